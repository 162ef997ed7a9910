"""Which documents contain passages of benchmark items: a prefix-filtered join on rare shingles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import unused_name
from terrace.llm.urls import WORDS as BLOOM_WORDS
from terrace.llm.urls import block_of, blocked_bloom, masks_of
from terrace.llm.words import lower_ascii, split_words

SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"

#: The windows are broadcast where their words and items take so many bytes at most, as measured; beyond that
#: they are joined by a shuffle, after a Bloom filter of fixed size.
BROADCAST_BYTES = 64 << 20
SHINGLE = 2


def benchmark_windows(items: DataFrame, item: str, text: str, length: int) -> DataFrame:
    """Each different window of the items' words: ``window``, its ``size``, and the ``items`` that have it.

    Windows are ``length`` words long; an item of fewer words, but not none, is one window.
    """
    words = items.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
        split_words(lower_ascii(F.col(text)), SEPARATORS).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - length + 1, F.lit(1)))).alias("start")
    windows = words.select("item", "words", starts).select("item", F.slice("words", F.col("start"), length).alias("window"))
    return windows.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("size", F.size("window"))


def _key(words: Column, at: Column, shingle: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(shingle)])


def _positions(docs: DataFrame, shingle: int, with_document: bool) -> DataFrame:
    """Each place where a shingle begins, with its key; also one row at -1 for the document itself if asked for.

    The words stay a reference in generated code as far as the next join or aggregation.
    """
    first = F.lit(-1 if with_document else 0)
    last = F.greatest(F.size("words") - shingle, first)
    rows = docs.select("*", F.explode(F.sequence(first, last)).alias("at"))
    return rows.withColumn("key", _key(F.col("words"), F.col("at"), shingle))


def _prefixes(windows: DataFrame, docs: DataFrame, shingle: int, small: bool) -> DataFrame:
    """Each window's rarest shingle among all documents, and where in the window it is.

    As a window must be in a document whole, a prefix of one shingle in the order of rarity is all it takes.
    """
    at = F.explode(F.sequence(F.lit(0), F.col("size") - shingle)).alias("offset")
    shingles = windows.select("window", "size", "items", at).withColumn("key", _key(F.col("window"), F.col("offset"), shingle))
    known = shingles.select("key").distinct()
    places = _positions(docs, shingle, False).select("key")
    counts = places.join(F.broadcast(known) if small else known, "key", "left_semi").groupBy("key").count()
    order = F.struct(F.coalesce("count", F.lit(0)).alias("count"), "key", "offset")
    rarest = (
        shingles.join(counts, "key", "left")
        .groupBy("window")
        .agg(F.min(order).alias("rarest"), F.first("items").alias("items"), F.first("size").alias("size"))
    )
    return rarest.select("window", "size", "items", F.col("rarest.key").alias("key"), F.col("rarest.offset").alias("offset"))


def _bytes(windows: DataFrame) -> int:
    each = F.octet_length(F.array_join("window", " ")) + F.octet_length(F.array_join("items", " ")) + 64
    return windows.agg(F.sum(each)).first()[0] or 0


def _matches(docs: DataFrame, prefixes: DataFrame, shingle: int, small: bool) -> DataFrame:
    """Documents with the windows they contain (``start``, ``size``, ``items``), and each document without one."""
    places = _positions(docs, shingle, True)
    start = F.col("at") - F.col("offset")
    own = ["row", "n_words", "at"]
    if small:
        found = places.withColumnRenamed("key", "place_key").join(
            F.broadcast(prefixes),
            (F.col("place_key") == F.col("key"))
            & (start >= 0)
            & (start + F.col("size") <= F.col("n_words"))
            & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("size")) == F.col("window")),
            "left",
        )
        found = found.where((F.col("at") < 0) | F.col("size").isNotNull())
        return found.select(*own, start.alias("start"), "size", "items")

    # Beyond the bound: a filter of fixed size leaves few places, and these take the words around them along.
    most = prefixes.agg(F.max("size")).first()[0] or 1
    bloom = blocked_bloom(prefixes, "key")
    words = [f"word{j}" for j in range(BLOOM_WORDS)]
    held = reduce(lambda a, b: a & b, [F.col(w).bitwiseAND(m) == m for w, m in zip(words, masks_of(F.col("key")))])
    around = F.greatest(F.col("at") - (most - 1), F.lit(0))
    possible = (
        places.join(F.broadcast(bloom), block_of(F.col("key")) == F.col("block"), "left")
        .where((F.col("at") >= 0) & held)
        .select(*own, "key", around.alias("around"), F.slice("words", around + 1, 2 * most).alias("near"))
    )
    found = possible.join(prefixes, "key").where(
        (start >= 0)
        & (start + F.col("size") <= F.col("n_words"))
        & (F.slice("near", F.greatest(start - F.col("around"), F.lit(0)) + 1, F.col("size")) == F.col("window"))
    )
    nothing = places.where(F.col("at") < 0).select(
        *own, F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("size"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    return found.select(*own, start.alias("start"), "size", "items").unionByName(nothing)


def find_contamination(
    docs: DataFrame, text: str, items: DataFrame, item: str, item_text: str, length: int = 10, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Adds ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` to every document.

    A word is hit that is in an occurrence of a window (``benchmark_windows``); ``n_items`` counts the items with
    an occurring window, and ``items_sha256`` is the digest of their names, in order, between commas. All
    statistics count all documents. Null texts have no words, and items without words no windows; null item names
    are empty ones; repeated rows are judged alike, each; columns of the five names are replaced, others stay.

    A document's words are split twice, once to count the shingles that items have, once to find the windows; only
    matches and one row per document are shuffled.
    """
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    docs = docs.drop(*added)
    windows = benchmark_windows(items, item, item_text, length)
    small = _bytes(windows) <= broadcast_bytes
    words = split_words(lower_ascii(F.col(text)), SEPARATORS)
    kept = [c for c in docs.columns if c != text]
    one = docs.select(F.struct(*[docs[c] for c in kept], F.xxhash64(docs[text]).alias(unused_name(docs, "h"))).alias("row"), words.alias("words"))
    one = one.withColumn("n_words", F.size("words"))

    sizes = [n for n in range(1, SHINGLE) if not windows.where(F.col("size") == n).isEmpty()] + [SHINGLE]
    parts = []
    for n in sizes:
        mine = windows.where(F.col("size") == n if n < SHINGLE else F.col("size") >= n)
        parts.append(_matches(one, _prefixes(mine, one, n, small), n, small).withColumn("own", (F.col("at") < 0) & F.lit(n == SHINGLE)))
    matches = reduce(DataFrame.unionByName, parts)

    span = F.when(F.col("size").isNotNull(), F.struct(F.col("start").alias("start"), (F.col("start") + F.col("size")).alias("stop")))
    by_doc = matches.groupBy("row").agg(
        F.count_if("own").alias("copies"),
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("names"),
    )
    none = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
    merged = F.aggregate(
        "spans",
        none,
        lambda acc, s: F.struct(
            (acc["hit"] + F.greatest(s["stop"] - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("hit"),
            F.greatest(s["stop"], acc["end"]).alias("end"),
        ),
    )
    result = by_doc.select(
        "row",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        "n_words",
        merged["hit"].cast("long").alias("n_hit"),
        F.size("names").cast("long").alias("n_items"),
        F.sha2(F.array_join("names", ","), 256).alias("items_sha256"),
    )
    return result.select(
        *[F.col("row").getField(c).alias(c) for c in kept], *added[:4], (F.col("n_hit") > 0).alias("contaminated")
    )
