"""Near duplicates by MinHash bands, odd sketches and whole sets.

Of every set of word n-grams, many smallest hashes are sampled. Sets that agree in all samples of a band may be alike.
More samples of theirs, folded into a bitmap of parities, an odd sketch, tell how many samples two sets disagree in from
how many bits differ, most exactly where few do. What the sketches leave is compared set by set.

Two sets as alike as asked for miss each other with a chance below ``MISSED``, at either step; no other limit is set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.components import connected_components
from terrace.llm.shingles import pack, set_hash, shingle_set, unpack
from terrace.scratch import remove, scratch_path

#: Samples of a set: bands of so many rows each. Of two sets alike to 0.8, one pair in 10 to the 8 shares no band.
BANDS, ROWS = 48, 5
#: Samples folded into an odd sketch, and its bits, kept as longs.
SAMPLES, BITS = 2048, 4096
#: The chance that a sketch drops a pair that is as alike as asked for.
MISSED = 1e-8
#: N-grams whose samples are taken at once, unless a text has more; and the sets a task remembers to have sent.
AT_ONCE, REMEMBERED = 1 << 16, 1 << 18
#: Longs of a bitmap that spares most sets without a shared band a shuffle.
WORDS = 1 << 18

Write = Callable[[DataFrame, str], DataFrame]

_numbers = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 64, (4, max(SAMPLES, BANDS * ROWS)), np.uint64)
_FACTORS, _FLIPS, _SALTS = _numbers[0] | np.uint64(1), _numbers[1], _numbers[2]
_WEIGHTS = _numbers[3][: BANDS * ROWS].reshape(BANDS, ROWS) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def samples(sets: list[np.ndarray], count: int) -> np.ndarray:
    """The smallest hash of each set, none of them empty, under each of so many hash functions."""
    grams = np.concatenate(sets).astype(np.uint64)
    starts = np.append(0, np.cumsum([len(s) for s in sets])[:-1])
    hashed, least = np.empty_like(grams), np.empty((len(sets), count), np.uint64)
    for i in range(count):
        np.bitwise_xor(grams, _FLIPS[i], out=hashed)
        np.multiply(hashed, _FACTORS[i], out=hashed)
        least[:, i] = np.minimum.reduceat(hashed, starts)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """A long for each band of each set; those of different bands differ."""
    weighted = (_mixed(least).reshape(-1, BANDS, ROWS) * _WEIGHTS).sum(axis=2, dtype=np.uint64)
    return _mixed(weighted + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def sketches(least: np.ndarray) -> np.ndarray:
    """The odd sketch of each set's samples: a bit is set if an odd number of samples falls to it."""
    place = (_mixed(least ^ _SALTS[:SAMPLES]) >> np.uint64(40)) % np.uint64(BITS)
    flat = (np.arange(len(least), dtype=np.int64)[:, None] * BITS + place.astype(np.int64)).ravel()
    odd = (np.bincount(flat, minlength=len(least) * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(-1, BITS), axis=1).view(np.int64)


@cache
def most_bits(percent: int) -> int:
    """The bits that sketches of sets alike to ``percent`` of 100 differ in at most, but for a chance of ``MISSED``.

    Each sample in which they disagree, one in ``100 - percent`` of 100, flips two random bits. Flips are followed one
    by one through the number of bits that differ, and weighted by the binomial distribution of disagreements.
    """
    part, n = 1 - percent / 100, np.arange(BITS + 1)
    differ, total = np.zeros(BITS + 1), np.zeros(BITS + 1)
    differ[0], weight = 1.0, (1 - part) ** SAMPLES
    for disagreed in range(SAMPLES + 1):
        total += weight * differ
        weight *= (SAMPLES - disagreed) / (disagreed + 1) * (part / (1 - part)) if part < 1 else 0
        for _ in range(2):
            up, down = differ * (BITS - n) / BITS, differ * n / BITS
            differ = np.append(0, up[:-1]) + np.append(down[1:], 0)
    beyond = np.cumsum(total[::-1])[::-1]  # the chance of so many or more
    return int(np.argmax(np.append(beyond, 0) <= MISSED)) - 1


def _signed(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """Each row's key, size and name of its set; with bands and packed set where its task has the set first."""
    kind = df.schema[key].dataType
    fields = "n_shingles long, node long, bands array<long>, grams binary"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()

        def rows(keys: pa.Array, sizes: list, nodes: list, at: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            banded, packed = [None] * len(sizes), [None] * len(sizes)
            if sets:
                for i, b, g in zip(at, bands(samples(sets, BANDS * ROWS)), sets):
                    banded[i], packed[i] = b, pack(g.view(np.int64))
            columns = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(banded, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(
                [keys, *columns, pa.array(packed, pa.binary())], names=["key", *[f.split()[0] for f in fields.split(", ")]]
            )

        for batch in batches:
            start, sizes, nodes, at, sets, held = 0, [], [], [], [], 0
            for row, value in enumerate(batch.column(1)):
                grams = shingle_set(value.as_py(), n)
                node = set_hash(grams) if len(grams) else None
                if node is not None and node not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(node)
                    at.append(row - start)
                    sets.append(grams)
                    held += len(grams)
                sizes.append(len(grams))
                nodes.append(node)
                if held >= AT_ONCE:
                    yield rows(batch.column(0).slice(start, row + 1 - start), sizes, nodes, at, sets)
                    start, sizes, nodes, at, sets, held = row + 1, [], [], [], [], 0
            if sizes:
                yield rows(batch.column(0).slice(start), sizes, nodes, at, sets)

    keyed = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return keyed.mapInArrow(sign, f"key {kind.simpleString()}, {fields}")


def _roughly_in(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of these nodes, and a few of others, without a shuffle: by a bitmap of at most ``WORDS`` longs.

    No exact semi-join follows, as Spark would do it first, and shuffle all sets for it; other sets do no harm.
    """
    word, bit = F.col("node").bitwiseAND(F.lit(WORDS - 1)).alias("word"), F.shiftright("node", 58).bitwiseAND(F.lit(63)).cast("int")
    one = F.expr("shiftleft(1L, bit)")
    words = nodes.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or(one).alias("bits"))
    marked = rows.select("*", word, bit.alias("bit")).join(F.broadcast(words), "word")
    return marked.where(F.col("bits").bitwiseAND(one) != 0).select(*rows.columns)


def _sketched(sets: DataFrame) -> DataFrame:
    """``node``, ``size`` and ``grams`` with the odd sketch of each set."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, sets = 0, 0, []
            for row, packed in enumerate(batch.column("grams")):
                sets.append(unpack(packed.as_py()).view(np.uint64))
                held += len(sets[-1])
                if held >= AT_ONCE or row + 1 == batch.num_rows:
                    folded = pa.array(list(sketches(samples(sets, SAMPLES))), pa.list_(pa.int64()))
                    part = batch.slice(start, len(sets))
                    yield pa.RecordBatch.from_arrays([*part.columns, folded], names=[*part.schema.names, "sketch"])
                    start, held, sets = row + 1, 0, []

    return sets.mapInArrow(fold, "node long, size long, grams binary, sketch array<long>")


def _apart(one: str, other: str) -> Column:
    """The bits that two sketches differ in."""
    bits = F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, b: total + b)


def _sizes_allow(least: str, most: str, other_least: str, other_most: str, percent: int) -> Column:
    return (100 * F.col(most) >= percent * F.col(other_least)) & (100 * F.col(other_most) >= percent * F.col(least))


def _likely(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) whose sizes and sketches allow them to be alike."""

    def end(name: str) -> DataFrame:
        return known.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    both = pairs.join(end("a"), "a").join(end("b"), "b")
    sizes = _sizes_allow("size_a", "size_a", "size_b", "size_b", percent)
    return both.where(sizes & (_apart("sketch_a", "sketch_b") <= most_bits(percent))).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets are alike."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = unpack(x.as_py()), unpack(y.as_py())
                shared = len(x) + len(y) - len(np.union1d(x, y))
                kept.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    one, other = sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), sets.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _ordered(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _linked(signed: DataFrame, percent: int, write: Write, done: Callable[[], None]) -> DataFrame:
    """Components (``node``, ``component``) of the sets that have links.

    A band's value that several sets have is a bucket. First every set of a bucket is compared with one of them, chosen
    by hash, so that buckets differ in it. What then still shares a bucket but no component is compared between
    components, never within one (``_between``): a group of near copies costs a comparison for each of them, and each
    outlier beside it as many again.
    """
    filled = signed.where("bands IS NOT NULL")
    banded = write(filled.select("node", "bands").dropDuplicates(["node"]), "bands")
    placed = banded.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = placed.groupBy("bucket").count().where("count > 1").select("bucket")
    buckets = write(placed.join(shared, "bucket"), "buckets")
    sets = _roughly_in(filled.select("node", F.col("n_shingles").alias("size"), "grams"), buckets.select("node"))
    sets = write(_sketched(sets.dropDuplicates(["node"])), "sets")
    done()

    known = sets.select("node", "size", "sketch")
    centres = buckets.groupBy("bucket").agg(F.min_by("node", F.xxhash64("bucket", "node")).alias("centre"))
    starred = buckets.join(centres, "bucket").where("node <> centre").select(*_ordered("node", "centre")).distinct()
    pairs = write(_likely(starred, known, percent), "pairs")
    links = write(_confirmed(pairs, sets, percent), "links")
    components = connected_components(links, write)

    labelled = buckets.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = write(labelled, "labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ = labelled.join(mixed.select("bucket"), "bucket", "left_semi")
    first = banded.select("node", F.transform("bands", lambda b: F.shiftright(b, 32).cast("int")).alias("bands"))
    left = write(_between(open_, known.join(first, "node"), percent).join(pairs, ["a", "b"], "left_anti"), "pairs")
    if left.isEmpty():
        return components
    return connected_components(links.unionByName(write(_confirmed(left, sets, percent), "links")), write)


def _between(rows: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in a bucket whose sizes and sketches allow them to be alike.

    What a component has in a bucket lies within some number of bits, its reach, of the component's first set. So by the
    triangle inequality two of them can have a likely pair only if these two sets are not further apart than both
    reaches and the bound together, and a set of one only if it is no further from the other's first set than that
    one's reach and the bound. The smaller one's sets are taken one by one first. Each test is part of a join, which
    gives out only what passes: of a likely pair, that in the first band they agree in.
    """
    bound, about = most_bits(percent), ["component", "heart", "reach", "least", "most", "sets"]
    heart = known.select(F.col("node").alias("component"), F.col("sketch").alias("heart"))
    held = rows.join(known, "node")
    # Dealt out by bucket as well as component, so that the join before it can split a hot component.
    near = held.join(heart, "component").select("bucket", "component", "size", _apart("sketch", "heart").alias("apart"))
    groups = near.repartition("bucket", "component").groupBy("bucket", "component").agg(
        F.max("apart").alias("reach"), F.min("size").alias("least"), F.max("size").alias("most"), F.count("*").alias("sets")
    )
    groups = groups.join(heart, "component")
    home = groups.select("bucket", *[F.col(c).alias(f"home_{c}") for c in about])
    away = groups.select(F.col("bucket").alias("met"), *[F.col(c).alias(f"away_{c}") for c in about])
    smaller = F.struct("home_sets", "home_component") < F.struct("away_sets", "away_component")
    sizes = _sizes_allow("home_least", "home_most", "away_least", "away_most", percent)
    near = _apart("home_heart", "away_heart") <= F.col("home_reach") + F.col("away_reach") + bound
    meeting = home.join(away, (home["bucket"] == away["met"]) & smaller & sizes & near)
    meeting = meeting.select("bucket", "home_component", *[f"away_{c}" for c in about[:-1]])

    def members(name: str) -> DataFrame:
        return held.select(
            F.col("bucket").alias("place"), F.col("component").alias("of"), "band",
            *[F.col(c).alias(f"{name}_{c}") for c in ("node", "size", "sketch", "bands")],
        )

    ours, theirs = members("one").drop("band"), members("other")
    sizes = _sizes_allow("one_size", "one_size", "away_least", "away_most", percent)
    near = _apart("one_sketch", "away_heart") <= F.col("away_reach") + bound
    half = meeting.join(ours, (F.col("bucket") == F.col("place")) & (F.col("home_component") == F.col("of")) & sizes & near)
    half = half.select("bucket", "away_component", "one_node", "one_size", "one_sketch", "one_bands")
    sizes = _sizes_allow("one_size", "one_size", "other_size", "other_size", percent)
    likely = _apart("one_sketch", "other_sketch") <= bound
    earlier = F.zip_with(F.slice("one_bands", 1, F.col("band")), F.slice("other_bands", 1, F.col("band")), lambda x, y: x == y)
    again = F.exists(earlier, lambda met: met)
    met = half.join(theirs, (F.col("bucket") == F.col("place")) & (F.col("away_component") == F.col("of")) & sizes & likely & ~again)
    return met.select(*_ordered("one_node", "other_node")).distinct()


def near_duplicates(df: DataFrame, key: str, text: str, n: int = 5, percent: int = 80) -> DataFrame:
    """A row per row of ``df``: its key, ``n_shingles``, ``component_id`` and ``kept``.

    Sets of distinct word n-grams of whole texts (``shingle_set``: A-Z as a-z; of fewer words, the whole sequence) are
    linked where 100 times their intersection is at least ``percent``, 80 or more, times their union, found by samples
    and sketches as above and confirmed on the whole sets. ``component_id`` is the smallest key that links lead to, the
    row's own included; ``kept`` tells the rows of that key. A null or blank text has an empty set, is linked with nothing
    and kept. Repeated rows and copies are one set. A null key is never the smallest beside others, and not kept but
    where all of its component are null. Other columns are left out; an empty table gives no rows.
    """
    if not 80 <= percent <= 100:
        raise ValueError("the samples are for sets alike to 80 of 100 or more")
    spark = df.sparkSession
    folder = scratch_path(spark, "near-duplicates")
    number = iter(range(1 << 30))

    def write(rows: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{next(number)}-{name}"
        rows.write.parquet(path)
        return spark.read.parquet(path)

    home = scratch_path(spark, "near-duplicates-signed")
    _signed(df, key, text, n).write.parquet(home)
    signed = spark.read.parquet(home)
    rows = write(signed.select("key", "n_shingles", "node"), "rows")
    found = _linked(signed, percent, write, lambda: remove(spark, home))

    filled, empty = rows.where("node IS NOT NULL"), rows.where("node IS NULL")
    own = filled.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = write(own.groupBy("component").agg(F.min("key").alias("component_id")), "smallest")
    whole = own.join(smallest, "component").select("key", "n_shingles", "component_id")
    both = whole.unionByName(empty.select("key", "n_shingles", F.col("key").alias("component_id")))
    return both.withColumn("kept", F.col("key").eqNullSafe(F.col("component_id"))).withColumnRenamed("key", key)
