"""Dictionary lemmatisation as a table job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import column, delimiter_pattern, quote_table
from terrace.operators.base import Step, require_columns
from terrace.scratch import scratch_path

# A dictionary up to this size is sent whole to every executor.
BROADCAST_BYTES = 32 * 1024 * 1024


def _entries(dictionary: DataFrame) -> DataFrame:
    """One lemma per token, written out: a dictionary that took work to make is measured and joined."""
    spark, place = dictionary.sparkSession, scratch_path(dictionary.sparkSession, "lemmas")
    known = dictionary.where(F.col("token").isNotNull() & F.col("lemma").isNotNull())
    known.groupBy("token").agg(F.min("lemma").alias("lemma")).write.parquet(place)
    return spark.read.parquet(place)


def _is_small(dictionary: DataFrame, most: int) -> bool:
    size = F.sum(F.octet_length("token") + F.octet_length("lemma") + 64)
    return (dictionary.agg(size).first()[0] or 0) <= most


def _merged(words: DataFrame, rows: DataFrame, split: Column, entries: DataFrame) -> DataFrame:
    """Left join by shuffle on the token, of which one may be a third of all words.

    Tokens with more than a task's share of all words, at most as many as there are tasks, are counted first.
    Their words go to several tasks each, as do those without a token, and their few entries are copied for it;
    all other entries are joined as they are.
    """
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    total = rows.agg(F.sum(F.size(split))).first()[0] or 0
    counts = rows.select(F.explode(split).alias("token")).groupBy("token").count()
    hot = {r["token"]: r["count"] for r in counts.where(F.col("count") > F.lit(total / tasks)).collect()}
    pieces = -(-max(hot.values(), default=1) * tasks // max(total, 1))
    is_hot = F.col("token").isin(list(hot)) if hot else F.lit(False)
    spread = F.pmod(F.xxhash64("key", "position"), F.lit(pieces)).cast("int")
    salt = F.when(is_hot, spread).when(F.col("token").isNull(), F.pmod(F.xxhash64("key"), F.lit(tasks)).cast("int"))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0)))
    known = entries.withColumn("salt", F.explode(copies))
    salted = words.withColumn("salt", F.coalesce(salt, F.lit(0)))
    return salted.join(known.hint("merge"), ["token", "salt"], "left").drop("salt")


def lemmatize(
    df: DataFrame,
    key: str,
    text: str,
    dictionary: DataFrame,
    delimiter: str = " ",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Replace each word of ``text`` that ``dictionary(token, lemma)`` knows by its lemma.

    Words are what ``delimiter`` separates; their order and number stay, and a null text stays null.
    A token listed twice takes the smaller lemma. ``key`` identifies a row: the words of one text
    meet again in an aggregation by it, so no group is larger than a text, and a key held by two
    rows fails the job. The text and the other columns travel with the first word; of the others only those that the
    dictionary knows are kept, and take their places in the text.

    With a dictionary small enough to broadcast (``broadcast_bytes``, 32 MiB if not given), whole texts are
    shuffled once, by key, and their words not at all. Beyond that words meet the dictionary in a merge join.
    The dictionary is written out and measured when this is called, and words are counted where it is large.
    """
    require_columns(df, [key, text])
    require_columns(dictionary, ["token", "lemma"])
    entries = _entries(dictionary)
    small = _is_small(entries, BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes)
    row = F.struct(*[column(n) for n in df.columns])
    rows = df.select(column(key).alias("key"), row.alias("row"))
    split = F.split(F.col("row").getField(text), delimiter_pattern(delimiter))
    words = (
        (rows.repartition("key") if small else rows)
        .select("key", "row", F.posexplode_outer(split).alias("position", "token"))
        .withColumn("row", F.when(F.coalesce("position", F.lit(0)) == 0, F.col("row")))
    )
    met = words.join(F.broadcast(entries), "token", "left") if small else _merged(words, rows, split, entries)
    known = F.when(F.col("lemma").isNotNull(), F.struct("position", "lemma"))
    texts = (
        met.where((F.coalesce("position", F.lit(0)) == 0) | F.col("lemma").isNotNull())
        .groupBy("key")
        .agg(
            F.sort_array(F.collect_list(known)).alias("found"),
            F.first("row", ignorenulls=True).alias("row"),
            F.count("row").alias("rows"),
        )
        .withColumn("words", split)
    )
    lemmatized = (
        F.when(F.col("rows") > 1, F.raise_error(F.lit(f"'{key}' is not unique")).cast("string"))
        .when(F.col("words").isNotNull(), F.array_join(_replaced(F.col("words"), F.col("found")), delimiter))
        .alias(text)
    )
    return texts.select(*[lemmatized if n == text else F.col("row").getField(n).alias(n) for n in df.columns])


def _replaced(words: Column, found: Column) -> Column:
    """The words with lemmas at the positions found, which are in order: stretches between two of them are kept whole."""
    after = lambda i: F.when(i > 0, F.get(found, i - 1)["position"] + 1).otherwise(0)
    stretch = lambda first, end: F.slice(words, first + 1, end - first)
    upto = F.transform(found, lambda f, i: F.concat(stretch(after(i), f["position"]), F.array(f["lemma"])))
    return F.concat(F.flatten(upto), stretch(after(F.size(found)), F.size(words)))


class Lemmatize(Step):
    """The same as a step: ``{key, text, dictionary}``, where ``dictionary`` names a table or view."""

    section_name = "lemmatize"

    def input_columns(self) -> list[str]:
        return [self.rules["key"], self.rules["text"]] if self.rules else []

    def apply(self, df: DataFrame) -> DataFrame:
        if not self.rules:
            return df
        dictionary = df.sparkSession.table(quote_table(self.rules["dictionary"]))
        return lemmatize(df, self.rules["key"], self.rules["text"], dictionary, self.rules.get("delimiter") or " ")
