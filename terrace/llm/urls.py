"""URL filtering: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"

#: Blocks of the filter, and 64-bit words of a block. Only blocks in use are rows of the filter, so what is
#: broadcast has at most this many rows of five longs, however long the list; a longer list makes more pages
#: possible hits, which the exact join sorts out.
BLOCKS = 1 << 18
WORDS = 4


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """After the first ``://``, in lower case; empty where there is none, also for null."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """One form for the spellings of a URL: no scheme, ``www.``, default port, closing slash, tracking
    parameters or fragment, and parameters in order. Null for null; without a ``://``, what is given, as it is."""
    params = F.array_sort(
        F.filter(F.split(F.regexp_extract(url, _PARTS, 3), "&"), lambda p: (p != "") & ~p.rlike(_TRACKING))
    )
    query = F.array_join(params, "&")
    place = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    at = F.concat(place, F.regexp_replace(path(url), "/+$", ""))
    whole = F.concat(at, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.contains(url, F.lit("://")), whole).otherwise(url)


def block_of(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 46)


def masks_of(key: Column) -> list[Column]:
    """Two bits in each word of the block, from slices of a second hash."""
    bits = F.xxhash64(key, F.lit(1))
    slot = lambda i: F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), slot(i))
    return [one(2 * j).bitwiseOR(one(2 * j + 1)) for j in range(WORDS)]


def blocked_bloom(keys: DataFrame, key: str) -> DataFrame:
    """The filter as a table: a row for each block in use (``block``, ``word0`` ..). Null keys are not in it."""
    masks = [m.alias(f"word{j}") for j, m in enumerate(masks_of(F.col(key)))]
    rows = keys.where(F.col(key).isNotNull()).select(block_of(F.col(key)).alias("block"), *masks)
    return rows.groupBy("block").agg(*[F.bit_or(f"word{j}").alias(f"word{j}") for j in range(WORDS)])


def rule_for(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (action, host, path) that fits, as its string and its action; null where none does.

    A rule fits its host and every subdomain where the path starts with the rule's. Of the same rule given
    twice, ``block`` counts.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block"))
    fits = [
        ((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in ordered
    ]
    pick = lambda values: F.coalesce(
        *[F.when(f, F.lit(v)) for f, v in zip(fits, values)], F.lit(None).cast("string")
    )
    return pick([h + p for _, h, p in ordered]), pick([a for a, _, _ in ordered])


def filter_urls(
    df: DataFrame, url: str, listed: DataFrame, listed_url: str, rules: Iterable[tuple[str, str, str]] = ()
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` (``allow`` or ``block``) to every row.

    A rule decides where one fits; elsewhere a row is blocked where its canonical URL is that of a listed one.
    The blocked Bloom filter passes all such rows and a few others, and only those that pass are shuffled, for
    a hash join on the canonical URL that decides exactly. Columns of these four names are replaced. Null or
    malformed URLs have empty host and path, no rule, and are allowed unless listed as they are;
    repeated rows are judged each; an empty list blocks nothing; other columns stay as they are.
    """
    df = df.drop("host", "path", "rule", "verdict")
    names = set(df.columns) | {"block", *(f"word{j}" for j in range(WORDS))}
    free = lambda name: next(n for i in range(len(names) + 1) if (n := f"{name}{i or ''}") not in names)
    key, action, hit = free("canonical"), free("action"), free("listed")
    rule, decided = rule_for(F.col("host"), F.col("path"), rules)
    judged = (
        df.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
        .withColumns({"rule": rule, action: decided, key: canonical(F.col(url))})
    )
    keys = listed.select(canonical(F.col(listed_url)).alias(key)).where(F.col(key).isNotNull()).distinct()

    blocks = [F.col(f"word{j}").alias(free(f"word{j}_")) for j in range(WORDS)]
    at = free("at_block")
    bloom = blocked_bloom(keys, key).select(F.col("block").alias(at), *blocks)
    bits = [free(f"word{j}_") for j in range(WORDS)]
    probe = judged.where(F.col(action).isNull() & F.col(key).isNotNull())
    held = reduce(lambda a, b: a & b, [F.col(b).bitwiseAND(m) == m for b, m in zip(bits, masks_of(F.col(key)))])
    probed = probe.join(F.broadcast(bloom), block_of(F.col(key)) == F.col(at), "left")
    possible = F.coalesce(held, F.lit(False))

    columns = [*df.columns, "host", "path", "rule"]
    ruled = judged.where(F.col(action).isNotNull() | F.col(key).isNull())
    passed = probed.where(possible).select(*columns, key)
    confirmed = passed.join(keys.withColumn(hit, F.lit(True)), key, "left")
    return (
        ruled.select(*columns, F.coalesce(F.col(action), F.lit("allow")).alias("verdict"))
        .unionByName(probed.where(~possible).select(*columns, F.lit("allow").alias("verdict")))
        .unionByName(
            confirmed.select(*columns, F.when(F.col(hit), "block").otherwise("allow").alias("verdict"))
        )
    )
