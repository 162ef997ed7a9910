"""Periodic runs against a check of every period."""

import random
import time

import pytest
from pyspark.sql import functions as F

from terrace.llm.query_runs import greatest_exponent, made_periodic
from terrace.llm.runs import collapse_runs, collapsed, find_runs, repeated_roots, runs_of_words


def brute(s, least, times):
    found = {}
    for q in range(1, len(s) // times + 1):
        x = 0
        while x + q < len(s):
            start = x
            while x + q < len(s) and s[x] == s[x + q]:
                x += 1
            length = x - start + q
            if length >= max(least, times * q):
                found.setdefault((start, length), q)
            x += x == start
    return sorted((start, length, q) for (start, length), q in found.items())


def made(rng):
    kinds, n = rng.choice([1, 2, 2, 3, 4]), rng.randint(0, 60)
    s = [rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.6:
        period, start = rng.randint(1, 8), rng.randrange(n)
        for i in range(start, n):
            s[i] = s[start + (i - start) % period]
        for _ in range(rng.randint(0, 2)):
            s[rng.randrange(n)] = rng.randrange(kinds)
    return s


@pytest.mark.parametrize("least", [3, 7, 24])
def test_runs_are_those_of_every_period(least):
    rng = random.Random(least)
    for _ in range(4000):
        s = made(rng)
        want = brute(s, least, 3)
        assert sorted(runs_of_words([str(c) for c in s], least)) == want
        assert sorted(find_runs(s, least, 3)) == want


def test_roots_are_the_longest_lyndon_words():
    rng = random.Random(5)
    lyndon = lambda w: all(w < w[i:] for i in range(1, len(w)))
    for _ in range(500):
        s = [rng.randrange(3) for _ in range(rng.randint(1, 30))]
        longest = [max(k for k in range(1, len(s) - i + 1) if lyndon(s[i : i + k])) for i in range(len(s))]
        want = set()
        for i, k in enumerate(longest):
            again = [j for j in range(i, len(s), k) if s[j : j + k] == s[i : i + k] and longest[j] == k]
            times = next(t for t in range(1, len(s) + 1) if i + t * k not in again)
            first = i < k or s[i - k : i] != s[i : i + k] or longest[i - k] != k
            if times > 1 and first:
                want.add((i, k, times))
        assert set(repeated_roots(s, 3)) == want


def test_long_texts_take_time_in_proportion():
    start = time.process_time()
    assert runs_of_words(["a"] * 1_000_000) == [(0, 1_000_000, 1)]
    words = [f"w{i % 5000}" for i in range(400_000)]
    assert runs_of_words(words) == [(0, 400_000, 5000)]
    nested = [w for i in range(60_000) for w in (f"x{i // 3}", "y")]
    runs_of_words(nested)
    assert time.process_time() - start < 60


def test_what_is_dropped():
    words = "a b c a b c a b c d".split()
    assert collapsed(words, [(0, 9, 3)]) == ["a", "b", "c", "d"]
    assert collapsed(words, [(0, 9, 3), (1, 9, 2)]) == ["a", "b", "c"]


def test_odd_rows(spark):
    same = " ".join(["x", "y"] * 20)
    rows = [(1, None, "k"), (2, "", "k"), (3, " \n\t ", None), (4, same, "k"), (4, same, "k"), (None, same, "k")]
    df = spark.createDataFrame(rows, "id long, text string, runs string")
    got = collapse_runs(df, "text")
    assert got.columns == ["id", "text", "runs", "collapsed"]
    out = sorted(((r.id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=repr)
    run = [(0, 40, 2)]
    assert out == sorted([(1, [], ""), (2, [], ""), (3, [], ""), (4, run, "x y"), (4, run, "x y"), (0, run, "x y")], key=repr)
    assert collapse_runs(df.limit(0), "text").count() == 0
    assert collapse_runs(df.select("runs"), "runs").columns == ["runs", "collapsed"]
    with pytest.raises(ValueError, match="three"):
        collapse_runs(df, "text", times=2)


def test_no_break_spaces_are_letters_and_case_counts(spark):
    text = " ".join(["a b", "A"] * 12)
    (row,) = collapse_runs(spark.createDataFrame([(text,)], "text string"), "text").collect()
    assert [tuple(r) for r in row.runs] == [(0, 24, 2)] and row.collapsed == "a b A"


def test_greatest_exponent_first_of_ties(spark):
    rows = [([(0, 30, 3), (5, 40, 4), (50, 25, 2)],), ([(0, 30, 3), (40, 40, 4)],), ([],)]
    df = spark.createDataFrame(rows, "runs array<struct<start: long, length: long, period: long>>")
    assert [tuple(r.best) if r.best else None for r in df.select(greatest_exponent("runs").alias("best")).collect()] == [
        (50, 25, 2),
        (0, 30, 3),
        None,
    ]


def test_documents_made_periodic(spark):
    from zlib import crc32

    ids = [i for i in range(200) if crc32(str(i).encode()) % 10 == 0][:3]
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(ids[0], text), (ids[1], None), (ids[2], " \t"), (None, text)]
    df = made_periodic(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.text for r in df.withColumn("text", F.col("text")).collect()}
    assert got[ids[1]] is None and got[ids[2]] == " \t" and got[None] == text
    g = crc32(str(ids[0]).encode()) // 10
    a = g % 50
    p = 1 + (50 - a) // (3 + g % 8)
    assert got[ids[0]].split(" ") == [f"w{i if i < a else a + (i - a) % p}" for i in range(50)]
