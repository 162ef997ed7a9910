import hashlib
import random

import pytest
from brute import contamination
from pyspark.sql import functions as F

from terrace.llm.contamination import find_contamination


def compared(spark, texts, items, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("words", F.lit("x")).withColumn("n_hit", F.lit(-1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("size", F.lit(0))
    out = find_contamination(docs, "text", bench, "item_id", "text", **options)
    assert "words" in out.columns and "text" not in out.columns
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in out.collect()}
    assert got == {
        i: (n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0)
        for i, (n, hit, names) in enumerate(contamination(texts, items))
    }


def passages(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcde") + rng.choice(["", "x", "é", "9"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([30, 12, 10, 9, 3, 2, 1, 15, 15])]
    items += [(20, None), (21, "..."), (None, "null named item of some ten words or even more"), (22, items[1][1]), (1, items[0][1][:40])]
    texts = [None, "", "!?", "a"]
    for _ in range(60):
        words = [word() for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(0, 2)):
            said = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, max(0, len(said) - 9))
            words[rng.randint(0, len(words)) :][:0] = said
            at = rng.randint(0, len(words))
            words[at:at] = said[cut:]
        texts.append(", ".join(words).upper() if rng.random() < 0.2 else "-".join(words))
    return [*texts, texts[-1], " ".join(["a", "b"] * 20000), "null named item of some ten words or even more"], items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("most", [1 << 20, 0])
def test_like_brute_force_by_either_join(spark, seed, most):
    texts, items = passages(seed)
    compared(spark, texts, items, broadcast_bytes=most)


def test_without_short_items(spark):
    texts, items = passages(3)
    compared(spark, texts, [x for x in items if len((x[1] or "").split()) > 9])


def test_empty_tables(spark):
    compared(spark, [], [(1, "a b c")])
    compared(spark, ["a b c", None], [])


def test_repeated_rows_stay(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 3 + [(1, "x"), (None, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "b c")], "item_id long, text string")
    got = find_contamination(docs, "text", items, "item_id", "text").collect()
    assert sorted((str(r["doc_id"]), r["n_hit"]) for r in got) == [("1", 0), ("1", 2), ("1", 2), ("1", 2), ("None", 2)]


def test_no_python_in_the_plan_and_no_words_shuffled(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    plan = find_contamination(docs, "text", items, "item_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
