import pytest
from brute import components, contamination, shingles
from pyspark.sql import functions as F
from test_packing import checked

import corpus_pipeline as pipeline

STAGES = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark, sf):
    """The small table, and rows of every odd kind."""
    table = spark.read.parquet(f"{sf}/documents.parquet")
    words = " ".join(f"word{i}" for i in range(40))
    odd = [
        (None, None), (None, ""), (9000, None), (9001, ""), (9002, words), (9002, words), (9003, words + " end"), (None, words),
        (9002, "another text of that number which is not alike at all"), (9004, "x " * 30000), (9005, words.upper()),
    ]
    more = spark.createDataFrame(odd, "doc_id long, text string").select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars")
    )
    return table.unionByName(more).withColumn("key", F.lit("mine")).withColumn("score", F.lit(1)).withColumn("kept", F.lit(0))


def kept(spark, sf, docs, name):
    out = STAGES[name](spark, docs, sf)
    assert out.columns == docs.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def test_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == [
        "quality classifier", "toxicity", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing",
    ]


@pytest.mark.parametrize("name, label, bad", [("quality classifier", "quality", 0), ("toxicity", "toxic", 1)])
def test_filters_keep_what_is_labelled_good(spark, sf, docs, name, label, bad):
    left = {k for k, _ in kept(spark, sf, docs, name)}
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good, rejected = [k for k, y in labels.items() if y != bad], [k for k, y in labels.items() if y == bad]
    assert len(left & set(good)) >= 0.97 * len(good)
    assert len(left & set(rejected)) <= 0.1 * len(rejected)


def test_one_of_each_group_stays(spark, sf, docs):
    rows = sorted({(r["doc_id"], r["text"]) for r in docs.collect()}, key=lambda r: (r[0] is None, r[0] or 0, str(r[1])))
    sets = [shingles(t, 5) for _, t in rows]
    want = [row for i, (row, root) in enumerate(zip(rows, components(sets, 80))) if i == root]
    got = kept(spark, sf, docs, "n-gram Jaccard join")
    ids = lambda found: sorted((k for k, _ in found), key=str)
    assert ids(got) == ids(want)


def test_leaky_documents_go(spark, sf, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hits = contamination([t for _, t in rows], items)
    assert kept(spark, sf, docs, "benchmark decontamination") == sorted((r for r, (_, hit, _) in zip(rows, hits) if not hit), key=str)


def test_packing_takes_what_is_there(spark, sf, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.limit(60).collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string").dropDuplicates()
    got = STAGES["best-fit packing"](spark, frame.where("doc_id < 9000"), sf).collect()
    checked(got, [r for r in set(rows) if r[0] is not None and r[0] < 9000])


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables(spark, sf, docs, name):
    assert STAGES[name](spark, docs.limit(0), sf).collect() == []


def test_run_is_the_stages_one_after_another(spark, sf):
    rows = pipeline.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert texts and checked(rows, texts)
