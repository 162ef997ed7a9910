import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm.hashing import PIECE, Grams, Rows, minimise, pack, sigmoid, unpack
from terrace.llm.quality import WIDTH, fit_ordinal, grade_quality, train_quality
from terrace.llm.quality import features as quality_features
from terrace.llm.queries import QUERIES
from terrace.llm.sampling import fit_in_one_task, labelled_sample
from terrace.llm.toxicity import _middle, fit_weights, log_count_ratios, score_toxicity, train_toxicity

MID = "/root/testdata/sf0.1"


def test_grams_are_those_of_the_whole_text():
    grams = Grams((2, 3), 16, True)
    text = "Ab c\n\tAB " * 50
    buckets, met = grams.of(text)
    assert (buckets[1:] > buckets[:-1]).all() and met.sum() == 2 * (len(text) + 2) - 3
    assert (grams.of(text.lower())[0] == buckets).all() and (Grams((2, 3), 16, False).of(text)[0].shape != buckets.shape)
    assert len(grams.of(None)[0]) == len(grams.of("")[0]) == 1


def test_long_texts_are_hashed_in_pieces_alike(monkeypatch):
    grams, text = Grams((3, 5), 14, False), "".join(chr(97 + i * i % 26) for i in range(5000)) + "é" * 10
    whole = grams.of(text)
    monkeypatch.setattr("terrace.llm.hashing.PIECE", 64)
    for a, b in zip(grams.of(text), whole):
        assert (a == b).all()
    assert PIECE == 1 << 20


def test_minimise_finds_the_minimum():
    target = np.arange(6.0)
    scale = np.array([1, 10, 100, 1, 5, 50.0])
    x = minimise(lambda x: (0.5 * scale @ (x - target) ** 2, scale * (x - target)), np.zeros(6))
    assert np.allclose(x, target, atol=1e-3)


def test_features_travel_whole():
    buckets, values = quality_features("some words, some words")
    a, b = unpack(pack((buckets, values)))
    assert (a == buckets).all() and (b == values).all() and a.max() < WIDTH


def rows_of(*sets, width=8):
    return Rows.of([(np.array(s), np.full(len(s), 1 / np.sqrt(len(s)), np.float32)) for s in sets], width)


def test_ratios_are_those_of_counts():
    ratios = log_count_ratios(rows_of([0, 1], [0, 2], [2, 3]), np.array([1.0, 1.0, 0.0]))
    ones, zeros = np.array([3, 2, 2, 1, 1, 1, 1, 1]), np.array([1, 1, 2, 2, 1, 1, 1, 1])
    assert np.allclose(ratios, np.log(ones / ones.sum()) - np.log(zeros / zeros.sum()))


def test_weights_separate_what_can_be_separated():
    rows, y = rows_of([0, 1], [0, 2], [2, 3], [1, 3]), np.array([1.0, 1.0, 0.0, 0.0])
    weights, constant = fit_weights(rows, y)
    assert ((sigmoid(rows.times(weights) + constant) >= 0.5) == (y == 1)).all()


def test_the_middle_lies_in_the_widest_gap():
    assert _middle(np.array([0.0, 1.0, 5.0, 6.0]), np.array([0, 0, 1, 1])) == 3.0


@pytest.mark.parametrize("grades", [[0, 0, 1, 1, 2, 2], [0, 0, 2, 2, 2, 2]])
def test_thresholds_rise_and_grades_are_told_apart(grades):
    rows = rows_of([0], [0, 7], [1], [1, 7], [2], [2, 7])
    weights, cuts = fit_ordinal(rows, np.array(grades), 2, penalty=1e-3)
    assert (np.diff(cuts) > 0).all()
    expected = sigmoid(rows.times(weights)[:, None] - cuts).sum(1)
    assert (expected.round() == grades).all()


def labelled(spark):
    docs = [(i, ("vile " if i % 4 == 0 else "kind ") * (1 + i % 5) + f"text number {i}", "x") for i in range(120)]
    docs += [(1000, None, None), (1001, "", "y"), (None, "vile vile", "z"), (1002, "kind " * 60000, "w"), (3, "kind text number 3", "again")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, label string").withColumn("copy", F.lit(7)).withColumn("score", F.lit("old"))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)] + [(None, 1), (5000, 1), (7, None)], "doc_id long, toxic int")
    return frame, labels


def test_toxicity_of_odd_rows(spark):
    docs, labels = labelled(spark)
    out = score_toxicity(docs, "text", train_toxicity(docs, labels, "doc_id", "text", "toxic"))
    rows = out.collect()
    assert len(rows) == 125 and out.columns == ["doc_id", "text", "label", "copy", "score"]
    for r in rows:
        assert 0 <= r["score"] <= 1
        if r["text"]:
            assert (r["score"] >= 0.5) == ("vile" in r["text"]), r
    empty = [r["score"] for r in rows if not r["text"]]
    assert len(empty) == 2 and empty[0] == empty[1]
    assert score_toxicity(docs.limit(0), "text", bytes(4 * (1 + (1 << 18)))).collect() == []


@pytest.mark.parametrize("kept, low, high", [("toxic = 1", 0.99, 1), ("toxic = 0", 0, 0.01), ("false", 0, 0.01)])
def test_toxicity_without_both_labels(spark, kept, low, high):
    docs, labels = labelled(spark)
    model = train_toxicity(docs, labels.where(kept), "doc_id", "text", "toxic")
    scores = {r["score"] for r in score_toxicity(docs, "text", model).collect()}
    assert len(scores) == 1 and low <= scores.pop() <= high


def test_quality_of_odd_rows(spark):
    docs, labels = labelled(spark)
    grades = labels.select("doc_id", (2 * (1 - F.col("toxic"))).alias("grade"))
    model = train_quality(docs, grades, "doc_id", "text", "grade", 2)
    out = grade_quality(docs.withColumn("kept", F.lit(None)), "text", model, 2, at_least=1)
    for r in out.collect():
        assert 0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2
        if r["text"]:
            assert r["kept"] == ("vile" not in r["text"])
    none = train_quality(docs, grades.where("false"), "doc_id", "text", "grade", 2)
    assert all(r["kept"] for r in grade_quality(docs, "text", none, 2, at_least=1).collect())
    junk = train_quality(docs, grades.where("grade = 0"), "doc_id", "text", "grade", 2)
    assert not any(r["kept"] for r in grade_quality(docs, "text", junk, 2, at_least=1).collect())


def test_the_sample_is_bounded_and_the_same_each_time(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('t', id) AS text").repartition(7)
    labels = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 3 = 0 AS INT) AS toxic")
    taken = [sorted(map(tuple, labelled_sample(docs, labels, "doc_id", "toxic", [0, 1], 50).collect())) for _ in range(2)]
    assert taken[0] == taken[1] and len(taken[0]) == 100


def test_held_out_toxicity(spark):
    scored = QUERIES["op2_toxicity"](spark, MID)
    rows = scored.collect()
    assert len(rows) == spark.read.parquet(f"{MID}/documents.parquet").count()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5)
    toxic, clean = [p for p, y in held if y], [p for p, y in held if not y]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.02 * len(clean)


def test_held_out_quality(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op4_quality_classifier"](spark, MID).collect() if r["held_out"] and r["doc_id"] in labels]
    good, junk = [r["kept"] for r in rows if labels[r["doc_id"]]], [r["kept"] for r in rows if not labels[r["doc_id"]]]
    assert sum(good) >= 0.98 * len(good) and sum(junk) <= 0.05 * len(junk)


def test_every_sampled_row_teaches_however_long_its_text(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(3000)), i % 2) for i in range(40)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(0, "again"), (0, "again")], "id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "id long, y int")
    told = {}
    train_toxicity(docs, labels, "id", "text", "y", rows=15, told=told)
    assert told == {"rows": 30}
    train_quality(docs, labels, "id", "text", "y", 1, rows=100, told=told)
    assert told == {"rows": 40}
    fit_in_one_task(docs.limit(0).selectExpr("text", "1 AS y"), "text", "y", quality_features, lambda x, y: b"", told)
    assert told == {"rows": 0}


def test_products_in_blocks_are_those_of_the_whole(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(50, rng.integers(1, 20), replace=False)) for _ in range(30)]
    rows = Rows.of([(s.astype(np.uint32), rng.random(len(s)).astype(np.float32)) for s in sets], 50)
    dense, weights, each = np.zeros((30, 50)), rng.random(50), rng.random(30)
    for i, (a, s) in enumerate(zip(rows.starts, sets)):
        dense[i, s] = rows.values[a : a + len(s)]
    for size in (1, 7, 1 << 22):
        monkeypatch.setattr("terrace.llm.hashing.AT_ONCE", size)
        assert np.allclose(rows.times(weights), dense @ weights)
        assert np.allclose(rows.transposed_times(each), each @ dense)
        assert np.allclose(rows.counts(each), each @ (dense > 0))


def test_scores_are_those_of_plain_python(spark):
    """Ratios, scores, thresholds and tail probabilities again from the model, n-gram by n-gram."""
    import math

    from terrace.llm.quality import GRAMS as QUALITY
    from terrace.llm.toxicity import GRAMS as TOXIC

    def bucket(grams, chunk, n):
        rolling = 0
        for c in chunk:
            rolling = (rolling * 0x01000193 + c) % 2**32
        x = (rolling + n) * 0x9E3779B1 % 2**32
        x = (x ^ x >> 15) * 0x85EBCA77 % 2**32
        return x >> (32 - grams.bits)

    def met(grams, text):
        codes = [32 if 9 <= c <= 13 else c + 32 if grams.fold_case and 65 <= c <= 90 else c for c in b" " + text.encode() + b" "]
        found = {}
        for n in grams.sizes:
            for i in range(len(codes) - n + 1):
                b = bucket(grams, codes[i : i + n], n)
                found[b] = found.get(b, 0) + 1
        return found

    texts = [f"{'awful hateful' if i % 2 else 'nice kind'} words number {i} é" for i in range(40)] + ["", "Nice\tKIND"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "id long, y int")
    known = np.frombuffer(model := train_toxicity(docs, labels, "id", "text", "y"), "<f4").tolist()
    got = {r["id"]: r["score"] for r in score_toxicity(docs, "text", model).collect()}
    for i, text in enumerate(texts):
        counts = met(TOXIC, text)
        margin = known[0] + sum(known[1 + b] * math.sqrt(c / sum(counts.values())) for b, c in counts.items())
        assert math.isclose(got[i], 1 / (1 + math.exp(-margin)), abs_tol=1e-5)
    known = np.frombuffer(model := train_quality(docs, labels, "id", "text", "y", 1), "<f4").tolist()
    for r in grade_quality(docs, "text", model, 1, at_least=1).collect():
        grams, plain = met(QUALITY, texts[r["id"]]), [b for b in quality_features(texts[r["id"]])[0].tolist() if b >= 1 << QUALITY.bits]
        weight = sum(known[1 + b] for b in grams) / math.sqrt(len(grams)) + sum(known[1 + b] for b in plain)
        above = 1 / (1 + math.exp(known[0] - weight))
        assert math.isclose(r["tail_probability"], above, abs_tol=1e-5) and math.isclose(r["expected_grade"], above, abs_tol=1e-5)
        assert r["kept"] == (r["tail_probability"] >= 0.5)
