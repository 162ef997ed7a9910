"""Near duplicates by samples and sketches, against all pairs of sets."""

import glob
import random

import numpy as np
import pytest
from brute import components, shingles
from pyspark.sql import functions as F

from terrace.llm import odd_sketches
from terrace.llm.odd_sketches import BANDS, BITS, ROWS, SAMPLES, bands, most_bits, near_duplicates, samples, sketches


def found(spark, rows, n, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"node": F.lit(1), "key": F.lit("x"), "kept": F.lit(2)})
    return sorted((tuple(r) for r in near_duplicates(df.repartition(5), "doc_id", "text", n, percent).collect()), key=str)


def wanted(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    roots = components(sets, percent)
    smallest = {}
    for (key, _), root in zip(rows, roots):
        if key is not None:
            smallest[root] = min(smallest.get(root, key), key)
    ids = [smallest.get(r) if s else k for (k, _), s, r in zip(rows, sets, roots)]
    return sorted(((k, len(s), c, k == c) for (k, _), s, c in zip(rows, sets, ids)), key=str)


def copies(seed, families, members, words):
    """Families of texts with words changed, and texts between two families, among texts that share passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    texts, bases = [], [[word() for _ in range(words)] for _ in range(families)]
    bases.append(bases[0][words // 4 :] + [word() for _ in range(words // 4)])
    for base in bases:
        for _ in range(members):
            changed = list(base)
            for _ in range(rng.randint(0, 6)):
                changed[rng.randrange(len(base))] = word()
            texts.append(" ".join(changed))
        texts += [" ".join(base)] * 5
    passage = " ".join(word() for _ in range(60))
    texts += [f"{passage} " + " ".join(word() for _ in range(rng.randint(3, 80))) for _ in range(members)]
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, n, percent", [(1, 4, 80), (2, 5, 80), (3, 3, 90)])
def test_groups_of_copies(spark, seed, n, percent):
    rows = copies(seed, 3, 40, 90)
    assert found(spark, rows, n, percent) == wanted(rows, n, percent)


def test_a_chain_is_one_component(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(50 - i, " ".join([*(f"x{j}" for j in range(15 * i)), *base[15 * i :]])) for i in range(12)]
    got = found(spark, rows, 4, 80)
    assert got == wanted(rows, 4, 80) and len({c for _, _, c, _ in got}) == 1


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(1, None), (2, ""), (2, " \n"), (3, "a b"), (3, "A b"), (None, "a\tb"), (None, None), (None, "alone"), (4, "a b c"), (6, long), (5, long + " z")]
    assert found(spark, rows, 4, 80) == wanted(rows, 4, 80)
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert near_duplicates(empty, "doc_id", "text").columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert near_duplicates(empty, "doc_id", "text").count() == 0
    assert found(spark, [(1, None)], 4, 80) == [(1, 0, 1, True)]
    with pytest.raises(ValueError, match="80"):
        near_duplicates(empty, "doc_id", "text", percent=70)


def test_a_task_that_forgets_sets_loses_none(spark, monkeypatch):
    monkeypatch.setattr(odd_sketches, "REMEMBERED", 2)
    monkeypatch.setattr(odd_sketches, "AT_ONCE", 50)
    rows = copies(7, 2, 15, 40)
    assert found(spark, rows, 4, 80) == wanted(rows, 4, 80)


@pytest.mark.parametrize("members", [100, 200])
def test_an_outlier_meets_each_copy_once(spark, monkeypatch, tmp_path, members):
    """Copies with small changes, and a text that has three quarters of their words: no pair within the copies."""
    monkeypatch.setattr(odd_sketches, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    rng = random.Random(members)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(members):
        changed = list(base)
        changed[rng.randrange(300)] = f"y{i}"
        texts.append(" ".join(changed))
    texts.append(" ".join(base[:230] + [f"z{i}" for i in range(70)]))
    rows = list(enumerate(texts))
    assert found(spark, rows, 4, 80) == wanted(rows, 4, 80)
    tables = glob.glob(f"{tmp_path}/near-duplicates/*-pairs") + glob.glob(f"{tmp_path}/near-duplicates/*-meeting")
    assert tables and sum(spark.read.parquet(t).count() for t in tables) < BANDS * members


def test_samples_agree_as_often_as_sets_are_alike():
    rng = np.random.Generator(np.random.PCG64(1))
    for share in (0.5, 0.8, 0.95):
        agree, differ = [], []
        for _ in range(40):
            own, common = rng.integers(0, 1 << 56, (2, 400), np.uint64), rng.integers(0, 1 << 56, 400, np.uint64)
            k = round(400 * share)
            rest = (400 - k) // 2
            sets = [np.unique(np.concatenate([common[:k], own[0][:rest]])), np.unique(np.concatenate([common[:k], own[1][:rest]]))]
            least = samples(sets, SAMPLES)
            agree.append((least[0] == least[1]).mean())
            x, y = np.unpackbits(sketches(least).view(np.uint8), axis=1)
            differ.append(int((x != y).sum()))
        assert abs(np.mean(agree) - share) < 0.02
        flips = 2 * SAMPLES * (1 - share)
        assert abs(np.mean(differ) - BITS / 2 * (1 - (1 - 2 / BITS) ** flips)) < BITS / 100
        assert share < 0.8 or max(differ) <= most_bits(80)
    assert np.array_equal(least[1], samples(sets[1:], SAMPLES)[0]) and bands(samples(sets, BANDS * ROWS)).shape == (2, BANDS)


def test_the_bound_on_bits_is_the_tail_of_its_distribution():
    assert most_bits(100) == 0 and most_bits(90) < most_bits(80)
    rng = np.random.Generator(np.random.PCG64(2))
    differ = []
    for _ in range(4000):
        flips = rng.integers(0, BITS, 2 * rng.binomial(SAMPLES, 0.2))
        differ.append(int((np.bincount(flips, minlength=BITS) & 1).sum()))
    assert max(differ) <= most_bits(80) <= np.mean(differ) + 8 * np.std(differ)
