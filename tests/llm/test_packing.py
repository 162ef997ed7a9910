import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from terrace.llm.packing import fullest, minimum_bin_slack, places
from terrace.llm.query_packing import packed
from terrace.llm.tokens import Ids
from tokenizers import Tokenizer

from terrace.llm.queries import QUERIES

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def ids():
    return Ids(PATH)


def test_ids_are_those_of_the_tokenizer(ids):
    whole = Tokenizer.from_file(PATH)
    plain = [chr(i) for i in range(0x250)] + ["‐", "—", "’", "…", " ", " ", "€", "中", "😀", "́"]
    texts = ["", "a<|endoftext|>b", "I'll say it's  two\n\n spaces \t", "<|im_end|>", "x" * 5000, " " * 3000]
    texts += [t for c in plain for t in (c, f"a{c}b", f" {c}{c} ", f"1{c} {c}2")]
    for text in texts:
        assert ids.of(text) == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("run", ["\n" * 2_000_000, " " * 2_000_000, "\n \t" * 700_000, " " * 100_000, " " * 99_999])
def test_ids_of_very_long_white_space(ids, run):
    whole = Tokenizer.from_file(PATH)
    for text in (f"some words{run}and more", run):
        assert ids.of(text) == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_fullest_is_the_fullest(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1)}
    chosen = fullest(counts, room)
    assert sum(chosen) == max(s for s in sums if s <= room)
    assert all(n <= counts[length] for length, n in Counter(chosen).items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 200), max_size=20))
def test_patterns_use_every_piece_once(histogram):
    patterns = minimum_bin_slack(histogram, 50)
    used = Counter()
    for p in patterns:
        assert 0 < sum(p.lengths) <= 50
        for length in p.lengths:
            used[length] += p.sequences
    assert used == Counter(histogram)
    for length, rows in places(patterns).items():
        assert (np.diff(rows[:, 0]) > 0).all() and rows[0, 0] == 0


def test_lengths_that_do_not_fit_are_refused():
    with pytest.raises(ValueError):
        minimum_bin_slack({11: 1}, 10)


def checked(rows, texts):
    """Every piece is where it says, with its ids; sequences have neither gaps nor overlaps. How many there are."""
    whole = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = Counter()
    for key, text in texts:
        found = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(found) % 1024 or 1024
        at = [0, *range(first, len(found) + 1, 1024)]
        want.update(
            (key, i, a, b - a, zlib.crc32(np.array(found[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(at, at[1:]))
        )
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 1024
    return len(sequences)


def test_query(spark, small):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = QUERIES["op7_best_fit_packing"](spark, small).collect()
    assert checked(rows, texts) <= 1.01 * sum(r["length"] for r in rows) / 1024 + 1


def test_odd_rows(spark):
    texts = [(1, None), (1, None), (2, ""), (3, "word " * 30000), (None, "no key"), (4, "<|endoftext|>"), (5, "日本語 text")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS rank", "2 AS length", "3 AS part")
    checked(packed(spark, docs).collect(), texts)
    assert packed(spark, docs.limit(0)).collect() == []
