"""Spelling variants against a comparison of all words with all."""

import random
import re
from collections import Counter

import pytest

from terrace.llm.query_spelling import lose_a_letter
from terrace.llm.spelling import count_words, near_words, signatures, spelling_variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio):
    out = {}
    for w, n in counts.items():
        others = sorted((-m, o) for o, m in counts.items() if near(w, o))
        form = others[0] if others and -others[0][0] >= ratio * n else None
        out[w] = [n, form[1] if form else None, -form[0] if form else None, len(others)]
    for w in out:
        root = w
        while out[root][1]:
            root = out[root][1]
        out[w].insert(3, root)
    return {w: tuple(v) for w, v in out.items()}


def vocabulary(seed, letters, sizes):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(60)}
    for w in list(words):
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]]) or c
            words.add(w)
    return {w: 10 ** rng.randint(0, 4) + rng.randint(0, 3) for w in words}


@pytest.mark.parametrize("letters, sizes", [("abcdefé", [7, 8, 9, 12]), ("ab", [1, 2, 3, 5, 6, 7]), ("abÿ🙂", [4, 6, 8])])
def test_variants_are_those_of_every_pair(spark, letters, sizes):
    counts = vocabulary(len(letters), letters, sizes)
    got = spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert got.columns == ["word", "n", "form", "form_n", "root", "n_near"]
    assert {r.word: tuple(r)[1:] for r in got.collect()} == brute(counts, 10)


def test_words_at_one_edit_share_a_signature():
    rng = random.Random(3)
    letters = "abcdeàé"
    dealt = {c: i % 5 for i, c in enumerate(letters[:4])}
    for _ in range(3000):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(1, 12)))
        i, c = rng.randrange(len(w)), rng.choice(letters)
        for other in (w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]):
            assert set(signatures(w, dealt)) & set(signatures(other, dealt))


def test_chains_of_forms_and_ties(spark):
    counts = {"lettersabc": 3, "lettersabd": 30, "lettersab": 300, "lettersa": 3000, "lettersax": 300, "lettersz": 3000}
    got = {r.word: r for r in spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert {w: r.root for w, r in got.items()} == {w: v[3] for w, v in brute(counts, 10).items()}
    assert got["lettersab"].form == "lettersa" and got["lettersabc"].root == "lettersa" and got["lettersa"].form is None


def test_counts_of_whole_texts(spark):
    rows = [
        (1, "Straßen straßen STRASSEN, abcdefgh-abcdefgh x×÷y×÷y a_longword1", "w"),
        (1, "Straßen straßen STRASSEN, abcdefgh-abcdefgh x×÷y×÷y a_longword1", None),
        (None, "abcdefgh ÀBCDEFG àbcdefg", "w"),
        (3, None, "w"),
        (4, "", "w"),
        (5, "q" * 100_000 + " " + "short " * 1000, "w"),
    ]
    df = spark.createDataFrame(rows, "id long, text string, word string")
    want = Counter()
    for _, text, _ in rows:
        low = (text or "").translate({i: i + 32 for i in range(65, 91)})
        want.update(w for w in re.findall("[A-Za-zÀ-ÿ]+", low) if len(w) >= 7)
    assert {r.word: r.n for r in count_words(df, "id", "text").collect()} == dict(want)
    changed = count_words(df, "id", "text", change=lambda key, word: f"{key}"[:1] + word[1:])
    assert {r.word for r in changed.collect()} >= {"Nbcdefgh", "1bcdefgh"}
    assert count_words(df.limit(0), "id", "text").count() == 0


def test_odd_words(spark):
    schema = "word string, n int, form string, other string"
    df = spark.createDataFrame([(None, 5, "x", "y"), ("", 1, "x", "y"), ("a", 10, "x", "y"), ("b" * 50_000, 2, "x", "y")], schema)
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling_variants(df).collect()}
    assert got == {"": ("a", "a", 1), "a": (None, "a", 1), "b" * 50_000: (None, "b" * 50_000, 0)}
    assert spelling_variants(df.limit(0)).count() == 0
    assert near_words(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="twice"):
        spelling_variants(df, ratio=1)


def test_letters_are_lost_by_the_key():
    from zlib import crc32

    lost = [(k, w) for k in range(400) for w in ("spelling", "résumés") if lose_a_letter(str(k), w) != w]
    assert lost and all(crc32(f"{k}:{w}".encode()) % 31 == 0 and len(lose_a_letter(str(k), w)) == len(w) - 1 for k, w in lost)
    assert len(lose_a_letter(None, "spelling")) in (7, 8)
