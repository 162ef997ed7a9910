"""Statistics of texts that tell sound ones from others, as Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import unused_name
from terrace.llm.words import split_words

SPACES = r"\x20\x09-\x0D"
WINDOW = 3
#: A window's hash gives way to its place in so many low bits, which is room for two million words; a longer text
#: gets as many more as it needs. What is left of the hash only finds candidates, whose words are then compared.
PLACE_BITS = 21


def _count(text: Column, characters: str) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{characters}]+", ""))


def _window_hashes(words: Column, bits: Column) -> Column:
    """A long for each window of three words: its hash, with its place in the low bits."""
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW, F.lit(0)))
    word = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    return F.when(
        F.size(words) >= WINDOW,
        F.transform(places, lambda i: F.call_function("shiftleft", word(i), bits).bitwiseOR(i.cast("long"))),
    )


def _with_equal_neighbour(sorted_: Column, bare: Callable[[Column], Column]) -> Column:
    """The values of a sorted array whose ``bare`` part one beside them has too."""
    at = lambda i: bare(F.get(sorted_, i))
    return F.filter(sorted_, lambda _, i: F.coalesce(at(i) == at(i - 1), F.lit(False)) | F.coalesce(at(i) == at(i + 1), F.lit(False)))


def _candidates(hashes: Column, bits: Column, words: Column) -> Column:
    """The windows with an equal neighbour among the sorted hashes, as sorted words (joined by a space, which no word
    has) and places."""
    low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    equal = _with_equal_neighbour(hashes, lambda v: F.call_function("shiftright", v, bits))
    place = lambda v: v.bitwiseAND(low).cast("int")
    said = lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(WINDOW)])
    return F.sort_array(F.transform(equal, lambda v: F.struct(said(place(v)).alias("said"), place(v).alias("place"))))


def _met_twice(candidates: Column) -> Column:
    """The places, in order, of windows whose words are met twice or more."""
    return F.sort_array(F.transform(_with_equal_neighbour(candidates, lambda v: v["said"]), lambda v: v["place"]))


def _covered(places: Column) -> Column:
    """Words in the windows at these places."""
    step = F.transform(places, lambda v, i: F.least(F.coalesce(F.get(places, i + 1) - v, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.coalesce(F.aggregate(step, F.lit(0).cast("long"), lambda total, x: total + x), F.lit(0).cast("long"))


def text_statistics(df: DataFrame, text: str) -> DataFrame:
    """Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and ``n_capitals``.

    Words stand between white space. ``word_chars`` counts their code points; ``n_symbols`` the characters of
    ``#*$%&|<>``; ``n_dup_lines`` the lines with a word that equal an earlier one; ``n_repeat_words`` the words in
    windows of three that the text has twice or more, first ones included; ``n_capitals`` the letters A-Z. Whole
    texts count; a null text has none of these. Columns of the six names are replaced.

    Windows are sorted as plain longs within their row, and by their words those that may be equal, so that no word
    is shuffled and the work per text is that of sorting it.
    """
    df = df.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals")
    said = F.coalesce(F.col(text), F.lit(""))
    words, lines, bits, hashes, alike, places = (
        unused_name(df, f"_{n}") for n in ("words", "lines", "bits", "hashes", "alike", "places")
    )
    sound = F.filter(F.split(said, "\n"), lambda x: F.translate(x, " \t\n\x0b\x0c\r", "") != "")
    split = df.withColumns({words: split_words(said, SPACES), lines: sound})
    counted = split.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.char_length(F.translate(said, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": _count(said, "#*$%&|<>").cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_capitals": _count(said, "A-Z").cast("long"),
            bits: F.greatest(F.lit(PLACE_BITS), F.ceil(F.log2(F.size(words) + 1.0)).cast("int")),
        }
    )
    hashed = counted.withColumn(hashes, F.sort_array(_window_hashes(F.col(words), F.col(bits)))).drop(lines)
    found = hashed.withColumn(alike, _candidates(F.col(hashes), F.col(bits), F.col(words))).drop(words, hashes, bits)
    placed = found.withColumn(places, _met_twice(F.col(alike))).drop(alike)
    return placed.withColumn("n_repeat_words", _covered(F.col(places))).drop(places)
