"""Periodic runs of words in texts, by Lyndon roots.

A run of period q has a root, a stretch of q words that is a Lyndon word under the order of words or under its
reverse, and is the longest one that begins where it does. The first phase of Baier's suffix sorter finds these longest
Lyndon words without sorting a suffix: it groups suffixes by them, highest group first. Equal roots that follow one
another stand in one group side by side; from there the run is extended both ways by common extensions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from terrace.functions import column

WORD = re.compile("[^\x20\x09-\x0d]+")
CUTS = 12

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUNS = ArrayType(StructType([StructField(n, LongType()) for n in ("start", "length", "period")]))


def repeated_roots(s: Sequence[int], symbols: int) -> list[tuple[int, int, int]]:
    """Where a longest Lyndon word is followed by itself: start, its length, and how many of it there are.

    ``s`` has numbers below ``symbols``, in their order. Every place begins as a group member by its symbol, in a list
    of places that wait. The highest group's places leave the list: what lies between one of them and the next place
    of the list is its longest Lyndon word. Those in a row that follow a lower place lengthen that one's word, which
    goes to a new group just above its old one, by how many they are.
    """
    n = len(s)
    after, before = list(range(1, n + 2)), list(range(-1, n + 1))  # places 1 to n, between two that never leave
    group = [-1, *s, -1]
    members: list[list[int]] = [[] for _ in range(symbols)]
    for i, c in enumerate(s, 1):
        members[c].append(i)
    alive = [len(m) for m in members]
    below, above = list(range(-1, symbols - 1)), list(range(1, symbols + 1))
    found = []
    g = symbols - 1
    while g >= 0:
        longer: dict[int, list[int]] = {}
        for i in members[g]:
            if group[i] != g:
                continue
            j, e, times = before[i], after[i], 1
            size = e - i
            group[i] = -2
            while group[e] == g:
                group[e] = -2
                e = after[e]
                times += 1
            after[j], before[e] = e, j
            if times > 1:
                found.append((i - 1, size, times))
            if j:
                if times in longer:
                    longer[times].append(j)
                else:
                    longer[times] = [j]
        members[g] = []
        for times in sorted(longer, reverse=True) if len(longer) > 1 else longer:
            homes: dict[int, list[int]] = {}
            for j in longer[times]:
                if group[j] in homes:
                    homes[group[j]].append(j)
                else:
                    homes[group[j]] = [j]
            for home, moved in homes.items():
                if len(moved) == alive[home]:
                    continue  # the whole group moves, and so stays what and where it is
                alive[home] -= len(moved)
                new, next_ = len(members), above[home]
                members.append(moved)
                alive.append(len(moved))
                below.append(home)
                above.append(next_)
                above[home] = new
                if next_ < len(below):
                    below[next_] = new
                for j in moved:
                    group[j] = new
        # The top of the order is what a new group may not link above to; it has left by then.
        if (down := below[g]) >= 0:
            above[down] = 1 << 62
        g = down
    return found


def _forward(s: Sequence[int], a: int, b: int) -> int:
    """How far what begins at ``a`` and at ``b`` above it agrees; compared in stretches that grow, then shrink."""
    n, done, width = len(s), 0, 8
    while s[a + done : a + done + width] == s[b + done : b + done + width] and b + done + width <= n:
        done += width
        width *= 2
    while width:
        if b + done + width <= n and s[a + done : a + done + width] == s[b + done : b + done + width]:
            done += width
        width //= 2
    return done


def find_runs(s: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of each stretch with that period that cannot be extended and is at least
    ``least`` and ``times`` periods long, by start and period; ``times`` is 3 at least."""
    symbols = max(s) + 1 if s else 0
    mirrored = s[::-1]
    runs = set()
    for word in (s, [symbols - 1 - c for c in s]):
        for i, period, count in repeated_roots(word, symbols):
            back = _forward(mirrored, len(s) - i - period, len(s) - i) if i else 0
            ahead = _forward(s, i + (count - 1) * period, i + count * period)
            length = back + count * period + ahead
            if length >= max(least, times * period):
                runs.add((i - back, length, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _parts(codes: np.ndarray, least: int, times: int) -> Iterator[tuple[int, list[int]]]:
    """Parts that all runs lie within: a word that a part has less than ``times`` times is in no run, and cuts it.

    Parts of parts are cut again, up to ``CUTS`` times, as a text could be made to lose a word at a time.
    """
    waiting = [(0, codes, 0)]
    while waiting:
        start, part, cuts = waiting.pop()
        if len(part) < least:
            continue
        _, small, met = np.unique(part, return_inverse=True, return_counts=True)
        often = met[small] >= times
        if often.all() or cuts == CUTS:
            yield start, small.tolist()
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]]).view(np.int8)))
        pieces = zip(edges[::2].tolist(), edges[1::2].tolist())
        waiting += [(start + a, part[a:b], cuts + 1) for a, b in pieces if b - a >= least]


def runs_of_words(words: Sequence[str], least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """The runs of a list of words, by start and period (``find_runs``)."""
    known: dict[str, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    runs = []
    for start, part in _parts(codes, least, times):
        runs += [(start + i, length, period) for i, length, period in find_runs(part, least, times)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: Sequence[tuple[int, int, int]]) -> list[str]:
    """The words that no run has after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    covered = np.cumsum(steps)
    return [w for w, c in zip(words, covered.tolist()) if not c]


def collapse_runs(
    df: DataFrame, text: str, least: int = 24, times: int = 3, runs: str = "runs", kept: str = "collapsed"
) -> DataFrame:
    """``df`` with two more columns: the runs of each whole text, and the text without what repeats in them.

    Words are what stands between white space, numbered from 0, and equal if all their characters are. ``runs`` holds
    start, length and smallest period of each run, by start and period: a stretch of words that its period holds for,
    that no neighbouring word extends, of at least ``least`` words and ``times`` (3 or more) periods. ``kept`` is the
    text's words but those that some run has after its first period, with one space between. A null, empty or blank
    text has no runs and leaves an empty one. Each row is by itself: repeated rows come out alike, an empty table
    empty. A column of ``df`` with one of the new names is replaced; all others stay as they are.
    """
    if times < 3:
        raise ValueError("runs of less than three periods are not looked for")
    names = [n for n in df.columns if n.lower() not in (runs.lower(), kept.lower())]
    hidden = next(f"text{i}" for i in range(len(names) + 3) if f"text{i}" not in {n.lower() for n in (*names, runs, kept)})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, left = [], []
            for value in batch.column(batch.num_columns - 1):
                words = WORD.findall(value.as_py() or "")
                mine = runs_of_words(words, least, times)
                found.append([dict(zip(("start", "length", "period"), r)) for r in mine])
                left.append(" ".join(collapsed(words, mine)))
            columns = [*batch.columns[:-1], pa.array(found, pa.list_(_RUN)), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, runs, kept])

    given = df.select(*[column(n) for n in names], column(text).alias(hidden))
    fields = [df.schema[n] for n in names] + [StructField(runs, _RUNS), StructField(kept, StringType())]
    return given.mapInArrow(work, StructType(fields))
