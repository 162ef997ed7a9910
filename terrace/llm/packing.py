"""Packing pieces into sequences by minimum bin slack, over the histogram of their lengths."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, each as often as there are some, whose sum is the largest of at most ``room``.

    A bitset says which sums the lengths so far can make; a length that comes several times enters as one, two,
    four .. of it. Going back from the largest sum takes the longest lengths first.
    """
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted(counts):
        left = min(counts[length], room // length)
        times = 1
        while left > 0:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & mask
            left -= times
            times *= 2
    total, chosen = reach.bit_length() - 1, []
    for length, times, before in reversed(steps):
        size = length * times
        if size <= total and before >> (total - size) & 1:
            chosen += [length] * times
            total -= size
    return chosen


@dataclass(frozen=True)
class Pattern:
    """Sequences with the same lengths: how many, and the lengths in their order."""

    sequences: int
    lengths: tuple[int, ...]


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use up a histogram of lengths from 1 to ``capacity``.

    Each time the longest length left is taken, with the fullest combination of others that fits beside it; what
    is found is removed, as often as the lengths allow, so that the work depends on the number of different
    lengths and not on that of the pieces.
    """
    left = {length: n for length, n in histogram.items() if n > 0}
    if left and not 0 < min(left) <= max(left) <= capacity:
        raise ValueError(f"lengths from {min(left)} to {max(left)} for sequences of {capacity}")
    patterns = []
    while left:
        longest = max(left)
        others = dict(left)
        others[longest] -= 1
        lengths = [longest, *fullest({k: n for k, n in others.items() if n}, capacity - longest)]
        each = {k: lengths.count(k) for k in set(lengths)}
        times = min(left[k] // n for k, n in each.items())
        patterns.append(Pattern(times, tuple(sorted(lengths, reverse=True))))
        for k, n in each.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
    return patterns


def places(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """By length: rows of first number, pieces per sequence, first sequence, and offset of its first piece.

    The pieces of a length, numbered from 0, go to the patterns in order; a row holds from its first number to
    the next row's.
    """
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    met: dict[int, int] = {}
    sequence = 0
    for p in patterns:
        offset = 0
        for length in sorted(set(p.lengths), reverse=True):
            n = p.lengths.count(length)
            rows.setdefault(length, []).append((met.get(length, 0), n, sequence, offset))
            met[length] = met.get(length, 0) + n * p.sequences
            offset += n * length
        sequence += p.sequences
    return {length: np.array(found, np.int64) for length, found in rows.items()}


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to written pieces (see ``token_pieces``).

    The histogram, at most ``capacity`` rows, is all that the driver sees. Counts by part and length give every
    piece its number among those of its length without sorting or gathering them, whatever share of all pieces
    one length has. Pieces must be read from a table, as their numbers come from the tasks that wrote them. Other
    columns stay; no pieces give no rows.
    """
    counts = pieces.groupBy("part", "length").count()
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    found = places(minimum_bin_slack(totals, capacity))
    before = F.expr("sum(count) OVER (PARTITION BY length ORDER BY part) - count")
    firsts = counts.select("part", "length", before.alias("before"))
    numbered = pieces.join(firsts, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    rows = numbered.select(*[c for c in pieces.columns if c not in ("part", "rank")], F.col("length").alias("l"), "rank")
    out = rows.drop("l", "rank").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, lengths, ranks = batch.columns
            lengths, ranks = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                mine = lengths == length
                rows = found[int(length)]
                first, n, start, at = rows[np.searchsorted(rows[:, 0], ranks[mine], "right") - 1].T
                nth = ranks[mine] - first
                sequence[mine] = start + nth // n
                offset[mine] = at + nth % n * length
            yield pa.RecordBatch.from_arrays([*others, pa.array(sequence), pa.array(offset)], names=out.names)

    return rows.mapInArrow(place, out)
