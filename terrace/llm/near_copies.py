"""Texts whose sets of word n-grams are alike: a vertically partitioned Jaccard join.

The order of all n-grams is cut into fragments, and every set into the segments that lie in them. A fragment's task
sees all sets that have one of its n-grams, and so knows how rare each is; n-grams of one set alone go no further.
Rarity orders a set's prefix, which any similar set must share an n-gram with. Pairs that do so are verified by
counting the overlap of their segments fragment by fragment, and summing the counts per pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.components import connected_components
from terrace.llm.shingles import BITS, pack, set_hash, shingle_set, unpack
from terrace.scratch import scratch_path

#: N-grams that a task gathers before it sends them to the fragments; what it then holds for them is some 50 MB.
GATHERED = 1 << 20
#: Bytes of text for a fragment of the order, some three million n-grams, however large the corpus: a task that counts
#: one holds some 100 MB. A task has several fragments, one after another.
FRAGMENT_BYTES = 16 << 20
FRAGMENTS_A_TASK = 4
#: Segments whose overlaps are counted separately.
SEGMENTS = 8

_SENT = "part string, fragment int, sets binary, sizes binary, grams binary, owners binary, counts binary"
_SENT_NAMES = [c.split()[0] for c in _SENT.split(", ")]
_SENT_TYPES = [pa.string(), pa.int32(), *[pa.binary()] * 5]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SENT_TYPES)], names=_SENT_NAMES)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _to_fragments(docs: DataFrame, text: str, n: int, bits: int) -> DataFrame:
    """Rows of a part, about a million n-grams of one task: for each fragment its n-grams and whose they are.

    A part sends a set once, however many copies it has. Which sets it has is told in a row of its own, whose fragment
    is negative: what is sent to the fragments are n-grams alone. A part's name is made of the task's place and a number, so that
    a task that runs again, over the same rows, sends the same.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        count, done, task = 0, 0, TaskContext.get().partitionId()

        def part() -> pa.RecordBatch:
            name = f"{task}-{done}"
            sets, grams = np.array(list(held), np.int64), list(held.values())
            sizes = np.array([len(g) for g in grams], np.int64)
            all_grams, owners = np.concatenate(grams), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(all_grams, kind="stable")
            all_grams, owners = all_grams[order].view(np.int64), owners[order]
            cuts = np.searchsorted(all_grams >> (BITS - bits), np.arange((1 << bits) + 1))
            known = (name, -1 - zlib.crc32(name.encode()) % (1 << bits), sets.tobytes(), pack(sizes), None, None, None)
            return _batch(
                [known]
                + [
                    (name, f, None, None, pack(all_grams[a:b]), pack(owners[a:b]), None)
                    for f, (a, b) in enumerate(zip(cuts, cuts[1:]))
                    if b > a
                ]
            )

        for batch in batches:
            for value in batch.column(0):
                grams = shingle_set(value.as_py(), n)
                if not len(grams):
                    continue
                if (key := set_hash(grams)) not in held:
                    held[key] = grams
                    count += len(grams)
                if count >= GATHERED:
                    yield part()
                    held, count, done = {}, 0, done + 1
        if held:
            yield part()

    return docs.select(text).mapInArrow(send, _SENT)


def _counted(sent: DataFrame, tasks: int) -> DataFrame:
    """Each fragment's rows again, with only the n-grams that two sets or more have, and how many have them.

    A fragment's rows wait, compressed, until its n-grams are counted. An n-gram that very many sets have takes next
    to nothing in them, as its place and its owners run on evenly.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fragment, rows in groupby(_rows(batches), key=itemgetter(1)):
            if fragment < 0:  # which sets parts have
                yield from (_batch([row]) for row in rows)
                continue
            waiting, found, times = [], [], []
            for row in rows:
                grams, met = np.unique(unpack(row[4]), return_counts=True)
                waiting.append(row)
                found.append(grams)
                times.append(met)
            grams = np.concatenate(found)
            order = np.argsort(grams, kind="stable")
            grams = grams[order]
            first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
            met = np.add.reduceat(np.concatenate(times)[order], first)
            shared, met = grams[first][met > 1], met[met > 1]
            if not len(shared):
                continue
            for part, _, _, _, packed, owners, _ in waiting:
                grams = unpack(packed)
                at = np.minimum(np.searchsorted(shared, grams), len(shared) - 1)
                kept = shared[at] == grams
                if kept.any():
                    row = (part, fragment, None, None, pack(grams[kept]), pack(unpack(owners)[kept]), pack(met[at][kept]))
                    yield _batch([row])

    return sent.repartition(tasks, "fragment").sortWithinPartitions("fragment").mapInArrow(count, _SENT)


def _active(counted: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Sets that can be similar to another one: their size, the shared n-grams of their prefix with their places in
    the order of rarity, and all shared n-grams by segment."""
    schema = "node long, size int, prefix array<struct<gram: long, place: int>>, segments array<array<long>>"
    places = pa.list_(pa.struct([("gram", pa.int64()), ("place", pa.int32())]))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=itemgetter(0)):
            grams, owners, met = [], [], []
            for _, fragment, known, long, packed, whose, times in rows:
                if fragment < 0:
                    sets, sizes = np.frombuffer(known, np.int64), unpack(long)
                    continue
                grams.append(unpack(packed))
                owners.append(unpack(whose))
                met.append(unpack(times))
            if not grams:
                continue
            grams, owners, met = (np.concatenate(x) for x in (grams, owners, met))
            order = np.lexsort((grams, met, owners))
            grams, owners = grams[order], owners[order]
            starts = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
            out: list[tuple] = []
            for a, b in zip(starts, [*starts[1:], len(owners)]):
                size = int(sizes[owners[a]])
                alone = size - int(b - a)
                prefix = size - -(-percent * size // 100) + 1
                if alone >= prefix:
                    continue
                mine = np.sort(grams[a:b])
                cuts = np.searchsorted(mine >> (BITS - 3), np.arange(SEGMENTS + 1))
                out.append(
                    (
                        int(sets[owners[a]]), size,
                        [{"gram": int(g), "place": alone + i} for i, g in enumerate(grams[a : min(b, a + prefix - alone)])],
                        [mine[i:j].tolist() for i, j in zip(cuts, cuts[1:])],
                    )
                )
            for i in range(0, len(out), 500):
                types = [pa.int64(), pa.int32(), places, pa.list_(pa.list_(pa.int64()))]
                columns = [pa.array(c, t) for c, t in zip(zip(*out[i : i + 500]), types)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "prefix", "segments"])

    whole = counted.repartition(tasks, "part").sortWithinPartitions("part")
    return whole.mapInArrow(gather, schema).dropDuplicates(["node"])


def _may_link(percent: int) -> Column:
    """Bounds on a pair that shares an n-gram: of the sizes, and of what can follow the n-gram in both orders."""
    sizes = 100 * F.least("size", "other_size") >= percent * F.greatest("size", "other_size")
    rest = F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    return sizes & ((100 + percent) * rest >= percent * (F.col("size") + F.col("other_size")))


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    chosen = met.where((F.col("node") != F.col("other")) & _may_link(percent))
    return chosen.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _verified(pairs: DataFrame, active: DataFrame, percent: int) -> DataFrame:
    """Pairs whose overlap, counted by segment and summed, makes them links."""
    segments = active.select("node", "size", F.posexplode("segments").alias("segment", "grams"))
    a = segments.select(F.col("node").alias("a"), F.col("size").alias("size_a"), "segment", F.col("grams").alias("grams_a"))
    b = segments.select(F.col("node").alias("b"), F.col("size").alias("size_b"), "segment", F.col("grams").alias("grams_b"))
    counted = pairs.join(a, "a").join(b, ["b", "segment"])
    overlap = F.size(F.array_intersect("grams_a", "grams_b"))
    whole = counted.groupBy("a", "b").agg(
        F.sum(overlap).alias("overlap"), (F.first("size_a") + F.first("size_b")).alias("sizes")
    )
    return whole.where((100 + percent) * F.col("overlap") >= percent * F.col("sizes")).select("a", "b")


def _across(labelled: DataFrame, write) -> DataFrame:
    """Sets of different components that share an n-gram, by n-gram.

    An n-gram's component of most sets is met by the sets of the others, and never joined with itself: what a few
    outliers share with a large group makes as many rows as the group has sets, not as it has pairs.
    """
    sizes = labelled.groupBy("gram", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("gram").agg(F.max(F.struct("n", "component")).alias("largest"), F.count("*").alias("components"))
    open_ = largest.where("components > 1").select("gram", F.col("largest.component").alias("largest"))
    left = write(labelled.join(open_, "gram"), "open")
    others = left.select(
        "gram", F.col("node").alias("other"), F.col("size").alias("other_size"), F.col("place").alias("other_place"),
        F.col("component").alias("other_component"),
    )
    once = (F.col("other_component") == F.col("largest")) | (F.col("node") < F.col("other"))
    met = left.where(F.col("component") != F.col("largest")).join(others, "gram")
    return met.where((F.col("component") != F.col("other_component")) & once)


def near_copy_links(active: DataFrame, percent: int, write) -> DataFrame:
    """Components of the links among active sets (``node``, ``component``).

    First, each n-gram's sets are compared with one of them, that whose n-gram comes earliest in its order: what is
    alike in a large group mostly is like this one. What then still is in different components is compared pair by
    pair (``_across``), so that a component's sets are not paired with each other again, and no link is lost.
    """
    places = active.select("node", "size", F.inline("prefix")).select("gram", "node", "size", "place")
    firsts = (
        places.groupBy("gram")
        .agg(F.min(F.struct("place", "size", "node")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("gram", F.col("first.node").alias("other"), F.col("first.size").alias("other_size"), F.col("first.place").alias("other_place"))
    )
    starred = write(_verified(write(_pairs(places.join(firsts, "gram"), percent), "pairs"), active, percent), "starred")
    known = connected_components(starred, write)

    labelled = places.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    met = _across(write(labelled, "labelled"), write)
    pairs = _pairs(met, percent).join(write(starred, "known"), ["a", "b"], "left_anti")
    more = _verified(write(pairs, "pairs"), active, percent)
    return connected_components(starred.unionByName(more), write)


def near_copy_pairs(active: DataFrame, percent: int, write) -> DataFrame:
    """Every link among active sets, once (``a`` below ``b``): a large group is expanded into all its pairs."""
    places = active.select("node", "size", F.inline("prefix")).select("gram", "node", "size", "place")
    others = places.select(
        "gram", F.col("node").alias("other"), F.col("size").alias("other_size"), F.col("place").alias("other_place")
    )
    met = places.join(others, "gram").where(F.col("node") < F.col("other"))
    return _verified(write(_pairs(met, percent), "pairs"), active, percent)


def _links_of(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """``n_links`` of each node: rows of the sets linked to it, and the other rows of its own."""
    copies = sets.groupBy("node").agg(F.count("*").alias("copies"))
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(copies.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("linked"))
    linked = F.coalesce("linked", F.lit(0)) + F.col("copies") - 1
    return copies.join(others, "node", "left").select("node", linked.alias("n_links"))


def near_copies(df: DataFrame, key: str, text: str, n: int = 5, percent: int = 80, links: bool = False) -> DataFrame:
    """A row per row of ``df``: its key, ``n_shingles`` and ``component_id``; with ``links``, ``n_links`` too.

    Sets of distinct word n-grams (``shingle_set``) are linked where 100 times their intersection is at least
    ``percent`` times their union; ``component_id`` is the smallest key that links lead to, the row's own included.
    A text without words has an empty set and a component of its own. Repeated rows and copies are one set; null
    keys never are the smallest; other columns are left out. Every whole text counts. ``df`` must give the same
    rows when a task runs again, as a table does.

    ``n_links`` is the number of other rows whose sets are linked to the row's own directly, equal sets included, and
    0 without words. It takes every pair of similar sets, where components alone take a few for each set.

    N-grams are hashed to 56 bits and sets to 64; what a hash may join wrongly is a few in 10 to the 17 pairs.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, "near-copies")
    written = iter(range(1 << 30))

    def write(rows: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{next(written)}-{name}"
        rows.write.parquet(path)
        return spark.read.parquet(path)

    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = max(3, (size // FRAGMENT_BYTES).bit_length())
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (1 << bits) // FRAGMENTS_A_TASK)
    counted = write(_counted(_to_fragments(df, text, n, bits), tasks), "counted")
    active = write(_active(counted, percent, tasks), "active")
    found = near_copy_links(active, percent, write)

    kind = df.schema[key].dataType

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(v.as_py(), n) for v in batch.column(1)]
            nodes = [set_hash(s) if len(s) else None for s in sets]
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_shingles", "node"])

    keyed = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = write(keyed.mapInArrow(sized, f"key {kind.simpleString()}, n_shingles long, node long"), "sets")
    filled, empty = rows.where(F.col("node").isNotNull()), rows.where(F.col("node").isNull())
    own = filled.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = own.groupBy("component").agg(F.min("key").alias("component_id"))
    whole = own.join(write(smallest, "smallest"), "component", "left")  # from a table, so that a hot component can be split
    alone = empty.withColumn("component_id", F.col("key"))
    names = ["key", "n_shingles", "component_id"]
    if links:
        counts = write(_links_of(filled, write(near_copy_pairs(active, percent, write), "all-links")), "n-links")
        whole, alone = whole.join(counts, "node"), alone.withColumn("n_links", F.lit(0).cast("long"))
        names.append("n_links")
    both = whole.select(*names).unionByName(alone.select(*names))
    return both.withColumnRenamed("key", key)
