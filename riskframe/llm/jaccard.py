"""Jaccard self-join of word-shingle sets by vertical partitioning.

All shingles have one global order, rare before common, measured by a fixed-size table of counts over all documents.
A document's prefix, its rarest shingles, must meet that of every partner; documents meet at shared prefix shingles.
The global order is cut into fragments: for the pairs that met, each fragment counts the overlap of its part of both
sets on its own, and the partial counts are summed per pair and compared with the threshold.

Documents with equal sets are one node, named by a 64-bit hash of the set. Pairs come in rounds, so that a group of
near copies never yields all its pairs: a round takes only pairs that lie in different components of the links found
before. The first rounds take near neighbours within the groups of a prefix shingle, ordered by size; the last takes
all pairs that are left. Pairs inside a component cannot change it, so the components are those of all links.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, shuffle_parts, slices, tidy, written
from .components import connected_components, merged_components
from .shingles import mixed, shingle_sets

SLICE_BYTES = 1 << 20
#: Cells of the count table (4 bytes each) and the parts it is summed in.
CELLS, PARTS = 1 << 22, 16
#: Fragments of the global order, prefix entries a task holds before it sends them, partners of a node in one group.
FRAGMENTS, FLUSH, PARTNERS = 4, 1 << 20, 1024
_ENTRY = np.dtype([("h", "<i8"), ("node", "<i8"), ("n", "<i4"), ("at", "<i4")])
_ROWS = "h long, node long, n int, at int"
#: Shared prefix shingles that two sets must have (as many as they need to share at all, if that is less).
MEETINGS = 2
#: Neighbours taken per entry and round; none: all.
AHEAD = (4, 32, 256, None)


def node_of(shingles: np.ndarray) -> int:
    """Name of a set: order-free 64-bit hash of its members and size."""
    total = mixed(shingles, 7).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mixed(total.reshape(1), 11).view(np.int64)[0])


@dataclass(frozen=True)
class GlobalOrder:
    """Places of shingles in [0, 1): classes of rising frequency, each as wide as its share of all shingles."""

    class_of: np.ndarray
    start: np.ndarray
    width: np.ndarray

    @staticmethod
    def of(classes: np.ndarray, weight: np.ndarray) -> "GlobalOrder":
        """From the class of every cell and the shingles of every class."""
        weight = weight / max(weight.sum(), 1)
        return GlobalOrder(classes, np.cumsum(weight) - weight, weight)

    def places(self, shingles: np.ndarray) -> np.ndarray:
        c = self.class_of[(shingles & np.uint64(CELLS - 1)).astype(np.int64)]
        return self.start[c] + self.width[c] * (shingles.astype(np.float64) * 2.0**-64)


def frequency_classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four classes per doubling of a cell's count, and how many shingles each of 256 classes has."""
    classes = np.floor(4 * np.log2(np.maximum(counts, 1))).astype(np.uint8)
    weight = np.zeros(256, np.int64)
    np.add.at(weight, classes, counts)
    return classes, weight


def prefix_length(n: int, percent: int) -> int:
    """So many of the rarest shingles that partners share ``MEETINGS`` of them."""
    return min(n, n - -(-percent * n // 100) + MEETINGS)


def needed(n, m, percent: int):
    """Smallest overlap of sets of n and m members whose Jaccard similarity reaches the threshold."""
    return -(-(percent * (n + m)) // (100 + percent))


def may_link(n_a, at_a, n_b, at_b, percent: int):
    """Can sets with these sizes, that meet first or second at these places of their orders, still reach the threshold?"""
    low, high = np.minimum(n_a, n_b).astype(np.int64), np.maximum(n_a, n_b).astype(np.int64)
    return (100 * low >= percent * high) & (MEETINGS + np.minimum(n_a - at_a, n_b - at_b) - 1 >= needed(low, high, percent))


def _in_groups(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries by shingle, size and node, without repeated nodes, and where each shingle's group begins."""
    e = e[np.lexsort((e["node"], e["n"], e["h"]))]
    new = np.ones(len(e), bool)
    new[1:] = (e["h"][1:] != e["h"][:-1]) | (e["node"][1:] != e["node"][:-1])
    e = e[new]
    first = np.ones(len(e), bool)
    first[1:] = e["h"][1:] != e["h"][:-1]
    return e, np.flatnonzero(first)


def _batch_of(e: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(e[c])) for c in _ENTRY.names], list(_ENTRY.names))


def shingled(df: DataFrame, words: int) -> tuple[DataFrame, GlobalOrder]:
    """From (id, text): a table (id, n, node), node null without words, and the order of all shingles. The driver gets
    one byte a cell."""
    kind = df.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        id_type = None
        for part in slices(batches, "text", SLICE_BYTES):
            id_type = part.column("id").type
            sets = shingle_sets(part.column("text").to_pylist(), words)
            cells = np.concatenate(sets) & np.uint64(CELLS - 1)
            counts += np.bincount(cells.astype(np.int64), minlength=CELLS)
            n = pa.array([len(s) for s in sets], pa.int32())
            nodes = pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())
            none = pa.nulls(len(sets))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), n, nodes, none.cast(pa.int32()), none.cast(pa.binary())], ["id", "n", "node", "part", "counts"])
        if counts.any():
            blobs = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, PARTS)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(PARTS, id_type), pa.nulls(PARTS, pa.int32()), pa.nulls(PARTS, pa.int64()), pa.array(range(PARTS), pa.int32()),
                 pa.array(blobs, pa.binary())], ["id", "n", "node", "part", "counts"])

    def add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(CELLS // PARTS, np.int64), None
        for batch in tables:
            part = batch.column("part")[:1]
            for blob in batch.column("counts"):
                total += np.frombuffer(zlib.decompress(blob.as_py()), np.int64)
        classes, weight = frequency_classes(total)
        yield pa.RecordBatch.from_arrays(
            [part, pa.array([classes.tobytes()], pa.binary()), pa.array([weight.tolist()], pa.list_(pa.int64()))],
            ["part", "classes", "weight"])

    out = written(df.mapInArrow(tidy(read), f"id {kind}, n int, node long, part int, counts binary"), "shingled")
    sums = out.where("part IS NOT NULL").select("part", "counts").groupBy("part")
    classes, weight = np.zeros((PARTS, CELLS // PARTS), np.uint8), np.zeros(256, np.int64)
    for row in sums.applyInArrow(add, "part int, classes binary, weight array<long>").collect():
        classes[row["part"]] = np.frombuffer(row["classes"], np.uint8)
        weight += row["weight"]
    return out.where("part IS NULL").select("id", "n", "node"), GlobalOrder.of(classes.ravel(), weight)


def _meetings(df: DataFrame, order, words: int, percent: int) -> DataFrame:
    """Prefix entries of shingles that several nodes have.

    Shingles that meet within a task are known to be shared; one of their entries still goes to the bucket of the
    shingle, marked, so a shingle that many documents share reaches its bucket once per task and flush.
    """
    buckets = shuffle_parts(df.sparkSession)

    def sent(e: np.ndarray) -> Iterator[pa.RecordBatch]:
        e, starts = _in_groups(e)
        sizes = np.diff(np.append(starts, len(e)))
        inner = _batch_of(e[np.repeat(sizes > 1, sizes)])
        heads, met = e[starts], sizes > 1
        bucket = (mixed(heads["h"].view(np.uint64), 3) % np.uint64(buckets)).astype(np.int64) * 2 + met
        by = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[by], np.arange(2 * buckets + 1))
        heads = heads[by]
        used = [k for k in range(2 * buckets) if cuts[k] < cuts[k + 1]]
        blobs = [heads[cuts[k]:cuts[k + 1]].tobytes() for k in used]
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k // 2 for k in used], pa.int32()), pa.array([bool(k % 2) for k in used]), pa.array(blobs, pa.binary()),
             *[none.cast(t) for t in inner.schema.types]], ["bucket", "met", "entries", *inner.schema.names])
        if inner.num_rows:  # spread evenly: these are done
            spread = pa.array((np.arange(inner.num_rows) * buckets // inner.num_rows).astype(np.int32))
            none = pa.nulls(inner.num_rows)
            yield pa.RecordBatch.from_arrays([spread, none.cast(pa.bool_()), none.cast(pa.binary()), *inner.columns],
                                             ["bucket", "met", "entries", *inner.schema.names])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, held, n_held = order.value, [], 0
        for part in slices(batches, "text", SLICE_BYTES):
            for shingles in shingle_sets(part.column("text").to_pylist(), words):
                n = len(shingles)
                if not n:
                    continue
                first = np.argsort(places.places(shingles), kind="stable")[:prefix_length(n, percent)]
                e = np.empty(len(first), _ENTRY)
                e["h"], e["node"], e["n"], e["at"] = shingles[first].view(np.int64), node_of(shingles), n, np.arange(len(first))
                held.append(e)
                n_held += len(e)
            if n_held >= FLUSH:
                yield from sent(np.concatenate(held))
                held, n_held = [], 0
        if held:
            yield from sent(np.concatenate(held))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            done = batch.filter(pa.compute.is_null(batch.column("entries")))
            if done.num_rows:
                yield done.select(list(_ENTRY.names))
            todo = batch.filter(pa.compute.is_valid(batch.column("entries")))
            for bucket, met, blob in zip(*(todo.column(c).to_pylist() for c in ("bucket", "met", "entries"))):
                parts.setdefault(bucket, []).append((np.frombuffer(blob, _ENTRY), met))
        for bucket in list(parts):
            blocks = parts.pop(bucket)
            known = np.concatenate([e["h"] for e, met in blocks if met] or [np.empty(0, np.int64)])
            e, starts = _in_groups(np.concatenate([e for e, _ in blocks]))
            sizes = np.diff(np.append(starts, len(e)))
            shared = (sizes > 1) | np.isin(e["h"][starts], known)
            e = e[np.repeat(shared, sizes)]
            if len(e):
                yield _batch_of(e)

    sent_rows = df.mapInArrow(tidy(send), f"bucket int, met boolean, entries binary, {_ROWS}")
    return written(sent_rows.repartition(buckets, "bucket").mapInArrow(tidy(meet), _ROWS), "meetings")


def _candidates(entries: DataFrame, percent: int, most: int | None) -> DataFrame:
    """Pairs (x, y, p, q) in different components that share enough prefix entries and may link.

    ``entries`` has h, node, n, at, component; up to ``most`` entries ahead in a group's order by size are paired.
    """
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = pa.Table.from_batches(list(batches))
        h, node, n, at, component = (e.column(c).to_numpy() for c in ("h", "node", "n", "at", "component"))
        order = np.lexsort((node, n, h))
        starts = np.flatnonzero(np.append(True, np.diff(h[order]) != 0))
        of = component[order]
        mixed_groups = np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts)
        order = order[np.repeat(mixed_groups, np.diff(np.append(starts, len(h))))]  # groups in one component are done
        if not len(order):
            return
        h, node, n, at, component = (x[order] for x in (h, node, n, at, component))
        starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        end = np.repeat(np.append(starts[1:], len(h)), np.diff(np.append(starts, len(h))))
        a, ahead = np.arange(len(h)), 1
        while most is None or ahead <= most:  # every entry with the one ``ahead`` places after it, all groups at once
            a = a[a + ahead < end[a]]
            a = a[100 * n[a].astype(np.int64) >= percent * n[a + ahead].astype(np.int64)]  # later ones are larger still
            if not len(a):
                return
            b = a + ahead
            ok = (component[a] != component[b]) & may_link(n[a], at[a], n[b], at[b], percent)
            if ok.any():
                i, j = a[ok], b[ok]
                swap = node[i] > node[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (node[i], node[j], n[i], n[j])], ["x", "y", "p", "q"])
            ahead += 1

    buckets = 4 * shuffle_parts(entries.sparkSession)
    dealt = entries.groupBy(F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("bucket")).applyInArrow(pair, "x long, y long, p int, q int")
    met = dealt.groupBy("x", "y", "p", "q").agg(F.count("*").alias("met"))
    least = F.ceil(F.lit(percent) * (F.col("p").cast("long") + F.col("q")) / (100 + percent))
    return met.where(F.col("met") >= F.least(F.lit(MEETINGS), least)).select("x", "y", "p", "q")


def _verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, count: int, order, words: int, percent: int) -> DataFrame:
    """Those of the ``count`` pairs (x, y, p, q) whose similarity reaches the threshold, by partial overlaps per fragment: (a, b)."""
    groups = -(-2 * count // 4096)
    nth = F.floor((F.row_number().over(Window.partitionBy("x").orderBy("y")) - 1) / PARTNERS)
    placed = written(
        pairs.withColumn("group", F.pmod(F.xxhash64("x", nth), F.lit(groups)).cast("int")), "pairs")
    wanted = placed.select(F.explode(F.array("x", "y")).alias("node"), "group").groupBy("node").agg(F.collect_set("group").alias("groups"))
    wanted = written(wanted.join(reps, "node").select("id", "node", "groups"), "wanted")
    # a merge join whatever the size of ``wanted``: the plan for a small corpus is that for a large one
    of = docs.join(wanted.hint("merge"), "id").select("node", "groups", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            rows: list[tuple] = []
            sets = shingle_sets(part.column("text").to_pylist(), words)
            for node, groups, shingles in zip(part.column("node").to_pylist(), part.column("groups").to_pylist(), sets):
                if node_of(shingles) != node:  # another text under a repeated id
                    continue
                fragment = (order.value.places(shingles) * FRAGMENTS).astype(np.int64).clip(0, FRAGMENTS - 1)
                for f in range(FRAGMENTS):
                    piece = shingles[fragment == f].tobytes()
                    rows += [(f, g, node, piece) for g in groups]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                                                 ["fragment", "group", "x", "piece"])

    pieces = of.mapInArrow(tidy(cut), "fragment int, group int, x long, piece binary")
    asked = placed.select(F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("fragment"), "group", "x", "y", "p", "q")
    met = pieces.unionByName(asked, allowMissingColumns=True)

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, pairs = {}, []
        for batch in batches:
            for x, blob in zip(*(batch.column(c).to_pylist() for c in ("x", "piece"))):
                if blob is not None:
                    piece[x] = np.frombuffer(blob, np.uint64)
            asked = batch.filter(pa.compute.is_valid(batch.column("y")))
            pairs.append(asked.select(["x", "y", "p", "q"]))
        none = np.empty(0, np.uint64)
        for asked in pairs:
            both = [len(np.intersect1d(piece.get(x, none), piece.get(y, none), assume_unique=True))
                    for x, y in zip(asked.column("x").to_pylist(), asked.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([*asked.columns, pa.array(both, pa.int64())], ["x", "y", "p", "q", "both"])

    partial = met.groupBy("fragment", "group").applyInArrow(overlap, "x long, y long, p int, q int, both long")
    total = partial.groupBy("x", "y", "p", "q").agg(F.sum("both").alias("both"))
    similar = F.col("both") * (100 + percent) >= percent * (F.col("p").cast("long") + F.col("q"))
    return written(total.where(similar).select(F.col("x").alias("a"), F.col("y").alias("b")), "links")


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable over links, the row's own included).

    Two texts link when their sets of ``words``-word shingles have a Jaccard similarity of at least ``percent``
    hundredths. Null texts and texts without words have size 0 and link with nothing; a shorter text is one
    shingle. Equal rows have equal sets and so link. A null id never names a component of rows with ids.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sizes, of_all = shingled(docs, words)
    order = df.sparkSession.sparkContext.broadcast(of_all)
    reps = written(sizes.where("node IS NOT NULL AND id IS NOT NULL").groupBy("node").agg(F.min("id").alias("id")), "nodes")
    shared = written(_meetings(docs, order, words, percent).distinct(), "shared")
    seen, component, rounds = None, None, []
    for most in AHEAD:
        entries = shared.withColumn("component", F.col("node"))
        if component is not None:
            of = component.withColumnRenamed("component", "now")
            entries = shared.join(of, "node", "left").select("h", "node", "n", "at", F.coalesce("now", "node").alias("component"))
        pairs = _candidates(entries, percent, most)
        if seen is not None:
            pairs = pairs.join(seen.select("x", "y"), ["x", "y"], "left_anti")
        pairs = written(pairs, "pairs")
        rounds.append(pairs)
        count = pairs.count()
        if not count:
            continue
        seen = pairs if seen is None else seen.unionByName(pairs)
        found = _verified(docs, reps, pairs, count, order, words, percent)
        if component is None:
            component = written(connected_components(found), "components")
        else:
            component = written(merged_components(component, found), "components")
    discard(shared, *rounds)
    if component is None:
        component = reps.select("node", F.col("node").alias("component")).limit(0)
    of = reps.join(component, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "id")
    of = written(of, "final")
    smallest = of.groupBy("component").agg(F.min("id").alias("component_id"))
    named = of.join(smallest, "component").select("node", "component_id")
    return sizes.join(named, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
