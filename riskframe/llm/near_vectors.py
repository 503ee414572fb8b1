"""Near-duplicate vectors within equal labels by PCA-ordered tiled comparison.

Vectors are rotated to the principal axes of all vectors, the widest first; rotation keeps products. Within a label
they are laid out along the first axis in cells no pair above the threshold can skip, and cells are cut into blocks.
A tile compares two blocks of the same or of adjoining cells: products over the leading dimensions come first, the
norms of what is left bound the rest, and only pairs whose bound still reaches the threshold go on.

Equal vectors are one class before any comparison. A tile reports per vector the number of linked vectors and its
place in a spanning forest of the tile, never its pairs, so a group of near copies costs no quadratic output.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import connected_components
from .vectors import matrix, usable

THRESHOLD, BLOCK = 0.93, 1024
#: Leading dimensions summed before each look at the bound.
STEPS = (8, 16, 32)
_SLACK = 1e-9
_PAIRS = 1 << 16


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length d the orthogonal axes (columns), by falling variance, over all rows (d, vector).

    Tasks send sums of products (d * d numbers), added up in two steps.
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = batch.column("d").to_numpy()
            for d in np.unique(lengths):
                unit = _unit(matrix(batch.filter(pa.array(lengths == d)).column("vector")))
                totals[int(d)] = totals.get(int(d), 0) + unit.T @ unit
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array([t.ravel() for t in totals.values()], pa.list_(pa.float64()))],
                ["d", "total"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"d": group["d"].iloc[:1], "total": [np.sum(np.stack(group["total"].to_numpy()), axis=0)]})

    parts = vectors.select("d", "vector").mapInArrow(sums, "d int, total array<double>")
    parts = parts.groupBy("d", F.pmod(F.spark_partition_id(), F.lit(16)).alias("part")).applyInPandas(add, "d int, total array<double>")
    totals: dict[int, np.ndarray] = {}
    for row in parts.toLocalIterator():
        totals[row["d"]] = totals.get(row["d"], 0) + np.array(row["total"])
    return {d: np.linalg.eigh(t.reshape(d, d))[1][:, ::-1] for d, t in totals.items()}


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` (unit vectors) whose product reaches the threshold."""
    ra, rb = a @ axes, b @ axes
    stops = [s for s in STEPS if s < ra.shape[1]] + [ra.shape[1]]

    def rest(r: np.ndarray, stop: int) -> np.ndarray:
        return np.sqrt((r[:, stop:] ** 2).sum(axis=1))

    head = stops[0]
    product = ra[:, :head] @ rb[:, :head].T
    i, j = np.nonzero(product + rest(ra, head)[:, None] * rest(rb, head)[None, :] >= threshold - _SLACK)
    sums = product[i, j]
    del product
    for start, stop in zip(stops, stops[1:]):
        if not len(i):
            break
        for at in range(0, len(i), _PAIRS):
            part = slice(at, at + _PAIRS)
            sums[part] += np.einsum("ij,ij->i", ra[i[part], start:stop], rb[j[part], start:stop])
        keep = sums + rest(ra, stop)[i] * rest(rb, stop)[j] >= threshold - _SLACK
        i, j, sums = i[keep], j[keep], sums[keep]
    exact = np.empty(len(i), bool)
    for at in range(0, len(i), _PAIRS):
        part = slice(at, at + _PAIRS)
        exact[part] = np.einsum("ij,ij->i", a[i[part]], b[j[part]]) >= threshold
    return i[exact], j[exact]


def forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For every row the smallest id it reaches over the pairs (i, j)."""
    root = ids.copy()
    while len(i):
        low = np.minimum(root[i], root[j])
        if (root[i] == low).all() and (root[j] == low).all():
            break
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
    return root


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, block: int = BLOCK,
) -> DataFrame:
    """Per row: id, n_links (other vectors of the same label with cosine >= threshold), component_id, kept.

    component_id is the smallest id reachable over links, the row's own included; kept rows are those with it. Rows
    without label, and vectors that are null, empty, zero or hold null or non-finite values, link with nothing;
    vectors of different length do not link. Ids are integers; rows repeating an id count once and agree.
    """
    vectors = written(
        usable(df, id_col, vector_col, label_col).where(F.col(label_col).isNotNull()).dropDuplicates(["id"])
        .select("id", F.col(label_col).alias("label"), F.size("vector").alias("d"), "vector"), "vectors")
    # equal vectors of a label are one class, named by the smallest id
    classes = written(vectors.groupBy("label", "d", "vector").agg(F.min("id").alias("id"), F.count("*").alias("n")), "classes")
    member = written(vectors.alias("v").join(classes.alias("c"), ["label", "d", "vector"]).select(
        F.col("v.id").alias("id"), F.col("c.id").alias("class"), "n"), "members")
    axes = classes.sparkSession.sparkContext.broadcast(principal_axes(classes))
    # beyond this distance along any axis two unit vectors cannot have the threshold as product
    width = math.sqrt(2 - 2 * threshold) + _SLACK

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, cells = batch.column("d").to_numpy(), np.zeros(batch.num_rows, np.int32)
            for d in np.unique(lengths):
                unit = _unit(matrix(batch.filter(pa.array(lengths == d)).column("vector")))
                cells[lengths == d] = np.floor(unit @ axes.value[int(d)][:, 0] / width)
            yield batch.append_column("cell", pa.array(cells))

    label = classes.schema["label"].dataType.simpleString()
    placed = written(classes.mapInArrow(place, f"label {label}, d int, vector array<double>, id long, n long, cell int"), "cells")
    sizes = placed.groupBy("label", "d", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    after = sizes.select("label", "d", (F.col("cell") - 1).alias("cell"), F.col("blocks").alias("next"))
    before = sizes.select("label", "d", (F.col("cell") + 1).alias("cell"), F.col("blocks").alias("previous"))
    layout = written(sizes.join(after, ["label", "d", "cell"], "left").join(before, ["label", "d", "cell"], "left"), "layout")
    own, every = F.col("own"), F.col("blocks")

    def tile(cell, left, right):
        return F.struct(cell.alias("tile_cell"), left.alias("left"), right.alias("right"))

    same = F.transform(F.sequence(F.lit(0), every - 1), lambda x: tile(
        F.col("cell"), F.least(own, x), F.greatest(own, x)))
    ahead = F.when(F.col("next").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("next") - 1), lambda x: tile(
        F.col("cell"), own, x + every))).otherwise(F.filter(same, lambda x: F.lit(False)))
    back = F.when(F.col("previous").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("previous") - 1), lambda x: tile(
        F.col("cell") - 1, x, own + F.col("previous")))).otherwise(F.filter(same, lambda x: F.lit(False)))
    dealt = placed.join(layout, ["label", "d", "cell"]).withColumn("own", F.pmod(F.xxhash64("id"), every).cast("int")).select(
        "label", "d", "id", "n", "vector", "own", "cell", F.explode(F.concat(same, ahead, back)).alias("t"))
    dealt = dealt.select(
        "label", "d", "id", "n", "vector", "t.tile_cell", "t.left", "t.right",
        ((F.col("cell") == F.col("t.tile_cell")) & (own == F.col("t.left"))).alias("first"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ids, n, first = group["id"].to_numpy(), group["n"].to_numpy(), group["first"].to_numpy()
        unit = _unit(np.stack(group["vector"].to_numpy()))
        a, b = np.flatnonzero(first), np.flatnonzero(~first)
        alone = group["left"].iloc[0] == group["right"].iloc[0]  # a block with itself
        b = a if alone else b
        if not len(a) or not len(b):
            return pd.DataFrame({"id": ids[:0], "links": n[:0], "root": ids[:0]})
        i, j = linked_pairs(unit[a], unit[b], axes.value[int(group["d"].iloc[0])], threshold)
        i, j = a[i], b[j]
        if alone:
            i, j = i[i < j], j[i < j]
        links = np.bincount(i, weights=n[j], minlength=len(ids)) + np.bincount(j, weights=n[i], minlength=len(ids))
        some = links > 0
        return pd.DataFrame({"id": ids[some], "links": links[some].astype(np.int64), "root": forest(ids, i, j)[some]})

    tiles = dealt.groupBy("label", "d", "tile_cell", "left", "right")
    linked = written(tiles.applyInPandas(compare, "id long, links long, root long"), "linked")
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    found = (
        member.join(links.withColumnRenamed("id", "class"), "class", "left")
        .join(components.withColumnRenamed("node", "class"), "class", "left")
        .select("id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "class").alias("component_id")))
    everyone = df.select(F.col(f"`{id_col}`").alias("id"))
    of = found.select(F.col("id").alias("of"), "n_links", "component_id")
    component = F.coalesce("component_id", F.col("id").cast("long"))
    return everyone.join(of, F.col("id") == F.col("of"), "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
