"""Approximate nearest neighbours: stable random projections in kd-trees, verified until a chi-square test stops.

Every vector is projected to ``DIMENSIONS`` Gaussian (2-stable) directions: the squared projected distance of two
vectors is their squared distance times a chi-square variable. Blocks of vectors are indexed by a kd-tree over the
projections. For a query, leaves come in the order of their projected distance and their vectors are compared
exactly; equal vectors are one point of the tree and share their distance. With the leaves up to projected distance r seen and the k-th exact distance d, a vector nearer than d is
still unseen with a chance of at most 1 - chi2(r^2 / d^2); the search stops when that is below ``MISS``.

All rows are indexed. Queries meet every block: queries and candidates are dealt into blocks, each query block is
copied to each candidate block, and the bests of the blocks are merged per query.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .vectors import usable

DIMENSIONS, MISS, LEAF, SEED = 8, 0.01, 32, 17
#: Values (8 bytes each) of the vectors in a block, and queries in a query block: what one task holds.
BLOCK_VALUES, QUERY_BLOCK = 1 << 20, 1024


def directions(width: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, DIMENSIONS))


def chi2_quantile(chance: float, freedom: int = DIMENSIONS) -> float:
    """Where the chi-square distribution of an even ``freedom`` reaches ``chance`` (bisection on its closed form)."""
    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))

    low, high = 0.0, 1e3
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < chance else (low, middle)
    return high


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Rows of the leaves of a kd-tree that halves the widest side at the median."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            leaves.append(rows)
            continue
        some = points[rows]
        side = int(np.argmax(some.max(axis=0) - some.min(axis=0)))
        half = len(rows) // 2
        order = np.argpartition(some[:, side], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return leaves


def distinct_vectors(vectors: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(firsts, rows, group): the row of each distinct vector's smallest id; the rows of the ``most`` smallest ids of
    every distinct vector, and for each of these which of the ``firsts`` it equals."""
    by_id = np.argsort(ids, kind="stable")
    packed = np.ascontiguousarray(vectors[by_id] + 0.0)  # -0.0 equals 0.0
    keys = packed.view(f"V{packed.itemsize * packed.shape[1]}").ravel()
    _, first, group = np.unique(keys, return_index=True, return_inverse=True)
    rows = np.argsort(group, kind="stable")
    group = group[rows]
    few = np.arange(len(rows)) - np.searchsorted(group, np.arange(len(first)))[group] < most
    return by_id[first], by_id[rows[few]], group[few]


def search_block(queries, query_ids, vectors, ids, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the query, ids, distances) of the k best of this block by distance, then id, as far as searched.

    The tree holds each distinct vector once, so that its copies are met together, however many there are; k + 1 of
    them suffice, as a query is no neighbour of its own.
    """
    axes = directions(vectors.shape[1])
    firsts, members, group = distinct_vectors(vectors, ids, k + 1)
    projected = vectors[firsts] @ axes
    leaves = kd_leaves(projected)
    low = np.stack([projected[rows].min(axis=0) for rows in leaves])
    high = np.stack([projected[rows].max(axis=0) for rows in leaves])
    leaf_of = np.empty(len(firsts), np.int64)
    for at, rows in enumerate(leaves):
        leaf_of[rows] = at
    leaf_of = leaf_of[group]
    leaves = np.split(members[np.argsort(leaf_of, kind="stable")], np.cumsum(np.bincount(leaf_of, minlength=len(leaves)))[:-1])
    enough = chi2_quantile(1 - MISS)
    for row, (query, own) in enumerate(zip(queries, query_ids)):
        at = query @ axes
        gap = np.maximum(np.maximum(low - at, at - high), 0.0)
        gap = np.einsum("ij,ij->i", gap, gap)
        order = np.argsort(gap)
        best_d, best_i = np.empty(0), np.empty(0, ids.dtype)
        step, done = 8, 0
        while done < len(order):
            if len(best_d) >= k and gap[order[done]] >= enough * best_d[k - 1] ** 2:
                break
            rows = np.concatenate([leaves[x] for x in order[done:done + step]])
            done += step
            rows = rows[ids[rows] != own]
            delta = vectors[rows] - query
            found_d = np.concatenate([best_d, np.sqrt(np.einsum("ij,ij->i", delta, delta))])
            found_i = np.concatenate([best_i, ids[rows]])
            keep = np.lexsort((found_i, found_d))[:k]
            best_d, best_i = found_d[keep], found_i[keep]
        yield row, best_i, best_d


def nearest_neighbours(
    df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """(query_id, rank, neighbour, score): the k nearest other rows of ``df`` found for each row of ``queries``.

    Score is the Euclidean distance in double precision; ties go to the smaller id; fewer rows than k give all.
    Rows without id and vectors that are null, empty, zero or hold null or non-finite values take no part. Rows
    that repeat an id count once per id. Ids are integers, vectors of one length meet only vectors of that length.
    """
    rows = written(usable(df, id_col, vector_col).dropDuplicates(["id"]).withColumn("d", F.size("vector")), "vectors")
    asked = usable(queries, id_col, vector_col).dropDuplicates(["id"]).withColumn("d", F.size("vector"))
    asked = written(asked, "queries")
    sizes = rows.groupBy("d").agg(F.ceil(F.count("*") * F.col("d") / block_values).cast("int").alias("blocks"))
    ahead = asked.groupBy("d").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    blocks = written(sizes.join(ahead, "d"), "blocks")
    slot = F.pmod(F.xxhash64("id"), F.lit(1 << 30)).cast("int")
    candidates = rows.join(blocks, "d").withColumn("block", slot % F.col("blocks")).select(
        "d", "block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"), "id", "vector", F.lit(False).alias("asks"))
    askers = asked.join(blocks, "d").withColumn("query_block", slot % F.col("query_blocks")).select(
        "d", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "query_block", "id", "vector", F.lit(True).alias("asks"))
    met = candidates.unionByName(askers).groupBy("d", "block", "query_block")

    def search(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        vectors = np.stack(group["vector"].to_numpy())
        ids = group["id"].to_numpy()
        out = {"query_id": [], "neighbour": [], "score": []}
        if asks.any() and not asks.all():
            for row, found, distance in search_block(vectors[asks], ids[asks], vectors[~asks], ids[~asks], k):
                out["query_id"].append(np.repeat(ids[asks][row], len(found)))
                out["neighbour"].append(found)
                out["score"].append(distance)
        return pd.DataFrame({c: np.concatenate(v) if v else np.empty(0, float if c == "score" else np.int64) for c, v in out.items()})

    found = met.applyInPandas(search, "query_id long, neighbour long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "neighbour"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "neighbour", "score")
