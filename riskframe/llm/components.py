"""Connected components of an edge table: tasks contract their edges, smallest-neighbour hops join what tasks have."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Edges that a task contracts at a time.
TASK_EDGES = 1 << 17


def smallest_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of these edges and for each the smallest one reachable."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, x, y = np.arange(len(nodes)), ends[:len(a)], ends[len(a):]
    while len(x):
        x, y = root[x], root[y]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, above := root[root]):
            root = above
    return nodes, nodes[root]


def _contracted(links: DataFrame, tasks: int) -> DataFrame:
    """The same components with a star per component and task: every node's edge leads to the smallest its task knows."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def stars() -> pa.RecordBatch:
            nodes, low = smallest_ends(*(pa.chunked_array([x.column(c) for x in held]).to_numpy() for c in ("a", "b")))
            inner = nodes != low
            return pa.RecordBatch.from_arrays([pa.array(nodes[inner], of_type), pa.array(low[inner], of_type)], ["a", "b"])

        for batch in batches:
            of_type = batch.schema.field("a").type
            held.append(batch)
            n_held += batch.num_rows
            if n_held >= TASK_EDGES:
                yield stars()
                held, n_held = [], 0
        if held:
            yield stars()

    return links.coalesce(tasks).mapInArrow(contract, links.schema)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable over ``edges(a, b)``; only nodes with edges.

    Alternates three steps until nothing changes: every task contracts the edges it has, every node hands its smallest
    neighbour to its larger ones, then to its smaller ones. The edges of a node are only ever aggregated to a minimum,
    so a hub is combined before the shuffle; the number of rounds grows with the logarithm of the longest chain. There
    are as many tasks as hold ``TASK_EDGES`` edges each; where that is one, its stars are the result.
    """
    links = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    before = None
    while True:
        tasks = max(1, -(-links.count() // TASK_EDGES))
        links = written(_contracted(links, tasks), "forest")
        if tasks == 1:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        # larger neighbours of a node join its smallest neighbour
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        big = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        big = big.unionByName(low.where("low < a").select("a", F.col("low").alias("b"))).distinct()
        big = written(big.where("a <> b"), "large-star")
        # then a node's smaller neighbours join the smallest of them
        low = big.groupBy("a").agg(F.min("b").alias("low"))
        small = big.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b")))
        links = written(small.where("a <> b").distinct(), "small-star")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state


def merged_components(known: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) of ``known`` components after adding ``edges(a, b)``: only the edges between them are searched."""
    for end in ("a", "b"):
        of = known.select(F.col("node").alias(end), F.col("component").alias("now"))
        edges = edges.join(of, end, "left").withColumn(end, F.coalesce("now", end)).drop("now")
    moved = written(connected_components(edges), "moved").select(F.col("node").alias("component"), F.col("component").alias("to"))
    kept = known.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    # nodes that had no component: those that moved and are not in the table yet
    new = moved.select(F.col("component").alias("node"), F.col("to").alias("component")).join(known.select("node"), "node", "left_anti")
    return kept.unionByName(new)
