"""Nearest neighbours and near-duplicate vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import near_vectors, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def some_vectors(n=400, d=12, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d)).astype(np.float32)
    for k in range(0, n, 5):  # near and exact copies
        base[(k + 3) % n] = base[k] + rng.standard_normal(d) * 0.08 * (k % 10 > 0)
    rows = [(int(k), base[k].tolist(), int(k % 3)) for k in range(n)]
    bad = [(n, None, 0), (n + 1, [0.0] * d, 0), (n + 2, [1.0, None] + [0.0] * (d - 2), 1), (n + 3, [float("nan")] * d, 1), (n + 4, [], 2),
           (n + 5, [float("inf")] + [1.0] * (d - 1), 2), (n + 6, rows[0][1], None), (n + 7, [1.0, 2.0], 0)]
    return rows, bad


def test_chi_square_quantile():
    assert neighbours.chi2_quantile(0.99, 8) == pytest.approx(20.0902, abs=1e-3)


def test_kd_leaves_hold_every_row_once():
    points = np.random.default_rng(1).standard_normal((1000, 4))
    points[:500] = points[0]  # many equal points
    leaves = neighbours.kd_leaves(points, 16)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000)) and max(map(len, leaves)) <= 16


@pytest.mark.parametrize("block_values", [1 << 20, 12 * 90])
def test_neighbours_against_brute_force(spark, block_values):
    rows, bad = some_vectors()
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumns({"id": F.lit("x"), "d": F.lit(1), "block": F.lit(2)})
    got = neighbours.nearest_neighbours(df, df.where("vec_id % 20 = 0"), block_values=block_values).collect()
    vectors = np.array([r[1] for r in rows + bad[6:7]], np.float64)
    ids = np.array([r[0] for r in rows + bad[6:7]])
    hits = total = 0
    for query in range(0, 400, 20):
        distance = np.sqrt(((vectors - vectors[query]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, distance)) if ids[k] != query][:10]
        mine = sorted((r["rank"], r["neighbour"], r["score"]) for r in got if r["query_id"] == query)
        assert [r[0] for r in mine] == list(range(1, 11))
        assert all(score == pytest.approx(distance[ids == n][0]) for _, n, score in mine)
        hits += len({ids[k] for k in order} & {n for _, n, _ in mine})
        total += 10
    assert hits >= 0.95 * total
    assert {r["query_id"] for r in got} == set(range(0, 400, 20))


def test_ties_among_thousands_of_copies_go_to_the_smallest_ids():
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((9000, 12))
    copies = np.sort(rng.choice(9000, 3000, replace=False))
    vectors[copies] = vectors[copies[0]]
    vectors[copies[1::2], 0] = vectors[copies[0], 0] = 0.0
    vectors[copies[2::2], 0] = -0.0
    ids = rng.permutation(9000)
    queries = np.concatenate([copies[:5], np.setdiff1d(np.arange(9000), copies)[:20]])
    # a query that is no copy but nearest to the group
    vectors[queries[-1]] = vectors[copies[0]] + 1e-3
    for row, found, distance in neighbours.search_block(vectors[queries], ids[queries], vectors, ids, 10):
        exact = np.sqrt(((vectors - vectors[queries[row]]) ** 2).sum(axis=1))
        want = [k for k in np.lexsort((ids, exact)) if ids[k] != ids[queries[row]]][:10]
        if row < 5 or row == len(queries) - 1:
            assert found.tolist() == ids[want].tolist() and np.allclose(distance, exact[want])
        assert len(set(found.tolist())) == 10 and ids[queries[row]] not in found


def test_few_neighbours_and_empty_tables(spark):
    df = spark.createDataFrame([(100, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [0.0, 1.0], 0)], SCHEMA)
    got = sorted(tuple(r) for r in neighbours.nearest_neighbours(df, df.where("vec_id = 100")).collect())
    assert [(r[1], r[2]) for r in got] == [(1, 2), (2, 3)]
    assert neighbours.nearest_neighbours(df.limit(0), df).count() == 0
    assert neighbours.nearest_neighbours(df, df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1024, 16])
def test_near_vectors_against_all_pairs(spark, block):
    rows, bad = some_vectors(300)
    bad = [b for b in bad]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumns({"id": F.lit("x"), "n": F.lit(1), "cell": F.lit(0), "vector": F.lit(3)})
    got = {r["vec_id"]: r for r in near_vectors.near_vectors(df, block=block).collect()}
    assert len(got) == len(rows) + len(bad)
    links = {k: set() for k in got}
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[2] == b[2]:
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                    links[a[0]].add(b[0])
                    links[b[0]].add(a[0])
    assert sum(map(len, links.values())) > 100
    for k, r in got.items():
        reach, todo = {k}, [k]
        while todo:
            for other in links[todo.pop()] - reach:
                reach.add(other)
                todo.append(other)
        assert (r["n_links"], r["component_id"], r["kept"]) == (len(links[k]), min(reach), k == min(reach))


def test_near_vectors_without_rows(spark):
    assert near_vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
