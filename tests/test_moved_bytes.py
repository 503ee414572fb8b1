"""What is moved and kept: shuffles of the cuts, counts made in arrays, scratch tables."""

import math
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import riskframe.functions.ranking as ranking
import riskframe.operators.split as split_module
from riskframe.operators.drift import feature_counts
from riskframe.operators.split import IS_TEST, flag_stratified
from riskframe.plans import jobs
from riskframe.session import shared_dir

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def classes(spark):
    """Two large classes, many small ones, a missing one; copies of some keys."""
    name = F.when(F.col("id") < 400, "a").when(F.col("id") < 700, "b").when(F.col("id") < 760, None).otherwise((F.col("id") / 4).cast("int").cast("string"))
    key = F.when(F.col("id") % 5 == 0, F.col("id") % 40).otherwise(F.col("id"))
    return spark.range(1000).select(name.alias("y"), key.alias("k"))


@pytest.mark.parametrize("last", [0, 1, 100, 350, 1 << 16])
def test_cuts_choose_the_smallest_keys_of_every_class(spark, monkeypatch, last):
    monkeypatch.setattr(ranking, "LAST_ROUND_ROWS", last)
    df = classes(spark).select(F.col("y").alias("grp"), F.md5(F.col("k").cast("string")).alias("key"))
    groups = {}
    for row in df.collect():
        groups.setdefault(row["grp"], []).append(row["key"])
    cuts = ranking.hash_cuts(df, F.floor(F.col("rows") * 0.4)).collect()
    assert {c["grp"]: c["rows"] for c in cuts} == {g: len(keys) for g, keys in groups.items()} and len(cuts) == len(groups)
    for c in cuts:
        keys = sorted(groups[c["grp"]])
        below, on = [k for k in keys if k < c["key"]], [k for k in keys if k == c["key"]]
        quota = int(len(keys) * 0.4)
        assert c["quota"] == quota
        if c["take"] == c["ties"]:
            assert below + on == keys[:quota]
        else:
            assert len(on) == c["ties"] and below + on[:c["take"]] == keys[:quota]


def test_small_classes_move_one_long_a_row(spark, monkeypatch):
    plans, real = [], ranking._stored
    monkeypatch.setattr(ranking, "_stored", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name))
    df = spark.range(2000).select((F.col("id") / 4).cast("int").alias("y"), "id")
    monkeypatch.setattr(split_module, "MAX_CASE_CLASSES", 2)
    flagged, _ = flag_stratified(df, "y", 0.4, 42, ["id"])
    assert flagged.where(IS_TEST).count() == 500
    assert all("SortAggregate" not in plan for plan in plans)
    assert max(plan.count("Exchange hashpartitioning") for plan in plans) == 1
    # the key is made behind the join
    exchanges = [x for x in flagged._jdf.queryExecution().optimizedPlan().toString().split("\n") if "md5" in x]
    assert exchanges and "Join" in flagged._jdf.queryExecution().optimizedPlan().toString().split(exchanges[-1])[1]


def test_ranks_and_bins_are_counted_in_arrays(spark):
    values = [-math.inf, -2.5, -0.0, 0.0, 1.0, 1.0, 3.0, math.inf, math.nan, None]
    df = spark.createDataFrame([(v, i, "x" if i % 2 else None) for i, v in enumerate(values)], "v double, n long, c string")
    assert ranking.key_ranges(df, ["v", "n"]) == {
        "v": (8, ranking.double_key(-math.inf), ranking.double_key(math.inf)), "n": (10, 0, 9)}
    found = ranking.search_ranks(df, {"v": [1, 3, 5]}, ranking.key_ranges(df, ["v"]))
    assert [(ranking.key_double(x.key), x.below, x.equal) for x in (found["v", r] for r in (1, 3, 5))] == [(-2.5, 1, 1), (0.0, 2, 2), (1.0, 4, 2)]
    counts = feature_counts(df, ["c", "v"], {"v": [-math.inf, 0.0, 1.0, math.inf]})
    assert "MapInArrow" in counts._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in counts.collect()} == {(0, 0, "x", 5), (0, 0, "__MISSING__", 5), (1, 0, None, 2), (1, 1, None, 2), (1, 2, None, 4)}


def test_job_steps_have_compiled_methods(spark, monkeypatch):
    before, seen = spark.conf.get(LIMIT, None), []

    def stop(*args, **options):
        seen.append(spark.conf.get(LIMIT))
        raise InterruptedError

    for name in ("load_dataset", "registry_of", "load_model", "read_table"):
        monkeypatch.setattr(jobs, name, stop)
    spark.conf.set(LIMIT, "65535")
    try:
        for step in (jobs.prepare, jobs.train_and_promote, jobs.score, jobs.monitor):
            with pytest.raises(InterruptedError):
                step(spark, jobs.JobConfig("source.parquet", "/tmp/none", id_columns=("patient_id",)))
        assert seen == ["8000"] * 4 and spark.conf.get(LIMIT) == "65535"
    finally:
        spark.conf.unset(LIMIT) if before is None else spark.conf.set(LIMIT, before)


def test_packed_records_are_small():
    repeats = pytest.importorskip("riskframe.llm.repeats")
    rng = np.random.default_rng(1)
    records = np.zeros(20_000, repeats._STRETCH)
    records["key"], records["text"] = np.sort(rng.integers(0, 2**32, 20_000)), rng.integers(0, 2**63, 20_000)
    records["doc"], records["first"] = rng.integers(0, 300_000, 20_000), rng.integers(0, 5_000, 20_000)
    records["windows"], records["anchor"] = rng.integers(1, 28, 20_000), rng.integers(0, 27, 20_000)
    (_, _, block), = repeats._dealt(records, np.zeros(20_000, np.int64), 1, 0)
    assert len(pa.compress(block, codec="lz4", asbytes=True)) < 0.85 * len(pa.compress(records.tobytes(), codec="lz4", asbytes=True))
    assert (repeats.unpacked([block, repeats.packed(records[:0])], repeats._STRETCH) == records).all()


def test_links_leave_no_entries_behind(spark):
    jaccard = pytest.importorskip("riskframe.llm.jaccard")
    before = set(os.listdir(shared_dir(spark)))
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (2, text + " more"), (3, "something else here entirely now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    new = set(os.listdir(shared_dir(spark))) - before
    left = [x for x in new if (spark.read.parquet(f"{shared_dir(spark)}/{x}").inputFiles() and spark.read.parquet(f"{shared_dir(spark)}/{x}").count())]
    assert left and not [x for x in left if x.startswith(("llm-entries", "llm-shared"))]
