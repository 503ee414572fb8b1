import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe import split_dataframe
from riskframe.functions import ranking
from riskframe.operators import split as split_module
from riskframe.operators.split import IS_TEST, assign_splits, create_train_test_tables, flag_stratified, temporal_flag


def fixture(spark):
    return spark.range(100).select(
        F.col("id").alias("patient_id"), (F.col("id") * 2).alias("feature"), (F.col("id") >= 80).cast("long").alias("TARGET")
    )


def ids(df):
    return sorted(r.patient_id for r in df.select("patient_id").collect())


def test_exact_class_counts(spark):
    result = split_dataframe(fixture(spark), "TARGET", 0.25, id_columns=["patient_id"])
    assert result.train_target_distribution == {"0": 60, "1": 15}
    assert result.test_target_distribution == {"0": 20, "1": 5}
    assert ids(result.train_df.unionByName(result.test_df)) == list(range(100))
    assert (result.train_df.count(), result.test_df.count()) == (75, 25)


@pytest.mark.parametrize("keys", [["patient_id"], []])
def test_same_split_on_any_partitioning(spark, keys):
    df = fixture(spark)
    one = split_dataframe(df.repartition(1), "TARGET", id_columns=keys)
    seven = split_dataframe(df.repartition(7), "TARGET", id_columns=keys)
    assert ids(one.test_df) == ids(seven.test_df)
    other = split_dataframe(df, "TARGET", random_state=7, id_columns=keys)
    assert ids(other.test_df) != ids(one.test_df)


def test_small_and_missing_classes(spark):
    rows = [(i, "a") for i in range(10)] + [(10, "b")] + [(11, None), (12, None), (13, None)]
    df = spark.createDataFrame(rows, "patient_id long, y string")
    result = split_dataframe(df, "y", 0.2, id_columns=["patient_id"])
    assert result.test_target_distribution == {"a": 2, "None": 1}
    assert result.train_target_distribution == {"a": 8, "b": 1, "None": 2}
    assert result.test_df.filter("y IS NULL").count() == 1


def test_identical_rows_straddling_the_cut(spark):
    df = spark.createDataFrame([(1, "hot")] * 50, "patient_id long, y string")
    result = split_dataframe(df, "y", 0.2, id_columns=["patient_id"])
    assert (result.train_df.count(), result.test_df.count()) == (40, 10)
    both = spark.createDataFrame([(1, "hot")] * 50 + [(1, "cold")] * 20, "patient_id long, y string")
    parts = split_dataframe(both, "y", 0.2, id_columns=["patient_id"])
    assert {r[0]: r[1] for r in parts.test_df.groupBy("y").count().collect()} == {"hot": 10, "cold": 4}
    without_ids = split_dataframe(df, "y", 0.2)
    assert (without_ids.train_df.count(), without_ids.test_df.count()) == (40, 10)


def test_deep_cut_and_many_classes_agree(spark, monkeypatch):
    df = fixture(spark)
    expected = ids(split_dataframe(df, "TARGET", id_columns=["patient_id"]).test_df)
    monkeypatch.setattr(ranking, "HEX_DIGITS_PER_LEVEL", 1)
    assert ids(split_dataframe(df, "TARGET", id_columns=["patient_id"]).test_df) == expected
    monkeypatch.setattr(ranking, "LAST_ROUND_ROWS", 0)
    assert ids(split_dataframe(df, "TARGET", id_columns=["patient_id"]).test_df) == expected
    monkeypatch.setattr(split_module, "MAX_CASE_CLASSES", 0)
    assert ids(split_dataframe(df, "TARGET", id_columns=["patient_id"]).test_df) == expected


def test_any_number_of_classes(spark):
    """Most classes have a row or two, one has many: every class meets its quota."""
    df = spark.range(3000).select(
        F.col("id").alias("patient_id"), F.when(F.col("id") < 900, F.lit("hot")).otherwise((F.col("id") / 2).cast("int").cast("string")).alias("y"))
    flagged, cuts = flag_stratified(df, "y", 0.2, 42, ["patient_id"])
    got = {r["y"]: (r["n"], r["t"]) for r in flagged.groupBy("y").agg(F.count("*").alias("n"), F.sum(F.col(IS_TEST).cast("int")).alias("t")).collect()}
    assert len(got) == 1051 and got.pop("hot") == (900, 180)
    assert set(got.values()) == {(2, 1)}
    assert cuts.count() == 1051


def test_many_classes_with_copies_across_the_cut(spark, monkeypatch):
    monkeypatch.setattr(split_module, "MAX_CASE_CLASSES", 2)
    rows = [(1, f"c{k}") for k in range(5) for _ in range(20 + k)] + [(2, None)] * 10
    parts = split_dataframe(spark.createDataFrame(rows, "patient_id long, y string"), "y", 0.2, id_columns=["patient_id"])
    assert {r[0]: r[1] for r in parts.test_df.groupBy("y").count().collect()} == {"c0": 4, "c1": 4, "c2": 4, "c3": 4, "c4": 4, None: 2}
    assert parts.train_df.count() == 98


def test_unstratified_and_checks(spark):
    df = fixture(spark)
    result = split_dataframe(df, "TARGET", 0.3, stratify=False, id_columns=["patient_id"])
    assert result.train_count + result.test_count == 100 and 10 < result.test_count < 50
    for size in (0, 1, -1):
        with pytest.raises(ValueError):
            split_dataframe(df, "TARGET", size)
    with pytest.raises(KeyError):
        split_dataframe(df, "absent")
    with pytest.raises(TypeError):
        split_dataframe([1], "TARGET")


def test_split_needs_no_shuffle(spark):
    result = split_dataframe(fixture(spark), "TARGET", id_columns=["patient_id"])
    assert "Exchange" not in result.test_df._jdf.queryExecution().executedPlan().toString()


def test_split_tables(spark, tmp_path):
    fixture(spark).write.parquet(str(tmp_path / "source"))
    result = create_train_test_tables(
        str(tmp_path / "source"), str(tmp_path / "train"), str(tmp_path / "test"), "TARGET", 0.25, spark=spark,
        id_columns=["patient_id"],
    )
    assert result.test_target_distribution == {"0": 20, "1": 5}
    assert spark.read.parquet(str(tmp_path / "test")).count() == 25


@pytest.mark.parametrize("share_of_one_time", [0, 70])
def test_temporal_split(spark, share_of_one_time):
    df = spark.range(100).select(
        F.col("id").alias("patient_id"),
        F.when(F.col("id") < share_of_one_time, 50).otherwise(F.col("id")).alias("t"),
    )
    flagged = temporal_flag(df, "t", 0.2, id_columns=["patient_id"])
    train = flagged.filter(~F.col(IS_TEST))
    assert train.count() == 80
    assert train.agg(F.max("t")).first()[0] <= flagged.filter(IS_TEST).agg(F.min("t")).first()[0]


def test_temporal_missing_last_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, 5.0)] * 10 + [(2, None)] * 5, "patient_id long, t double")
    flagged = temporal_flag(df, "t", 0.5, id_columns=["patient_id"])
    counts = {(r[0], r[1]): r[2] for r in flagged.groupBy(IS_TEST, "patient_id").count().collect()}
    assert counts == {(False, 1): 7, (True, 1): 3, (True, 2): 5}


@pytest.mark.parametrize("strategy", ["stratified", "random", "temporal"])
def test_three_way_split_is_a_partition(spark, strategy):
    df = fixture(spark)
    out = assign_splits(
        df, target="TARGET", strategy=strategy, test_size=0.2, validation_size=0.25, id_columns=["patient_id"],
        temporal_column="feature",
    )
    assert ids(out) == list(range(100))
    counts = {r[0]: r[1] for r in out.groupBy("split").count().collect()}
    if strategy != "random":
        assert counts["test"] == 20 and counts["valid"] == 20


@pytest.mark.parametrize("strategy", ["stratified", "random", "temporal"])
def test_three_way_split_reads_its_source_once(spark, tmp_path, strategy):
    fixture(spark).write.parquet(str(tmp_path / "t"))
    out = assign_splits(
        spark.read.parquet(str(tmp_path / "t")), target="TARGET", strategy=strategy, id_columns=["patient_id"], temporal_column="feature")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


@pytest.mark.parametrize("times", ["one", "two", "missing"])
def test_temporal_three_way_with_tied_times(spark, times):
    """Both cuts fall on one time, or on times that many rows share."""
    when = {"one": F.lit(5), "two": (F.col("id") / 50).cast("int"), "missing": F.when(F.col("id") < 30, F.col("id"))}[times]
    df = spark.range(100).select(F.col("id").alias("patient_id"), when.alias("t"), F.lit(0).alias("TARGET"))
    out = assign_splits(df, target="TARGET", strategy="temporal", test_size=0.2, validation_size=0.25, id_columns=["patient_id"], temporal_column="t")
    assert {r[0]: r[1] for r in out.groupBy("split").count().collect()} == {"test": 20, "valid": 20, "train": 60}
    assert out.select("patient_id").distinct().count() == 100
    same = df.withColumn("patient_id", F.lit(1))
    out = assign_splits(same, target="TARGET", strategy="temporal", test_size=0.2, validation_size=0.25, id_columns=["patient_id"], temporal_column="t")
    assert {r[0]: r[1] for r in out.groupBy("split").count().collect()} == {"test": 20, "valid": 20, "train": 60}


@pytest.mark.parametrize("counters", [1, 1 << 20])
def test_quantiles_match_numpy(spark, monkeypatch, counters):
    rng = np.random.default_rng(3)
    smooth = rng.lognormal(size=2000) * rng.choice([-1, 1], 2000)
    hot = np.where(rng.random(2000) < 0.4, 7.0, rng.integers(0, 15, 2000))
    whole = rng.integers(-(2**40), 2**40, 2000)
    rows = [(float(a), float(b), None, int(c), str(a)) for a, b, c in zip(smooth, hot, whole)]
    df = spark.createDataFrame(rows, "a double, b float, c double, d long, e string").repartition(3)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    monkeypatch.setattr(ranking, "ROUND_COUNTERS", counters)
    found = ranking.exact_quantiles(df, ["a", "b", "c", "d", "e"], probs)
    assert found["a"] == found["e"] == pytest.approx(np.quantile(smooth, probs).tolist())
    assert found["b"] == pytest.approx(np.quantile(hot, probs).tolist())
    assert found["c"] is None
    assert found["d"] == pytest.approx(np.quantile(whole, probs).tolist())


def test_keys_are_the_bits_of_every_double(spark):
    values = [s * m * 2.0**e for e in range(-1074, 1024) for m in (1.0, 1.5, 1.9999999999999998) for s in (1, -1)]
    values += [0.0, -0.0, float("inf"), float("-inf"), 5e-324, 1.7976931348623157e308, 2.2250738585072014e-308]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in ranking.with_keys(df, ["v"]).collect()]
    assert got == [ranking.double_key(v) for v in values]
    assert [ranking.key_double(k) for k in got] == values
    order = sorted(range(len(values)), key=lambda i: values[i])
    assert [got[i] for i in order] == sorted(got)


def test_ranks_of_many_columns_need_few_rounds(spark, monkeypatch):
    df = spark.range(3000).select(*[(F.rand(k) * 10.0**k).alias(f"c{k}") for k in range(30)]).cache()
    rounds, real = [], ranking._round
    monkeypatch.setattr(ranking, "_round", lambda keys, x: rounds.append(len(x)) or real(keys, x))
    found = ranking.exact_quantiles(df, df.columns, [0.1, 0.5, 0.9])
    local = df.toPandas()
    for c in df.columns:
        assert found[c] == pytest.approx(np.quantile(local[c], [0.1, 0.5, 0.9]).tolist())
    assert len(rounds) <= 7
    df.unpersist()


def test_global_index(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(5)
    rows = ranking.global_index(df, ["k"]).collect()
    assert all(r.k == r["index"] for r in rows) and len(rows) == 1000
