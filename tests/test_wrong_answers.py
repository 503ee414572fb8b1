"""Inputs that used to give a silent wrong answer."""

import pytest
from pyspark.sql import functions as F

from riskframe.functions.ranking import long_order_statistic
from riskframe.operators.cleaning import clean_categorical_variables
from riskframe.operators.duplicates import drop_duplicate_rows, duplicate_row_count, row_hash
from riskframe.operators.features import LifestyleFeatureEngineer
from riskframe.operators.metrics import compute_binary_holdout_metrics
from riskframe.operators.split import IS_TEST, temporal_flag
from riskframe.plans.evaluation import ModelEvaluator
from riskframe.sources.tables import upsert


def test_upsert_needs_identifiers(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    with pytest.raises(ValueError, match="identifier"):
        upsert(old, old, [])
    got = upsert(old, spark.createDataFrame([(2, "new"), (3, "c")], "id long, v string"), ["id"])
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "new"), (3, "c")]


def test_nanosecond_times_are_cut_exactly(spark):
    base = 1_700_000_000_000_000_000
    df = spark.range(100).select("id", (F.lit(base) + F.col("id")).alias("ns"))
    late = temporal_flag(df, "ns", 0.2, id_columns=["id"]).where(IS_TEST)
    assert sorted(r["id"] for r in late.collect()) == list(range(80, 100))


def test_nan_times_count_as_missing_and_sort_last(spark):
    rows = [(k, float("nan") if k % 10 == 0 else float(k)) for k in range(100)]
    df = spark.createDataFrame(rows, "id long, t double")
    late = {r["id"] for r in temporal_flag(df, "t", 0.2, id_columns=["id"]).where(IS_TEST).collect()}
    assert len(late) == 20 and {k for k in range(0, 100, 10)} <= late


@pytest.mark.parametrize("rank", [0, 1, 500, 998, 999])
def test_long_order_statistic_over_the_whole_range(spark, rank):
    values = sorted([-(2**63), 2**63 - 1, 0, -1, 1] + [(k * 7_919_191_919_191) % 2**62 * (-1) ** k for k in range(995)])
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert long_order_statistic(df, "v", rank) == values[rank]


def test_coded_categories_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, 0, 5.0, 200.0, 7.0, 1.0)], "smoking_status int, gender int, diet_score double, "
                               "physical_activity_minutes_per_week double, sleep_hours_per_day double, alcohol_consumption_per_week double")
    df = df.withColumn("screen_time_hours_per_day", F.lit(2.0))
    cleaned = clean_categorical_variables(df)
    assert cleaned.schema == df.schema and cleaned.collect() == df.collect()
    assert LifestyleFeatureEngineer().transform(cleaned).first()["lifestyle_score"] is not None


@pytest.mark.parametrize("row", [(None, 0.5), (1, None), (0, float("nan"))])
def test_metrics_refuse_missing_input(spark, row):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), row], "y int, s double")
    with pytest.raises(Exception, match="must not be missing"):
        compute_binary_holdout_metrics(df, "y", "s")


def test_metrics_need_both_classes_and_the_right_positive(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.9), (1, 0.2), (2, 0.8)], "y int, s double")
    assert compute_binary_holdout_metrics(df, "y", "s", positive=2)["holdout_roc_auc"] == 1.0
    with pytest.raises(ValueError, match="label 1"):
        compute_binary_holdout_metrics(df.where("y = 1"), "y", "s")


class _ThreeClasses:
    """Scores from a column; class 1 is never in the test rows."""

    classes = [0, 1, 2]

    def transform(self, df):
        sure = F.when(F.col("x") > 0, F.array(F.lit(0.1), F.lit(0.1), F.lit(0.8))).otherwise(F.array(F.lit(0.8), F.lit(0.1), F.lit(0.1)))
        return df.withColumn("probabilities", sure)


def test_evaluator_keeps_the_classes_of_the_model(spark):
    df = spark.createDataFrame([(0, -1), (2, 1), (0, -2), (2, 2)], "y int, x int")
    report = ModelEvaluator(_ThreeClasses()).evaluate(df, "y")
    assert report.metrics["accuracy"] == 1.0
    with pytest.raises(ValueError, match="not trained on"):
        ModelEvaluator(_ThreeClasses()).evaluate(df.withColumn("y", F.col("y") + 1), "y")


def test_row_hash_sees_where_a_value_is_missing(spark):
    rows = [(None, 1, 2, 3, k) for k in range(5)] + [(1, None, 2, 3, k) for k in range(5)] + [(None, 1, 2, 3, 0)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int")
    assert df.select(row_hash(df)).distinct().count() == 10
    assert duplicate_row_count(df) == 1 and drop_duplicate_rows(df).count() == 10
