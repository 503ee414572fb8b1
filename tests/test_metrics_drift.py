import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe import DataDriftMonitor, compute_binary_holdout_metrics
from riskframe.operators import metrics as M


def brute_force(label, score):
    pos, neg = score[label == 1], score[label == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    order = sorted(set(score), reverse=True)
    ap, last = 0.0, 0.0
    for t in order:
        chosen = score >= t
        recall = (label[chosen] == 1).sum() / len(pos)
        ap += (recall - last) * (label[chosen] == 1).mean()
        last = recall
    return wins / (len(pos) * len(neg)), ap


def test_perfect_separation(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.8), (1, 0.9)], "y long, s double")
    metrics = compute_binary_holdout_metrics(df, "y", "s")
    for name in ("accuracy", "balanced_accuracy", "precision", "recall", "f1", "roc_auc", "avg_precision", "mcc"):
        assert metrics[f"holdout_{name}"] == 1.0
    assert (metrics["holdout_tp"], metrics["holdout_tn"]) == (2, 2)
    assert metrics["holdout_brier_score"] < 0.1


@pytest.mark.parametrize("decimals", [None, 6])
def test_curves_match_brute_force(spark, decimals):
    rng = np.random.default_rng(0)
    label = rng.integers(0, 2, 400)
    score = np.round(np.clip(rng.normal(0.4 + 0.2 * label, 0.2), 0, 1), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(label, score)], "y long, s double").repartition(3)
    row = M.binary_metrics_wide(df, "y", "s", decimals=decimals).first()
    auc, ap = brute_force(label, score)
    assert row.roc_auc == pytest.approx(auc) and row.avg_precision == pytest.approx(ap)
    assert row.brier_score == pytest.approx(np.mean((score - label) ** 2))
    p = np.clip(score, M.LOG_LOSS_EPSILON, 1 - M.LOG_LOSS_EPSILON)
    assert row.log_loss == pytest.approx(-np.mean(np.where(label == 1, np.log(p), np.log(1 - p))))


def test_undefined_values(spark):
    df = spark.createDataFrame([("a", 0, 0.1), ("a", 0, 0.2), ("b", 1, 0.9), ("b", 0, 0.2)], "g string, y long, s double")
    found = {(r.g, r.metric): r.value for r in M.binary_metrics(df, "y", "s", by=["g"], decimals=6).collect()}
    assert found[("a", "roc_auc")] is None and found[("b", "roc_auc")] == 1.0
    assert found[("a", "precision")] == 0.0 and found[("a", "mcc")] == 0.0


def test_multiclass(spark):
    rows = [(0, 0), (0, 1), (1, 1), (2, 2), (2, 2), (2, 0)]
    df = spark.createDataFrame(rows, "a long, p long")
    matrix = {r.actual: (r.predicted_0, r.predicted_1, r.predicted_2) for r in M.confusion_matrix(df, "a", "p", [0, 1, 2]).collect()}
    assert matrix == {"actual_0": (1, 1, 0), "actual_1": (0, 1, 0), "actual_2": (1, 0, 2)}
    report = {r.label: r for r in M.classification_report(df, "a", "p").collect()}
    assert report["2"].precision == 1.0 and report["2"].recall == pytest.approx(2 / 3) and report["2"].support == 3
    assert report["accuracy"].precision == pytest.approx(4 / 6)
    metrics = {r.metric: r.value for r in M.multiclass_metrics(df, "a", "p").collect()}
    assert metrics["balanced_accuracy"] == pytest.approx((0.5 + 1 + 2 / 3) / 3)


def test_gates(spark):
    metrics = spark.createDataFrame([("recall", 0.6), ("other", 0.1)], "metric string, value double")
    rows = [tuple(r) for r in M.apply_gates(metrics, {"recall": 0.6}).collect()]
    assert rows == [("recall", 0.6, 0.6, True)]


def test_drift_detected_and_sorted(spark):
    reference = spark.range(100).select(F.col("id").alias("age"), F.when(F.col("id") < 50, "A").otherwise("B").alias("segment"))
    current = reference.select((F.col("age") + 1000).alias("age"), F.lit("C").alias("segment"))
    report = DataDriftMonitor().compare(reference, current)
    assert not report.passed and set(report.drifted_features) == {"age", "segment"}
    with pytest.raises(ValueError):
        report.raise_for_failure()
    same = DataDriftMonitor().compare(reference, reference)
    assert same.passed and all(r.psi == 0 for r in same.metrics.collect())


def test_psi_value_by_hand(spark):
    reference = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [(None,)], "c string")
    current = spark.createDataFrame([("a",)] * 2 + [("b",)] * 8, "c string")
    psi = DataDriftMonitor().compare(reference, current).metrics.first().psi
    expected = sum((q - p) * math.log(q / p) for p, q in ((0.6, 0.2), (0.3, 0.8), (0.1, 1e-6)))
    assert psi == pytest.approx(expected)


def test_numeric_psi_matches_numpy(spark):
    rng = np.random.default_rng(5)
    ref, cur = rng.normal(size=500), rng.normal(0.3, 1.2, size=300)
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
    edges[0], edges[-1] = -np.inf, np.inf
    p = np.clip(np.histogram(ref, edges)[0] / 500, 1e-6, None)
    q = np.clip(np.histogram(cur, edges)[0] / 300, 1e-6, None)
    frames = [spark.createDataFrame([(float(v),) for v in values], "x double") for values in (ref, cur)]
    psi = DataDriftMonitor().compare(*frames).metrics.first().psi
    assert psi == pytest.approx(float(np.sum((q - p) * np.log(q / p))))


def test_drift_degenerate_and_types(spark):
    reference = spark.createDataFrame([(1.0, None, 1.0, True, 0), (1.0, None, 2.0, False, 1)] * 10,
                                      "k double, m double, x double, flag boolean, two long")
    current = reference.selectExpr("CAST(k AS STRING) AS k", "m", "CAST(NULL AS DOUBLE) AS x", "flag", "two")
    rows = {r.feature: r for r in DataDriftMonitor().compare(reference, current).metrics.collect()}
    assert rows["k"].psi == 0.0 and rows["m"].psi == 0.0 and rows["x"].psi == math.inf
    assert rows["flag"].feature_type == "numeric"
    moved = current.selectExpr("'2' AS k")
    assert DataDriftMonitor().compare(reference, moved).metrics.first().psi == math.inf


def test_drift_checks(spark):
    df = spark.createDataFrame([(1,)], "a long")
    with pytest.raises(ValueError):
        DataDriftMonitor(psi_threshold=0)
    with pytest.raises(ValueError):
        DataDriftMonitor(bins=1)
    with pytest.raises(ValueError):
        DataDriftMonitor().compare(df, df.filter("a > 1"))
    with pytest.raises(ValueError):
        DataDriftMonitor().compare(df, df.toDF("b"))
