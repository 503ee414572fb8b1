"""Classification metrics as aggregations over ``(label, score)``, optionally per subgroup."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import bin_index, clip, safe_ratio
from riskframe.session import local_frame

# --- fixed values ----------------------------------------------------------------------
LOG_LOSS_EPSILON = 2.220446049250313e-16
HOLDOUT_METRICS = (
    "accuracy", "balanced_accuracy", "precision", "recall", "f1", "roc_auc", "avg_precision",
    "mcc", "brier_score", "specificity", "npv", "tn", "fp", "fn", "tp",
)
TRACKED_METRICS = (
    "valid_roc_auc", "valid_avg_precision", "valid_recall",
    "valid_specificity", "valid_mcc", "valid_brier_score",
)
# names used by the model evaluator for the same quantities
EVALUATOR_NAMES = {
    "avg_precision": "average_precision", "npv": "negative_predictive_value",
    "tp": "true_positive", "fp": "false_positive", "fn": "false_negative", "tn": "true_negative",
}

SCORE_BUCKETS = 1000
SPLITTERS = 255


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(safe_ratio(numerator, denominator), F.lit(0.0))


def _long(wide: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    return wide.select(*by, F.inline(entries))


def score_counts(
    df: DataFrame, label: str, score: str, *, by: Sequence[str] = (), positive: object = 1,
    decimals: int | None = None,
) -> DataFrame:
    """``(by…, score, pos, neg)``: the only step that reads every row.

    Partial aggregation combines equal scores before the shuffle. A missing label or score, or a NaN
    score, fails the query. With ``decimals`` the number of
    distinct scores is bounded, 1,000,001 per subgroup for six.
    """
    known = F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    given = F.when(known, F.col(score)).otherwise(F.raise_error(F.lit("labels and scores must not be missing")).cast("double"))
    value = given if decimals is None else F.bround(given, decimals)
    is_positive = (F.col(label) == F.lit(positive)).cast("long")
    return df.groupBy(*by, value.alias("score")).agg(
        F.sum(is_positive).alias("pos"), F.sum(F.lit(1) - is_positive).alias("neg")
    )


def _bucketed(counts: DataFrame, bounded: bool) -> DataFrame:
    """Add a descending score bucket, so that running totals need no single-task window."""
    if bounded:
        return counts.withColumn("bucket", F.floor(F.col("score") * SCORE_BUCKETS))
    grid = F.array(*[F.lit(i / (SPLITTERS + 1)) for i in range(1, SPLITTERS + 1)])
    found = counts.agg(F.percentile_approx("score", grid, 10_000)).first()[0]
    splitters = sorted(set(found)) if found else []
    return counts.withColumn("bucket", bin_index(F.col("score"), splitters))


def running_counts(counts: DataFrame, by: Sequence[str] = (), *, bounded: bool = True) -> DataFrame:
    """Distinct-score counts with running and total counts, from the highest score down.

    Two levels instead of one window over all scores: totals per bucket are accumulated over at
    most about a thousand buckets, then scores are accumulated inside each bucket only.
    """
    keys = list(by)
    bucketed = _bucketed(counts, bounded)
    per_bucket = bucketed.groupBy(*keys, "bucket").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    above = group.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *keys,
        "bucket",
        F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("neg_above"),
        F.sum("bp").over(group).alias("total_pos"),
        F.sum("bn").over(group).alias("total_neg"),
    )
    joined = _join_null_safe(bucketed, offsets, [*keys, "bucket"])
    inside = Window.partitionBy(*keys, "bucket").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return joined.withColumns(
        {
            "cum_pos": F.col("pos_above") + F.sum("pos").over(inside),
            "cum_neg": F.col("neg_above") + F.sum("neg").over(inside),
        }
    )


def _curve_columns() -> list[Column]:
    """ROC area (ties count half) and step-wise average precision over running counts."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    cum_pos = F.col("cum_pos").cast("double")
    total_pos, total_neg = F.col("total_pos").cast("double"), F.col("total_neg").cast("double")
    area = neg * (cum_pos - pos + pos / 2)
    step = safe_ratio(pos, total_pos) * (cum_pos / (cum_pos + F.col("cum_neg")))
    return [
        safe_ratio(F.sum(area), F.max(total_pos * total_neg)).alias("roc_auc"),
        F.sum(step).alias("avg_precision"),
    ]


def ranking_sums(counts: DataFrame, by: Sequence[str] = (), *, bounded: bool = True) -> DataFrame:
    """Per subgroup ``roc_auc`` and ``avg_precision`` from distinct-score counts."""
    return running_counts(counts, by, bounded=bounded).groupBy(*by).agg(*_curve_columns())


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = None
    for k in keys:
        match = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        condition = match if condition is None else condition & match
    return left.join(renamed, condition).drop(*[f"__r_{k}" for k in keys])


def _threshold_columns() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(n).cast("double") for n in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    sensitivity, specificity = safe_ratio(tp, tp + fn), safe_ratio(tn, tn + fp)
    both = F.when(sensitivity.isNotNull() & specificity.isNotNull(), (sensitivity + specificity) / 2)
    denominator = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return {
        "accuracy": safe_ratio(tp + tn, total),
        "balanced_accuracy": F.coalesce(both, sensitivity, specificity),
        "precision": _or_zero(tp, tp + fp),
        "recall": _or_zero(tp, tp + fn),
        "f1": _or_zero(tp * 2, tp * 2 + fp + fn),
        "mcc": _or_zero(tp * tn - fp * fn, denominator),
        "specificity": _or_zero(tn, tn + fp),
        "npv": _or_zero(tn, tn + fn),
    }


def binary_metrics_wide(
    df: DataFrame,
    label: str,
    score: str,
    *,
    threshold: float = 0.5,
    by: Sequence[str] = (),
    positive: object = 1,
    decimals: int | None = None,
) -> DataFrame:
    """One row per subgroup with every binary metric as a column.

    The rows are read once, into counts per distinct score; everything else is computed from
    those counts.
    """
    keys = list(by)
    counts = score_counts(df, label, score, by=keys, positive=positive, decimals=decimals)
    chosen = F.col("score") >= F.lit(threshold)
    pos, neg, value = F.col("pos"), F.col("neg"), F.col("score")
    clipped = clip(value, LOG_LOSS_EPSILON, 1 - LOG_LOSS_EPSILON)
    rows = F.sum(pos + neg)
    sums = running_counts(counts, keys, bounded=decimals is not None).groupBy(*keys).agg(
        rows.alias("rows"),
        F.sum(F.when(chosen, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(chosen, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(chosen, 0).otherwise(pos)).alias("fn"),
        F.sum(F.when(chosen, 0).otherwise(neg)).alias("tn"),
        (F.sum(pos * (value - 1) * (value - 1) + neg * value * value) / rows).alias("brier_score"),
        (-F.sum(pos * F.ln(clipped) + neg * F.ln(1 - clipped)) / rows).alias("log_loss"),
        *_curve_columns(),
    )
    return sums.withColumns(_threshold_columns())


def binary_metrics(
    df: DataFrame,
    label: str,
    score: str,
    *,
    threshold: float = 0.5,
    by: Sequence[str] = (),
    positive: object = 1,
    decimals: int | None = None,
) -> DataFrame:
    """Long form ``(by…, metric, value)``; the ROC area of a one-class subgroup is NULL."""
    wide = binary_metrics_wide(
        df, label, score, threshold=threshold, by=by, positive=positive, decimals=decimals
    )
    return _long(wide, by, (*HOLDOUT_METRICS, "log_loss"))


def split_metrics(df: DataFrame, label: str, score: str, *, split: str = "split", threshold: float = 0.5) -> DataFrame:
    """``(metric, value)`` named ``<split>_<metric>`` and rounded to six digits, all splits in one job."""
    rows = binary_metrics_wide(df, label, score, by=[split], threshold=threshold).collect()
    # rounded like the metric dictionaries, by the binary value; one row per split and metric
    rounded = [
        (f"{row[split]}_{name}", None if row[name] is None else round(float(row[name]), 6))
        for row in rows
        for name in HOLDOUT_METRICS
    ]
    return local_frame(df.sparkSession, rounded, "metric string, value double")


def tracked_metrics(metrics: DataFrame) -> DataFrame:
    """The few validation metrics by which runs are compared."""
    return metrics.filter(F.col("metric").isin(*TRACKED_METRICS))


def threshold_prediction(score: Column, threshold: float, negative: object = 0, positive: object = 1) -> Column:
    return F.when(score >= F.lit(threshold), F.lit(positive)).otherwise(F.lit(negative))


def argmax_class(probabilities: Column, classes: Sequence[object]) -> Column:
    """Label of the largest entry (the first of equal ones) of a probability array."""
    position = F.array_position(probabilities, F.array_max(probabilities)).cast("int")
    return F.element_at(F.array(*[F.lit(c) for c in classes]), position)


def label_pairs(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``(actual, predicted, n)`` for the pairs that occur."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: Sequence[object]) -> DataFrame:
    """One row per actual label, one column ``predicted_<label>`` per predicted label, zeros filled."""
    pairs = label_pairs(df, actual, predicted)
    cells = [
        F.coalesce(F.sum(F.when(F.col("predicted") == F.lit(c), F.col("n"))), F.lit(0)).alias(f"predicted_{c}")
        for c in labels
    ]
    counted = pairs.groupBy("actual").agg(*cells)
    kind = pairs.schema["actual"].dataType.simpleString()
    frame = local_frame(df.sparkSession, [(c,) for c in labels], f"label {kind}")
    names = [f"predicted_{c}" for c in labels]
    return frame.join(counted, F.col("label") == F.col("actual"), "left").select(
        F.concat(F.lit("actual_"), F.col("label").cast("string")).alias("actual"),
        *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names],
    )


def per_class_counts(pairs: DataFrame) -> DataFrame:
    """``(label, tp, support, predicted_n)`` from pair counts, labels of either side."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("label"), hit.alias("tp"), F.col("n").alias("support"),
                         F.lit(0).cast("long").alias("predicted_n")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("tp"),
                         F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted_n")),
            )
        )
    )
    return sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted_n")])


def _with_class_scores(classes: DataFrame) -> DataFrame:
    tp, support, predicted = (F.col(c).cast("double") for c in ("tp", "support", "predicted_n"))
    return classes.withColumns(
        {
            "precision": _or_zero(tp, predicted),
            "recall": _or_zero(tp, support),
            "f1_score": _or_zero(tp * 2, support + predicted),
        }
    )


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``(label, precision, recall, f1_score, support)`` per class, then accuracy and averages."""
    classes = _with_class_scores(per_class_counts(label_pairs(df, actual, predicted)))
    columns = ("precision", "recall", "f1_score")
    rows = classes.select(F.col("label").cast("string").alias("label"), *columns, F.col("support").cast("double"))
    support = F.col("support").cast("double")
    total = F.sum(support)
    accuracy = (F.sum("tp") / total).cast("double")
    summary = classes.agg(
        accuracy.alias("acc"),
        total.alias("total"),
        *[F.avg(c).alias(f"macro_{c}") for c in columns],
        *[(F.sum(F.col(c) * support) / total).alias(f"weighted_{c}") for c in columns],
    )
    # the accuracy row repeats the accuracy in every column, its support included
    lines = F.array(
        F.struct(F.lit("accuracy").alias("label"), *[F.col("acc").alias(c) for c in columns], F.col("acc").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), *[F.col(f"macro_{c}").alias(c) for c in columns], F.col("total").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), *[F.col(f"weighted_{c}").alias(c) for c in columns], F.col("total").alias("support")),
    )
    return rows.unionByName(summary.select(F.inline(lines)))


def multiclass_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``(metric, value)``: accuracy, balanced accuracy, weighted precision/recall/F1, correlation."""
    classes = _with_class_scores(per_class_counts(label_pairs(df, actual, predicted)))
    support, hits, predicted_n = (F.col(c).cast("double") for c in ("support", "tp", "predicted_n"))
    total = F.sum(support)
    wide = classes.agg(
        total.alias("s"),
        F.sum(hits).alias("c"),
        F.avg(F.when(support > 0, F.col("recall"))).alias("balanced_accuracy"),
        *[(F.sum(F.col(name) * support) / total).alias(alias)
          for name, alias in (("precision", "precision"), ("recall", "recall"), ("f1_score", "f1"))],
        F.sum(support * predicted_n).alias("tp_dot"),
        F.sum(support * support).alias("t_sq"),
        F.sum(predicted_n * predicted_n).alias("p_sq"),
    )
    s, c = F.col("s"), F.col("c")
    wide = wide.withColumns(
        {
            "accuracy": c / s,
            "mcc": _or_zero(c * s - F.col("tp_dot"), F.sqrt((s * s - F.col("p_sq")) * (s * s - F.col("t_sq")))),
        }
    )
    return _long(wide, (), ("accuracy", "balanced_accuracy", "precision", "recall", "f1", "mcc"))


def multiclass_score_metrics(
    df: DataFrame, actual: str, probabilities: str, classes: Sequence[object], *, decimals: int | None = None
) -> DataFrame:
    """``(metric, value)``: one-vs-rest ROC area weighted by prevalence, and log loss.

    Each row becomes one row per class; the areas of all classes come from one grouped run.
    """
    entries = F.array(
        *[F.struct(F.lit(i).alias("class_index"), F.element_at(F.col(probabilities), i + 1).alias("p"),
                   (F.col(actual) == F.lit(c)).cast("int").alias("is_class")) for i, c in enumerate(classes)]
    )
    melted = df.select(F.inline(entries))
    counts = score_counts(melted, "is_class", "p", by=["class_index"], decimals=decimals)
    areas = ranking_sums(counts, ["class_index"], bounded=decimals is not None)
    prevalence = counts.groupBy("class_index").agg(F.sum("pos").alias("weight"))
    area = areas.join(prevalence, "class_index").agg(
        F.lit("roc_auc").alias("metric"),
        (F.sum(F.col("roc_auc") * F.col("weight")) / F.sum("weight")).alias("value"),
    )
    true_p = clip(F.col("p"), LOG_LOSS_EPSILON, 1 - LOG_LOSS_EPSILON)
    loss = melted.filter(F.col("is_class") == 1).agg(
        F.lit("log_loss").alias("metric"), (-F.avg(F.ln(true_p))).alias("value")
    )
    return area.unionByName(loss)


def apply_gates(metrics: DataFrame, gates: Mapping[str, float]) -> DataFrame:
    """``(metric, actual, minimum, passed)`` for the gated metrics."""
    minimum = None
    for name, value in gates.items():
        minimum = F.when(F.col("metric") == name, F.lit(float(value))) if minimum is None else minimum.when(
            F.col("metric") == name, F.lit(float(value))
        )
    return (
        metrics.withColumn("minimum", minimum)
        .filter(F.col("minimum").isNotNull())
        .select("metric", F.col("value").alias("actual"), "minimum", (F.col("value") >= F.col("minimum")).alias("passed"))
    )


def compute_binary_holdout_metrics(
    df: DataFrame, label: str, score: str, threshold: float = 0.5, prefix: str = "holdout", decimals: int | None = None,
    positive: object = 1,
) -> dict[str, float]:
    """Prefixed, six-digit metrics of one scored table as a small dictionary; both classes must occur."""
    row = binary_metrics_wide(df, label, score, threshold=threshold, decimals=decimals, positive=positive).first()
    if row is None or not (row["tp"] or row["fn"]) or not (row["tn"] or row["fp"]):
        raise ValueError(f"metrics need rows with and without the label {positive!r}")
    counts = {"tn", "fp", "fn", "tp"}
    return {
        f"{prefix}_{name}": int(row[name]) if name in counts else (None if row[name] is None else round(row[name], 6))
        for name in HOLDOUT_METRICS
    }


def compute_classification_metrics(
    df: DataFrame, label: str, score: str, prefix: str = "train", threshold: float = 0.5
) -> dict[str, float]:
    """Same metrics under a split prefix."""
    return compute_binary_holdout_metrics(df, label, score, threshold, prefix)
