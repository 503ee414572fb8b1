"""Profile A, splits W, metrics E, drift D."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe import DataDriftMonitor, split_dataframe
from riskframe.operators import metrics as M
from riskframe.operators.drift import align_counts, feature_counts, quantile_edges
from riskframe.operators.duplicates import duplicate_row_count
from riskframe.operators.encoding import category_counts, most_frequent, numeric_fill_values, vocabulary
from riskframe.operators.profile import missing_values, numeric_summary, target_distribution
from riskframe.operators.split import (
    IS_TEST,
    assign_splits,
    bernoulli_flag,
    create_train_test_tables,
    flag_stratified,
    split_counts,
    temporal_flag,
)
from riskframe.session import local_frame, scratch_path
from riskframe.sources import read_table, write_table
from workload.catalog import comparable, r, register
from workload.fixtures import SCORE_SQL, patients, scored, table, with_patients


def union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---- profile -------------------------------------------------------------------------------

def _profile_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, {r(f'avg(CAST({c} AS DOUBLE))', 4)} AS mean, "
        f"{r(f'stddev_samp(CAST({c} AS DOUBLE))', 4)} AS std, {r(f'min({c})', 4)} AS min, "
        + ", ".join(f"{r(f'quantile_cont(CAST({c} AS DOUBLE), {p})', 4)} AS {n}" for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)))
        + f", {r(f'max({c})', 4)} AS max FROM {source}"
        for c in columns
    )


PATIENT_NUMBERS = ["age", "glucose_fasting", "bmi", "systolic_bp", "triglycerides", "hba1c"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("a6_numeric_summary", with_patients(_profile_sql("patients", PATIENT_NUMBERS)))
def a6(spark, sf_dir):
    return comparable(numeric_summary(patients(spark, sf_dir), PATIENT_NUMBERS), 4)


@register("a6_numeric_summary_lineitem", _profile_sql("lineitem", LINE_NUMBERS))
def a6_lineitem(spark, sf_dir):
    return comparable(numeric_summary(table(spark, sf_dir, "lineitem"), LINE_NUMBERS), 4)


LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@register("a6_numeric_summary_lineitem_all", _profile_sql("lineitem", LINE_KEYS + LINE_NUMBERS))
def a6_lineitem_all(spark, sf_dir):
    """Every number of the table, as the summary finds them itself."""
    return comparable(numeric_summary(table(spark, sf_dir, "lineitem")), 4)


@register("a6_numeric_summary_events", _profile_sql("events", ["value"]))
def a6_events(spark, sf_dir):
    return comparable(numeric_summary(table(spark, sf_dir, "events"), ["value"]), 4)


@register(
    "a1_size",
    "SELECT count(*) AS row_count, CAST(3 AS BIGINT) AS column_count FROM lineitem",
)
def a1(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    return df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).cast("long").alias("column_count"))


@register(
    "a2_duplicate_rows",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_quantity)",
)
def a2(spark, sf_dir):
    count = duplicate_row_count(table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity"))
    return local_frame(spark, [(count,)], "duplicate_rows long")


@register(
    "a4_missing_values",
    with_patients(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count(*) AS \"rows\" FROM patients"
            for c in ("age", "glucose_fasting", "bmi", "gender", "encounter_ts")
        )
    ),
)
def a4(spark, sf_dir):
    return missing_values(patients(spark, sf_dir).select("age", "glucose_fasting", "bmi", "gender", "encounter_ts"))


@register(
    "a5_target_distribution",
    "SELECT l.quality AS quality, count(*) AS \"rows\" FROM documents d LEFT JOIN (SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM labels) l ON d.doc_id = l.doc_id GROUP BY 1",
)
def a5(spark, sf_dir):
    """Unlabelled documents form the missing group."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"))
    joined = table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left")
    return target_distribution(joined, "quality")


@register("t6_class_counts", with_patients("SELECT diagnosed_diabetes, count(*) AS \"rows\" FROM patients GROUP BY 1"))
def t6(spark, sf_dir):
    return target_distribution(patients(spark, sf_dir), "diagnosed_diabetes").orderBy("diagnosed_diabetes")


@register(
    "a9_class_check",
    with_patients(
        "SELECT count(DISTINCT diagnosed_diabetes) AS classes, count(*) - count(diagnosed_diabetes) AS missing FROM patients"
    ),
)
def a9(spark, sf_dir):
    target = F.col("diagnosed_diabetes")
    return patients(spark, sf_dir).agg(
        F.count_distinct(target).alias("classes"), (F.count("*") - F.count(target)).alias("missing")
    )


# ---- imputer statistics and vocabulary -----------------------------------------------------

NUMERIC = ["glucose_fasting", "bmi", "age"]
CATEGORICAL = ["gender", "employment_status", "smoking_status", "income_level"]


def _statistic(strategy: str, sql: str) -> None:
    @register(
        f"a10_impute_{strategy}",
        with_patients(" UNION ALL ".join(f"SELECT '{c}' AS feature, {r(sql.format(c=c))} AS value FROM patients" for c in NUMERIC)),
    )
    def query(spark, sf_dir):
        values = numeric_fill_values(patients(spark, sf_dir), NUMERIC, strategy)
        return comparable(local_frame(spark, list(values.items()), "feature string, value double"))


_statistic("median", "quantile_cont(CAST({c} AS DOUBLE), 0.5)")
_statistic("mean", "avg(CAST({c} AS DOUBLE))")


@register(
    "a10_most_frequent",
    with_patients(
        " UNION ALL ".join(
            f"(SELECT '{c}' AS feature, {c} AS value FROM patients WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
            for c in CATEGORICAL
        )
    ),
)
def a10_mode(spark, sf_dir):
    return most_frequent(category_counts(patients(spark, sf_dir), CATEGORICAL))


@register(
    "a11_vocabulary",
    with_patients(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {c} AS value, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM patients WHERE {c} IS NOT NULL)"
            for c in CATEGORICAL
        )
    ),
)
def a11(spark, sf_dir):
    return comparable(vocabulary(patients(spark, sf_dir), CATEGORICAL))


# ---- splits --------------------------------------------------------------------------------

def _hash(seed: int, id_sql: str) -> str:
    return f"md5(concat('{seed}:', CAST({id_sql} AS VARCHAR)))"


def _stratified_sql(source: str, ids: str, target: str, size: float) -> str:
    return (
        f"SELECT {ids}, {target}, rn <= CASE WHEN n <= 1 THEN 0 ELSE least(n - 1, greatest(1, floor(n * {size}))) END AS is_test FROM ("
        f"SELECT {ids}, {target}, count(*) OVER (PARTITION BY {target}) AS n, "
        f"row_number() OVER (PARTITION BY {target} ORDER BY {_hash(42, ids)}) AS rn FROM {source})"
    )


@register("w1_stratified_split", with_patients(_stratified_sql("patients", "patient_id", "diagnosed_diabetes", 0.2)))
def w1(spark, sf_dir):
    flagged, _ = flag_stratified(patients(spark, sf_dir), "diagnosed_diabetes", 0.2, 42, ["patient_id"])
    return flagged.select("patient_id", "diagnosed_diabetes", F.col(IS_TEST).alias("is_test"))


@register("w1_stratified_split_orders", _stratified_sql("orders", "o_orderkey", "o_orderpriority", 0.25))
def w1_orders(spark, sf_dir):
    flagged, _ = flag_stratified(table(spark, sf_dir, "orders"), "o_orderpriority", 0.25, 42, ["o_orderkey"])
    return flagged.select("o_orderkey", "o_orderpriority", F.col(IS_TEST).alias("is_test"))


@register(
    "w1_stratified_split_order_classes",
    "SELECT l_orderkey, l_linenumber, rn <= CASE WHEN n <= 1 THEN 0 ELSE least(n - 1, greatest(1, floor(n * 0.4))) END AS is_test FROM ("
    "SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey "
    "ORDER BY md5(concat('42:', l_orderkey, '|', l_linenumber))) AS rn FROM lineitem)",
)
def w1_order_classes(spark, sf_dir):
    """Every order is a class: the number of classes grows with the table."""
    lines = table(spark, sf_dir, "lineitem")
    flagged, _ = flag_stratified(lines, "l_orderkey", 0.4, 42, ["l_orderkey", "l_linenumber"])
    return flagged.select("l_orderkey", "l_linenumber", F.col(IS_TEST).alias("is_test"))


@register("w2_random_split", f"SELECT o_orderkey, substr({_hash(42, 'o_orderkey')}, 1, 8) < '33333333' AS is_test FROM orders")
def w2(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", bernoulli_flag(orders, 0.2, 42, ["o_orderkey"]).alias("is_test"))


_SPLIT_CTE = with_patients("") + f", s AS ({_stratified_sql('patients', 'patient_id', 'diagnosed_diabetes', 0.2)}) "


@register("a8_split_counts", _SPLIT_CTE + "SELECT is_test, diagnosed_diabetes AS target, count(*) AS \"rows\" FROM s GROUP BY 1, 2")
def a8(spark, sf_dir):
    flagged, _ = flag_stratified(patients(spark, sf_dir), "diagnosed_diabetes", 0.2, 42, ["patient_id"])
    return split_counts(flagged, "diagnosed_diabetes")


@register("u2_train_complement", _SPLIT_CTE + "SELECT patient_id FROM s WHERE NOT is_test")
def u2(spark, sf_dir):
    result = split_dataframe(patients(spark, sf_dir), "diagnosed_diabetes", id_columns=["patient_id"])
    return result.train_df.select("patient_id")


@register("p12_test_rows", _SPLIT_CTE + "SELECT patient_id FROM s WHERE is_test")
def p12(spark, sf_dir):
    result = split_dataframe(patients(spark, sf_dir), "diagnosed_diabetes", id_columns=["patient_id"])
    return result.test_df.select("patient_id")


@register(
    "w3_split_tables",
    _SPLIT_CTE + "SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS part, diagnosed_diabetes, count(*) AS \"rows\" FROM s GROUP BY 1, 2",
)
def w3(spark, sf_dir):
    base = scratch_path(spark, "w3")
    write_table(patients(spark, sf_dir).select("patient_id", "bmi", "diagnosed_diabetes"), f"{base}/source")
    create_train_test_tables(
        f"{base}/source", f"{base}/train", f"{base}/test", "diagnosed_diabetes", spark=spark, id_columns=["patient_id"]
    )
    parts = union([read_table(spark, f"{base}/{p}").withColumn("part", F.lit(p)) for p in ("train", "test")])
    return parts.groupBy("part", "diagnosed_diabetes").agg(F.count("*").alias("rows"))


@register(
    "w4_temporal_split",
    f"SELECT o_orderkey, rn > CAST(floor(n * (1 - CAST(0.2 AS DOUBLE))) AS BIGINT) AS is_test FROM (SELECT o_orderkey, count(*) OVER () AS n, "
    f"row_number() OVER (ORDER BY o_orderdate, {_hash(42, 'o_orderkey')}) AS rn FROM orders)",
)
def w4(spark, sf_dir):
    flagged = temporal_flag(table(spark, sf_dir, "orders"), "o_orderdate", 0.2, 42, ["o_orderkey"])
    return flagged.select("o_orderkey", F.col(IS_TEST).alias("is_test"))


@register(
    "w4_temporal_split_events",
    f"SELECT event_id, rn > CAST(floor(n * (1 - CAST(0.3 AS DOUBLE))) AS BIGINT) AS is_test FROM (SELECT event_id, count(*) OVER () AS n, "
    f"row_number() OVER (ORDER BY ts, {_hash(42, 'event_id')}) AS rn FROM events)",
)
def w4_events(spark, sf_dir):
    flagged = temporal_flag(table(spark, sf_dir, "events"), "ts", 0.3, 42, ["event_id"])
    return flagged.select("event_id", F.col(IS_TEST).alias("is_test"))


def _quota(n: str, size: float) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0 ELSE least({n} - 1, greatest(1, floor({n} * {size}))) END"


@register(
    "w5_three_way_split",
    _SPLIT_CTE
    + ", t AS (SELECT patient_id, diagnosed_diabetes, count(*) OVER (PARTITION BY diagnosed_diabetes) AS n, "
    + f"row_number() OVER (PARTITION BY diagnosed_diabetes ORDER BY {_hash(43, 'patient_id')}) AS rn FROM s WHERE NOT is_test) "
    + "SELECT patient_id, 'test' AS split FROM s WHERE is_test UNION ALL "
    + f"SELECT patient_id, CASE WHEN rn <= {_quota('n', 0.25)} THEN 'valid' ELSE 'train' END FROM t",
)
def w5(spark, sf_dir):
    assigned = assign_splits(
        patients(spark, sf_dir).select("patient_id", "diagnosed_diabetes"), target="diagnosed_diabetes", test_size=0.2,
        validation_size=0.25, id_columns=["patient_id"],
    )
    return assigned.select("patient_id", "split")


# ---- metrics -------------------------------------------------------------------------------

SCORED = f"scored AS (SELECT patient_id, gender, age, diagnosed_diabetes AS label, {SCORE_SQL} AS score FROM patients)"
COUNTS = (
    "count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp, "
    "count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn, count(*) FILTER (WHERE score < 0.5 AND label = 0) AS tn"
)
RATES = {
    "accuracy": "(tp + tn) * 1.0 / (tp + fp + fn + tn)",
    "balanced_accuracy": "CASE WHEN tp + fn > 0 AND tn + fp > 0 THEN (CAST(tp AS DOUBLE) / nullif(tp + fn, 0) + CAST(tn AS DOUBLE) / nullif(tn + fp, 0)) / 2 "
                         "ELSE coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), CAST(tn AS DOUBLE) / nullif(tn + fp, 0)) END",
    "precision": "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)",
    "f1": "coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0)",
    "mcc": "coalesce((CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / nullif(sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0)",
    "specificity": "coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0)",
    "npv": "coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0)",
    "tp": "tp", "fp": "fp", "fn": "fn", "tn": "tn",
}


def _curve_sql(group: str) -> str:
    """ROC area and average precision per group over distinct scores."""
    part = f"PARTITION BY {group} " if group else ""
    by = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return (
        f"g AS (SELECT {by}score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM base GROUP BY {by}score), "
        f"w AS (SELECT *, sum(pos) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp, "
        f"sum(neg) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn, "
        f"sum(pos) OVER ({part}) AS tpos, sum(neg) OVER ({part}) AS tneg FROM g), "
        f"curve AS (SELECT {by}sum(CAST(neg AS DOUBLE) * (cp - pos + pos / 2.0)) / nullif(max(CAST(tpos AS DOUBLE) * tneg), 0) AS roc_auc, "
        f"sum(CAST(pos AS DOUBLE) / nullif(tpos, 0) * cp / (cp + cn)) AS avg_precision FROM w{tail})"
    )


def _metrics_sql(prefix: str, group: str, group_alias: str | None = None) -> str:
    by = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    join = f"c.{group} IS NOT DISTINCT FROM k.{group}" if group else "true"
    values = {
        **RATES,
        "roc_auc": "roc_auc",
        "avg_precision": "avg_precision",
        "brier_score": "brier",
        "log_loss": "logloss",
    }
    select = " UNION ALL ".join(
        f"SELECT {f'{group} AS {group_alias or group}, ' if group else ''}'{n}' AS metric, {r(e)} AS value FROM m" for n, e in values.items()
    )
    return (
        prefix + _curve_sql(group)
        + f", k0 AS (SELECT {by}{COUNTS}, avg((score - label) * (score - label)) AS brier, "
        "-avg(CASE WHEN label = 1 THEN ln(greatest(score, 2.220446049250313e-16)) ELSE ln(1 - least(score, 1 - 2.220446049250313e-16)) END) AS logloss "
        f"FROM base{tail}), "
        f"m AS (SELECT k.*, c.roc_auc, c.avg_precision FROM k0 k JOIN curve c ON {join}) "
        + select
    )


_PATIENT_SCORES = with_patients("") + f", {SCORED}, base AS (SELECT * FROM scored), "


@register("e4_binary_metrics", _metrics_sql(_PATIENT_SCORES, ""))
def e4(spark, sf_dir):
    """E1, E4-E11, E13-E16 in one long table."""
    return comparable(M.binary_metrics(scored(spark, sf_dir), "label", "score", decimals=6))


@register("e4_binary_metrics_by_group", _metrics_sql(_PATIENT_SCORES, "gender"))
def e4_by(spark, sf_dir):
    return comparable(M.binary_metrics(scored(spark, sf_dir), "label", "score", by=["gender"], decimals=6))


_DOC_SCORES = (
    "WITH base AS (SELECT CAST(l.toxic AS BIGINT) AS label, CAST((d.doc_id * 7919 % 1000) / 1000.0 AS DOUBLE) AS score, d.lang AS lang "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id), "
)


def _doc_scores(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("long").alias("label"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.join(labels, "doc_id").select(
        "label", "lang", ((F.col("doc_id") * 7919 % 1000) / F.lit(1000.0)).alias("score")
    )


@register("e4_binary_metrics_documents", _metrics_sql(_DOC_SCORES, "lang"))
def e4_documents(spark, sf_dir):
    """Unrounded scores: running totals over equi-depth score ranges."""
    return comparable(M.binary_metrics(_doc_scores(spark, sf_dir), "label", "score", by=["lang"]))


@register("e1_threshold_prediction", with_patients("") + f", {SCORED} SELECT patient_id, CAST(CASE WHEN score >= 0.7 THEN 1 ELSE 0 END AS BIGINT) AS predicted FROM scored")
def e1(spark, sf_dir):
    return comparable(scored(spark, sf_dir).select("patient_id", M.threshold_prediction(F.col("score"), 0.7).alias("predicted")))


@register("e11_roc_auc", with_patients("") + f", {SCORED}, base AS (SELECT * FROM scored), {_curve_sql('')} SELECT {r('roc_auc')} AS roc_auc, {r('avg_precision')} AS avg_precision FROM curve")
def e11(spark, sf_dir):
    counts = M.score_counts(scored(spark, sf_dir), "label", "score", decimals=6)
    return comparable(M.ranking_sums(counts))


_SPLIT_OF = "CASE WHEN patient_id % 5 = 0 THEN 'test' WHEN patient_id % 5 = 1 THEN 'valid' ELSE 'train' END"
_SPLIT_SCORES = (
    with_patients("") + f", {SCORED}, base AS (SELECT *, {_SPLIT_OF} AS split FROM scored), "
)
def _split_scored(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("split", F.expr(_SPLIT_OF))


def _nested(sql: str, outer: str) -> str:
    """Wrap the final SELECT of a CTE chain."""
    head, tail = sql.rsplit("FROM k0 k JOIN curve c ON c.split IS NOT DISTINCT FROM k.split) ", 1)
    return f"{head}FROM k0 k JOIN curve c ON c.split IS NOT DISTINCT FROM k.split), long AS ({tail}) {outer}"


@register(
    "e17_split_metrics",
    _nested(_metrics_sql(_SPLIT_SCORES, "split"), "SELECT concat(split, '_', metric) AS metric, value FROM long WHERE metric <> 'log_loss'"),
)
def e17(spark, sf_dir):
    return comparable(M.split_metrics(_split_scored(spark, sf_dir), "label", "score"))


@register(
    "e22_tracked_metrics",
    _nested(
        _metrics_sql(_SPLIT_SCORES, "split"),
        "SELECT concat(split, '_', metric) AS metric, value FROM long WHERE split = 'valid' AND metric IN "
        "('roc_auc', 'avg_precision', 'recall', 'specificity', 'mcc', 'brier_score')",
    ),
)
def e22(spark, sf_dir):
    return comparable(M.tracked_metrics(M.split_metrics(_split_scored(spark, sf_dir), "label", "score")))


@register(
    "e20_quality_gates",
    _nested(
        _metrics_sql(_SPLIT_SCORES, "split"),
        "SELECT concat(split, '_', metric) AS metric, value AS actual, CASE metric WHEN 'roc_auc' THEN CAST(0.7 AS DOUBLE) ELSE CAST(0.99 AS DOUBLE) END AS minimum, "
        "value >= CASE metric WHEN 'roc_auc' THEN CAST(0.7 AS DOUBLE) ELSE CAST(0.99 AS DOUBLE) END AS passed FROM long WHERE split = 'test' AND metric IN ('roc_auc', 'recall')",
    ),
)
def e20(spark, sf_dir):
    metrics = M.split_metrics(_split_scored(spark, sf_dir), "label", "score")
    return comparable(M.apply_gates(metrics, {"test_roc_auc": 0.7, "test_recall": 0.99}))


# multiclass: three priority classes with a deterministic prediction
CLASS_SQL = (
    "cls AS (SELECT o_orderkey, CAST(o_orderkey % 3 AS BIGINT) AS actual, "
    "CAST(CASE WHEN o_orderkey % 10 < 7 THEN o_orderkey % 3 ELSE (o_orderkey + 1) % 3 END AS BIGINT) AS predicted FROM orders)"
)


def _classes(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (key % 3).cast("long").alias("actual"),
        F.when(key % 10 < 7, key % 3).otherwise((key + 1) % 3).cast("long").alias("predicted"),
    )


@register(
    "e3_confusion_matrix",
    f"WITH {CLASS_SQL} SELECT concat('actual_', actual) AS actual, "
    + ", ".join(f"count(*) FILTER (WHERE predicted = {c}) AS predicted_{c}" for c in range(3))
    + " FROM cls GROUP BY 1",
)
def e3(spark, sf_dir):
    return M.confusion_matrix(_classes(spark, sf_dir), "actual", "predicted", [0, 1, 2])


_CLASS_STATS = (
    f"WITH {CLASS_SQL}, k AS (SELECT l AS label, count(*) FILTER (WHERE actual = l AND predicted = l) AS tp, "
    "count(*) FILTER (WHERE actual = l) AS support, count(*) FILTER (WHERE predicted = l) AS predicted_n "
    "FROM cls, (SELECT DISTINCT actual AS l FROM cls) GROUP BY l), "
    "s AS (SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(predicted_n, 0), 0) AS p, coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0) AS rc, "
    "coalesce(CAST(2 * tp AS DOUBLE) / nullif(predicted_n + support, 0), 0) AS f FROM k) "
)


@register(
    "e18_classification_report",
    _CLASS_STATS
    + f"SELECT CAST(label AS VARCHAR) AS label, {r('p')} AS precision, {r('rc')} AS recall, {r('f')} AS f1_score, {r('support')} AS support FROM s "
    + f"UNION ALL SELECT 'accuracy', {r('sum(tp) * 1.0 / sum(support)')}, {r('sum(tp) * 1.0 / sum(support)')}, {r('sum(tp) * 1.0 / sum(support)')}, {r('sum(tp) * 1.0 / sum(support)')} FROM s "
    + f"UNION ALL SELECT 'macro avg', {r('avg(p)')}, {r('avg(rc)')}, {r('avg(f)')}, {r('sum(support)')} FROM s "
    + f"UNION ALL SELECT 'weighted avg', {r('sum(p * support) / sum(support)')}, {r('sum(rc * support) / sum(support)')}, {r('sum(f * support) / sum(support)')}, {r('sum(support)')} FROM s",
)
def e18(spark, sf_dir):
    return comparable(M.classification_report(_classes(spark, sf_dir), "actual", "predicted"))


@register(
    "e10_multiclass_metrics",
    _CLASS_STATS
    + f"SELECT 'accuracy' AS metric, {r('sum(tp) * 1.0 / sum(support)')} AS value FROM s "
    + f"UNION ALL SELECT 'balanced_accuracy', {r('avg(rc)')} FROM s UNION ALL SELECT 'precision', {r('sum(p * support) / sum(support)')} FROM s "
    + f"UNION ALL SELECT 'recall', {r('sum(rc * support) / sum(support)')} FROM s UNION ALL SELECT 'f1', {r('sum(f * support) / sum(support)')} FROM s "
    + "UNION ALL SELECT 'mcc', " + r(
        "(CAST(sum(tp) AS DOUBLE) * sum(support) - sum(CAST(support AS DOUBLE) * predicted_n)) / "
        "sqrt((CAST(sum(support) AS DOUBLE) * sum(support) - sum(CAST(predicted_n AS DOUBLE) * predicted_n)) * "
        "(CAST(sum(support) AS DOUBLE) * sum(support) - sum(CAST(support AS DOUBLE) * support)))"
    ) + " FROM s",
)
def e10(spark, sf_dir):
    return comparable(M.multiclass_metrics(_classes(spark, sf_dir), "actual", "predicted"))


PROBABILITY_SQL = [
    "CAST((o_orderkey * 7 % 50 + CASE WHEN o_orderkey % 3 = 0 THEN 25 ELSE 0 END) AS DOUBLE)",
    "CAST((o_orderkey * 11 % 50 + CASE WHEN o_orderkey % 3 = 1 THEN 25 ELSE 0 END) AS DOUBLE)",
    "CAST((o_orderkey * 13 % 50 + CASE WHEN o_orderkey % 3 = 2 THEN 25 ELSE 0 END + 1) AS DOUBLE)",
]
_PROBS = (
    f"w AS (SELECT o_orderkey, CAST(o_orderkey % 3 AS BIGINT) AS actual, {', '.join(f'{e} AS w{i}' for i, e in enumerate(PROBABILITY_SQL))} FROM orders), "
    "p AS (SELECT o_orderkey, actual, " + ", ".join(f"w{i} / (w0 + w1 + w2) AS p{i}" for i in range(3)) + " FROM w)"
)


def _probabilities(spark, sf_dir):
    weights = [F.expr(e) for e in PROBABILITY_SQL]
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 3).cast("long").alias("actual"), F.array(*weights).alias("w")
    )
    total = F.col("w")[0] + F.col("w")[1] + F.col("w")[2]
    return df.select("o_orderkey", "actual", F.array(*[F.col("w")[i] / total for i in range(3)]).alias("p"))


@register(
    "e2_argmax_class",
    f"WITH {_PROBS} SELECT o_orderkey, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 'a' WHEN p1 >= p2 THEN 'b' ELSE 'c' END AS predicted FROM p",
)
def e2(spark, sf_dir):
    return _probabilities(spark, sf_dir).select("o_orderkey", M.argmax_class(F.col("p"), ["a", "b", "c"]).alias("predicted"))


def _ovr(c: int) -> str:
    return (
        f"(SELECT count(*) FILTER (WHERE actual = {c}) AS weight, sum(CASE WHEN actual = {c} THEN rk END) AS ranks, count(*) AS n "
        f"FROM (SELECT actual, rank() OVER (ORDER BY p{c}) + (count(*) OVER (PARTITION BY p{c}) - 1) / 2.0 AS rk FROM p))"
    )


@register(
    "e12_multiclass_auc",
    f"WITH {_PROBS}, o AS (" + " UNION ALL ".join(f"SELECT * FROM {_ovr(c)}" for c in range(3)) + "), "
    "a AS (SELECT weight, (ranks - weight * (weight + 1) / 2.0) / (CAST(weight AS DOUBLE) * (n - weight)) AS auc FROM o) "
    + f"SELECT 'roc_auc' AS metric, {r('sum(auc * weight) / sum(weight)')} AS value FROM a UNION ALL "
    + f"SELECT 'log_loss', {r('-avg(ln(greatest(CASE actual WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 2.220446049250313e-16)))')} FROM p",
)
def e12(spark, sf_dir):
    return comparable(M.multiclass_score_metrics(_probabilities(spark, sf_dir), "actual", "p", [0, 1, 2]))


@register(
    "e19_prediction_frame",
    with_patients("") + f", {SCORED} SELECT label AS actual, CAST(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS predicted, {r('score')} AS probability FROM scored",
)
def e19(spark, sf_dir):
    return comparable(
        scored(spark, sf_dir).select(
            F.col("label").alias("actual"), M.threshold_prediction(F.col("score"), 0.5).alias("predicted"), F.col("score").alias("probability")
        )
    )


# ---- drift ---------------------------------------------------------------------------------

PROBS = "[" + ", ".join(f"CAST({i / 10} AS DOUBLE)" for i in range(11)) + "]"


def _psi_numeric(name: str, ref: str, cur: str) -> str:
    """PSI of one numeric column between two tables, with ten reference quantile bins."""
    bins = f"len(list_filter(e.inner_edges, lambda x: x <= v))"
    return (
        f"(WITH q AS (SELECT list_sort(list_distinct(quantile_cont(CAST({name} AS DOUBLE), {PROBS}))) AS edges FROM {ref}), "
        "e AS (SELECT edges[2:len(edges) - 1] AS inner_edges FROM q), "
        f"rb AS (SELECT {bins} AS b, count(*) AS n FROM (SELECT CAST({name} AS DOUBLE) AS v FROM {ref} WHERE {name} IS NOT NULL), e GROUP BY 1), "
        f"cb AS (SELECT {bins} AS b, count(*) AS n FROM (SELECT CAST({name} AS DOUBLE) AS v FROM {cur} WHERE {name} IS NOT NULL), e GROUP BY 1), "
        "j AS (SELECT greatest(coalesce(rb.n, 0) / (SELECT sum(n) FROM rb), 1e-6) AS p, greatest(coalesce(cb.n, 0) / (SELECT sum(n) FROM cb), 1e-6) AS q "
        "FROM rb FULL OUTER JOIN cb ON rb.b = cb.b) SELECT sum((q - p) * ln(q / p)) FROM j)"
    )


def _psi_categorical(name: str, ref: str, cur: str) -> str:
    value = f"coalesce(CAST({name} AS VARCHAR), '__MISSING__')"
    return (
        f"(WITH rb AS (SELECT {value} AS b, count(*) AS n FROM {ref} GROUP BY 1), cb AS (SELECT {value} AS b, count(*) AS n FROM {cur} GROUP BY 1), "
        "j AS (SELECT greatest(coalesce(rb.n, 0) / (SELECT sum(n) FROM rb), 1e-6) AS p, greatest(coalesce(cb.n, 0) / (SELECT sum(n) FROM cb), 1e-6) AS q "
        "FROM rb FULL OUTER JOIN cb ON rb.b = cb.b) SELECT sum((q - p) * ln(q / p)) FROM j)"
    )


def _psi_report(head: str, ref: str, cur: str, numeric: list[str], categorical: list[str]) -> str:
    rows = [(c, "numeric", _psi_numeric(c, ref, cur)) for c in numeric] + [(c, "categorical", _psi_categorical(c, ref, cur)) for c in categorical]
    return head + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, '{k}' AS feature_type, {r(sql)} AS psi, {sql} >= CAST(0.2 AS DOUBLE) AS drift_detected, "
        f"(SELECT count(*) FROM {ref}) AS reference_rows, (SELECT count(*) FROM {cur}) AS current_rows"
        for c, k, sql in rows
    )


DRIFT_NUMERIC = ["age", "bmi", "glucose_fasting", "hdl_cholesterol"]
DRIFT_CATEGORICAL = ["gender", "smoking_status"]
_DRIFT_COLUMNS = DRIFT_NUMERIC + DRIFT_CATEGORICAL
_DRIFT_HEAD = with_patients("") + (
    f", ref AS (SELECT {', '.join(_DRIFT_COLUMNS)} FROM patients WHERE encounter_ts < TIMESTAMP '1998-01-01'), "
    f"cur AS (SELECT {', '.join('bmi + 5 AS bmi' if c == 'bmi' else c for c in _DRIFT_COLUMNS)} FROM patients WHERE encounter_ts >= TIMESTAMP '1998-01-01') "
)


def _drift_sides(spark, sf_dir):
    df = patients(spark, sf_dir)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    before = df.filter(F.col("encounter_ts") < cut).select(*_DRIFT_COLUMNS)
    after = df.filter(F.col("encounter_ts") >= cut).withColumn("bmi", F.col("bmi") + 5).select(*_DRIFT_COLUMNS)
    return before, after


@register("d7_drift_report", _psi_report(_DRIFT_HEAD, "ref", "cur", DRIFT_NUMERIC, DRIFT_CATEGORICAL))
def d7(spark, sf_dir):
    before, after = _drift_sides(spark, sf_dir)
    return comparable(DataDriftMonitor().compare(before, after).metrics)


_EVENT_HEAD = (
    "WITH ref AS (SELECT value, event_type FROM events WHERE event_id % 2 = 0), "
    "cur AS (SELECT value * 2 AS value, CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS event_type FROM events WHERE event_id % 2 = 1) "
)


@register("d7_drift_report_events", _psi_report(_EVENT_HEAD, "ref", "cur", ["value"], ["event_type"]))
def d7_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    before = events.filter(F.col("event_id") % 2 == 0).select("value", "event_type")
    after = events.filter(F.col("event_id") % 2 == 1).select(
        (F.col("value") * 2).alias("value"), F.when(F.col("event_type") != "click", F.col("event_type")).alias("event_type")
    )
    return comparable(DataDriftMonitor().compare(before, after).metrics)


_LINE_HEAD = (
    "WITH ref AS (SELECT l_quantity, l_extendedprice, l_discount, l_returnflag FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01'), "
    "cur AS (SELECT l_quantity, l_extendedprice, l_discount, l_returnflag FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01') "
)


@register("d7_drift_report_lineitem", _psi_report(_LINE_HEAD, "ref", "cur", ["l_quantity", "l_extendedprice", "l_discount"], ["l_returnflag"]))
def d7_lineitem(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag"]
    return comparable(
        DataDriftMonitor().compare(
            lines.filter(F.col("l_shipdate") < cut).select(*columns), lines.filter(F.col("l_shipdate") >= cut).select(*columns)
        ).metrics
    )


@register(
    "d2_quantile_edges",
    with_patients(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {r('edge')} AS edge FROM (SELECT unnest(list_distinct(quantile_cont(CAST({c} AS DOUBLE), {PROBS}))) AS edge FROM patients)"
            for c in ("bmi", "age", "family_history_diabetes")
        )
    ),
)
def d2(spark, sf_dir):
    columns = ["bmi", "age", "family_history_diabetes"]
    edges = quantile_edges(patients(spark, sf_dir), columns, 10)
    rows = [(c, float(e)) for c in columns for e in edges[c]]
    return comparable(local_frame(spark, rows, "feature string, edge double"))


@register(
    "d3_histogram",
    f"WITH q AS (SELECT list_sort(list_distinct(quantile_cont(l_extendedprice, {PROBS}))) AS edges FROM lineitem), e AS (SELECT edges[2:len(edges) - 1] AS inner_edges FROM q) "
    "SELECT CAST(len(list_filter(e.inner_edges, lambda x: x <= l_extendedprice)) AS BIGINT) AS bin, count(*) AS n FROM lineitem, e GROUP BY 1",
)
def d3(spark, sf_dir):
    """J3: values to bins by edges."""
    lines = table(spark, sf_dir, "lineitem").select("l_extendedprice")
    edges = quantile_edges(lines, ["l_extendedprice"], 10)
    return comparable(feature_counts(lines, ["l_extendedprice"], edges).select("bin", "n"))


@register(
    "j2_align_categories",
    "SELECT category, CAST(sum(r) AS BIGINT) AS reference_n, CAST(sum(c) AS BIGINT) AS current_n FROM ("
    "SELECT event_type AS category, count(*) AS r, 0 AS c FROM events WHERE event_id % 3 = 0 AND event_type <> 'view' GROUP BY 1 UNION ALL "
    "SELECT event_type, 0, count(*) FROM events WHERE event_id % 3 <> 0 AND event_type <> 'click' GROUP BY 1) GROUP BY 1",
)
def j2(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("category"))
    sides = [
        events.filter((F.col("event_id") % 3 == 0) & (F.col("category") != "view")),
        events.filter((F.col("event_id") % 3 != 0) & (F.col("category") != "click")),
    ]
    counts = [s.groupBy("category").agg(F.count("*").alias("n")) for s in sides]
    return align_counts(counts[0], counts[1], ["category"])


@register(
    "d4_degenerate_features",
    "SELECT 'constant_moved' AS feature, CAST('Infinity' AS DOUBLE) AS psi, true AS drift_detected UNION ALL "
    "SELECT 'constant_same', CAST(0 AS DOUBLE), false UNION ALL SELECT 'all_missing', CAST(0 AS DOUBLE), false UNION ALL "
    "SELECT 'one_side_missing', CAST('Infinity' AS DOUBLE), true UNION ALL SELECT 'two_valued', CAST(0 AS DOUBLE), false",
)
def d4(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    nothing = F.lit(None).cast("double")

    def side(value: float, missing) -> DataFrame:
        return orders.select(
            F.lit(value).alias("constant_moved"), F.lit(1.0).alias("constant_same"), nothing.alias("all_missing"),
            missing.alias("one_side_missing"), (F.col("o_orderkey") % 10 == 0).cast("long").alias("two_valued"),
        )

    report = DataDriftMonitor().compare(side(1.0, F.col("o_totalprice")), side(2.0, nothing))
    return report.metrics.select("feature", "psi", "drift_detected")


@register(
    "t1_strongest_drift",
    "SELECT feature, feature_type FROM (" + _psi_report(_DRIFT_HEAD, "ref", "cur", DRIFT_NUMERIC, DRIFT_CATEGORICAL) + ") ORDER BY psi DESC, feature LIMIT 1",
)
def t1(spark, sf_dir):
    before, after = _drift_sides(spark, sf_dir)
    return DataDriftMonitor().compare(before, after).metrics.orderBy(F.desc("psi"), "feature").limit(1).select("feature", "feature_type")
