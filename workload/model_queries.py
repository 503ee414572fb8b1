"""Encoding and models M, attribution X, promotion, jobs K, streaming."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe import (
    BoostingShapExplainer,
    DataDriftMonitor,
    DataQualityValidator,
    JobConfig,
    ModelEvaluator,
    ModelFactory,
    ModelRegistry,
    ShapResult,
    TabularPreprocessor,
    train_model,
)
from riskframe.operators.attribution import linear_contributions
from riskframe.operators.encoding import MISSING_CODE, encode_with_vocabulary, impute, vocabulary
from riskframe.operators.metrics import binary_metrics
from riskframe.operators.split import assign_splits
from riskframe.plans import jobs
from riskframe.plans.registry import current_promotions
from riskframe.plans.scoring import ScoringModel, priority_label
from riskframe.session import scratch_path
from riskframe.sources import read_history
from riskframe.streaming import contract_per_batch, drift_per_batch, stream_features
from workload.catalog import comparable, r, register
from workload.feature_queries import FEATURES
from workload.fixtures import SCORE_SQL, patients, scored, table, with_patients

NUMERIC = ["age", "bmi", "glucose_fasting", "systolic_bp"]
CATEGORICAL = ["gender", "smoking_status"]
LABEL = "diagnosed_diabetes"
SMALL_TREES = {"n_estimators": 10, "max_depth": 3}

# ---- imputation and encoding ---------------------------------------------------------------

_MEDIAN = "(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM patients WHERE patient_id % 5 <> 0)"


def _train_part(df):
    return df.filter(F.col("patient_id") % 5 != 0)


@register(
    "m1_numeric_imputation",
    with_patients(
        "SELECT patient_id, "
        + ", ".join(f"{r(f'coalesce(CAST({c} AS DOUBLE), {_MEDIAN.format(c=c)})')} AS {c}" for c in ("bmi", "glucose_fasting"))
        + " FROM patients"
    ),
)
def m1(spark, sf_dir):
    """Medians of the training part applied to all rows."""
    df = patients(spark, sf_dir).select("patient_id", "bmi", "glucose_fasting")
    from riskframe.operators.encoding import numeric_fill_values

    fills = numeric_fill_values(_train_part(df), ["bmi", "glucose_fasting"], "median")
    return comparable(impute(df, fills, {}))


@register(
    "m2_categorical_imputation",
    "SELECT event_id, coalesce(CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END, 'missing') AS event_type FROM events",
)
def m2(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("event_type")
    )
    return impute(events, {}, {"event_type": "missing"})


_CODES = "(SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM patients WHERE {c} IS NOT NULL AND patient_id % 20 <> 0))"


@register(
    "m3_ordinal_codes",
    with_patients(
        "SELECT patient_id, coalesce(g.code, -1) AS gender_code, coalesce(s.code, -1) AS smoking_status_code FROM patients "
        f"LEFT JOIN {_CODES.format(c='gender')} g ON gender = g.v LEFT JOIN {_CODES.format(c='smoking_status')} s ON smoking_status = s.v"
    ),
)
def m3(spark, sf_dir):
    """J4: lookup in a vocabulary learned from rows without the 'Other' category."""
    df = patients(spark, sf_dir).select("patient_id", *CATEGORICAL)
    codes = vocabulary(df.filter(F.col("patient_id") % 20 != 0), CATEGORICAL)
    return comparable(encode_with_vocabulary(df, codes, CATEGORICAL).drop(*CATEGORICAL))


@register(
    "m3_ordinal_codes_missing",
    with_patients(
        "SELECT patient_id, CASE WHEN v IS NULL THEN -2 ELSE coalesce(g.code, -1) END AS smoking_status_code FROM "
        "(SELECT patient_id, CASE WHEN patient_id % 7 <> 0 THEN smoking_status END AS v FROM patients) p "
        f"LEFT JOIN {_CODES.format(c='smoking_status')} g USING (v)"
    ),
)
def m3_missing(spark, sf_dir):
    """J4: missing values have a code of their own, apart from unknown ones."""
    df = patients(spark, sf_dir).select("patient_id", "smoking_status")
    codes = vocabulary(df.filter(F.col("patient_id") % 20 != 0), ["smoking_status"])
    gaps = df.withColumn("smoking_status", F.when(F.col("patient_id") % 7 != 0, F.col("smoking_status")))
    return comparable(encode_with_vocabulary(gaps, codes, ["smoking_status"], missing_code=MISSING_CODE).drop("smoking_status"))


@register(
    "m5_ordinal_vector",
    with_patients(
        f"SELECT patient_id, {r('age')} AS age, {r('coalesce(bmi, ' + _MEDIAN.format(c='bmi') + ')')} AS bmi, "
        f"{r('coalesce(g.code, -1)')} AS gender FROM patients LEFT JOIN (SELECT gender AS v, row_number() OVER (ORDER BY gender) - 1 AS code "
        "FROM (SELECT DISTINCT gender FROM patients WHERE patient_id % 5 <> 0)) g ON gender = g.v"
    ),
)
def m5(spark, sf_dir):
    df = patients(spark, sf_dir).select("patient_id", "age", "bmi", "gender")
    fitted = TabularPreprocessor(["age", "bmi"], ["gender"]).fit(_train_part(df))
    vector = vector_to_array("features")
    out = fitted.transform(df).withColumn("v", vector)
    return comparable(out.select("patient_id", *[F.element_at("v", i + 1).alias(n) for i, n in enumerate(fitted.feature_names_out)]))


@register(
    "m4_one_hot",
    with_patients(
        "SELECT patient_id, "
        + ", ".join(f"CAST(CASE WHEN smoking_status = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS smoking_status_{v}" for v in ("Current", "Former", "Never"))
        + " FROM patients"
    ),
)
def m4(spark, sf_dir):
    df = patients(spark, sf_dir).select("patient_id", "smoking_status")
    fitted = TabularPreprocessor([], ["smoking_status"], categorical_encoding="onehot").fit(df)
    out = fitted.transform(df).withColumn("v", vector_to_array("features"))
    return out.select("patient_id", *[F.element_at("v", i + 1).alias(n) for i, n in enumerate(fitted.feature_names_out)])


@register("m7_saved_preprocessor")
def m7(spark, sf_dir):
    df = patients(spark, sf_dir).select("patient_id", *NUMERIC, *CATEGORICAL)
    path = scratch_path(spark, "m7")
    TabularPreprocessor(NUMERIC, CATEGORICAL).fit(df).save(path)
    loaded = TabularPreprocessor.load(path, spark)
    return loaded.transform(df).select("patient_id", vector_to_array("features").alias("features"))


# ---- classifiers ---------------------------------------------------------------------------

def _vectors(spark, sf_dir):
    df = patients(spark, sf_dir).select("patient_id", LABEL, "hba1c", *NUMERIC, *CATEGORICAL)
    fitted = TabularPreprocessor(["hba1c", *NUMERIC], CATEGORICAL).fit(df)
    return fitted.transform(df).select("patient_id", LABEL, "features"), fitted.feature_names_out


def _classifier(key: str, name: str, params: dict) -> None:
    @register(key)
    def query(spark, sf_dir):
        """Score quality of a small model on the rows it has seen."""
        vectors, names = _vectors(spark, sf_dir)
        model = ModelFactory.create(name, params).fit(vectors, LABEL, feature_names=names)
        return comparable(binary_metrics(model.predict_proba(vectors, "score"), LABEL, "score", decimals=6))


_classifier("m10_logistic_regression", "logistic_regression", {"max_iter": 50})
_classifier("m11_random_forest", "random_forest", {"n_estimators": 10, "max_depth": 5})
_classifier("m12_gradient_boosting", "gradient_boosting", SMALL_TREES)
_classifier("m13_xgboost", "xgboost", SMALL_TREES)
_classifier("m14_lightgbm", "lightgbm", SMALL_TREES)
_classifier("m15_catboost", "catboost", {"iterations": 10, "depth": 3})


@register("m19_feature_importance")
def m19(spark, sf_dir):
    vectors, names = _vectors(spark, sf_dir)
    model = ModelFactory.create("gradient_boosting", SMALL_TREES).fit(vectors, LABEL, feature_names=names)
    return model.get_feature_importance(spark)


@register("m20_saved_multiclass_model")
def m20(spark, sf_dir):
    """Three classes, saved, loaded, scored."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", (F.col("o_orderkey") % 3).cast("long").alias("label")
    )
    vectors = TabularPreprocessor(["o_totalprice"], ["o_orderpriority"]).fit_transform(orders)
    path = scratch_path(spark, "m20")
    model = ModelFactory.create("random_forest", {"n_estimators": 5, "max_depth": 4}, "multiclass_classification")
    model.fit(vectors, "label").save(path, spark)
    return type(model).load(path, spark).predict(vectors).select("o_orderkey", "label", "predicted")


@register("e21_model_evaluation")
def e21(spark, sf_dir):
    vectors, names = _vectors(spark, sf_dir)
    model = ModelFactory.create("logistic_regression", {"max_iter": 50}).fit(vectors, LABEL, feature_names=names)
    report = ModelEvaluator(model, quality_gates={"roc_auc": 0.6}).evaluate(vectors, LABEL)
    return comparable(report.classification_report)


def _training(spark, sf_dir):
    registry = ModelRegistry(spark, scratch_path(spark, "models"))
    rows = patients(spark, sf_dir).drop("encounter_ts", "diabetes_risk_score", "diabetes_stage")
    result = train_model(
        rows, registry=registry, target_column=LABEL, id_columns=["patient_id"], model_type="gradient_boosting",
        model_params=SMALL_TREES, registered_model_name="risk",
    )
    return rows, registry, result


@register("m21_training_metrics")
def m21(spark, sf_dir):
    return _training(spark, sf_dir)[2].metrics_dataframe(spark)


@register("m24_batch_scoring")
def m24(spark, sf_dir):
    rows, registry, result = _training(spark, sf_dir)
    return ScoringModel.load(registry.resolve(result.model_uri), spark).predict(rows.drop(LABEL))


@register("m23_priority_labels", with_patients(
    f"SELECT patient_id, CASE WHEN {SCORE_SQL} >= 0.8 THEN 'HIGH' WHEN {SCORE_SQL} >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM patients"
))
def m23(spark, sf_dir):
    return scored(spark, sf_dir).select("patient_id", priority_label(F.col("score")).alias("priority"))


@register(
    "m27_current_promotion",
    "SELECT o_orderpriority AS model, o_orderstatus AS alias, o_orderkey AS version FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
)
def m27(spark, sf_dir):
    """Latest entry per model and alias, on orders as promotion history."""
    history = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("model"), F.col("o_orderstatus").alias("alias"), F.col("o_orderkey").alias("version"),
        F.lit("").alias("path"), F.col("o_orderdate").alias("promoted_at"),
    )
    return current_promotions(history).select("model", "alias", F.col("version").cast("long").alias("version"))


# ---- attribution ---------------------------------------------------------------------------

COEFFICIENTS = {"age": 0.02, "hba1c": 0.7, "insulin_level": -0.05, "systolic_bp": 0.01}
INTERCEPT = -4.0
_CONTRIB = {c: f"{k}::DOUBLE * (CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM patients))" for c, k in COEFFICIENTS.items()}


def _linear(spark, sf_dir) -> ShapResult:
    df = patients(spark, sf_dir).select("patient_id", *COEFFICIENTS)
    frame = linear_contributions(df, list(COEFFICIENTS.values()), INTERCEPT, list(COEFFICIENTS))
    return ShapResult(frame, list(COEFFICIENTS))


@register("x2_contributions_wide", with_patients(f"SELECT patient_id, {', '.join(f'{r(e)} AS {c}' for c, e in _CONTRIB.items())} FROM patients"))
def x2(spark, sf_dir):
    """X1 for a linear model, one column per feature."""
    return comparable(_linear(spark, sf_dir).wide(["patient_id"]))


_LONG = " UNION ALL ".join(f"SELECT patient_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {e} AS c FROM patients" for c, e in _CONTRIB.items())


@register("x3_feature_ranking", with_patients("") + f", l AS ({_LONG}) SELECT feature, {r('avg(abs(c))')} AS mean_abs_contribution FROM l GROUP BY 1")
def x3(spark, sf_dir):
    """A12 and T3: mean absolute contribution."""
    return comparable(_linear(spark, sf_dir).mean_abs())


@register(
    "t3_top_features",
    with_patients("") + f", l AS ({_LONG}) SELECT feature, {r('avg(abs(c))')} AS mean_abs_contribution FROM l GROUP BY 1 ORDER BY avg(abs(c)) DESC, feature LIMIT 2",
)
def t3(spark, sf_dir):
    return comparable(_linear(spark, sf_dir).top_features(2))


_BASE = f"({INTERCEPT}::DOUBLE + " + " + ".join(f"{k}::DOUBLE * (SELECT avg(CAST({c} AS DOUBLE)) FROM patients)" for c, k in COEFFICIENTS.items()) + ")"


@register(
    "x4_waterfall",
    with_patients("") + f", l AS ({_LONG}), k AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY abs(c) DESC, feature) AS rk FROM l), "
    "b AS (SELECT patient_id, '2 other features' AS feature, sum(c) AS c, 0 AS position FROM k WHERE rk > 2 GROUP BY patient_id "
    "UNION ALL SELECT patient_id, feature, c, 3 - rk FROM k WHERE rk <= 2), "
    f"t AS (SELECT *, {_BASE} + sum(c) OVER (PARTITION BY patient_id ORDER BY position ROWS UNBOUNDED PRECEDING) AS e FROM b) "
    f"SELECT patient_id, CAST(position AS BIGINT) AS position, feature, {r('c', 4)} AS contribution, {r('e - c', 4)} AS start_value, {r('e', 4)} AS end_value FROM t",
)
def x4(spark, sf_dir):
    """W7 and W8: ranked contributions of every row with running totals."""
    return comparable(_linear(spark, sf_dir).waterfall(["patient_id"], 2), 4)


@register(
    "x6_scatter",
    with_patients("") + f", l AS ({_LONG}), top AS (SELECT feature FROM l GROUP BY 1 ORDER BY avg(abs(c)) DESC, feature LIMIT 2) "
    f"SELECT patient_id, feature, {r('value')} AS value, {r('c')} AS contribution FROM l WHERE feature IN (SELECT feature FROM top)",
)
def x6(spark, sf_dir):
    return comparable(_linear(spark, sf_dir).scatter(["patient_id"], 2))


@register("x1_tree_contributions")
def x1(spark, sf_dir):
    """Mean absolute Shapley contributions of a boosted ensemble."""
    vectors, names = _vectors(spark, sf_dir)
    model = ModelFactory.create("gradient_boosting", SMALL_TREES).fit(vectors, LABEL, feature_names=names)
    return BoostingShapExplainer(model).fit(vectors).result.mean_abs()


# ---- end-to-end steps ------------------------------------------------------------------------

def _job(spark, sf_dir) -> JobConfig:
    root = scratch_path(spark, "jobs")
    patients(spark, sf_dir).write.parquet(f"{root}/source.parquet")
    return JobConfig(
        f"{root}/source.parquet", root, id_columns=("patient_id",), model_type="gradient_boosting",
        model_params=SMALL_TREES, exclude_columns=("encounter_ts",),
    )


@register("k1_prepare")
def k1(spark, sf_dir):
    config = _job(spark, sf_dir)
    jobs.prepare(spark, config)
    return read_history(spark, config.table("data_quality"))


@register("k5_all_steps")
def k5(spark, sf_dir):
    """Prepare, train and promote, score (K1-K4 in order); the priority counts of the scored table."""
    predictions = jobs.run_all(spark, _job(spark, sf_dir))["predictions"]
    return predictions.groupBy("priority", "model_version").agg(F.count("*").alias("rows"))


# ---- streaming -------------------------------------------------------------------------------

def _patient_stream(spark, sf_dir, rows=None):
    path = scratch_path(spark, "stream-input")
    (rows if rows is not None else patients(spark, sf_dir)).write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


@register(
    "stream_features",
    with_patients(f"SELECT patient_id, {FEATURES['f12'][2]} AS metabolic_syndrome_flag, {FEATURES['f10'][2]} AS bmi_category FROM patients"),
)
def stream(spark, sf_dir):
    """The feature projection on a stream, drained into files and read back."""
    out = scratch_path(spark, "stream-output")
    features = stream_features(_patient_stream(spark, sf_dir), target_column=LABEL, id_columns=["patient_id"])
    query = (
        features.writeStream.format("parquet").option("checkpointLocation", f"{out}-checkpoint")
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("patient_id", "metabolic_syndrome_flag", "bmi_category")


@register("stream_contract")
def stream_contract(spark, sf_dir):
    out = scratch_path(spark, "stream-contract")
    rows = patients(spark, sf_dir).select("patient_id", "bmi", LABEL)
    validator = DataQualityValidator(required_columns=["bmi"], target_column=LABEL, id_columns=["patient_id"])
    contract_per_batch(_patient_stream(spark, sf_dir, rows), validator, out, f"{out}-checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return read_history(spark, out)


@register("stream_drift")
def stream_drift(spark, sf_dir):
    out = scratch_path(spark, "stream-drift")
    rows = patients(spark, sf_dir).select("bmi", "gender")
    drift_per_batch(_patient_stream(spark, sf_dir, rows), rows, DataDriftMonitor(), out, f"{out}-checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return read_history(spark, out)


@register(
    "w5_temporal_three_way",
    "WITH o AS (SELECT o_orderkey, o_orderdate, count(*) OVER () AS n, row_number() OVER (ORDER BY o_orderdate, "
    "md5(concat('42:', CAST(o_orderkey AS VARCHAR)))) AS rn FROM orders), "
    "t AS (SELECT *, rn <= CAST(floor(n * (1 - CAST(0.2 AS DOUBLE))) AS BIGINT) AS rest FROM o), "
    "r AS (SELECT *, count(*) OVER () AS m, row_number() OVER (ORDER BY o_orderdate, md5(concat('43:', CAST(o_orderkey AS VARCHAR)))) AS place "
    "FROM t WHERE rest), "
    "s AS (SELECT o_orderdate, 'test' AS split FROM t WHERE NOT rest UNION ALL SELECT o_orderdate, "
    "CASE WHEN place <= CAST(floor(m * (1 - CAST(0.2 AS DOUBLE))) AS BIGINT) THEN 'train' ELSE 'valid' END FROM r) "
    'SELECT split, count(*) AS "rows", min(o_orderdate) AS first, max(o_orderdate) AS last FROM s GROUP BY split',
)
def w5_temporal(spark, sf_dir):
    """Latest rows as test, the latest of the rest as validation."""
    assigned = assign_splits(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), target="o_orderkey", strategy="temporal",
        temporal_column="o_orderdate", id_columns=["o_orderkey"],
    )
    return assigned.groupBy("split").agg(F.count("*").alias("rows"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
