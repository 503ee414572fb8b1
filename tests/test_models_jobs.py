import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import riskframe as rf
from riskframe.operators.attribution import leaf_paths
from riskframe.operators.encoding import encode_with_vocabulary, vocabulary
from riskframe.plans import jobs
from riskframe.plans.registry import ModelRegistry
from riskframe.plans.scoring import priority_label, select_scoring_columns
from riskframe.streaming import stream_features
from workload.fixtures import patients

TREES = {"n_estimators": 4, "max_depth": 3}


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(200).select(
        F.col("id").alias("patient_id"),
        (F.col("id") % 60 + 20).cast("double").alias("age"),
        F.when(F.col("id") % 9 == 0, None).otherwise(20 + F.col("id") % 17).cast("double").alias("bmi"),
        F.when(F.col("id") % 3 == 0, "F").when(F.col("id") % 50 == 1, None).otherwise("M").alias("gender"),
        ((F.col("id") % 60 > 35) | (F.col("id") % 11 == 0)).cast("long").alias("y"),
    ).cache()


def vectors(people, **options):
    fitted = rf.TabularPreprocessor(["age", "bmi"], ["gender"], **options).fit(people)
    return fitted, fitted.transform(people)


def test_preprocessor(spark, people, tmp_path):
    fitted, out = vectors(people)
    assert fitted.feature_names_out == ["age", "bmi", "gender"]
    median = float(np.median([r.bmi for r in people.select("bmi").na.drop().collect()]))
    row = out.filter("bmi IS NULL").select(vector_to_array("features").alias("v")).first()
    assert row.v[1] == median
    fresh = spark.createDataFrame([(1.0, 2.0, "X"), (None, None, None)], "age double, bmi double, gender string")
    codes = [r.v[2] for r in fitted.transform(fresh).select(vector_to_array("features").alias("v")).collect()]
    assert codes == [-1.0, 1.0]
    assert set(fitted.transform(fresh).columns) == {"age", "bmi", "gender", "features"}
    fitted.save(str(tmp_path / "p"))
    loaded = rf.TabularPreprocessor.load(str(tmp_path / "p"))
    assert loaded.get_config() == fitted.get_config()
    assert loaded.transform(fresh).collect() == fitted.transform(fresh).collect()
    with pytest.raises(RuntimeError):
        rf.TabularPreprocessor(["age"]).transform(people)


def test_one_hot_and_constant(spark, people):
    fitted, _ = vectors(people, categorical_encoding="onehot", categorical_impute_strategy="constant",
                        numeric_impute_strategy="mean")
    assert fitted.feature_names_out == ["age", "bmi", "gender_F", "gender_M", "gender_missing"]
    fresh = spark.createDataFrame([(1.0, 2.0, "X"), (1.0, 2.0, "M"), (1.0, 2.0, None)], "age double, bmi double, gender string")
    found = [r.v[2:] for r in fitted.transform(fresh).select(vector_to_array("features").alias("v")).collect()]
    assert found == [[0, 0, 0], [0, 1, 0], [0, 0, 1]]


def test_vocabulary_paths_agree(spark, people, monkeypatch):
    from riskframe.operators import encoding

    small = {tuple(r) for r in vocabulary(people, ["gender"]).collect()}
    monkeypatch.setattr(encoding, "WINDOW_CODE_ROWS", 0)
    codes = vocabulary(people, ["gender"])
    assert {(r.feature, r.value, r.code) for r in codes.collect()} == small == {("gender", "F", 0), ("gender", "M", 1)}
    fresh = spark.createDataFrame([("M",), ("?",), (None,)], "gender string")
    encoded = encode_with_vocabulary(fresh, codes, ["gender"])
    assert sorted(r.gender_code for r in encoded.collect()) == [-1, -1, 1]


@pytest.mark.parametrize("name", rf.ModelFactory.list_supported())
def test_classifiers_share_an_interface(spark, people, name, tmp_path):
    fitted, data = vectors(people)
    params = {"iterations": 3, "depth": 3} if name == "catboost" else {**TREES, "max_iter": 20}
    model = rf.ModelFactory.create(f" {name.upper()} ", params)
    with pytest.raises(RuntimeError):
        model.predict(data)
    model.fit(data, "y", feature_names=fitted.feature_names_out)
    scores = model.predict_proba(data, "s").agg(F.min("s"), F.max("s"), F.count("s")).first()
    assert 0 <= scores[0] <= scores[1] <= 1 and scores[2] == 200
    assert {r.predicted for r in model.predict(data).select("predicted").distinct().collect()} <= {0, 1}
    importance = model.get_feature_importance(spark).collect()
    assert {r.feature for r in importance} == {"age", "bmi", "gender"}
    assert [r.importance for r in importance] == sorted((r.importance for r in importance), reverse=True)
    model.save(str(tmp_path / name), spark)
    loaded = rf.ModelFactory.create(name).load(str(tmp_path / name), spark)
    assert type(loaded) is type(model) and loaded.feature_names == model.feature_names
    difference = model.predict_proba(data, "s").join(loaded.predict_proba(data, "t").select("patient_id", "t"), "patient_id")
    assert difference.agg(F.max(F.abs(F.col("s") - F.col("t")))).first()[0] == 0


def test_multiclass_boosting_and_evaluation(people):
    data = vectors(people.withColumn("y", F.col("patient_id") % 3))[1]
    model = rf.ModelFactory.create("xgboost", TREES, "multiclass_classification").fit(data, "y")
    totals = model.transform(data).select(F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x).alias("t"))
    assert totals.filter(F.abs(F.col("t") - 1) > 1e-9).count() == 0
    report = rf.ModelEvaluator(model).evaluate(data, "y")
    assert {"accuracy", "roc_auc", "log_loss"} <= set(report.metrics)
    assert report.predictions.columns == ["actual", "predicted", "probability_0", "probability_1", "probability_2"]


def test_continuous_labels_are_rejected(people, monkeypatch):
    data = vectors(people)[1]
    monkeypatch.setattr("riskframe.operators.models.MAX_CLASSES", 5)
    monkeypatch.setattr("riskframe.plans.evaluation.MAX_CLASSES", 5)
    with pytest.raises(ValueError, match="not a class label"):
        rf.ModelFactory.create("random_forest", TREES).fit(data, "age")
    with pytest.raises(ValueError, match="not a class label"):
        rf.ModelEvaluator(rf.ModelFactory.create("random_forest")).evaluate(data, "age")


def test_factory_rejections():
    with pytest.raises(ValueError, match="unknown model_type"):
        rf.ModelFactory.create("prophet")
    with pytest.raises(ValueError, match="unsupported task_type"):
        rf.ModelFactory.create("xgboost", task_type="regression")


def test_evaluator(people):
    fitted, data = vectors(people)
    model = rf.ModelFactory.create("random_forest", TREES).fit(data, "y", feature_names=fitted.feature_names_out)
    report = rf.ModelEvaluator(model, quality_gates={"roc_auc": 0.5, "recall": 1.1}).evaluate(data, "y")
    assert report.quality_gates["roc_auc"]["passed"] and not report.quality_gates["recall"]["passed"]
    assert not report.passed and report.confusion_matrix.count() == 2
    counts = [report.metrics[n] for n in ("true_positive", "false_positive", "false_negative", "true_negative")]
    assert sum(counts) == 200
    with pytest.raises(ValueError, match="no such metric"):
        rf.ModelEvaluator(model, quality_gates={"nope": 1}).evaluate(data, "y")
    for bad in (data.filter("y > 1"), data.filter("y = 1"), data.withColumn("y", F.lit(None).cast("long"))):
        with pytest.raises(ValueError):
            rf.ModelEvaluator(model).evaluate(bad, "y")


def exact_shapley(leaves, row, features):
    """Shapley values straight from the definition over all coalitions."""

    def passes(tests, value):
        return all(((value <= p[0]) if threshold else value in p) == left for threshold, p, left in tests)

    def worth(known):
        total = 0.0
        for value, path in leaves:
            for f, zero, tests in path:
                value *= (1.0 if passes(tests, row[f]) else 0.0) if f in known else zero
            total += value
        return total

    n, result = len(features), []
    for f in features:
        rest = [g for g in features if g != f]
        total = 0.0
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for group in itertools.combinations(rest, size):
                total += weight * (worth({*group, f}) - worth(set(group)))
        result.append(total)
    return result


@pytest.mark.parametrize("name", ["gradient_boosting", "random_forest"])
def test_tree_contributions_match_definition(spark, people, name):
    fitted, data = vectors(people)
    model = rf.ModelFactory.create(name, TREES).fit(data, "y", feature_names=fitted.feature_names_out)
    explainer = rf.BoostingShapExplainer(model).fit(data)
    leaves = leaf_paths(model.model, spark)
    for row in explainer.result.frame.select("feature_values", "contributions").limit(5).collect():
        assert row.contributions == pytest.approx(exact_shapley(leaves, row.feature_values, [0, 1, 2]), abs=1e-9)
    raw = model.model.transform(data).select("patient_id", vector_to_array("rawPrediction")[1].alias("raw"),
                                             vector_to_array("probability")[1].alias("p"))
    total = explainer.result.frame.select(
        "patient_id", F.aggregate("contributions", F.col("base_value"), lambda a, c: a + c).alias("total")
    ).join(raw, "patient_id")
    output = "raw" if name == "gradient_boosting" else "p"
    assert total.agg(F.max(F.abs(F.col("total") - F.col(output)))).first()[0] < 1e-9
    assert explainer.top_features(2).count() == 2
    bars = explainer.waterfall_of("patient_id", 7, max_display=1).orderBy("position").collect()
    assert bars[0].feature == "2 other features" and bars[1].start_value == bars[0].end_value
    with pytest.raises(IndexError):
        explainer.waterfall_of("patient_id", -1)


def test_linear_contributions(people):
    fitted, data = vectors(people)
    model = rf.ModelFactory.create("logistic_regression").fit(data, "y", feature_names=fitted.feature_names_out)
    result = rf.BoostingShapExplainer(model).fit(data).result
    margin = model.model.transform(data).select("patient_id", vector_to_array("rawPrediction")[1].alias("raw"))
    total = result.frame.select(
        "patient_id", F.aggregate("contributions", F.col("base_value"), lambda a, c: a + c).alias("total")
    ).join(margin, "patient_id")
    assert total.agg(F.max(F.abs(F.col("total") - F.col("raw")))).first()[0] < 1e-9
    assert result.long(["patient_id"]).count() == 600
    assert result.wide(["patient_id"]).columns == ["patient_id", "age", "bmi", "gender"]
    assert result.scatter(["patient_id"], 1).count() == 200


def test_priority_and_projection(spark):
    df = spark.createDataFrame([(0.9,), (0.8,), (0.7999999,), (0.5,), (0.2,), (None,)], "s double")
    assert [r[0] for r in df.select(priority_label(F.col("s"))).collect()] == ["HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    assert select_scoring_columns(df.selectExpr("s", "1 AS id"), ["s"], ["id", "gone"]).columns == ["id", "s"]
    with pytest.raises(KeyError):
        select_scoring_columns(df, ["absent"])


@pytest.mark.parametrize(
    "options",
    [
        {"test_size": 0}, {"validation_size": 1}, {"test_size": 0.6, "validation_size": 0.5}, {"split_strategy": "temporal"},
        {"split_strategy": "other"}, {"task_type": "regression"}, {"model_type": "x"}, {"numeric_impute_strategy": "x"},
        {"categorical_impute_strategy": "x"}, {"categorical_encoding": "x"}, {"priority_medium_threshold": 0.9},
        {"numeric_columns": ["a"], "categorical_columns": ["a"]}, {"feature_columns": ["TARGET"]},
        {"feature_columns": ["a"], "numeric_columns": ["b"]},
    ],
)
def test_training_config_rejections(options):
    with pytest.raises(rf.InvalidConfigurationError):
        rf.TrainingConfig(**options)


def test_inference_config():
    assert rf.InferenceConfig("runs:/1").output_mode == "overwrite"
    for options in ({"model_uri": ""}, {"model_uri": "x", "output_mode": "y"}, {"model_uri": "x", "batch_size": 0}):
        with pytest.raises(rf.InvalidConfigurationError):
            rf.InferenceConfig(**options)


def test_training_rejections(spark):
    def train(rows, schema, **options):
        return rf.train_model(spark.createDataFrame(rows, schema), target_column="y", **options)

    cases = [
        ([(1, 0)], "x long, z long", {}, "that the table lacks"), ([], "x long, y long", {}, "at least one row"),
        ([(1, None), (2, 1)], "x long, y long", {}, "missing values"), ([(1, 1)], "x long, y long", {}, "at least two"),
        ([(1, 0), (1, 1), (1, 2)], "x long, y long", {}, "exactly two"), ([(0,), (1,)], "y long", {}, "no feature columns"),
        ([(1, 0), (1, 1)], "x long, y long", {"feature_columns": ["q"]}, "feature columns: q"),
    ]
    for rows, schema, options, message in cases:
        with pytest.raises(ValueError, match=message):
            train(rows, schema, **options)
    with pytest.raises(ValueError, match="duplicate columns"):
        rf.train_model(spark.createDataFrame([(1, 2, 0)], "a long, b long, y long").toDF("a", "a", "y"), target_column="y")


def test_train_register_score_merge(spark, people, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "models"))
    options = dict(target_column="y", id_columns=["patient_id"], model_type="random_forest", model_params=TREES,
                   registered_model_name="risk")
    first = rf.train_model(people, registry=registry, **options)
    second = rf.train_model(people, registry=registry, **options)
    assert (first.registered_model_version, second.registered_model_version) == ("1", "2")
    assert {"train_roc_auc", "valid_recall", "test_mcc"} <= set(first.metrics) and first.metrics == second.metrics
    assert set(first.tracked_metrics()) == set(rf.operators.metrics.TRACKED_METRICS)
    registry.set_alias("risk", 2, "Champion")
    registry.set_alias("risk", 1, "Champion")
    assert registry.resolve("models:/risk@Champion") == registry.run_path(first.run_id)
    assert registry.resolve("models:/risk/2") == registry.run_path(second.run_id)
    with pytest.raises(ValueError):
        registry.set_alias("risk", 9, "Champion")
    with pytest.raises(ValueError):
        registry.resolve("models:/risk@Nobody")
    predictor = rf.ModelPredictor("models:/risk@Champion", spark, registry)
    out = predictor.predict(people.drop("y"))
    assert out.columns == ["patient_id", "probability", "priority", "prediction_date", "model_version"]
    assert {r.model_version for r in out.select("model_version").distinct().collect()} == {"1"} and out.count() == 200
    table = str(tmp_path / "scores")
    write = dict(output_table=table, spark=spark, registry=registry)
    rf.predict_with_registered_model("models:/risk/1", input_df=people.filter("patient_id < 150"), **write)
    merged = rf.predict_with_registered_model("models:/risk/2", input_df=people.filter("patient_id >= 100"), mode="merge", **write)
    assert {r[0]: r[1] for r in merged.groupBy("model_version").count().collect()} == {"1": 100, "2": 100}
    evaluation = rf.evaluate_registered_model_on_holdout("models:/risk/1", "y", input_df=people, spark=spark, registry=registry)
    assert evaluation.row_count == 200 and evaluation.metrics["holdout_roc_auc"] > 0.5
    with pytest.raises(ValueError):
        rf.predict_with_registered_model("models:/risk/1", spark=spark, registry=registry)
    with pytest.raises(KeyError):
        rf.evaluate_registered_model_on_holdout("models:/risk/1", "absent", input_df=people, spark=spark, registry=registry)


def test_temporal_training(spark, people, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "models"))
    result = rf.train_model(
        people.withColumn("seen", F.col("patient_id")), registry=registry, target_column="y", id_columns=["patient_id"],
        split_strategy="temporal", temporal_column="seen", model_type="logistic_regression",
    )
    assert result.feature_names == ["age", "bmi", "gender"]


def test_jobs_end_to_end(spark, sf_dir, tmp_path):
    patients(spark, sf_dir).write.parquet(str(tmp_path / "source.parquet"))
    config = rf.JobConfig(
        str(tmp_path / "source.parquet"), str(tmp_path), id_columns=("patient_id",), model_type="gradient_boosting",
        model_params=TREES, exclude_columns=("encounter_ts",),
    )
    outcome = jobs.run_all(spark, config)
    assert outcome["prepare"].split.test_count == 300 and outcome["predictions"].count() == 300
    assert outcome["evaluation"].metrics["holdout_roc_auc"] >= 0.7
    assert spark.read.parquet(config.table("drift_metrics")).filter("feature = 'bmi'").count() == 1
    with pytest.raises(RuntimeError, match="rejected"):
        jobs.train_and_promote(spark, rf.JobConfig(**{**config.__dict__, "min_recall": 1.1}))


def test_streaming_features_equal_batch(spark, sf_dir, tmp_path):
    source = str(tmp_path / "in")
    patients(spark, sf_dir).write.parquet(source)
    batch = spark.read.parquet(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    out = str(tmp_path / "out")
    stream_features(stream, id_columns=["patient_id"]).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "cp")
    ).trigger(availableNow=True).start(out).awaitTermination()
    written = spark.read.parquet(out)
    expected = stream_features(batch, id_columns=["patient_id"])
    assert written.exceptAll(expected.select(written.columns)).count() == 0 and written.count() == 1500


def test_early_stopping_uses_the_validation_rows(spark, people, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "models"))
    result = rf.train_model(
        people, registry=registry, target_column="y", id_columns=["patient_id"], model_type="gradient_boosting",
        model_params={"n_estimators": 6, "max_depth": 2, "learning_rate": 0.9}, early_stopping=True,
    )
    model = rf.ScoringModel.load(registry.resolve(result.model_uri), spark)
    assert 1 <= len(model.classifier.model.treeWeights) <= 6


def test_entry_and_registration(spark):
    import __spark_entry__ as entry_module

    frame = entry_module.entry(spark)
    assert frame.columns == ["bmi_category", "patients", "with_syndrome", "syndrome_rate"] and frame.count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
