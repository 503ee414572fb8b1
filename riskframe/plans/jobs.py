"""The scheduled steps end to end: prepare, train and promote, score, monitor."""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import Any, Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.cleaning import preprocess_dataset
from riskframe.operators.contract import DataQualityReport, DataQualityValidator
from riskframe.operators.drift import DataDriftMonitor, DriftReport
from riskframe.operators.features import FeatureEngineeringPipeline
from riskframe.operators.split import SplitTablesResult, create_train_test_tables
from riskframe.plans.config import JobConfig
from riskframe.plans.registry import ModelRegistry
from riskframe.plans.scoring import HoldoutEvaluationResult, evaluate_registered_model_on_holdout, load_model
from riskframe.plans.training import TrainingResult, train_boosting_model
from riskframe.session import compiled_methods
from riskframe.sources.tables import append_history, load_dataset, read_table, scoring_table, write_table


def _compiled(step: Callable) -> Callable:
    """A step whose wide projections the JVM compiles, whatever the session's own setting."""

    @functools.wraps(step)
    def run(spark: SparkSession, config: JobConfig) -> Any:
        with compiled_methods(spark):
            return step(spark, config)

    return run


@dataclass(frozen=True)
class PrepareOutcome:
    quality: DataQualityReport
    split: SplitTablesResult


@_compiled
def prepare(spark: SparkSession, config: JobConfig) -> PrepareOutcome:
    """Ingest, check the contract, clean, derive features, write train, holdout and scoring tables.

    The contract looks at the raw rows by default, so that duplicates and infinities can fail it;
    ``contract_stage="clean"`` checks after cleaning instead.
    """
    raw_table = config.table("raw")
    write_table(load_dataset(config.source_path, spark=spark), raw_table, mode=config.write_mode)
    raw = read_table(spark, raw_table)
    clean = preprocess_dataset(raw, hash_first=True)
    report = DataQualityValidator(
        required_columns=(*config.required_columns, config.target_column),
        target_column=config.target_column,
        id_columns=config.id_columns,
        max_missing_ratio=config.max_missing_ratio,
        allow_duplicate_rows=config.allow_duplicate_rows,
    ).validate(raw if config.contract_stage == "raw" else clean)
    append_history(report.history_rows(spark, config.environment).coalesce(1), config.table("data_quality"))
    report.raise_for_failure()

    features = FeatureEngineeringPipeline(config.age_group_strategy, config.validate_schema).transform(
        clean, target_column=config.target_column, id_columns=config.id_columns
    )
    write_table(features, config.table("features"), mode=config.write_mode)
    split = create_train_test_tables(
        config.table("features"),
        config.table("train"),
        config.table("holdout"),
        config.target_column,
        config.test_size,
        config.random_state,
        config.stratify,
        config.write_mode,
        spark,
        config.id_columns,
    )
    write_table(
        scoring_table(read_table(spark, config.table("holdout")), config.target_column),
        config.table("scoring"),
        mode=config.write_mode,
    )
    return PrepareOutcome(report, split)


def registry_of(spark: SparkSession, config: JobConfig) -> ModelRegistry:
    return ModelRegistry(spark, config.table("models"))


@_compiled
def train_and_promote(
    spark: SparkSession, config: JobConfig
) -> tuple[TrainingResult, HoldoutEvaluationResult]:
    """Train a candidate, evaluate it on the holdout table, promote it if the gates pass."""
    registry = registry_of(spark, config)
    result = train_boosting_model(
        read_table(spark, config.table("train")),
        registry=registry,
        target_column=config.target_column,
        id_columns=list(config.id_columns),
        exclude_columns=list(config.exclude_columns),
        model_type=config.model_type,
        model_params=dict(config.model_params),
        test_size=config.test_size,
        validation_size=config.validation_size,
        random_state=config.random_state,
        registered_model_name=config.model_name,
        use_internal_test_split=False,
        training_data_source=config.table("train"),
        environment=config.environment,
    )
    evaluation = evaluate_registered_model_on_holdout(
        result.model_uri,
        config.target_column,
        input_table=config.table("holdout"),
        output_table=config.table("holdout_predictions"),
        mode=config.write_mode,
        spark=spark,
        registry=registry,
    )
    minimums = {"holdout_roc_auc": config.min_roc_auc, "holdout_recall": config.min_recall}
    failures = {
        name: (evaluation.metrics[name], minimum)
        for name, minimum in minimums.items()
        if evaluation.metrics[name] is None or evaluation.metrics[name] < minimum
    }
    if failures:
        raise RuntimeError(f"candidate rejected: {failures}")
    gates = {name: evaluation.metrics[name] for name in minimums}
    registry.set_alias(config.model_name, int(result.registered_model_version), config.model_alias, gates)
    return result, evaluation


@_compiled
def score(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Score the unlabelled table with the promoted model.

    Rows are not de-duplicated: two identical patients get two predictions.
    """
    model = load_model(f"models:/{config.model_name}@{config.model_alias}", spark, registry_of(spark, config))
    rows = preprocess_dataset(read_table(spark, config.table("scoring")), drop_duplicates=False)
    features = FeatureEngineeringPipeline(config.age_group_strategy, config.validate_schema).transform(
        rows, id_columns=config.id_columns
    )
    write_table(model.predict(features), config.table("predictions"), mode=config.write_mode)
    return read_table(spark, config.table("predictions"))


@_compiled
def monitor(spark: SparkSession, config: JobConfig) -> DriftReport:
    """Drift of the scoring table against the training table, appended to the history."""
    ignored = [config.target_column, *config.id_columns]
    report = DataDriftMonitor(psi_threshold=config.drift_psi_threshold).compare(
        read_table(spark, config.table("train")).drop(*ignored),
        read_table(spark, config.table("scoring")).drop(*ignored),
    )
    history = report.metrics.withColumns(
        {
            "environment": F.lit(config.environment),
            "model_uri": F.lit(f"models:/{config.model_name}@{config.model_alias}"),
            "measured_at": F.current_timestamp(),
        }
    )
    append_history(history.coalesce(1), config.table("drift_metrics"))
    if config.fail_on_drift:
        report.raise_for_failure()
    return report


def run_all(spark: SparkSession, config: JobConfig) -> dict[str, Any]:
    """All steps in order."""
    prepared = prepare(spark, config)
    trained, evaluation = train_and_promote(spark, config)
    predictions = score(spark, config)
    drift = monitor(spark, config)
    return {
        "prepare": prepared, "train": trained, "evaluation": evaluation, "predictions": predictions, "drift": drift,
    }
