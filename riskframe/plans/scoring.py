"""Batch scoring: saved model package, priority labels, holdout evaluation."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import select_label
from riskframe.operators.cleaning import integers_to_double
from riskframe.operators.encoding import TabularPreprocessor
from riskframe.operators.metrics import compute_binary_holdout_metrics
from riskframe.operators.models import ClassifierModel
from riskframe.plans.registry import ModelRegistry
from riskframe.session import active_session, scratch_path
from riskframe.sources.metadata import read_metadata, write_metadata
from riskframe.sources.tables import read_table, upsert, write_table

# --- fixed values ----------------------------------------------------------------------
PROBABILITY_DECIMALS = 6
PRIORITY_LABELS = ["HIGH", "MEDIUM"]
PRIORITY_DEFAULT = "LOW"
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"


def priority_label(score: Column, high: float = 0.8, medium: float = 0.5) -> Column:
    """HIGH, MEDIUM or LOW from the unrounded score."""
    return select_label([score >= F.lit(high), score >= F.lit(medium)], PRIORITY_LABELS, PRIORITY_DEFAULT)


def select_scoring_columns(df: DataFrame, feature_columns: Sequence[str], id_columns: Sequence[str] = ()) -> DataFrame:
    """Identifiers that exist, then all features in training order; absent features are an error."""
    absent = [c for c in feature_columns if c not in df.columns]
    if absent:
        raise KeyError(f"missing feature columns: {absent}")
    ids = [c for c in id_columns if c in df.columns and c not in feature_columns]
    return df.select(*[f"`{c}`" for c in [*ids, *feature_columns]])


def scoring_output(
    df: DataFrame, score: Column, ids: Sequence[str], version: str, high: float = 0.8, medium: float = 0.5
) -> DataFrame:
    """``(ids…, probability, priority, prediction_date, model_version)``."""
    return df.select(
        *[f"`{c}`" for c in ids],
        F.bround(score, PROBABILITY_DECIMALS).alias("probability"),
        priority_label(score, high, medium).alias("priority"),
        F.date_format(F.current_timestamp(), DATE_FORMAT).alias("prediction_date"),
        F.lit(version).alias("model_version"),
    )


class ScoringModel:
    """Fitted preprocessor and classifier with the settings needed to score raw rows."""

    def __init__(
        self,
        preprocessor: TabularPreprocessor,
        classifier: ClassifierModel,
        feature_columns: Sequence[str],
        id_columns: Sequence[str] = (),
        priority_high: float = 0.8,
        priority_medium: float = 0.5,
        version: str = "unregistered",
    ) -> None:
        self.preprocessor = preprocessor
        self.classifier = classifier
        self.feature_columns = list(feature_columns)
        self.id_columns = list(id_columns)
        self.priority_high = priority_high
        self.priority_medium = priority_medium
        self.version = version

    def _vectors(self, df: DataFrame, carry: Sequence[str]) -> DataFrame:
        chosen = select_scoring_columns(integers_to_double_except(df, carry), self.feature_columns, carry)
        return self.preprocessor.transform(chosen)

    def transform(self, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """Vectors and class probabilities, identifiers and ``carry`` columns kept."""
        keep = [*self.id_columns, *[c for c in carry if c not in self.id_columns]]
        return self.classifier.transform(self._vectors(df, keep))

    def predict(self, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """Lazy scored table; multiclass models add the probability array and predicted class."""
        ids = [c for c in [*self.id_columns, *carry] if c in df.columns and c not in self.feature_columns]
        scored = self.transform(df, carry)
        if self.classifier.task_type == "binary_classification":
            return scoring_output(
                scored, F.element_at("probabilities", 2), ids, self.version, self.priority_high, self.priority_medium
            )
        best = F.array_position("probabilities", F.array_max("probabilities")).cast("int")
        classes = F.array(*[F.lit(c) for c in self.classifier.classes])
        return scored.select(
            *[f"`{c}`" for c in ids],
            F.transform("probabilities", lambda p: F.bround(p, PROBABILITY_DECIMALS)).alias("probabilities"),
            F.element_at(classes, best).alias("predicted"),
            F.date_format(F.current_timestamp(), DATE_FORMAT).alias("prediction_date"),
            F.lit(self.version).alias("model_version"),
        )

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        session = active_session(spark)
        self.preprocessor.save(f"{path}/preprocessor")
        self.classifier.save(path, session)
        write_metadata(
            session,
            f"{path}/package",
            {
                "feature_columns": self.feature_columns,
                "id_columns": self.id_columns,
                "priority_high": self.priority_high,
                "priority_medium": self.priority_medium,
                "version": self.version,
            },
        )

    @classmethod
    def load(cls, path: str, spark: SparkSession | None = None) -> ScoringModel:
        session = active_session(spark)
        package = read_metadata(session, f"{path}/package")
        return cls(
            TabularPreprocessor.load(f"{path}/preprocessor", session), ClassifierModel.load(path, session), **package
        )


def integers_to_double_except(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Widen integral features, leave identifiers as they are."""
    widened = integers_to_double(df.drop(*keep)) if keep else integers_to_double(df)
    types = {f.name: f.dataType for f in widened.schema.fields}
    return df.select(
        *[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns]
    )


def load_model(model_uri: str, spark: SparkSession | None = None, registry: ModelRegistry | None = None) -> ScoringModel:
    session = active_session(spark)
    return ScoringModel.load((registry or ModelRegistry(session)).resolve(model_uri), session)


def _input(df: DataFrame | None, table: str | None, session: SparkSession) -> DataFrame:
    if df is not None:
        return df
    if table is None:
        raise ValueError("provide either input_df or input_table")
    return read_table(session, table)


def predict_with_registered_model(
    model_uri: str,
    input_df: DataFrame | None = None,
    input_table: str | None = None,
    output_table: str | None = None,
    mode: str = "overwrite",
    spark: SparkSession | None = None,
    registry: ModelRegistry | None = None,
) -> DataFrame:
    """Score a DataFrame or table; written only when ``output_table`` is given.

    ``merge`` replaces rows with the same identifiers. Files cannot be replaced while they are
    read, so the merged result is staged in the shared folder first.
    """
    session = active_session(spark)
    model = load_model(model_uri, session, registry)
    if mode == "merge" and not model.id_columns:
        raise ValueError("mode 'merge' needs a model with identifier columns")
    scored = model.predict(_input(input_df, input_table, session))
    if output_table is None:
        return scored
    if mode == "merge":
        staged = scratch_path(session, "merge")
        upsert(read_table(session, output_table), scored, model.id_columns).write.parquet(staged)
        write_table(session.read.parquet(staged), output_table, mode="overwrite")
    else:
        write_table(scored, output_table, mode=mode)
    return read_table(session, output_table)


@dataclass
class HoldoutEvaluationResult:
    """Metrics and predictions (with the target) of a holdout table."""

    metrics: dict[str, float]
    predictions: DataFrame
    row_count: int
    target_column: str
    model_uri: str | None = None
    output_table: str | None = None
    metadata: dict[str, Any] = field(default_factory=dict)


def evaluate_registered_model_on_holdout(
    model_uri: str,
    target_column: str,
    input_df: DataFrame | None = None,
    input_table: str | None = None,
    output_table: str | None = None,
    threshold: float = 0.5,
    mode: str = "overwrite",
    spark: SparkSession | None = None,
    registry: ModelRegistry | None = None,
) -> HoldoutEvaluationResult:
    """Score a labelled table and compute its metrics on the six-digit probability."""
    session = active_session(spark)
    df = _input(input_df, input_table, session)
    if target_column not in df.columns:
        raise KeyError(f"target column '{target_column}' not found in holdout data")
    model = load_model(model_uri, session, registry)
    if len(model.classifier.classes) != 2:
        raise ValueError("holdout metrics are defined for two classes; use ModelEvaluator for more")
    predictions = model.predict(df, carry=[target_column])
    if output_table is not None:
        write_table(predictions, output_table, mode=mode)
        predictions = read_table(session, output_table)
    metrics = compute_binary_holdout_metrics(
        predictions, target_column, "probability", threshold, "holdout", decimals=PROBABILITY_DECIMALS,
        positive=model.classifier.classes[-1],
    )
    rows = sum(metrics[f"holdout_{n}"] for n in ("tn", "fp", "fn", "tp"))
    return HoldoutEvaluationResult(metrics, predictions, int(rows), target_column, model_uri, output_table)


def join_truth(predictions: DataFrame, truth: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """Predictions with labels that arrived later."""
    return predictions.join(truth, list(id_columns), "inner")


class ModelPredictor:
    """Object form of scoring with one model."""

    def __init__(self, model_uri: str, spark: SparkSession | None = None, registry: ModelRegistry | None = None) -> None:
        self.model_uri = model_uri
        self.spark = spark
        self.registry = registry

    def predict(self, df: DataFrame) -> DataFrame:
        return predict(self.model_uri, df, spark=self.spark, registry=self.registry)


def predict(
    model_uri: str, df: DataFrame, *, spark: SparkSession | None = None, registry: ModelRegistry | None = None
) -> DataFrame:
    """Score a DataFrame with a saved or registered model."""
    return predict_with_registered_model(model_uri, input_df=df, spark=spark, registry=registry)
