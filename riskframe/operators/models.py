"""Classifiers behind one interface, trained by Spark ML on all executors."""

from __future__ import annotations

from typing import Any, Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel as FittedLogistic,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import active_session, ensure_checkpoint_dir, local_frame
from riskframe.sources.metadata import read_metadata, write_metadata

SUPPORTED_TASK_TYPES = ("binary_classification", "multiclass_classification")
CHECKPOINT_INTERVAL = 10
LABEL_INDEX = "__label_index"
MAX_CLASSES = 1_000  # a column with more values is not a class label


class ClassifierModel:
    """Shared behaviour: ``fit`` / ``predict`` / ``predict_proba`` / importance / save / load.

    Inputs are DataFrames with an assembled vector column. Labels may be any values; they are
    numbered in sorted order.
    """

    defaults: dict[str, Any] = {}

    def __init__(
        self,
        params: Mapping[str, Any] | None = None,
        task_type: str = "binary_classification",
        features_column: str = "features",
    ) -> None:
        self.params = {**self.defaults, **(params or {})}
        self.task_type = task_type
        self.features_column = features_column
        self.model: Model | None = None
        self.feature_names: list[str] = []
        self.classes: list[Any] = []

    @property
    def model_name(self) -> str:
        return type(self).__name__

    @property
    def is_fitted(self) -> bool:
        return self.model is not None

    def _estimator(self, rows: int) -> Estimator:
        raise NotImplementedError

    def fit(
        self,
        train: DataFrame,
        label_column: str,
        *,
        feature_names: Sequence[str] = (),
        validation: DataFrame | None = None,
        early_stopping: bool = False,
    ) -> ClassifierModel:
        """Fit on ``train``; ``validation`` rows stop boosting early only when asked to."""
        self.feature_names = list(feature_names)
        labels = train.groupBy(F.col(label_column).alias("label")).agg(F.count("*").alias("n"))
        counted = labels.limit(MAX_CLASSES + 1).collect()
        if len(counted) > MAX_CLASSES:
            raise ValueError(f"'{label_column}' has more than {MAX_CLASSES} values and is not a class label")
        self.classes = sorted(r.label for r in counted)
        columns = [F.col(self.features_column), self._label_index(label_column).alias(LABEL_INDEX)]
        data = train.select(*columns)
        estimator = self._estimator(sum(r.n for r in counted))
        if early_stopping and validation is not None and isinstance(estimator, GBTClassifier):
            data = data.withColumn("__valid", F.lit(False)).unionByName(
                validation.select(*columns).withColumn("__valid", F.lit(True))
            )
            estimator = estimator.setValidationIndicatorCol("__valid")
        ensure_checkpoint_dir(train.sparkSession)  # long boosting runs cut their lineage there
        cached = data.persist()
        try:
            self.model = estimator.fit(cached)
        finally:
            cached.unpersist()
        return self

    def _label_index(self, label_column: str) -> Column:
        index = None
        for position, value in enumerate(self.classes):
            hit = F.col(label_column) == F.lit(value)
            index = F.when(hit, F.lit(float(position))) if index is None else index.when(hit, F.lit(float(position)))
        return index

    def _check_fitted(self) -> Model:
        if self.model is None:
            raise RuntimeError(f"{self.model_name} is not fitted; call fit() first")
        return self.model

    def transform(self, df: DataFrame, probability_column: str = "probabilities") -> DataFrame:
        """Append the class-probability array (in the order of ``classes``)."""
        model = self._check_fitted()
        raw = [c for c in ("rawPrediction", "probability", "prediction") if c in df.columns]
        scored = model.transform(df.drop(*raw))
        if isinstance(model, OneVsRestModel):
            # one margin per class and no probabilities: squash and normalize them
            margins = vector_to_array("rawPrediction")
            squashed = F.transform(margins, lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(-m)))
            scored = scored.withColumn("__s", squashed).withColumn(
                probability_column, F.transform("__s", lambda p: p / F.aggregate("__s", F.lit(0.0), lambda a, x: a + x))
            ).drop("__s")
        else:
            scored = scored.withColumn(probability_column, vector_to_array("probability"))
        return scored.drop("rawPrediction", "probability", "prediction")

    def predict_proba(self, df: DataFrame, column: str = "probability_score") -> DataFrame:
        """Positive-class probability for a binary task, the whole array otherwise."""
        scored = self.transform(df, "__p")
        value = F.element_at("__p", 2) if self.task_type == "binary_classification" else F.col("__p")
        return scored.withColumn(column, value).drop("__p")

    def predict(self, df: DataFrame, column: str = "predicted") -> DataFrame:
        """Most probable class."""
        scored = self.transform(df, "__p")
        position = F.array_position("__p", F.array_max("__p")).cast("int")
        labels = F.array(*[F.lit(c) for c in self.classes])
        return scored.withColumn(column, F.element_at(labels, position)).drop("__p")

    def get_feature_importance(self, spark: SparkSession | None = None) -> DataFrame:
        """``(feature, importance)``, largest first: impurity gain, or mean absolute coefficient."""
        model = self._check_fitted()
        if isinstance(model, FittedLogistic):
            matrix = model.coefficientMatrix.toArray()
            values = abs(matrix).mean(axis=0)
        elif isinstance(model, OneVsRestModel):
            values = sum(m.featureImportances.toArray() for m in model.models) / len(model.models)
        else:
            values = model.featureImportances.toArray()
        names = self.feature_names or [f"f{i}" for i in range(len(values))]
        rows = sorted(((n, float(v)) for n, v in zip(names, values)), key=lambda r: (-r[1], r[0]))
        return local_frame(active_session(spark), rows, "feature string, importance double")

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        self._check_fitted().write().overwrite().save(f"{path}/classifier")
        document = {
            "type": self.model_type(),
            "params": self.params,
            "task_type": self.task_type,
            "features_column": self.features_column,
            "feature_names": self.feature_names,
            "classes": self.classes,
        }
        write_metadata(active_session(spark), f"{path}/classifier_info", document)

    @classmethod
    def load(cls, path: str, spark: SparkSession | None = None) -> ClassifierModel:
        info = read_metadata(active_session(spark), f"{path}/classifier_info")
        loaded = REGISTRY[info["type"]](info["params"], info["task_type"], info["features_column"])
        loaded.feature_names, loaded.classes = info["feature_names"], info["classes"]
        readers = (FittedLogistic, RandomForestClassificationModel, GBTClassificationModel, OneVsRestModel)
        loaded.model = next(r for r in readers if r.__name__ == info_class(path, spark)).load(f"{path}/classifier")
        return loaded

    @classmethod
    def model_type(cls) -> str:
        return next(name for name, kind in REGISTRY.items() if kind is cls)

    def _common(self) -> dict[str, Any]:
        return {"featuresCol": self.features_column, "labelCol": LABEL_INDEX}


def info_class(path: str, spark: SparkSession | None) -> str:
    """Class name in the metadata of a saved ML model."""
    document = active_session(spark).read.json(f"{path}/classifier/metadata").select("class").first()[0]
    return document.rsplit(".", 1)[-1]


class LogisticRegressionModel(ClassifierModel):
    """L2-regularized logistic regression; ``C`` is the inverse strength as usual."""

    defaults = {"max_iter": 1000, "C": 1.0, "random_state": 42}

    def _estimator(self, rows: int) -> Estimator:
        return LogisticRegression(
            **self._common(),
            maxIter=int(self.params["max_iter"]),
            regParam=1.0 / (float(self.params["C"]) * max(rows, 1)),
            elasticNetParam=0.0,
            standardization=False,
            family="binomial" if self.task_type == "binary_classification" else "multinomial",
        )


class RandomForestModel(ClassifierModel):
    """Random forest; ``max_depth`` is bounded by Spark's limit of 30."""

    defaults = {"n_estimators": 300, "random_state": 42}

    def _estimator(self, rows: int) -> Estimator:
        depth = self.params.get("max_depth")
        return RandomForestClassifier(
            **self._common(),
            numTrees=int(self.params["n_estimators"]),
            maxDepth=30 if depth is None else int(depth),
            seed=int(self.params["random_state"]),
            checkpointInterval=CHECKPOINT_INTERVAL,
        )


class _BoostedModel(ClassifierModel):
    """Gradient-boosted trees, one-vs-rest for more than two classes.

    Parameters Spark's trees do not have (leaf penalties, column sampling per level, verbosity)
    are accepted and ignored.
    """

    def _estimator(self, rows: int) -> Estimator:
        depth = self.params.get("max_depth", self.params.get("depth", 3))
        trees = GBTClassifier(
            **self._common(),
            maxIter=int(self.params.get("n_estimators", self.params.get("iterations", 100))),
            stepSize=float(self.params.get("learning_rate", 0.1)),
            maxDepth=int(depth),
            subsamplingRate=float(self.params.get("subsample", 1.0)),
            featureSubsetStrategy=str(self.params.get("colsample_bytree", "all")),
            minInstancesPerNode=int(self.params.get("min_child_samples", 1)),
            maxBins=int(self.params.get("border_count", 32)),
            seed=int(self.params.get("random_state", self.params.get("random_seed", 42))),
            checkpointInterval=CHECKPOINT_INTERVAL,
        )
        if self.task_type == "binary_classification":
            return trees
        return OneVsRest(classifier=trees, **self._common())


class GradientBoostingModel(_BoostedModel):
    """Plain gradient boosting."""

    defaults = {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 3, "random_state": 42}


class XGBoostModel(_BoostedModel):
    """Boosting with the usual extreme-boosting defaults."""

    defaults = {
        "max_depth": 6, "learning_rate": 0.05, "n_estimators": 300,
        "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42,
    }


class LightGBMModel(_BoostedModel):
    """Boosting with leaf-wise library defaults mapped to depth."""

    defaults = {
        "max_depth": 6, "learning_rate": 0.05, "n_estimators": 300, "min_child_samples": 20,
        "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42,
    }


class CatBoostModel(_BoostedModel):
    """Boosting with symmetric-tree library defaults mapped to depth."""

    defaults = {"depth": 6, "learning_rate": 0.05, "iterations": 300, "border_count": 128, "random_seed": 42}


REGISTRY: dict[str, type[ClassifierModel]] = {
    "xgboost": XGBoostModel,
    "catboost": CatBoostModel,
    "lightgbm": LightGBMModel,
    "logistic_regression": LogisticRegressionModel,
    "random_forest": RandomForestModel,
    "gradient_boosting": GradientBoostingModel,
}


class ModelFactory:
    """Create a classifier by name."""

    @staticmethod
    def create(
        model_type: str,
        params: Mapping[str, Any] | None = None,
        task_type: str = "binary_classification",
        **options: Any,
    ) -> ClassifierModel:
        name = model_type.strip().lower()
        if name not in REGISTRY:
            raise ValueError(f"unknown model_type '{model_type}'; supported: {sorted(REGISTRY)}")
        if task_type not in SUPPORTED_TASK_TYPES:
            raise ValueError(f"unsupported task_type '{task_type}'; supported: {list(SUPPORTED_TASK_TYPES)}")
        return REGISTRY[name](params, task_type, **options)

    @staticmethod
    def list_supported() -> list[str]:
        return list(REGISTRY)


