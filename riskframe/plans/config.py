"""Training, scoring and job configuration with validation at construction."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from enum import Enum
from typing import Any

from riskframe.errors import InvalidConfigurationError
from riskframe.operators.encoding import CATEGORICAL_STRATEGIES, ENCODINGS, NUMERIC_STRATEGIES
from riskframe.operators.models import REGISTRY


class SplitStrategy(str, Enum):
    RANDOM = "random"
    STRATIFIED = "stratified"
    TEMPORAL = "temporal"


class TaskType(str, Enum):
    BINARY_CLASSIFICATION = "binary_classification"
    MULTICLASS_CLASSIFICATION = "multiclass_classification"


def _as_enum(name: str, value: Any, kind: type[Enum]) -> Enum:
    try:
        return kind(value)
    except ValueError as error:
        raise InvalidConfigurationError(name, value, [item.value for item in kind]) from error


def _require(name: str, value: Any, ok: bool, expected: Any) -> None:
    if not ok:
        raise InvalidConfigurationError(name, value, expected)


@dataclass
class TrainingConfig:
    """Everything a training run needs; see the README for the meaning of each field."""

    target_column: str = "TARGET"
    id_columns: list[str] = field(default_factory=list)
    feature_columns: list[str] | None = None
    exclude_columns: list[str] = field(default_factory=list)
    numeric_columns: list[str] | None = None
    categorical_columns: list[str] | None = None
    split_strategy: SplitStrategy = SplitStrategy.STRATIFIED
    test_size: float = 0.2
    validation_size: float = 0.2
    use_internal_test_split: bool = True
    random_state: int = 42
    temporal_column: str | None = None
    numeric_impute_strategy: str = "median"
    categorical_impute_strategy: str = "most_frequent"
    categorical_encoding: str = "ordinal"
    model_type: str = "xgboost"
    task_type: TaskType = TaskType.BINARY_CLASSIFICATION
    model_params: dict[str, Any] = field(default_factory=dict)
    early_stopping: bool = False
    run_name: str | None = None
    registered_model_name: str | None = None
    training_data_source: str | None = None
    environment: str | None = None
    priority_high_threshold: float = 0.8
    priority_medium_threshold: float = 0.5

    def __post_init__(self) -> None:
        self.split_strategy = _as_enum("split_strategy", self.split_strategy, SplitStrategy)
        self.task_type = _as_enum("task_type", self.task_type, TaskType)
        for field_name, holds, expected in self._rules():
            _require(field_name, getattr(self, field_name), holds, expected)

    def _rules(self) -> list[tuple[str, bool, Any]]:
        """(field, does it hold, what is allowed), choices first, then sizes, then how the column lists fit together."""
        choices = {
            "model_type": sorted(REGISTRY), "categorical_encoding": ENCODINGS,
            "numeric_impute_strategy": NUMERIC_STRATEGIES, "categorical_impute_strategy": CATEGORICAL_STRATEGIES,
        }
        rules: list[tuple[str, bool, Any]] = [(name, getattr(self, name) in allowed, allowed) for name, allowed in choices.items()]
        rules += [(name, 0 < getattr(self, name) < 1, "part of the rows, not none and not all") for name in ("test_size", "validation_size")]
        left = 1 - self.validation_size - (self.test_size if self.use_internal_test_split else 0)
        rules.append(("validation_size", left > 0, "rows left to train on"))
        rules.append(("temporal_column", bool(self.temporal_column) or self.split_strategy is not SplitStrategy.TEMPORAL, "the time of a row"))
        rules.append(("priority_medium_threshold", 0 <= self.priority_medium_threshold <= self.priority_high_threshold, "0 up to the high one"))
        rules.append(("priority_high_threshold", self.priority_high_threshold <= 1, "at most 1"))
        typed = [*(self.numeric_columns or ()), *(self.categorical_columns or ())]
        chosen = set(typed) if self.feature_columns is None else set(self.feature_columns)
        rules.append(("categorical_columns", len(set(typed)) == len(set(self.numeric_columns or ())) + len(set(self.categorical_columns or ())),
                      "no numeric column"))
        rules.append(("target_column", self.target_column not in {*typed, *chosen, *self.id_columns}, "neither feature nor identifier"))
        rules.append(("feature_columns", chosen >= set(typed), "every column with a declared type"))
        return rules

    def to_document(self) -> dict[str, Any]:
        """JSON-ready form stored next to the model."""
        document = asdict(self)
        document["split_strategy"] = self.split_strategy.value
        document["task_type"] = self.task_type.value
        return document


@dataclass
class InferenceConfig:
    """A batch scoring run."""

    model_uri: str = ""
    input_table: str | None = None
    output_table: str | None = None
    output_mode: str = "overwrite"
    id_columns: list[str] = field(default_factory=list)
    batch_size: int | None = None

    def __post_init__(self) -> None:
        _require("model_uri", self.model_uri, bool(self.model_uri), "a non-empty model location")
        modes = ("overwrite", "append", "merge")
        _require("output_mode", self.output_mode, self.output_mode in modes, modes)
        _require("batch_size", self.batch_size, self.batch_size is None or self.batch_size > 0, "a positive integer")


@dataclass(frozen=True)
class JobConfig:
    """Settings of the four scheduled steps; table names are paths below ``root`` or catalog names."""

    source_path: str
    root: str
    environment: str = "dev"
    target_column: str = "diagnosed_diabetes"
    id_columns: tuple[str, ...] = ()
    required_columns: tuple[str, ...] = ("age", "glucose_fasting", "bmi")
    write_mode: str = "overwrite"
    age_group_strategy: str = "detailed"
    validate_schema: bool = True
    contract_stage: str = "raw"
    allow_duplicate_rows: bool = False
    test_size: float = 0.2
    validation_size: float = 0.2
    random_state: int = 42
    stratify: bool = True
    model_type: str = "xgboost"
    model_params: dict[str, Any] = field(default_factory=dict)
    model_name: str = "risk_model"
    model_alias: str = "Champion"
    exclude_columns: tuple[str, ...] = ()
    min_roc_auc: float = 0.70
    min_recall: float = 0.60
    max_missing_ratio: float = 0.05
    drift_psi_threshold: float = 0.20
    fail_on_drift: bool = False

    def __post_init__(self) -> None:
        _require("environment", self.environment, self.environment in ("dev", "stg", "prd"), ("dev", "stg", "prd"))
        _require("contract_stage", self.contract_stage, self.contract_stage in ("raw", "clean"), ("raw", "clean"))
        _require("write_mode", self.write_mode, self.write_mode in ("overwrite", "append"), ("overwrite", "append"))

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"
