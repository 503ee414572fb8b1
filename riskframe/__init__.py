"""Spark-native tabular risk analytics."""

from riskframe.errors import (
    FeatureEngineeringError,
    InvalidConfigurationError,
    MissingRequiredColumnError,
    RiskFrameError,
    SchemaValidationError,
)
from riskframe.operators.attribution import BoostingShapExplainer, ShapResult
from riskframe.operators.cleaning import (
    DatasetPreprocessor,
    auto_detect_column_types,
    clean_categorical_variables,
    drop_leakage_columns,
    preprocess_dataset,
)
from riskframe.operators.contract import DataQualityReport, DataQualityValidator
from riskframe.operators.drift import DataDriftMonitor, DriftReport
from riskframe.operators.encoding import TabularPreprocessor
from riskframe.operators.features import FeatureEngineeringPipeline, FeatureTransformer, build_features
from riskframe.operators.metrics import compute_binary_holdout_metrics, compute_classification_metrics
from riskframe.operators.models import (
    CatBoostModel,
    GradientBoostingModel,
    LightGBMModel,
    LogisticRegressionModel,
    ModelFactory,
    RandomForestModel,
    XGBoostModel,
)
from riskframe.operators.profile import DatasetAnalysis, DatasetAnalyzer, analyze_dataset
from riskframe.operators.schema import DataSchemaValidator
from riskframe.operators.split import (
    DatasetSplitResult,
    SplitTablesResult,
    create_train_test_tables,
    split_dataframe,
)
from riskframe.plans.config import InferenceConfig, JobConfig, SplitStrategy, TaskType, TrainingConfig
from riskframe.plans.evaluation import EvaluationReport, ModelEvaluator
from riskframe.plans.registry import ModelRegistry
from riskframe.plans.scoring import (
    HoldoutEvaluationResult,
    ModelPredictor,
    ScoringModel,
    evaluate_registered_model_on_holdout,
    predict,
    predict_with_registered_model,
)
from riskframe.plans.training import (
    ModelTrainer,
    TrainingResult,
    evaluate_splits,
    train_boosting_model,
    train_model,
)
from riskframe.session import build_session
from riskframe.sources.tables import DatasetLoader, load_dataset, to_pandas, to_spark

__version__ = "0.1.0"

__all__ = sorted(name for name in globals() if not name.startswith("_") and name not in {"errors", "operators", "plans", "functions", "session", "sources"})
