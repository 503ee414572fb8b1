"""Clinical, metabolic and lifestyle features as column expressions."""

from riskframe.operators.features.blocks import (
    BehavioralFeatureEngineer,
    ClinicalFeatureEngineer,
    DemographicsFeatureEngineer,
    LifestyleFeatureEngineer,
    MedicalFeatureEngineer,
    MetabolicFeatureEngineer,
)
from riskframe.operators.features.enrich import (
    FeatureEngineeringPipeline,
    FeatureTransformer,
    build_features,
)

__all__ = [
    "BehavioralFeatureEngineer",
    "ClinicalFeatureEngineer",
    "DemographicsFeatureEngineer",
    "FeatureEngineeringPipeline",
    "FeatureTransformer",
    "LifestyleFeatureEngineer",
    "MedicalFeatureEngineer",
    "MetabolicFeatureEngineer",
    "build_features",
]
