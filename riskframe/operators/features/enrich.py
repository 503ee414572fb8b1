"""Full feature enrichment: protect ids and target, clean, derive, re-attach."""

from __future__ import annotations

from typing import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import nan_to_null
from riskframe.operators.cleaning import clean_categorical_variables, drop_leakage_columns
from riskframe.operators.features.blocks import (
    BehavioralFeatureEngineer,
    ClinicalFeatureEngineer,
    DemographicsFeatureEngineer,
    LifestyleFeatureEngineer,
    MedicalFeatureEngineer,
    MetabolicFeatureEngineer,
)
from riskframe.operators.schema import DataSchemaValidator


def resolve_age_ambiguity(df: DataFrame) -> DataFrame:
    """Keep ``Age`` when both spellings exist; names are case-insensitive in SQL."""
    if "Age" in df.columns and "age" in df.columns:
        by_position = ["__age_lower" if name == "age" else name for name in df.columns]
        return df.toDF(*by_position).drop("__age_lower")
    return df


def fold_nan(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """NaN becomes NULL in floating columns, because SQL orders NaN above every number."""
    floating = {
        field.name: nan_to_null(F.col(f"`{field.name}`"))
        for field in df.schema.fields
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)) and field.name not in skip
    }
    return df.withColumns(floating) if floating else df


class FeatureEngineeringPipeline:
    """Configuration of the enrichment; ``transform`` adds up to 32 features lazily.

    ``validate_schema=True`` runs the schema checks first: names and types on the driver, ranges
    and infinities in one aggregate job. Streaming inputs skip the aggregate.
    """

    def __init__(
        self,
        age_group_strategy: str = "detailed",
        validate_schema: bool = True,
        strict_ranges: bool = False,
    ) -> None:
        self.age_group_strategy = age_group_strategy
        self.validate_schema = validate_schema
        self.schema_validator = DataSchemaValidator(strict_ranges=strict_ranges)
        self.blocks = (
            DemographicsFeatureEngineer(age_group_strategy),
            MedicalFeatureEngineer(),
            ClinicalFeatureEngineer(),
            MetabolicFeatureEngineer(),
            BehavioralFeatureEngineer(),
            LifestyleFeatureEngineer(),
        )

    def transform(
        self,
        df: DataFrame,
        *,
        target_column: str | None = None,
        id_columns: Sequence[str] = (),
    ) -> DataFrame:
        protected = list(id_columns) + ([target_column] if target_column is not None else [])
        absent = sorted(set(protected) - set(df.columns))
        if absent:
            raise ValueError(f"protected columns are missing: {absent}")
        if self.validate_schema:
            unprotected = df.select(*[f"`{c}`" for c in df.columns if c not in protected])
            self.schema_validator.validate(unprotected)

        usable = resolve_age_ambiguity(df)
        droppable = drop_leakage_columns(usable, keep=protected)
        prepared = clean_categorical_variables(fold_nan(droppable, skip=protected), skip=protected)
        visible = [name for name in prepared.columns if name not in protected]
        features = {}
        for block in self.blocks:
            features.update(block.columns(visible))
        enriched = prepared.withColumns(features)
        others = [name for name in enriched.columns if name not in protected]
        return enriched.select(*[F.col(f"`{name}`") for name in protected + others])


def build_features(
    df: DataFrame,
    *,
    target_column: str | None = None,
    id_columns: Sequence[str] = (),
    pipeline: FeatureEngineeringPipeline | None = None,
) -> DataFrame:
    """Enrich a table, ids and target first and untouched."""
    return (pipeline or FeatureEngineeringPipeline()).transform(
        df, target_column=target_column, id_columns=id_columns
    )


class FeatureTransformer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The enrichment as a Spark ML stage, so it can be saved inside a ``PipelineModel``."""

    ageGroupStrategy = Param(Params._dummy(), "ageGroupStrategy", "detailed or coarse", TypeConverters.toString)
    targetColumn = Param(Params._dummy(), "targetColumn", "protected target, may be empty", TypeConverters.toString)
    idColumns = Param(Params._dummy(), "idColumns", "protected identifiers", TypeConverters.toListString)
    validateSchema = Param(Params._dummy(), "validateSchema", "run schema checks", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, ageGroupStrategy="detailed", targetColumn="", idColumns=(), validateSchema=False):
        super().__init__()
        self._setDefault(ageGroupStrategy="detailed", targetColumn="", idColumns=[], validateSchema=False)
        values = dict(self._input_kwargs)
        if "idColumns" in values:
            values["idColumns"] = list(values["idColumns"])
        self._set(**values)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        target = self.getOrDefault(self.targetColumn)
        # scoring inputs usually carry no target
        target = target if target and target in dataset.columns else None
        pipeline = FeatureEngineeringPipeline(
            self.getOrDefault(self.ageGroupStrategy), self.getOrDefault(self.validateSchema)
        )
        return pipeline.transform(
            dataset, target_column=target, id_columns=self.getOrDefault(self.idColumns)
        )
