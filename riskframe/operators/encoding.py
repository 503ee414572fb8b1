"""Imputation and encoding learned from training rows, applied as persistable ML stages."""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import to_number
from riskframe.functions.ranking import exact_quantiles, global_index
from riskframe.operators.cleaning import auto_detect_column_types

# --- fixed values ----------------------------------------------------------------------
UNKNOWN_CODE = -1
#: Code of a missing value where it is told apart from unknown ones.
MISSING_CODE = -2
CONSTANT_CATEGORY = "missing"
CONSTANT_NUMBER = 0.0

NUMERIC_STRATEGIES = ("mean", "median", "constant")
CATEGORICAL_STRATEGIES = ("most_frequent", "constant")
ENCODINGS = ("ordinal", "onehot")
MAX_MODEL_CATEGORIES = 1_000_000  # labels a fitted model may carry to the executors
WINDOW_CODE_ROWS = 1_000_000  # distinct categories numbered by a plain window
MAX_BROADCAST_CODES = 1_000_000  # vocabulary entries sent to every executor


def numeric_fill_values(df: DataFrame, columns: Sequence[str], strategy: str) -> dict[str, float]:
    """Replacement per numeric column; a column without any value is filled with zero."""
    if strategy not in NUMERIC_STRATEGIES:
        raise ValueError(f"numeric strategy must be one of {NUMERIC_STRATEGIES}")
    if not columns or strategy == "constant":
        return {c: CONSTANT_NUMBER for c in columns}
    if strategy == "median":
        medians = exact_quantiles(df, columns, (0.5,))
        return {c: medians[c][0] if medians[c] else CONSTANT_NUMBER for c in columns}
    row = df.agg(*[F.avg(to_number(F.col(f"`{c}`"))).alias(f"a{i}") for i, c in enumerate(columns)]).first()
    return {c: CONSTANT_NUMBER if row[f"a{i}"] is None else row[f"a{i}"] for i, c in enumerate(columns)}


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, n)`` of the non-missing categories of all columns, one shuffle."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(entries))
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )


def most_frequent(counts: DataFrame) -> DataFrame:
    """``(feature, value)`` with the highest count, the smallest value among equals."""
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value")))
    return counts.groupBy("feature").agg(best.alias("best")).select("feature", F.col("best.value").alias("value"))


def vocabulary(df: DataFrame, columns: Sequence[str], *, counts: DataFrame | None = None) -> DataFrame:
    """``(feature, value, code)``: sorted distinct categories numbered from zero.

    Distinct categories are numbered by a window per feature as long as there are few; beyond
    that by a range-partitioned sort over all executors.
    """
    distinct = (counts if counts is not None else category_counts(df, columns)).select("feature", "value")
    total = distinct.count()
    if total <= WINDOW_CODE_ROWS:
        order = Window.partitionBy("feature").orderBy("value")
        return distinct.withColumn("code", F.row_number().over(order) - 1)
    numbered = global_index(distinct, ["feature", "value"], "position")
    first = numbered.groupBy("feature").agg(F.min("position").alias("first"))
    # one row per feature
    return numbered.join(F.broadcast(first), "feature").select(
        "feature", "value", (F.col("position") - F.col("first")).alias("code")
    )


def encode_with_vocabulary(df: DataFrame, codes: DataFrame, columns: Sequence[str], suffix: str = "_code", missing_code: int = UNKNOWN_CODE) -> DataFrame:
    """Left lookup of every categorical column; unknown values become -1, missing ones ``missing_code`` (-1 as well, or
    ``MISSING_CODE`` to tell them apart).

    A vocabulary of counted, bounded size is broadcast, so the rows stay where they are; a larger
    one is joined by shuffle (adaptive execution splits hot categories).
    """
    result = df
    codes = codes.persist()
    small = codes.count() <= MAX_BROADCAST_CODES
    if not small:
        codes.unpersist()
    for i, name in enumerate(columns):
        lookup = codes.filter(F.col("feature") == name).select(
            F.col("value").alias(f"__value{i}"), F.col("code").alias(f"__code{i}")
        )
        lookup = F.broadcast(lookup) if small else lookup
        result = (
            result.join(lookup, F.col(f"`{name}`").cast("string") == F.col(f"__value{i}"), "left")
            .withColumn(f"{name}{suffix}", F.when(F.col(f"`{name}`").isNull(), missing_code).otherwise(
                F.coalesce(F.col(f"__code{i}"), F.lit(UNKNOWN_CODE))).cast("long"))
            .drop(f"__value{i}", f"__code{i}")
        )
    return result


def impute(df: DataFrame, numbers: dict[str, float], categories: dict[str, str]) -> DataFrame:
    """Fill missing values with learned constants."""
    filled: dict[str, Column] = {
        c: F.coalesce(to_number(F.col(f"`{c}`")), F.lit(float(v))) for c, v in numbers.items()
    }
    filled.update({c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(v)) for c, v in categories.items()})
    return df.withColumns(filled)


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class TabularPreprocessor:
    """Median/mode imputation and ordinal or one-hot encoding of a table.

    ``fit`` looks at the given rows only. The fitted form is a ``PipelineModel`` of built-in
    stages: an imputing projection, a string indexer with a sorted vocabulary, a projection
    that maps unseen categories to -1 (or the one-hot encoder), and a vector assembler.
    """

    def __init__(
        self,
        numeric_columns: Sequence[str] | None = None,
        categorical_columns: Sequence[str] | None = None,
        numeric_impute_strategy: str = "median",
        categorical_impute_strategy: str = "most_frequent",
        categorical_encoding: str = "ordinal",
        output_column: str = "features",
    ) -> None:
        if numeric_impute_strategy not in NUMERIC_STRATEGIES:
            raise ValueError(f"numeric_impute_strategy must be one of {NUMERIC_STRATEGIES}")
        if categorical_impute_strategy not in CATEGORICAL_STRATEGIES:
            raise ValueError(f"categorical_impute_strategy must be one of {CATEGORICAL_STRATEGIES}")
        if categorical_encoding not in ENCODINGS:
            raise ValueError(f"categorical_encoding must be one of {ENCODINGS}")
        self.numeric_columns = list(numeric_columns or [])
        self.categorical_columns = list(categorical_columns or [])
        self.numeric_impute_strategy = numeric_impute_strategy
        self.categorical_impute_strategy = categorical_impute_strategy
        self.categorical_encoding = categorical_encoding
        self.output_column = output_column
        self.model: PipelineModel | None = None
        self.feature_names_out: list[str] = []

    def fit(self, df: DataFrame) -> TabularPreprocessor:
        numbers = numeric_fill_values(df, self.numeric_columns, self.numeric_impute_strategy)
        fills, labels = self._learn_categories(df)
        projections = [
            f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {float(v)!r}D) AS `{self._imputed(c)}`"
            for c, v in numbers.items()
        ]
        projections += [
            f"coalesce(CAST(`{c}` AS STRING), {_sql_text(fills[c])}) AS `{self._imputed(c)}`"
            for c in self.categorical_columns
        ]
        stages: list[Any] = [SQLTransformer(statement=f"SELECT *, {', '.join(projections)} FROM __THIS__")]
        inputs = [self._imputed(c) for c in self.numeric_columns]
        names = list(self.numeric_columns)
        if self.categorical_columns:
            indexed = [f"__index_{c}" for c in self.categorical_columns]
            stages.append(
                StringIndexerModel.from_arrays_of_labels(
                    [labels[c] for c in self.categorical_columns],
                    [self._imputed(c) for c in self.categorical_columns],
                    indexed,
                    "keep",
                )
            )
            encoded = [f"__encoded_{c}" for c in self.categorical_columns]
            if self.categorical_encoding == "ordinal":
                # the indexer gives an unseen category the index after the last one
                cases = [
                    f"CASE WHEN `__index_{c}` = {len(labels[c])} THEN {float(UNKNOWN_CODE)}D "
                    f"ELSE `__index_{c}` END AS `__encoded_{c}`"
                    for c in self.categorical_columns
                ]
                stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(cases)} FROM __THIS__"))
                names += self.categorical_columns
            else:
                # dropping the last slot removes the one for unseen categories: they are all zeros
                stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True))
                names += [f"{c}_{value}" for c in self.categorical_columns for value in labels[c]]
            inputs += encoded
        stages.append(VectorAssembler(inputCols=inputs, outputCol=self.output_column))
        helpers = [self._imputed(c) for c in self.numeric_columns + self.categorical_columns]
        helpers += [f"__{p}_{c}" for c in self.categorical_columns for p in ("index", "encoded")]
        stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{h}`' for h in helpers)}) FROM __THIS__"))
        # the one-hot stage reads its sizes from column metadata, so fitting needs no data pass
        self.model = Pipeline(stages=stages).fit(df.limit(0))
        self.feature_names_out = names
        return self

    def _learn_categories(self, df: DataFrame) -> tuple[dict[str, str], dict[str, list[str]]]:
        columns = self.categorical_columns
        if not columns:
            return {}, {}
        # bounded by the check below; a model cannot carry more labels anyway
        counted = category_counts(df, columns).limit(MAX_MODEL_CATEGORIES + 1).collect()
        if len(counted) > MAX_MODEL_CATEGORIES:
            raise ValueError(
                f"more than {MAX_MODEL_CATEGORIES} categories cannot be carried by a model; "
                "exclude identifier-like columns or use encode_with_vocabulary"
            )
        fills = {c: CONSTANT_CATEGORY for c in columns}
        labels: dict[str, list[str]] = {c: [] for c in columns}
        for row in sorted(counted, key=lambda r: (-r.n, r.value)):
            if not labels[row.feature] and self.categorical_impute_strategy == "most_frequent":
                fills[row.feature] = row.value
            labels[row.feature].append(row.value)
        if self.categorical_impute_strategy == "constant":
            missing = df.agg(*[F.max(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(columns)]).first()
            for i, c in enumerate(columns):
                if missing[f"m{i}"] and CONSTANT_CATEGORY not in labels[c]:
                    labels[c].append(CONSTANT_CATEGORY)
        return fills, {c: sorted(v) if v else [fills[c]] for c, v in labels.items()}

    @staticmethod
    def _imputed(name: str) -> str:
        return f"__imputed_{name}"

    def transform(self, df: DataFrame) -> DataFrame:
        """Append the feature vector."""
        if self.model is None:
            raise RuntimeError("TabularPreprocessor is not fitted; call fit() first")
        return self.model.transform(df)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def save(self, path: str) -> None:
        if self.model is None:
            raise RuntimeError("TabularPreprocessor is not fitted; call fit() first")
        self.model.write().overwrite().save(f"{path}/stages")
        from riskframe.sources.metadata import write_metadata

        write_metadata(self.model_session(), f"{path}/config", {**self.get_config(), "names": self.feature_names_out})

    @classmethod
    def load(cls, path: str, spark=None) -> TabularPreprocessor:
        from riskframe.session import active_session
        from riskframe.sources.metadata import read_metadata

        config = read_metadata(active_session(spark), f"{path}/config")
        names = config.pop("names")
        loaded = cls(**config)
        loaded.model = PipelineModel.load(f"{path}/stages")
        loaded.feature_names_out = names
        return loaded

    @staticmethod
    def model_session():
        from riskframe.session import active_session

        return active_session()

    def get_config(self) -> dict[str, Any]:
        return {
            "numeric_columns": self.numeric_columns,
            "categorical_columns": self.categorical_columns,
            "numeric_impute_strategy": self.numeric_impute_strategy,
            "categorical_impute_strategy": self.categorical_impute_strategy,
            "categorical_encoding": self.categorical_encoding,
        }


__all__ = [
    "TabularPreprocessor",
    "auto_detect_column_types",
    "category_counts",
    "encode_with_vocabulary",
    "impute",
    "most_frequent",
    "numeric_fill_values",
    "vocabulary",
]
