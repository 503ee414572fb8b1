"""Contribution tables: how much every feature moved every prediction from the base value.

Linear models are explained by column expressions. Tree ensembles need a walk over the trees per
row, which runs in Arrow batches next to the data; the shape of the result is the same: one array
of contributions per row. Rankings, waterfalls and scatter tables are array expressions on it, so
nothing below needs a shuffle except the final mean per feature.
"""

from __future__ import annotations

from typing import Any, Iterator, Sequence

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.models import ClassifierModel
from riskframe.session import scratch_path

VALUES, CONTRIBUTIONS, BASE = "feature_values", "contributions", "base_value"


def linear_contributions(
    df: DataFrame,
    coefficients: Sequence[float],
    intercept: float,
    columns: Sequence[str],
    *,
    means: Sequence[float] | None = None,
) -> DataFrame:
    """Exact additive contributions ``coef * (x - mean)`` of a linear model on plain columns."""
    if means is None:
        row = df.agg(*[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
        means = [row[f"m{i}"] for i in range(len(columns))]
    parts = [
        (F.col(f"`{c}`").cast("double") - F.lit(float(m))) * F.lit(float(k))
        for c, k, m in zip(columns, coefficients, means)
    ]
    base = float(intercept) + sum(float(k) * float(m) for k, m in zip(coefficients, means))
    return df.withColumns(
        {
            VALUES: F.array(*[F.col(f"`{c}`").cast("double") for c in columns]),
            CONTRIBUTIONS: F.array(*parts),
            BASE: F.lit(base),
        }
    )


def _tree_rows(model: Any, spark) -> list:
    """Nodes of every tree, read from the model's own saved form (bounded by the model size)."""
    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData")
    return data.select(
        "treeID",
        node["id"].alias("id"),
        node["prediction"].alias("prediction"),
        node["impurityStats"].alias("stats"),
        node["rawCount"].alias("cover"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        node["split"]["leftCategoriesOrThreshold"].alias("points"),
        node["split"]["numCategories"].alias("categories"),
    ).collect()


def leaf_paths(model: Any, spark) -> list[tuple[float, list[tuple[int, float, list]]]]:
    """``(value, [(feature, zero_fraction, conditions)])`` of every leaf of the ensemble.

    ``zero_fraction`` is the share of training rows that follow the path when the feature is
    unknown; ``conditions`` are ``(is_threshold, points, go_left)`` tests on that feature.
    """
    weights = list(model.treeWeights)
    if isinstance(model, RandomForestClassificationModel):
        weights = [1.0 / len(weights)] * len(weights)
    trees: dict[int, dict[int, Any]] = {}
    for row in _tree_rows(model, spark):
        trees.setdefault(row.treeID, {})[row.id] = row
    leaves = []
    for tree_id, nodes in trees.items():
        stack: list[tuple[int, dict[int, list]]] = [(0, {})]
        while stack:
            node_id, path = stack.pop()
            node = nodes[node_id]
            if node.left < 0:
                if isinstance(model, RandomForestClassificationModel):
                    value = node.stats[1] / sum(node.stats)
                else:
                    value = node.prediction
                leaves.append((value * weights[tree_id], [(f, z, tests) for f, (z, tests) in sorted(path.items())]))
                continue
            for child, go_left in ((node.left, True), (node.right, False)):
                share = nodes[child].cover / node.cover if node.cover else 0.0
                test = (node.categories == -1, list(node.points), go_left)
                z, tests = path.get(node.feature, (1.0, []))
                stack.append((child, {**path, node.feature: (z * share, tests + [test])}))
    return leaves


def _expected_value(leaves: list) -> float:
    total = 0.0
    for value, path in leaves:
        for _, zero, _ in path:
            value *= zero
        total += value
    return total


def _explain_batches(leaves: list, feature_count: int, carried: Sequence[str]):
    """Batch function computing path-dependent Shapley values (the published leaf-wise form).

    For one leaf the game is a product over its features, so the Shapley weights are sums over
    polynomial coefficients. Rows matter only through which path tests they pass; leaves with few
    features use a table over all outcomes.
    """

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from math import factorial

        import numpy as np
        import pyarrow as pa

        def leaf_values(outcomes, zeros, value):
            # outcomes: (patterns, d) of 0/1; returns contributions (patterns, d)
            patterns, d = outcomes.shape
            weights = np.array([factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)])
            result = np.zeros((patterns, d))
            for i in range(d):
                coefficients = np.zeros((patterns, d))
                coefficients[:, 0] = 1.0
                for j in range(d):
                    if j != i:
                        shifted = np.zeros_like(coefficients)
                        shifted[:, 1:] = coefficients[:, :-1] * outcomes[:, [j]]
                        coefficients = coefficients * zeros[j] + shifted
                result[:, i] = value * (outcomes[:, i] - zeros[i]) * (coefficients @ weights)
            return result

        def passes(column, tests):
            ok = np.ones(len(column), dtype=bool)
            for is_threshold, points, go_left in tests:
                left = column <= points[0] if is_threshold else np.isin(column, points)
                ok &= left if go_left else ~left
            return ok

        tables = {}
        for batch in batches:
            rows = batch.num_rows
            flat = batch.column(batch.schema.get_field_index(VALUES)).flatten()
            matrix = np.ascontiguousarray(flat.to_numpy(zero_copy_only=False).reshape(rows, feature_count).T).T
            total = np.zeros((rows, feature_count))
            for index, (value, path) in enumerate(leaves):
                d = len(path)
                if d == 0:
                    continue
                features = [f for f, _, _ in path]
                zeros = [z for _, z, _ in path]
                hits = np.stack([passes(matrix[:, f], tests) for f, _, tests in path], axis=1)
                if d <= 8:
                    if index not in tables:
                        every = (np.arange(2**d)[:, None] >> np.arange(d)) & 1
                        tables[index] = leaf_values(every.astype(float), zeros, value)
                    codes = hits @ (1 << np.arange(d))
                    found = tables[index][codes]
                else:
                    unique, inverse = np.unique(hits, axis=0, return_inverse=True)
                    found = leaf_values(unique.astype(float), zeros, value)[inverse.reshape(-1)]
                total[:, features] += found
            offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * feature_count)
            contributions = pa.ListArray.from_arrays(offsets, pa.array(total.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, contributions], [*carried, CONTRIBUTIONS])

    return explain


def tree_contributions(df: DataFrame, model: Any, features_column: str = "features") -> DataFrame:
    """Shapley contributions of a forest or boosted ensemble for the positive class.

    Boosted trees are explained on the margin, forests on the probability; contributions plus the
    base value add up to that output.
    """
    spark = df.sparkSession
    leaves = leaf_paths(model, spark)
    with_values = df.withColumn(VALUES, vector_to_array(features_column)).drop(features_column)
    schema = T.StructType(
        list(with_values.schema.fields) + [T.StructField(CONTRIBUTIONS, T.ArrayType(T.DoubleType()))]
    )
    explain = _explain_batches(leaves, model.numFeatures, with_values.columns)
    return with_values.mapInArrow(explain, schema).withColumn(BASE, F.lit(_expected_value(leaves)))


class ShapResult:
    """Contributions of a table as a DataFrame plus the tables derived from it."""

    def __init__(self, frame: DataFrame, feature_names: Sequence[str]) -> None:
        self.frame = frame
        self.feature_names = list(feature_names)

    def _names(self) -> Column:
        return F.array(*[F.lit(n) for n in self.feature_names])

    def wide(self, id_columns: Sequence[str] = ()) -> DataFrame:
        """One column per feature."""
        return self.frame.select(
            *id_columns, *[F.element_at(CONTRIBUTIONS, i + 1).alias(n) for i, n in enumerate(self.feature_names)]
        )

    def long(self, id_columns: Sequence[str] = ()) -> DataFrame:
        """``(ids…, feature, value, contribution)``."""
        pairs = F.zip_with(
            F.col(VALUES),
            F.col(CONTRIBUTIONS),
            lambda v, c: F.struct(v.alias("value"), c.alias("contribution")),
        )
        named = F.zip_with(
            self._names(),
            pairs,
            lambda n, s: F.struct(n.alias("feature"), s["value"].alias("value"), s["contribution"].alias("contribution")),
        )
        return self.frame.select(*id_columns, F.inline(named))

    def mean_abs(self) -> DataFrame:
        """``(feature, mean_abs_contribution)``, largest first: one aggregate over the array slots."""
        slots = [F.avg(F.abs(F.element_at(CONTRIBUTIONS, i + 1))).alias(f"s{i}") for i in range(len(self.feature_names))]
        entries = F.array(
            *[F.struct(F.lit(n).alias("feature"), F.col(f"s{i}").alias("mean_abs_contribution"))
              for i, n in enumerate(self.feature_names)]
        )
        return self.frame.agg(*slots).select(F.inline(entries)).orderBy(F.desc("mean_abs_contribution"), "feature")

    def top_features(self, n: int = 10) -> DataFrame:
        return self.mean_abs().limit(n)

    def scatter(self, id_columns: Sequence[str] = (), n: int = 20) -> DataFrame:
        """Long table of the ``n`` strongest features (value against contribution)."""
        names = [r.feature for r in self.top_features(n).collect()]
        return self.long(id_columns).filter(F.col("feature").isin(names))

    def waterfall(self, id_columns: Sequence[str], max_display: int = 10) -> DataFrame:
        """``(ids…, position, feature, contribution, start_value, end_value)`` for every row.

        The ``max_display`` strongest features are kept, the rest is summed as one entry that
        comes first; then contributions run in ascending strength from the base value. Sorting
        happens inside each row's array.
        """
        ranked = F.array_sort(
            F.zip_with(
                self._names(),
                F.col(CONTRIBUTIONS),
                lambda n, c: F.struct((-F.abs(c)).alias("strength"), n.alias("feature"), c.alias("contribution")),
            )
        )
        total = len(self.feature_names)
        others = max(total - max_display, 0)
        shown = F.reverse(F.slice(F.col("ranked"), 1, max_display))
        entry = lambda s: F.struct(s["feature"].alias("feature"), s["contribution"].alias("contribution"))
        bars = F.transform(shown, entry)
        if others:
            rest = F.aggregate(
                F.slice(F.col("ranked"), max_display + 1, others), F.lit(0.0), lambda a, s: a + s["contribution"]
            )
            first = F.struct(F.lit(f"{others} other features").alias("feature"), rest.alias("contribution"))
            bars = F.concat(F.array(first), bars)
        exploded = (
            self.frame.withColumn("ranked", ranked)
            .withColumn("bars", bars)
            .select(*id_columns, BASE, "bars", F.posexplode_outer("bars").alias("position", "bar"))
        )
        before = F.aggregate(
            F.slice(F.col("bars"), F.lit(1), F.col("position")), F.col(BASE), lambda a, s: a + s["contribution"]
        )
        return exploded.withColumn("start_value", before).select(
            *id_columns,
            F.col("position").cast("long").alias("position"),
            F.col("bar.feature").alias("feature"),
            F.col("bar.contribution").alias("contribution"),
            "start_value",
            (F.col("start_value") + F.col("bar.contribution")).alias("end_value"),
        )


class BoostingShapExplainer:
    """Explain a fitted classifier on a table with an assembled feature vector."""

    def __init__(self, model: ClassifierModel, feature_names: Sequence[str] | None = None) -> None:
        if not model.is_fitted:
            raise RuntimeError("the model must be fitted before it can be explained")
        self.classifier = model
        self.feature_names = list(feature_names or model.feature_names)
        self._result: ShapResult | None = None

    def fit(self, df: DataFrame) -> BoostingShapExplainer:
        column = self.classifier.features_column
        complete = df.filter(F.col(column).isNotNull())
        model = self.classifier.model
        if isinstance(model, LogisticRegressionModel):
            values = complete.withColumn("__x", vector_to_array(column)).drop(column)
            names = [f"__x{i}" for i in range(model.numFeatures)]
            plain = values.select("*", *[F.element_at("__x", i + 1).alias(n) for i, n in enumerate(names)])
            frame = linear_contributions(plain, list(model.coefficients), model.intercept, names).drop("__x", *names)
        elif isinstance(model, (GBTClassificationModel, RandomForestClassificationModel)):
            frame = tree_contributions(complete, model, column)
        else:
            raise RuntimeError(f"no explainer for {type(model).__name__}")
        self._result = ShapResult(frame, self.feature_names or [f"f{i}" for i in range(model.numFeatures)])
        return self

    @property
    def result(self) -> ShapResult:
        if self._result is None:
            raise RuntimeError("the explainer is not fitted; call fit() first")
        return self._result

    def get_shap_dataframe(self, id_columns: Sequence[str] = ()) -> DataFrame:
        return self.result.wide(id_columns)

    def top_features(self, n: int = 10) -> DataFrame:
        return self.result.top_features(n)

    def waterfall_of(self, id_column: str, value: Any, max_display: int = 10) -> DataFrame:
        """Waterfall of a single row, an error when the identifier does not occur."""
        rows = self.result.waterfall([id_column], max_display).filter(F.col(id_column) == F.lit(value))
        if rows.isEmpty():
            raise IndexError(f"{id_column}={value!r} is not among the explained rows")
        return rows
