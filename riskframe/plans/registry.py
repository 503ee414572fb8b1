"""Model versions and promotions as append-only history tables."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import local_frame, shared_dir
from riskframe.sources.tables import append_history, read_history

VERSION_SCHEMA = "model string, version long, path string, registered_at timestamp"
PROMOTION_SCHEMA = "model string, alias string, version long, path string, promoted_at timestamp, gates string"


def current_promotions(promotions: DataFrame) -> DataFrame:
    """The latest promotion of every ``(model, alias)``; rolling back is promoting an older version."""
    latest = F.max_by(
        F.struct("version", "path", "promoted_at"), F.struct("promoted_at", "version")
    )
    return promotions.groupBy("model", "alias").agg(latest.alias("latest")).select("model", "alias", "latest.*")


class ModelRegistry:
    """Where fitted models live and which version an alias points to."""

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark = spark
        self.root = (root or spark.conf.get("spark.riskframe.modelRoot", None) or f"{shared_dir(spark)}/models").rstrip("/")
        self._versions = f"{self.root}/registry/versions"
        self._promotions = f"{self.root}/registry/promotions"

    def run_path(self, run_id: str) -> str:
        return f"{self.root}/runs/{run_id}"

    def _read(self, path: str, schema: str) -> DataFrame:
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        exists = hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop_path)
        return read_history(self.spark, path) if exists else local_frame(self.spark, [], schema)

    def versions(self) -> DataFrame:
        return self._read(self._versions, VERSION_SCHEMA)

    def promotions(self) -> DataFrame:
        return self._read(self._promotions, PROMOTION_SCHEMA)

    def next_version(self, model: str) -> int:
        last = self.versions().filter(F.col("model") == model).agg(F.max("version")).first()[0]
        return (last or 0) + 1

    def register(self, model: str, version: int, path: str) -> None:
        row = [(model, version, path, datetime.now(timezone.utc))]
        append_history(local_frame(self.spark, row, VERSION_SCHEMA).coalesce(1), self._versions)

    def set_alias(self, model: str, version: int, alias: str, gates: Mapping[str, object] | None = None) -> None:
        """Point an alias to a version (promotion and rollback)."""
        found = self.versions().filter((F.col("model") == model) & (F.col("version") == int(version))).head(1)
        if not found:
            raise ValueError(f"model '{model}' has no version {version}")
        row = [(model, alias, int(version), found[0].path, datetime.now(timezone.utc), str(dict(gates or {})))]
        append_history(local_frame(self.spark, row, PROMOTION_SCHEMA).coalesce(1), self._promotions)

    def current(self) -> DataFrame:
        return current_promotions(self.promotions())

    def resolve(self, model_uri: str) -> str:
        """Path of ``models:/name@alias``, ``models:/name/3``, ``runs:/id`` or a plain path."""
        if model_uri.startswith("runs:/"):
            return self.run_path(model_uri[len("runs:/"):].split("/")[0])
        if not model_uri.startswith("models:/"):
            return model_uri
        name = model_uri[len("models:/"):]
        if "@" in name:
            model, alias = name.rsplit("@", 1)
            rows = self.current().filter((F.col("model") == model) & (F.col("alias") == alias)).head(1)
        else:
            model, version = name.rsplit("/", 1)
            rows = self.versions().filter((F.col("model") == model) & (F.col("version") == int(version))).head(1)
        if not rows:
            raise ValueError(f"no registered model matches '{model_uri}'")
        return rows[0].path
