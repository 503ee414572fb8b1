"""Small JSON documents next to saved models, through Spark so any file system works."""

from __future__ import annotations

import json
from typing import Any, Mapping

from pyspark.sql import SparkSession

from riskframe.session import local_frame


def write_metadata(spark: SparkSession, path: str, document: Mapping[str, Any]) -> None:
    local_frame(spark, [(json.dumps(document),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_metadata(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])
