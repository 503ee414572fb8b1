"""Structured Streaming forms of the stateless operators.

Features, recodes and priority labels are projections, so a stream needs no watermark and no
state. The contract and the drift monitor look at one micro-batch at a time.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from riskframe.operators.cleaning import preprocess_dataset
from riskframe.operators.contract import DataQualityValidator
from riskframe.operators.drift import DataDriftMonitor
from riskframe.operators.features import FeatureEngineeringPipeline
from riskframe.sources.tables import write_batch


def stream_features(
    stream: DataFrame, *, target_column: str | None = None, id_columns: Sequence[str] = ()
) -> DataFrame:
    """Clean and enrich a streaming (or batch) table without state."""
    cleaned = preprocess_dataset(stream, drop_duplicates=False)
    return FeatureEngineeringPipeline(validate_schema=False).transform(
        cleaned, target_column=target_column, id_columns=id_columns
    )


def _per_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            handle(batch, batch_id)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def contract_per_batch(
    stream: DataFrame, validator: DataQualityValidator, history_path: str, checkpoint: str
) -> DataStreamWriter:
    """Write the contract checks of every micro-batch below ``batch_id=N`` of a history location; replays replace."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        checks = validator.validate(batch).to_dataframe(batch.sparkSession)
        write_batch(checks.coalesce(1), history_path, batch_id)

    return _per_batch(stream, handle, checkpoint)


def drift_per_batch(
    stream: DataFrame, reference: DataFrame, monitor: DataDriftMonitor, history_path: str, checkpoint: str
) -> DataStreamWriter:
    """Write the drift of every micro-batch against a fixed reference below ``batch_id=N`` of a history location; replays
    replace."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        metrics = monitor.compare(reference, batch).metrics
        write_batch(metrics.coalesce(1), history_path, batch_id)

    return _per_batch(stream, handle, checkpoint)
