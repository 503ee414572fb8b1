"""Streaming entry points: the stateless projections, and per-batch contract and drift."""

from riskframe.streaming.micro_batch import contract_per_batch, drift_per_batch, stream_features

__all__ = ["contract_per_batch", "drift_per_batch", "stream_features"]
