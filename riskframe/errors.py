"""Exceptions raised by riskframe."""

from __future__ import annotations

from typing import Any, Iterable


class RiskFrameError(Exception):
    """Base class of every error raised on purpose by this package."""


class SchemaValidationError(RiskFrameError):
    """The input does not have the shape an operator needs."""


class MissingRequiredColumnError(SchemaValidationError):
    """One or more mandatory columns are absent."""

    def __init__(self, columns: Iterable[str]) -> None:
        self.columns = sorted(columns)
        super().__init__(f"missing required columns: {self.columns}")


class FeatureEngineeringError(RiskFrameError):
    """A feature block cannot be built."""


class InvalidConfigurationError(RiskFrameError, ValueError):
    """A configuration value is outside what is allowed."""

    def __init__(self, field: str, value: Any, expected: Any) -> None:
        self.field = field
        self.value = value
        self.expected = expected
        super().__init__(f"invalid {field}: {value!r} (expected {expected})")
