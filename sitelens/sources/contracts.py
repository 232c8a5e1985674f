"""Column-presence contracts (S10) shared by readers and operators."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame


class ContractError(ValueError):
    """A required column is missing; the stage stops with one clear error."""


def missing_columns(df: DataFrame, cols) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c not in have]


def require_columns(df: DataFrame, cols, severity: str = "stop") -> list[str]:
    """Check that ``cols`` exist. ``stop`` raises :class:`ContractError`,
    ``warn`` emits a warning, ``assert`` raises ``AssertionError``.
    Returns the missing names (metadata only, no Spark job)."""
    missing = missing_columns(df, cols)
    if missing:
        msg = f"missing required columns: {missing}"
        if severity == "stop":
            raise ContractError(msg)
        if severity == "assert":
            raise AssertionError(msg)
        if severity == "warn":
            warnings.warn(msg, stacklevel=2)
        else:
            raise ValueError(f"unknown severity {severity!r}")
    return missing
