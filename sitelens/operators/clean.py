"""Projections, renames, filters and missing-value handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.functions._util import col
from sitelens.functions.numeric import coerce_numeric, nan_to_null
from sitelens.sources.contracts import require_columns


def strip_column_names(df: DataFrame) -> DataFrame:
    """Trim blanks around every column name (metadata only)."""
    return df.toDF(*[c.strip() for c in df.columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map; names that are absent are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def relabel(df: DataFrame, names: list[str]) -> DataFrame:
    """Positional re-heading of all columns."""
    return df.toDF(*names)


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Ordered projection of the wanted columns that exist."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def select_strict(df: DataFrame, cols: list[str]) -> DataFrame:
    """P5: ordered projection; an absent column stops the stage."""
    require_columns(df, cols, "stop")
    return df.select(*cols)


def equals(df: DataFrame, column: str, value) -> DataFrame:
    """Exact-case equality filter; missing values are excluded."""
    return df.filter(F.col(column) == F.lit(value))


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL (or NaN)."""
    require_columns(df, cols, "stop")
    return df.dropna(how="any", subset=cols)


def drop_null_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys stay NULL (never the text 'nan'), so the sentinel filter is a
    NULL filter."""
    return df.filter(F.col(key).isNotNull())


def above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """P10: strict ``>`` threshold; NULL never passes (NaN is NULL by then)."""
    return df.filter(F.col(column) > F.lit(threshold))


def in_range(c: str | Column, lo: float, hi: float) -> Column:
    """Inclusive range predicate."""
    return col(c).between(lo, hi)


def violates(predicate: Column) -> Column:
    """Negation that counts a missing operand as a violation."""
    return ~F.coalesce(predicate, F.lit(False))


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL/NaN -> 0 on the named columns only."""
    return df.fillna(0, subset=cols)


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """Source-boundary rule: every float/double NaN becomes NULL."""
    floats = {f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    return df.withColumns({c: nan_to_null(c) for c in floats})


def coerce_columns(df: DataFrame, cols: list[str], severity: str = "stop") -> DataFrame:
    """K1 over named columns: numbers keep their value (NaN -> NULL), text is
    parsed leniently. Missing columns follow the contract ``severity``."""
    missing = require_columns(df, cols, severity)
    types = dict(df.dtypes)
    out = {}
    for c in cols:
        if c in missing:
            continue
        if types[c] in ("string",):
            out[c] = coerce_numeric(c)
        else:
            out[c] = nan_to_null(F.col(c).cast("double"))
    return df.withColumns(out)
