"""Display formatting.

``format_number`` rounds half-even like Python's format mini-language; the
``%.1f`` of ``format_string`` rounds half-up and is deliberately not used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.functions._util import col


def fmt_count(c: str | Column) -> Column:
    """``f"{x:,.0f}"`` -> '1,234,568'."""
    return F.format_number(col(c), 0)


def _pattern(decimals: int) -> str:
    return "0" if decimals == 0 else "0." + "0" * decimals


def fmt_fixed(c: str | Column, decimals: int = 2) -> Column:
    """``f"{x:.2f}"`` (no grouping)."""
    return F.call_function("format_number", col(c), F.lit(_pattern(decimals)))


def fmt_pct(c: str | Column, decimals: int = 1) -> Column:
    """``f"{x:.1%}"`` -> '6.2%'; NULL stays NULL."""
    return F.concat(
        F.call_function("format_number", col(c) * 100, F.lit(_pattern(decimals))),
        F.lit("%"))


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_ms_to_date(c: str | Column, pattern: str = "MMM d, yyyy") -> Column:
    """Epoch milliseconds to a UTC display date, whatever the session time
    zone (the arithmetic stays in zone-less timestamps)."""
    return F.date_format(F.timestamp_add("MILLISECOND", col(c), _epoch()), pattern)


def epoch_ms(c: str | Column) -> Column:
    """Milliseconds since the epoch of a zone-less timestamp or a date, read
    as UTC (no session time-zone shift)."""
    return F.timestamp_diff("MILLISECOND", _epoch(), col(c).cast("timestamp_ntz"))
