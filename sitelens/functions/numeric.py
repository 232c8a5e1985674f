"""Lenient numeric conversion and guarded arithmetic (K1, K3, K4, K5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.functions._util import col

# Fixed value: the text forms accepted as numbers. Anything else becomes NULL,
# which keeps Spark in line with pandas/DuckDB where Spark's own cast is more
# lenient ('5d', '5f' parse in Spark) or differs ('NaN', '1_000').
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL for a numeric column; the house rule at source boundaries."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def coerce_numeric(c: str | Column) -> Column:
    """Text (or number) to double; anything that is not a plain number -> NULL."""
    text = col(c).cast("string")
    return F.when(text.rlike(NUMERIC_TEXT), F.trim(text).try_cast("double"))


def parts_sum(*parts: str | Column) -> Column:
    """Sum of parts; NULL when any part is NULL (pandas ``a + b``)."""
    out = col(parts[0])
    for p in parts[1:]:
        out = out + col(p)
    return out


def residual(total: str | Column, *parts: str | Column) -> Column:
    """total - (p1 + p2 + ...); may be negative, left unchecked like the source."""
    return col(total) - parts_sum(*parts)


def ratio_or_zero(num: str | Column, den: str | Column, zero_den: str = "inf") -> Column:
    """``(num / den).fillna(0)`` without ANSI divide-by-zero errors.

    Missing operand -> 0, 0/0 -> 0. For n/0 with n != 0, ``zero_den`` chooses:
    ``"inf"`` (signed infinity, what pandas produces), ``"zero"`` or ``"null"``.
    """
    n, d = col(num), col(den)
    if zero_den == "inf":
        on_zero = (F.when(n > 0, F.lit(float("inf")))
                   .when(n < 0, F.lit(float("-inf")))
                   .otherwise(F.lit(0.0)))
    elif zero_den == "zero":
        on_zero = F.lit(0.0)
    elif zero_den == "null":
        on_zero = F.when(n == 0, F.lit(0.0))
    else:
        raise ValueError(f"zero_den must be inf, zero or null, not {zero_den!r}")
    return (F.when(n.isNull() | d.isNull(), F.lit(0.0))
            .when(d == 0, on_zero)
            .otherwise(n.cast("double") / d.cast("double")))
