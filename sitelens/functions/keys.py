"""Join-key normalisation (K2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.functions._util import col


def normalise_key(c: str | Column, numeric: bool = False) -> Column:
    """Key to text with exactly one trailing ``.0`` removed.

    Text keys: ``100010.0`` -> ``100010``; ``100010.00`` and leading zeros stay.
    Numeric keys (``numeric=True``): integral values go through ``bigint`` so
    that 12345678.0 prints as ``12345678`` rather than ``1.2345678E7``.
    NULL stays NULL (it never joins, as the reference's ``'nan'`` text never did).
    """
    c = col(c)
    if numeric:
        d = c.cast("double")
        return (F.when(d == F.floor(d), d.cast("bigint").cast("string"))
                .otherwise(d.cast("string")))
    return F.regexp_replace(c.cast("string"), r"\.0$", "")
