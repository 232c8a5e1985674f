"""Keep-first dedup and grain-safe sums.

Measures of a coarse grain (an organisation) are repeated on every fine-grain
row (its sites); adding them up without first keeping one row per key counts
them many times. "First" is defined by an explicit ordinal, never by physical
row order (which a shuffle does not keep).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order: str | list[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def keep_first(df: DataFrame, key: str | list[str], order: str | list[str]) -> DataFrame:
    """First row per key by ``order``; all NULL keys form one group.

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so a hot key sends at most one row per input partition.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


def _ordinal(order: str | list[str]) -> Column:
    cols = _order(order)
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)


def first_at_grain(df: DataFrame, key: str, order: str | list[str],
                   measures: list[str]) -> DataFrame:
    """One row per key with each measure taken from the key's first row.

    ``min_by`` is a declarative aggregate: partial aggregation on the map side
    collapses a hot key before the shuffle (hash aggregate for a single
    numeric ordinal).
    """
    ordinal = _ordinal(order)
    return df.groupBy(key).agg(*[F.min_by(m, ordinal).alias(m) for m in measures])


def sum_at_grain(df: DataFrame, key: str, order: str | list[str],
                 measures: list[str]) -> DataFrame:
    """A5: ``drop_duplicates(key)[measures].sum()`` -> one row; empty -> 0."""
    firsts = first_at_grain(df, key, order, measures)
    return firsts.agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures])
