"""Left enrichment join with a match report.

Scale notes. AQE turns the sort-merge join into a broadcast join when the
measured right side is small enough, and otherwise splits skewed left
partitions. Rows with a NULL key can never match; they are split off before
the join and added back after it, so they are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.sources.contracts import ContractError

MARKER = "_matched"


def enrich_left(left: DataFrame, right: DataFrame, key: str,
                right_cols: list[str] | None = None,
                marker: str | None = MARKER) -> DataFrame:
    """``left ⟕ right`` on ``key``; duplicate right keys fan out.

    ``marker`` adds a non-NULL right-side column, so a match is visible even
    when every right measure is NULL. Rows with a NULL key stay, unmatched.
    """
    cols = right_cols if right_cols is not None else [c for c in right.columns if c != key]
    clash = sorted(set(cols) & (set(left.columns) - {key}))
    if clash:
        raise ContractError(f"columns on both sides of the join: {clash}; project the right side")
    r = right.select(key, *cols)
    if marker:
        r = r.withColumn(marker, F.lit(True))
    joined = left.filter(F.col(key).isNotNull()).join(r, key, "left").select(key, *[
        c for c in [*left.columns, *r.columns[1:]] if c != key])
    without = left.filter(F.col(key).isNull()).select(
        key, *[c for c in left.columns if c != key],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in r.schema.fields[1:]])
    return joined.unionByName(without)


def match_report(joined: DataFrame, marker: str = MARKER,
                 measure: str | None = None) -> DataFrame:
    """One row ``rows, matched, match_rate`` (plus ``matched_measure``,
    the reference's count of rows whose measure is present)."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.count(F.col(marker)).alias("matched")]
    if measure:
        aggs.append(F.count(F.col(measure)).alias("matched_measure"))
    out = joined.agg(*aggs)
    return out.withColumn("match_rate", F.try_divide(F.col("matched"), F.col("rows")))


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows with no partner (NULL keys included, without a shuffle)."""
    without = left.filter(F.col(key).isNull())
    named = left.filter(F.col(key).isNotNull()).join(right.select(key), key, "left_anti")
    return named.select(*left.columns).unionByName(without)
