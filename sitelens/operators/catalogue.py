"""Catalogue facets, filters and table search, re-aimed from the browser
listing as batch jobs (T1, T2, A14, L4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def facet_counts(items: DataFrame, categories: str, all_label: str = "All",
                 category: str = "category", count: str = "items") -> DataFrame:
    """Items per category (case-sensitive) plus an ``All`` row with the
    number of items (those without categories included), ordered
    case-insensitively after ``All``.

    One pass: every item contributes one tagged "all" entry and one entry per
    category; partial aggregation per category keeps a category that holds
    most items cheap.
    """
    tagged = F.concat(
        F.array(F.struct(F.lit(True).alias("t"), F.lit(None).cast("string").alias("c"))),
        F.transform(F.coalesce(F.col(categories), F.array().cast("array<string>")),
                    lambda c: F.struct(F.lit(False).alias("t"), c.alias("c"))))
    counted = (items.select(F.explode(tagged).alias("e"))
               .groupBy(F.col("e.t").alias("t"), F.col("e.c").alias("c"))
               .agg(F.count(F.lit(1)).alias(count)))
    # the "All" row must exist even for an empty catalogue: merge a zero row
    # into the (one row per category) result
    zero = items.sparkSession.range(1).select(
        F.lit(True).alias("t"), F.lit(None).cast("string").alias("c"), F.lit(0).cast("bigint").alias(count))
    counted = counted.unionByName(zero).groupBy("t", "c").agg(F.sum(count).cast("bigint").alias(count))
    out = counted.select(
        F.when(F.col("t"), F.lit(all_label)).otherwise(F.col("c")).alias(category), count, "t")
    return out.orderBy(F.col("t").desc(), F.lower(F.col(category)), F.col(category)).drop("t")


def category_filter(items: DataFrame, categories: str, category: str) -> DataFrame:
    """Exact, case-sensitive membership; ``""`` means no filter; items
    without categories are excluded."""
    if category == "":
        return items
    return items.filter(F.array_contains(F.col(categories), category))


def table_search(df: DataFrame, term: str, columns: list[str] | None = None) -> DataFrame:
    """Rows where any of ``columns`` (as text) contains ``term``,
    case-insensitively."""
    cols = columns or df.columns
    t = term.lower()
    hits = [F.coalesce(F.lower(F.col(c).cast("string")).contains(t), F.lit(False)) for c in cols]
    return df.filter(reduce(lambda a, b: a | b, hits))


def listing_order(items: DataFrame, date: str = "date", title: str = "title") -> DataFrame:
    """L4: newest first, title breaks ties."""
    return items.orderBy(F.col(date).desc_nulls_last(), F.col(title))
