"""Correlation, quantiles and least squares, overall or per group.

All of these are single aggregations with map-side partial aggregation, so a
group holding a third of the rows still splits across many tasks.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.functions._util import col
from sitelens.session import stored


def pearson(x: str | Column, y: str | Column) -> Column:
    """A9 aggregate: Pearson r on pairs where both values are present.

    Fewer than two pairs or a constant input -> NULL (bare ``corr`` raises a
    divide-by-zero under ANSI on a constant column).
    """
    x, y = col(x).cast("double"), col(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    r = F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))
    return F.when(F.count(xx) >= 2, r)


def correlation(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Pearson r and number of pairs, overall or per group."""
    aggs = [pearson(x, y).alias("corr"),
            F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def quantiles(df: DataFrame, c: str, probs=(0.1, 0.5, 0.9), by: list[str] | None = None,
              method: str = "distributed", accuracy: int = 10000) -> DataFrame:
    """A10: one row per probability (linear interpolation; NULLs skipped; a
    column or group without values gives NULLs).

    ``distributed`` is exact: no task ever holds more than a range slice of a
    group's distinct values. ``exact`` (Spark's ``percentile``) keeps every
    distinct value of a group in one aggregation buffer: for modest columns
    only. ``approx`` is ``percentile_approx``.
    """
    probs = [float(p) for p in probs]
    if method == "distributed":
        if by:
            return distributed_group_quantiles(df, c, probs, list(by))
        return distributed_quantiles(df, c, probs)
    arr = F.array(*[F.lit(p) for p in probs])
    if method == "exact":
        agg = F.percentile(F.col(c).cast("double"), arr)
    elif method == "approx":
        agg = F.percentile_approx(F.col(c).cast("double"), arr, accuracy)
    else:
        raise ValueError(method)
    keys = list(by or [])
    wide = (df.groupBy(*keys) if keys else df).agg(agg.alias("__q"))
    rows = F.transform(arr, lambda p, i: F.struct(p.alias("probability"), F.get("__q", i).alias("value")))
    return wide.select(*keys, F.inline(rows))


def distributed_quantiles(df: DataFrame, c: str, probs, slices: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles of one column, computed by rank.

    1. distinct values with their counts (partial aggregation);
    2. range-partitioned into ``slices`` ordered slices, checkpointed so the
       slice ids stay fixed;
    3. one count per slice (``slices`` small rows to the driver) gives each
       slice's first rank;
    4. only the slices holding a wanted rank are scanned with a running sum
       (window per slice) to find the value at that rank.
    """
    spark = df.sparkSession
    m = slices or spark.sparkContext.defaultParallelism
    counts = (df.select(F.col(c).cast("double").alias("v")).filter(F.col("v").isNotNull())
              .groupBy("v").agg(F.count(F.lit(1)).alias("k")))
    ranged = stored(counts.repartitionByRange(m, "v")
                         .withColumn("slice", F.spark_partition_id()))
    sizes = {r["slice"]: r["n"] for r in
             ranged.groupBy("slice").agg(F.sum("k").alias("n")).collect()}
    n = sum(sizes.values())
    schema = "probability double, value double"
    if n == 0:
        return spark.createDataFrame([(p, None) for p in probs], schema)
    starts, acc = {}, 0
    for sl in sorted(sizes):
        starts[sl] = acc
        acc += sizes[sl]
    wanted = set()
    for p in probs:
        pos = p * (n - 1)
        wanted.update({int(math.floor(pos)), int(math.ceil(pos))})

    def slice_of(rank: int) -> int:
        return max(sl for sl in starts if starts[sl] <= rank)

    ranks = [(slice_of(r), r - starts[slice_of(r)], r) for r in sorted(wanted)]
    targets = spark.createDataFrame(ranks, "slice int, local long, rank long")
    w = Window.partitionBy("slice").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    run = (ranged.join(F.broadcast(targets.select("slice").distinct()), "slice", "left_semi")
           .withColumn("cum", F.sum("k").over(w)))
    hits = (run.join(F.broadcast(targets), "slice")
            .filter((F.col("cum") - F.col("k") <= F.col("local")) & (F.col("local") < F.col("cum")))
            .select("rank", "v").collect())
    at = {r["rank"]: r["v"] for r in hits}
    out = []
    for p in probs:
        pos = p * (n - 1)
        lo, hi = int(math.floor(pos)), int(math.ceil(pos))
        out.append((p, at[lo] + (pos - lo) * (at[hi] - at[lo])))
    return spark.createDataFrame(out, schema)


def distributed_group_quantiles(df: DataFrame, c: str, probs, by: list[str],
                                slices: int | None = None) -> DataFrame:
    """Exact per-group quantiles by rank, safe for a group holding most rows.

    (group, value) counts are range-partitioned into slices (stored, so slice
    ids stay fixed); a window over the few (group, slice) rows gives each
    slice's first rank within its group; the wanted ranks (one row per group,
    probability and neighbour) are located in their slices, and only those
    (group, slice) partitions are scanned with a running sum. Groups are
    compared by their own values; NULL group keys are a group like any other,
    and a group without values gives NULLs.
    """
    m = slices or df.sparkSession.sparkContext.defaultParallelism
    g = [f"__g{i}" for i in range(len(by))]
    named = df.select(*[F.col(b).alias(x) for b, x in zip(by, g, strict=True)], F.col(c).cast("double").alias("v"))
    counts = named.groupBy(*g, "v").agg(F.count(F.lit(1)).alias("k"))
    ranged = stored(counts.repartitionByRange(m, *g, "v").withColumn("slice", F.spark_partition_id()), "ranges")

    def match(a: DataFrame, b: DataFrame, more: list[str], how: str = "inner") -> DataFrame:
        """Join on the groups (NULL equals NULL) and on ``more``."""
        b = b.select(*[F.col(x).alias(f"{x}_b") if x in g + more else F.col(x) for x in b.columns])
        on = [a[x].eqNullSafe(b[f"{x}_b"]) for x in g] + [a[x] == b[f"{x}_b"] for x in more]
        return a.join(b, reduce(lambda p, q: p & q, on), how).drop(*[f"{x}_b" for x in g + more])

    per = ranged.groupBy(*g, "slice").agg(F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("k"))), F.lit(0)).alias("n_s"))
    group = Window.partitionBy(*g)
    per = per.withColumns({"start": F.sum("n_s").over(group.orderBy("slice")) - F.col("n_s"), "n": F.sum("n_s").over(group)})
    per = stored(per, "slices")
    arr = F.array(*[F.lit(float(p)) for p in probs])
    targets = (per.select(*g, "n").distinct().select(*g, "n", F.explode(arr).alias("probability"))
               .withColumn("pos", F.col("probability") * (F.col("n") - 1)))
    wanted = targets.select(*g, "probability", "pos", F.explode(F.array(F.floor("pos"), F.ceil("pos"))).alias("rank")).distinct()
    located = match(wanted, per.select(*g, "slice", "start", "n_s"), []).filter(
        (F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("n_s")))
    located = stored(located.select(*g, "slice", "probability", "pos", "rank", (F.col("rank") - F.col("start")).alias("local")), "ranks")
    slice_order = Window.partitionBy(*g, "slice").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    run = match(ranged.filter("v IS NOT NULL"), located.select(*g, "slice").distinct(), ["slice"], "left_semi")
    run = run.withColumn("cum", F.sum("k").over(slice_order))
    at = match(located, run, ["slice"]).filter((F.col("cum") - F.col("k") <= F.col("local")) & (F.col("local") < F.col("cum")))
    low, high = F.min("v"), F.max("v")
    value = at.groupBy(*g, "probability").agg((low + (F.max("pos") - F.floor(F.max("pos"))) * (high - low)).alias("value"))
    out = match(targets.select(*g, "probability"), value, ["probability"], "left")
    return out.select(*[F.col(x).alias(b) for b, x in zip(by, g, strict=True)], "probability", "value")


def ols_terms(x: str, y: str) -> list[Column]:
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    return [F.regr_slope(yy, xx).alias("slope"),
            F.regr_intercept(yy, xx).alias("intercept"),
            F.regr_r2(yy, xx).alias("r2"),
            F.regr_count(yy, xx).alias("n")]


def ols(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Y ~ x least squares: slope, intercept, R², n."""
    return df.groupBy(*by).agg(*ols_terms(x, y)) if by else df.agg(*ols_terms(x, y))


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row result (a global aggregate) to every row.

    The one-row frame becomes a scalar subquery (run once, its value inlined
    into the projection): no join and nothing that grows with the data.
    """
    cols = one_row.columns
    value = one_row.select(F.struct(*cols).alias("__s")).scalar()
    return (df.withColumn("__s", value)
            .select(*df.columns, *[F.col("__s")[c].alias(c) for c in cols]))


def ols_fitted(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows with the fitted value ``intercept + slope * x`` of the overall fit."""
    df = stored(df, "fitted")       # read once, for the fit and for the rows
    coef = df.agg(*ols_terms(x, y)).select("slope", "intercept")
    return (attach(df, coef)
            .withColumn("fitted", F.col("intercept") + F.col("slope") * F.col(x).cast("double")))


def group_relationship(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Per group n, Pearson r and the least-squares line."""
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    return df.groupBy(group).agg(
        F.regr_count(yy, xx).alias("n"),
        pearson(x, y).alias("corr"),
        F.regr_slope(yy, xx).alias("slope"),
        F.regr_intercept(yy, xx).alias("intercept"),
        F.regr_r2(yy, xx).alias("r2"))


def forall(predicate: Column) -> Column:
    """A13 aggregate: true on empty input, false when any value is missing."""
    return F.coalesce(F.bool_and(F.coalesce(predicate, F.lit(False))), F.lit(True))
