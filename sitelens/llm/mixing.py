"""Mixing sources to target weights along a curriculum (operator 6), native.

Each source has a target (the words the mix takes of it) and a weight
schedule over training time t in [0, 1]:
    w(t) = target * (1 + slope * (2 t - 1)),    -1 < slope < 1,
whose integral, the cumulative demand D(t) = target * (t + slope * (t^2 - t)),
ends at the target. A source's documents stand in a fixed hashed order, pass
after pass; the copy of a document that begins after c words of its source
gets the training position t with D(t) = c. Sorting all copies by position
(a range sort) gives the training order.

Targets: the weights share the words of all sources; a target stops at
``most`` times its source's words and the excess is reshared by weight until
none is above. In the last pass documents are taken whole up to the target
and the one on it in part, so the words taken meet the target to within one
word for each source.

Running sums over a source never sort it in one task: the documents of a
source are dealt by their order hash into ``BUCKETS`` ranges, the sums of
ranges are added up first (one row for each source and range), and only the
order inside a range is sorted. Sources themselves are one small row each.

Null source: a source of its own, ordered last. Null or empty text: size 0,
never taken. Repeated rows: each counts, as a separate document. No source
has words: all targets 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.staging import staged

WEIGHTS = (5, 2, 1)
SLOPES = (0.5, 0.0, -0.5)       # early, steady and late sources, repeating
MOST = 3
BUCKETS = 4096                  # ranges of the order hash, a power of 16


def size_of(text: Column) -> Column:
    """Number of runs of anything but white space (0x20, 0x09-0x0D)."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.filter(parts, lambda w: w != "")).cast("long")


def cyclic(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (rank % len(values) + 1).cast("int"))


def targets(sized: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, slope, target), one row a source.

    Resharing until none is above is the level L at which the sums of
    min(most * size, L * weight) meet the total: sources in the order of
    most * size / weight are full up to some place, the others get L * weight."""
    per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("rank", F.row_number().over(order) - 1)
    per = per.withColumns({"weight": cyclic(weights, F.col("rank")), "slope": cyclic(slopes, F.col("rank")),
                           "full": (F.col("source_size") * most).cast("double")})
    every = Window.partitionBy()
    by_level = Window.orderBy(F.col("full") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({
        "total": F.sum("source_size").over(every).cast("double"),
        "all_weight": F.sum("weight").over(every),
        "full_before": F.coalesce(F.sum("full").over(by_level), F.lit(0.0)),
        "weight_before": F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))})
    level = (F.col("total") - F.col("full_before")) / (F.col("all_weight") - F.col("weight_before"))
    # the level of the first source in that order that is not full is the
    # highest of those that leave their source at or below its limit
    per = per.withColumn("level", F.when(level * F.col("weight") <= F.col("full"), level))
    per = per.withColumn("target", F.least("full", F.col("weight") * F.max("level").over(every)))
    return per.select("source", "source_size", "weight", "slope", F.coalesce("target", "full").alias("target"))


def schedule(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
             weights: tuple = WEIGHTS, slopes: tuple = SLOPES, most: int = MOST) -> DataFrame:
    """One row a document: (key, source, size, source_size, target, slope,
    before, taken). ``before`` is the words of its source that stand before
    it, ``taken`` the words the mix takes of it in all passes."""
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"))
    rows = rows.withColumn("hash", F.md5(F.coalesce(F.col("key").cast("string"), F.lit("null"))))
    rows = rows.withColumn("range", F.conv(F.substring("hash", 1, len(f"{BUCKETS - 1:x}")), 16, 10).cast("int"))
    rows = staged(rows, "sizes")            # texts are split into words once
    per_range = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    lower = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(F.col("source").alias("s"), F.col("range").alias("r"),
                               F.coalesce(F.sum("words").over(lower), F.lit(0)).alias("offset"))
    goal = targets(rows, weights, slopes, most)
    offsets = offsets.join(goal, F.col("s").eqNullSafe(goal["source"])).drop("source", "weight")
    joined = rows.join(offsets, rows["source"].eqNullSafe(offsets["s"]) & (rows["range"] == offsets["r"]))
    within = Window.partitionBy("source", "range").orderBy("hash", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = joined.withColumn("before", F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    rest = F.round(F.col("target") - whole * F.col("source_size")).cast("long")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return out.select("key", "source", "size", "source_size", "target", "slope", "before",
                      (whole * F.col("size") + last).cast("long").alias("taken"))


def position(before: Column, target: Column, slope: Column) -> Column:
    """Training time t in [0, 1] at which the cumulative demand of a source
    reaches ``before`` words: the root of slope t^2 + (1 - slope) t = c."""
    c = before / target
    b = F.lit(1.0) - slope
    root = (F.sqrt(b * b + F.lit(4.0) * slope * c) - b) / (F.lit(2.0) * slope)
    return F.when(slope == 0, c).otherwise(root) + F.lit(0.0)      # no -0.0


def training_order(plan: DataFrame) -> DataFrame:
    """The copies of a ``schedule``'s documents in training order: one row for
    each document and pass that takes of it, (key, source, size, source_size,
    target, before, pass, words, position), range-sorted by position."""
    taking = plan.filter("taken > 0")
    each = taking.withColumn("pass", F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1)))
    words = F.least(F.col("size"), F.col("taken") - F.col("pass") * F.col("size"))
    begun = F.least(F.col("before") + F.col("pass") * F.col("source_size"), F.col("target"))
    each = each.select("key", "source", "size", "source_size", "target", "before", "pass", words.alias("words"),
                       position(begun, F.col("target"), F.col("slope")).alias("position"))
    return each.orderBy("position", "key", "pass")


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """The training order of ``docs``: (key, source, size, pass, words, position)."""
    order = training_order(schedule(docs, key, text, source, **settings))
    return order.select(F.col("key").alias(key), F.col("source").alias(source), "size", "pass", "words", "position")


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """One row a document: (key, size, source_size, target, taken, position),
    the words and the first position it has in the training order, which is
    written in its ranges and read back; 0 and null where it has none. Copies
    with words are one document's where source and ``before`` are the same."""
    plan = staged(schedule(docs, key, text, source, **settings), "plan")
    order = staged(training_order(plan), "order")
    mixed = order.groupBy("source", "before", "key", "size", "source_size", "target").agg(
        F.sum("words").cast("long").alias("taken"), F.min("position").alias("position"))
    unused = plan.filter("taken = 0").withColumn("position", F.lit(None).cast("double"))
    columns = [F.col("key").alias(key), "size", "source_size", "target", "taken", "position"]
    return mixed.select(*columns).unionByName(unused.select(*columns))
