"""One key holding a third of all rows: results stay whole and exact, and
the hot key is collapsed on the map side before any shuffle."""

from pyspark.sql import functions as F

from sitelens.operators import catalogue, grain, join, report, search


def _hot(spark, n=3000):
    # a third of the rows share key 'hot'; measures repeat per key
    df = spark.range(n).select(
        F.col("id").alias("ord"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("key"))
    return df.withColumn("m", F.when(F.col("key") == "hot", F.lit(100.0)).otherwise(F.lit(1.0)))


def test_sum_at_grain_hot_key(spark):
    df = _hot(spark)
    assert grain.sum_at_grain(df, "key", "ord", ["m"]).first()["m"] == 100.0 + 2000.0
    plan = grain.sum_at_grain(df, "key", "ord", ["m"])._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.index("Exchange hashpartitioning")
    assert "partial_min_by" in plan[first_exchange:]


def test_kpi_and_keep_first_hot_key(spark):
    df = _hot(spark).withColumn("name", F.col("key"))
    k = report.kpi_row(df, "key", "ord", "name", "m").first()
    assert (k["sites"], k["organizations"], k["patients"]) == (3000, 2001, 2100.0)
    assert grain.keep_first(df, "key", "ord").count() == 2001


def test_left_join_hot_key(spark):
    left = _hot(spark)
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3)], "key string, r int")
    j = join.enrich_left(left, right, "key")
    assert j.count() == 2000 + 2000
    assert j.filter(F.col("_matched").isNotNull()).count() == 2001


def test_facets_hot_category(spark):
    items = _hot(spark).select(F.array("key").alias("categories"))
    got = {r["category"]: r["items"] for r in catalogue.facet_counts(items, "categories").collect()}
    assert got["hot"] == 1000 and got["All"] == 3000 and len(got) == 2002


def test_search_term_hitting_every_record(spark):
    recs = spark.range(500).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("href"),
                                   F.lit("common title").alias("title"), F.lit("").alias("section"),
                                   F.lit("text").alias("text"))
    qs = spark.createDataFrame([(1, "common")], "query_id int, query string")
    res = search.keyword_search(qs, recs)
    assert res.count() == 50
    assert res.agg(F.max("rank")).first()[0] == 50
