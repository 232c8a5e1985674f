"""Registered queries: one per operator family of the survey inventory.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL or
None)``. Every query reads whole driver tables (or frames Spark derives from
them); limits appear only where they are the feature (top-k, paging,
sampling, the 50-result search limit).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions import (
    add_param, coerce_numeric, decode_categories, epoch_ms, epoch_ms_to_date, make_params,
    normalise_key, parse_params, query_string, ratio_or_zero, reading_time, word_count,
)
from sitelens.operators import catalogue, clean, grain, join, quality, report, search, skipping, stats
from sitelens.plans import jobs, sql, standins as S
from sitelens.session import work_folder
from sitelens.sources.catalogue import read_catalogue
from sitelens.sources.readers import preview, profile, read_listings, read_quarantined, read_table, write_table

REGISTRY: dict[str, tuple] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --- flagship: payer mix, not double counted --------------------------------

@register("payer_mix", sql.with_joined("""
, tot AS (SELECT coalesce(sum(coalesce(total_patients, 0)), 0) AS t,
                 coalesce(sum(coalesce(medicaid, 0)), 0) AS m,
                 coalesce(sum(coalesce(uninsured, 0)), 0) AS u FROM firsts),
mix AS (SELECT 'Medicaid' AS Category, m AS Patients FROM tot
        UNION ALL SELECT 'Uninsured', u FROM tot
        UNION ALL SELECT 'Other (Private/Medicare)', t - (m + u) FROM tot)
SELECT Category, round(Patients, 6) AS Patients,
       round(Patients / nullif(sum(Patients) OVER (), 0), 6) AS share FROM mix"""))
def payer_mix(spark: SparkSession, d: str) -> DataFrame:
    rf = jobs.report_frame(S.joined(spark, d))
    pm = report.payer_mix(rf, "bhcmis_id", "site_id", "total_patients",
                          {"Medicaid": "medicaid", "Uninsured": "uninsured"})
    return pm.select("Category", r6("Patients").alias("Patients"), r6("share").alias("share"))


# --- sources, cleaning, conversions ----------------------------------------

@register("clean_sites", "WITH " + sql.SITES + """
SELECT site_id, bhcmis_raw AS bhcmis_id, organization, site_name, city, county, type,
       round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
FROM sites WHERE state = 'O'""")
def clean_sites(spark, d):
    df = jobs.clean_sites(S.sites_raw(spark, d), region="O", ordinal="site_id")
    return df.withColumns({"latitude": r6("latitude"), "longitude": r6("longitude")})


_PART_TEXTS = {
    "brand": ("regexp_replace(p_brand, '^Brand#', '')",
              lambda: F.regexp_replace("p_brand", "^Brand#", "")),
    "name": ("p_name", lambda: F.col("p_name")),
    "size": ("' ' || CAST(p_size AS VARCHAR) || '.'",
             lambda: F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit("."))),
    "suffixed": ("CAST(p_size AS VARCHAR) || 'd'",
                 lambda: F.concat(F.col("p_size").cast("string"), F.lit("d"))),
    "price": ("CAST(p_retailprice AS VARCHAR)", lambda: F.col("p_retailprice").cast("string")),
    "exponent": ("CAST(p_size AS VARCHAR) || 'e2'",
                 lambda: F.concat(F.col("p_size").cast("string"), F.lit("e2"))),
}


@register("coerce_numeric", "SELECT p_partkey, " + ", ".join(
    f"round({sql.coerce(expr)}, 6) AS {name}_num" for name, (expr, _) in _PART_TEXTS.items())
    + " FROM part")
def coerce_numeric_q(spark, d):
    p = S.table(spark, d, "part")
    return p.select("p_partkey", *[r6(coerce_numeric(mk())).alias(f"{name}_num")
                                   for name, (_, mk) in _PART_TEXTS.items()])


@register("normalise_key", r"""
SELECT o_orderkey,
  regexp_replace(CAST(o_custkey AS VARCHAR) || '.0', '\.0$', '') AS k_text,
  regexp_replace(CAST(o_custkey AS VARCHAR) || '.00', '\.0$', '') AS k_two,
  regexp_replace(CAST(o_custkey AS VARCHAR) || '.0.0', '\.0$', '') AS k_dots,
  regexp_replace('0' || CAST(o_custkey AS VARCHAR), '\.0$', '') AS k_zero,
  CAST(o_custkey AS VARCHAR) AS k_num
FROM orders""")
def normalise_key_q(spark, d):
    o = S.table(spark, d, "orders")
    ck = F.col("o_custkey").cast("string")
    return o.select(
        "o_orderkey",
        normalise_key(F.concat(ck, F.lit(".0"))).alias("k_text"),
        normalise_key(F.concat(ck, F.lit(".00"))).alias("k_two"),
        normalise_key(F.concat(ck, F.lit(".0.0"))).alias("k_dots"),
        normalise_key(F.concat(F.lit("0"), ck)).alias("k_zero"),
        normalise_key(F.col("o_custkey").cast("double"), numeric=True).alias("k_num"))


_MEASURES = ["total_patients", "uninsured", "medicaid", "pct_uninsured", "pct_medicaid"]


@register("org_metrics", "WITH " + sql.ORGS + """
SELECT bhcmis_id, segment, """ + ", ".join(f"round({m}, 6) AS {m}" for m in _MEASURES) + " FROM orgs")
def org_metrics(spark, d):
    o = S.orgs(spark, d)
    return o.select("bhcmis_id", "segment", *[r6(m).alias(m) for m in _MEASURES])


@register("ratio_edges", """
WITH o AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity ELSE 0 END) - 20 AS returned,
                  sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS open_quantity,
                  sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS known FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, round(""" + sql.ratio("returned", "open_quantity") + """, 6) AS by_open,
       round(""" + sql.ratio("returned", "known") + """, 6) AS by_known, round(""" + sql.ratio("known", "open_quantity") + """, 6) AS known_by_open FROM o""")
def ratio_edges(spark, d):
    """K4 where numerators are negative, zero, positive or missing and
    denominators zero or missing."""
    q, li = F.col("l_quantity"), S.table(spark, d, "lineitem")
    per = li.groupBy("l_orderkey").agg(
        (F.sum(F.when(F.col("l_returnflag") != "N", q).otherwise(0.0)) - 20).alias("returned"),
        F.sum(F.when(F.col("l_linestatus") == "O", q).otherwise(0.0)).alias("open_quantity"),
        F.sum(F.when(F.col("l_returnflag") == "R", q)).alias("known"))
    return per.select("l_orderkey", r6(ratio_or_zero("returned", "open_quantity")).alias("by_open"),
                      r6(ratio_or_zero("returned", "known")).alias("by_known"), r6(ratio_or_zero("known", "open_quantity")).alias("known_by_open"))


@register("source_profile", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", (SELECT count(*) FROM {t}) AS \"rows\", "
    f"(SELECT string_agg(column_name, ',' ORDER BY ordinal_position) FROM "
    f"(SELECT column_name, ordinal_position FROM information_schema.columns "
    f"WHERE table_name = '{t}' ORDER BY ordinal_position LIMIT 5)) AS first_columns"
    for t in S.TABLES))
def source_profile(spark, d):
    return reduce(DataFrame.unionByName, [profile(S.table(spark, d, t), t) for t in S.TABLES])


# --- joins --------------------------------------------------------------------

@register("enrich_left", sql.with_joined("""
SELECT site_id, bhcmis_id, organization, """ + ", ".join(f"round({m}, 6) AS {m}" for m in _MEASURES)
    + ", matched FROM joined"))
def enrich_left(spark, d):
    j = S.joined(spark, d)
    return j.select("site_id", "bhcmis_id", "organization", *[r6(m).alias(m) for m in _MEASURES],
                    F.coalesce(F.col(join.MARKER), F.lit(False)).alias("matched"))


@register("match_report", sql.with_joined("""
SELECT count(*) AS "rows", count(*) FILTER (WHERE matched) AS matched,
       count(total_patients) AS matched_measure,
       round(CAST(count(*) FILTER (WHERE matched) AS DOUBLE) / count(*), 6) AS match_rate
FROM joined"""))
def match_report(spark, d):
    rep = join.match_report(S.joined(spark, d), measure="total_patients")
    return rep.withColumn("match_rate", r6("match_rate"))


@register("unmatched", "WITH " + sql.SITES + "," + sql.ORGS + r"""
SELECT s.site_id, regexp_replace(s.bhcmis_raw, '\.0$', '') AS bhcmis_id FROM sites s
WHERE NOT EXISTS (SELECT 1 FROM orgs g WHERE g.segment <> 'HOUSEHOLD' AND g.bhcmis_id = regexp_replace(s.bhcmis_raw, '\.0$', ''))""")
def unmatched(spark, d):
    sites = S.sites(spark, d).withColumn("bhcmis_id", normalise_key("bhcmis_id"))
    return join.unmatched(sites, S.orgs(spark, d).filter(S.LISTED), "bhcmis_id").select("site_id", "bhcmis_id")


@register("labels_match", """
SELECT count(*) AS "rows", count(l.doc_id) AS matched, count(l.quality) AS matched_measure,
       round(CAST(count(l.doc_id) AS DOUBLE) / count(*), 6) AS match_rate
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def labels_match(spark, d):
    docs = S.table(spark, d, "documents").select("doc_id")
    j = join.enrich_left(docs, S.table(spark, d, "labels"), "doc_id")
    return join.match_report(j, measure="quality").withColumn("match_rate", r6("match_rate"))


# --- grain, aggregates, statistics -----------------------------------------

@register("kpi_row", sql.with_joined("""
SELECT (SELECT count(*) FROM joined) AS sites,
       (SELECT count(DISTINCT organization) FROM joined) AS organizations,
       (SELECT round(coalesce(sum(coalesce(total_patients, 0)), 0), 6) FROM firsts) AS patients"""))
def kpi_row(spark, d):
    rf = jobs.report_frame(S.joined(spark, d))
    k = report.kpi_row(rf, "bhcmis_id", "site_id", "organization", "total_patients")
    return k.withColumn("patients", r6("patients"))


@register("keep_first", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""")
def keep_first(spark, d):
    o = S.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return grain.keep_first(o, "o_custkey", "o_orderkey")


@register("share_of_total", """
SELECT l_returnflag, sum(l_quantity) AS quantity,
       round(sum(l_quantity) / sum(sum(l_quantity)) OVER (), 6) AS share
FROM lineitem GROUP BY l_returnflag""")
def share_of_total(spark, d):
    li = S.table(spark, d, "lineitem")
    per = li.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("quantity"))
    return report.share_of_total(per, "quantity").withColumn("share", r6("share"))


@register("corr_size_mix", sql.with_joined("""
SELECT round(corr(total_patients, pct_medicaid), 6) AS corr, count(*) AS n,
       format('{:.2f}', corr(total_patients, pct_medicaid)) AS corr_text
FROM joined WHERE total_patients > 100 AND pct_medicaid IS NOT NULL"""))
def corr_size_mix(spark, d):
    c = jobs.size_mix_corr(S.joined(spark, d))
    return c.withColumn("corr", r6("corr"))


@register("quantiles", sql.with_joined("""
SELECT unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS probability,
       round(unnest(quantile_cont(pct_medicaid, [0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE])), 6) AS value
FROM joined WHERE total_patients > 100"""))
def quantiles(spark, d):
    q = jobs.mix_deciles(S.joined(spark, d))
    return q.withColumn("value", r6("value"))


@register("quantiles_distributed", sql.with_joined("""
SELECT unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS probability,
       round(unnest(quantile_cont(pct_medicaid, [0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE])), 6) AS value
FROM joined WHERE total_patients > 100"""))
def quantiles_distributed(spark, d):
    big = clean.above(S.joined(spark, d), "total_patients", 100)
    q = stats.quantiles(big, "pct_medicaid", (0.1, 0.5, 0.9), method="distributed")
    return q.withColumn("value", r6("value"))


@register("quantiles_by_group", "WITH " + sql.ORGS + """
SELECT segment, unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS probability,
       round(unnest(quantile_cont(pct_medicaid, [0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE])), 6) AS value
FROM orgs GROUP BY segment""")
def quantiles_by_group(spark, d):
    q = stats.quantiles(S.orgs(spark, d), "pct_medicaid", (0.1, 0.5, 0.9), by=["segment"],
                        method="distributed")
    return q.withColumn("value", r6("value"))


@register("corr_by_group", "WITH " + sql.ORGS_ALL + """
SELECT segment, CAST(regr_count(pct_medicaid, total_patients) AS BIGINT) AS n,
       round(corr(total_patients, pct_medicaid), 6) AS corr,
       round(regr_slope(pct_medicaid, total_patients), 6) AS slope,
       round(regr_intercept(pct_medicaid, total_patients), 6) AS intercept,
       round(regr_r2(pct_medicaid, total_patients), 6) AS r2
FROM orgs GROUP BY segment""")
def corr_by_group(spark, d):
    g = jobs.group_relationship(S.orgs_all(spark, d), "segment", "total_patients", "pct_medicaid")
    return g.select("segment", "n", *[r6(c).alias(c) for c in ("corr", "slope", "intercept", "r2")])


_ORG_FIT = sql.with_joined("""
, big AS (SELECT bhcmis_id, coalesce(total_patients, 0) AS total_patients,
                 coalesce(pct_medicaid, 0) AS pct_medicaid FROM firsts
          WHERE coalesce(total_patients, 0) > 100),
coef AS (SELECT regr_slope(pct_medicaid, total_patients) AS slope,
                regr_intercept(pct_medicaid, total_patients) AS intercept,
                regr_r2(pct_medicaid, total_patients) AS r2,
                CAST(regr_count(pct_medicaid, total_patients) AS BIGINT) AS n FROM big)
""")


@register("ols_fit", _ORG_FIT + """
SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(r2, 6) AS r2, n FROM coef""")
def ols_fit(spark, d):
    orgs = jobs.org_grain(jobs.report_frame(S.joined(spark, d)), "site_id")
    fit = stats.ols(orgs, "total_patients", "pct_medicaid")
    return fit.select(r6("slope").alias("slope"), r6("intercept").alias("intercept"),
                      r6("r2").alias("r2"), "n")


@register("ols_fitted", _ORG_FIT + """
SELECT b.bhcmis_id, b.total_patients, round(b.pct_medicaid, 6) AS pct_medicaid,
       round(c.intercept + c.slope * b.total_patients, 6) AS fitted
FROM big b, coef c""")
def ols_fitted(spark, d):
    orgs = jobs.org_grain(jobs.report_frame(S.joined(spark, d)), "site_id")
    f = stats.ols_fitted(orgs, "total_patients", "pct_medicaid")
    return f.select("bhcmis_id", "total_patients", r6("pct_medicaid").alias("pct_medicaid"),
                    r6("fitted").alias("fitted"))


@register("landscape_summary", _ORG_FIT + """
, t AS (SELECT coalesce(sum(coalesce(total_patients, 0)), 0) AS patients, coalesce(sum(coalesce(medicaid, 0)), 0) AS medicaid,
               coalesce(sum(coalesce(uninsured, 0)), 0) AS uninsured FROM firsts)
SELECT (SELECT count(*) FROM joined) AS sites, (SELECT count(DISTINCT organization) FROM joined) AS organizations,
       round(patients, 6) AS patients, round(medicaid, 6) AS medicaid, round(uninsured, 6) AS uninsured,
       round(patients - (medicaid + uninsured), 6) AS other, round(slope, 6) AS slope, round(intercept, 6) AS intercept,
       round(r2, 6) AS r2, n AS n_fitted FROM t, coef""")
def landscape_summary(spark, d):
    """M5: KPI row, payer mix and fitted line from one grouped pass."""
    one = jobs.report_summary(jobs.org_groups(jobs.report_frame(S.joined(spark, d)), "site_id"))
    exact = ("sites", "organizations", "n_fitted")
    return one.select(*[F.col(c) if c in exact else r6(c).alias(c) for c in one.columns])


@register("observation_report", """
WITH c AS (SELECT c_mktsegment, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer)
SELECT c_mktsegment, CAST(regr_count(c_acctbal, c_nationkey) AS BIGINT) AS n, round(corr(c_nationkey, c_acctbal), 6) AS corr,
       round(regr_slope(c_acctbal, c_nationkey), 6) AS slope, round(regr_intercept(c_acctbal, c_nationkey), 6) AS intercept,
       round(regr_r2(c_acctbal, c_nationkey), 6) AS r2, min(first_key) AS first_key
FROM c, (SELECT min(c_custkey) AS first_key FROM customer) GROUP BY c_mktsegment""")
def observation_report(spark, d):
    """M6: a table as a delimited file with missing-value marks, read with its
    schema; the relationship of two measures per group, and the preview."""
    path = f"{work_folder(spark)}/observations-{uuid.uuid4().hex}"
    c = S.table(spark, d, "customer")
    c = c.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    write_table(c, path, fmt="csv", nullValue="NA")
    made = jobs.observation_report(spark, path, S.SCHEMAS["customer"], "c_mktsegment", "c_nationkey", "c_acctbal", ["c_custkey"])
    first = made["preview"].agg(F.min("c_custkey").alias("first_key"))
    rel = stats.attach(made["relationship"], first)
    return rel.select("c_mktsegment", "n", *[r6(x).alias(x) for x in ("corr", "slope", "intercept", "r2")], "first_key")


# --- sorted, paged and sampled views ----------------------------------------

@register("top_need", sql.with_joined("""
SELECT bhcmis_id, organization, uninsured, total_patients FROM firsts
ORDER BY uninsured DESC NULLS LAST, bhcmis_id LIMIT 20"""))
def top_need(spark, d):
    orgs = jobs.org_grain(S.joined(spark, d), "site_id", threshold=None)
    return report.top_k(orgs, "uninsured", 20, ["bhcmis_id"]).select(
        "bhcmis_id", "organization", "uninsured", "total_patients")


@register("page_2", sql.with_joined("""
SELECT site_id, organization, site_name FROM joined
ORDER BY organization, site_id LIMIT 25 OFFSET 25"""))
def page_2(spark, d):
    j = S.joined(spark, d).select("site_id", "organization", "site_name")
    return report.page(j, ["organization", "site_id"], 2, 25)


@register("page_keyset", sql.with_joined("""
SELECT site_id, organization, site_name FROM joined
WHERE organization > 'Org 5' OR (organization = 'Org 5' AND site_id > 0)
ORDER BY organization, site_id LIMIT 25"""))
def page_keyset(spark, d):
    j = S.joined(spark, d).select("site_id", "organization", "site_name")
    return report.page_after(j, ["organization", "site_id"], ("Org 5", 0), 25)


@register("page_deep", """
WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice NULLS FIRST, o_orderkey) - 1 AS place FROM orders)
SELECT o_orderkey, o_totalprice FROM r WHERE place >= (SELECT count(*) // 2 FROM orders) AND place < (SELECT count(*) // 2 FROM orders) + 25""")
def page_deep(spark, d):
    """L3: the page in the middle of all orders by price, from the range that
    holds it."""
    index = report.RankIndex(S.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])
    return index.page(sum(n for _, _, n in index.starts()) // 2, 25)


@register("sample_n", sql.with_joined("""
SELECT site_name, city, county, type FROM joined
ORDER BY md5(CAST(site_id AS VARCHAR) || '|42'), site_id LIMIT 5"""))
def sample_n(spark, d):
    return report.sample_n(S.joined(spark, d), 5, "site_id").select("site_name", "city", "county", "type")


@register("display_table", sql.with_joined("""
SELECT organization AS "Organization", site_name AS "Site", city AS "City",
       coalesce(total_patients, 0) AS "Org Total Patients",
       """ + sql.fmt_pct("coalesce(pct_medicaid, 0)") + """ AS "% Medicaid",
       """ + sql.fmt_pct("pct_uninsured") + """ AS "% Uninsured"
FROM joined"""))
def display_table(spark, d):
    return jobs.display_table(jobs.report_frame(S.joined(spark, d)))


@register("map_layer", sql.with_joined("""
SELECT round(latitude, 6) AS lat, round(longitude, 6) AS lon, coalesce(total_patients, 0) AS size,
       round(coalesce(pct_medicaid, 0), 6) AS color, site_name AS hover_title, organization, city,
       format('{:,.0f}', coalesce(total_patients, 0)) AS "Patients (fmt)",
       """ + sql.fmt_pct("coalesce(pct_medicaid, 0)") + """ AS "Medicaid %"
FROM joined"""))
def map_layer(spark, d):
    layer = jobs.landscape_report(S.joined(spark, d), "site_id")["map"]
    return layer.withColumns({"lat": r6("lat"), "lon": r6("lon"), "color": r6("color")})


# --- quality gate ---------------------------------------------------------------

@register("range_violations", "WITH " + sql.SITES_ALL + """
SELECT site_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM sites_all
WHERE NOT coalesce(latitude BETWEEN 41 AND 47 AND longitude BETWEEN -125 AND -116, false)""")
def range_violations(spark, d):
    """Outside of the box, or without coordinates."""
    bad = S.sites(spark, d, placed=False).filter(clean.violates(clean.in_range("latitude", 41, 47)
                                                                & clean.in_range("longitude", -125, -116)))
    return bad.select("site_id", r6("latitude").alias("latitude"), r6("longitude").alias("longitude"))


@register("gate_missing_values", "WITH " + sql.SITES_ALL + """,
g AS (SELECT count(*) AS n, count(*) FILTER (WHERE NOT coalesce(latitude BETWEEN 41 AND 47 AND longitude BETWEEN -125 AND -116, false)) AS v1
      FROM sites_all),
""" + sql.ORGS + """,
c AS (SELECT count(*) FILTER (WHERE NOT coalesce(NOT (coalesce(uninsured, 0) > coalesce(total_patients, 0)), false)) AS v2,
             count(*) FILTER (WHERE coalesce(total_patients, 0) < 0) AS v3
      FROM sites_all s LEFT JOIN orgs o ON o.segment <> 'HOUSEHOLD' AND o.bhcmis_id = regexp_replace(s.bhcmis_raw, '\\.0$', ''))
SELECT 'not_empty' AS rule, n AS observed, n > 0 AS passed FROM g
UNION ALL SELECT 'min_rows', n, n > 10 FROM g
UNION ALL SELECT 'required_columns', 0, true FROM g
UNION ALL SELECT 'coordinates_in_bounds', v1, v1 = 0 FROM g
UNION ALL SELECT 'uninsured_le_total', v2, v2 = 0 FROM c
UNION ALL SELECT 'non_negative_total', v3, v3 = 0 FROM c
UNION ALL SELECT 'gate', CAST((n <= 0)::INT + (n <= 10)::INT + (v1 > 0)::INT + (v2 > 0)::INT + (v3 > 0)::INT AS BIGINT),
                 n > 10 AND v1 = 0 AND v2 = 0 AND v3 = 0 FROM g, c""")
def gate_missing_values(spark, d):
    """The gate counts sites without coordinates as violations. Its
    counts ride on the write of the joined table (Q7)."""
    rules = quality.site_gate(fill=True)
    df, counts = quality.observe_gate(S.joined_unplaced(spark, d), rules)
    write_table(df, f"{work_folder(spark)}/gated-{uuid.uuid4().hex}")
    return quality.observed_gate(df, rules, counts)


@register("quality_gate", sql.with_joined("""
, g AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE NOT coalesce(latitude BETWEEN 41 AND 47 AND longitude BETWEEN -125 AND -116, false)) AS v1,
  count(*) FILTER (WHERE NOT coalesce(NOT (coalesce(uninsured, 0) > coalesce(total_patients, 0)), false)) AS v2,
  count(*) FILTER (WHERE NOT coalesce(coalesce(total_patients, 0) >= 0, false)) AS v3
  FROM joined)
SELECT 'not_empty' AS rule, n AS observed, n > 0 AS passed FROM g
UNION ALL SELECT 'min_rows', n, n > 10 FROM g
UNION ALL SELECT 'required_columns', 0, true FROM g
UNION ALL SELECT 'coordinates_in_bounds', v1, v1 = 0 FROM g
UNION ALL SELECT 'uninsured_le_total', v2, v2 = 0 FROM g
UNION ALL SELECT 'non_negative_total', v3, v3 = 0 FROM g
UNION ALL SELECT 'gate', CAST((n <= 0)::INT + (n <= 10)::INT + (v1 > 0)::INT + (v2 > 0)::INT
                              + (v3 > 0)::INT AS BIGINT),
                 n > 10 AND v1 = 0 AND v2 = 0 AND v3 = 0 FROM g"""))
def quality_gate_q(spark, d):
    return jobs.quality_gate(S.joined(spark, d))


# --- catalogue ------------------------------------------------------------------

def _items(spark, d):
    items = S.catalogue_items(spark, d)
    return items.withColumn("categories", decode_categories("categories_b64"))


@register("facet_counts", """
SELECT 'All' AS category, count(*) AS items FROM documents
UNION ALL
SELECT c AS category, count(*) AS items FROM (SELECT unnest([lang, source]) AS c FROM documents)
GROUP BY c""")
def facet_counts(spark, d):
    return catalogue.facet_counts(_items(spark, d), "categories")


@register("category_filter", """
SELECT doc_id, lang, source FROM documents WHERE list_contains([lang, source], 'src3')""")
def category_filter(spark, d):
    return catalogue.category_filter(_items(spark, d), "categories", "src3").select(
        "doc_id", "lang", "source")


_WC = f"CAST(len(list_filter(string_split_regex(text, '{sql.WS}'), lambda w: w <> '')) AS INTEGER)"


@register("listing", f"""
SELECT doc_id, lang || ', ' || source AS categories, {_WC} AS word_count,
       CAST(ceil({_WC} / 200.0) AS INTEGER) AS reading_time
FROM documents""")
def listing(spark, d):
    items = _items(spark, d).withColumn("word_count", word_count("text"))
    return items.select("doc_id", F.array_join("categories", ", ").alias("categories"),
                        "word_count", reading_time("word_count").alias("reading_time"))


@register("word_count", f"""
SELECT doc_id, {_WC} AS word_count, CAST(ceil({_WC} / 200.0) AS INTEGER) AS reading_time
FROM documents""")
def word_count_q(spark, d):
    docs = S.table(spark, d, "documents").withColumn("word_count", word_count("text"))
    return docs.select("doc_id", "word_count", reading_time("word_count").alias("reading_time"))


@register("date_display", """
SELECT o_orderkey, epoch_ms(o_orderdate) AS date_ms, strftime(o_orderdate, '%b %-d, %Y') AS date_display
FROM orders""")
def date_display(spark, d):
    o = S.table(spark, d, "orders")
    ms = epoch_ms("o_orderdate")
    return o.select("o_orderkey", ms.alias("date_ms"), epoch_ms_to_date(ms).alias("date_display"))


@register("table_search", """
SELECT doc_id, lang, source FROM documents
WHERE contains(lower(CAST(doc_id AS VARCHAR)), 'licen') OR contains(lower(text), 'licen')
   OR contains(lower(lang), 'licen') OR contains(lower(source), 'licen')""")
def table_search(spark, d):
    docs = S.table(spark, d, "documents")
    return catalogue.table_search(docs, "licen", ["doc_id", "text", "lang", "source"]).select(
        "doc_id", "lang", "source")


# --- URL strings ------------------------------------------------------------------

@register("catalogue_page", """
SELECT event_id AS id, event_type AS title, CAST(ts AS DATE) AS date FROM events
WHERE event_type = (SELECT max(event_type) FROM events)
ORDER BY CAST(ts AS DATE) DESC NULLS LAST, event_type, event_id LIMIT 20 OFFSET 20""")
def catalogue_page(spark, d):
    """L4 and M8: the items of one category, newest first, the second page."""
    ev = S.table(spark, d, "events")
    items = ev.select(F.col("event_id").alias("id"), F.col("event_type").alias("title"), F.col("ts").cast("date").alias("date"),
                      F.array("event_type").alias("categories"), F.lit("").alias("description"))
    category = ev.agg(F.max("event_type")).first()[0] or ""
    return jobs.catalogue_views(items, category, 2, 20, key="id")["page"].select("id", "title", "date")


@register("csv_round_trip", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, round(avg(s_acctbal) OVER (PARTITION BY s_nationkey), 6) AS nation_mean
FROM supplier""")
def csv_round_trip(spark, d):
    """A table written as CSV and read with its explicit schema."""
    path = f"{work_folder(spark)}/csv-{uuid.uuid4().hex}"
    write_table(S.table(spark, d, "supplier"), path, fmt="csv", nullValue="NA")
    back = read_table(spark, path, fmt="csv", schema=S.SCHEMAS["supplier"], nullValue="NA")
    means = back.groupBy(F.col("s_nationkey").alias("n")).agg(r6(F.avg("s_acctbal")).alias("nation_mean"))
    return back.join(means, F.col("s_nationkey").eqNullSafe(F.col("n"))).drop("n")


@register("json_listing", """
SELECT lang AS listing, '/' || source || '/' || CAST(doc_id AS VARCHAR) AS item FROM documents WHERE lang IS NOT NULL""")
def json_listing(spark, d):
    """Listings written as JSON, read back and flattened."""
    path = f"{work_folder(spark)}/json-{uuid.uuid4().hex}"
    link = F.concat(F.lit("/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    docs = S.table(spark, d, "documents").filter("lang IS NOT NULL")
    docs.select(F.col("lang").alias("listing"), F.array(link).alias("items")).write.json(path)
    return read_listings(spark, path, lines=True)


@register("quarantine", """
SELECT 'json' AS source, count(*) FILTER (WHERE s_suppkey % 7 <> 0) AS good, count(*) FILTER (WHERE s_suppkey % 7 = 0) AS quarantined,
       CASE WHEN count(*) FILTER (WHERE s_suppkey % 7 = 0) > 0 THEN 'line does not fit the schema' END AS reasons FROM supplier
UNION ALL SELECT 'parquet', count(*), 1, 'not a parquet file' FROM supplier""")
def quarantine(spark, d):
    """A table written with lines cut in two, and one with a file that is
    none of its format; what can be read, and what was set aside and why."""
    lines, files_ = (f"{work_folder(spark)}/{n}-{uuid.uuid4().hex}" for n in ("lines", "files"))
    t = S.table(spark, d, "supplier")
    whole = F.to_json(F.struct(*t.columns))
    t.select(F.when(F.col("s_suppkey") % 7 == 0, F.substring(whole, 1, 12)).otherwise(whole).alias("value")).write.text(lines)
    t.write.parquet(files_)
    t.limit(1).select(F.lit("no table").alias("value")).write.mode("append").text(files_)
    found = []
    for source, path in (("json", lines), ("parquet", files_)):
        good, bad = read_quarantined(spark, path, source, S.SCHEMAS["supplier"])
        n = good.agg(F.count(F.lit(1)).alias("good"))
        why = bad.agg(F.count(F.lit(1)).alias("quarantined"), F.array_join(F.array_sort(F.collect_set("reason")), ", ").alias("reasons"))
        found.append(stats.attach(n, why).select(F.lit(source).alias("source"), "good", "quarantined",
                                                 F.when(F.col("reasons") != "", F.col("reasons")).alias("reasons")))
    return found[0].unionByName(found[1])


@register("catalogue_scan", f"""
SELECT item_id, 'Item: ' || CAST(item_id AS VARCHAR) AS title, CAST('2024-01-01' AS DATE) + CAST(item_id % 300 AS INTEGER) AS date,
       'bench, group ' || CAST(item_id % 3 AS VARCHAR) AS categories, {_WC} AS word_count,
       CAST(ceil({_WC} / 200.0) AS INTEGER) AS reading_time, true AS absent_skipped
FROM benchmark WHERE item_id IS NOT NULL""")
def catalogue_scan(spark, d):
    """Every benchmark text as a document of its own with a header block,
    found again below the root; S8: a root that is not there."""
    root = f"{work_folder(spark)}/documents-{uuid.uuid4().hex}"
    key = F.col("item_id").cast("string")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("item_id") % 300).cast("int")).cast("string")
    head = F.concat(F.lit('---\ntitle: "Item: '), key, F.lit('"\ndate: '), day, F.lit("\ncategories: [bench, 'group "),
                    (F.col("item_id") % 3).cast("string"), F.lit("']\n---\n"))
    docs = S.table(spark, d, "benchmark").filter("item_id IS NOT NULL")
    docs.select("item_id", F.concat(head, F.coalesce("text", F.lit(""))).alias("value")).write.partitionBy("item_id").text(root)
    absent = read_table(spark, f"{root}-absent", fmt="text", on_missing="skip") is None
    items = read_catalogue(spark, root, glob="*.txt")
    return items.select(F.regexp_extract("path", "item_id=(-?[0-9]+)", 1).cast("bigint").alias("item_id"), "title", "date",
                        F.array_join("categories", ", ").alias("categories"), "word_count", "reading_time",
                        F.lit(absent).alias("absent_skipped"))


@register("text_skipping", """
SELECT doc_id, lang, true AS files_skipped FROM documents WHERE contains(lower(text), 'keitlich')""")
def text_skipping(spark, d):
    """All documents written by language with the signatures of their
    files, and a German syllable looked up: the other languages' files stay
    closed."""
    path = f"{work_folder(spark)}/signed-{uuid.uuid4().hex}"
    docs = S.table(spark, d, "documents").select("doc_id", "lang", "text")
    skipping.write_signed(docs, path, ["text"], partition_by=["lang"])
    found = skipping.skipping_search(spark, path, "keitlich", ["text"], docs.schema)
    return found.rows.select("doc_id", "lang", F.lit(found.files_read < found.files).alias("files_skipped"))


@register("gate_missing_column", sql.with_joined("""
, g AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE NOT coalesce(coalesce(total_patients, 0) >= 0, false)) AS v3,
  count(*) FILTER (WHERE NOT coalesce(NOT (coalesce(uninsured, 0) > coalesce(total_patients, 0)), false)) AS v2 FROM joined)
SELECT 'not_empty' AS rule, n AS observed, n > 0 AS passed FROM g
UNION ALL SELECT 'min_rows', n, n > 10 FROM g
UNION ALL SELECT 'required_columns', 1, false FROM g
UNION ALL SELECT 'coordinates_in_bounds', NULL, false FROM g
UNION ALL SELECT 'uninsured_le_total', v2, v2 = 0 FROM g
UNION ALL SELECT 'non_negative_total', v3, v3 = 0 FROM g
UNION ALL SELECT 'gate', CAST(2 + (n <= 0)::INT + (n <= 10)::INT + (v2 > 0)::INT + (v3 > 0)::INT AS BIGINT), false FROM g"""))
def gate_missing_column(spark, d):
    """The gate over a table without its longitudes."""
    return jobs.quality_gate(S.joined(spark, d).drop("longitude"))


@register("parse_params", r"""
WITH q AS (SELECT page_id, regexp_extract(url, '\?([^#]*)', 1) AS qs FROM pages),
pieces AS (SELECT page_id, unnest(string_split(qs, '&')) AS piece,
                  unnest(generate_series(1, len(string_split(qs, '&')))) AS pos
           FROM q WHERE qs <> ''),
kv AS (SELECT page_id, pos, split_part(piece, '=', 1) AS key, split_part(piece, '=', 2) AS value
       FROM pieces WHERE len(string_split(piece, '=')) = 2)
SELECT page_id, key, arg_max(url_decode(value), pos) AS value FROM kv GROUP BY page_id, key""")
def parse_params_q(spark, d):
    p = S.table(spark, d, "pages")
    return p.select("page_id", F.explode(parse_params(query_string("url"))).alias("key", "value"))


@register("add_param", """
WITH u AS (SELECT page_id, url, strpos(url, '#') AS h FROM pages),
b AS (SELECT page_id, CASE WHEN h > 0 THEN substr(url, 1, h - 1) ELSE url END AS base,
             CASE WHEN h > 0 THEN substr(url, h) ELSE '' END AS rest FROM u)
SELECT page_id, base || CASE WHEN strpos(base, '?') > 1 THEN '&' ELSE '?' END || 'q=sitelens' || rest AS link
FROM b""")
def add_param_q(spark, d):
    p = S.table(spark, d, "pages")
    return p.select("page_id", add_param("url", "q", "sitelens").alias("link"))


# --- search ---------------------------------------------------------------------

@register("page_sections", "WITH " + sql.RECORDS + """
SELECT page_id, href, title, section, text, position FROM records""")
def page_sections(spark, d):
    return search.page_sections(S.section_pages(spark, d))


@register("required_fields", "WITH " + sql.RECORDS + """
, g AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE NOT coalesce(href IS NOT NULL AND href <> '', false)) AS v1,
  count(*) FILTER (WHERE NOT coalesce(title IS NOT NULL AND title <> '', false)) AS v2,
  count(*) FILTER (WHERE NOT coalesce(text IS NOT NULL AND text <> '', false)) AS v3 FROM records)
SELECT 'not_empty' AS rule, n AS observed, n > 0 AS passed FROM g
UNION ALL SELECT 'required_columns', 0, true FROM g
UNION ALL SELECT 'href_present', v1, v1 = 0 FROM g
UNION ALL SELECT 'title_present', v2, v2 = 0 FROM g
UNION ALL SELECT 'text_present', v3, v3 = 0 FROM g
UNION ALL SELECT 'gate', CAST((n <= 0)::INT + (v1 > 0)::INT + (v2 > 0)::INT + (v3 > 0)::INT AS BIGINT),
                 n > 0 AND v1 = 0 AND v2 = 0 AND v3 = 0 FROM g""")
def required_fields(spark, d):
    return quality.required_fields(S.search_index(spark, d))


@register("keyword_search", "WITH " + sql.RECORDS + "," + sql.TERMS + """
SELECT query_id, query, CAST(rnk AS INTEGER) AS "rank", href, score FROM results""")
def keyword_search(spark, d):
    return search.keyword_search(S.search_queries(spark, d), S.search_lists(spark, d), details=False)


@register("snippet", "WITH " + sql.RECORDS + "," + sql.TERMS + """
SELECT query_id, href, """ + sql.snippet_sql("text", "query") + """ AS snippet,
       CASE WHEN strpos(href, '#') > 0 THEN substr(href, 1, strpos(href, '#') - 1) ELSE href END
       || CASE WHEN strpos(CASE WHEN strpos(href, '#') > 0 THEN substr(href, 1, strpos(href, '#') - 1)
                                ELSE href END, '?') > 1 THEN '&' ELSE '?' END
       || 'q=' || query
       || CASE WHEN strpos(href, '#') > 0 THEN substr(href, strpos(href, '#')) ELSE '' END AS link
FROM results""")
def snippet_q(spark, d):
    shown = search.with_snippets(S.search_results(spark, d), S.search_lists(spark, d))
    return shown.select("query_id", "href", "snippet", "link")


@register("search_collapsed", "WITH " + sql.RECORDS + "," + sql.TERMS + """
, r AS (SELECT *, CASE WHEN strpos(href, '#') > 0 THEN substr(href, 1, strpos(href, '#') - 1)
                       ELSE href END AS base_href, strpos(href, '#') = 0 AS is_doc FROM results),
r2 AS (SELECT *, row_number() OVER (PARTITION BY query_id, base_href ORDER BY is_doc DESC, rnk) AS item_rank,
              count(*) OVER (PARTITION BY query_id, base_href) AS group_size,
              min(rnk) OVER (PARTITION BY query_id, base_href) AS group_first FROM r),
r3 AS (SELECT *, dense_rank() OVER (PARTITION BY query_id ORDER BY group_first) AS group_rank FROM r2)
SELECT query_id, base_href, CAST(group_rank AS INTEGER) AS group_rank, CAST(item_rank AS INTEGER) AS item_rank,
       CASE WHEN item_rank = 1 THEN 'doc' ELSE 'item' END AS kind, href, CAST(NULL AS BIGINT) AS more
FROM r3 WHERE item_rank <= 3
UNION ALL
SELECT query_id, base_href, CAST(group_rank AS INTEGER), 4, 'more', CAST(NULL AS VARCHAR), CAST(group_size - 3 AS BIGINT)
FROM r3 WHERE item_rank = 1 AND group_size > 3""")
def search_collapsed(spark, d):
    return search.collapse_hits(S.search_results(spark, d))


@register("preview", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5""")
def preview_q(spark, d):
    o = S.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return preview(o, ["o_orderkey"], 5)


@register("params_roundtrip", r"""
WITH q AS (SELECT page_id, regexp_extract(url, '\?([^#]*)', 1) AS qs FROM pages),
pieces AS (SELECT page_id, unnest(string_split(qs, '&')) AS piece,
                  unnest(generate_series(1, len(string_split(qs, '&')))) AS pos
           FROM q WHERE qs <> ''),
kv AS (SELECT page_id, pos, split_part(piece, '=', 1) AS key, split_part(piece, '=', 2) AS value
       FROM pieces WHERE len(string_split(piece, '=')) = 2),
per_key AS (SELECT page_id, key, min(pos) AS first_pos, arg_max(url_decode(value), pos) AS value
            FROM kv GROUP BY page_id, key)
SELECT page_id, string_agg(key || '=' || value, '&' ORDER BY first_pos) AS params
FROM per_key GROUP BY page_id""")
def params_roundtrip(spark, d):
    p = S.table(spark, d, "pages")
    m = parse_params(query_string("url"))
    return p.select("page_id", make_params(m).alias("params")).filter(F.col("params").isNotNull()
                                                                     & (F.col("params") != ""))


@register("non_negative_balance", """
SELECT coalesce(bool_and(coalesce(c_acctbal >= 0, false)), true) AS all_non_negative,
       count(*) FILTER (WHERE NOT coalesce(c_acctbal >= 0, false)) AS violations
FROM customer""")
def non_negative_balance(spark, d):
    c = S.table(spark, d, "customer")
    ok = F.col("c_acctbal") >= 0
    return c.agg(stats.forall(ok).alias("all_non_negative"),
                 F.count_if(clean.violates(ok)).alias("violations"))
