"""Composite jobs M1-M9: the reference's scripts, report, gate, catalogue and
search, built from the operators. All are lazy plans but for those that store
a stage on the way (``mix_deciles``, the fitted line, ``site_search``)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions import fmt_fixed, fmt_pct, normalise_key, parts_sum, ratio_or_zero
from sitelens.operators import catalogue, clean, grain, join, quality, report, search, stats
from sitelens.session import stored

# Header names of the raw sites sheet and the org-metrics
# sheet, and the clean column names they become.
SITE_RENAMES = {
    "BHCMIS Organization Identification Number": "bhcmis_id",
    "Health Center Name": "organization",
    "Site Name": "site_name",
    "Site City": "city",
    "County Equivalent Name": "county",
    "Health Center Type": "type",
    "Geocoding Artifact Address Primary Y Coordinate": "latitude",
    "Geocoding Artifact Address Primary X Coordinate": "longitude",
}
SITE_COLUMNS = ["bhcmis_id", "organization", "site_name", "city", "county", "type",
                "latitude", "longitude"]
STATE_COLUMN = "Site State Abbreviation"
ORG_KEY = "BHCMISID"
ORG_TOTAL = "T4_L6_Ca"
ORG_UNINSURED = ("T4_L7_Ca", "T4_L7_Cb")
ORG_MEDICAID = ("T4_L8_Ca", "T4_L8_Cb")
ORG_MEASURES = ["total_patients", "uninsured", "medicaid", "pct_uninsured", "pct_medicaid"]
DISPLAY_LABELS = ["Organization", "Site", "City", "Org Total Patients", "% Medicaid", "% Uninsured"]


def clean_sites(raw: DataFrame, region: str | None = None, ordinal: str | None = None, placed: bool = True) -> DataFrame:
    """M1: trim headers, keep one region, rename, keep the known columns that
    exist (plus the ordinal), drop rows without coordinates (``placed``)."""
    df = clean.strip_column_names(raw)
    if region is not None:
        df = clean.equals(df, STATE_COLUMN, region)
    df = clean.rename(df, SITE_RENAMES)
    df = clean.select_existing(df, ([ordinal] if ordinal else []) + SITE_COLUMNS)
    return clean.drop_missing(df, ["latitude", "longitude"]) if placed else df


def org_metrics(raw: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """M2: lenient numbers, totals of the two parts, shares (0 when missing),
    normalised key, rows without a key dropped."""
    cols = [ORG_TOTAL, *ORG_UNINSURED, *ORG_MEDICAID]
    df = clean.coerce_columns(raw, cols, severity="stop")
    df = df.withColumns({
        "total_patients": F.col(ORG_TOTAL),
        "uninsured": parts_sum(*ORG_UNINSURED),
        "medicaid": parts_sum(*ORG_MEDICAID),
    })
    df = df.withColumns({
        "pct_uninsured": ratio_or_zero("uninsured", "total_patients"),
        "pct_medicaid": ratio_or_zero("medicaid", "total_patients"),
    })
    df = clean.select_strict(df, [ORG_KEY, *ORG_MEASURES, *(extra or [])])
    df = df.withColumn(ORG_KEY, normalise_key(ORG_KEY)).withColumnRenamed(ORG_KEY, "bhcmis_id")
    return clean.drop_null_keys(df, "bhcmis_id")


def enrich(sites: DataFrame, orgs: DataFrame) -> DataFrame:
    """M3: normalised site keys, left join of the org measures."""
    sites = sites.withColumn("bhcmis_id", normalise_key("bhcmis_id"))
    return join.enrich_left(sites, orgs, "bhcmis_id")


def size_mix_corr(joined: DataFrame, threshold: float = 100) -> DataFrame:
    """M4: site-grain correlation of size and Medicaid share on rows with more
    than ``threshold`` patients."""
    corr = stats.correlation(clean.above(joined, "total_patients", threshold), "total_patients", "pct_medicaid")
    return corr.withColumn("corr_text", fmt_fixed("corr", 2))


def mix_deciles(joined: DataFrame, threshold: float = 100) -> DataFrame:
    """M4: 10th, 50th and 90th percentile of the Medicaid share of the same
    rows. The exact distributed quantile looks for its slices when the frame
    is built, so it runs jobs; the correlation has none of them."""
    return stats.quantiles(clean.above(joined, "total_patients", threshold), "pct_medicaid", (0.1, 0.5, 0.9))


def report_frame(joined: DataFrame) -> DataFrame:
    """The report's working table: missing measures shown as 0 and the
    formatted hover fields (``pct_uninsured`` is left unfilled, as in the
    source)."""
    df = clean.fill_zero(joined, ["total_patients", "pct_medicaid", "uninsured", "medicaid"])
    return report.with_tooltips(df, "total_patients", "pct_medicaid")


def org_grain(joined: DataFrame, ordinal: str, threshold: float | None = 100) -> DataFrame:
    """First row per organisation, optionally only the large ones."""
    orgs = grain.first_at_grain(joined, "bhcmis_id", ordinal,
                                ["organization", "total_patients", "pct_medicaid", "uninsured"])
    return clean.above(orgs, "total_patients", threshold) if threshold is not None else orgs


def display_table(df: DataFrame) -> DataFrame:
    """P5 + P3 + K7: the searchable table with formatted shares."""
    out = clean.select_strict(df, ["organization", "site_name", "city", "total_patients",
                                   "pct_medicaid", "pct_uninsured"])
    out = clean.relabel(out, DISPLAY_LABELS)
    return out.withColumns({"% Medicaid": fmt_pct("% Medicaid"),
                            "% Uninsured": fmt_pct("% Uninsured")})


class LazyTables(Mapping):
    """Named tables, each built when it is first asked for."""

    def __init__(self, builds: dict[str, Callable[[], DataFrame]]):
        self._builds, self._built = builds, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builds[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builds)

    def __len__(self) -> int:
        return len(self._builds)


SUMMED = ["total_patients", "medicaid", "uninsured", "pct_medicaid"]


def org_groups(rf: DataFrame, ordinal: str) -> DataFrame:
    """(bhcmis_id, sites, names, first row's measures): the one grouped pass
    over the report's working table that its KPI row, payer mix and fit need.
    A missing organisation key is one group. ``names`` are the organisation's
    different names, of which a key has few."""
    first = F.min_by(F.struct("organization", *SUMMED), F.col(ordinal)).alias("first")
    return rf.groupBy("bhcmis_id").agg(F.count(F.lit(1)).alias("sites"), F.collect_set("organization").alias("names"), first).select(
        "bhcmis_id", "sites", "names", *[F.col(f"first.{c}").alias(c) for c in ("organization", *SUMMED)])


def report_summary(groups: DataFrame, threshold: float = 100) -> DataFrame:
    """M5 in one row, from ``org_groups``: KPI row (sites, organizations,
    patients), the parts of the payer mix, and the line fitted to the
    organisations with more than ``threshold`` patients. The names are told
    apart in the same plan (``explode`` of the few rows), everything else is
    one global aggregate over one row per organisation."""
    large = F.col("total_patients") > threshold
    x, y = F.when(large, F.col("total_patients")), F.when(large, F.col("pct_medicaid"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    return groups.select("*", F.explode_outer("names").alias("name"), F.get("names", F.lit(0)).alias("lead")).select(
        "name", *[F.when(F.col("name").eqNullSafe(F.col("lead")), F.col(c)).alias(c) for c in ("sites", *SUMMED)]).agg(
        F.coalesce(F.sum("sites"), F.lit(0)).alias("sites"), F.count_distinct("name").alias("organizations"), zero("total_patients").alias("patients"),
        zero("medicaid").alias("medicaid"), zero("uninsured").alias("uninsured"),
        (zero("total_patients") - (zero("medicaid") + zero("uninsured"))).alias("other"),
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.count_if(x.isNotNull() & y.isNotNull()).alias("n_fitted"))


def landscape_report(joined: DataFrame, ordinal: str, groups: DataFrame | None = None) -> Mapping[str, DataFrame]:
    """M5: every table of the report page from one joined table. Nothing is
    built, and no job runs, before a table is asked for. ``groups``: the
    stored ``org_groups``, where a job keeps them for all tables."""
    rf = report_frame(joined)
    held = {"groups": groups}

    def grouped() -> DataFrame:
        if held["groups"] is None:
            held["groups"] = org_groups(rf, ordinal)
        return held["groups"]

    def large() -> DataFrame:
        orgs = grouped().select("bhcmis_id", "organization", "total_patients", "pct_medicaid", "uninsured")
        return clean.above(orgs, "total_patients", 100)

    hover = {"latitude": False, "longitude": False, "total_patients": False, "pct_medicaid": False, "uninsured": False,
             "medicaid": False, "organization": True, "city": True, "Patients (fmt)": True, "Medicaid %": True}
    mix = {"Medicaid": "medicaid", "Uninsured": "uninsured"}
    return LazyTables({
        "kpi": lambda: report_summary(grouped()).select("sites", "organizations", "patients"),
        "payer_mix": lambda: report.mix_rows(grouped().agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in SUMMED[:3]]),
                                             "total_patients", mix),
        "map": lambda: report.map_layer(rf, "latitude", "longitude", "total_patients", "pct_medicaid", "site_name", hover),
        "org_fit": lambda: stats.ols(large(), "total_patients", "pct_medicaid"),
        "org_fitted": lambda: stats.ols_fitted(large(), "total_patients", "pct_medicaid"),
        "table": lambda: display_table(rf),
        "sample": lambda: report.sample_n(rf, 5, ordinal).select("site_name", "city", "county", "type"),
    })


def group_relationship(obs: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Per-group n, correlation and fitted line."""
    return stats.group_relationship(obs, group, x, y)


def observation_report(spark, path: str, schema: str, group: str, x: str, y: str,
                       order: list[str], null_value: str = "NA") -> dict[str, DataFrame]:
    """M6: a delimited observation table read with an explicit schema and its
    missing-value marker (S4), its first rows (S11) and the relationship of
    two measures per group (A12)."""
    from sitelens.sources.readers import preview, read_table
    obs = read_table(spark, path, fmt="csv", schema=schema, nullValue=null_value)
    return {"preview": preview(obs, order, 5),
            "relationship": group_relationship(obs, group, x, y)}


def quality_gate(joined: DataFrame) -> DataFrame:
    """M7: patch, then all rules in one aggregation."""
    return quality.quality_gate(quality.patch_for_gate(joined), quality.site_gate())


def catalogue_facets(items: DataFrame, categories: str = "categories") -> DataFrame:
    """Facet counts of a catalogue."""
    return catalogue.facet_counts(items, categories)


def catalogue_views(items: DataFrame, category: str = "", page_number: int = 1,
                    page_size: int = 20, term: str | None = None,
                    key: str | None = None) -> dict[str, DataFrame]:
    """M8: facets, the items of one category newest first, one page of them
    and a text search over title and description. ``key`` breaks the ties of
    date and title."""
    chosen = catalogue.category_filter(items, "categories", category)
    newest_first = [F.col("date").desc_nulls_last(), F.col("title"), *([F.col(key)] if key else [])]
    views = {"facets": catalogue_facets(items),
             "listing": catalogue.listing_order(chosen),
             "page": report.page(chosen, newest_first, page_number, page_size)}
    if term is not None:
        views["search"] = catalogue.table_search(items, term, ["title", "description"])
    return views


def site_search(queries: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M9: index build, weighted search, per-page collapse."""
    index = search.build_index(search.page_sections(pages))
    results = stored(search.keyword_search(queries, index), "results")
    return results, search.collapse_hits(results)


__all__ = ["clean_sites", "org_metrics", "enrich", "size_mix_corr", "mix_deciles", "landscape_report", "org_groups", "report_summary",
           "group_relationship", "observation_report", "catalogue_views", "quality_gate", "catalogue_facets", "site_search",
           "display_table", "report_frame", "org_grain"]
