"""The full-refresh batch job: workbooks in, published tables out.

Stages follow the reference's scripts and gate (ingest -> clean -> join ->
analyse, then the data-quality tests), but as one Spark application. The
joined table is written once into a new version of the publication; the gate's
counts ride on that write, so its rules cost no second reading. One grouped
pass over the joined table (``org_groups``) feeds the KPI row, the payer mix
and the fitted line. Readers see a version only when all of its tables are
complete: a failed rule or a job that dies leaves the last good one in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.operators import quality
from sitelens.plans import jobs
from sitelens.sources.publish import Publication, read_published
from sitelens.sources.workbook import read_workbook, strip_cell_text


def refresh(spark: SparkSession, sites_path: str, orgs_path: str, out: str,
            region: str | None = None, orgs_sheet: str = "Table4",
            export_csv: bool = False, enforce_gate: bool = True) -> dict[str, DataFrame]:
    """Run the refresh; returns the tables of the version it published under
    ``out`` (``sources.publish.read_published`` finds them)."""
    sites_raw = strip_cell_text(read_workbook(spark, sites_path))
    sites_raw = sites_raw.withColumn("site_row", F.concat_ws("#", "_file", F.lpad(F.col("_row").cast("string"), 10, "0")))
    sites = jobs.clean_sites(sites_raw, region=region, ordinal="site_row")
    sites = sites.withColumns({c: sites[c].cast("double") for c in ("latitude", "longitude")})
    orgs = jobs.org_metrics(strip_cell_text(read_workbook(spark, orgs_path, sheet=orgs_sheet)))
    joined = jobs.enrich(sites, orgs)

    with Publication(spark, out) as version:
        rules = quality.site_gate(fill=True)
        observed, counts = quality.observe_gate(joined, rules)
        joined = version.write(observed, "joined")
        gate = version.write(quality.observed_gate(joined, rules, counts), "quality_gate")
        if enforce_gate:
            quality.enforce(gate)
        if export_csv:
            version.write(joined, "joined_csv", fmt="csv")

        groups = version.write(jobs.org_groups(jobs.report_frame(joined), "site_row"), "organisations")
        tables = jobs.landscape_report(joined, "site_row", groups)
        for name in tables:
            version.write(tables[name], name)
        version.write(jobs.size_mix_corr(joined), "size_vs_mix")
        version.write(jobs.mix_deciles(joined), "medicaid_deciles")
    return {name: read_published(spark, out, name)
            for name in ["joined", "quality_gate", "organisations", *tables, "size_vs_mix", "medicaid_deciles"]}
