"""Command line: the batch steps as Spark applications.

  python -m sitelens refresh --sites DIR --orgs FILE --out DIR [--region OR] [--csv]
  python -m sitelens gate --joined DIR [--out DIR]          exit status 1 when a rule fails
  python -m sitelens search --pages DIR --queries FILE --out DIR
  python -m sitelens catalogue --root DIR --out DIR [--category NAME]

Inputs and outputs are paths on any file system Spark can read; outputs are
parquet folders (full refresh: overwritten).
"""

from __future__ import annotations

import argparse
import sys

from sitelens.operators import catalogue, quality, search
from sitelens.plans import batch, jobs
from sitelens.session import get_session, scale_conf
from sitelens.sources.catalogue import read_catalogue
from sitelens.sources.publish import current_version, read_published
from sitelens.sources.readers import read_table, write_table


def _refresh(spark, a) -> int:
    batch.refresh(spark, a.sites, a.orgs, a.out, region=a.region, export_csv=a.csv,
                  enforce_gate=not a.no_gate)
    return 0


def _gate(spark, a) -> int:
    published = current_version(spark, a.joined) is not None
    result = jobs.quality_gate(read_published(spark, a.joined, "joined") if published else read_table(spark, a.joined))
    if a.out:
        write_table(result, a.out)
        result = read_table(spark, a.out)
    result.show(truncate=False)
    try:
        quality.enforce(result)
    except quality.GateFailed as e:
        print(e, file=sys.stderr)
        return 1
    return 0


def _search(spark, a) -> int:
    pages = read_table(spark, a.pages)
    queries = read_table(spark, a.queries, fmt=a.queries_format,
                         schema="query_id string, query string" if a.queries_format == "csv" else None)
    index = search.page_sections(pages)
    write_table(index, f"{a.out}/index")
    index = read_table(spark, f"{a.out}/index")
    results = search.keyword_search(queries, search.build_index(index))
    write_table(results, f"{a.out}/results")
    write_table(search.collapse_hits(read_table(spark, f"{a.out}/results")), f"{a.out}/collapsed")
    return 0


def _catalogue(spark, a) -> int:
    items = read_catalogue(spark, a.root)
    write_table(items, f"{a.out}/items")
    items = read_table(spark, f"{a.out}/items")
    write_table(catalogue.facet_counts(items, "categories"), f"{a.out}/facets")
    listed = catalogue.listing_order(catalogue.category_filter(items, "categories", a.category))
    write_table(listed, f"{a.out}/listing")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sitelens")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    p.add_argument("--input-gb", type=int, default=0, help="size of the input, to size partitions by")
    p.add_argument("--cores", type=int, default=0, help="cores of the cluster")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("--sites", required=True)
    r.add_argument("--orgs", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--region", default=None)
    r.add_argument("--csv", action="store_true")
    r.add_argument("--no-gate", action="store_true")
    g = sub.add_parser("gate")
    g.add_argument("--joined", required=True)
    g.add_argument("--out", default=None)
    s = sub.add_parser("search")
    s.add_argument("--pages", required=True)
    s.add_argument("--queries", required=True)
    s.add_argument("--queries-format", default="parquet")
    s.add_argument("--out", required=True)
    c = sub.add_parser("catalogue")
    c.add_argument("--root", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--category", default="")
    a = p.parse_args(argv)
    conf = scale_conf(a.input_gb << 30, a.cores) if a.input_gb and a.cores else None
    spark = get_session(app=f"sitelens-{a.cmd}", master=a.master, conf=conf)
    handler = {"refresh": _refresh, "gate": _gate, "search": _search, "catalogue": _catalogue}[a.cmd]
    return handler(spark, a)


if __name__ == "__main__":
    sys.exit(main())
