"""Catalogue scan over header-block documents written by the test."""

import os

from sitelens.functions import epoch_ms_to_date
from sitelens.operators import catalogue, report
from sitelens.sources.catalogue import read_catalogue

DOCS = {
    "projects/tides/index.qmd": '---\ntitle: "Harbour Tides"\nauthor: "M. Quay"\n'
    'date: "2021-03-14"\ncategories: [sea, charts, python]\nimage: "tide.svg"\n'
    'description: "High water by month."\n---\n\n## Start\n\nOne two three four five.\n',
    "projects/orchard/index.qmd": '---\ntitle: "Orchard"\nsubtitle: "Rows"\ndate: last-modified\n'
    'categories: [Fruit Growing, Weather, Python]\nformat:\n  html:\n    toc: true\n---\n'
    + "word " * 402,
    "projects/hello/index.qmd": "---\ntitle: Hello # a comment\ndate: 2021-03-13\ncategories:\n"
    "  - notes\n  - 'Python'\n---\nHello there\n",
    "projects/notes.qmd": "---\ntitle: not an index file\n---\n",
}


def test_read_catalogue(spark, tmp_path):
    for rel, text in DOCS.items():
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    items = read_catalogue(spark, str(tmp_path))
    got = {os.path.basename(os.path.dirname(r["path"])): r for r in items.collect()}
    assert set(got) == {"tides", "orchard", "hello"}
    p = got["tides"]
    assert (p["title"], p["author"], str(p["date"]), p["image"]) == \
        ("Harbour Tides", "M. Quay", "2021-03-14", "tide.svg")
    assert p["categories"] == ["sea", "charts", "python"]
    assert p["word_count"] == 7 and p["reading_time"] == 1
    assert got["orchard"]["categories"] == ["Fruit Growing", "Weather", "Python"]
    assert got["orchard"]["date"] is not None and got["orchard"]["reading_time"] == 3
    assert got["hello"]["title"] == "Hello" and got["hello"]["categories"] == ["notes", "Python"]
    facets = [(r["category"], r["items"]) for r in catalogue.facet_counts(items, "categories").collect()]
    assert facets[0] == ("All", 3) and ("Python", 2) in facets and ("python", 1) in facets
    ordered = [r["title"] for r in catalogue.listing_order(items).collect()]
    assert ordered[1:] == ["Harbour Tides", "Hello"]
    assert [r["title"] for r in report.page(catalogue.listing_order(items), ["date"], 1, 2)
            .collect()][0] == "Hello"
    shown = items.select(epoch_ms_to_date("date_ms").alias("d")).collect()
    assert "Mar 14, 2021" in {r["d"] for r in shown}
    assert catalogue.category_filter(items, "categories", "Python").count() == 2


def test_catalogue_views(spark, tmp_path):
    from sitelens.plans import jobs
    for rel, text in DOCS.items():
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    items = read_catalogue(spark, str(tmp_path))
    v = jobs.catalogue_views(items, category="Python", page_number=1, page_size=1, term="high water")
    assert [r["title"] for r in v["page"].collect()] == ["Orchard"]
    assert v["listing"].count() == 2
    assert [r["title"] for r in v["search"].collect()] == ["Harbour Tides"]
    assert v["facets"].first()["category"] == "All"
