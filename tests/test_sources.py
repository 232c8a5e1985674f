"""Readers: workbook source, contracts, missing input, JSON records, CSV."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sitelens.plans import jobs
from sitelens.sources import readers, workbook
from tests.xlsx_util import write_xlsx


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def test_workbook_first_and_named_sheet(spark, tmp):
    write_xlsx(os.path.join(tmp, "a.xlsx"), {
        "Sites": [[" Site State Abbreviation", "BHCMIS Organization Identification Number ", "Site Name"],
                  ["OR", 100010, "North"], ["WA", 100011.0, "South"], ["OR", None, "East"]],
        "Table4": [["BHCMISID", "T4_L6_Ca", "T4_L7_Ca", "T4_L7_Cb", "T4_L8_Ca", "T4_L8_Cb"],
                   [100010, 200, 10, 5, 50, 20], ["Footnote: see notes", None, None, None, None, None]],
    })
    write_xlsx(os.path.join(tmp, "b.xlsx"), {
        "Sites": [[" Site State Abbreviation", "BHCMIS Organization Identification Number ", "Site Name"],
                  ["OR", "010010", "West & Co"], ["OR", True, "Bool"]]}, inline=True)
    sites = workbook.read_workbook(spark, tmp)
    assert sites.columns[:2] == ["_file", "_row"]
    rows = sorted((r["_row"], r["Site Name"], r["BHCMIS Organization Identification Number "])
                  for r in sites.collect())
    assert rows == [(2, "North", "100010"), (2, "West & Co", "010010"), (3, "Bool", "TRUE"),
                    (3, "South", "100011.0"), (4, "East", None)]
    clean = jobs.clean_sites(sites.withColumns({
        "Geocoding Artifact Address Primary Y Coordinate": F.lit(44.0),
        "Geocoding Artifact Address Primary X Coordinate": F.lit(-120.0)}), region="OR")
    assert clean.count() == 4 and "bhcmis_id" in clean.columns
    orgs = workbook.read_workbook(spark, os.path.join(tmp, "a.xlsx"), sheet="Table4")
    m = {r["bhcmis_id"]: r for r in jobs.org_metrics(orgs).collect()}
    assert set(m) == {"100010", "Footnote: see notes"}
    assert m["100010"]["uninsured"] == 15.0 and m["100010"]["pct_medicaid"] == pytest.approx(0.35)
    assert m["Footnote: see notes"]["total_patients"] is None


def test_workbook_bad_file(spark, tmp):
    write_xlsx(os.path.join(tmp, "good.xlsx"), {"S": [["a"], ["1"]]})
    with open(os.path.join(tmp, "bad.xlsx"), "wb") as fh:
        fh.write(b"not a zip")
    assert workbook.read_workbook(spark, tmp, on_error="skip").count() == 1
    rec = workbook.read_workbook(spark, tmp, on_error="record")
    errs = rec.filter(F.col("_error").isNotNull()).collect()
    assert len(errs) == 1 and errs[0]["_file"].endswith("bad.xlsx") and errs[0]["_row"] == 0
    assert rec.filter(F.col("_error").isNull()).count() == 1
    with pytest.raises(Exception):
        workbook.read_workbook(spark, tmp).count()


def test_missing_input_and_csv(spark, tmp):
    assert readers.read_table(spark, os.path.join(tmp, "nope"), on_missing="skip") is None
    with pytest.raises(Exception):
        readers.read_table(spark, os.path.join(tmp, "nope"))
    p = os.path.join(tmp, "obs.csv")
    with open(p, "w") as fh:
        fh.write("species,island,bill_length_mm,year\nAdelie,Torgersen,39.1,2007\n"
                 "Adelie,Torgersen,NA,2007\nGentoo,Biscoe,46.1,2008\n")
    df = readers.read_table(spark, p, fmt="csv",
                            schema="species string, island string, bill_length_mm double, year int",
                            nullValue="NA")
    assert [r["bill_length_mm"] for r in df.orderBy("year", "bill_length_mm").collect()] == [None, 39.1, 46.1]
    assert readers.preview(df, ["year", "species"], 2).count() == 2
    out = os.path.join(tmp, "out")
    readers.write_table(df, out, fmt="csv")
    readers.write_table(df, out, fmt="csv")  # overwrite = full refresh
    assert spark.read.option("header", True).csv(out).count() == 3
    prof = readers.profile(df, "obs").first()
    assert prof["rows"] == 3 and prof["first_columns"] == "species,island,bill_length_mm,year"


def test_search_records_and_listings(spark, tmp):
    recs = [{"objectID": "p.html", "href": "p.html", "title": "T", "section": "", "text": "x"},
            {"objectID": "p.html#a", "href": "p.html#a", "title": "T", "section": "A", "text": "y"}]
    p = os.path.join(tmp, "search.json")
    with open(p, "w") as fh:
        json.dump(recs, fh)
    assert readers.read_search_records(spark, p).count() == 2
    lp = os.path.join(tmp, "listings.json")
    with open(lp, "w") as fh:
        json.dump([{"listing": "/projects.html", "items": ["/a.html", "/b.html"]},
                   {"listing": "/d.html", "items": []}], fh)
    assert sorted(r["item"] for r in readers.read_listings(spark, lp).collect()) == ["/a.html", "/b.html"]


def test_observation_report(spark, tmp):
    p = os.path.join(tmp, "obs.csv")
    rows = ["species,island,flipper_length_mm,body_mass_g,year"]
    rows += [f"A,X,{180 + i},{3000 + 20 * i},2007" for i in range(10)]
    rows += ["A,X,NA,NA,2007"]
    rows += [f"B,Y,{200 + i},{5000 - 10 * i},2008" for i in range(10)]
    with open(p, "w") as fh:
        fh.write("\n".join(rows) + "\n")
    out = jobs.observation_report(
        spark, p, "species string, island string, flipper_length_mm double, body_mass_g double, year int",
        "species", "flipper_length_mm", "body_mass_g", ["year", "species", "flipper_length_mm"])
    assert out["preview"].count() == 5
    rel = {r["species"]: r for r in out["relationship"].collect()}
    assert rel["A"]["n"] == 10 and rel["A"]["corr"] == pytest.approx(1.0)
    assert rel["B"]["slope"] == pytest.approx(-10.0)


def test_ignore_corrupt_parquet(spark, tmp):
    good = os.path.join(tmp, "t")
    spark.range(5).write.parquet(good)
    with open(os.path.join(good, "part-99999-broken.parquet"), "wb") as fh:
        fh.write(b"PAR1 not really parquet")
    assert readers.read_table(spark, good, schema="id long", ignore_corrupt=True).count() == 5
    with pytest.raises(Exception):
        readers.read_table(spark, good, schema="id long").count()
