"""Versioned publication (S6), the gate on the write (Q7), quarantine (S9),
rank index (L3), lazy report tables (M4, M5) and file skipping (T1)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sitelens.operators import quality, report, skipping
from sitelens.plans import jobs
from sitelens.sources import publish
from sitelens.sources.readers import read_quarantined

JOINED = ("site_id long, bhcmis_id string, organization string, latitude double, longitude double, total_patients double, "
          "uninsured double, medicaid double, pct_medicaid double, pct_uninsured double, site_name string, city string, county string, type string")


def joined(spark, n=60, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        org = rnd.choice([None, *"abcdefg"])
        total = rnd.choice([None, 0.0, 90.0, 500.0, 1200.0])
        rows.append((i, org, rnd.choice([f"Org {org}", None, "Other"]), rnd.choice([None, 44.0, 50.0]), -120.0, total, rnd.choice([None, 10.0, 2000.0]),
                     rnd.choice([None, 30.0]), rnd.choice([None, 0.1, 0.7]), 0.2, f"s{i}", "c", "k", "t"))
    return spark.createDataFrame(rows, JOINED)


# -- S6 ---------------------------------------------------------------------------

def test_readers_keep_the_last_good_version(spark, tmp_path):
    root = str(tmp_path / "pub")
    with pytest.raises(publish.NothingPublished):
        publish.read_published(spark, root, "t")
    for n in (3, 5):
        with publish.Publication(spark, root) as v:
            v.write(spark.range(n), "t")
            v.write(spark.range(n * 10), "u")
    old = publish.read_published(spark, root, "t")
    assert old.count() == 5 and publish.read_published(spark, root, "u").count() == 50

    with pytest.raises(RuntimeError):           # the job fails between two tables
        with publish.Publication(spark, root) as v:
            v.write(spark.range(7), "t")
            raise RuntimeError
    assert publish.read_published(spark, root, "t").count() == 5 and len(publish.versions(spark, root)) == 2

    killed = publish.Publication(spark, root)   # the process dies: nothing cleans up, nothing is published
    killed.write(spark.range(9), "t")
    assert publish.read_published(spark, root, "t").count() == 5

    with publish.Publication(spark, root) as v:
        v.write(spark.range(8), "t")
    assert publish.read_published(spark, root, "t").count() == 8
    assert old.count() == 5                     # a reader that began before goes on
    with publish.Publication(spark, root, keep=1) as v:
        v.write(spark.range(2), "t")
    assert publish.versions(spark, root) == publish.published_versions(spark, root) == [v.version] and publish.read_published(spark, root, "t").count() == 2


def test_writing_the_pointer_is_the_last_step(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "pub")
    with publish.Publication(spark, root) as v:
        v.write(spark.range(1), "t")

    def dies(*_):
        raise OSError("no space")

    monkeypatch.setattr(publish, "_write_text", dies)
    with pytest.raises(OSError):
        with publish.Publication(spark, root) as v:
            v.write(spark.range(2), "t")
    assert publish.read_published(spark, root, "t").count() == 1


# -- Q7 ---------------------------------------------------------------------------

@pytest.mark.parametrize("seed, drop", [(1, []), (2, ["longitude"]), (3, ["uninsured", "organization"])])
def test_gate_on_the_write_equals_the_gate(spark, tmp_path, seed, drop):
    df = joined(spark, seed=seed).drop(*drop)
    rules = quality.site_gate(fill=True)
    observed, counts = quality.observe_gate(df, rules)
    observed.write.mode("overwrite").parquet(str(tmp_path / "joined"))
    plan = quality.observed_gate(df, rules, counts)
    got = {tuple(r) for r in plan.collect()}
    assert got == {tuple(r) for r in jobs.quality_gate(df).collect()} and len(got) >= 6
    assert "Scan" not in plan._jdf.queryExecution().executedPlan().toString()       # no data is read again
    assert spark.read.parquet(str(tmp_path / "joined")).columns == df.columns


# -- S9 ---------------------------------------------------------------------------

def test_quarantine_of_lines(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"a": 1, "b": "x"}\n{"a": 2, "b"\n{"a": "no number", "b": "y"}\n{"a": 3}\n')
    (tmp_path / "j" / "b.json").write_text("")
    good, bad = read_quarantined(spark, str(tmp_path / "j"), "json", "a int, b string")
    assert sorted((r["a"], r["b"]) for r in good.collect() if r["a"] < 3) == [(1, "x")] and good.count() == 2
    rows = bad.collect()
    assert {r["line"] for r in rows if r["line"]} == {'{"a": 2, "b"', '{"a": "no number", "b": "y"}'}
    assert {(os.path.basename(r["file"]), r["reason"]) for r in rows} == {("a.json", "line does not fit the schema")}
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("a,b\n1,x\nfoo,y\n2\n3,z,more\n")
    good, bad = read_quarantined(spark, str(tmp_path / "c"), "csv", "a int, b string")
    assert {(r["a"], r["b"]) for r in good.collect()} >= {(1, "x")} and good.count() + bad.count() == 4 and bad.count() >= 2
    assert all(r["file"].endswith("a.csv") and r["reason"] for r in bad.collect())


def test_quarantine_of_files(spark, tmp_path):
    root = tmp_path / "p"
    spark.range(10).coalesce(1).write.parquet(str(root))
    (root / "broken.parquet").write_bytes(b"this is no parquet file at all")
    (root / "cut.parquet").write_bytes(b"PAR1 and then nothing")
    (root / "_hidden").write_bytes(b"ignored")
    good, bad = read_quarantined(spark, str(root), "parquet", "id long")
    assert good.count() == 10
    assert {(os.path.basename(r["file"]), r["reason"]) for r in bad.collect()} == {
        ("broken.parquet", "not a parquet file"), ("cut.parquet", "no row could be read")}


# -- L3 ---------------------------------------------------------------------------

def test_deep_pages_open_few_ranges(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([None, 1, 2, 3, rnd.randint(0, 500)])) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, v int")
    index = report.RankIndex(df, ["v", "id"], 16)
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    starts = index.starts()
    assert sum(n for _, _, n in starts) == 2000 and len(starts) > 8
    for offset in (0, 1, starts[3][1] - 5, starts[3][1], 1000, 1990, 1999, 2000, 9999):
        assert [tuple(r) for r in index.page(offset, 25).collect()] == want[offset:offset + 25]
    plan = index.page(1000, 25)._jdf.queryExecution().executedPlan().toString()
    held = [p for p, before, n in starts if before < 1025 and before + n > 1000]
    assert len(held) <= 3 and report.PART in plan[plan.index("PartitionFilters"):]
    assert "offset=1000" not in plan
    assert report.RankIndex(df.limit(0), ["v", "id"], 4).page(0, 5).count() == 0


def test_page_after_missing_values(spark):
    rows = [(i, v) for i, v in enumerate([None, None, 1, 1, 2, None, 3])]
    df = spark.createDataFrame(rows, "id int, v int")
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    last, got = None, []
    while page := report.page_after(df, ["v", "id"], last, 2).collect():
        got += [tuple(r) for r in page]
        last = (page[-1]["v"], page[-1]["id"])
    assert got == want


# -- M4, M5 -----------------------------------------------------------------------

def jobs_run(spark, build):
    """Number of Spark jobs that ``build`` starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"group-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    out = build()
    n = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return n, out


def test_report_tables_are_lazy_and_fused(spark):
    df = joined(spark, 300).cache()
    df.count()
    n, tables = jobs_run(spark, lambda: jobs.landscape_report(df, "site_id"))
    assert n == 0 and set(tables) == {"kpi", "payer_mix", "map", "org_fit", "org_fitted", "table", "sample"}
    assert jobs_run(spark, lambda: jobs.size_mix_corr(df))[0] == 0
    rf = jobs.report_frame(df)
    assert tables["kpi"].first().asDict() == report.kpi_row(rf, "bhcmis_id", "site_id", "organization", "total_patients").first().asDict()
    want = report.payer_mix(rf, "bhcmis_id", "site_id", "total_patients", {"Medicaid": "medicaid", "Uninsured": "uninsured"})
    assert {tuple(r) for r in tables["payer_mix"].collect()} == {tuple(r) for r in want.collect()}
    one = jobs.report_summary(jobs.org_groups(rf, "site_id"))
    row, fit = one.first(), tables["org_fit"].first()
    assert row["n_fitted"] == fit["n"] and row["slope"] == pytest.approx(fit["slope"]) and row["r2"] == pytest.approx(fit["r2"])
    assert tables["org_fitted"].count() == fit["n"] and tables["table"] is tables["table"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(bhcmis_id") == 1 and plan.count("InMemoryTableScan") == 1
    assert jobs.report_summary(jobs.org_groups(rf.limit(0), "site_id")).first()["sites"] == 0


# -- T1 ---------------------------------------------------------------------------

def test_text_search_skips_files(spark, tmp_path):
    rnd = random.Random(9)
    letters = {"a": "abcd", "b": "efgh", "c": "ijkl é"}
    rows = [(i, p, "".join(rnd.choice(letters[p]) for _ in range(rnd.randint(0, 60))) or None) for i in range(300) for p in [rnd.choice("abc")]]
    rows.append((999, "b", "a NEEDLE here"))
    df = spark.createDataFrame(rows, "id int, part string, text string")
    path = str(tmp_path / "signed table")
    skipping.write_signed(df.coalesce(1), path, ["text"], partition_by=["part"])
    for term, files in (("needle", 1), ("NEEDLE h", 1), ("abc", 1), ("qqq", 0), ("a", 3), ("jk", 3), ("é", 3), ("needles", None)):
        found = skipping.skipping_search(spark, path, term, ["text"])
        assert {r["id"] for r in found.rows.collect()} == {i for i, _, t in rows if t and term.lower() in t.lower()}
        assert found.files == 3 and (files is None or found.files_read == files)
    assert set(found.rows.columns) == {"id", "part", "text"}
