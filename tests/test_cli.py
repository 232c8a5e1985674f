"""The command line on files written by the test and on driver pages."""

from sitelens.__main__ import main
from sitelens.sources.publish import read_published
from tests.test_batch import _orgs, _sites
from tests.xlsx_util import write_xlsx


def test_cli_refresh_gate_catalogue_search(spark, tmp_path):
    write_xlsx(str(tmp_path / "sites.xlsx"), {"Sheet1": _sites()})
    write_xlsx(str(tmp_path / "orgs.xlsx"), {"Table4": _orgs()})
    out = str(tmp_path / "out")
    assert main(["refresh", "--sites", str(tmp_path / "sites.xlsx"), "--orgs",
                 str(tmp_path / "orgs.xlsx"), "--out", out, "--region", "OR", "--csv"]) == 0
    assert read_published(spark, out, "kpi").first()["sites"] == 12
    assert main(["gate", "--joined", out, "--out", str(tmp_path / "gate")]) == 0
    bad = read_published(spark, out, "joined").limit(5)
    bad.write.parquet(str(tmp_path / "small"))
    assert main(["gate", "--joined", str(tmp_path / "small")]) == 1

    docs = tmp_path / "site" / "projects" / "a"
    docs.mkdir(parents=True)
    (docs / "index.qmd").write_text('---\ntitle: "A"\ndate: "2025-01-02"\ncategories: [x, y]\n---\nbody\n')
    assert main(["catalogue", "--root", str(tmp_path / "site"), "--out", str(tmp_path / "cat")]) == 0
    facets = {r["category"]: r["items"] for r in spark.read.parquet(str(tmp_path / "cat" / "facets")).collect()}
    assert facets == {"All": 1, "x": 1, "y": 1}

    (tmp_path / "q.csv").write_text("query_id,query\n1,the\n2,zz\n")
    assert main(["search", "--pages", "/root/testdata/sf0.001/pages.parquet", "--queries",
                 str(tmp_path / "q.csv"), "--queries-format", "csv", "--out", str(tmp_path / "s")]) == 0
    res = spark.read.parquet(str(tmp_path / "s" / "results"))
    index = spark.read.parquet(str(tmp_path / "s" / "index")).collect()
    holding = sum("the" in f"{r['title']}\0{r['section']}\0{r['text']}".lower() for r in index)
    assert res.filter("query_id = '1'").count() == min(50, holding) > 0
