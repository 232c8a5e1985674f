"""Operators on the hand-made edge rows of FIXTURES.md §3."""

import math

import pytest
from pyspark.sql import functions as F

from sitelens.operators import catalogue, clean, grain, join, quality, report, search, stats
from sitelens.sources.contracts import ContractError


def test_left_join_fanout_and_report(spark):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, k string")
    right = spark.createDataFrame([("a", 10.0), ("a", 11.0), (None, 12.0)], "k string, v double")
    j = join.enrich_left(left, right, "k")
    assert j.count() == 6
    rep = join.match_report(j, measure="v").first()
    assert (rep["rows"], rep["matched"], rep["matched_measure"]) == (6, 4, 4)
    assert sorted(r["id"] for r in join.unmatched(left, right, "k").collect()) == [3, 4]


def test_match_marker_counts_null_measure(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a", None)], "k string, v double")
    rep = join.match_report(join.enrich_left(left, right, "k"), measure="v").first()
    assert rep["matched"] == 1 and rep["matched_measure"] == 0


def test_keep_first_and_sum_at_grain(spark):
    rows = [("a", 1, 1.0), (None, 2, 2.0), ("a", 3, 3.0), (None, 4, 4.0), ("b", 5, 5.0)]
    df = spark.createDataFrame(rows, "k string, o int, v double")
    kept = sorted(r["v"] for r in grain.keep_first(df, "k", "o").collect())
    assert kept == [1.0, 2.0, 5.0]
    assert grain.sum_at_grain(df, "k", "o", ["v"]).first()["v"] == 8.0
    empty = df.filter(F.lit(False))
    assert grain.sum_at_grain(empty, "k", "o", ["v"]).first()["v"] == 0.0
    assert grain.keep_first(grain.keep_first(df, "k", "o"), "k", "o").count() == 3


def test_threshold_nan_is_null(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (100.0,), (101.0,)], "x double")
    df = clean.nan_to_null_all(df)
    assert [r[0] for r in clean.above(df, "x", 100).collect()] == [101.0]


def test_bounds_violation_counts_missing(spark):
    df = spark.createDataFrame([(41.0,), (47.0,), (40.99,), (None,)], "lat double")
    n = df.filter(clean.violates(clean.in_range("lat", 41, 47))).count()
    assert n == 2


def test_forall(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert df.agg(stats.forall(F.col("x") >= 0)).first()[0] is False
    assert df.filter(F.lit(False)).agg(stats.forall(F.col("x") >= 0)).first()[0] is True


def test_pearson(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (3.0, 9.0), (100.0, None)], "x double, y double")
    r = stats.correlation(df, "x", "y").first()
    assert r["corr"] == pytest.approx(0.924473451641905, abs=1e-9) and r["n"] == 3
    for rows in ([(1.0, 2.0), (1.0, 3.0)], [(1.0, 2.0)], []):
        d = spark.createDataFrame(rows, "x double, y double")
        assert stats.correlation(d, "x", "y").first()["corr"] is None


def test_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    got = {r["probability"]: r["value"] for r in stats.quantiles(df, "x").collect()}
    assert got[0.1] == pytest.approx(1.2) and got[0.5] == 2.0 and got[0.9] == pytest.approx(3.6)
    approx = stats.quantiles(df, "x", method="approx").collect()
    assert len(approx) == 3


def test_ols(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (3.0, 5.0)], "x double, y double")
    r = stats.ols(df, "x", "y").first()
    assert r["slope"] == pytest.approx(1.5) and r["intercept"] == pytest.approx(1 / 3)
    assert r["r2"] == pytest.approx(27 / 28) and r["n"] == 3
    fitted = {row["x"]: row["fitted"] for row in stats.ols_fitted(df, "x", "y").collect()}
    assert fitted[2.0] == pytest.approx(1 / 3 + 3.0)
    g = stats.group_relationship(df.withColumn("g", F.lit("s")), "g", "x", "y").first()
    assert g["n"] == 3 and g["slope"] == pytest.approx(1.5)


def test_payer_mix_keeps_negative_residual(spark):
    df = spark.createDataFrame([("o1", 1, 100.0, 60.0, 50.0), ("o1", 2, 100.0, 60.0, 50.0)],
                               "k string, o int, t double, m double, u double")
    mix = {r["Category"]: (r["Patients"], r["share"])
           for r in report.payer_mix(df, "k", "o", "t", {"Medicaid": "m", "Uninsured": "u"}).collect()}
    assert mix["Medicaid"][0] == 60.0 and mix["Other (Private/Medicare)"][0] == -10.0
    assert sum(s for _, s in mix.values()) == pytest.approx(1.0)


def test_kpi_row(spark):
    df = spark.createDataFrame([("o1", 1, "A", 10.0), ("o1", 2, "A", 10.0), ("o2", 3, "B", 5.0)],
                               "k string, o int, name string, t double")
    r = report.kpi_row(df, "k", "o", "name", "t").first()
    assert (r["sites"], r["organizations"], r["patients"]) == (3, 2, 15.0)


def test_top_page_sample(spark):
    df = spark.createDataFrame([(i, float(i % 7) if i % 5 else None) for i in range(40)],
                               "id int, v double")
    top = report.top_k(df, "v", 5, ["id"]).collect()
    assert [r["v"] for r in top] == [6.0, 6.0, 6.0, 6.0, 5.0]
    p2 = [r["id"] for r in report.page(df, ["id"], 2, 10).collect()]
    assert p2 == list(range(10, 20))
    after = [r["id"] for r in report.page_after(df, ["id"], (19,), 10).collect()]
    assert after == list(range(20, 30))
    assert report.sample_n(df, 5, df.columns[0]).count() == 5
    assert report.sample_n(df.limit(3), 5, df.columns[0]).count() == 3
    assert report.sample_n(df, 5, df.columns[0]).collect() == report.sample_n(df, 5, df.columns[0]).collect()


def test_share_of_total_by_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0)], "g string, v double")
    got = {(r["g"], r["v"]): r["share"] for r in report.share_of_total(df, "v", by=["g"]).collect()}
    assert got[("a", 1.0)] == 0.25 and got[("b", 0.0)] is None


def test_contracts(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    with pytest.raises(ContractError):
        clean.select_strict(df, ["a", "zz"])
    assert clean.select_existing(df, ["zz", "b", "a"]).columns == ["b", "a"]
    assert clean.rename(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]
    assert clean.strip_column_names(df.toDF(" a ", "b ")).columns == ["a", "b"]
    with pytest.warns(UserWarning):
        clean.coerce_columns(df, ["b", "zz"], severity="warn")


def _gate_frame(spark, rows):
    return spark.createDataFrame(rows, "latitude double, longitude double, total_patients double, "
                                       "uninsured double, medicaid double, pct_medicaid double, "
                                       "organization string")


def test_quality_gate(spark):
    good = [(44.0, -120.0, 10.0, 10.0, 1.0, 0.1, "o")] * 11
    res = {r["rule"]: (r["observed"], r["passed"])
           for r in quality.quality_gate(quality.patch_for_gate(_gate_frame(spark, good)),
                                         quality.site_gate()).collect()}
    assert res["gate"] == (0, True) and res["uninsured_le_total"] == (0, True)
    bad = good[:5] + [(None, -120.0, -1.0, 20.0, 1.0, 0.1, "o")]
    res = {r["rule"]: (r["observed"], r["passed"])
           for r in quality.quality_gate(quality.patch_for_gate(_gate_frame(spark, bad)),
                                         quality.site_gate()).collect()}
    assert res["min_rows"] == (6, False)
    assert res["coordinates_in_bounds"] == (1, False)
    assert res["uninsured_le_total"] == (1, False)
    assert res["non_negative_total"] == (1, False)
    assert res["gate"][1] is False
    with pytest.raises(quality.GateFailed):
        quality.enforce(quality.quality_gate(_gate_frame(spark, bad), quality.site_gate()))
    observed, obs = quality.observe_gate(_gate_frame(spark, good), quality.site_gate())
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["__rows"] == 11


def test_facets_filter_search(spark):
    items = spark.createDataFrame([(1, ["Python"]), (2, ["python"]), (3, None)],
                                  "id int, categories array<string>")
    facets = [(r["category"], r["items"]) for r in catalogue.facet_counts(items, "categories").collect()]
    assert facets == [("All", 3), ("python", 1), ("Python", 1)] or \
        facets == [("All", 3), ("Python", 1), ("python", 1)]
    assert [r["id"] for r in catalogue.category_filter(items, "categories", "Python").collect()] == [1]
    assert catalogue.category_filter(items, "categories", "").count() == 3
    docs = spark.createDataFrame([(1, "Hello World"), (2, None), (3, "x")], "id int, t string")
    assert [r["id"] for r in catalogue.table_search(docs, "WORLD").collect()] == [1]


def test_keyword_search_weights_and_collapse(spark):
    recs = spark.createDataFrame([
        ("p1", "Zebra page", "", "nothing"),
        ("p2", "Other", "", "a zebra here"),
        ("p3", "zebra", "Zebra", "zebra"),
        ("p4", "x", "", "y"),
    ], "href string, title string, section string, text string")
    qs = spark.createDataFrame([(1, "ZEBRA"), (2, ""), (3, "z")], "query_id int, query string")
    res = {r["href"]: r["score"] for r in search.keyword_search(qs, recs).collect()}
    assert res == {"p1": 20, "p2": 10, "p3": 50}
    hits = spark.createDataFrame(
        [(1, "pg#a", 1), (1, "pg#b", 2), (1, "pg", 3), (1, "pg#c", 4), (1, "pg#d", 5), (1, "other", 6)],
        "query_id int, href string, rank int")
    out = search.collapse_hits(hits).orderBy("group_rank", "item_rank").collect()
    got = [(r["group_rank"], r["item_rank"], r["kind"], r["href"], r["more"]) for r in out]
    assert got == [(1, 1, "doc", "pg", None), (1, 2, "item", "pg#a", None),
                   (1, 3, "item", "pg#b", None), (1, 4, "more", None, 2),
                   (2, 1, "doc", "other", None)]


def test_page_sections(spark):
    html = ("<html><head><title>T &amp; U</title><script>x</script></head><body><nav>n</nav>"
            "<article><h1>T</h1><p>Intro text.</p><h2>Set up</h2><p>Body one.</p>"
            "<p><b>Lead</b> more</p><h3>Set up</h3><p>Two</p></article><p>between</p>"
            "<article><h4 class=c id='own'>Third</h4>Three<h2>Set up 1</h2>Four</article><footer>f</footer></body></html>")
    bare = "<article><h2>A &#xD800;&#9999999;</h2>x<h2>A &#xD800;&#9999999;</h2>y</article>"
    pages = spark.createDataFrame([(1, "p.html", html), (2, "q.html", bare)], "page_id int, url string, html string")
    rows = search.page_sections(pages).orderBy("page_id", "position").collect()
    recs = {r["href"]: (r["section"], r["text"]) for r in rows}
    assert recs["p.html"] == ("", "Intro text.") and rows[0]["title"] == "T & U"
    assert recs["p.html#set-up"] == ("", "Body one.\nLead more")
    assert recs["p.html#set-up-1"] == ("Set up", "Set up\nTwo")
    assert recs["p.html#own"] == ("Third", "Third\nThree")
    assert recs["p.html#set-up-1-1"] == ("Set up 1", "Set up 1\nFour")
    assert recs["q.html"] == recs["q.html#a"] == ("", "x") and recs["q.html#a-1"] == ("A \ufffd\ufffd", "A \ufffd\ufffd\ny")
    assert len(recs) == len(rows)
    req = {r["rule"]: r["passed"] for r in quality.required_fields(search.page_sections(pages.limit(1))).collect()}
    assert req["gate"] is True


def test_no_python_in_core_plans(spark):
    from sitelens.plans import registry
    for name in ["payer_mix", "enrich_left", "kpi_row", "quality_gate", "page_sections"]:
        plan = registry.REGISTRY[name][0](spark, "/root/testdata/sf0.001")._jdf \
            .queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEval" not in plan


def test_keep_first_uses_group_limit(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    plan = grain.keep_first(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_payer_mix_is_grain_safe_hash_aggregate(spark):
    from sitelens.plans import registry
    plan = registry.REGISTRY["payer_mix"][0](spark, "/root/testdata/sf0.001")._jdf \
        .queryExecution().executedPlan().toString()
    assert "min_by" in plan and "SortAggregate" not in plan
    assert not math.isnan(1.0)


def test_half_of_the_keys_null(spark):
    left = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, F.lit("a")).alias("k"))
    right = spark.createDataFrame([("a", 1.0), (None, 2.0)], "k string, v double")
    j = join.enrich_left(left, right, "k")
    assert j.columns == ["k", "id", "v", "_matched"]
    assert j.count() == 2000 and j.filter("_matched AND v = 1.0").count() == 1000
    assert join.unmatched(left, right, "k").filter("k IS NULL").count() == 1000


def test_distributed_quantiles_match_exact(spark):
    import random
    rnd = random.Random(3)
    vals = [(float(rnd.randint(0, 50)),) for _ in range(500)] + [(None,)] * 5 + [(7.0,)] * 300
    df = spark.createDataFrame(vals, "x double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0)
    exact = {r["probability"]: r["value"] for r in stats.quantiles(df, "x", probs, method="exact").collect()}
    dist = {r["probability"]: r["value"]
            for r in stats.distributed_quantiles(df, "x", probs, slices=5).collect()}
    assert set(exact) == set(dist)
    for p in probs:
        assert dist[p] == pytest.approx(exact[p], abs=1e-12)
    one = spark.createDataFrame([(4.0,)], "x double")
    assert stats.distributed_quantiles(one, "x", [0.5]).first()["value"] == 4.0
    empty = spark.createDataFrame([(None,)], "x double")
    assert stats.distributed_quantiles(empty, "x", [0.5]).first()["value"] is None


def test_keyword_search_without_valid_terms(spark):
    recs = spark.createDataFrame([("p1", "T", "", "x")], "href string, title string, section string, text string")
    qs = spark.createDataFrame([(1, ""), (2, " a ")], "query_id int, query string")
    assert search.keyword_search(qs, recs).count() == 0


def test_keyword_hits_match_brute_force(spark):
    import random
    rnd = random.Random(11)
    terms = ["".join(rnd.choice("abé ") for _ in range(rnd.randint(2, 6))).strip() or "ab" for _ in range(40)]
    texts = [(f"r{i}", "".join(rnd.choice("abÉ ") for _ in range(rnd.randint(0, 40))), rnd.choice(["", None, "ab"])) for i in range(60)]
    recs = spark.createDataFrame(texts, "href string, text string, title string")
    tdf = spark.createDataFrame([(i, t, t) for i, t in enumerate(terms) if len(t) > 1], "query_id int, query string, term string")
    got = {(r["href"], r["term"]): r["score"] for r in search.keyword_hits(tdf, recs, weights={"title": 20, "text": 10}).collect()}
    want = {}
    for href, text, title in texts:
        for t in {t for t in terms if len(t) > 1}:
            score = 10 * (t in text.lower()) + 20 * (t in (title or ""))
            if score:
                want[href, t] = score
    assert got == want and len(want) > 50


def test_many_terms_and_many_queries(spark):
    recs = spark.range(300).selectExpr("concat('p', id) AS href", "concat('word', id, 'x') AS title", "'' AS section", "'common' AS text")
    many = spark.range(200_000).selectExpr("id AS query_id", "concat('word', id, 'X') AS query")
    out = search.keyword_search(many, recs, details=False)
    assert out.count() == 300 and out.filter("query = concat('word', query_id, 'X')").count() == 300
    same = spark.range(1_000_000).selectExpr("id AS query_id", "'Common' AS query")
    out = search.keyword_search(same, recs.limit(2), details=False)
    assert out.agg(F.count("*"), F.countDistinct("query_id")).first() == (2_000_000, 1_000_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_records_that_share_a_key(spark):
    recs = spark.createDataFrame([(1, 0, "h", "zebra", "", "a"), (1, 1, "h", "zebra", "", "b")],
                                 "page_id int, position int, href string, title string, section string, text string")
    out = search.keyword_search(spark.createDataFrame([(1, " Zebra ")], "query_id int, query string"), recs).collect()
    assert [(r["rank"], r["text"], r["query"]) for r in sorted(out, key=lambda r: r["rank"])] == [(1, "a", " Zebra "), (2, "b", " Zebra ")]


def test_enrich_rejects_clashing_columns(spark):
    left = spark.createDataFrame([("a", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 2)], "k string, v int")
    with pytest.raises(ContractError):
        join.enrich_left(left, right, "k")
    assert join.enrich_left(left, right.withColumnRenamed("v", "w"), "k").count() == 1


def test_kpi_row_approx_distinct(spark):
    df = spark.range(5000).selectExpr("cast(id % 100 as string) k", "id o", "cast(id % 100 as string) name",
                                      "1.0 t")
    r = report.kpi_row(df, "k", "o", "name", "t", distinct="approx").first()
    assert r["sites"] == 5000 and abs(r["organizations"] - 100) <= 5 and r["patients"] == 100.0


def test_numeric_entities_match_html_unescape(spark):
    import html
    import re
    texts = ["a&#233;b", "&#x1F600;&#X41;", "&amp;#65;", "&#8217;s", "x&#;y", "&#0233 no semicolon",
             "<p>caf&#xe9;</p>", "plain", "", "&#60;b&#62; &#38;amp; &#1;&#2;", "&#xD800;&#99999999999;&#x110000;&#0;&#x000000041;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(search.decode_numeric_entities(F.col("t"))).collect()]
    markup = {60: "&lt;", 62: "&gt;", 38: "&amp;", 1: "", 2: ""}

    def ref(m):
        code = m.group(1)
        n = int(code[1:], 16) if code[0] in "xX" else int(code)
        if n in markup:
            return markup[n]
        ch = html.unescape(m.group(0))
        return ch if len(ch) == 1 else "\ufffd"
    pattern = re.compile(search.NUMERIC_ENTITY)
    assert got == [pattern.sub(ref, t) for t in texts]
    html_page = ("<html><head><title>Caf&#xe9;</title></head><body><article><p>A &#60;b&#62; tag "
                 "&#38;amp; caf&#233;</p></article></body></html>")
    pages = spark.createDataFrame([(1, "p.html", html_page)], "page_id int, url string, html string")
    rec = search.page_sections(pages).first()
    assert rec["title"] == "Café" and rec["text"] == "A <b> tag &amp; café"


def test_distributed_group_quantiles_match_exact(spark):
    import random
    rnd = random.Random(8)
    rows = [("hot", float(rnd.randint(0, 400))) for _ in range(900)]
    rows += [(g, float(rnd.randint(0, 30))) for g in ("a", "b", None) for _ in range(rnd.randint(1, 40))]
    rows += [("one", 5.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = (0.0, 0.1, 0.5, 0.9, 1.0)
    exact = {(r["g"], r["probability"]): r["value"] for r in stats.quantiles(df, "x", probs, by=["g"], method="exact").collect()}
    dist = {(r["g"], r["probability"]): r["value"]
            for r in stats.quantiles(df, "x", probs, by=["g"], method="distributed").collect()}
    assert set(exact) == set(dist)
    for key, v in exact.items():
        assert dist[key] == pytest.approx(v, abs=1e-9), key


def test_distributed_group_quantiles_two_keys(spark):
    rows = [(g, h, float(i)) for g in ("a", None) for h in (1, 2) for i in range(h * 7)]
    df = spark.createDataFrame(rows, "g string, h int, x double")
    exact = {(r["g"], r["h"], r["probability"]): r["value"]
             for r in stats.quantiles(df, "x", (0.25, 0.75), by=["g", "h"], method="exact").collect()}
    dist = {(r["g"], r["h"], r["probability"]): r["value"]
            for r in stats.quantiles(df, "x", (0.25, 0.75), by=["g", "h"], method="distributed").collect()}
    assert exact == pytest.approx(dist) and len(dist) == 8


def test_quantiles_of_nothing_and_of_close_times(spark):
    empty = spark.createDataFrame([], "g string, x double")
    for method in ("distributed", "exact", "approx"):
        assert [tuple(r) for r in stats.quantiles(empty, "x", (0.1, 0.9), method=method).orderBy("probability").collect()] == [(0.1, None), (0.9, None)]
    rows = spark.createDataFrame([("2024-01-01 00:00:00.000001", 1.0), ("2024-01-01 00:00:00.000002", 9.0), (None, 5.0), (None, None), ("2025-01-01 00:00:00", None)],
                                 "t string, x double").withColumn("t", F.col("t").cast("timestamp"))
    got = stats.quantiles(rows, "x", (0.5,), by=["t"]).collect()
    assert sorted((r["value"] is None, r["value"] or 0.0) for r in got) == [(False, 1.0), (False, 5.0), (False, 9.0), (True, 0.0)]


def test_gate_reports_missing_columns(spark):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(20)], "total_patients double, uninsured double")
    got = {r["rule"]: (r["observed"], r["passed"]) for r in quality.quality_gate(quality.patch_for_gate(df), quality.site_gate()).collect()}
    assert got["required_columns"] == (4, False) and got["coordinates_in_bounds"] == (None, False)
    assert got["non_negative_total"] == (0, True) and got["gate"][1] is False


def test_rewritten_input_is_read_again(spark, tmp_path):
    from sitelens.session import published
    path = str(tmp_path / "t.parquet")
    seen = []
    for n in (3, 30):
        spark.range(n).write.mode("overwrite").parquet(path)
        for _ in range(2):
            df = published(spark, "again", lambda: seen.append(n) or spark.read.parquet(path), [path])
            assert df.count() == n
    assert seen == [3, 30]


def test_shares_and_fits_read_their_input_once(spark):
    for df in (report.share_of_total(spark.range(5).selectExpr("id * 1.0D AS v"), "v"),
               stats.ols_fitted(spark.range(5).selectExpr("id * 1.0D AS x", "id * 2.0D AS y"), "x", "y")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Range (" not in plan and df.count() == 5
