"""Index build (T5) and keyword search (T3) against plain Python, and their
cost: linear in the page, and no row with both a text and a single term."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sitelens.functions.scan import scan
from sitelens.functions.text import snippet
from sitelens.operators import search, sections

RECORD = "page_id int, position int, href string, title string, section string, text string"


def sections_of(spark, *pages):
    df = spark.createDataFrame([(i, f"{i}.html", h) for i, h in enumerate(pages)], "page_id int, url string, html string")
    out = {}
    for r in sections.page_sections(df).orderBy("page_id", "position").collect():
        out.setdefault(r["page_id"], []).append((r["href"].removeprefix(f"{r['page_id']}.html"), r["section"], r["text"]))
    return [out[i] for i in range(len(pages))]


# -- T5 --------------------------------------------------------------------------

def test_scan_keeps_what_it_sees(spark):
    rows = [(list(range(n)),) for n in (0, 1, 2, 255, 256, 257, 1000)]
    step = lambda s, x: F.struct((s["sum"] + x).alias("sum"), (s["sum"] + x).alias("out"))
    zero = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).cast("bigint").alias("out"))
    df = spark.createDataFrame(rows, "a array<bigint>")
    for chunk in (1, 7, 256):
        got = [r[0] for r in df.select(scan(F.col("a"), zero, step, "bigint", chunk)).collect()]
        assert got == [[sum(a[:i + 1]) for i in range(len(a))] for a, in rows]


def test_elements_nest_and_attributes_hold_anything(spark):
    nested = ("<body>before<article>a<article>b</article>c<nav>x<nav>y</nav>z</nav>d</article>between"
              "<article><footer>f<nav>g</nav></footer>e</article>after</body>")
    attributes = """<article><p title="a > b" data-x='<h2>no</h2>'>one</p><h2 data-id="no" class='c>d' id="yes">Two <b title=">">bold</b></h2>three</article>"""
    raw = "<article>a<script>if (a < b) { '</article>' }</script>b<!-- <h2>no</h2> > -->c<style>x > y {}</style>d<SCRIPT >q</SCRIPT\n>e</article>"
    open_ends = "<article>a<nav>b<h2>inside</h2>"
    headings = "<article>i<h2>One<h3>Two</h3>t<h4>Three</article>tail<article>more</article>"
    no_body = "text <b>bold</b><h1>Title</h1><h2>Set</h2>x<br>y"
    got = sections_of(spark, nested, attributes, raw, open_ends, headings, no_body, "", "<!-- open", "<script>open", "a < b")
    assert got[0] == [("", "", "ab\ncd\ne")]
    assert got[1] == [("", "", "one"), ("#yes", "", "three")]
    assert got[2] == [("", "", "abcde")]
    assert got[3] == [("", "", "a")]
    assert got[4] == [("", "", "i"), ("#one", "", ""), ("#two", "Two", "Two\nt"), ("#three", "Three", "Three\nmore")]
    assert got[5] == [("", "", "text bold"), ("#set", "", "x\ny")]
    assert got[6] == got[7] == got[8] == [("", "", "")] and got[9] == [("", "", "a < b")]


def test_index_build_is_linear(spark):
    """Twice the entities, headings and nested elements cost about twice the
    time, equal and numbered headings included."""
    def page(n):
        return "<article>" + "".join(f"<h2>Same &#233;</h2><p>{i} &#x41;<nav><nav>x</nav></nav></p><h3>Own {i}</h3>" for i in range(n)) + "</article>"

    def run(n):
        df = spark.createDataFrame([(1, "p", page(n))], "page_id int, url string, html string").cache()
        df.count()
        begin = time.perf_counter()
        rows = sections.page_sections(df).collect()
        return time.perf_counter() - begin, rows

    run(100)
    small, _ = run(5_000)
    large, rows = run(10_000)
    assert len(rows) == 20_001 and len({r["href"] for r in rows}) == 20_001
    assert rows[2]["href"] == "p#own-0" and rows[-2]["href"] == "p#same-é-9999" and rows[-2]["text"] == "Same é\n9999 A"
    assert large < 3 * small + 2


def test_anchors_match_one_by_one_numbering(spark):
    def plain(bases):
        used = []
        for b in bases:
            name, n = b, 0
            while name in used:
                n += 1
                name = f"{b}-{n}"
            used.append(name)
        return used

    rnd = random.Random(3)
    rows = [[rnd.choice(["a", "a-1", "a-2", "a-1-1", "b", "c"]) for _ in range(rnd.randint(0, 12))] for _ in range(200)]
    rows += [["a"] * 600, [f"s{i % 7}" for i in range(700)], [f"s{i}" for i in range(300)] * 2, ["a", "a", "a-1"] * 40]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, b array<string>").orderBy("i").select(sections.unique_anchors(F.col("b"))).collect()
    assert [r[0] for r in got] == [plain(r) for r in rows]


# -- T3 --------------------------------------------------------------------------

def plain_search(queries, records, limit):
    out = set()
    for qid, q in queries:
        term = q.strip(" ").lower()
        if len(term) < 2:
            continue
        hits = []
        for p, pos, href, *fields in records:
            score = sum(w for w, f in zip((20, 20, 10), fields) if term in (f or "").lower())
            if score:
                hits.append((-score, href, p, pos))
        out |= {(qid, q, i + 1, h[1], -h[0]) for i, h in enumerate(sorted(hits)[:limit])}
    return out


@pytest.mark.parametrize("probe, most", [(1, 4096), (4, 2), (1, 3)])
def test_search_matches_brute_force(spark, monkeypatch, probe, most):
    """Also where the first candidates do not decide, and where a record is
    read for few terms at a time."""
    monkeypatch.setattr(search, "PROBE", probe)
    monkeypatch.setattr(search, "MOST_TERMS", most)
    rnd = random.Random(probe * 10 + most)
    word = lambda n, letters="abc": "".join(rnd.choice(letters) for _ in range(n))
    records = [(i, j, f"p{i % 40}#{j}", rnd.choice([None, "", word(4), "Abc ABC"]), rnd.choice(["", word(5), "aab"]),
                rnd.choice([None, "", " ".join(word(rnd.randint(1, 7), "abcÉ ") for _ in range(12))]))
               for i in range(60) for j in range(4)]
    queries = [(k, q) for k, q in enumerate([word(rnd.randint(2, 5), "abcé") for _ in range(60)] + [" ABC ", "a", "", "zzzz", "b a", "abc"])]
    qs = spark.createDataFrame(queries, "query_id int, query string")
    recs = spark.createDataFrame(records, RECORD)
    for limit in (3, 50):
        found = search.keyword_search(qs, recs, limit=limit)
        rows = found.collect()
        assert {(r["query_id"], r["query"], r["rank"], r["href"], r["score"]) for r in rows} == plain_search(queries, records, limit)
        brief = search.keyword_search(qs, recs, limit=limit, details=False).collect()
        assert len(brief) == len(rows) and {tuple(r) for r in brief} == plain_search(queries, records, limit)
    marked = found.select("snippet", snippet(F.col("text"), F.lower(F.trim("query"))).alias("own")).collect()
    assert all(r["snippet"] == r["own"] for r in marked)


def test_words_need_no_text_and_phrases_few(spark, monkeypatch):
    """Words are answered from the posting lists; records whose text alone may
    hold a phrase are not looked at once enough titles do."""
    recs = spark.range(2000).selectExpr("cast(id AS int) AS page_id", "0 AS position", "concat('p', lpad(id, 5, '0')) AS href",
                                        "if(id < 300, 'zebra one', 'other') AS title", "'' AS section", "'a zebra one here' AS text")
    index = search.build_index(recs)
    terms = spark.createDataFrame([("ebra",)], "term string")
    phrase = spark.createDataFrame([("ebra on",)], "term string")
    seen = []
    real = search.checked
    monkeypatch.setattr(search, "checked", lambda pairs, index: seen.append(pairs.count()) or real(pairs, index))
    top = search.top_hits(terms, index).orderBy("rank").collect()
    assert [r["href"] for r in top] == [f"p{i:05}" for i in range(50)] and {r["score"] for r in top} == {30}
    assert seen == []
    top = search.top_hits(phrase, index).orderBy("rank").collect()
    assert [r["href"] for r in top] == [f"p{i:05}" for i in range(50)] and {r["score"] for r in top} == {30}
    assert seen == [200]


def test_no_row_holds_a_text_and_a_single_term(spark):
    recs = spark.createDataFrame([(1, 0, "h", "Zebra zebra", "", "a zebra")], RECORD)
    index = search.build_index(recs)
    terms = spark.createDataFrame([("zebra",), ("a ze",)], "term string")
    plan = search.checked(search.candidates(terms, index), index)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list(term") > plan.index("Generate inline")       # gathered below the reading of texts
    held = {r["token"]: r["fields"] for r in index.postings.collect()}
    assert held == {"zebra": 5, "a": 4}
    hits = {(r["term"], r["score"]) for r in search.keyword_hits(terms, index).collect()}
    assert hits == {("zebra", 30), ("a ze", 30)}
    assert "text" not in search.top_hits(terms.limit(1), index)._jdf.queryExecution().optimizedPlan().toString()


def test_stored_postings_are_sorted(spark):
    recs = spark.range(50).selectExpr("cast(id AS int) AS page_id", "0 AS position", "cast(id AS string) AS href", "'Title' AS title",
                                      "'' AS section", "concat('text number ', id) AS text")
    index = search.build_index(recs)
    for df, column in ((index.postings, "token"), (index.runs, "run")):
        by = {}
        for r in df.withColumn("file", F.col("_metadata.file_path")).collect():
            by.setdefault(r["file"], []).append(r[column])
        assert all(v == sorted(v) for v in by.values())
        spans = sorted((v[0], v[-1]) for v in by.values())
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert index.postings.filter("token = 'text'").count() == 50 and index.runs.filter("run = 'tex'").count() == 1
