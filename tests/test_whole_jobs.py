"""Jobs that must cover all of their input, on rows made here."""

import __spark_entry__ as E


def tables(spark, path, **rows):
    from sitelens.plans.standins import SCHEMAS
    for name, values in rows.items():
        spark.createDataFrame(values, SCHEMAS[name]).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_corr_by_group_covers_every_organisation(spark, tmp_path):
    """Also those whose key the sheet leaves out (every 97th)."""
    keys = [1, 2, 97, 194]
    d = tables(spark, tmp_path,
               customer=[(k, f"c{k}", 1, 0.0, "A" if k < 100 else "B") for k in keys],
               orders=[(k * 10, k, "O", 1.0, None, "1-URGENT") for k in keys],
               lineitem=[(k * 10, 1, 1, i, q, 1.0, 0.0, 0.0, f, s, None) for n, k in enumerate(keys)
                         for i, (q, f, s) in enumerate([(10.0 * (n + 1), "R", "O"), (5.0 + n * n, "R", "F"), (7.0, "N", "O")])])
    got = {r["segment"]: r for r in E.queries()["corr_by_group"](spark, d).collect()}
    assert {s: r["n"] for s, r in got.items()} == {"A": 3, "B": 1}
    points = [((10 * (n + 1) + 5 + n * n + 7), (10 * (n + 1) + 5 + n * n) / (10 * (n + 1) + 5 + n * n + 7)) for n in range(3)]
    mx, my = (sum(p[i] for p in points) / 3 for i in (0, 1))
    slope = sum((x - mx) * (y - my) for x, y in points) / sum((x - mx) ** 2 for x, _ in points)
    assert abs(got["A"]["slope"] - slope) < 1e-6
    assert "bhcmis_id IS NOT NULL" not in E.oracle_sql()["corr_by_group"] and "% 97" not in E.oracle_sql()["corr_by_group"]


def plain_hits(terms, records, limit):
    """Records of the same names and key count once, with the fields of all."""
    out = set()
    for t in terms:
        held = {}
        for r in records:
            bits = tuple(t in (f or "").lower() for f in r[3:])
            held[r[:3]] = tuple(a or b for a, b in zip(bits, held.get(r[:3], bits), strict=True))
        low = lambda x: (x is not None, x)
        hits = sorted((-sum(w for w, b in zip((20, 20, 10), bits, strict=True) if b), *map(low, (k[2], k[0], k[1]))) for k, bits in held.items() if any(bits))
        out |= {(t, n + 1, -h[0], h[1][1], h[2][1], h[3][1]) for n, h in enumerate(hits[:limit])}
    return out


def test_posting_lists_stay_in_their_blocks(spark, monkeypatch):
    """Repeated and null names, several blocks: the hits are those of brute
    force, and posting lists that a search makes are dealt once, by block;
    only the best few of a block move on."""
    import random

    from sitelens.operators import search
    from sitelens.session import stored
    monkeypatch.setattr(search, "BLOCK_BITS", 3)
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abcé") for _ in range(n))
    records = [(rnd.choice([None, *range(20)]), rnd.randint(0, 2), rnd.choice([None, "p#a", "p#b", "q"]), rnd.choice([None, "", word(4)]),
                rnd.choice(["", word(5)]), " ".join(word(rnd.randint(1, 6)) for _ in range(8))) for _ in range(150)]
    records += records[:30]
    recs = stored(search.numbered(spark.createDataFrame(records, "page_id int, position int, href string, title string, section string, text string").repartition(3)))
    places = stored(search.placed(recs))
    index = search.read_index(recs, places, search.blocks_of(recs, places), search.token_runs(search.postings_of(recs, kept=["record_no"])))
    words = sorted({word(rnd.randint(2, 4)) for _ in range(40)})
    terms = spark.createDataFrame([(w,) for w in words], "term string")
    for limit in (2, 50):
        got = search.top_hits(terms, index, limit).select("term", "rank", "score", "href", "page_id", "position").collect()
        assert {tuple(r) for r in got} == plain_hits(words, records, limit) and len(got) == len(plain_hits(words, records, limit))
    plan = search.word_hits(terms, index, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(block") >= 1 and "hashpartitioning(term" not in plan and "hashpartitioning(token" not in plan
