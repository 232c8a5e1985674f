"""Archive conversion, the Jaccard join and the pipeline."""

import gzip
import hashlib
import random


import pytest

from sitelens.llm import components, jaccard, warc
from tests.llm.test_scans import brute_decontamination

# -- archives ------------------------------------------------------------------

PAGES = [(5, "a " * 80), (3, "a " * 80), (9, "a " * 80), (None, "a " * 80), (1, ""), (2, None), (4, "short"), (6, "short"), (7, "é\r\n\r\nWARC/1.1\r\n" * 30),
         (8, "é\r\n\r\nWARC/1.1\r\n" * 30), (8, "é\r\n\r\nWARC/1.1\r\n" * 30), (10, "x" * 6_000_000), (11, "\n\nhttp://a 1 2 3 4\n" * 20)]


def brute_pages(pages):
    rows = [(k, (h or "").encode()) for k, h in pages]
    for key, body in rows:
        same = [k for k, b in rows if b == body and k is not None and len(body) >= 100]
        first = min(same, default=None)
        again = first is not None and key != first
        yield key, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None


def test_pages_through_both_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT", 2000)
    pages = spark.createDataFrame([(k, f"http://e.org/{k} b", h, 1) for k, h in PAGES], "page_id long, url string, html string, block int")
    got = warc.archive_pages(pages).collect()
    assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=str) == sorted(brute_pages(PAGES), key=str)
    assert all(r["date"] == "2024-01-01T00:00:00Z" and r["url"].startswith("http://e.org/") for r in got)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_both_versions_parse():
    block = warc.http_block(7, "<p>é</p>")
    for version in (b"1", b"2"):
        data = warc.version_block(version, "f.arc", "20240101000000") + b"\n\n" + warc.arc_record(
            version, "http://a/b", "192.0.2.1", "20230405060708", "text/html", block, 0, "f.arc") + b"\n"
        for packed in (data, gzip.compress(data), gzip.compress(data[:50]) + gzip.compress(data[50:])):
            (r,) = warc.parse_arc(warc.unpacked(packed)[0])
            assert (r["page_id"], r["url"], r["date"], r["record_type"], r["block"]) == (7, "http://a/b", "2023-04-05T06:07:08Z", "response", block)
            assert r["payload_digest"] == hashlib.sha256("<p>é</p>".encode()).hexdigest()
    other = warc.version_block(b"1", "f", "20240101000000") + b"\nftp://x/y z 192.0.2.1 202304050607 text/plain 3\nabc\n"
    (r,) = warc.parse_arc(other)
    assert (r["url"], r["record_type"], r["date"], r["block"]) == ("ftp://x/y z", "resource", "2023-04-05T06:07:00Z", b"abc")
    assert [r["record_type"] for r in warc.parse_arc(other + b"http://a 1 2 3 99\nabc")] == ["resource", "error"]
    assert list(warc.parse_arc(b"")) == [] and warc.record_id(1, "u", "d", "x") == warc.record_id(1, "u", "d", "x")


# -- Jaccard join ------------------------------------------------------------------

def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(docs):
    sets = [(k, shingles(t)) for k, t in docs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k, len(s), least[find(i)]) for i, (k, s) in enumerate(sets))


def corpus(rnd, n):
    """Copies, near copies of several depths, shared passages and short texts."""
    vocab = [f"w{i}" for i in range(400)]
    say = lambda k: [rnd.choice(vocab) for _ in range(k)]
    bases, passage, out = [say(rnd.randint(5, 150)) for _ in range(12)], say(60), []
    for _ in range(n):
        kind = rnd.random()
        text = list(rnd.choice(bases))
        if kind < 0.55:
            for _ in range(rnd.randint(0, 1 + len(text) // 40)):
                text[rnd.randrange(len(text))] = rnd.choice(vocab)
        elif kind < 0.7:
            text = passage + say(rnd.randint(0, 40))
        elif kind < 0.8:
            text = say(rnd.randint(0, 7))
        elif kind < 0.9:
            text = text[:rnd.randint(1, len(text))]
        else:
            text = say(80)
        out.append(" ".join(text).upper() if rnd.random() < 0.1 else " ".join(text))
    return out


def test_components_equal_brute_force(make, monkeypatch):
    for seed, group, limit in ((1, 48, 500_000), (2, 2, 0), (3, 5, 500_000)):
        monkeypatch.setattr(jaccard, "GROUP", group)
        monkeypatch.setattr(jaccard, "BROADCAST_ROWS", limit)
        docs = list(enumerate(corpus(random.Random(seed), 260), 100))
        got = sorted(tuple(r) for r in jaccard.component_ids(make(docs)).collect())
        assert got == brute_components(docs)


def test_exact_residual_step_alone(make, monkeypatch):
    """Without any link from the groups, the matrix must find them all."""
    monkeypatch.setattr(jaccard, "min_hash_pairs", lambda tokens, bands: [int(tokens[0] >> 1)] * 0)
    docs = list(enumerate(corpus(random.Random(9), 120)))
    assert sorted(tuple(r) for r in jaccard.component_ids(make(docs)).collect()) == brute_components(docs)


def test_components_of_odd_rows(make, odd):
    got = sorted((tuple(r) for r in jaccard.component_ids(make([*odd, (6, "another text under a used key here")])).collect()), key=str)
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 2, 5), (6, 2, 5), (6, 2, 5), (6, 3, 6), (7, 1, 7), (8, 1, 8), (9, 1, 9), (None, 3, None)]
    assert got == sorted(want, key=str)
    assert jaccard.component_ids(make([]).limit(0)).count() == 0


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}


# -- pipeline ------------------------------------------------------------------------

def test_pipeline_stages(spark, documents):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs, bench = documents, spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    extra = [(10_000, None), (10_001, "!!! 123"), (10_002, "write to jane.doe@mail.org or 4539578763621486 about these words and more of them here")]
    docs = docs.unionByName(spark.createDataFrame([(k, t, "en", "src1", 5) for k, t in extra], docs.schema))
    kept = {(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in (10_000, 10_001)}
    step = P.language_id(spark, docs, sf)
    assert {(r["doc_id"], r["text"]) for r in step.collect()} == kept and step.columns == docs.columns
    step = P.near_duplicates(spark, step.unionByName(step.limit(2)), sf)
    firsts = {k for k, _, c in brute_components(sorted(kept)) if k == c}
    assert sorted(r["doc_id"] for r in step.collect()) == sorted(firsts) and step.columns == docs.columns
    step = P.decontamination(spark, step, sf)
    clean = {k for k, t in kept if k in firsts and not brute_decontamination(t, [(b["item_id"], b["text"]) for b in bench])[1]}
    assert {r["doc_id"] for r in step.collect()} == clean
    before = {r["doc_id"]: r["text"] for r in step.collect()}
    step = P.pseudonyms(spark, step, sf)
    after = {r["doc_id"]: r for r in step.collect()}
    assert step.columns == docs.columns and after.keys() == before.keys()
    assert "jane.doe" not in after[10_002]["text"] and "4539578763621486" not in after[10_002]["text"]
    assert all(r["n_chars"] == len(r["text"]) for k, r in after.items() if r["text"] != before[k])
    order = P.mixing_order(spark, step, sf).collect()
    assert {r["doc_id"] for r in order} <= after.keys() and [r["position"] for r in order] == sorted(r["position"] for r in order)
    assert len(P.STAGES) == 5 and [n for n, _ in P.STAGES][0] == "language_id"


def test_run_is_the_stages_in_turn(spark):
    import corpus_pipeline as P

    rows = P.run(spark, "/root/testdata/sf0.001").collect()
    again = P.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_pipeline_empty(spark, documents, tmp_path):
    import corpus_pipeline as P

    documents.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_rows_without_a_key_link_like_others(make):
    words = [f"w{i}" for i in range(60)]
    near = lambda i: " ".join([*words[:i], "other", *words[i + 1:]])
    far = " ".join(f"z{i}" for i in range(60))
    docs = make([(None, " ".join(words)), (30, near(2)), (None, near(50)), (None, far), (None, far + " end"), (None, far)])
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.component_ids(docs).collect()), key=str)
    assert got == sorted([(None, 56, 30), (30, 56, 30), (None, 56, 30), (None, 56, None), (None, 57, None), (None, 56, None)], key=str)
    chain = make([(8, near(2)), (None, " ".join(words)), (9, near(57))])        # linked through the row without a key
    assert {r["component_id"] for r in jaccard.component_ids(chain).collect()} == {8}


def arc(*records, version=b"1"):
    return warc.version_block(version, "x.arc", "20240101000000") + b"".join(line + b" %d\n" % len(body) + body + b"\n" for line, body in records)


@pytest.mark.parametrize("version, more", [(b"1", b""), (b"2", b" 200 - - 0 x.arc")])
def test_arc_headers_are_told_by_their_form(version, more):
    """Spaces in content types and addresses, odd dates, IPv6, error records."""
    good = arc((b"http://a/x y 1.2.3.4 20240229123456 text/html; charset=utf-8" + more, b"one"),
               (b"http://b 2001:db8::1 202401021112 -" + more, b"two"), (b"dns:c - 20240102 text/dns" + more, b""), version=version)
    got = [(r["url"], r["ip"], r["date"], r["mime"], r["record_type"], r["block"]) for r in warc.parse_arc(good)]
    assert got == [("http://a/x y", "1.2.3.4", "2024-02-29T12:34:56Z", "text/html; charset=utf-8", "response", b"one"),
                   ("http://b", "2001:db8::1", "2024-01-02T11:12:00Z", "-", "response", b"two"),
                   ("dns:c", "-", "2024-01-02T00:00:00Z", "text/dns", "resource", b"")]
    for bad in (b"http://a 1.2.3.4 notadate text/html", b"http://a 1.2.3.4 20240230000000 text/html", b"http://a text/html 20240101000000"):
        got = list(warc.parse_arc(arc((b"http://b 1.2.3.4 20240101000000 text/html" + more, b"ok"), (bad + more, b"abc"), version=version)))
        assert [r["record_type"] for r in got] == ["response", "error"] and got[1]["block"].startswith(bad)


def test_broken_archives_end_in_error_records(spark, tmp_path):
    import gzip
    one = gzip.compress(arc((b"http://a 1.2.3.4 20240101000000 text/html", b"one")))
    broken = bytearray(gzip.compress(arc((b"http://b 1.2.3.4 20240101000000 text/html", b"two" * 1000))))
    broken[30] ^= 255
    cases = {"whole": (one, []), "padded": (one + b"\0" * 512, []), "tail": (one + b"left over", [b"left over"]),
             "cut": (one + one[:40], [one[:40]]), "broken": (one + bytes(broken), [bytes(broken)])}
    for name, (data, errors) in cases.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.arc.gz").write_bytes(data)
        rows = warc.read_arc(spark, str(tmp_path / name)).collect()
        assert [r["url"] for r in rows if r["record_type"] == "response"] == ["http://a"]
        assert [bytes(r["block"]) for r in rows if r["record_type"] == "error"] == errors, name
