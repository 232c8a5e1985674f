"""Token counts, the mix and fingerprints."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitelens.llm import mixing, sketch, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_token_counts_equal_the_library(library, make, odd, documents):
    docs = documents.select("doc_id", "text").collect() + [(100_000 + i, t) for i, (_, t) in enumerate(odd)]
    docs += [(200_000, "<|endoftext|> a<|endoftext|>'s's 'll  \n\n x'RE don't\t\ty 12ab ½²³")]
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.token_counts(make([tuple(d) for d in docs]), PATH).collect()}
    for key, text in docs:
        n = len(library.encode(text or "", add_special_tokens=False))
        assert got[key] == (len((text or "").encode()), n, n > 1024)


ALPHABET = " \n\t　'strevldmaZ09!?.é— 漢<|endoftext|>🙂"


def test_chunks_compose(library):
    table = np.frombuffer(tokens.class_table(), dtype=np.uint8)
    dfa, rnd = tokens.boundary_transducer(), random.Random(2)
    merger = tokens.MergeTransducer(__import__("json").load(open(PATH)))
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 90))) for _ in range(2000)] + ["", "'", "'r", "a" * 70, "ab" * 40]
    want = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    for chunk in (16, 64, 1024):
        assert tokens.count_batch(texts, table, dfa, merger, chunk).tolist() == want


# -- mixing ------------------------------------------------------------------------

def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest, w = total - sum(3 * sizes[s] for s in full), sum(weight[s] for s in names if s not in full)
        share = {s: 3 * sizes[s] if s in full else rest * weight[s] / w for s in names}
        more = {s for s in names if s not in full and share[s] > 3 * sizes[s] + 1e-9}
        if not more:
            return share
        full |= more


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b", "É", "z", "Z"]), st.integers(0, 40)), min_size=1, max_size=25))
def test_schedule(make, rows):
    plan = mixing.schedule(make([(i, "w " * n, s) for i, (s, n) in enumerate(rows)])).collect()
    sizes = defaultdict(int)
    for s, n in rows:
        sizes[s] += n
    want, taken = brute_targets(sizes), defaultdict(int)
    for r in plan:
        assert r["size"] == rows[r["key"]][1] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(plan) == len(rows) and all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_mixture_follows_the_schedule(documents):
    order = mixing.mixture(documents).collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order) and 0 <= order[0]["position"] <= order[-1]["position"] <= 1
    plan = {r["key"]: r for r in mixing.schedule(documents).collect()}
    words = defaultdict(int)
    for r in order:
        words[r["doc_id"]] += r["words"]
        p = plan[r["doc_id"]]
        t = r["position"]                               # the demand up to t is where the copy begins
        demand = p["target"] * (t + p["slope"] * (t * t - t))
        assert abs(demand - (p["before"] + r["pass"] * p["source_size"])) < 1e-6 * p["target"] + 1e-6
    assert {k: v for k, v in words.items()} == {k: p["taken"] for k, p in plan.items() if p["taken"]}


def test_mix_odd_rows(make, odd):
    plan = mixing.schedule(make([(k, t, None if k == 5 else "s") for k, t in odd])).collect()
    assert sorted((r["size"] for r in plan)) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in odd)
    assert mixing.mixture(make([]).limit(0)).count() == 0


# -- fingerprints --------------------------------------------------------------------

def brute_edits(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        yield key, text, text[:len(text) - len(text) // 2] + after[:len(text) // 2], after


def true_likeness(a, b):
    a, b = (set(sketch.shingle_hashes(x).tolist()) for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_fingerprints(make, odd, documents):
    tables = [odd, [tuple(r) for r in documents.select("doc_id", "text").collect()], [(3, "one row only, its own neighbour here")], []]
    for rows in tables:
        got = sorted(sketch.edited_fingerprints(make(rows) if rows else make([]).limit(0)).collect(), key=lambda r: str((r["doc_id"], r["n_chars"], r["edited_sha256"])))
        want = sorted(brute_edits(rows), key=lambda r: str((r[0], len(r[1]), hashlib.sha256(r[2].encode()).hexdigest())))
        assert len(got) == len(want)
        for r, (key, text, edited, after) in zip(got, want, strict=True):
            assert (r["doc_id"], r["n_chars"], r["edited_sha256"]) == (key, len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert r["fingerprint"] == sketch.spelt(sketch.sketch(text)) and r["edited_fingerprint"] == sketch.spelt(sketch.sketch(edited))
            assert abs(r["near_edited"] - true_likeness(text, edited)) < 0.25 and abs(r["near_next"] - true_likeness(text, after)) < 0.25


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2 ** 48 - 1), max_size=400), st.sets(st.integers(0, 2 ** 48 - 1), max_size=400))
def test_sketches_merge(a, b):
    x, y = (sketch.bottom(np.array(sorted(s), dtype=np.uint64), 64) for s in (a, b))
    both = sketch.bottom(np.array(sorted(a | b), dtype=np.uint64), 64)
    assert sketch.merge(x, y, 64).tolist() == both.tolist() and sketch.read(sketch.spelt(x)).tolist() == x.tolist()


def test_estimates():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 2 ** 48, 20_000, dtype=np.uint64)
    b = np.concatenate([a[:10_000], rnd.integers(0, 2 ** 48, 10_000, dtype=np.uint64)])
    x, y = sketch.bottom(a, 512), sketch.bottom(b, 512)
    assert abs(sketch.resemblance(x, y, 512) - 1 / 3) < 0.1 and abs(sketch.containment(x, y, 512) - 0.5) < 0.15
    assert abs(sketch.distinct(x, 512) / 20_000 - 1) < 0.2


def test_sketches_of_groups(spark):
    """The merged sketch of a group is that of all its shingles; one group
    holds most rows, one is null, one has empty texts only."""
    from pyspark.sql import functions as F

    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 40))), rnd.choice(["hot"] * 8 + ["x", None])) for i in range(400)]
    rows += [(900, "", "none"), (901, None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    prints = sketch.fingerprints(docs, k=32).join(docs.select("doc_id", "source"), "doc_id")
    got = {r["source"]: (r["fingerprint"], r["n_distinct"]) for r in sketch.merged_fingerprints(prints, "source", k=32).collect()}
    want = defaultdict(set)
    for _, t, s in rows:
        want[s] |= set(sketch.shingle_hashes(t or "").tolist())
    assert set(got) == set(want)
    for s, hashes in want.items():
        whole = sketch.bottom(np.array(sorted(hashes), dtype=np.uint64), 32)
        assert got[s] == (sketch.spelt(whole), sketch.distinct(whole, 32))
    assert sketch.merged_fingerprints(prints.limit(0), "source").count() == 0
    out = sketch.edited_fingerprints(docs.select("doc_id", "text")).orderBy("doc_id").select("n_distinct", "kept_in_edited", F.col("doc_id")).collect()
    assert all(r["n_distinct"] == len(set(sketch.shingle_hashes(dict((k, t) for k, t, _ in rows)[r["doc_id"]] or "").tolist())) for r in out)
    assert all(0 <= r["kept_in_edited"] <= 1 for r in out)
