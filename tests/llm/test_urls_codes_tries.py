"""URL filter, vector codes and conversation tries against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from sitelens.llm import trie, urls, vectors

# -- url filter -----------------------------------------------------------------


def ways(name):
    for n in range(len(name)):
        for at in combinations(range(1, len(name)), n):
            ends = [0, *at, len(name)]
            yield [name[a:b] for a, b in zip(ends, ends[1:])]


def test_names_are_split_into_the_most_probable_words():
    counts, total = {"free": 40, "bet": 30, "bets": 20, "fre": 3, "ebets": 1, "casino": 9, "win": 50, "in": 400}, 1000

    def score(words):
        return sum(math.log(counts[w] / total) if w in counts else -math.log(total + 1) - len(w) * math.log(10) for w in words)

    for name in ("freebets", "casinowin", "xfreebet", "win", "zz", "betsin", "f"):
        found = urls.split_name(name, counts, total)
        assert "".join(found) == name
        assert score(found) == pytest.approx(max(map(score, ways(name))))
    assert urls.split_name("freebets", counts, total) == ["free", "bets"]
    assert urls.split_name("", counts, total) == []


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(urls.LOWER), re.match(r"[^?#]*", rest[len(host):]).group()


def plain_rule(host, path):
    fits = [(len(h + p), h + p, a) for a, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def plain_judge(rows):
    """Every step by dictionaries, on (key, url, html)."""
    parts = {(k, u): plain_url(u) for k, u, _ in rows}
    counts = Counter()
    for _, _, h in rows:
        counts.update(re.findall("[a-z]+", re.sub(urls.MARKUP.replace("(?s)", "").replace("(?i:", "(?i:"), " ", h or "", flags=re.S).translate(urls.LOWER)))
    for host in {h for h, _ in parts.values()}:
        counts.update(re.findall("[a-z]+", " ".join(x for x in host.split(".") if "-" in x)))
    for _, path in set(parts.values()):
        counts.update(re.findall("[a-z]+", path.translate(urls.LOWER)))
    counts = {w: n for w, n in counts.items() if 2 <= len(w) <= urls.LONGEST_WORD}
    total = sum(counts.values())

    def words(host):
        front, last = host.rsplit(".", 1) if "." in host else (host, "")
        out = [w for name in re.findall("[a-z]+", front) for w in urls.split_name(name, {w: n for w, n in counts.items() if w in name}, total)]
        return out + re.findall("[a-z]+", last)

    judged = []
    for k, u, _ in rows:
        host, path = parts[k, u]
        judged.append((k, host, path, *plain_rule(host, path), words(host)))
    shown = []
    for k, host, path, rule, action, found in judged:
        block = action == "block" if action else True if set(found) & set(urls.SEEDS) else None
        if block is not None:
            shown.append((block, urls.url_tokens(found, path)))
    model = urls.fit(shown)
    out = []
    for k, host, path, rule, action, found in judged:
        odds = urls.log_odds(model, urls.url_tokens(found, path))
        out.append((k, host, path, rule, action or ("block" if odds is not None and odds > 0 else "allow"), " ".join(found),
                    None if odds is None else round(odds, 9)))
    return out


def judged(df):
    return [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], " ".join(r["words"] or []),
             None if r["log_odds"] is None else round(r["log_odds"], 9)) for r in df.collect()]


def test_url_filter(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in pages.collect()]
    odd = [(None, "HTTPS://M.Example.ORG/es/1?x#y", None), (7, None, "<p>x</p>"), (7, None, "<p>x</p>"), (8, "no scheme/at all", ""),
           (9, "http://", "a"), (10, "a://b://c/d", "<script>casino casino</script> free"), (11, "http://freecasino.net/win#q?z", "casino free " * 500),
           (12, "http://org", "x" * 100_000), (13, "http://forg/", None), (14, "http://org/", None), (15, "x\ny://host-name.com/fr/Ä", None),
           (16, "http://user@casino-site.de:80/a/99/b", None)]
    schema = "page_id long, url string, html string"
    for data in (rows + odd, odd, []):
        df = spark.createDataFrame(data, schema)
        for c in ("host", "words", "key", "rule", "block", "name"):
            from pyspark.sql import functions as F
            df = df.withColumn(c, F.lit(3))
        assert sorted(judged(urls.judge(df)), key=str) == sorted(plain_judge(data), key=str)
    found = {r[0]: r for r in plain_judge(rows + odd)}
    assert found[11][5] == "free casino net" and found[11][4] == "block"
    assert found[12][3] is None and found[14][3] == "org/" and found[13][3] is None


def test_model_counts_by_hand():
    model = urls.fit([(True, ["a", "a", "b"]), (False, ["b"]), (False, ["c"])])
    assert model[""] == pytest.approx(math.log(1 / 2))
    assert model["a"] == pytest.approx(math.log(3 / 6) - math.log(1 / 5))
    assert urls.log_odds(model, ["x"]) is None and urls.fit([(True, ["a"])]) is None
    assert urls.log_odds(model, ["a", "x", "b"]) == pytest.approx(model[""] + model["a"] + model["b"])


# -- vector codes ----------------------------------------------------------------


def plain_codes(rows):
    """(vec_id, code, error, label) by squared differences alone."""
    kept = [(k, [math.floor(1024 * x) for x in v], y) for k, v, y in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    per = -(-size // 4)
    q = [r[1] + [0] * (4 * per - size) for r in kept]
    cut = [[v[p * per:(p + 1) * per] for p in range(4)] for v in q]
    books = [[c[p] for c in cut[:256]] for p in range(4)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), i) for i, e in enumerate(books[p])) for p in range(4)] for c in cut]

    for _ in range(4):
        near = assign()
        for p in range(4):
            by = defaultdict(list)
            for c, n in zip(cut, near):
                by[n[p][1]].append(c[p])
            for e, members in by.items():
                books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    near = assign()
    text = ",".join(str(x) for b in books for e in b for x in e)
    return [(k, "".join(f"{n[1]:02x}" for n in c), sum(n[0] for n in c), y) for (k, _, y), c in zip(kept, near)], hashlib.sha256(text.encode()).hexdigest()


def coded(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    from pyspark.sql import functions as F
    out = vectors.vector_codes(df.withColumns({c: F.lit(1) for c in ("key", "q", "code", "error", "part", "_label")}))
    return sorted((tuple(r) for r in out.select("vec_id", "code", "error", "label", "label_error", "codebooks_sha256").collect()), key=str)


def want(rows):
    found, digest = plain_codes(rows)
    sums = Counter()
    for _, _, e, y in found:
        sums[y] += e
    return sorted(((k, c, e, y, sums[y], digest) for k, c, e, y in found), key=str)


def floats(rng, n, size):
    return [[float(np.float32(x)) for x in rng.normal(0, 0.2, size)] for _ in range(n)]


def test_vector_codes(spark):
    rng = np.random.default_rng(5)
    rows = [(i * 3 % 401, v, i % 3 or None) for i, v in enumerate(floats(rng, 400, 24))]
    rows += rows[:20] + [(1, None, 1), (2, [], 1), (3, [math.nan] * 24, 1), (4, [math.inf] * 24, 2), (5, [None] + [1.0] * 23, 2),
                         (None, [0.5] * 24, None), (0, [-0.0001] * 24, 9), (8, [1.0] * 8, 1), (6, [60_000.0] * 24, 1)]
    assert coded(spark, rows) == want(rows)


@pytest.mark.parametrize("size", [1, 4, 6, 20])
def test_vector_codes_of_few_and_odd_lengths(spark, size):
    rows = [(i // 2, v, None) for i, v in enumerate(floats(np.random.default_rng(size), 9, size))] + [(50, [0.0] * size, 1)] * 4
    assert coded(spark, rows) == want(rows)


def test_vector_codes_without_rows_and_out_of_range(spark):
    assert coded(spark, []) == [] and coded(spark, [(1, None, 2)]) == []
    with pytest.raises(ValueError):
        coded(spark, [(1, [1e9] * 8, 1)])


def test_transform_scales_distances_exactly_and_orders_by_sign_changes():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 8, 13, 16):
        x, y = rng.integers(-2 ** 20, 2 ** 20, (2, 5, size))
        assert (((vectors.transform(x) - vectors.transform(y)) ** 2).sum(1) == vectors.padded(size) * ((x - y) ** 2).sum(1)).all()
    rows = np.eye(16, dtype=np.int64)
    changes = [(np.diff(np.sign(c)) != 0).sum() for c in vectors.transform(rows).T]
    assert changes == list(range(16))


def test_nearest_takes_the_lower_number_on_ties():
    e = vectors.transform(np.array([[4, 0], [0, 4], [4, 0], [0, 0]]))
    number, distance = vectors.nearest(vectors.transform(np.array([[4, 0], [2, 2], [0, 0], [9, 9]])), e)
    assert number.tolist() == [0, 0, 3, 0] and distance.tolist() == [0, 8, 0, 25 + 81]


# -- conversations ----------------------------------------------------------------


def plain_nodes(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
    members, kids = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    order = sorted(members, key=len, reverse=True)
    leaves, saved, out = Counter(), Counter(), []
    for s in order:
        if s:
            kids[s[:-1]].append(s)
    for s in order:
        saved[s] += (len(members[s]) - 1) * (len(s[-1][1].encode()) if s else 0)
        leaves[s] += not kids[s]
        if s:
            saved[s[:-1]] += saved[s]
            leaves[s[:-1]] += leaves[s]
        ends = ",".join(str(c) for c in members[s] if len(built[c]) == len(s))
        out.append((members[s][0], len(s), members[s[:-1]][0] if s else None, len(members[s]), len(kids[s]), leaves[s], saved[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    from pyspark.sql import functions as F
    out = trie.prefix_nodes(df.withColumns({c: F.lit(1) for c in ("conv", "chain", "path", "id", "depth", "n", "digest")}))
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_prefix_nodes_on_odd_conversations(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, None, None), (0, None, "system", "é🙂"), (1, 0, "user", "hi"), (2, 5, "user", ""), (3, 0, "", "user"),
            (4, 0, "user", "x" * 200_000), (None, 0, "user", "lost"), (-3, 0, "a", "b"), (-5, 0, "a", "c"), (10, 1, "u", "one"), (10, 1, "u", "one"),
            (12, 0, "u", "one"), (25, 0, None, "a")]
    assert nodes_of(spark, rows) == plain_nodes(rows)
    assert nodes_of(spark, []) == []
    assert nodes_of(spark, [(None, 1, "u", "x")]) == []


@pytest.mark.parametrize("seed", range(3))
def test_prefix_nodes_on_random_conversations(spark, seed, monkeypatch):
    """Few different turns, so that paths part, end inside edges and repeat;
    with joins by shuffle as well."""
    if seed == 2:
        monkeypatch.setattr(trie, "BROADCAST_NODES", 0)
        monkeypatch.setattr(trie, "CHUNK", 3)
    rng = np.random.default_rng(seed)
    rows = [(c, t, "user", "ab"[int(rng.integers(0, 2)) if rng.random() < 0.3 else 0])
            for c in range(150) for t in range(int(rng.integers(1, 40 if seed == 1 else 14)))]
    assert nodes_of(spark, rows) == plain_nodes(rows)


def test_trie_is_compact_and_handles_are_two_fattest(spark):
    rows = [(c, t, "u", "x" if t < 6 else str(c)) for c in range(0, 40, 5) for t in range(9)]
    own = trie.turn_chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    convs = trie.rebuilt(own).mapInArrow(trie.chaining, "conv long, chain array<binary>, total array<long>, end binary")
    nodes = trie.build(trie.paths_of(convs)).collect()
    assert sorted((n["up"], n["depth"], len(n["edge"])) for n in nodes) == [(-1, 0, 0), (0, 6, 6)] + [(6, 9, 3)] * 8
    got = spark.range(0, 30).crossJoin(spark.range(1, 40).withColumnRenamed("id", "b")).filter("id < b").select(
        "id", "b", trie.fattest(trie.F.col("id").cast("int"), trie.F.col("b").cast("int")).alias("f")).collect()
    assert all(r["f"] == max(range(r["id"] + 1, r["b"] + 1), key=lambda v: v & -v) for r in got)
