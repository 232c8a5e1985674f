"""Secret scan, decontamination and pseudonyms against plain Python."""

import base64
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitelens.llm import decontam, pii, secrets

PIECES = ["password", "PassWd", "api_key", "apikey", "token", "secret", ":", "=", " ", "'", '"', "abc123", "AKIA", "ABCDEFGHIJ123456",
          "deadbeef01", "0123456789abcdef", "é", "ſ", "K", "\n", "x", "-", "_", "/+="]


def brute_spans(text):
    """The base kinds by one search each over the whole text."""
    out = [(m.start(), 0, m.end()) for m in re.compile(secrets.ASSIGN, re.I | re.A).finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_scan_equals_plain_search(text):
    assert [s for s in secrets.scan(text, secrets.automaton()) if s[1] < 3] == brute_spans(text)


def token(prefix, rnd):
    body = "".join(rnd.choice(secrets.BASE62) for _ in range(30))
    return prefix + body + secrets.base62(zlib.crc32(body.encode()), 6)


def test_checksums():
    rnd, found = random.Random(3), secrets.automaton()
    good = token("ghp_", rnd)
    bad = good[:-1] + ("A" if good[-1] != "A" else "B")
    assert [secrets.KINDS[k] for _, k, _ in secrets.scan(f"x {good} {bad} {token('npm_', rnd)}", found)] == ["github", "npm"]
    body = bytes(range(90))
    lines = base64.b64encode(body).decode()
    armour = "-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: 1\n\n{}\n{}\n={}\n-----END PGP PRIVATE KEY BLOCK-----".format(
        lines[:64], lines[64:], base64.b64encode(secrets.crc24(body).to_bytes(3, "big")).decode())
    assert [k for _, k, _ in secrets.scan("é" + armour, found)] == [5]
    assert not secrets.scan(armour.replace("Version: 1\n\nAAEC", "Version: 1\n\nAAED"), found)
    assert secrets.redact(f"a {good} b", [("github", 2, 42)]) == "a [github] b"


def test_secret_rows(make, odd, spark):
    rows = {(r["doc_id"], len(r["spans"])) for r in secrets.secret_spans(make([*odd, (10, "token = abcdefg")])).collect()}
    assert rows == {(k, 0) for k, _ in odd} | {(10, 1)}
    assert secrets.secret_spans(make([]).limit(0)).count() == 0


# -- decontamination -----------------------------------------------------------

WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def plain_words(text):
    return re.findall(WORDS, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_decontamination(text, bench):
    w, hit, items = plain_words(text), set(), set()
    for item, t in bench:
        iw = plain_words(t)
        size = min(10, len(iw))
        wins = {tuple(iw[i:i + size]) for i in range(len(iw) - size + 1)} if size else set()
        for i in range(len(w) - size + 1):
            if size and tuple(w[i:i + size]) in wins:
                hit.update(range(i, i + size))
                items.add(str(item))
    return len(w), len(hit), sorted(items)


def test_decontamination(make, odd, spark):
    rnd = random.Random(5)
    vocab = ["a", "b", "c", "É", "d9"]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    bench = [(1, "a b c d9 a b c d9 a b c"), (2, "b"), (3, None), (4, ""), (5, say(13)), (6, "É É d9"), (6, "c c c c"), (None, "d9 d9 d9 a a a"), (7, "B!")]
    docs = [(i, say(n).replace("a", rnd.choice(["a", "A", "a,"]))) for i, n in enumerate([0, 1, 2, 5, 9, 10, 11, 30, 60, 61, 200], 20)] + odd
    frame = spark.createDataFrame(bench, "item_id long, text string")
    named = [(i if i is not None else "∅", t) for i, t in bench]
    for items, n in ((bench, named), (bench[:1], named[:1]), (bench[4:5], named[4:5])):
        frame = spark.createDataFrame([(i if i is not None else None, t) for i, t in items], "item_id long, text string")
        got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontam.decontaminate(make(docs), frame).collect()]
        want = []
        for k, t in docs:
            a, b, c = brute_decontamination(t, n)
            want.append((k, a, b, [x for x in c if x != "∅"]))
        assert sorted(got, key=str) == sorted(want, key=str)
        clean = [k for k, _, hit, _ in want if not hit]
        kept = decontam.drop_contaminated(make(docs), frame)
        assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, clean))
        assert kept.columns == make(docs).columns
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(make(docs), nothing).filter("n_hit > 0").count() == 0
    assert decontam.decontaminate(make([]).limit(0), frame).count() == 0


def test_decontamination_without_broadcast(make, spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    frame = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    got = decontam.decontaminate(make([(1, "x one two three four five six seven eight nine ten y"), (2, "one two")]), frame).collect()
    assert {(r["doc_id"], r["n_hit"]) for r in got} == {(1, 10), (2, 0)}


# -- pseudonyms ------------------------------------------------------------------

def luhn_ok(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def pseudonyms(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [(r["text"], r["kinds"]) for r in pii.pseudonymise(df, key, found="kinds").orderBy("doc_id").collect()]


def test_pseudonyms_keep_formats_and_links(spark):
    texts = ["card 4539578763621486.", "again 4539 5787 6362 1486 x", "mail A.b@c.de and a.b@c.de", "ip 97.51.17.173, 256.1.1.1, 1.2.3.4.5",
             "on 1984-02-29 and 1985-02-29 and 12/31/1999", "ssn 078-05-1120 or 000-12-3456", "DE89 3704 0044 0532 0130 00, GB82WEST12345698765432",
             "+1 (017) 555-7713", "id 4539578763621487 of 12 345", "", None]
    out = pseudonyms(spark, texts)
    one, two = (re.sub("[^0-9]", "", out[i][0]) for i in (0, 1))
    assert one == two != "4539578763621486" and luhn_ok(one) and re.fullmatch(r"again \d{4} \d{4} \d{4} \d{4} x", out[1][0])
    a, b = re.findall(r"\S+@\S+", out[2][0])
    assert a == b and "c.de" not in a
    assert out[3][0].endswith(", 256.1.1.1, 1.2.3.4.5") and out[3][1] == ["ip"] and "97.51.17.173" not in out[3][0]
    assert re.fullmatch(r"on \d{4}-\d\d-\d\d and 1985-02-29 and \d\d/\d\d/\d{4}", out[4][0]) and out[4][1] == ["date", "date"]
    assert out[5][0].endswith("or 000-12-3456") and "078-05-1120" not in out[5][0]
    for account in re.findall(r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]+[0-9]", out[6][0]):
        plain = account.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", out[7][0]) and out[7][0] != texts[7]
    assert out[8] == (texts[8], []) and out[9] == ("", []) and out[10] == (None, [])
    assert pseudonyms(spark, texts[:1], "other")[0] != out[0] and pseudonyms(spark, texts) == out


def test_permutations_are_one_to_one(spark):
    days = spark.range(0, 3000).select(F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    got = [r["text"] for r in pii.pseudonymise(days, "k").collect()]
    assert len(set(got)) == 3000 and all(re.fullmatch(r"(19|20)\d\d-\d\d-\d\d", x) for x in got)
    pairs = spark.range(0, 100).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("d"))
    assert pairs.select(pii.permuted_digits("k", "t", F.col("d")).alias("p")).distinct().count() == 100


ACCOUNTS = ["BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
CARDS = ["4111 1111 1111 1111", "4539578763621486", "3782 822463 10005"]
BESIDE = ["50 euro", "2024-01-05", "EUR 50", "BIC GEBABEBB", "1234", "AB12", "078-05-1120", "97.51.17.173", "word", *ACCOUNTS, *CARDS]


def test_values_side_by_side_are_all_replaced(spark):
    cases = [(x, f"{a} {b}") for x in ACCOUNTS + CARDS for y in BESIDE for a, b in ((x, y), (y, x))
             if not (x in CARDS and (a, b) == ("1234", x))]     # four digits before a card may be valid with its first twelve
    out = pseudonyms(spark, [t for _, t in cases])
    for (value, text), (new, kinds) in zip(cases, out, strict=True):
        assert value not in new and ("iban" if value in ACCOUNTS else "card") in kinds, (text, new)
    alone = {x: new for x, (new, _) in zip(ACCOUNTS + CARDS, pseudonyms(spark, ACCOUNTS + CARDS), strict=True)}
    # what follows AB12, no country, may be valid together with it
    assert all(alone[value] in new for (value, text), (new, _) in zip(cases, out, strict=True) if value in CARDS or "AB12" not in text)
    new, kinds = pseudonyms(spark, ["BE68 5390 0754 7034 2024-01-05"])[0]
    assert kinds == ["iban", "date"] and "2024-01-05" not in new
    assert pseudonyms(spark, ["AB12 4111 1111 1111 1112 x"])[0] == ("AB12 4111 1111 1111 1112 x", [])
    assert pseudonyms(spark, ["call +1 555 0123 4567 2024 x"])[0][1] == ["phone"]


def test_many_values_in_one_text(spark):
    parts = ["AB12 4111 1111 1111 1111", "BE68 5390 0754 7034 50", "1985-02-29 1984-02-29"] * 700
    once = [pseudonyms(spark, [x])[0] for x in parts[:3]]
    new, kinds = pseudonyms(spark, ["; ".join(parts)])[0]
    assert new == "; ".join(x for x, _ in once * 700) and kinds == [k for _, ks in once * 700 for k in ks]


def test_pseudonyms_leave_other_columns(make, odd):
    df = make(odd)
    out = pii.pseudonymise(df, "k")
    assert out.columns == df.columns and sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, df.select("doc_id", "text").collect()))


def test_staged_tables_are_removed(spark):
    import os

    from sitelens.llm import staging
    kept = spark.sparkContext.getCheckpointDir()
    df = staging.staged(spark.range(3), "some")
    folder = staging.shared_folder(spark).removeprefix("file:")
    assert df.count() == 3 and os.path.isdir(folder) and folder.startswith(kept.removeprefix("file:"))
    staging.remove_staged(spark)
    assert not os.path.exists(folder)
    assert staging.staged(spark.range(2), "again").count() == 2
