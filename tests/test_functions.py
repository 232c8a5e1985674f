"""Column functions on the hand-made edge rows of FIXTURES.md §3."""

import math

import pytest

from sitelens.functions import (
    add_param, coerce_numeric, decode_categories, encode_categories, epoch_ms_to_date,
    fmt_count, fmt_fixed, fmt_pct, make_params, normalise_key, parse_params, parts_sum,
    ratio_or_zero, reading_time, residual, slugify, snippet, word_count,
)
from sitelens.functions.text import MARK_CLOSE, MARK_OPEN


def col1(spark, values, ddl, expr):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expr).collect()]


def test_coerce_numeric_good(spark):
    got = col1(spark, ["5", " 5 ", "1e3", "+3", ".5", "5."], "x string", coerce_numeric("x"))
    assert got == [5.0, 5.0, 1000.0, 3.0, 0.5, 5.0]


def test_coerce_numeric_bad(spark):
    bad = ["1,234", "5d", "5f", "0x10", "-", "", "1_000", "1 2", "NaN", "inf", None]
    assert col1(spark, bad, "x string", coerce_numeric("x")) == [None] * len(bad)


def test_normalise_key_text(spark):
    vals = ["100010.0", "100010", "100010.00", "10.0.0", "010010", None]
    assert col1(spark, vals, "k string", normalise_key("k")) == [
        "100010", "100010", "100010.00", "10.0", "010010", None]


def test_normalise_key_number(spark):
    got = col1(spark, [100010.0, 12345678.0, None], "k double", normalise_key("k", numeric=True))
    assert got == ["100010", "12345678", None]


def test_ratio_or_zero(spark):
    rows = [(1.0, 4.0), (0.0, 0.0), (None, 4.0), (2.0, None), (None, 0.0), (1.0, 0.0), (-1.0, 0.0)]
    df = spark.createDataFrame(rows, "n double, d double")
    got = [r[0] for r in df.select(ratio_or_zero("n", "d")).collect()]
    assert got == [0.25, 0.0, 0.0, 0.0, 0.0, math.inf, -math.inf]
    zero = [r[0] for r in df.select(ratio_or_zero("n", "d", zero_den="zero")).collect()]
    assert zero[-2:] == [0.0, 0.0]


def test_parts_and_residual(spark):
    df = spark.createDataFrame([(1.0, 2.0, 100.0), (1.0, None, 100.0)], "a double, b double, t double")
    assert [r[0] for r in df.select(parts_sum("a", "b")).collect()] == [3.0, None]
    mix = spark.createDataFrame([(100.0, 60.0, 50.0)], "t double, m double, u double")
    assert mix.select(residual("t", "m", "u")).first()[0] == -10.0


def test_formats(spark):
    counts = col1(spark, [0.5, 1.5, 2.5, 1234567.5, 646289.0], "x double", fmt_count("x"))
    assert counts == ["0", "2", "2", "1,234,568", "646,289"]
    pcts = col1(spark, [0.0625, 0.4375, 0.1235, 12.5, 1.0005, None], "x double", fmt_pct("x"))
    assert pcts == ["6.2%", "43.8%", "12.3%", "1250.0%", "100.0%", None]
    assert col1(spark, [0.924473], "x double", fmt_fixed("x")) == ["0.92"]


def test_epoch_ms_to_date(spark):
    assert col1(spark, [1765052530000], "x long", epoch_ms_to_date("x")) == ["Dec 6, 2025"]


def test_categories(spark):
    code = "RGF0YSUyMEVuZ2luZWVyaW5nJTJDSGVhbHRoY2FyZSUyQ1B5dGhvbg=="
    got = col1(spark, [code, "%%%"], "x string", decode_categories("x"))
    assert got == [["Data Engineering", "Healthcare", "Python"], None]
    df = spark.createDataFrame([(["a+b", "C d", "é"],)], "c array<string>")
    assert df.select(decode_categories(encode_categories("c"))).first()[0] == ["a+b", "C d", "é"]


def test_parse_and_make_params(spark):
    m = col1(spark, ["a=1&b=2&c&a=9&d=x=y", "", None, "k=a%20b+c"], "s string", parse_params("s"))
    assert m[0] == {"a": "9", "b": "2"}
    assert m[1] is None and m[2] is None
    assert m[3] == {"k": "a b+c"}
    df = spark.createDataFrame([("a=1&b=2&a=9",)], "s string")
    assert df.select(make_params(parse_params("s"))).first()[0] == "a=9&b=2"


def test_add_param(spark):
    got = col1(spark, ["p.html#s", "p.html?x=1#s", "p.html", "?x#a#b"], "u string",
               add_param("u", "q", "z"))
    assert got == ["p.html?q=z#s", "p.html?x=1&q=z#s", "p.html?q=z", "?x?q=z#a#b"]


def test_word_count_and_reading_time(spark):
    assert col1(spark, ["  a b\n c ", "", None], "t string", word_count("t")) == [3, 0, None]
    assert col1(spark, [902, 432, 192, 154, 0], "w int", reading_time("w")) == [5, 3, 1, 1, 0]


def test_slugify(spark):
    got = col1(spark, ["Advanced Analytics & QA", "Visualization: Flipper Length vs. Body Mass",
                       "1. Intro", "&&"], "h string", slugify("h"))
    assert got == ["advanced-analytics-qa", "visualization-flipper-length-vs.-body-mass",
                   "intro", "section"]


def _snippet_reference(query, text):
    """Direct reading of the snippet rules, used as brute force."""
    start = text.lower().find(query.lower())
    if not query or start < 0:
        return text
    end = start + len(query)
    t = text[:start] + MARK_OPEN + text[start:end] + MARK_CLOSE + text[end:]

    def find(pos, step):
        p = pos
        while -1 < p < len(t):
            if t[p] in " ,:":
                return (p if step == 1 else p - step), (1 < p < len(t))
            p += step
        return p - step, False

    pos0 = 0 if start - 50 < 0 else find(start, -1)[0]
    cut = pos0 + len(MARK_OPEN) + len(MARK_CLOSE) + 200
    if cut > len(t):
        return t[pos0:]
    p, clipped = find(cut, 1)
    return t[pos0:p] + ("…" if clipped else "")


def test_snippet_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    words = ["alpha", "beta", "gamma,", "delta:", "Epsilon", "zeta", "x"]
    rows = []
    for _ in range(80):
        n = rnd.randint(0, 120)
        text = " ".join(rnd.choice(words) for _ in range(n))
        if rnd.random() < 0.2:
            text = text.replace(" ", "")
        rows.append((text, rnd.choice(["beta", "EPS", "gamma", "zz", "a"])))
    rows += [("no match here", "qq"), ("Short text", "short")]
    df = spark.createDataFrame(rows, "t string, q string")
    got = [r[0] for r in df.select(snippet("t", "q")).collect()]
    assert got == [_snippet_reference(q, t) for t, q in rows]


@pytest.mark.parametrize("bad", [None])
def test_snippet_null(spark, bad):
    df = spark.createDataFrame([(bad, "q")], "t string, q string")
    assert df.select(snippet("t", "q")).first()[0] is None


def test_epoch_ms_independent_of_session_zone(spark):
    from sitelens.functions import epoch_ms
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(1765052530000,)], "x long")
        assert df.select(epoch_ms_to_date("x")).first()[0] == "Dec 6, 2025"
        ntz = spark.sql("select timestamp_ntz'2025-12-06 20:22:10' t, date'2025-11-23' d")
        r = ntz.select(epoch_ms("t"), epoch_ms("d")).first()
        assert r[0] == 1765052530000 and r[1] == 1763856000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_scale_conf():
    from sitelens.session import scale_conf
    big = scale_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = scale_conf(10 * 2**20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
