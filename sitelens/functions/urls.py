"""Category codes and URL parameter strings.

Browser semantics reproduced: ``decodeURIComponent`` keeps ``+`` (Spark's URL
decoder would turn it into a blank, so it is escaped first), a ``k=v`` piece
with other than exactly two parts is dropped, the last duplicate wins while
the key keeps the position of its first appearance.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.functions._util import col


def _uri_decode(c: Column) -> Column:
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def decode_categories(c: str | Column) -> Column:
    """base64 -> URI-decode -> split on ``,``; malformed input -> NULL."""
    raw = F.try_to_binary(col(c), F.lit("base64")).cast("string")
    return F.split(_uri_decode(raw), ",", -1)


def encode_categories(c: str | Column) -> Column:
    """Inverse of :func:`decode_categories` for an array of category names."""
    text = F.replace(F.url_encode(F.array_join(col(c), ",")), F.lit("+"), F.lit("%20"))
    return F.base64(F.encode(text, "UTF-8"))


def parse_params(c: str | Column) -> Column:
    """``a=1&b=2&c&a=9`` -> map {a: 9, b: 2}; NULL or empty -> NULL."""
    s = col(c)
    pairs = F.transform(
        F.filter(F.split(s, "&", -1), lambda p: F.size(F.split(p, "=", -1)) == 2),
        lambda p: F.struct(F.split(p, "=", -1)[0].alias("k"),
                           F.split(p, "=", -1)[1].alias("v")))
    firsts = F.filter(
        pairs,
        lambda e, i: ~F.exists(F.slice(pairs, F.lit(1), i), lambda x: x["k"] == e["k"]))
    resolved = F.transform(
        firsts,
        lambda e: F.struct(
            e["k"].alias("key"),
            _uri_decode(F.element_at(F.filter(pairs, lambda x: x["k"] == e["k"]), -1)["v"])
            .alias("value")))
    return F.when(s.isNotNull() & (s != ""), F.map_from_entries(resolved))


def make_params(c: str | Column) -> Column:
    """Map -> ``k=v&k=v`` in key order (no encoding, as the source)."""
    return F.array_join(
        F.transform(F.map_entries(col(c)),
                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")


def query_string(c: str | Column) -> Column:
    """Part of a URL between ``?`` and ``#`` ('' when absent)."""
    return F.regexp_extract(col(c), r"\?([^#]*)", 1)


def add_param(url: str | Column, name: str, value: str | Column) -> Column:
    """Add ``name=value`` before any ``#``; ``&`` if the base has a ``?`` after
    position 0, else ``?``."""
    u = col(url)
    hash_at = F.instr(u, "#")
    base = F.when(hash_at > 0, F.substring_index(u, "#", 1)).otherwise(u)
    rest = F.when(hash_at > 0, F.call_function("substr", u, hash_at)).otherwise(F.lit(""))
    sep = F.when(F.instr(base, "?") > 1, F.lit("&")).otherwise(F.lit("?"))
    v = F.lit(value) if isinstance(value, str) else value
    return F.concat(base, sep, F.lit(name + "="), v, rest)
