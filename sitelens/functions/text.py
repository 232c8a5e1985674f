"""Text measures and search snippets (K13, K15, section anchors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.functions._util import col
from sitelens.functions.scan import bind

# Whitespace set shared with the SQL oracle (Java's and RE2's
# ``\s`` differ on vertical tab), snippet marks, context widths and the
# characters a snippet may be cut at.
WHITESPACE = r"[ \t\n\x0B\f\r]+"
MARK_OPEN = "<mark class='search-match'>"
MARK_CLOSE = "</mark>"
LEFT_CONTEXT = 50
RIGHT_CONTEXT = 200
NOT_BOUNDARY_RUN = "^[^ ,:]*"
WORDS_PER_MINUTE = 200


def word_count(c: str | Column) -> Column:
    """Number of whitespace-separated words; NULL text -> NULL."""
    t = col(c)
    return F.when(t.isNotNull(),
                  F.size(F.filter(F.split(t, WHITESPACE), lambda w: w != "")))


def reading_time(words: str | Column, per_minute: int = WORDS_PER_MINUTE) -> Column:
    """Minutes at ``per_minute`` words per minute, rounded up (902 -> 5)."""
    return F.ceil(col(words) / F.lit(per_minute)).cast("int")


def slugify(c: str | Column) -> Column:
    """Heading to anchor: lower case, keep letters/digits/``_ . -``, blanks to
    single ``-``, leading non-letters dropped; empty -> ``section``."""
    kept = F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{N}_. \t\n\r\f-]", "")
    words = F.filter(F.split(kept, WHITESPACE), lambda w: w != "")
    slug = F.regexp_replace(F.array_join(words, "-"), r"^[^\p{L}]+", "")
    return F.when(slug == "", F.lit("section")).otherwise(slug)


def snippet(text: str | Column, query: str | Column, low: Column | None = None) -> Column:
    """Mark the first case-insensitive match of ``query`` in ``text`` and clip.

    Left clip when the match starts at or after 50: to just after the nearest
    blank, ``,`` or ``:`` before it. Right clip at the first such character from
    200 characters (plus the mark lengths) after the snippet start, with ``…``.
    If there is none, the last character is dropped (kept quirk of the source
    behaviour). No match, empty query or NULL text -> text unchanged. ``low``:
    the lower-cased text, where a caller has it for several queries.

    Every step is bound, so it is computed once, also inside of a lambda.
    """
    sub = lambda c, at, n: F.substring(c, at, n)
    mark_len = len(MARK_OPEN) + len(MARK_CLOSE)

    def clipped(x: Column) -> Column:
        t, start, qlen = x["t"], x["start"], x["qlen"]
        marked = F.concat(sub(t, F.lit(1), start), F.lit(MARK_OPEN), sub(t, start + 1, qlen), F.lit(MARK_CLOSE),
                          sub(t, start + 1 + qlen, F.length(t) + 1))
        before = F.reverse(sub(t, F.lit(1), start))
        run_left = F.length(F.regexp_extract(before, NOT_BOUNDARY_RUN, 0))
        return bind(F.struct(marked.alias("marked"), run_left.alias("run_left"), start.alias("start"), (F.length(t) + mark_len).alias("total")), cut_left)

    def cut_left(x: Column) -> Column:
        start, run_left = x["start"], x["run_left"]
        clip_from = F.when(start < LEFT_CONTEXT, F.lit(0)).when(run_left < start, start - run_left).otherwise(F.lit(0))
        return bind(F.struct(x["marked"].alias("marked"), x["total"].alias("total"), clip_from.alias("left")), cut_right)

    def cut_right(x: Column) -> Column:
        cut = x["left"] + mark_len + RIGHT_CONTEXT
        tail = sub(x["marked"], cut + 1, x["total"] + 1)
        return bind(F.struct(x["marked"].alias("marked"), x["total"].alias("total"), x["left"].alias("left"), cut.alias("cut"),
                             F.length(F.regexp_extract(tail, NOT_BOUNDARY_RUN, 0)).alias("run"), F.length(tail).alias("tail")), joined)

    def joined(x: Column) -> Column:
        found = x["run"] < x["tail"]
        clip_to = F.when(x["cut"] > x["total"], x["total"]).when(found, x["cut"] + x["run"]).otherwise(x["total"] - 1)
        suffix = F.when((x["cut"] <= x["total"]) & found, F.lit("…")).otherwise(F.lit(""))
        return F.concat(sub(x["marked"], x["left"] + 1, clip_to - x["left"]), suffix)

    def whole(x: Column) -> Column:
        return F.when(x["t"].isNull() | x["qlen"].isNull() | (x["qlen"] == 0) | (x["start"] < 0), x["t"]).otherwise(clipped(x))

    t, q = col(text), col(query)
    start = F.call_function("instr", F.lower(t) if low is None else low, F.lower(q)) - 1
    return bind(F.struct(t.alias("t"), start.alias("start"), F.length(q).alias("qlen")), whole)
