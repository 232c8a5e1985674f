"""Folds over array columns that keep what they see on the way.

``aggregate`` hands on one state; a fold that also appends to an array copies
that array at every item, so it is quadratic. ``scan`` appends within chunks
and joins the chunks once, which stays linear for any array that fits a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names
    it, also inside of lambda functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scan(items: Column, zero: Column, step: Callable[[Column, Column], Column], kind: str, chunk: int = CHUNK) -> Column:
    """For every item the field ``out`` (of type ``kind``) of the state after
    it. ``zero`` is the state before the first; ``step(state, item)`` gives
    the next one, of the same struct type. NULL items give NULL."""
    none = F.array().cast(f"array<{kind}>")

    def one(acc: Column, item: Column) -> Column:
        return bind(step(acc["state"], item), lambda s: F.struct(s.alias("state"), F.concat(acc["out"], F.array(s["out"])).alias("out")))

    def part(acc: Column, some: Column) -> Column:
        folded = F.aggregate(some, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return bind(folded, lambda f: F.struct(f["state"].alias("state"), F.concat(acc["out"], F.array(f["out"])).alias("out")))

    def whole(all_: Column) -> Column:
        begin = F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(chunk))
        parts = F.transform(begin, lambda i: F.slice(all_, i, F.lit(chunk)))
        start = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.flatten(F.aggregate(parts, start, part)["out"])

    return bind(items, whole)
