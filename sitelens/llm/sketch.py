"""Document fingerprints (operator 8): bottom-k sketches of shingle hashes.

A text's shingles are its runs of five words (a text of fewer words, but not
none, is one shingle); its sketch is the k smallest distinct 48-bit shingle
hashes. Sketches of parts merge into the sketch of the whole set, and two
sketches estimate resemblance, containment and distinct shingles; below k
shingles all of these are exact. Equal texts have equal sketches.

A null text counts as empty; an empty text has an empty sketch, which
resembles an empty one (1) and no other (0).
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
WORDS = 5
SPACE = 1 << 48
STEP = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
ROWS_A_RANGE, MOST_RANGES = 32, 16_000


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """48-bit hashes of the runs of ``words`` words, A-Z lower-cased."""
    split = text.encode().lower().split()
    if not split:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, split), dtype=np.uint64, count=len(split))
    size = min(words, len(split))
    with np.errstate(over="ignore"):
        mixed = np.full(len(hashed) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            mixed = mixed * np.uint64(STEP[0]) + hashed[i:len(hashed) - size + 1 + i]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(STEP[1])
    return (mixed ^ (mixed >> np.uint64(32))) >> np.uint64(16)


def bottom(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes, ascending."""
    if len(hashes) > 4 * k:
        near = np.unique(np.partition(hashes, 2 * k)[:2 * k + 1])
        if len(near) >= k:
            return near[:k]
    return np.unique(hashes)[:k]


def sketch(text: str, k: int = K) -> np.ndarray:
    return bottom(shingle_hashes(text), k)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of two sets together."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated intersection over union."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge(a, b, k)
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(both))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * SPACE / (float(a[k - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first set that lies in the second."""
    if not len(a):
        return 1.0
    like = resemblance(a, b, k)
    return min(1.0, like / (1 + like) * (distinct(a, k) + distinct(b, k)) / distinct(a, k))


def spelt(a: np.ndarray) -> str:
    """Six bytes a hash, ascending, in base 64."""
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    six = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, 6)
    return np.hstack([np.zeros((len(six), 2), dtype=np.uint8), six]).copy().view(">u8").ravel().astype(np.uint64)


def fingerprinter(k: int):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([spelt(sketch(t or "", k)) for t in batch.column(1).to_pylist()], pa.string())],
                names=["key", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """(key, fingerprint) of every row; nothing is shuffled."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(fingerprinter(k), f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def merging(k: int):
    """Task: (group, fingerprint) to the merged fingerprint of every group in
    a batch."""
    def run(batches):
        for batch in batches:
            found: dict = {}
            for group, print_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = read(print_ or "")
                found[group] = merge(found[group], own, k) if group in found else own[:k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), batch.schema.field(0).type), pa.array([spelt(v) for v in found.values()], pa.string())],
                names=["group", "fingerprint"])

    return run


def merged_group(k: int):
    def run(table: pa.Table) -> pa.Table:
        out = np.zeros(0, dtype=np.uint64)
        for print_ in table.column("fingerprint").to_pylist():
            out = merge(out, read(print_), k)
        return pa.table({"group": table.column("group")[:1], "fingerprint": pa.array([spelt(out)], pa.string()),
                         "n_distinct": pa.array([distinct(out, k)], pa.float64())})

    return run


def merged_fingerprints(prints: DataFrame, by: str, fingerprint: str = "fingerprint", k: int = K, parts: int = 64) -> DataFrame:
    """(by, fingerprint, n_distinct) of every group of ``prints``: the sketch
    of all its texts together and their estimated number of distinct
    shingles. Sketches merge within batches first, then in ``parts`` parts of
    a group, so a group with most rows is no single task's; null is a group."""
    kind = prints.schema[by].dataType.simpleString()
    rows = prints.select(F.col(by).alias("group"), F.col(fingerprint).alias("fingerprint"))
    rows = rows.mapInArrow(merging(k), f"group {kind}, fingerprint string")
    merged = f"group {kind}, fingerprint string, n_distinct double"
    rows = rows.groupBy("group", F.pmod(F.xxhash64("fingerprint"), F.lit(parts))).applyInArrow(merged_part(k), merged)
    return rows.groupBy("group").applyInArrow(merged_group(k), merged).withColumnRenamed("group", by)


def merged_part(k: int):
    """As ``merged_group``, of a part of a group (its key has two columns)."""
    whole = merged_group(k)
    return lambda _, table: whole(table)


def range_of(c: Column, bounds: list) -> Column:
    """Number of bounds below the value, by two short searches: which stretch
    of bounds, then where in it. Null: 0."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    every = F.lit([int(x) for x in bounds])
    coarse = F.lit([int(x) for x in bounds[step - 1::step]] or [int(bounds[-1])])
    stretch = F.size(F.filter(coarse, lambda b: b < c))
    return F.aggregate(F.array(stretch), F.lit(0), lambda _, s: s * step + F.size(
        F.filter(F.slice(every, s * step + 1, step), lambda b: b < c)))


def with_next(rows: DataFrame) -> DataFrame:
    """``rows`` (key, text) dealt into ranges of the key, each sorted by key
    descending and closed by a copy of the first row of the range that
    follows (after the last: of the first): (range, key, text, closing).

    Only that one copy of every row moves. The bounds, at most MOST_RANGES
    numbers, and the first key of each range are all the driver or a
    broadcast holds."""
    stats = rows.agg(F.count(F.lit(1)).alias("n")).first()
    ranges = max(1, min(MOST_RANGES, stats["n"] // ROWS_A_RANGE))
    wanted = [i / ranges for i in range(1, ranges)]
    bounds = []
    if wanted:
        found = rows.agg(F.percentile_approx("key", F.lit(wanted), 4 * ranges).alias("b")).first()["b"] or []
        bounds = sorted(set(found))
    placed = rows.withColumn("range", range_of(F.col("key"), bounds)).withColumn("closing", F.lit(False))
    firsts = placed.groupBy("range").agg(F.max("key").alias("first"))
    down = Window.orderBy(F.col("range").desc())
    follows = firsts.select(F.col("range").alias("closes"), F.coalesce(
        F.lead(F.struct("first")).over(down),
        F.first(F.struct("first")).over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("f"))
    follows = F.broadcast(follows.select("closes", F.col("f.first").alias("first")))       # MOST_RANGES rows at most
    copies = rows.join(follows, rows["key"].eqNullSafe(follows["first"]))
    copies = copies.groupBy("closes", "first").agg(F.min(F.struct(F.col("text").isNotNull().alias("has"), "text")).alias("t"))
    closing = copies.select(F.col("first").alias("key"), F.col("t.text").alias("text"), F.col("closes").alias("range"),
                            F.lit(True).alias("closing"))
    dealt = placed.select("range", "key", "text", "closing").unionByName(closing).repartition("range")
    return dealt.sortWithinPartitions("range", "closing", F.col("key").desc_nulls_last(), F.col("text").asc_nulls_first())


def editor(k: int):
    """Pairs each row with the one after it, batch by batch: only one row is
    carried over."""
    def run(batches):
        last = None                                     # key, text and sketch of the row before
        for batch in batches:
            out = {n: [] for n in EDITED}
            keys, closing = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            for key, text, ends in zip(keys, batch.column(2).to_pylist(), closing, strict=True):
                text = text or ""
                own = sketch(text, k)
                if last:
                    before, body, print_ = last
                    n = len(body)
                    edited = body[:n - n // 2] + text[:n // 2]
                    other = sketch(edited, k)
                    for name, value in zip(EDITED, (
                            before, n, hashlib.sha256(edited.encode()).hexdigest(), spelt(print_), spelt(other),
                            resemblance(print_, other, k), resemblance(print_, own, k), distinct(print_, k),
                            containment(print_, other, k)), strict=True):
                        out[name].append(value)
                last = None if ends else (key, text, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[n], t) for n, t in zip(EDITED, (batch.schema.field(1).type, *ARROW), strict=True)],
                names=list(EDITED))

    return run


EDITED = ("key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
          "n_distinct", "kept_in_edited")
ARROW = pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of every row's text, of its edited text (the last half
    replaced by the beginning of the next row's, by descending key; rows of
    one key by their text) and how alike the row's fingerprint is to the edited
    text's and to the next row's; the estimated number of distinct shingles
    and the share of them that the edited text keeps. ``key`` is a whole
    number; null keys last."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    kinds = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_distinct double, kept_in_edited double"
    return with_next(rows).mapInArrow(editor(k), kinds).withColumnRenamed("key", key)
