"""Vector code compression by integer Walsh-Hadamard transforms (operator 12).

Vectors become integers, floor(1024 x), and are cut into equal parts; every
part position has a codebook of up to 256 entries that rounds of nearest
assignment and floored means refine. The code of a vector is its nearest
entry's number for each part.

Nearest entries are found without floating point: parts and entries are
padded with zeros to a power of two P and transformed by the Walsh-Hadamard
matrix, which multiplies every squared distance by exactly P. The scaled
squared differences are summed coefficient by coefficient in sequency order
(fewest sign changes first, where most of a smooth part lies). Every few
coefficients the entry that leads is measured to its end; an entry whose
partial sum already exceeds that bound is out, since the sum only grows. Once
few entries are left they go on alone, each until it exceeds the bound as
well. Ties go to the lower number.

Scale: rows never meet. A round is one pass over the staged integer vectors;
each task adds up its own parts, so at most 256 rows a part and task are
shuffled, and the driver gets the codebooks only (256 x dimension integers).
Sums of a label are formed before the shuffle.

Defined cases: vectors that are null, empty or hold null or non-finite
components are dropped. The length of the kept vector with the smallest key
holds; vectors of another length cannot be cut alike and are dropped as well.
A length that the parts do not divide is filled up with zeros. Null keys come
last, equal keys by their components; fewer vectors than entries give smaller
codebooks, no vectors no rows. Components of 2**30 / P or more after scaling
(65,536 before it, for P = 16) raise an error: their squares would leave 64
bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.staging import staged

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
ROOM = 1 << 30                  # of P times a component, so that P times a squared distance stays below 2**63
STEP = 4                        # coefficients between two looks at the bounds
FEW = 1 / 16                    # share of entries left from which each goes on by itself
BLOCK = 256                     # rows compared at a time
BROADCAST_LABELS = 200_000


def sequency(size: int) -> np.ndarray:
    """Natural Hadamard positions in order of sign changes of their rows."""
    rows = np.array([[bin(i & j).count("1") & 1 for j in range(size)] for i in range(size)])
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def padded(size: int) -> int:
    return 1 << max(size - 1, 0).bit_length()


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows of ``x`` (padded to a power of
    two), coefficients in sequency order; integers throughout."""
    size = padded(x.shape[1])
    out = np.zeros((len(x), size), dtype=np.int64)
    out[:, :x.shape[1]] = x
    step = 1
    while step < size:
        pairs = out.reshape(len(x), size // (2 * step), 2, step)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(x), size)
        step *= 2
    return out[:, sequency(size)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest of the transformed
    ``entries`` for each transformed row; both scaled alike."""
    size = x.shape[1]
    number, scaled = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    columns = np.ascontiguousarray(entries.T)
    for begin in range(0, len(x), BLOCK):
        part = x[begin:begin + BLOCK]
        total = np.zeros((len(part), len(entries)), dtype=np.int64)
        for done in range(min(STEP, size), size + STEP, STEP):
            for k in range(done - STEP if done > STEP else 0, min(done, size)):
                away = part[:, k, None] - columns[k]
                away *= away
                total += away
            lead = total.argmin(axis=1)
            bound = total[np.arange(len(part)), lead] + ((part[:, done:] - entries[lead, done:]) ** 2).sum(axis=1)
            alive = total <= bound[:, None]
            if done >= size or np.count_nonzero(alive) <= FEW * alive.size:
                break
        row, entry = np.nonzero(alive)
        total = total[row, entry]
        for k in range(done, size):             # the few that are left, one by one
            total += (part[row, k] - entries[entry, k]) ** 2
            alive = total <= bound[row]
            row, entry, total = row[alive], entry[alive], total[alive]
        first = np.flatnonzero(np.diff(row, prepend=-1))        # rows ascend, entries ascend within a row
        least = np.minimum.reduceat(total, first)
        at = np.flatnonzero(total == np.repeat(least, np.diff(first, append=len(row))))
        at = at[np.flatnonzero(np.diff(row[at], prepend=-1))]
        number[begin:begin + BLOCK], scaled[begin:begin + BLOCK] = entry[at], least
    return number, scaled // size


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """A column of equally long integer lists as rows of a matrix."""
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), width)


def assigner(codebooks: list[np.ndarray], width: int):
    """Batch of vectors to [(number, distance, part rows)] for each part."""
    books = [transform(b) for b in codebooks]

    def run(column: pa.Array):
        x = matrix_of(column, width)
        per = width // len(books)
        for p, book in enumerate(books):
            part = x[:, p * per:(p + 1) * per]
            yield (*nearest(transform(part), book), part)

    return run


def summing(codebooks: list[np.ndarray], width: int):
    """Task: vectors to (part, entry, n, sums) over the whole task."""
    def run(batches):
        assign = assigner(codebooks, width)
        n = [np.zeros(len(b), dtype=np.int64) for b in codebooks]
        sums = [np.zeros(b.shape, dtype=np.int64) for b in codebooks]
        for batch in batches:
            for p, (number, _, part) in enumerate(assign(batch.column("q"))):
                order = np.argsort(number, kind="stable")
                first = np.flatnonzero(np.diff(number[order], prepend=-1))
                if len(first):
                    used = number[order][first]
                    n[p][used] += np.diff(first, append=len(order))
                    sums[p][used] += np.add.reduceat(part[order], first, axis=0)
        for p in range(len(codebooks)):
            used = np.flatnonzero(n[p])
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array(np.full(len(used), p), pa.int32()), "entry": pa.array(used, pa.int32()), "n": pa.array(n[p][used], pa.int64()),
                 "sums": pa.array(list(sums[p][used]), pa.list_(pa.int64()))})

    return run


def coding(codebooks: list[np.ndarray], width: int):
    """Task: vectors to (key, label, code, error)."""
    def run(batches):
        assign = assigner(codebooks, width)
        for batch in batches:
            code, error = [""] * batch.num_rows, np.zeros(batch.num_rows, dtype=np.int64)
            for number, distance, _ in assign(batch.column("q")):
                code = [c + f"{i:02x}" for c, i in zip(code, number.tolist(), strict=True)]
                error += distance
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)],
                                             names=["key", "label", "code", "error"])

    return run


def quantised(vectors: DataFrame, key: str, vector: str, label: str, parts: int) -> tuple[DataFrame, int]:
    """Staged (key, label, q) of the kept vectors, and their padded length."""
    x = F.col(vector).cast("array<double>")
    usable = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    q = F.transform(x, lambda v: F.floor(v * SCALE).cast("long"))
    kept = vectors.filter(usable).select(F.col(key).alias("key"), F.col(label).alias("label"), q.alias("q"))
    first = kept.orderBy(F.col("key").asc_nulls_last(), "q").select(F.size("q").alias("n")).first()
    size = first["n"] if first else 0
    width = -(-size // parts) * parts
    kept = kept.filter(F.size("q") == size)
    if width > size:
        kept = kept.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("long"), width - size)))
    return staged(kept, "vectors"), width


def train(kept: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after ``rounds`` rounds over all of the staged vectors."""
    first = kept.orderBy(F.col("key").asc_nulls_last(), "q").limit(entries).select("q").collect()
    if not first:
        return [np.zeros((0, 0), dtype=np.int64) for _ in range(parts)]
    per = width // parts
    limit = ROOM // padded(per)
    if kept.filter(F.exists("q", lambda v: (v >= limit) | (v <= -limit))).take(1):
        raise ValueError(f"components of {limit} or more after scaling leave no room for exact squares")
    start = np.array([r["q"] for r in first], dtype=np.int64)
    books = [start[:, p * per:(p + 1) * per].copy() for p in range(parts)]
    for _ in range(rounds):
        made = kept.select("q").mapInArrow(summing(books, width), "part int, entry int, n long, sums array<long>")
        made = made.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(per)]).alias("sums"))
        for r in made.collect():            # at most parts * entries rows
            books[r["part"]][r["entry"]] = [s // r["n"] for s in r["sums"]]
    return books


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimals by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def encode(kept: DataFrame, books: list[np.ndarray], width: int, kind: str, label_kind: str) -> DataFrame:
    """(key, label, code, error) of the staged vectors."""
    return kept.mapInArrow(coding(books, width), f"key {kind}, label {label_kind}, code string, error long")


def decode(codes: list[str], books: list[np.ndarray]) -> np.ndarray:
    """The vectors (scaled integers) that codes stand for."""
    return np.array([np.concatenate([b[int(c[2 * p:2 * p + 2], 16)] for p, b in enumerate(books)]) for c in codes])


def vector_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, label, code, error, label_error, codebooks_sha256) of every kept
    vector; label_error adds up the errors of equal labels, nulls together."""
    kept, width = quantised(vectors, key, vector, label, PARTS)
    books = train(kept, width)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    coded = staged(encode(kept, books, width, kinds["key"], kinds["label"]), "codes")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    totals = staged(totals, "label errors")
    totals = F.broadcast(totals) if totals.count() <= BROADCAST_LABELS else totals
    out = coded.join(totals, coded["label"].eqNullSafe(totals["_label"]))
    return out.select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", "label_error",
                      F.lit(books_digest(books)).alias("codebooks_sha256"))
