"""Toxicity by cumulative-link ordinal regression (operator 2).

Severity grades 0 (clean) to GRADES - 1 are ordered; the model is
    P(grade >= k) = sigmoid(w . x - theta_k),   theta_1 < theta_2 < ...
One weight vector is shared by all thresholds. x holds log(1 + count) of
sparse text features: words, and runs of five letters inside the marked
word. Only features that tell toxic from clean labelled documents enter (by
the z-score of their log odds, the best FEATURES of them), so neutral text
of any length neither adds nor takes away.

Labels are binary; grades come from them: clean documents have grade 0, the
toxic ones are split about evenly into the other grades by the number of
their words that carry a feature of high toxic odds.

Training reads a bounded sample (``sample`` labelled rows are expected, drawn
by a hash of the key; labels of a key are merged, toxic if any says so): all
toxic rows up to half of it, or what the clean ones leave, and the rest from
the clean ones. Drawn rows weigh in the fit what they stand for. The
sample's feature counts are summed by Spark; the driver gets those of
features in LEAST_DOCS of its toxic documents and the sample's sparse
vectors, both bounded. Prediction reads every
whole text.

Null or empty text: no features, so the grade of a text without any. No
labels, or of one kind only: every text has grade 0 and severity 0.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 10_000
FEATURES = 4096
RUN = 5                     # letters of a run
LEAST_Z = 3.0               # of a chosen feature
MARK_ODDS = 2.0             # log odds of a feature that marks a word as toxic
GRADES = 4
LEAST_DOCS = 5              # documents that a feature must occur in
ROUNDS, RATE, RIDGE = 400, 0.1, 1e-5
KEPT = 600_000
WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """63-bit hashes of the features of a word."""
    marked = f"^{word}$"
    runs = {marked} | {marked[i:i + RUN] for i in range(len(marked) - RUN + 1)}
    return [xxhash.xxh3_64_intdigest(x) >> 1 for x in runs]


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def toxic_features(batches):
    """Task: texts of toxic documents to (feature, documents that have it)."""
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column(0).to_pylist():
            counts.update({f for w in set(words_of(text)) for f in word_features(w)})
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["feature", "n"])


def clean_counts(features):
    """Task: texts of clean documents to (feature, documents that have it),
    for the features asked for."""
    def run(batches):
        reader = Reader({f: f for f in features.value})
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                counts.update({f for x in reader.read(text) for f in x})
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["feature", "n"])

    return run


class Reader:
    """Counts of the chosen features in a text."""

    def __init__(self, features: dict[int, int]):
        self.features = features
        self.known: dict[str, tuple[int, ...]] = {}

    def ids(self, word: str) -> tuple[int, ...]:
        get = self.features.get
        return tuple(i for i in map(get, word_features(word)) if i is not None)

    def read(self, text: str | None) -> list[tuple[int, ...]]:
        """The features of each word that has any."""
        words, known = words_of(text), self.known
        if len(known) > KEPT:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = self.ids(w)
        return [x for x in map(known.__getitem__, words) if x]

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        counts = Counter(i for x in self.read(text) for i in x)
        return np.fromiter(counts, dtype=np.int64, count=len(counts)), np.log1p(np.fromiter(counts.values(), dtype=float, count=len(counts)))


def vectors(model):
    """Task: (toxic, text) to the sparse vectors of the sample."""
    def run(batches):
        features, marks = model.value
        reader, marks = Reader(features), set(marks)
        for batch in batches:
            ids, values, marked = [], [], []
            for text in batch.column(1).to_pylist():
                found = reader.read(text)
                i, x = reader.vector(text)
                ids.append(i.tolist())
                values.append(x.tolist())
                marked.append(sum(not marks.isdisjoint(f) for f in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64())),
                 pa.array(marked, pa.int64())], names=["toxic", "ids", "x", "marked"])

    return run


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_ordinal(ids: list, values: list, grade: np.ndarray, width: int, grades: int = GRADES, weight: np.ndarray | None = None,
                ridge: float = RIDGE):
    """Weights and thresholds of least penalised loss, by Adam. Thresholds
    are a first one and positive steps, so they stay in order. ``weight``: of
    the rows, all the same if not given."""
    part = np.full(len(ids), 1 / len(ids)) if weight is None else weight / weight.sum()
    size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    row = np.repeat(np.arange(len(ids)), size)
    col = np.concatenate([np.asarray(i, dtype=np.int64) for i in ids]) if len(row) else np.zeros(0, dtype=np.int64)
    x = np.concatenate([np.asarray(v) for v in values]) if len(row) else np.zeros(0)
    param = np.zeros(width + grades - 1)
    least = part[grade > 0].sum()
    param[width] = np.log((1 - least) / least) if 0 < least < 1 else 0.0     # so that a rare class is not far from the start
    first, second = np.zeros_like(param), np.zeros_like(param)
    for t in range(1, ROUNDS + 1):
        w, steps = param[:width], param[width:]
        theta = steps[0] + np.concatenate([[0.0], np.cumsum(np.exp(steps[1:]))])
        s = np.bincount(row, weights=x * w[col], minlength=len(ids))
        above = sigmoid(s[:, None] - theta[None, :])                        # P(grade >= 1 ...)
        edges = np.hstack([np.ones((len(ids), 1)), above, np.zeros((len(ids), 1))])
        slopes = edges * (1 - edges)
        rows = np.arange(len(ids))
        p = np.maximum(edges[rows, grade] - edges[rows, grade + 1], 1e-12)
        ds = -part * (slopes[rows, grade] - slopes[rows, grade + 1]) / p     # of the loss, by s
        dtheta = np.zeros(grades + 1)
        np.add.at(dtheta, grade, part * slopes[rows, grade] / p)
        np.add.at(dtheta, grade + 1, -part * slopes[rows, grade + 1] / p)
        dtheta = dtheta[1:grades]
        grad = np.empty_like(param)
        grad[:width] = np.bincount(col, weights=x * ds[row], minlength=width) + ridge * w
        grad[width] = dtheta.sum()
        grad[width + 1:] = np.cumsum(dtheta[::-1])[::-1][1:] * np.exp(steps[1:])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        param -= RATE * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    steps = param[width:]
    return param[:width], steps[0] + np.concatenate([[0.0], np.cumsum(np.exp(steps[1:]))])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE, grades: int = GRADES):
    """(features, weights, thresholds), or None without both kinds of labels."""
    sc = docs.sparkSession.sparkContext
    said = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("toxic")).dropna().groupBy("k").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in said.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    draw = F.conv(F.substring(F.md5(F.col("k").cast("string")), 1, 8), 16, 10).cast("double") / 2.0 ** 32
    size = min(n[1], max(sample / 2, sample - n[0]))
    part = {0: min(1.0, (sample - size) / n[0]), 1: size / n[1]}
    drawn = F.broadcast(said.filter(draw < F.when(F.col("toxic") == 1, part[1]).otherwise(part[0])))    # about ``sample`` rows of two numbers
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(drawn, "k").select("toxic", "text")

    def summed(df: DataFrame, task, least: int) -> dict[int, int]:
        found = df.select("text").mapInArrow(task, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
        return {r["feature"]: r["n"] for r in found.filter(F.col("n") >= least).collect()}

    toxic_docs = summed(rows.filter("toxic > 0"), toxic_features, LEAST_DOCS)
    clean_docs = summed(rows.filter("toxic = 0"), clean_counts(sc.broadcast(list(toxic_docs))), 1)
    scored = []
    for feature, a in toxic_docs.items():
        c = clean_docs.get(feature, 0)
        odds = np.log((a + 0.5) / (max(n[1] * part[1] - a, 0) + 0.5)) - np.log((c + 0.5) / (max(n[0] * part[0] - c, 0) + 0.5))
        scored.append((float(odds / np.sqrt(1 / (a + 0.5) + 1 / (c + 0.5))), feature, float(odds)))
    best = sorted((x for x in scored if x[0] >= LEAST_Z), reverse=True)[:FEATURES]
    features = {f: i for i, (_, f, _) in enumerate(best)}
    marks = [i for i, (_, _, odds) in enumerate(best) if odds > MARK_ODDS]

    made = rows.mapInArrow(vectors(sc.broadcast((features, marks))), "toxic int, ids array<long>, x array<double>, marked long").collect()
    toxic = np.array([r["toxic"] for r in made])
    marked = np.array([r["marked"] for r in made], dtype=float)
    if len(set(toxic.tolist())) < 2:
        return None
    cuts = np.quantile(marked[toxic == 1], [i / (grades - 1) for i in range(1, grades - 1)])
    grade = np.where(toxic == 1, 1 + np.searchsorted(cuts, marked, side="right"), 0)
    weight = np.where(toxic == 1, 1 / part[1], 1 / part[0])
    # the penalty follows the rows of least weight, or it would outweigh a rare class
    w, theta = fit_ordinal([r["ids"] for r in made], [r["x"] for r in made], grade, len(features), grades, weight,
                           RIDGE * weight.min() / weight.mean())
    return features, w, theta


def grader(model):
    def run(batches):
        features, w, theta = model.value
        reader = Reader(features)
        for batch in batches:
            s = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids, x = reader.vector(text)
                s[i] = x @ w[ids] if len(ids) else 0.0
            above = sigmoid(s[:, None] - theta[None, :])
            grade = (-np.diff(np.hstack([np.ones((len(s), 1)), above, np.zeros((len(s), 1))]), axis=1)).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, 0].copy()), pa.array(grade, pa.int64())],
                names=["key", "severity", "p_toxic", "grade"])

    return run


def severity(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, severity, p_toxic, grade) of every row: the expected grade, the
    chance of any toxic grade, and the likeliest grade. Nothing is shuffled."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if model is None:
        return rows.select(F.col("key").alias(key), F.lit(0.0).alias("severity"), F.lit(0.0).alias("p_toxic"), F.lit(0).cast("long").alias("grade"))
    kind = docs.schema[key].dataType.simpleString()
    made = rows.mapInArrow(grader(docs.sparkSession.sparkContext.broadcast(model)),
                           f"key {kind}, severity double, p_toxic double, grade long")
    return made.withColumnRenamed("key", key)
