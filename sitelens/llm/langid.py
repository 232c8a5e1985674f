"""Language identification by multilingual mixture inference (operator 7).

Each learned language is a character trigram model of words. A document is a
mixture: every word belongs to one language, drawn with the document's
language proportions. Expectation-maximisation estimates the proportions
from the words' n-gram likelihoods; the languages then enter in the order of
their share, and the set of languages with the best likelihood, less half a
logarithm of the number of words for each language after the first, is kept.

Training: a bounded sample of labelled rows (``sample`` of them are expected,
drawn by a hash of the key; a rare language keeps all of its rows up to an
equal part of the sample). Trigram counts are summed by Spark; the model on
the driver holds the counts of the sample only. Prediction reads every whole
text; label, source and key are no inputs of it.

Null text, or one without a letter: language ``und``, score 0, no shares.
Repeated rows are predicted alike. No labelled rows: everything is ``und``.

Whether a text is in one of the learned languages at all (``fits``) is a
matter of its likelihood as well: each word in its best language, against
letters drawn at random from those that were seen. A text of at least
LEAST_GRAMS trigrams that random letters explain as well is in none of them.
Shorter texts say too little and fit; so does every text with a letter where
nothing was learned.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm.staging import bounded_batches

SAMPLE = 20_000
ALPHA = 0.05                # added to every trigram count
ROUNDS, FEWER = 10, 4       # iterations with all languages, and with each smaller set
WORDS_AT_ONCE = 200_000
KEPT = 300_000
UND = "und"
LEAST_GRAMS, MARGIN = 30, 0.05
WORD = re.compile(r"[^\W\d_]+")
BEGIN, END = "\x02", "\x03"


def held_out(key: Column) -> Column:
    """Rows that no learning may read: CRC-32 of the key as text, mod 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def trigrams(word: str):
    padded = BEGIN + BEGIN + word + END
    return [padded[i:i + 3] for i in range(len(padded) - 2)]


def trigram_counts(batches):
    """Task: (lang, text) to (lang, trigram, count), summed by batch."""
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words.setdefault(lang, Counter()).update(words_of(text))
        for lang, found in words.items():
            grams: Counter = Counter()
            for word, n in found.items():
                for g in trigrams(word):
                    grams[g] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams)), pa.array(list(grams)), pa.array(list(grams.values()), pa.int64())],
                names=["lang", "gram", "n"])


class Model:
    """Logarithms of trigram probabilities in each language."""

    def __init__(self, counts: list[tuple[str, str, int]]):
        self.languages = sorted({lang for lang, _, _ in counts})
        place = {x: i for i, x in enumerate(self.languages)}
        letters = len({g[2] for _, g, _ in counts}) + 1
        k = len(self.languages)
        seen: dict[str, np.ndarray] = {}
        context: dict[str, np.ndarray] = {}
        for lang, gram, n in counts:
            seen.setdefault(gram, np.zeros(k))[place[lang]] += n
            context.setdefault(gram[:2], np.zeros(k))[place[lang]] += n
        base = {c: np.log(v + ALPHA * letters) for c, v in context.items()}
        rows = [np.full(k, -np.log(letters))]            # first: a context never seen
        self.grams: dict[str, int] = {}                  # trigram, or context of an unseen one, to its row
        for c, v in base.items():
            self.grams[c] = len(rows)
            rows.append(np.log(ALPHA) - v)
        for g, v in seen.items():
            self.grams[g] = len(rows)
            rows.append(np.log(v + ALPHA) - base[g[:2]])
        self.table = np.stack(rows)
        self.random = -np.log(letters)                   # of a trigram of random letters
        self.forget()

    def forget(self):
        self.ids: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.languages)))
        self.gain = np.zeros((1024, 2))                  # best likelihood over random letters, trigrams

    def learn(self, words: list[str]):
        """Likelihoods of new words: the product over their trigrams, over
        the best language's (the ratio is all that proportions need)."""
        grams = [trigrams(w) for w in words]
        get = self.grams.get
        ids = [get(g) or get(g[:2], 0) for word in grams for g in word]
        starts = np.concatenate([[0], np.cumsum([len(g) for g in grams])[:-1]]).astype(np.int64)
        log = np.add.reduceat(self.table[ids], starts, axis=0)
        first, upto = len(self.ids), len(self.ids) + len(words)
        if upto > len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros((max(upto, len(self.rows)), log.shape[1]))])
            self.gain = np.vstack([self.gain, np.zeros((max(upto, len(self.gain)), 2))])
        self.rows[first:upto] = np.exp(log - log.max(axis=1, keepdims=True))
        n = np.array([len(g) for g in grams])
        self.gain[first:upto] = np.stack([log.max(axis=1) - n * self.random, n], axis=1)
        self.ids.update(zip(words, range(first, upto), strict=True))

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """One row a word."""
        return self.rows[self.places(words)]

    def places(self, words: list[str]) -> list[int]:
        if len(self.ids) > KEPT:
            self.forget()
        found = list(map(self.ids.get, words))
        if None in found:
            missing = [i for i, at in enumerate(found) if at is None]
            self.learn(list({words[i] for i in missing}))
            for i in missing:
                found[i] = self.ids[words[i]]
        return found


def em(like: np.ndarray, starts: np.ndarray, owner: np.ndarray, share: np.ndarray, n: np.ndarray, rounds: int):
    """Shares of the languages in each document, and the logarithm of its
    likelihood (over the words' best)."""
    for _ in range(rounds):
        joint = like * share[owner]
        joint /= joint.sum(axis=1, keepdims=True) + 1e-300
        share = np.add.reduceat(joint, starts, axis=0) / n[:, None]
    total = np.log((like * share[owner]).sum(axis=1) + 1e-300)
    return share, np.add.reduceat(total, starts)


def mixtures(like: np.ndarray, sizes: np.ndarray):
    """For documents of ``sizes`` words each: the shares with all languages,
    and those of the chosen set."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    k = like.shape[1]
    full, _ = em(like, starts, owner, np.full((len(sizes), k), 1.0 / k), sizes, ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    ranked = np.take_along_axis(like, order[owner], axis=1)
    share = np.take_along_axis(full, order, axis=1)
    best = np.full(len(sizes), -np.inf)
    chosen = np.zeros_like(share)
    for m in range(1, k + 1):
        first = share[:, :m] / share[:, :m].sum(axis=1, keepdims=True)
        fit, log = em(ranked[:, :m], starts, owner, first, sizes, FEWER if m > 1 else 0)
        gain = log - 0.5 * (m - 1) * np.log(sizes)
        better = gain > best + 1e-9
        best[better] = gain[better]
        chosen[better] = 0
        chosen[np.ix_(better, range(m))] = fit[better]
    out = np.zeros_like(chosen)
    np.put_along_axis(out, order, chosen, axis=1)
    return full, out


def predict(texts: list[str], model: Model) -> list[tuple[str, float, list, bool]]:
    """(language, score, [(language, share) of the chosen set], fits) of each text."""
    out: list = [(UND, 0.0, [], False)] * len(texts)
    if not model.languages:
        return [(UND, 0.0, [], any(map(str.isalpha, t or ""))) for t in texts]
    names, k = model.languages, len(model.languages)
    some, words, sizes, i = [], [], [], 0
    while i <= len(texts):
        if i < len(texts):
            found = words_of(texts[i]) if texts[i] else []
            if found and any(map(str.isalpha, found)):
                some.append(i)
                words += found
                sizes.append(len(found))
        i += 1
        if sizes and (len(words) >= WORDS_AT_ONCE or i > len(texts)):
            n = np.asarray(sizes)
            at = model.places(words)
            full, chosen = mixtures(model.rows[at], n)
            gain = np.add.reduceat(model.gain[at], np.cumsum(n) - n, axis=0)
            fits = (gain[:, 0] > MARGIN * gain[:, 1]) | (gain[:, 1] < LEAST_GRAMS)
            top = chosen.argmax(axis=1)
            score = (np.take_along_axis(full, top[:, None], axis=1)[:, 0] * n + 1) / (n + k)
            for j, row in enumerate(some):
                share = [(names[x], float(chosen[j, x])) for x in np.flatnonzero(chosen[j] > 0)]
                out[row] = (names[top[j]], float(min(1.0, score[j])), sorted(share, key=lambda x: (-x[1], x[0])), bool(fits[j]))
            some, words, sizes = [], [], []
    return out


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> list[tuple]:
    """Trigram counts of a bounded sample of the rows that may be learned from."""
    bounded_batches(docs.sparkSession)
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key)))
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "lang").limit(sample).collect()}
    if not sizes:
        return []
    each = max(1, sample // len(sizes))
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col("key").cast("string"), F.lit("null"))), 1, 8), 16, 10).cast("double") / 2.0 ** 32
    part = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, each / n))])
    drawn = rows.filter(draw < F.coalesce(F.element_at(part, F.col("lang")), F.lit(0.0))).select("lang", "text")
    counts = drawn.mapInArrow(trigram_counts, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return [(r["lang"], r["gram"], r["n"]) for r in counts.collect()]


def identifier(counts, text: str):
    def run(batches):
        model = Model(counts.value)
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            found = predict(pc.struct_field(batch.column(0), text).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found]), pa.array([x[1] for x in found], pa.float64()),
                 pa.array([[{"lang": a, "share": b} for a, b in x[2]] for x in found], kind), pa.array([x[3] for x in found], pa.bool_())],
                names=["row", "lang_pred", "score", "shares", "fits"])

    return run


PREDICTED = "lang_pred string, score double, shares array<struct<lang:string,share:double>>, fits boolean"


def identify(docs: DataFrame, counts: list[tuple], text: str = "text") -> DataFrame:
    """Every row of ``docs`` as a struct ``row``, with lang_pred, score and
    the shares of the chosen languages, and whether they fit. The model is broadcast: it holds the
    trigrams of the bounded sample only. Nothing is shuffled."""
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(counts)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return rows.mapInArrow(identifier(model, text), f"row {rows.schema['row'].dataType.simpleString()}, {PREDICTED}")


def keep_identified(docs: DataFrame, counts: list[tuple], text: str = "text") -> DataFrame:
    """``docs`` without the rows that are in none of the learned languages:
    null texts, texts without a letter, and texts that random letters explain
    as well. All columns stay as they are. Where nothing was learned only the
    first two go."""
    return identify(docs, counts, text).filter("fits").select("row.*")
