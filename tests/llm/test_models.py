"""Language ID and toxicity on labelled texts."""

import numpy as np
from pyspark.sql import functions as F

from sitelens.llm import langid, toxicity


def test_language_id_on_rows_not_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(docs, langid.fit(docs)).select("row.*", "lang_pred", "score", "shares").collect()
    kept = [r for r in out if __import__("zlib").crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(out) == docs.count() and len(kept) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in kept]) >= 0.97
    assert all(0 <= r["score"] <= 1 and abs(sum(x["share"] for x in r["shares"]) - 1) < 1e-6 for r in out)


def counts_of(texts):
    from collections import Counter
    out = Counter()
    for lang, text in texts:
        for w in langid.words_of(text):
            out.update((lang, g) for g in langid.trigrams(w))
    return [(lang, g, n) for (lang, g), n in out.items()]


EN, FR, DE = "the quick brown fox jumps over that lazy dog with them ", "le renard brun saute par dessus un chien avec eux ", "der schnelle braune fuchs springt über einen hund mit ihnen "


def test_mixtures_are_estimated():
    model = langid.Model(counts_of([("en", EN), ("fr", FR), ("de", DE)]))
    out = langid.predict([EN * 3, FR * 6 + EN * 3, "", None, "12 !", "²½", DE], model)
    assert out[0][0] == "en" and [x for x, _ in out[0][2]] == ["en"]
    assert out[1][0] == "fr" and [x for x, _ in out[1][2]] == ["fr", "en"] and abs(out[1][2][0][1] - 2 / 3) < 0.1
    assert [x[:2] for x in out[2:6]] == [("und", 0.0)] * 4 and out[6][0] == "de"
    assert langid.predict([EN, None], langid.Model(counts_of([("en", EN)])))[0][0] == "en"


def test_likelihood_rises_with_every_round():
    model = langid.Model(counts_of([("en", EN), ("fr", FR), ("de", DE)]))
    words = langid.words_of(EN + FR + FR)
    like, n = model.likelihoods(words), np.array([len(words)])
    share, before = np.full((1, 3), 1 / 3), -np.inf
    for _ in range(8):
        share, log = langid.em(like, np.array([0]), np.zeros(len(words), dtype=int), share, n, 1)
        assert log[0] >= before - 1e-9
        before = log[0]


def test_language_id_odd_rows(make, odd):
    docs = make([*odd, (20, EN), (21, EN)])         # 20 is held out, 21 is learned from
    counts = langid.fit(docs)
    out = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, counts).select("row.*", "lang_pred").collect()}
    assert out[1] == out[2] == out[3] == "und" and out[20] == "en"
    kept = langid.keep_identified(docs, counts)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k, _ in odd if k not in (1, 2, 3)} | {20, 21}
    assert langid.fit(docs.withColumn("lang", F.lit(None).cast("string"))) == []
    assert {r["doc_id"] for r in langid.keep_identified(docs, []).collect()} == {k for k, _ in odd if k not in (1, 2, 3)} | {20, 21}
    assert langid.identify(docs.limit(0), counts).count() == 0


def test_texts_in_no_learned_language_are_rejected(spark, make):
    """Other scripts and random letters go; clean rows, short ones, mixtures
    and rows that no learning may read stay."""
    rnd = np.random.default_rng(3)
    noise = " ".join("".join(map(chr, rnd.integers(97, 123, 7))) for _ in range(200))
    greek, russian = "το γρήγορο καφέ αλεπού πηδάει πάνω από το σκυλί " * 5, "быстрая коричневая лиса прыгает через собаку " * 5
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = langid.fit(known)
    docs = make([(1, greek), (2, russian), (3, noise), (4, "xq zj"), (5, EN), (6, FR + EN), (7, None), (8, "123 !")])
    assert {r["doc_id"] for r in langid.keep_identified(docs, counts).collect()} == {4, 5, 6}
    lettered = known.filter(F.col("text").rlike(r"\p{L}"))
    assert langid.keep_identified(lettered, counts).count() >= 0.999 * lettered.count()
    unlabelled = known.withColumn("lang", F.lit(None).cast("string"))
    assert langid.keep_identified(unlabelled, langid.fit(unlabelled)).count() == lettered.count()


def test_toxicity_on_rows_not_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels.filter("doc_id % 4 <> 0"))
    assert (np.diff(model[2]) > 0).all()
    held = docs.join(F.broadcast(labels.filter("doc_id % 4 = 0")), "doc_id")
    rows = toxicity.severity(held, model).join(held.select("doc_id", "toxic"), "doc_id").collect()
    said, true = np.array([r["p_toxic"] >= 0.5 for r in rows]), np.array([r["toxic"] == 1 for r in rows])
    assert said[true].mean() >= 0.95 and said[~true].mean() <= 0.01
    severity = np.array([r["severity"] for r in rows])
    assert ((severity >= 0) & (severity <= toxicity.GRADES - 1)).all() and severity[true].mean() > severity[~true].mean() + 1


def test_ordinal_fit_recovers_order():
    rnd = np.random.default_rng(4)
    x = rnd.integers(0, 6, 600)
    grade = np.minimum(3, x // 2 + (rnd.random(600) < 0.1))
    ids = [[0] if v else [] for v in x]
    w, theta = toxicity.fit_ordinal(ids, [[float(v)] if v else [] for v in x], grade, 1)
    assert w[0] > 0 and (np.diff(theta) > 0).all()
    expected = toxicity.sigmoid(np.arange(6)[:, None] * w[0] - theta).sum(axis=1)
    assert (np.diff(expected) > 0).all() and abs(expected[5] - 2.1) < 0.6


def test_toxicity_odd_rows(make, odd, spark):
    docs = make(odd)
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 0), (4, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.severity(docs, toxicity.fit(docs, labels)).collect()
    assert len(out) == len(odd) and all(0 <= r["severity"] <= 3 for r in out)
    none = toxicity.fit(docs, labels.limit(0))
    assert none is None and toxicity.severity(docs, none).filter("severity > 0").count() == 0
    assert toxicity.severity(docs.limit(0), none).count() == 0


def test_rare_toxic_class_stays_in_the_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    learned = labels.filter("doc_id % 4 <> 0")
    rare = learned.filter("toxic = 0").union(learned.filter("toxic = 1").orderBy(F.xxhash64("doc_id")).limit(50))
    model = toxicity.fit(docs, rare, sample=200)        # without regard to class, 4 toxic rows in it
    assert model is not None and len(model[0]) > 20
    held = docs.join(F.broadcast(labels.filter("doc_id % 4 = 0")), "doc_id")
    rows = toxicity.severity(held, model).join(held.select("doc_id", "toxic"), "doc_id").collect()
    said, true = np.array([r["p_toxic"] >= 0.5 for r in rows]), np.array([r["toxic"] == 1 for r in rows])
    assert said[true].mean() >= 0.6 and said[~true].mean() <= 0.03


def test_weighted_rows_count_as_often_as_they_weigh():
    rnd = np.random.default_rng(2)
    x, grade = rnd.integers(1, 5, 40), rnd.integers(0, 4, 40)
    times = np.where(grade > 0, 1, 3)
    rows = lambda v: ([[0]] * len(v), [[float(i)] for i in v])
    w, theta = toxicity.fit_ordinal(*rows(x), grade, 1, weight=times.astype(float))
    again, theta2 = toxicity.fit_ordinal(*rows(np.repeat(x, times)), np.repeat(grade, times), 1)
    assert np.allclose(w, again) and np.allclose(theta, theta2)
