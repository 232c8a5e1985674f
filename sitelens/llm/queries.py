"""Registered queries of the subpackage: name -> (query, oracle SQL or None).

Each query runs its operator over the whole table with production
parameters and derives the columns of its contract from the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import decontam, jaccard, langid, mixing, pii, secrets, sketch, sql, tokens, toxicity, trie, urls, vectors, warc

REGISTRY: dict[str, tuple] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


@register("op1_secret_scan")
def op1(spark: SparkSession, d: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, d, "documents").select("doc_id", "text"))
    spelt = lambda kinds: F.array_join(F.transform(
        F.filter("spans", lambda x: x["kind"].isin(list(kinds))),
        lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda *kinds: F.size(F.filter("spans", lambda x: x["kind"].isin(list(kinds)))).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        sha256_hex(spelt(secrets.KINDS[:3])).alias("base_sha256"), spelt(secrets.KINDS).alias("spans"),
        count(*secrets.KINDS[3:]).alias("n_validated"))


@register("op2_toxicity")
def op2(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, d, "labels"))
    out = toxicity.severity(docs, model)
    return out.select("doc_id", "severity", "p_toxic", "grade", (F.col("p_toxic") >= 0.5).alias("toxic"))


@register("op3_decontamination", sql.DECONTAMINATION)
def op3(spark: SparkSession, d: str) -> DataFrame:
    out = decontam.decontaminate(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      sha256_hex(F.array_join("items", ",")).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


#: Key of the pseudonyms; a deployment sets its own.
PII_SECRET = "sitelens-pseudonyms"


@register("op4_pii_pseudonyms")
def op4(spark: SparkSession, d: str) -> DataFrame:
    out = pii.pseudonymise(table(spark, d, "documents").select("doc_id", "text"), PII_SECRET, found="kinds")
    count = lambda k: F.size(F.filter("kinds", lambda x: x == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"), *[count(k) for k in pii.KINDS])


@register("op5_token_counts")
def op5(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, d, "documents").select("doc_id", "text")
    return tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@register("op6_curriculum_mix", sql.CURRICULUM_MIX)
def op6(spark: SparkSession, d: str) -> DataFrame:
    out = mixing.mixed_documents(table(spark, d, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken",
                      F.round("position", 6).alias("position"))


@register("op7_language_id")
def op7(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    counts = langid.fit(docs)
    out = langid.identify(docs.select("doc_id", "text"), counts)
    return out.select("row.doc_id", langid.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score",
                      F.size("shares").cast("long").alias("n_languages"))


@register("op8_fingerprints")
def op8(spark: SparkSession, d: str) -> DataFrame:
    return sketch.edited_fingerprints(table(spark, d, "documents").select("doc_id", "text"))


@register("op9_arc_to_warc", sql.ARC_TO_WARC)
def op9(spark: SparkSession, d: str) -> DataFrame:
    back = warc.archive_pages(table(spark, d, "pages").select("page_id", "url", "html"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op10_jaccard_join", sql.JACCARD_JOIN)
def op10(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.component_ids(table(spark, d, "documents").select("doc_id", "text"))


@register("op11_url_filter")
def op11(spark: SparkSession, d: str) -> DataFrame:
    out = urls.judge(table(spark, d, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "host", "path", "rule", "verdict", F.array_join("words", " ").alias("words"), "log_odds")


@register("op12_vector_codes", sql.VECTOR_CODES)
def op12(spark: SparkSession, d: str) -> DataFrame:
    out = vectors.vector_codes(table(spark, d, "embeddings").select("vec_id", "embedding", "label"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@register("op13_prefix_trie", sql.PREFIX_TRIE)
def op13(spark: SparkSession, d: str) -> DataFrame:
    return trie.prefix_nodes(table(spark, d, "conversations").select("conv_id", "turn", "role", "text"))
