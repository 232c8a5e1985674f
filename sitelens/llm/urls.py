"""URL filter by host word segmentation and naive Bayes (operator 11).

1. Rules decide the urls that they fit: a rule is a host, with all of its
   subdomains, and the beginning of a path; the longest rule wins.
2. Host names are split into words: at dots, hyphens and digits, and then,
   since names are often several words run together, by unigram Viterbi: of
   all ways to cut a name into words the most probable one. Word counts come
   from the pages' own words (markup taken out), the parts of hyphenated
   names and the words of paths. A piece that is no known word costs a factor
   of ten a letter (and one in the number of all words), so names stay whole
   only where no known words make them up.
3. Urls that a rule fits teach a multinomial naive Bayes model over the words
   of hosts and paths; it judges all others. Urls without a rule whose host
   holds one of the seed words are examples to block as well.

Scale: only words that occur inside some host name are kept of the counts,
found by joining the pieces of the distinct names with the counted words; each
distinct host is segmented once. Those tables grow with the hosts; they are
broadcast only after they were counted, and shuffled beyond BROADCAST_ROWS (a
host with a third of all pages is split by Spark, as its other side is one
row). The model is fitted on a documented sample of labelled urls (``sample``
of them, lowest hashes first and class by class), so it has a bounded size and
travels to the tasks.

Defined cases: null urls and urls without ``://`` have an empty host and path
and fit no rule; urls without a word that the model knows are allowed, and so
are all without a rule where the labelled ones are all of one kind. Equal urls
get equal results; null and repeated keys stay as rows of their own; other
columns are ignored; null pages have no words.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm.staging import ascii_lower, staged

# The rules (action, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
SEEDS = ("adult", "bet", "bets", "casino", "gamble", "pills", "poker", "porn", "sex", "spam", "viagra", "xxx")
LONGEST_WORD = 24               # letters of a known word inside a name
SAMPLE = 10_000                 # labelled urls of each kind that the model learns from
BROADCAST_ROWS = 200_000
MARKUP = r"(?s)<(?i:script|style)\b.*?</(?i:script|style)\s*>|<[^>]*>|&[A-Za-z#0-9]+;"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits, null where none does."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, action = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(action)
    return rule, action


def words_in(text: Column) -> Column:
    """The runs of a-z of a text, A-Z lower-cased."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "[^a-z]+"), lambda w: w != "")


# -- segmentation ---------------------------------------------------------------

def known_words(pages: DataFrame, urls: DataFrame, hosts: DataFrame, names: DataFrame, html: str) -> tuple[DataFrame, int]:
    """(name, words) with the counts of all known words inside of each name,
    and the number of all words counted: those of the pages, and of distinct
    hosts and urls what hyphens and slashes set apart."""
    text = pages.select(F.explode(words_in(F.regexp_replace(html, MARKUP, " "))).alias("word"))
    parted = F.filter(F.split("host", r"\."), lambda x: F.contains(x, F.lit("-")))
    of_hosts = hosts.select(F.explode(words_in(F.array_join(parted, " "))).alias("word"))
    of_paths = urls.select("host", "path").distinct().select(F.explode(words_in(F.col("path"))).alias("word"))
    counts = text.unionByName(of_hosts).unionByName(of_paths).filter(F.length("word").between(2, LONGEST_WORD))
    counts = staged(counts.groupBy("word").agg(F.count(F.lit(1)).alias("k")), "words")
    total = counts.agg(F.sum("k")).first()[0] or 0
    n = F.length("name")
    inside = names.select("name", F.explode(F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), n - i + 1)),
                                                       lambda k: F.substring("name", i, k)))))).alias("word"))
    met = inside.filter(F.length("word") > 1).join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("word", "k")).alias("words"))
    return names.join(met, "name", "left").select("name", "words"), total


def split_name(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words of a name; of equally probable ways the one
    whose last word is longest."""
    unknown = [0.0] + [-math.log(total + 1.0) - k * math.log(10.0) for k in range(1, len(name) + 1)]
    best, cut = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    known = {w: math.log(c / total) for w, c in counts.items()}
    longest = max(map(len, known), default=0)
    for end in range(1, len(name) + 1):
        for begin in range(end):
            if end - begin <= longest and (p := known.get(name[begin:end])) is not None:
                score = best[begin] + p
            else:
                score = best[begin] + unknown[end - begin]
            if score > best[end] + 1e-12:
                best[end], cut[end] = score, begin
    out, end = [], len(name)
    while end:
        out.append(name[cut[end]:end])
        end = cut[end]
    return out[::-1]


def splitting(total: int):
    """Task: (name, words) to (name, cut)."""
    def run(batches):
        for batch in batches:
            names, found = batch.column("name"), batch.column("words").to_pylist()
            cut = [split_name(n, {x["word"]: x["k"] for x in w or ()}, total) for n, w in zip(names.to_pylist(), found, strict=True)]
            yield pa.RecordBatch.from_arrays([names, pa.array(cut, pa.list_(pa.string()))], names=["name", "cut"])

    return run


def host_words(pages: DataFrame, urls: DataFrame, html: str) -> DataFrame:
    """Staged (host, words): the words of every distinct host, in order, names
    as cut by Viterbi; the last of several labels stays whole."""
    hosts = staged(urls.filter("host <> ''").select("host").distinct(), "hosts")
    front = F.when(F.contains("host", F.lit(".")), F.regexp_replace("host", r"\.[^.]*$", "")).otherwise(F.col("host"))
    last = F.when(F.contains("host", F.lit(".")), words_in(F.substring_index("host", ".", -1))).otherwise(F.array().cast("array<string>"))
    pieces = hosts.select("host", F.posexplode(words_in(front)).alias("at", "name"))
    names = staged(pieces.select("name").distinct(), "names")
    found, total = known_words(pages, urls, hosts, names, html)
    cuts = staged(found.mapInArrow(splitting(total), "name string, cut array<string>"), "cuts")
    cuts = F.broadcast(cuts) if cuts.count() <= BROADCAST_ROWS else cuts
    joined = pieces.join(cuts, "name").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "cut"))).alias("cuts"))
    words = F.concat(F.coalesce(F.flatten(F.col("cuts.cut")), F.array().cast("array<string>")), last)
    return staged(hosts.join(joined, "host", "left").select("host", words.alias("words")), "host words")


# -- naive Bayes -----------------------------------------------------------------

def url_tokens(words: list[str] | None, path: str) -> list[str]:
    """Tokens of a url: the words of its host, and those of its path with
    their numbers as lengths."""
    parts = re.findall("[a-z]+|[0-9]+", path.translate(LOWER))
    return [f"h:{w}" for w in words or ()] + [f"p:#{len(p)}" if p.isdigit() else f"p:{p}" for p in parts]


LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def fit(examples: list[tuple[bool, list[str]]]) -> dict[str, float] | None:
    """Log odds of blocking for each token, "" for the prior (add-one
    smoothing); None where all examples are of one kind."""
    docs, seen = Counter(), {True: Counter(), False: Counter()}
    for block, tokens in examples:
        docs[block] += 1
        seen[block].update(tokens)
    if not (docs[True] and docs[False]):
        return None
    known = sorted(set(seen[True]) | set(seen[False]))
    size = {b: sum(seen[b].values()) + len(known) for b in (True, False)}
    odds = {t: math.log((seen[True][t] + 1) / size[True]) - math.log((seen[False][t] + 1) / size[False]) for t in known}
    return {"": math.log(docs[True] / docs[False])} | odds


def log_odds(model: dict[str, float] | None, tokens: list[str]) -> float | None:
    """Of blocking; None where the model knows no token."""
    met = [model[t] for t in tokens if t in model] if model else []
    return model[""] + math.fsum(met) if met else None


def judging(model):
    """Task: (..., path, words) to (..., path, words, odds)."""
    def run(batches):
        for batch in batches:
            words, paths = batch.column("words").to_pylist(), batch.column("path").to_pylist()
            odds = [log_odds(model.value, url_tokens(w, p)) for w, p in zip(words, paths, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(odds, pa.float64())], names=[*batch.schema.names, "odds"])

    return run


def sampled(rows: DataFrame, sample: int) -> list[tuple[bool, list[str]]]:
    """Up to ``sample`` labelled urls of each kind, drawn by a hash of the row."""
    out = []
    for kind in (True, False):
        some = rows.filter(F.col("block") == kind).select("block", "words", "path", F.xxhash64("key", "host", "path").alias("draw"))
        for r in some.orderBy("draw", "host", "path").limit(sample).collect():
            out.append((r["block"], url_tokens(r["words"], r["path"])))
    return out


def judge(pages: DataFrame, rules=RULES, seeds=SEEDS, sample: int = SAMPLE, key: str = "page_id", url: str = "url",
          html: str = "html") -> DataFrame:
    """(key, host, path, rule, verdict, words, log_odds) of every row: the
    rule's verdict, else the model's."""
    u = F.col(url)
    urls = pages.select(F.col(key).alias("key"), host_of(u).alias("host"), path_of(u).alias("path"))
    found = host_words(pages.select(F.col(html).alias(html)), urls, html)
    found = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    rows = urls.join(found, "host", "left").withColumns({"rule": rule, "action": action})
    seeded = F.arrays_overlap("words", F.array(*map(F.lit, seeds)) if seeds else F.array().cast("array<string>"))
    label = F.when(F.col("action").isNotNull(), F.col("action") == "block").when(seeded, True)
    model = fit(sampled(rows.withColumn("block", label).filter("block IS NOT NULL"), sample))
    sent = pages.sparkSession.sparkContext.broadcast(model)
    kind = urls.schema["key"].dataType.simpleString()
    out = rows.select("key", "host", "path", "rule", "action", "words").mapInArrow(
        judging(sent), f"key {kind}, host string, path string, rule string, action string, words array<string>, odds double")
    verdict = F.coalesce("action", F.when(F.col("odds") > 0, "block").otherwise("allow"))
    return out.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "words", F.col("odds").alias("log_odds"))
