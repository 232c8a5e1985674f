"""Benchmark decontamination (operator 3), native.

Benchmark items become windows of ten normalised words (a shorter item is
one window). A scan over the training words looks their n-grams up in a hash
set of the benchmark's: of a window of L words, the n-gram of
a = ceil(L / 2) words that begins at a multiple of s = L - a + 1 lies inside
exactly one place, so every occurrence of a window is met exactly once by
looking up only each s-th n-gram. The few that are met bring the words
around them; the windows over those are looked up by hash and then compared
word by word. The hash set is broadcast only after its size was counted
against a bound; beyond the bound the same join shuffles.

Null or empty texts have no words; rows with equal key and text get equal
results; a key that comes with different texts gets a result for each text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm.staging import ascii_lower, staged

WINDOW = 10
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 200_000        # windows of at most 16 + 8 * 10 bytes and their words
BROADCAST_MARKS = 1_000_000     # keys and text digests of contaminated rows, 16 bytes each


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, then runs of digits, a-z and
    everything beyond ASCII."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS)
    return F.filter(parts, lambda w: w != "")


def item_windows(bench: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """(item, size, hash, window) of every item, distinct."""
    w = bench.select(F.col(item).alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    w = w.withColumn("size", F.least(F.size("w"), F.lit(size)))
    w = w.select("item", "size", F.explode(F.expr("transform(sequence(1, size(w) - size + 1), i -> slice(w, i, size))")).alias("window"))
    return w.distinct().withColumn("hash", F.xxhash64("window"))


def stride(size: int) -> tuple[int, int]:
    """(a, s): words of the n-gram looked up, and the step between them."""
    a = (size + 1) // 2
    return a, size - a + 1


def bench_sets(bench: DataFrame, item: str, text: str, size: int) -> tuple[DataFrame, list[int], bool]:
    """The staged windows, the window sizes among them (10 at most) and
    whether their number allows a broadcast."""
    table = staged(item_windows(bench, item, text, size), "windows")
    sizes = {r["size"]: r["n"] for r in table.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    return table, sorted(sizes), sum(sizes.values()) * max([1, *(stride(k)[1] for k in sizes)]) <= BROADCAST_ROWS


def hits(docs: DataFrame, table: DataFrame, sizes: list[int], small: bool, key: str, text: str) -> DataFrame:
    """(key, digest, at, size, hash, window): every occurrence of a window in
    a document, ``at`` counted in words from 0. ``digest`` stands for the
    text, so repeated rows and keys stay apart."""
    send = F.broadcast if small else (lambda df: df)
    w = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("digest"), words(F.col(text)).alias("w"))
    found = None
    for size in sizes:
        a, step = stride(size)
        mine = table.filter(F.col("size") == size)
        grams = mine.select(F.explode(F.expr(
            f"transform(sequence(1, {step}), i -> xxhash64(slice(window, i, {a})))")).alias("gram")).distinct()
        met = w.filter(F.size("w") >= size).select("key", "digest", F.explode(F.expr(
            f"transform(sequence(0, size(w) - {a}, {step}), i -> named_struct('gram', xxhash64(slice(w, i + 1, {a})), "
            f"'lo', greatest(i - {step - 1}, 0), "
            f"'near', slice(w, greatest(i - {step - 1}, 0) + 1, {a} + least(i, {step - 1}) + {size - a})))")).alias("m"))
        met = met.select("key", "digest", "m.*").join(send(grams), "gram", "left_semi")
        met = met.filter(F.size("near") >= size).select("key", "digest", F.explode(F.expr(
            f"transform(sequence(0, size(near) - {size}), j -> named_struct('at', lo + j, "
            f"'window', slice(near, j + 1, {size}), 'hash', xxhash64(slice(near, j + 1, {size}))))")).alias("m"))
        met = met.select("key", "digest", "m.*").join(
            send(mine.select("hash", "window").distinct()), ["hash", "window"], "left_semi")
        met = met.select("key", "digest", "at", F.lit(size).alias("size"), "hash", "window")
        found = met if found is None else found.unionByName(met)
    return found


def occurrences(docs, table, sizes, small, key, text) -> DataFrame:
    """(key, digest, places) of the rows that hold a window, staged."""
    found = hits(docs, table, sizes, small, key, text)
    return staged(found.groupBy("key", "digest").agg(
        F.collect_set(F.struct("at", "size", "hash")).alias("places")), "occurrences")


def covered(starts: Column) -> Column:
    """Words inside the union of (at, size) intervals."""
    return F.aggregate(
        F.array_sort(starts), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["at"] + x["size"] - F.greatest(acc["upto"], x["at"]), F.lit(0))).cast("long").alias("n"),
            F.greatest(acc["upto"], (x["at"] + x["size"]).cast("long")).alias("upto")),
        lambda acc: acc["n"])


def decontaminate(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """(key, digest, n_words, n_hit, items) of every row of ``docs``: the
    words, those inside occurrences, and the sorted items that occur (as
    strings)."""
    table, sizes, small = bench_sets(bench, item, item_text, size)
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("digest"),
                       F.size(words(F.col(text))).cast("long").alias("n_words"))
    no_items = F.array().cast("array<string>")
    if not sizes:
        return rows.select(F.col("key").alias(key), "digest", "n_words",
                           F.lit(0).cast("long").alias("n_hit"), no_items.alias("items"))
    places = occurrences(docs, table, sizes, small, key, text)
    met = places.select("key", "digest", F.explode(F.array_distinct(F.transform("places", lambda x: F.struct(
        x["size"].alias("size"), x["hash"].alias("hash"))))).alias("x")).select("key", "digest", "x.*")
    which = table.select(F.col("item").cast("string").alias("item"), "size", "hash")
    items = met.join(F.broadcast(which) if small else which, ["size", "hash"])
    items = items.groupBy("key", "digest").agg(F.array_sort(F.collect_set("item")).alias("items"))
    summed = places.select("key", "digest", covered(F.col("places")).alias("n_hit"), F.lit(None).cast("array<string>").alias("items"))
    summed = summed.unionByName(items.withColumn("n_hit", F.lit(None).cast("long")))
    summed = summed.groupBy(F.col("key").alias("k"), F.col("digest").alias("d")).agg(F.max("n_hit").alias("n_hit"), F.max("items").alias("items"))
    out = rows.join(summed, rows["key"].eqNullSafe(summed["k"]) & (rows["digest"] == summed["d"]), "left")
    return out.select(F.col("key").alias(key), "digest", "n_words",
                      F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", no_items).alias("items"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text",
                      item: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; all columns
    of the others stay as they are. Of the rows that go only key and text
    digest are kept; they are broadcast after they were counted, so that no
    text moves, and shuffled beyond BROADCAST_MARKS."""
    table, sizes, small = bench_sets(bench, item, item_text, size)
    if not sizes:
        return docs
    met = hits(docs, table, sizes, small, key, text).select(F.col("key").alias("_k"), F.col("digest").alias("_d"))
    found = staged(met.distinct(), "contaminated")
    found = F.broadcast(found) if found.count() <= BROADCAST_MARKS else found
    return docs.join(found, docs[key].eqNullSafe(found["_k"]) & (F.xxhash64(docs[text]) == found["_d"]), "left_anti")
