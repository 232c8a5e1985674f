"""Weighted keyword search over an inverted index, re-aimed from the browser
search as a batch job (T3, W2, K12, K13).

The index holds, once per set of records, posting lists (token -> the records
that hold it, and in which fields) and the runs of up to three characters of
every distinct token. Posting lists stand in blocks of up to 2 ** BLOCK_BITS records,
numbered in the order that breaks ties, as arrays of two-byte numbers. A term without blanks lies inside of tokens only, so the tokens that contain
it, found by its rarest run, give its records and scores exactly, and no text
is read; a block hands on the best few of its records for a term, so that no
row is made for every hit. A phrase is looked up by its longest piece; the
fields that hold it bound the score, the best-bounded candidates are checked
first, and where the hits among them come before whatever the next candidate
could reach, the rest is never looked at. Candidates are gathered by record,
so a record's text is read once for all of its phrases. Neither the terms nor
the records pass through the driver or a broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.functions.scan import bind
from sitelens.functions.text import snippet
from sitelens.functions.urls import add_param
from sitelens.operators.sections import NUMERIC_ENTITY, decode_numeric_entities, page_sections
from sitelens.session import stored

__all__ = ["NUMERIC_ENTITY", "SearchIndex", "build_index", "collapse_hits", "decode_numeric_entities", "keyword_hits",
           "keyword_search", "page_sections", "record_names", "search_hits", "search_terms", "with_snippets"]

# Field weights, result limit, shortest match and how many
# hits of one page are shown before the "n more" line.
FIELD_WEIGHTS = {"title": 20, "section": 20, "text": 10}
RESULT_LIMIT = 50
MIN_MATCH_CHARS = 2
COLLAPSE_AFTER = 3
QUERY_ARG = "q"
RUN = 3                     # letters of a run that keys a term
BLANKS = r"\s+"             # between tokens
PROBE = 4                   # candidates checked first, as a multiple of the limit
MOST_TERMS = 4096           # terms checked against one reading of a record
BLOCK_BITS = 13             # of a record's number within its block of posting lists, which fits a short


# --- index ------------------------------------------------------------------------

@dataclass
class SearchIndex:
    """Records, their places (record_no, place, names..., key) in the order of
    key and names, the blocks of their posting lists (token, fields, block, at)
    and the runs (run, token) of the distinct tokens. ``fields`` has one bit
    for each weighted field, in the order of ``weights``. Records of the same
    names and key share a place, and in posting lists the first's number."""
    records: DataFrame
    places: DataFrame
    blocks: DataFrame
    runs: DataFrame
    names: list[str]
    key: str
    weights: dict[str, int]

    @property
    def postings(self) -> DataFrame:
        """(token, fields, record_no): the posting lists in rows."""
        rows = self.blocks.select("token", "fields", "block", F.explode("at").alias("at"))
        return rows.select("token", "fields", number_of("block", "at").alias("record_no"))


def number_of(block: str, at: str) -> Column:
    return F.shiftleft(F.col(block), BLOCK_BITS) + F.col(at)


def pieces_of(text: Column) -> Column:
    """What stands between the blanks of a text."""
    return F.filter(F.split(text, BLANKS), lambda x: x != "")


def runs_of(text: Column, sizes: list[int]) -> Column:
    """The distinct runs of a text, of each of the sizes."""
    def of(letters: Column) -> Column:
        def size(n: int) -> Column:
            first = F.slice(letters, F.lit(1), F.greatest(F.size(letters) - n + 1, F.lit(0)))
            return F.transform(first, lambda x, i: F.concat(x, *[F.get(letters, i + k) for k in range(1, n)]))
        return F.array_distinct(F.concat(*[size(n) for n in sizes]))

    return bind(F.split(text, ""), of)


def lowered(field: str) -> Column:
    return F.lower(F.coalesce(F.col(field), F.lit("")))


def record_names(records: DataFrame, key: str) -> list[str]:
    """The columns that name a record: (page_id, position) where there are
    such, else ``key``, which is then unique."""
    return ["page_id", "position"] if {"page_id", "position"} <= set(records.columns) else [key]


def numbered(records: DataFrame, key: str = "href") -> DataFrame:
    """``records`` with a number of their own, ``record_no``, in the order of
    key and names within each partition; to be stored."""
    order = dict.fromkeys([key, *record_names(records, key)])
    return records.sortWithinPartitions(*order).withColumn("record_no", F.monotonically_increasing_id())


def placed(records: DataFrame, key: str = "href") -> DataFrame:
    """(record_no, place, names..., key) of numbered records: their place,
    from 0 without gaps, in the order of key and names. Ranges of that order
    are ranked each on its own; where a range begins is a sum over ranges."""
    names = record_names(records, key)
    order = list(dict.fromkeys([key, *names]))
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = records.select("record_no", *order).repartitionByRange(parts, *order)
    ranged = stored(ranged.withColumn("in_range", F.spark_partition_id()), "ranges")
    ranked = ranged.withColumn("at", F.dense_rank().over(Window.partitionBy("in_range").orderBy(*order)))
    sizes = ranked.groupBy("in_range").agg(F.max("at").alias("n"))
    before = Window.orderBy("in_range").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("in_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return ranked.join(F.broadcast(begins), "in_range").select(
        "record_no", (F.col("begin") + F.col("at") - 1).alias("place"), *dict.fromkeys([*names, key]))


def blocks_of(records: DataFrame, places: DataFrame, key: str = "href", weights: dict[str, int] | None = None) -> DataFrame:
    """(token, fields, block, at): the postings of numbered records, gathered
    by block, token and fields. Records are dealt by block, so that what is
    grouped within a block moves no more."""
    twins = places.withColumn("first_no", F.min("record_no").over(Window.partitionBy("place"))).filter("first_no < record_no")
    twins = stored(twins.select("record_no", "first_no"), "twins")
    if twins.take(1):
        joined = records.join(twins, "record_no", "left")
        records = joined.withColumn("record_no", F.coalesce("first_no", "record_no")).drop("first_no")
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = [F.col(f) for f in weights or FIELD_WEIGHTS]
    dealt = records.select(*fields, F.shiftright("record_no", BLOCK_BITS).alias("block"),
                           F.col("record_no").bitwiseAND((1 << BLOCK_BITS) - 1).cast("short").alias("at")).repartition(parts, "block")
    rows = postings_of(dealt, key, weights, ["block", "at"])
    return rows.groupBy("block", "token", "fields").agg(F.collect_list("at").alias("at")).select("token", "fields", "block", "at")


def postings_of(records: DataFrame, key: str = "href", weights: dict[str, int] | None = None,
                kept: list[str] | None = None) -> DataFrame:
    """(token, fields, names..., key): one row for every distinct token of a
    record, in lower case. ``kept``: other columns to name it by. The last field is taken for the long one: its
    tokens are compared with the others' as sets."""
    weights = weights or FIELD_WEIGHTS
    kept = kept or list(dict.fromkeys([*record_names(records, key), key]))
    *heads, long = weights
    each = F.struct(*[F.array_distinct(pieces_of(lowered(f))).alias(f) for f in weights])

    def rows(x: Column) -> Column:
        short = F.array_distinct(F.concat(F.array().cast("array<string>"), *[x[f] for f in heads]))
        return bind(short, lambda s: bind(F.array_intersect(s, x[long]), lambda both: F.concat(
            F.transform(s, lambda r: F.struct(r.alias("token"), reduce(
                lambda a, b: a + b,
                [F.when(F.array_contains(held, r), 1 << i).otherwise(0) for i, held in enumerate([*[x[f] for f in heads], both])]).alias("fields"))),
            F.transform(F.array_except(x[long], s), lambda r: F.struct(r.alias("token"), F.lit(1 << len(heads)).alias("fields"))))))

    return records.select(*kept, F.inline(bind(each, rows))).select("token", "fields", *kept)


def token_runs(postings: DataFrame) -> DataFrame:
    """(run, token): the runs of every distinct token of posting lists."""
    return postings.select("token").distinct().select(F.explode(runs_of(F.col("token"), [1, RUN - 1, RUN])).alias("run"), "token")


def sorted_by(df: DataFrame, column: str) -> DataFrame:
    """``df`` dealt and sorted by a column, so that files hold ranges of it;
    as many as the session has shuffle partitions, whatever their size, since
    what reads them is heavy per row."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, column).sortWithinPartitions(column)


def build_index(records: DataFrame, key: str = "href", weights: dict[str, int] | None = None) -> SearchIndex:
    """The index of ``records``: numbered records, their places, blocks by
    token and runs stored, the last two sorted, so that a reader's filter
    skips most row groups."""
    records = stored(numbered(records, key), "records")
    places = stored(placed(records, key), "places")
    blocks = stored(sorted_by(blocks_of(records, places, key, weights), "token"), "postings")
    return read_index(records, places, blocks, stored(sorted_by(token_runs(blocks), "run"), "runs"), key, weights)


def read_index(records: DataFrame, places: DataFrame, blocks: DataFrame, runs: DataFrame, key: str = "href",
               weights: dict[str, int] | None = None) -> SearchIndex:
    """An index over numbered records and places that are stored, and blocks
    and runs that are stored or made by whoever reads them."""
    return SearchIndex(records, places, blocks, runs, record_names(records, key), key, weights or FIELD_WEIGHTS)


# --- search -----------------------------------------------------------------------

def search_terms(queries: DataFrame, query_id: str = "query_id", query: str = "query") -> DataFrame:
    """(query_id, query, term): the user's text and its normalised term, lower
    case, trimmed, of at least two characters, not all of them blank (an empty
    query finds nothing)."""
    term = F.lower(F.trim(F.col(query)))
    return (queries.select(F.col(query_id).alias("query_id"), F.col(query).alias("query"), term.alias("term"))
            .filter((F.length("term") >= MIN_MATCH_CHARS) & (F.size(pieces_of(F.col("term"))) > 0)))


def term_keys(terms: DataFrame, index: SearchIndex) -> DataFrame:
    """(term, piece, run): a term's longest piece and the rarest of its runs,
    for terms whose runs all occur. What is made from the terms alone is
    stored, so that its size is known where it meets the tokens."""
    longest = F.array_max(F.transform(pieces_of(F.col("term")), lambda p: F.struct(F.length(p).alias("n"), p.alias("piece"))))
    words = terms.select("term").distinct().select("term", longest["piece"].alias("piece"))
    size = lambda n: runs_of(F.col("piece"), [n])
    n = F.length("piece")
    wanted = stored(words.select("term", "piece", F.explode(F.when(n == 1, size(1)).when(n < RUN, size(RUN - 1)).otherwise(size(RUN))).alias("run")), "wanted")
    rarity = index.runs.join(stored(wanted.select("run").distinct(), "sought"), "run", "left_semi").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    # a run that no token holds leaves its term without candidates
    best = wanted.join(rarity, "run", "left").groupBy("term", "piece").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("run").alias("run"))).alias("b"))
    return stored(best.filter("b.n > 0").select("term", "piece", "b.run"), "keys")


def candidates(terms: DataFrame, index: SearchIndex) -> DataFrame:
    """(term, whole, bound, names..., key): the records with a token that
    contains the term's longest piece, with the score that the fields of those
    tokens allow. Where the piece is the ``whole`` term the bound is its score."""
    kept = dict.fromkeys([*index.names, index.key])
    held = index.runs.join(term_keys(terms, index), "run").filter(F.contains("token", F.col("piece")))
    held = held.select("term", (F.col("piece") == F.col("term")).alias("whole"), "token")
    met = index.postings.join(held, "token").groupBy("term", "whole", "record_no").agg(F.bit_or("fields").alias("fields"))
    bound = reduce(lambda a, b: a + b, [F.when(F.col("fields").bitwiseAND(1 << i) > 0, w).otherwise(0)
                                        for i, w in enumerate(index.weights.values())])
    return met.join(index.places, "record_no").select("term", "whole", bound.alias("bound"), *kept)


def word_hits(terms: DataFrame, index: SearchIndex, limit: int) -> DataFrame:
    """(term, score, record_no) with the best ``limit`` hits of every term
    without blanks among them: those of every block. Within a block, the
    records of a field are one array of numbers, and a score is a combination
    of fields; tokens meet the terms where the block is."""
    keys = term_keys(terms, index).filter("piece = term").select("term", "run")
    runs = index.blocks.select("*", F.explode(runs_of(F.col("token"), [RUN - 1, RUN])).alias("run"))
    met = runs.join(keys, "run").filter(F.contains("token", F.col("term")))
    fields = range(len(index.weights))
    numbers = [F.array_distinct(F.flatten(F.collect_list(F.when(F.col("fields").bitwiseAND(1 << i) > 0, F.col("at"))))) for i in fields]
    sets = met.groupBy("term", "block").agg(*[n.alias(f"in{i}") for i, n in zip(fields, numbers, strict=True)])

    def exactly(mask: int) -> Column:
        """Records in all fields of a mask and in no other."""
        inside = reduce(F.array_intersect, [F.col(f"in{i}") for i in fields if mask >> i & 1])
        return reduce(F.array_except, [F.col(f"in{i}") for i in fields if not mask >> i & 1], inside)

    levels: dict[int, list[Column]] = {}
    for mask in range(1, 1 << len(index.weights)):
        levels.setdefault(sum(w for i, w in enumerate(index.weights.values()) if mask >> i & 1), []).append(exactly(mask))

    def first(score: int) -> Column:
        found = F.slice(F.array_sort(F.concat(*levels[score])), 1, limit)
        return F.transform(found, lambda at: F.struct(F.lit(score).alias("score"), at.alias("at")))

    best = [first(score) for score in sorted(levels, reverse=True)]
    rows = sets.select("term", "block", F.inline(F.slice(F.concat(*best), 1, limit)))
    return rows.select("term", "score", number_of("block", "at").alias("record_no"))


def checked(pairs: DataFrame, index: SearchIndex) -> DataFrame:
    """(term, score, names..., key) of the (term, names...) pairs whose term
    occurs in at least one field: score = sum of the weights of the fields
    that contain it. Pairs are gathered by record first; a record with more
    than MOST_TERMS terms is read once for every so many."""
    names = index.names
    busy = pairs.groupBy(*names).agg(F.ceil(F.count(F.lit(1)) / MOST_TERMS).alias("parts")).filter("parts > 1")
    dealt = pairs.select("term", *names).join(busy, names, "left")
    part = F.pmod(F.xxhash64("term"), F.coalesce("parts", F.lit(1)))
    gathered = dealt.groupBy(*names, part.alias("part")).agg(F.collect_list("term").alias("terms"))
    fields = F.struct(*[lowered(f).alias(f) for f in index.weights])
    # one reading of the record for all of its terms
    hits = lambda x: F.filter(F.transform("terms", lambda t: F.struct(t.alias("term"), reduce(
        lambda a, b: a + b, [F.when(F.contains(x[f], t), w).otherwise(0) for f, w in index.weights.items()]).alias("score"))),
        lambda h: h["score"] > 0)
    kept = dict.fromkeys([*names, index.key])
    rec = index.records.select(*dict.fromkeys([*kept, *index.weights]))
    return gathered.join(rec, names).select(*kept, F.inline(bind(fields, hits)))


def keyword_hits(terms: DataFrame, records: DataFrame | SearchIndex, key: str = "href",
                 weights: dict[str, int] | None = None) -> DataFrame:
    """Every (record, term) pair where the term occurs (case-insensitive
    substring) in at least one field, with its score, without a limit."""
    index = records if isinstance(records, SearchIndex) else build_index(records, key, weights)
    pairs = candidates(terms, index)
    return exact(pairs, index).unionByName(checked(pairs.filter(~F.col("whole")), index).select("term", "score", *dict.fromkeys([*index.names, index.key])))


def exact(pairs: DataFrame, index: SearchIndex) -> DataFrame:
    """(term, score, names..., key) of the candidates that need no text."""
    return pairs.filter("whole").select("term", F.col("bound").alias("score"), *dict.fromkeys([*index.names, index.key]))


def best_first(index: SearchIndex, score: str) -> list[Column]:
    return [F.col(score).desc(), F.col(index.key), *[F.col(n) for n in index.names if n != index.key]]


def place(index: SearchIndex, score: str, prefix: str = "") -> Column:
    """A record's place under a term as a struct: smaller is better."""
    return F.struct((-F.col(prefix + score)).alias("a"), *[F.col(prefix + n).alias(f"b{i}") for i, n in enumerate(
        dict.fromkeys([index.key, *index.names]))])


def top_hits(terms: DataFrame, index: SearchIndex, limit: int = RESULT_LIMIT) -> DataFrame:
    """(term, rank, score, names..., key): the best ``limit`` records of every
    term by score, ties by key and name, which is the order of places."""
    out = ["term", "rank", "score", *dict.fromkeys([*index.names, index.key])]
    by = Window.partitionBy("term")
    best = word_hits(terms, index, limit).join(index.places.select("record_no", "place"), "record_no")
    best = best.withColumn("rank", F.row_number().over(by.orderBy(F.col("score").desc(), "place"))).filter(F.col("rank") <= limit)
    hits = best.drop("place").join(index.places, "record_no").select(*out)
    phrases = terms.filter(F.size(pieces_of(F.col("term"))) > 1)
    if phrases.take(1):
        found = phrase_hits(candidates(phrases, index).filter(~F.col("whole")), index, limit)
        ranked = found.withColumn("rank", F.row_number().over(by.orderBy(*best_first(index, "score"))))
        hits = hits.unionByName(ranked.filter(F.col("rank") <= limit).select(*out))
    return hits


def phrase_hits(pairs: DataFrame, index: SearchIndex, limit: int) -> DataFrame:
    """(term, score, names..., key) with the best ``limit`` hits of every
    phrase among them.

    The candidates of a phrase are ranked by bound; the first PROBE * limit
    are checked. If ``limit`` of the hits among them come before the best
    place that the next candidate could have, the phrase is done. Only the
    other phrases' remaining candidates are checked as well, those that could
    still come before the hits found."""
    first = PROBE * limit
    by = Window.partitionBy("term")
    ranked = pairs.withColumn("at", F.row_number().over(by.orderBy(*best_first(index, "bound")))).filter(F.col("at") <= first + 1)
    ranked = stored(ranked, "candidates")
    hits = stored(checked(ranked.filter(F.col("at") <= first), index), "hits")
    frontier = ranked.filter(F.col("at") == first + 1).select("term", place(index, "bound").alias("next"))
    ahead = frontier.join(hits.select("term", place(index, "score").alias("found")), "term", "left")
    ahead = ahead.groupBy("term", "next").agg(F.count_if(F.col("found") < F.col("next")).alias("n"))
    open_ = stored(ahead.filter(F.col("n") < limit).select("term", "next"), "open")
    if open_.take(1):
        ranks = hits.join(open_, "term", "left_semi").withColumn("rank", F.row_number().over(by.orderBy(*best_first(index, "score"))))
        last = ranks.filter(F.col("rank") == limit).select("term", place(index, "score").alias("last"))
        rest = pairs.join(open_.join(last, "term", "left"), "term")
        here = place(index, "bound")
        rest = rest.filter((here >= F.col("next")) & (F.col("last").isNull() | (here < F.col("last")))).drop("next", "last")
        hits = hits.unionByName(checked(rest, index))
    return hits


def with_snippets(results: DataFrame, index: SearchIndex, columns: tuple[str, ...] = ()) -> DataFrame:
    """``results`` with ``link`` (the key with ``?q=query``), ``snippet`` (the
    marked, clipped text) and, if asked for, ``columns`` of the records. The
    results of a record are gathered, so its text is read once for all."""
    names = index.names
    busy = results.groupBy(*names).agg(F.ceil(F.count(F.lit(1)) / MOST_TERMS).alias("parts")).filter("parts > 1")
    part = F.pmod(F.xxhash64("query_id"), F.coalesce("parts", F.lit(1)))
    own = [c for c in results.columns if c not in names]
    gathered = results.join(busy, names, "left").groupBy(*names, part.alias("part")).agg(F.collect_list(F.struct(*own)).alias("results"))
    more = list(dict.fromkeys(c for c in ("text", *columns) if c not in (*names, *own)))
    # only records with results are moved
    hit = stored(results.select(*names).distinct(), "hit")
    records = index.records.select(*names, *more).join(hit, names, "left_semi")
    text = F.struct(F.col("text").alias("text"), F.lower("text").alias("low"))
    rows = bind(text, lambda x: F.transform("results", lambda r: F.struct(
        *[r[c].alias(c) for c in own], add_param(r[index.key] if index.key in own else F.col(index.key), QUERY_ARG, r["query"]).alias("link"),
        snippet(x["text"], r["term"], x["low"]).alias("snippet"))))
    return gathered.join(records, names).select(*names, *[c for c in columns if c in more], F.inline(rows))


def search_hits(queries: DataFrame, index: SearchIndex, limit: int = RESULT_LIMIT,
                query_id: str = "query_id", query: str = "query") -> DataFrame:
    """(query_id, query, term, rank, score, names..., key): T3 without the
    records' texts. Equal terms are searched once."""
    terms = search_terms(queries, query_id, query)
    return top_hits(terms, index, limit).join(terms, "term")


def keyword_search(queries: DataFrame, records: DataFrame | SearchIndex, limit: int = RESULT_LIMIT,
                   key: str = "href", weights: dict[str, int] | None = None,
                   query_id: str = "query_id", query: str = "query", details: bool = True) -> DataFrame:
    """Best ``limit`` records per query by score, ties by ``key`` (and by
    the record's name, where several share the key). ``records`` is a table,
    which is indexed first, or an index.

    Output: query_id, query (the user's text), rank, href, score, title,
    section, text, link (href with ``?q=query``) and snippet (marked, clipped
    text). ``details=False`` returns only query_id, query, rank, href and
    score, without reading the records again.
    """
    index = records if isinstance(records, SearchIndex) else build_index(records, key, weights)
    hits = search_hits(queries, index, limit, query_id, query)
    if not details:
        return hits.select("query_id", "query", "rank", index.key, "score")
    out = with_snippets(hits, index, ("title", "section", "text"))
    return out.select("query_id", "query", "rank", index.key, "score", "title", "section", "text", "link", "snippet")


def collapse_hits(results: DataFrame, collapse_after: int = COLLAPSE_AFTER,
                  href: str = "href", rank: str = "rank") -> DataFrame:
    """Group each query's results by page; the page's own record first,
    then its sections in result order; ``collapse_after`` entries shown, then
    one ``more`` row counting the rest. Groups keep the order of their first
    hit (``group_rank``)."""
    base = F.substring_index(F.col(href), "#", 1)
    r = results.withColumn("base_href", base).withColumn("is_doc", F.instr(F.col(href), "#") == 0)
    g = Window.partitionBy("query_id", "base_href")
    w = g.orderBy(F.col("is_doc").desc(), F.col(rank))
    r = (r.withColumn("item_rank", F.row_number().over(w))
         .withColumn("group_size", F.count(F.lit(1)).over(g))
         .withColumn("group_first", F.min(rank).over(g)))
    r = r.withColumn("group_rank", F.dense_rank().over(
        Window.partitionBy("query_id").orderBy("group_first")))
    shown = F.struct(
        F.col("item_rank").alias("item_rank"),
        F.when(F.col("item_rank") == 1, F.lit("doc")).otherwise(F.lit("item")).alias("kind"),
        F.col(href).alias("href"), F.lit(None).cast("bigint").alias("more"))
    more = F.struct(
        F.lit(collapse_after + 1).alias("item_rank"), F.lit("more").alias("kind"),
        F.lit(None).cast("string").alias("href"),
        (F.col("group_size") - collapse_after).cast("bigint").alias("more"))
    # one pass: each hit yields its own line (if shown) and, for the group's
    # first hit, the "n more" line
    lines = F.concat(
        F.when(F.col("item_rank") <= collapse_after, F.array(shown)).otherwise(F.array().cast(
            "array<struct<item_rank:int,kind:string,href:string,more:bigint>>")),
        F.when((F.col("item_rank") == 1) & (F.col("group_size") > collapse_after), F.array(more))
        .otherwise(F.array().cast("array<struct<item_rank:int,kind:string,href:string,more:bigint>>")))
    return r.select("query_id", "base_href", "group_rank", F.inline(lines))
