"""N-gram Jaccard join by a token-group matrix (operator 10).

Two documents link when the intersection of their sets of five-word shingles
is at least 80 % of the union; the result names each document's component.

1. Equal sets are one *class* from here on.
2. *Groups*: classes that share a pair of min-hashes fall under one leader;
   a leader's classes are split into groups of about GROUP. Links inside
   each group, and between it and the leader's first group, are found, and
   give provisional components. All of these links are exact.
3. *Token-group matrix*: for each provisional component, the union of the
   tokens that can witness a link. Tokens are ordered rare first; a class
   of n tokens and a smaller or equal one that link share a token among the
   first n - ceil(0.8 n) + 1 of the larger and the first
   n' - ceil(1.6 n' / 1.8) + 1 of the smaller (prefix filter; no link is
   lost whatever the order). So (token, component) rows that meet under one
   token, pass the bounds on sizes and on the overlap that is still possible,
   and belong to different components, are all that can still link.
4. Those components' groups go through the matrix once more, by group, now
   counting the tokens they share; the pairs that pass are compared: a query's overlap with the other
   group's token union bounds its overlap with every member, and only where
   this bound reaches 80 % of the query the group is opened and its members'
   intersections counted.

The links of both steps together give the components. No step forms all
pairs of a large group: copies are one class, near copies meet only within
groups of bounded size or as one component. What is broadcast: at most
COMMON_TOKENS frequent tokens (they only set the order), and lists of rows
to reread whose number was counted against BROADCAST_ROWS (beyond it the
join shuffles).

Null or empty texts, or texts without words, have no shingles and link with
nothing: their component is their own key. Rows that repeat a key and text
are one class; a component is named by its smallest key (null if it has
null keys only; such rows link like any other). A key with several texts
stands for each of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.components import components
from sitelens.llm.staging import bounded_batches, staged

WORDS, PERCENT = 5, 80
BANDS = 10
GROUP = 192
COMMON_TOKENS = 1_000_000       # 16 bytes each
BROADCAST_ROWS = 500_000
STEP = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as ascending 64-bit hashes."""
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
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def needed(n: int, percent: int) -> int:
    """Least overlap of a set of n with one that links with it."""
    return -(-percent * n // 100)


def min_hash_pairs(tokens: np.ndarray, bands: int) -> list[int]:
    """One key a band, of two min-hashes each."""
    seeds = (np.arange(1, 2 * bands + 1, dtype=np.uint64) * np.uint64(STEP[0])) | np.uint64(1)
    keys = np.full(2 * bands, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for part in range(0, len(tokens), 50_000):
            mixed = tokens[None, part:part + 50_000] * seeds[:, None]
            mixed ^= mixed >> np.uint64(31)
            mixed *= np.uint64(STEP[1])
            keys = np.minimum(keys, mixed.min(axis=1))
        pairs = keys[0::2] * np.uint64(STEP[1]) ^ keys[1::2]
    return pairs.view(np.int64).tolist()


def common_counter(words: int):
    """Task: (token, n) of the tokens in several texts of a batch."""
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column(0).to_pylist() if t]
            if sets:
                token, n = np.unique(np.concatenate(sets), return_counts=True)
                often = n >= 3
                yield pa.RecordBatch.from_arrays([pa.array(token[often].view(np.int64)), pa.array(n[often])], names=["token", "n"])

    return run


SET_TYPES = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])
SET_DDL = "doc long, row long, n long, digest binary, bands array<long>"


def set_maker(words: int, bands: int):
    """Task: texts to set size, digest and min-hash keys."""
    def run(batches):
        for batch in batches:
            out = {n: [] for n in SET_TYPES.names}
            for doc, row, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                s = shingle_set(text or "", words)
                for name, value in zip(SET_TYPES.names, (
                        doc, row, len(s), digest_of(s), min_hash_pairs(s, bands) if len(s) else []), strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=SET_TYPES)

    return run


def digest_of(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def full_sets(words: int):
    """Task: (digest, id columns..., text) to (id columns..., tokens), without
    the texts whose set has another digest (of a key with several texts)."""
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t or "", words) for t in batch.column(batch.num_columns - 1).to_pylist()]
            fits = pa.array([digest_of(s) == d for s, d in zip(sets, batch.column(0).to_pylist(), strict=True)], pa.bool_())
            tokens = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:-1], tokens], names=[*batch.schema.names[1:-1], "tokens"]).filter(fits)

    return run


def prefix_of(s: np.ndarray, common, percent: int) -> np.ndarray:
    """The tokens of a set, rare first, that a link must touch."""
    token, count = common
    seen = np.zeros(len(s), dtype=np.int64)
    if len(token):
        at = np.minimum(np.searchsorted(token, s), len(token) - 1)
        seen = np.where(token[at] == s, count[at], 0)
    return s[np.lexsort((s, seen))[:len(s) - needed(len(s), percent) + 1]]


def prefix_rows(common, words: int, percent: int, by: int):
    """Task: classes (digest, ``by`` ids, text) to matrix rows, already merged
    within a batch: (token, ids, lo, hi, rem, rem_index). rem is the most
    tokens that stand from this one on; rem_index the same for those that
    also count as the smaller set of a link, 0 for none. A text whose set
    has another digest (of a key with several texts) is left out."""
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t or "", words) for t in batch.column(by + 1).to_pylist()]
            fits = [i for i, d in enumerate(batch.column(0).to_pylist()) if digest_of(sets[i]) == d]
            if not fits:
                continue
            lists = [prefix_of(sets[i], common.value, percent) for i in fits]
            length = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            token = np.concatenate(lists).view(np.int64)
            whose = np.repeat(np.arange(len(fits)), length)
            n = np.fromiter((len(sets[i]) for i in fits), dtype=np.int64, count=len(fits))[whose]
            pos = np.arange(len(token)) - np.repeat(np.cumsum(length) - length, length)
            rem = n - pos
            index = n - -(-2 * percent * n // (100 + percent)) + 1
            ids = [np.asarray(batch.column(1 + k), dtype=np.int64)[fits][whose] for k in range(by)]
            order = np.lexsort((*ids, token))
            token, n, rem, rem_index = token[order], n[order], rem[order], np.where(pos < index, rem, 0)[order]
            ids = [x[order] for x in ids]
            new = np.ones(len(token), dtype=bool)
            new[1:] = token[1:] != token[:-1]
            for x in ids:
                new[1:] |= x[1:] != x[:-1]
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (token[at], *(x[at] for x in ids), np.minimum.reduceat(n, at), np.maximum.reduceat(n, at),
                                       np.maximum.reduceat(rem, at), np.maximum.reduceat(rem_index, at))],
                names=["token", *(f"id{k}" for k in range(by)), "lo", "hi", "rem", "rem_index"])

    return run


def matrix(docs: DataFrame, classes: DataFrame, common, words: int, percent: int, by: tuple[str, ...]) -> DataFrame:
    """The token-group matrix of the staged ``classes`` (rep, digest, ids)
    under the first id in ``by``, with the smallest and largest component
    that it holds under the token; dealt by token. Both sides of its join
    with itself read the same columns, so it is made and shuffled once."""
    rows = chosen(docs.select(F.col("row").alias("rep"), "text"), classes.select("rep", "digest", *by), ["rep"])
    kinds = ", ".join(f"{c} long" for c in ("token", *by, "lo", "hi", "rem", "rem_index"))
    rows = rows.select("digest", *by, "text").mapInArrow(prefix_rows(common, words, percent, len(by)), kinds)
    return rows.repartition("token").groupBy("token", by[0]).agg(
        F.min(by[-1]).alias("least"), F.max(by[-1]).alias("most"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("rem").alias("rem"), F.max("rem_index").alias("rem_index"))


def meetings(rows: DataFrame, percent: int, by: str, counted: bool = False) -> DataFrame:
    """(x, y): pairs of ``by`` that meet under a token, are not of one and the
    same component there, and pass the bounds; x the smaller number.

    One token must have room for the whole overlap behind it. ``counted``:
    all tokens under which a pair meets are counted as well; what the
    probing prefixes do not share can only lie behind one of them, so the
    overlap is at most that count and the longer rest."""
    a, b = rows.alias("a"), rows.alias("b")
    one = (F.col("a.least") == F.col("a.most")) & (F.col("b.least") == F.col("b.most")) & (F.col("a.least") == F.col("b.least"))
    on = (F.col("a.token") == F.col("b.token")) & ~one
    on &= (F.col("a.lo") * percent <= F.col("b.hi") * 100) & (F.col("a.hi") * 100 >= F.col("b.lo") * percent)
    if not counted:
        overlap = F.least("a.rem_index", "b.rem") * (100 + percent) >= (F.col("a.lo") + F.col("b.lo")) * percent
        same = F.col("a.rem").isNotNull() & F.col("b.rem_index").isNotNull()       # always; both sides read all columns
        met = a.join(b, on & (F.col("a.rem_index") > 0) & (F.col("a.lo") <= F.col("b.hi")) & overlap & same)
        return met.select(F.least(f"a.{by}", f"b.{by}").alias("x"), F.greatest(f"a.{by}", f"b.{by}").alias("y")).distinct()
    met = a.join(b, on & (F.col(f"a.{by}") < F.col(f"b.{by}"))).groupBy(F.col(f"a.{by}").alias("x"), F.col(f"b.{by}").alias("y")).agg(
        F.count(F.lit(1)).alias("k"), (F.min("a.lo") + F.min("b.lo")).alias("both"), F.greatest(F.max("a.hi"), F.max("b.hi")).alias("most"))
    rest = F.ceil(F.col("most") * percent / 100) - 1
    return met.filter((F.col("k") + rest) * (100 + percent) >= F.col("both") * percent).select("x", "y")


def linker(percent: int):
    """Task: the classes of one unit (side, cls, comp, tokens) to links.
    Sides 0 and 1 are compared, or side 0 with itself if there is no other;
    classes of one component are not."""
    def run(unit: pa.Table) -> pa.Table:
        side, cls, comp = (np.asarray(unit.column(c)) for c in ("side", "cls", "comp"))
        tokens = unit.column("tokens").combine_chunks()
        start = np.asarray(tokens.offsets)
        flat = np.asarray(tokens.values)
        sizes = np.diff(start)
        members = np.flatnonzero(side == side.max())
        queries = np.flatnonzero(side == 0)
        token = np.concatenate([flat[start[m]:start[m + 1]] for m in members])
        owner = np.repeat(np.arange(len(members)), sizes[members])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        root = {int(c): int(c) for c in comp}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        u, v = [], []
        for q in queries:
            mine, n = flat[start[q]:start[q + 1]], int(sizes[q])
            low, high = np.searchsorted(token, mine, "left"), np.searchsorted(token, mine, "right")
            count = high - low
            if 100 * int((count > 0).sum()) < percent * n:      # the union bounds every member
                continue
            total = int(count.sum())
            at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(total)
            both = np.bincount(owner[at], minlength=len(members))
            for k in np.flatnonzero(100 * both >= percent * (n + sizes[members] - both)).tolist():
                m = members[k]
                x, y = find(int(comp[q])), find(int(comp[m]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    u.append(int(cls[q]))
                    v.append(int(cls[m]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def links(units: DataFrame, percent: int) -> DataFrame:
    """(u, v) of linked classes, from units (unit columns x and y, side, cls,
    comp, tokens) of bounded size."""
    return units.groupBy("x", "y").applyInArrow(linker(percent), "u long, v long")


def chosen(df: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """``df`` joined with the staged ``rows``, which are broadcast only after
    their number was counted against BROADCAST_ROWS."""
    return df.join(F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows, on)


def common_tokens(docs: DataFrame, words: int):
    """Broadcast (tokens, counts) of the most frequent tokens, ascending."""
    common = docs.select("text").mapInArrow(common_counter(words), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    common = staged(common, "common")
    rows = common.count()
    least = 0
    if rows > COMMON_TOKENS:        # the list sets an order only; ties at its end are left out
        least = common.agg(F.percentile_approx("n", F.lit(1 - COMMON_TOKENS / rows), 10_000)).first()[0]
    top = common.filter(F.col("n") > least).toArrow()
    token = np.asarray(top.column("token"), dtype=np.int64).view(np.uint64)
    order = np.argsort(token)
    return docs.sparkSession.sparkContext.broadcast((token[order], np.asarray(top.column("n"), dtype=np.int64)[order]))


def classes_of(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Staged (doc, row, n, digest) of all rows and (cls, digest, rep, first,
    n, bands) of the classes of non-empty sets: ``rep`` is the row that stands
    for the class, ``first`` its smallest key."""
    sets = staged(docs.select("doc", "row", "text").mapInArrow(set_maker(words, BANDS), SET_DDL), "sets")
    full = sets.filter("n > 0").groupBy("digest").agg(
        F.min("row").alias("rep"), F.min("doc").alias("first"), F.min_by(F.struct("n", "bands"), F.col("n")).alias("s"))
    full = full.select(F.monotonically_increasing_id().alias("cls"), "digest", "rep", "first", "s.n", "s.bands")
    return sets.select("doc", "row", "n", "digest"), staged(full, "classes")


def grouped(classes: DataFrame) -> DataFrame:
    """(cls, leader, grp, first) of the classes that share a min-hash pair
    with others: the smallest class they share one with, and their group
    under it (numbered by its smallest class); ``first``: the leader's first."""
    keys = classes.select("cls", F.posexplode("bands").alias("band", "key"))
    least = keys.groupBy("band", "key").agg(F.min("cls").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    led = keys.join(least.drop("n"), ["band", "key"]).groupBy("cls").agg(F.min("leader").alias("leader"))
    size = led.groupBy("leader").agg(F.count(F.lit(1)).alias("members"))
    led = led.join(size, "leader").withColumn("parts", F.ceil(F.col("members") / GROUP))
    led = led.withColumn("part", F.when(F.col("cls") == F.col("leader"), 0).otherwise(F.pmod(F.xxhash64("cls"), "parts")))
    return staged(led.select("cls", "leader", "part", "parts"), "groups")


def bodies_of(docs: DataFrame, rows: DataFrame, words: int, repeated: bool) -> DataFrame:
    """The staged ``rows`` (rep, digest, cls, ...) with the token sets of
    their classes; only their texts are read into sets."""
    found = chosen(docs.select(F.col("row").alias("rep"), "text"), rows, ["rep"])
    kept = [f for f in rows.schema.fields if f.name not in ("rep", "digest")]
    kinds = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + ["tokens array<long>"])
    made = found.select("digest", *[f.name for f in kept], "text").mapInArrow(full_sets(words), kinds)
    return made.dropDuplicates(["cls"]) if repeated else made


def component_ids(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                     percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``docs``. ``key`` is a
    whole number."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    # a row is reread by the hash of its key, which may be null, and text
    docs = docs.withColumn("row", F.xxhash64("doc", "text"))
    sets, classes = classes_of(docs, words)
    ids = classes.select("cls", "rep", "digest")
    repeated = bool(sets.groupBy("row", "digest").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").take(1))

    groups = grouped(classes)
    bodies = bodies_of(docs, staged(groups.join(ids, "cls"), "members"), words, repeated)
    unit = lambda x, y, side: F.struct(x.alias("x"), y.cast("long").alias("y"), F.lit(side).alias("side"))
    leader, part, across = F.col("leader"), F.col("part"), -F.col("leader") - 1
    others = F.when((part == 0) & (F.col("parts") > 1), F.transform(
        F.sequence(F.lit(1).cast("long"), F.greatest(F.col("parts").cast("long") - 1, F.lit(1))), lambda y: unit(across, y, 1)))
    within = F.when(part > 0, F.array(unit(leader, part, 0), unit(across, part, 0))).otherwise(F.array(unit(leader, part, 0)))
    units = bodies.select(F.explode(F.when(others.isNull(), within).otherwise(F.concat(within, others))).alias("u"),
                          "cls", F.col("cls").alias("comp"), "tokens").select("u.*", "cls", "comp", "tokens")
    comps = components(staged(links(units, percent), "links"))

    labels = comps.select(F.col("node").alias("cls"), "component").join(
        groups.select("cls", F.xxhash64("leader", "part").alias("grp")), "cls", "full")
    named = ids.join(labels, "cls", "left")
    named = staged(named.select("cls", "rep", "digest", F.coalesce("component", "cls").alias("comp"), F.coalesce("grp", "cls").alias("grp")), "named")

    common = common_tokens(docs, words)
    pairs = staged(meetings(matrix(docs, named, common, words, percent, ("comp",)), percent, "comp"), "pairs")
    involved = staged(pairs.select(F.explode(F.array("x", "y")).alias("comp")).distinct(), "involved")
    again = staged(chosen(named, involved, ["comp"]), "again")
    opened = staged(meetings(matrix(docs, again, common, words, percent, ("grp", "comp")), percent, "grp", counted=True), "opened")
    members = opened.select(F.explode(F.array(F.struct("x", "y", F.col("x").alias("grp"), F.lit(0).alias("side")),
                                              F.struct("x", "y", F.col("y").alias("grp"), F.lit(1).alias("side")))).alias("m")).select("m.*")
    wanted = staged(members.select("grp").distinct(), "wanted")
    rows = staged(chosen(again.select("cls", "rep", "digest", "comp", "grp"), wanted, ["grp"]), "members")
    bodies = bodies_of(docs, rows, words, repeated)
    units = bodies.join(members, "grp").select("x", "y", "side", "cls", "comp", "tokens")
    more = staged(links(units, percent), "links")

    every = comps.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more.select("u", "v"))
    final = components(every)
    placed = classes.select("cls", "digest", "first").join(final, F.col("cls") == F.col("node"), "left")
    placed = placed.withColumn("comp", F.coalesce("component", "cls"))
    least = placed.groupBy("comp").agg(F.min("first").alias("component_id"))
    placed = placed.join(least, "comp").select("digest", "component_id")
    out = sets.join(placed, "digest", "left")
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"))
