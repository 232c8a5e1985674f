"""Shared prefixes of conversations as a z-fast trie (operator 13).

A conversation is the chain of digests of its prefixes. Of the trie of all
chains only the *compacted* nodes are kept: the root, prefixes after which
conversations part, and prefixes where one ends. Each has the edge of digests
from its parent down to itself (depths up + 1 .. depth), and is stored under
the digest at its *handle*, the two-fattest depth of that interval (the one
with the most trailing zero bits).

1. Conversations with equal chains are one path from here on.
2. Paths are inserted in batches. Every path of a batch finds its exit node by
   fat binary search: of the depths (a, b] that may still hold it, the
   two-fattest is looked up in the handle table; a node found whose own
   digest is on the path raises a, a miss lowers b. The binary logarithm of
   the longest chain bounds the rounds, each one a join by digest. The edge
   that leaves there gives the depth at which the path leaves the trie.
3. Edges are cut where paths leave or end inside them; below that, the new
   paths' digests are grouped: those with several successors, or an end, are
   new nodes, with the edge from the node above on the path.
4. Counts run up the finished trie: each node's own weight is carried by its
   smallest path to the nodes above on that path. Last, the edges are
   expanded: every prefix on an edge has the members of the edge's node.

Scale: texts are hashed where they are read; what moves are digests of 16
bytes. Nodes are met by joins; the handle table is broadcast only after its
rows were counted, and shuffled beyond BROADCAST_NODES. A prefix that a third
of all conversations share is one node: its rows are summed before the
shuffle, and joins by its digest have one row on the other side, so that
Spark splits them. The root, which all share, is summed without any join.
Turns of one conversation are one row of digests (24 bytes a turn). The ids
that end at one node are sorted by range over many tasks, and joined into
chunks there; only the chunks are hashed in a row.

Defined cases: null roles and texts are empty; turns order by number, null
first, equal numbers by digest; rows without conversation id belong to none;
an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.staging import staged

HEADS, FAMILY = 9, 5            # a rebuilt conversation takes up to 8 turns from its family's first
BATCHES = (4, 16, 64)           # of 64 hash classes, those inserted up to each batch
BROADCAST_NODES = 200_000       # of about 100 bytes
CHUNK = 8192                    # ids joined into one string
ROOT = b"\0" * 16


def root() -> Column:
    return F.lit(bytearray(ROOT))


def turn_chains(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turns) with the turns of every conversation in order, each as
    the digest of its role and text and the UTF-8 bytes of the text."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    spelt = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)
    one = F.struct(F.col(turn).isNotNull().alias("known"), F.col(turn).alias("turn"),
                   F.unhex(F.substring(F.sha2(spelt.cast("binary"), 256), 1, 32)).alias("digest"),
                   F.octet_length(said).cast("long").alias("bytes"))
    rows = turns.filter(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv"), one.alias("t"))
    grouped = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return grouped.select("conv", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Every conversation with its first h turns replaced by those of its
    family's first (id - id % 5); h hashes the id."""
    heads = own.filter(F.col("conv") % FAMILY == 0).select(
        F.col("conv").alias("family"), F.slice("turns", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    both = own.withColumn("family", F.col("conv") - F.col("conv") % FAMILY).join(heads, "family", "left")
    taken = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    return both.select("conv", F.concat(taken, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def chaining(batches):
    """Task: turns to the digests of all prefixes, and the bytes up to each."""
    for batch in batches:
        chain, total = [], []
        for turns in batch.column("turns").to_pylist():
            last, digests, sums = ROOT, [], [0]
            for t in turns:
                last = hashlib.blake2b(last + t["digest"], digest_size=16).digest()
                digests.append(last)
                sums.append(sums[-1] + t["bytes"])
            chain.append(digests)
            total.append(sums)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(chain, pa.list_(pa.binary())), pa.array(total, pa.list_(pa.int64())),
             pa.array([c[-1] if c else ROOT for c in chain], pa.binary())], names=["conv", "chain", "total", "end"])


def paths_of(convs: DataFrame) -> DataFrame:
    """Staged (path, chain, total, n): the distinct chains, named by their
    smallest conversation."""
    ends = convs.groupBy("end").agg(F.min("conv").alias("path"), F.count(F.lit(1)).alias("n")).select("path", "n")
    return staged(convs.join(ends, convs["conv"] == ends["path"]).select("path", "chain", "total", "n", F.size("chain").alias("len")), "paths")


# -- locating ------------------------------------------------------------------

def fattest(a: Column, b: Column) -> Column:
    """The two-fattest number of (a, b]."""
    bit = F.floor(F.log2(a.bitwiseXOR(b).cast("double"))).cast("int")
    return b.bitwiseAND(F.call_function("shiftleft", F.lit(-1), bit))


def digest_at(depth: Column) -> Column:
    """The path's digest at a depth, the root's at 0."""
    return F.when(depth == 0, root()).otherwise(F.get("chain", depth - 1))


def sent(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_NODES else table


def located(paths: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """Staged paths with ``at``, the depth at which they leave the trie, and
    the node ``x`` on whose edge that is, if it is inside of one."""
    below = nodes.filter("depth > 0")
    size = below.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("edge")), F.lit(0))).first()
    rows = paths.select("path", "chain", "len", F.lit(0).alias("a"), F.col("len").alias("b"))
    if size[0] == 0:
        return staged(rows.select("path", "chain", "len", F.lit(0).alias("at"), F.lit(None).cast("binary").alias("x")), "located")
    up, depth = F.col("up"), F.col("depth")
    handles = below.select(F.get("edge", fattest(up, depth) - up - 1).alias("handle"), F.col("id").alias("hit"), "depth", "up")
    handles = sent(staged(handles, "handles"), size[0])
    a, b, open_ = F.col("a"), F.col("b"), F.col("a") < F.col("b")
    for _ in range(longest.bit_length() + 1):
        # a path that is done meets nothing, by a key of its own instead of a null one
        probe = rows.withColumn("f", F.when(open_, fattest(a, b)))
        probe = probe.withColumn("want", F.when(open_, F.get("chain", F.col("f") - 1)).otherwise(F.col("path").cast("string").cast("binary")))
        met = probe.join(handles, F.col("want") == F.col("handle"), "left")
        found = open_ & F.col("hit").isNotNull()
        whole = found & (depth <= F.col("len")) & F.coalesce(F.get("chain", depth - 1) == F.col("hit"), F.lit(False))
        rows = met.select("path", "chain", "len",
                          F.when(whole, depth).when(found, up).otherwise(a).alias("a"),
                          F.when(whole, b).when(found, up).when(open_, F.col("f") - 1).otherwise(b).alias("b"))
    edges = below.select(F.get("edge", F.lit(0)).alias("first"), "id", "up", "depth", "edge")
    edges = sent(staged(edges, "edges"), size[1])
    rows = rows.withColumn("want", F.when(a < F.col("len"), F.get("chain", a)).otherwise(F.col("path").cast("string").cast("binary")))
    rows = rows.join(edges, F.col("want") == F.col("first"), "left")
    along = F.size(F.filter(F.sequence(F.lit(0), F.least(F.size("edge"), F.col("len") - up) - 1),
                            lambda i: F.get("edge", i) == F.get("chain", up + i)))
    inside = F.col("id").isNotNull()
    return staged(rows.select("path", "chain", "len", F.when(inside, up + along).otherwise(a).alias("at"),
                              F.when(inside, F.col("id")).alias("x")), "located")


# -- inserting -----------------------------------------------------------------

def cut(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """The nodes with their edges cut where paths leave or end inside."""
    cuts = rows.filter("x IS NOT NULL").groupBy("x").agg(F.collect_set("at").alias("cuts"))
    all_ = nodes.join(cuts, F.col("id") == F.col("x"), "left")
    ends = F.array_sort(F.array_union(F.coalesce("cuts", F.array().cast("array<int>")), F.array("depth")))
    pieces = all_.select("id", "up", "depth", "above", "edge", ends.alias("ends"))
    inner = lambda d: F.get("edge", d - F.col("up") - 1)
    before = lambda i: F.when(i == 0, F.col("up")).otherwise(F.get("ends", i - 1))
    pieces = pieces.select(F.explode(F.transform("ends", lambda d, i: F.struct(
        F.when(d == F.col("depth"), F.col("id")).otherwise(inner(d)).alias("id"), d.alias("depth"), before(i).alias("up"),
        F.when(i == 0, F.col("above")).otherwise(inner(before(i))).alias("above"),
        F.slice("edge", before(i) - F.col("up") + 1, d - before(i)).alias("edge")))).alias("p"))
    return pieces.select("p.*")


def grown(rows: DataFrame) -> DataFrame:
    """The new nodes below the depths at which the paths leave the trie."""
    tails = rows.filter(F.col("at") < F.col("len")).select("path", "at", F.explode(F.transform(
        F.sequence(F.col("at") + 1, F.col("len")),
        lambda d: F.struct(d.alias("depth"), F.get("chain", d - 1).alias("id"), F.xxhash64(F.get("chain", d)).alias("next"),
                           (d == F.col("len")).alias("last")))).alias("t")).select("path", "at", "t.*")
    follows = F.when(~F.col("last"), F.col("next"))
    new = tails.groupBy("id").agg(F.min(follows).alias("lo"), F.max(follows).alias("hi"), F.max("last").alias("ends"), F.min("path").alias("by"))
    new = staged(new.filter("ends OR lo <> hi").select("id", "by"), "new nodes")
    on = tails.select("path", "at", "id", "depth").join(sent(new, new.count()), "id")
    on = on.withColumn("up", F.coalesce(F.lag("depth").over(Window.partitionBy("path").orderBy("depth")), F.col("at")))
    mine = on.filter(F.col("path") == F.col("by")).select("path", "id", "depth", "up")
    made = mine.join(rows.select("path", "chain"), "path")
    return made.select("id", "depth", "up", digest_at(F.col("up")).alias("above"),
                       F.slice("chain", F.col("up") + 1, F.col("depth") - F.col("up")).alias("edge"))


def build(paths: DataFrame, batches: tuple[int, ...] = BATCHES) -> DataFrame:
    """Staged compacted nodes (id, depth, up, above, edge) of the paths;
    ``above`` is the parent's id."""
    spark = paths.sparkSession
    longest = paths.agg(F.max("len")).first()[0] or 0
    nodes = spark.range(1).select(root().alias("id"), F.lit(0).alias("depth"), F.lit(-1).alias("up"),
                                  F.lit(None).cast("binary").alias("above"), F.array().cast("array<binary>").alias("edge"))
    begin = 0
    for upto in batches:
        share = F.pmod(F.xxhash64("path"), F.lit(batches[-1]))
        rows = located(paths.filter((share >= begin) & (share < upto)), nodes, longest)
        nodes = staged(cut(nodes, rows).unionByName(grown(rows)), "nodes")
        begin = upto
    return nodes


# -- counts --------------------------------------------------------------------

def id_chunks(batches):
    """Task: rows sorted by (end, conv) to (end, first, ids joined)."""
    end, ids = None, []

    def out():
        return pa.RecordBatch.from_pydict({"end": pa.array([end], pa.binary()), "first": pa.array([ids[0]], pa.int64()),
                                           "ids": pa.array([",".join(map(str, ids))])})

    for batch in batches:
        for e, c in zip(batch.column("end").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if ids and (e != end or len(ids) == CHUNK):
                yield out()
                ids = []
            end = e
            ids.append(c)
    if ids:
        yield out()


def chunk_digests(batches):
    """Task: chunks sorted by (end, first) to (end, digest of all)."""
    end, state = None, None
    done = lambda: pa.RecordBatch.from_pydict({"end": pa.array([end], pa.binary()), "digest": pa.array([state.hexdigest()])})
    for batch in batches:
        for e, ids in zip(batch.column("end").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if e != end:
                if state:
                    yield done()
                end, state = e, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state:
        yield done()


def end_digests(convs: DataFrame) -> DataFrame:
    """(end, digest) of the ascending ids that end at each prefix."""
    rows = convs.select("end", "conv").repartitionByRange("end", "conv").sortWithinPartitions("end", "conv")
    chunks = rows.mapInArrow(id_chunks, "end binary, first long, ids string")
    chunks = chunks.repartition("end").sortWithinPartitions("end", "first")
    return chunks.mapInArrow(chunk_digests, "end binary, digest string")


def prefix_nodes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for every distinct prefix of the rebuilt conversations:
    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)."""
    own = staged(turn_chains(turns, conv, turn, role, text), "turns")
    convs = staged(rebuilt(own).mapInArrow(chaining, "conv long, chain array<binary>, total array<long>, end binary"), "chains")
    paths = paths_of(convs)
    nodes = build(paths)
    inner = nodes.filter("depth > 0")
    count = inner.count()

    # every path meets its nodes below the root
    on = paths.select("path", "n", F.posexplode("chain").alias("pos", "id")).join(sent(inner.select("id", "depth"), count), "id")
    on = staged(on.select("path", "n", "id", "depth"), "on path")
    members = on.groupBy("id").agg(F.min("path").alias("conv_id"), F.sum("n").alias("n_convs"))
    children = inner.groupBy(F.col("above").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    known = inner.join(members, "id").join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    totals = paths.select(F.col("path").alias("conv_id"), "total")
    known = known.join(totals, "conv_id")
    known = known.withColumn("total", F.slice("total", F.col("up") + 1, F.col("depth") - F.col("up") + 1))     # at up .. depth
    edge_bytes = F.element_at("total", -1) - F.element_at("total", 1)
    known = staged(known.withColumns({"weight": (F.col("n_convs") - 1) * edge_bytes, "leaf": (F.col("n_children") == 0).cast("long")}), "known")

    # a node's weight goes up along its smallest path
    carried = on.select("path", "id", "depth").join(sent(known.select("id", "conv_id", "weight", "leaf"), count), "id")
    mine = F.col("path") == F.col("conv_id")
    lower = Window.partitionBy("path").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select("id", F.coalesce(F.sum(F.when(mine, F.col("weight"))).over(lower), F.lit(0)).alias("weight_below"),
                             F.coalesce(F.sum(F.when(mine, F.col("leaf"))).over(lower), F.lit(0)).alias("leaves_below"))
    below = carried.groupBy("id").agg(F.sum("weight_below").alias("weight_below"), F.sum("leaves_below").alias("leaves_below"))
    tops = paths.agg(F.min("path").alias("conv_id"), F.sum("n").alias("n_convs")).filter("conv_id IS NOT NULL")
    tops = staged(tops.withColumn("id", root()), "root")

    # edges expanded
    parents = known.select(F.col("id").alias("above"), F.col("conv_id").alias("parent")).unionByName(
        tops.select(F.col("id").alias("above"), F.col("conv_id").alias("parent")))
    full = known.join(below, "id").join(sent(parents, count), "above")
    own_digest = end_digests(convs).select(F.col("end").alias("id"), "digest")
    full = full.join(own_digest, "id", "left")
    up, at_end = F.col("up"), F.lit("")
    nothing = F.sha2(at_end.cast("binary"), 256)
    rows = full.select("*", F.explode(F.sequence(up + 1, F.col("depth"))).alias("d"))
    last, first = F.col("d") == F.col("depth"), F.col("d") == up + 1
    rest = F.element_at("total", -1) - F.get("total", F.col("d") - up - 1)
    rows = rows.select(
        "conv_id", F.col("d").cast("long").alias("depth"), F.when(first, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        (F.col("leaves_below") + F.col("leaf")).alias("n_leaves"), (F.col("weight_below") + (F.col("n_convs") - 1) * rest).alias("saved_tokens"),
        F.when(last, F.coalesce("digest", nothing)).otherwise(nothing).alias("ends_sha256"))
    sums = known.agg(F.count_if(F.col("above") == root()).alias("n_children"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("leaves"),
                     F.coalesce(F.sum("weight"), F.lit(0)).alias("saved_tokens"))
    sums = sums.first()         # three numbers
    head = tops.join(own_digest, "id", "left").withColumns({c: F.lit(sums[c]).cast("long") for c in ("n_children", "leaves", "saved_tokens")})
    head = head.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"), "saved_tokens", F.coalesce("digest", nothing).alias("ends_sha256"))
    return rows.unionByName(head)
