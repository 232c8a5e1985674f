"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.staging import staged


def _nearest(links: DataFrame) -> DataFrame:
    """(u, m): the smallest of each node and its neighbours."""
    return links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _checksum(links: DataFrame):
    r = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(r)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected ``links`` (u, v),
    the component named by its smallest node.

    Large-star and small-star rounds: every node hands its larger (then its
    smaller) neighbours the smallest node it knows, until nothing changes;
    the number of rounds grows with the logarithm of the longest path. A node
    with very many links is only ever counted by a minimum, which is formed
    before the shuffle, and joined by key, where Spark splits hot keys. Each
    round is written to the shared folder and reread."""
    links = staged(links.filter("u <> v").distinct(), "links")
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_nearest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = down.join(_nearest(down), "u")
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                               F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        links = staged(small.filter("u <> v").distinct(), "links")
        now = _checksum(links)
        if now == before:
            break
        before = now
    named = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return named.union(named.select(F.col("component").alias("node"), "component").distinct())
