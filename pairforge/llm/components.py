"""Connected components of links between integer ids, by alternating large-star and small-star
rounds (Kiveris et al., 2014).  Each round is an aggregation for the least neighbour and a join of
the links with it: a node with very many links is one row on the aggregated side, and its links can
be split over tasks.  Stage tables compress to a fraction of their rows, so joins are never left to be a broadcast.  Rounds
are cut by stage tables; only a checksum reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import stage


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").hint("merge").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.hint("merge").join(least, "u")
    return joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(id, component): for every id in ``links`` (u, v: not null) but the least of each component
    itself, that least id.  Self-links are ignored."""
    links = stage(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _checksum(links)
    while True:
        links = stage(_small_star(_large_star(links).distinct()).distinct(), "links")
        after = _checksum(links)
        if after == before:
            return links.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = after
