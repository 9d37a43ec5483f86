"""Ordered assignment: sources, one after the other, take the first target that is still free.

Each source has an ordered list of keys.  For one key after the other it takes, among the targets of that key in their order, the first that
no source before it has taken; it takes one target at most.  The outcome of this sequence is found by rounds of proposals:

* A source stands at one of its keys.  A target that is held through another key is closed to the sources of this key that come after its holder.
  The sources that stand at a key pass over its targets in order, and each proposes to the next one that isn't closed to it.  All of them propose
  anew in each round, so one that is pushed on pushes the others on at once.  A source passes over a target only if that goes to a source before it.
* A target keeps the first of its proposers.  Holders only ever get earlier.
* A source beyond the open targets of a key moves on to its next key: no target of this one is left for it, now or later.

Whether a target is closed where the sources of a key pass it follows from bounds of how many targets before it are taken.  Where the bounds leave it
unknown it counts as open; who then proposes in vain does so anew.  A round that changes nothing draws the bounds closer, until they meet.
Counts inside a key come from windows over buckets of places and over the sums of buckets, so a key that very many rows share lies in many groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairforge.operators.similarity import position
from pairforge.sources.stages import stage

#: Buckets of places of a key.
BUCKETS = 4096


def counted_before(df: DataFrame, place: str, size: int, flags: dict[str, Column]) -> DataFrame:
    """``df`` (a stage table) with, for each of ``flags`` (name -> condition), the number of rows of the same ``key`` at a lesser ``place`` for which it
    holds.  ``size``: the places of a bucket."""
    marked = df.withColumns({"_bucket": F.floor(F.col(place) / size), **{f"_f_{n}": c.cast("long") for n, c in flags.items()}})
    inside = W.partitionBy("key", "_bucket").orderBy(place).rangeBetween(W.unboundedPreceding, -1)
    over = W.partitionBy("key").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = marked.groupBy("key", "_bucket").agg(*[F.sum(f"_f_{n}").alias(f"_s_{n}") for n in flags])
    sums = sums.select("key", "_bucket", *[F.coalesce(F.sum(f"_s_{n}").over(over), F.lit(0)).alias(f"_b_{n}") for n in flags])
    counted = marked.withColumns({f"_i_{n}": F.coalesce(F.sum(f"_f_{n}").over(inside), F.lit(0)) for n in flags}).join(sums, ["key", "_bucket"])
    return counted.select(*df.columns, *[(F.col(f"_i_{n}") + F.col(f"_b_{n}")).alias(n) for n in flags])


def passed(near: DataFrame, size: int, times: int) -> DataFrame:
    """(key, target, rank): the targets of ``near`` (key, target, cut: how many sources of the key come before the holder, null: there is no holder outside
    the key) that aren't known to be closed, with the number of them before each.  Bounds are drawn ``times`` times."""
    marks = near.withColumn("open", F.when(F.col("cut").isNull(), True).when(F.col("cut") == 0, False))
    for _ in range(times):
        bounds = counted_before(stage(marks, "marks"), "target", size, {"least": F.coalesce("open", F.lit(False)), "most": F.coalesce("open", F.lit(True))})
        marks = bounds.withColumn("open", F.coalesce("open", F.when(F.col("least") >= F.col("cut"), False).when(F.col("most") < F.col("cut"), True))).drop("least", "most")
    left = stage(marks.filter("open IS NULL OR open").select("key", "target"), "open")
    return counted_before(left, "target", size, {"rank": F.lit(True)})


def assigned(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """(target, source, key): who takes what, and under which key.  ``sources``: (source: its place in the order, keys), ``targets``: (target:
    the same, keys), both unique; null keys and null lists count as none."""

    def placed(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame, int]:
        """(place as ``name``, keys; place and ``name`` itself; places of a bucket)."""
        keys = F.array_distinct(F.filter(F.coalesce("keys", F.array().cast("array<string>")), lambda k: k.isNotNull()))
        df = position(df.select(F.col(name).alias("id"), keys.alias("keys")).filter(F.size("keys") > 0), ["id"], "place")
        return df.select(F.col("place").alias(name), "keys"), df.select(F.col("place").alias(name), "id"), -(-df.count() // BUCKETS) or 1

    s, source_ids, s_size = placed(sources, "source")
    t, target_ids, t_size = placed(targets, "target")
    by_key = stage(t.select("target", F.explode("keys").alias("key")), "targets")
    state = s.withColumn("at", F.lit(0))  # the sources, and the key at which each stands
    held = s.sparkSession.createDataFrame([], "target long, holder long, held_by string")
    times = 0  # nothing is held yet
    while True:
        stands = state.select("source", F.get("keys", F.col("at")).alias("key"))
        outside = F.when(F.col("held_by") != F.col("key"), F.col("holder")).alias("source")
        near = stage(by_key.join(stands.select("key").distinct(), "key").join(held, "target", "left").select("key", "target", outside), "near")
        asked = near.filter("source IS NOT NULL").select("key", "source", "target")
        events = stage(stands.select("key", "source", F.lit(None).cast("long").alias("target")).union(asked), "events")
        ranks = counted_before(events, "source", s_size, {"rank": F.col("target").isNull()})
        cuts = ranks.filter("target IS NOT NULL").select("key", "target", F.col("rank").alias("cut"))
        found = passed(near.select("key", "target").join(cuts, ["key", "target"], "left"), t_size, times)
        met = stage(ranks.filter("target IS NULL").drop("target").join(found, ["key", "rank"], "left").select("source", "key", "target"), "met")
        before, proposed = held, met.filter("target IS NOT NULL")
        held = proposed.groupBy("target").agg(F.min(F.struct("source", "key")).alias("_h"))
        held = stage(held.select("target", F.col("_h.source").alias("holder"), F.col("_h.key").alias("held_by")), "held")
        moved = state.join(met.select("source", F.col("target").isNull().alias("spent")), "source")
        state = stage(moved.select("source", "keys", (F.col("at") + F.col("spent").cast("int")).alias("at"), "spent").filter(F.col("at") < F.size("keys")), "state")
        if state.filter("spent").isEmpty():
            if proposed.count() == held.count():
                break  # nobody moves on, and nobody proposed in vain
            if held.exceptAll(before).isEmpty():
                times *= 2
        times = max(times, 1)
        state = state.drop("spent")
    who = held.join(target_ids.withColumnRenamed("id", "_t"), "target").join(source_ids.select(F.col("source").alias("holder"), F.col("id").alias("source")), "holder")
    return who.select(F.col("_t").alias("target"), "source", F.col("held_by").alias("key"))


def emails_from_persons(targets: DataFrame, persons: DataFrame) -> DataFrame:
    """(target, email, key) of the targets that get one.  ``targets``: (target: its place, keys) of rows without an e-mail; ``persons``: (file,
    row, email, keys), taken in the order of file and row."""
    placed = stage(position(persons, ["file", "row"], "source"), "persons")
    return assigned(placed, targets).join(placed.select("source", "email"), "source").select("target", "email", "key")
