"""Sharding by balanced label propagation, in native expressions.

Documents that belong together form groups (equal texts in the registered query).  A group is a node that
links its members, so copies cost a link each and not a pair each.  Labels are shards:

1. Linked documents start at a shard by hash.
2. In each round a group counts its members by shard and proposes the shard where most of them are
   (among those with room for the others; the shard with most room is a candidate as well).  Members
   elsewhere want to move there.
3. Quotas: the moves into a shard are summed in ``TICKETS`` classes by a hash of the group, and the
   largest classes that fit into its room, one after the other, are accepted.  The rest tries again in
   the next round under another hash.  Room is counted against the quota and a slack, since the members
   that leave make place that is only known afterwards.  Rounds end when nothing moves.

Then shards are made exactly even by rows: linked documents beyond a shard's quota, taken group by group,
and all documents without a link fill the shards in order.  Positions come from one range sort with offsets of the
ranges, so no shard is gathered in a task.

A group larger than a shard cannot stay whole; it is dealt by hash into parts of half a quota, each of
which is a group of its own.  Of each round only sums for 24 shards reach the driver.

The law is ``rows``: counts differ by one at most.  Defined cases: a null text is the empty text for groups,
sizes and checksums; repeated rows are rows of their own, linked like copies; null doc_ids are dealt like others; an
empty table gives no row; further columns are ignored; long texts are compared by a 128-bit hash of the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairforge.llm.common import placed, stage

SHARDS = 24
ROUNDS = 10
#: Rooms are counted against quota * (1 + SLACK) while labels propagate.
SLACK = 0.2
#: Classes of moves into one shard; the sums of each round have SHARDS * TICKETS rows at most.
TICKETS = 512


def text_group(text: Column) -> Column:
    """The group of equal texts."""
    return F.md5(text.cast("binary"))


def linked(rows: DataFrame, quota: int) -> DataFrame:
    """(row, grp) of the rows whose ``grp`` has another member.  Groups over half a quota become parts."""
    # a stage table, so that the join's other side can be split where a group is hot
    sizes = stage(rows.groupBy("grp").agg(F.count("*").alias("m")).filter("m > 1 AND grp IS NOT NULL"), "sizes")
    parts = F.ceil(F.col("m") / max(quota // 2, 1))
    part = F.when(parts > 1, F.pmod(F.xxhash64("row", "grp"), parts)).otherwise(F.lit(0))
    return rows.select("row", "grp").join(sizes, "grp").select("row", F.xxhash64("grp", part).alias("grp"))


def _by_shard(rooms: list[int]) -> Column:
    return F.lit(rooms).cast("array<bigint>")


def proposals(state: DataFrame, rooms: list[int], salt: int) -> DataFrame:
    """(grp, target, need): the shard that each divided group proposes, and how many members would move."""
    here = state.groupBy("grp", "shard").agg(F.count("*").alias("n"))
    whole = here.groupBy("grp").agg(F.sum("n").alias("m"), F.collect_list(F.struct("n", "shard")).alias("held"))  # SHARDS entries at most
    emptiest = max(range(len(rooms)), key=lambda s: (rooms[s], -s))
    # most members first, equal numbers by a hash, so that ties don't favour one shard
    ranked = F.transform("held", lambda h: F.struct(h["n"].alias("n"), F.xxhash64("grp", h["shard"], F.lit(salt)).alias("tie"), h["shard"].alias("shard")))
    fits = F.filter(ranked, lambda h: F.element_at(_by_shard(rooms), h["shard"] + 1) >= F.col("m") - h["n"])
    best = F.array_max(fits)
    divided = whole.filter(F.size("held") > 1).select("grp", "m", best.alias("best"))
    into_empty = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("tie"), F.lit(emptiest).alias("shard"))
    chosen = divided.select("grp", "m", F.coalesce("best", F.when(F.col("m") <= rooms[emptiest], into_empty)).alias("best")).filter("best IS NOT NULL")
    return chosen.select("grp", F.col("best.shard").alias("target"), (F.col("m") - F.col("best.n")).alias("need"))


def accepted(wanted: DataFrame, rooms: list[int], salt: int) -> DataFrame:
    """The proposals (grp, target) that the rooms allow, by whole classes."""
    ticket = F.pmod(F.xxhash64("grp", F.lit(salt)), F.lit(TICKETS)).cast("int")
    wanted = wanted.withColumn("ticket", ticket)
    room = F.element_at(_by_shard(rooms), F.col("target") + 1)
    sums = wanted.groupBy("target", "ticket").agg(F.sum("need").alias("need")).filter(F.col("need") <= room)
    so_far = F.sum("need").over(W.partitionBy("target").orderBy(F.desc("need"), "ticket").rowsBetween(W.unboundedPreceding, W.currentRow))
    allowed = sums.withColumn("so_far", so_far).filter(F.col("so_far") <= room).select("target", "ticket")
    return wanted.join(F.broadcast(allowed), ["target", "ticket"]).select("grp", "target")


def propagated(members: DataFrame, n: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(row, grp, shard) of linked rows after label propagation under quotas; ``n`` is the number of all rows."""
    most = int(n / shards * (1 + SLACK))
    state = stage(members.select("row", "grp", F.pmod(F.xxhash64("row", F.lit(7)), F.lit(shards)).cast("int").alias("shard")), "labels")
    for k in range(rounds):
        filled = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        rooms = [max(most - filled.get(s, 0), 0) for s in range(shards)]
        moves = stage(accepted(proposals(state, rooms, k), rooms, k), "moves")
        if moves.isEmpty():
            break
        state = stage(state.join(moves, "grp", "left").select("row", "grp", F.coalesce("target", "shard").alias("shard")), "labels")
    return state


def balanced(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (a stage table with ``row``, different for each, and ``grp``, null for rows without links) with ``shard`` and
    ``slot``, gapless in each shard; counts of shards differ by one at most."""
    n = rows.count()
    quota = [n // shards + (s < n % shards) for s in range(shards)]
    state = propagated(linked(rows, n // shards), n, shards, rounds)
    held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    held = [held.get(s, 0) for s in range(shards)]
    kept = [min(h, q) for h, q in zip(held, quota, strict=True)]
    begin = [sum(held[:s]) for s in range(shards)]
    released = [sum(h - k for h, k in zip(held[:s], kept[:s], strict=True)) for s in range(shards)]
    rooms_before = [sum(q - k for q, k in zip(quota[:s], kept[:s], strict=True)) for s in range(shards + 1)]

    def of(values: list[int], s: Column | str) -> Column:
        return F.element_at(_by_shard(values), F.col(s) + 1 if isinstance(s, str) else s + 1)

    labelled = rows.join(state.select("row", F.col("shard").alias("label"), F.col("grp").alias("together")), "row", "left")
    # linked rows by shard and group, then the others; hence a row's place gives its place in the shard or among those to be dealt
    order = [F.coalesce("label", F.lit(shards)), F.col("together").asc_nulls_first(), F.col("row")]
    out = placed(labelled, order, "place")
    inside = F.col("place") - of(begin, "label")
    stays = F.col("label").isNotNull() & (inside < of(kept, "label"))
    dealt = F.when(F.col("label").isNull(), F.col("place") - sum(kept)).otherwise(of(released, "label") + inside - of(kept, "label"))
    out = out.withColumn("stays", stays).withColumn("dealt", dealt)
    # the last shard whose rooms before it are not more than the row's place among those dealt
    into = F.size(F.filter(F.lit(rooms_before[:-1]).cast("array<bigint>"), lambda b: b <= F.col("dealt"))) - 1
    out = out.withColumn("shard", F.when(F.col("stays"), F.col("label")).otherwise(into).cast("int"))
    slot = F.when(F.col("stays"), inside).otherwise(of(kept, "shard") + F.col("dealt") - of(rooms_before[:-1], "shard"))
    return out.withColumn("slot", slot).drop("label", "together", "place", "stays", "dealt")


def sharded(documents: DataFrame, group: Column | None = None, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, grp, shard, slot), a row for each document.  ``group`` says what belongs
    together; by default equal texts."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), (text_group(text) if group is None else group).alias("grp"))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    return balanced(rows, shards).drop("row")


def divided(out: DataFrame) -> DataFrame:
    """(groups, whole, links, cut): of the groups with several rows how many lie in one shard; links to the group
    and those that leave its main shard."""
    here = out.groupBy("grp", "shard").agg(F.count("*").alias("n")).groupBy("grp").agg(F.sum("n").alias("m"), F.max("n").alias("most")).filter("m > 1")
    return here.agg(F.count("*").alias("groups"), F.count_if(F.col("m") == F.col("most")).alias("whole"), F.sum("m").alias("links"), F.sum(F.col("m") - F.col("most")).alias("cut"))
