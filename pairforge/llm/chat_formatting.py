"""Chat formatting with cumulative-snapshot collapse, in native expressions.

Logs often hold a conversation many times, each time one exchange longer.  For every conversation
a rolling hash over its turns gives one hash for each of its prefixes.  A conversation whose
whole hash is the hash of a proper prefix of another one goes (anti join); of equal
conversations the least conv_id stays.  What remains is rendered.

Defined cases: turns are ordered by ``turn`` (nulls first), then role and text; repeated rows count
once; a null role or text is empty; rows with a null conv_id belong to no conversation and
are left out; template marks inside a text are taken apart by a zero-width space, so that a text
cannot open or close a turn.  Texts of any length are hashed whole; a conversation of very many turns is
one row of the result, and its hashes are rows of their own; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairforge.llm.common import stage

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_JOINER = "\u200b"


def assembled(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return conversations.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_set(turn)).alias("turns"))


def prefixes(assembled: DataFrame) -> DataFrame:
    """(conv_id, k, n, h0, h1): the rolling hash of the first k of n turns, for every k.

    The hash of a prefix is that of the prefix before it, changed by the hash of its last turn and place
    (exclusive or), so a conversation costs one step for each turn.  Two hashes make 128 bits."""
    own = F.transform("turns", lambda t: F.md5(F.concat_ws("\u0001", F.md5(t["role"].cast("binary")), F.md5(t["text"].cast("binary"))).cast("binary")))
    rows = assembled.select("conv_id", F.size("turns").alias("n"), F.posexplode(own).alias("at", "own"))
    so_far = W.partitionBy("conv_id").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    rolling = [F.bit_xor(F.xxhash64(F.lit(salt), "at", "own")).over(so_far).alias(f"h{salt}") for salt in (0, 1)]
    return rows.select("conv_id", (F.col("at") + 1).alias("k"), "n", *rolling)


def maximal(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): conversations that are not a prefix of a longer one, once each."""
    c = stage(assembled(conversations), "conversations")
    p = stage(prefixes(c), "prefixes")
    least = p.filter("k = n").groupBy("n", "h0", "h1").agg(F.min("conv_id").alias("conv_id"))
    inner = p.filter("k < n").select(F.col("k").alias("n"), "h0", "h1").distinct()
    kept = least.join(inner, ["n", "h0", "h1"], "left_anti").select("conv_id")
    return c.join(kept, "conv_id", "left_semi")


def rendered(turns: Column) -> Column:
    def safe(x: Column) -> Column:
        return F.replace(x, F.lit("<|"), F.lit("<" + _JOINER + "|"))

    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), safe(t["role"]), F.lit("\n"), safe(t["text"]), F.lit(CLOSE + "\n"))), "")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, rendered) of the maximal conversations."""
    return maximal(conversations).select("conv_id", F.size("turns").cast("long").alias("n_turns"), rendered(F.col("turns")).alias("rendered"))
