"""Joins on containment of one text in another, through an index of character grams instead of a nested loop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters of a gram; a shorter text is a gram as a whole.
GRAM = 3


def _runs(chars: Column, size: int) -> Column:
    """All runs of ``size`` neighbouring characters."""
    at = F.sequence(F.lit(0), F.size(chars) - size)
    return F.when(F.size(chars) >= size, F.transform(at, lambda i: F.concat(*[F.get(chars, i + j) for j in range(size)]))).otherwise(F.array().cast("array<string>"))


def _texts(df: DataFrame, text: str, keys: list[str], name: str) -> DataFrame:
    return df.select(*keys, F.col(text).alias(name)).filter(F.col(name) != "").distinct().withColumn("_ch", F.split(name, ""))


def contained(longs: DataFrame, long: str, shorts: DataFrame, short: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, long, short): the different texts of which the first contains the second, within equal ``keys``; each pair once.

    A short text is posted under the rarest of its grams, by the number of long texts that hold it, and not at all if one of its grams is in no
    long text.  A long text meets the postings of its own grams and what it meets is verified.  Empty and null texts take no part.
    """
    keys = list(keys)
    chars = F.col("_ch")
    l = _texts(longs, long, keys, "_l")
    held = l.select(*keys, "_l", F.explode(F.array_distinct(F.concat(*[_runs(chars, k) for k in range(1, GRAM + 1)]))).alias("_g"))
    own = _runs(chars, GRAM)
    for k in range(GRAM - 1, 0, -1):
        own = F.when(F.size(chars) == k, _runs(chars, k)).otherwise(own)
    s = _texts(shorts, short, keys, "_s").withColumn("_gs", F.array_distinct(own))
    grams = s.select(*keys, "_s", F.size("_gs").alias("_n"), F.explode("_gs").alias("_g"))
    counts = held.groupBy(*keys, "_g").agg(F.count("*").alias("_c"))
    posted = grams.join(counts, [*keys, "_g"]).groupBy(*keys, "_s", "_n").agg(F.count("*").alias("_found"), F.min_by("_g", F.struct("_c", "_g")).alias("_g")).filter("_found = _n")
    met = held.join(posted.select(*keys, "_s", "_g"), [*keys, "_g"]).filter(F.contains("_l", "_s"))
    return met.select(*keys, F.col("_l").alias(long), F.col("_s").alias(short))


def either_way(left: DataFrame, a: str, right: DataFrame, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, a, b): the different texts of which one contains the other."""
    columns = [*keys, a, b]
    return contained(left, a, right, b, keys).select(*columns).union(contained(right, b, left, a, keys).filter(F.col(a) != F.col(b)).select(*columns))
