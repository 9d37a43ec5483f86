"""Rankings, top-k views and quality checks of rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ranked(df: DataFrame, group: str | list[str], order: list, name: str) -> DataFrame:
    """Row numbers from 1 inside each group."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(group).orderBy(*order)))


def qualified_rank(df: DataFrame, group: str, score: str, ties: list[str], name: str, qualified: str = "qualified") -> DataFrame:
    """Ranks among the qualified rows of each group; null for the others."""
    w = W.partitionBy(group, qualified).orderBy(F.col(score).desc(), *ties)
    return df.withColumn(name, F.when(F.col(qualified), F.row_number().over(w)))


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key: a partial max_by, so a key with very many rows isn't sorted in one task."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def first_of_group(df: DataFrame, group: str, order: list, columns: dict[str, str]) -> DataFrame:
    w = W.partitionBy(group).orderBy(*order)
    return df.withColumns({new: F.first_value(F.col(old)).over(w) for new, old in columns.items()})


def batch_rank(df: DataFrame, index: str, group: str, order: list, name: str, size: int = 10) -> DataFrame:
    """Ranks that restart for each ``size`` source entities."""
    return ranked(df.withColumn("batch", F.floor(F.col(index) / size)), ["batch", group], order, name)


def rank_qa(df: DataFrame, group: str, rank: str, final: str, product: str, decision: str) -> DataFrame:
    """For each group: places where the order is broken, and whether rank 1 is not Yes though a Yes exists."""
    w = W.partitionBy(group).orderBy(rank)
    broken = (F.lag(final).over(w) < F.col(final)) | ((F.lag(final).over(w) == F.col(final)) & (F.lag(product).over(w) < F.col(product)))
    d = df.withColumn("_broken", F.coalesce(broken, F.lit(False)))
    yes = F.col(decision) == "Yes"
    return d.groupBy(group).agg(F.count_if("_broken").alias("order_violations"), (F.bool_or(yes) & ~F.bool_or(yes & (F.col(rank) == 1))).alias("top_not_yes"))


def contiguous(df: DataFrame, group: str, rank: str) -> DataFrame:
    """Groups whose ranks are not 1..n."""
    g = df.groupBy(group).agg(F.count(rank).alias("n"), F.min(rank).alias("lo"), F.max(rank).alias("hi"), F.count_distinct(rank).alias("d"))
    return g.filter((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n")))


def order_first_with_matches(count: str, name: str) -> list[Column]:
    return [(F.col(count) == 0).asc(), F.col(name).asc()]


def first_rows(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """The first row of each group.  Spark keeps only the first rows of each task's groups before the
    shuffle (a group limit), so a large group isn't moved whole."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(group).orderBy(*order))).filter("_r = 1").drop("_r")


def head(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows in an order: the same ones each time, by partial top-k."""
    return df.orderBy(*order).limit(n)
