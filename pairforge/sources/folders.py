"""Folders of CSV files with headers of their own, read as one table of texts."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge import dims
from pairforge.functions import text as X
from pairforge.sources.stages import CSV

#: Columns that :func:`read_folder` adds: the file, and a number that rises with the rows of one file.
FILE, ROW = "_file", "_row"


def first_lines(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(file, its first line that isn't blank) of every CSV file below ``path``, sorted; one pair for each file."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value").filter("trim(value) <> ''")
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("block", "line")).alias("value"))
    return sorted((r["file"], r["value"].removeprefix("﻿")) for r in first.collect())


def column_names(line: str) -> list[str] | None:
    """The column names of a header; a name that repeats, or is blank, gets a number.  None if the line ends inside quotes."""
    try:
        names = next(csv.reader([line], strict=True))
    except csv.Error:
        return None
    out: list[str] = []
    taken = {FILE, ROW}
    for k, name in enumerate(names):
        base = name if name.strip() else f"column {k}"
        new, n = base, 0
        while new.lower() in taken:
            n += 1
            new = f"{base}.{n}"
        taken.add(new.lower())
        out.append(new)
    return out


def read_folder(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, broken): the rows of every CSV file of a tree, each file under its own header, one below the other by column name (other cases of a
    name are the same column); all values are texts.  Files are grouped by their header, and a group is one scan.  ``broken``: (file,
    reason) of files that can't be read.  Values may hold quotes and line ends, so a file is read by one task."""
    groups: dict[tuple[str, ...], list[str]] = {}
    broken: list[tuple[str, str]] = []
    for file, line in first_lines(spark, path):
        names = column_names(line)
        if names is None:
            broken.append((file, "the header ends inside quotes"))
        else:
            groups.setdefault(tuple(names), []).append(file)
    parts, known = [], {}
    for names, files in sorted(groups.items()):
        names = [known.setdefault(n.lower(), n) for n in names]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = spark.read.schema(schema).options(**CSV, multiLine=True, enforceSchema=True).csv(files)
        parts.append(rows.select("*", F.col("_metadata.file_path").alias(FILE), F.monotonically_increasing_id().alias(ROW)))
    empty = spark.createDataFrame([], T.StructType([T.StructField(FILE, T.StringType()), T.StructField(ROW, T.LongType())]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts or [empty]), spark.createDataFrame(broken, "file string, reason string")


def person_rows(rows: DataFrame, least_key: int = 4) -> DataFrame:
    """(file, row, email, keys) of the rows of :func:`read_folder` that hold an e-mail: the first in the e-mail columns, else in any column; and
    the keys under which the row's person may be known, in order: each name column, then first and last names put together."""
    columns = [c for c in rows.columns if c not in (FILE, ROW)]
    if not columns:
        return rows.select(F.col(FILE).alias("file"), F.col(ROW).alias("row"), F.lit("").alias("email"), F.array().cast("array<string>").alias("keys")).limit(0)

    def named(words: list[str]) -> list[str]:
        return [c for c in columns if any(w in c.lower() for w in words)]

    def exactly(names: list[str]) -> list[str]:
        return [c for c in columns if c.lower().strip() in names]

    def first(names: list[str]) -> Column:
        return X.first_email(F.concat_ws(" | ", *[F.col(f"`{c}`") for c in names])) if names else F.lit("")

    own = first(named(dims.EMAIL_COLUMN_WORDS))
    keys = [X.normalize_key(F.col(f"`{c}`")) for c in named(dims.PERSON_COLUMN_WORDS)]
    # a missing part of a name is the empty text
    part = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    both = [X.normalize_key(F.concat_ws(" ", part(a), part(b))) for a in exactly(dims.FIRST_NAME_COLUMNS) for b in exactly(dims.LAST_NAME_COLUMNS)]
    all_keys = F.array(*keys, *both) if keys or both else F.array().cast("array<string>")
    kept = F.array_distinct(F.filter(all_keys, lambda k: F.length(k) >= least_key))
    out = rows.select(F.col(FILE).alias("file"), F.col(ROW).alias("row"), F.when(own != "", own).otherwise(first(columns)).alias("email"), kept.alias("keys"))
    return out.filter("email <> ''")
