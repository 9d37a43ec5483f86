"""A clustered layout over several columns: ranks on each, interleaved, cut into files.

For every dimension the rows are range-partitioned and sorted by (value, row number), so a value that a
third of the rows holds lies in many ranges.  A row's rank ``s`` is the number of rows with a smaller
value: the place of the first row of its run of equal values.  Runs are found inside each range; one
small row for each *range* (its size, first and last value, and where its last run starts) carries the
start of a run over to the ranges that continue it.  The coordinate is ``floor(cells * s / n)``.

``z`` interleaves the coordinates' bits.  A last range sort by (z, doc_id) with the ranges' offsets gives
positions, hence files.  What a query box meets is joined on *different* cells: a row's z is its cell, so
there are at most ``cells ** dimensions`` of them (4,096 in the registered query) whatever the number of
rows; files are counted for each different shape of bounds, and a file that lies within one cell has that
cell's shape, so the shapes are fewer than twice the cells.

Defined cases: null is the smallest value and a value of its own; strings compare by their UTF-8 bytes;
a null text has length -1, an empty one 0, and long texts are measured whole; repeated rows are rows of
their own, in any order among themselves; a null doc_id comes first in its cell and has a null date; further
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.common import placed, sorted_ranges, stage, starts_of

CELLS = 8
FILE_ROWS = 1000


@dataclass(frozen=True)
class Dimension:
    """A value to lay out by, and how many coordinates to each side a query reaches."""

    name: str
    value: Column
    reach: int = 0


def document_dimensions() -> list[Dimension]:
    """Source, language, length in bytes and the made-up date of a document."""
    length = F.coalesce(F.octet_length("text"), F.lit(-1)).cast("long")
    date = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 365
    return [Dimension("source", F.col("source")), Dimension("lang", F.col("lang")), Dimension("length", length, 1), Dimension("date", date, 1)]


def _mark_runs(value: str, schema: T.StructType):
    """A function for ``mapInArrow`` over sorted ranges: adds ``_part`` and ``_run``, the row inside the
    range at which the run of equal values starts."""
    names = [f.name for f in schema.fields]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, run, last = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            col = batch.column(batch.schema.get_field_index(value))
            codes = col.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new = np.ones(len(codes), dtype=bool)
            new[1:] = codes[1:] != codes[:-1]
            if seen and col[0].as_py() == last:
                new[0] = False
            starts = np.where(new, np.arange(seen, seen + len(codes)), run)
            starts = np.maximum.accumulate(starts)
            run, last, seen = int(starts[-1]), col[-1].as_py(), seen + len(codes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(codes), part), pa.int32()), pa.array(starts, pa.int64())], names=names)

    return mark


def ranked(df: DataFrame, value: str, row: str, name: str) -> DataFrame:
    """``df`` as a stage table with ``name``: the number of rows whose ``value`` is smaller (null is the
    smallest).  ``row`` numbers the rows, so that equal values spread over ranges."""
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_run", T.LongType())])
    ranges = stage(sorted_ranges(df, [F.col(value).asc_nulls_first(), F.col(row)]).mapInArrow(_mark_runs(value, schema), schema), f"ranked-{name}")
    held = F.struct(F.col(value).isNotNull(), F.col(value))
    parts = sorted(ranges.groupBy("_part").agg(F.count("*").alias("size"), F.min(held).alias("first"), F.max(held).alias("last"), F.max("_run").alias("run")).collect(), key=lambda r: r["_part"])
    before = starts_of({r["_part"]: r["size"] for r in parts})
    carried, run, last = list(before), 0, None  # carried: where the run began that a range opens with
    for r in parts:
        p = r["_part"]
        if r["first"] == last:
            carried[p] = run
        run, last = before[p] + r["run"] if r["run"] else carried[p], r["last"]
    of_part = [F.element_at(F.lit(x).cast("array<bigint>"), F.col("_part") + 1) for x in (before, carried)]
    return ranges.withColumn(name, F.when(F.col("_run") > 0, of_part[0] + F.col("_run")).otherwise(of_part[1])).drop("_part", "_run")


def interleaved(coordinates: list[Column], bits: int) -> Column:
    """The coordinates' binary digits, highest first, taken in turn."""
    z = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for c in coordinates:
            z = z * 2 + F.shiftright(c, bit).bitwiseAND(F.lit(1))
    return z


def layout(df: DataFrame, dimensions: list[Dimension], key: str = "doc_id", cells: int = CELLS, file_rows: int = FILE_ROWS) -> DataFrame:
    """A stage table of (key, c0 .. ck: coordinates, z, position, file, lo0, hi0, ..: the file's bounds), a
    row for each row of ``df``.  ``cells`` is a power of two."""
    if cells & (cells - 1):
        raise ValueError("the number of cells must be a power of two")
    names = [f"v{k}" for k in range(len(dimensions))]
    rows = stage(df.select(F.col(key).alias("key"), *[d.value.alias(v) for d, v in zip(dimensions, names, strict=True)]).withColumn("row", F.monotonically_increasing_id()), "rows")
    n = rows.count()
    for k, v in enumerate(names):
        rows = ranked(rows, v, "row", "s").withColumn(f"c{k}", F.expr(f"int({cells} * s div {max(n, 1)})")).drop(v, "s")
    coordinates = [F.col(f"c{k}") for k in range(len(names))]
    rows = rows.withColumn("z", interleaved(coordinates, cells.bit_length() - 1))
    rows = placed(rows, [F.col("z"), F.col("key").asc_nulls_first(), F.col("row")], "position").withColumn("file", F.expr(f"position div {file_rows}"))
    one = W.partitionBy("file")  # file_rows rows
    bounds = {f"{side}{k}": f(c).over(one) for k, c in enumerate(coordinates) for side, f in (("lo", F.min), ("hi", F.max))}
    return stage(rows.withColumns(bounds).drop("row").withColumnRenamed("key", key), "layout")


def files_met(laid: DataFrame, dimensions: list[Dimension], cells: int = CELLS) -> DataFrame:
    """(z, files_touched, files_matching) for each different cell as the centre of a query box: files whose
    bounds meet the box, and files with a row inside.  At most cells ** dimensions rows."""
    k_all = range(len(dimensions))
    bits = cells.bit_length() - 1

    def centres(lo: list[Column], hi: list[Column]) -> list[Column]:
        """For each dimension the centres whose box reaches between lo and hi."""
        return [F.sequence(F.greatest(lo[k] - d.reach, F.lit(0)), F.least(hi[k] + d.reach, F.lit(cells - 1))) for k, d in enumerate(dimensions)]

    def spread(df: DataFrame, each: list[Column], *kept: str) -> DataFrame:
        for k in k_all:
            df = df.withColumn(f"q{k}", F.explode(each[k]))
        return df.select(interleaved([F.col(f"q{k}") for k in k_all], bits).alias("z"), *kept)

    own = [F.col(f"c{k}") for k in k_all]
    with_row = spread(laid.select("file", *own).distinct(), centres(own, own), "file").distinct()
    matching = with_row.groupBy("z").agg(F.count("*").alias("files_matching"))
    sides = [f"{side}{k}" for k in k_all for side in ("lo", "hi")]
    shapes = laid.select("file", *sides).distinct().groupBy(*sides).agg(F.count("*").alias("files"))
    touched = spread(shapes, centres([F.col(f"lo{k}") for k in k_all], [F.col(f"hi{k}") for k in k_all]), "files").groupBy("z").agg(F.sum("files").alias("files_touched"))
    return touched.join(matching, "z").join(laid.select("z").distinct(), "z", "left_semi")


def with_queries(laid: DataFrame, dimensions: list[Dimension], cells: int = CELLS) -> DataFrame:
    """``laid`` with files_touched and files_matching of each row's own box.  What is broadcast has a row for
    each different cell."""
    return laid.join(F.broadcast(files_met(laid, dimensions, cells)), "z")


def write_files(df: DataFrame, laid: DataFrame, path: str, key: str = "doc_id") -> None:
    """The rows of ``df`` (a unique ``key``) as Parquet, one folder for each file of the layout."""
    df.join(laid.select(key, "z", "position", "file"), key).repartition("file").sortWithinPartitions("file", "position").write.partitionBy("file").parquet(path)
