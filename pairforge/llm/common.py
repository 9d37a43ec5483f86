"""What the training-data operators share: tables, stage storage, and vectorised text access.

Stage tables are Parquet directories below ``spark.checkpoint.dir``: every executor can read
them, a lost executor costs only the tasks it ran, and column pruning applies when they are read
again.  Nothing is kept in a machine-local folder and no RDD is checkpointed locally.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read through Spark (the path may lie in any store Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_root(spark: SparkSession) -> str:
    """The shared folder for stage tables.  A temporary one serves a local session that names none; on a
    cluster the setting is needed, since other hosts do not see a local folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        root = tempfile.mkdtemp(prefix="stages-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def remove_stages() -> None:
    """Remove the stage tables made so far.  Call it when results that read them have been read; at the
    end of the process it is called anyway."""
    while _written:
        spark, path = _written.pop()
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - that session has ended; others may still be there
            continue


atexit.register(remove_stages)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a stage table in the shared folder and read it back: the lineage ends here."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/stage-{uuid.uuid4().hex[:12]}-{name}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark a staged table for broadcast when its counted rows lie under ``max_rows``; else leave
    the join to the planner, which shuffles both sides."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def same_key(left: DataFrame, right: DataFrame, *names: str):
    """Null-safe equality over ``names``: a null key meets null keys."""
    cond = None
    for n in names:
        c = left[n].eqNullSafe(right[n])
        cond = c if cond is None else cond & c
    return cond


# ---------------------------------------------------------------------------------------------
# Arrow text access

#: Bytes of text that vectorised kernels take at a time; bounds their scratch memory.  One longer
#: document is taken alone.
CHUNK_BYTES = 1 << 19


def utf8(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    if not wide and not pa.types.is_string(col.type):
        col, wide = col.cast(pa.large_string()), True
    _, offsets, data = col.buffers()
    if offsets is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) for runs of whole rows of about ``most`` bytes."""
    data, off = utf8(batch, column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _random_table(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(n, dtype=np.uint64) + _U(seed)) * _U(0x9E3779B97F4A7C15))


#: A random 64-bit value for each byte.
BYTE_VALUE = _random_table(256, 1)

_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        m = max(n, 1 << 16)
        for key, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(m, b, dtype=np.uint64)
            p[0] = 1
            _powers[key] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash; see :func:`span_hash`."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of values[start:end], the same wherever the span lies."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, off: np.ndarray, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a chunk, and the n + 1 offsets of its rows' words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    gap = separator[data]
    word = ~gap
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    before[1:] = gap[:-1]
    start = np.flatnonzero(word & (before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    after[:-1] = gap[1:]
    end = np.flatnonzero(word & (after | edge[1:])) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, by its bytes and length."""
    h = span_hash(prefix_hash(BYTE_VALUE[data]), start, end)
    return mix(h + (end - start).astype(np.uint64) * _U(0x9E3779B97F4A7C15))


# ---------------------------------------------------------------------------------------------
# Global order

#: ``monotonically_increasing_id`` counts rows in the low bits and partitions above them.
_ROW_BITS = 33


def sorted_ranges(df: DataFrame, keys: list) -> DataFrame:
    """``df`` dealt into ranges of ``keys`` and sorted inside each.  Keys that end with a column of different
    values let equal leading values spread over many ranges."""
    return df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)


def starts_of(sizes: dict[int, int]) -> list[int]:
    """For each partition number, the rows in the partitions before it."""
    out, so_far = [], 0
    for p in range(max(sizes, default=0) + 1):
        out.append(so_far)
        so_far += sizes.get(p, 0)
    return out


def placed(df: DataFrame, keys: list, name: str) -> DataFrame:
    """``df`` as a stage table with the 0-based place ``name`` of each row in the order of ``keys``.  No task
    sees more than a range: rows count inside their partition, and one size for each partition (not for
    each row) gives the offsets."""
    ranged = stage(sorted_ranges(df, keys).withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", _ROW_BITS).cast("int")
    before = starts_of({r[0]: r[1] for r in ranged.groupBy(part.alias("part")).agg(F.count("*")).collect()})
    at = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return ranged.withColumn(name, F.element_at(F.lit(before).cast("array<bigint>"), part + 1) + at).drop("_place")
