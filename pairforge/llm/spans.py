"""Repeated-span search shared by the word and byte operators.

Every window of ``window`` units (words or bytes) owns the minimal hash among its ``gram``-unit
pieces, the leftmost on ties.  Equal windows own equal minimisers at equal places, so a repeat
can never be missed.  Consecutive windows with one minimiser form a *run*; a run is described by
the minimiser's hash ``a`` and the hash ``u`` of all its content.  Consecutive runs form a *chain*,
which ends after a run whose minimiser says so (one in ``CHAIN``): equal stretches of text are cut into
equal chains wherever they lie.  A chain is described like a run.  Rows are chains, then runs, not
windows, so what is shuffled is a few hundredths of the units:

1. ``chains``       one row for each chain of each document, with its runs (stage table);
2. ``trunks``       chains that repeat whole: one row for each, with its least place;
3. ``dealt``        the chains, with runs only where they don't repeat or are the one occurrence kept;
4. ``shared``       runs whose minimiser occurs twice or more;
5. ``paths``        one row for each (a, u): how often and where it occurs first;
6. ``branching``    minimisers through which several different paths pass; only for these single
                    windows are compared, on the first occurrence of each path.

A chain that repeats whole is never taken apart where it repeats: a copy of a long passage costs a row
for each chain, and runs only in the chains in which it departs from its source.

Hashes are 64 bits each and always used in pairs.  Keys that very many rows share are reduced by
partial aggregation before they are shuffled; joins on them have one row for each key on one side, a
stage table, so that adaptive execution can split the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.common import _SPACE, BYTE_VALUE, chunks, mix, powers, prefix_hash, span_hash, stage, word_hashes, word_spans

_U = np.uint64
_LENGTH = _U(0x9E3779B97F4A7C15)
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


#: A document of more bytes is worked on in parts, so that memory stays bounded.
LONG_BYTES = 4 << 20
#: Bytes of shorter documents that are taken together.
CHUNK = 1 << 19
#: One run in so many ends a chain; a chain without such a run ends after ``LONGEST_CHAIN`` runs.
CHAIN, LONGEST_CHAIN = 16, 128


def word_units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(data) <= LONG_BYTES:
        start, end, rows = word_spans(data, off)
        return word_hashes(data, start, end), rows
    parts, at = [], 0  # one long document: parts end after a separator
    while at < len(data):
        to = min(at + LONG_BYTES, len(data))
        while to < len(data) and not _SPACE[data[to - 1]]:
            to += 1
        start, end, _ = word_spans(data[at:to], np.array([0, to - at]))
        parts.append(word_hashes(data[at:to], start, end))
        at = to
    values = np.concatenate(parts)
    return values, np.array([0, len(values)])


def byte_units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUE[data], off


def parts_of(units: Units, data: np.ndarray, off: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int | None]]:
    """(first unit, units, row offsets, most window starts in a row): a chunk as it is, or one long document
    in parts that overlap by a reach less one.  Where a part ends, a run ends; runs that are cut
    differently in two documents meet as different paths of one minimiser, so their windows are still
    compared."""
    if len(data) <= LONG_BYTES:
        yield 0, *units(data, off), None
        return
    by_byte = units.__name__ == "byte_units"
    values = data if by_byte else units(data, off)[0]
    for lo in range(0, len(values), LONG_BYTES):
        part = values[lo : lo + LONG_BYTES + reach - 1]
        yield lo, BYTE_VALUE[part] if by_byte else part, np.array([0, len(part)]), LONG_BYTES


class Runs(NamedTuple):
    """Of each run: row, minimiser hash, content hash, first window, number of windows; of each chain: its
    first run, content hash, number of windows."""

    row: np.ndarray
    a: np.ndarray
    u: np.ndarray
    s: np.ndarray
    n: np.ndarray
    begin: np.ndarray
    chain_u: np.ndarray
    covers: np.ndarray


def window_runs(values: np.ndarray, off: np.ndarray, window: int, gram: int, reach: int | None = None, most: int | None = None) -> Runs:
    """The runs of a chunk, and the chains that they form.  The content of a run goes as far as ``reach``
    (a window, if not given) from its last start, or to the end of the row; ``most`` bounds the starts."""
    reach = reach or window
    n = len(values)
    lens = np.diff(off)
    long = np.flatnonzero(lens >= window)
    if not len(long):
        return Runs(*[np.zeros(0, np.int64)] * 8)
    prefix = prefix_hash(values)
    _, down = powers(n + 1)
    grams = mix((prefix[gram:] - prefix[:-gram]) * down[: n - gram + 1])
    m = len(grams)
    low = (grams & _U(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    width, span = window - gram + 1, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    count = m - width + 1
    low = np.minimum(low[:count], low[width - span : width - span + count])
    step = np.zeros(count + 1, dtype=np.int8)
    step[off[long]] += 1
    stop = off[long + 1] - window + 1
    step[stop if most is None else np.minimum(stop, off[long] + most)] -= 1
    at = np.flatnonzero(np.cumsum(step[:-1], dtype=np.int8))
    place = (low[at] & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    size = np.diff(np.append(first, len(at)))
    s = at[first]
    row = np.searchsorted(off, s, side="right") - 1
    to = np.minimum(s + size - 1 + reach, off[row + 1])
    u = mix(span_hash(prefix, s, to) + size.astype(np.uint64) + (to - s).astype(np.uint64) * _LENGTH)
    a = grams[place[first]]
    # chains: runs that follow each other in one document, up to one whose minimiser ends the chain
    ends = (mix(a) % _U(CHAIN) == 0) | np.append(row[1:] != row[:-1], True)
    begin = np.concatenate(([0], np.flatnonzero(ends)[:-1] + 1))
    long_ = np.diff(np.append(begin, len(a)))
    if (long_ > LONGEST_CHAIN).any():
        begin = np.concatenate([np.arange(b, b + k, LONGEST_CHAIN) for b, k in zip(begin, long_, strict=True)])
    last = np.append(begin[1:], len(a)) - 1
    covers = s[last] + size[last] - s[begin]
    chain_u = mix(span_hash(prefix, s[begin], to[last]) + covers.astype(np.uint64) + (to[last] - s[begin]).astype(np.uint64) * _LENGTH)
    return Runs(row, a.view(np.int64), u.view(np.int64), s - off[row], size, begin, chain_u.view(np.int64), covers)


#: The fields of a run in a chain's list.
_RUN = T.StructType([T.StructField("a", T.LongType()), T.StructField("u", T.LongType()), T.StructField("s", T.IntegerType()), T.StructField("n", T.IntegerType())])


def chains(docs: DataFrame, units: Units, window: int, gram: int, reach: int | None = None) -> DataFrame:
    """(doc_id, rk, a, u, s, n, runs): ``docs``: doc_id, rk, text."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("rk", T.LongType()), *_RUN.fields, T.StructField("runs", T.ArrayType(_RUN))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, data, off in chunks(batch, "text", CHUNK):
                for first, values, rows, most in parts_of(units, data, off, reach or window):
                    r = window_runs(values, rows, window, gram, reach, most)
                    if not len(r.row):
                        continue
                    pick = pa.array(r.row[r.begin] + lo)
                    start = pa.array((r.s + first).astype(np.int32))
                    each = pa.StructArray.from_arrays([pa.array(r.a), pa.array(r.u), start, pa.array(r.n.astype(np.int32))], names=["a", "u", "s", "n"])
                    held = pa.ListArray.from_arrays(pa.array(np.append(r.begin, len(r.row)).astype(np.int32)), each)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pick), batch.column(1).take(pick), pa.array(r.a[r.begin]), pa.array(r.chain_u), start.take(pa.array(r.begin)), pa.array(r.covers.astype(np.int32)), held],
                        names=["doc_id", "rk", "a", "u", "s", "n", "runs"],
                    )

    return docs.select("doc_id", "rk", "text").mapInArrow(scan, schema)


def lists(batch: pa.RecordBatch, column: str):
    """The offsets and the flattened struct fields of a list-of-struct column, nulls as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = np.zeros(len(col), dtype=np.int64)
    sizes[:] = np.asarray(col.value_lengths().fill_null(0))
    off = np.concatenate(([0], np.cumsum(sizes)))
    flat = col.flatten()
    return off, {flat.type.field(i).name: flat.field(i) for i in range(flat.type.num_fields)}


def _long_window_rows(batch: pa.RecordBatch, at: int, data: np.ndarray, units: Units, window: int, items: np.ndarray, a, u, s, n) -> Iterator[pa.RecordBatch]:
    """The rows of one long document: each run is hashed by itself."""
    by_byte = units.__name__ == "byte_units"
    values = data if by_byte else units(data, np.array([0, len(data)]))[0]
    for k in items:
        size = int(n[k])
        part = values[s[k] : s[k] + size + window - 1]
        prefix = prefix_hash(BYTE_VALUE[part] if by_byte else part)
        o = np.arange(size)
        w = span_hash(prefix, o, o + window)
        doc = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(np.repeat(at, size)))
        yield pa.RecordBatch.from_arrays([doc, pa.array(np.repeat(a[k], size)), pa.array(np.repeat(u[k], size)), pa.array(o.astype(np.int32)), pa.array(w.view(np.int64))], names=["doc_id", "a", "u", "o", "w"])


def window_rows(batch: pa.RecordBatch, units: Units, window: int, keep: str | None = None) -> Iterator[pa.RecordBatch]:
    """(a, u, o, w): the hash of each window of the runs listed in ``need``."""
    data_off = chunks(batch, "text", CHUNK)
    off, need = lists(batch, "need")
    pick = np.asarray(need[keep]) if keep else np.ones(off[-1], dtype=bool)
    a, u, s, n = (np.asarray(need[k]) for k in "ausn")
    for lo, data, rows_off in data_off:
        if len(data) > LONG_BYTES:
            yield from _long_window_rows(batch, lo, data, units, window, np.arange(off[lo], off[lo + 1])[pick[off[lo] : off[lo + 1]]], a, u, s, n)
            continue
        values, rows = units(data, rows_off)
        prefix = prefix_hash(values)
        hi = lo + len(rows_off) - 1
        item = np.arange(off[lo], off[hi])
        item = item[pick[item]]
        if not len(item):
            continue
        row = np.searchsorted(off, item, side="right") - 1
        size = n[item].astype(np.int64)
        o = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(rows[row - lo] + s[item], size) + o
        w = span_hash(prefix, at, at + window)
        each = np.repeat(item, size)
        doc = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(np.repeat(row, size)))
        yield pa.RecordBatch.from_arrays([doc, pa.array(a[each]), pa.array(u[each]), pa.array(o.astype(np.int32)), pa.array(w.view(np.int64))], names=["doc_id", "a", "u", "o", "w"])


class RepeatedSpans:
    """Windows that occur elsewhere, for one choice of units.

    ``earlier_only``: a window counts if it also starts in a document with a smaller doc_id;
    else if it also starts anywhere else, in the same document included.  ``reach``: the length that is
    looked for, where minimisers belong to shorter windows, which are reported too (``near``).
    """

    def __init__(self, units: Units, window: int, gram: int, earlier_only: bool, reach: int | None = None):
        self.units, self.window, self.gram, self.earlier_only, self.reach = units, window, gram, earlier_only, reach or window

    def shared_runs(self, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(occurrences of chains that repeat whole and go; runs whose minimiser occurs twice or more;
        paths): three stage tables.

        Runs are taken from all other chains and, so that these can be compared with what goes, from the
        place that a repeated chain is kept for: its least document, or its least occurrence."""
        every = stage(chains(docs, self.units, self.window, self.gram, self.reach), "chains")
        if self.earlier_only:
            every = every.filter(F.col("doc_id").isNotNull())
        place = F.struct("doc_id", "rk", "s")
        seen = every.groupBy("a", "u").agg(F.count("*").alias("c"), F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"), F.min(place).alias("at"))
        trunks = stage(seen.filter("d0 < d1" if self.earlier_only else "c > 1").select("a", "u", F.col("d0" if self.earlier_only else "at").alias("kept")), "trunks")
        goes = F.col("kept").isNotNull() & (F.col("doc_id") > F.col("kept") if self.earlier_only else F.lit(True))
        dealt = every.join(trunks, ["a", "u"], "left").withColumn("goes", goes)
        stays = ~F.col("goes") if self.earlier_only else F.col("kept").isNull() | place.eqNullSafe(F.col("kept"))
        dealt = stage(dealt.select("doc_id", "rk", "s", "n", "goes", F.when(stays, F.col("runs")).alias("runs")), "dealt")
        gone = dealt.filter("goes").drop("runs", "goes")
        every = dealt.filter("runs IS NOT NULL").select("doc_id", "rk", F.inline("runs"))
        twice = stage(every.groupBy("a").agg(F.count("*").alias("c")).filter("c > 1").select("a"), "twice")
        shared = stage(every.join(twice, "a"), "shared")
        paths = stage(
            shared.groupBy("a", "u").agg(F.count("*").alias("c"), F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"), F.min(F.struct("doc_id", "rk", "s")).alias("at"), F.max("n").alias("n")),
            "paths",
        )
        return gone, shared, paths

    def branching(self, paths: DataFrame) -> DataFrame:
        """For each minimiser through which several paths pass: a, and their number."""
        found = paths.groupBy("a").agg(F.count("*").alias("n_paths"), F.min("d0").alias("lo"), F.max("d1").alias("hi")).filter("n_paths > 1")
        return stage((found.filter("lo < hi") if self.earlier_only else found).select("a", "n_paths"), "branching")

    def with_sources(self, docs: DataFrame, need: DataFrame) -> DataFrame:
        """The documents in which the first occurrences of ``need`` lie, with those as a list."""
        by_doc = need.groupBy(F.col("at.doc_id").alias("need_doc"), F.col("at.rk").alias("need_rk")).agg(F.collect_list(F.struct("a", "u", F.col("at.s").alias("s"), "n", *[c for c in need.columns if c == "hot"])).alias("need"))
        d = docs.select("doc_id", "rk", "text")
        return d.join(by_doc, d["doc_id"].eqNullSafe(by_doc["need_doc"]) & (d["rk"] == by_doc["need_rk"])).select("doc_id", "rk", "text", "need")

    def window_schema(self, docs: DataFrame) -> T.StructType:
        return T.StructType([docs.schema["doc_id"], T.StructField("a", T.LongType()), T.StructField("u", T.LongType()), T.StructField("o", T.IntegerType()), T.StructField("w", T.LongType())])

    def repeated_windows(self, rows: DataFrame) -> DataFrame:
        """(a, u, pieces) of the windows in ``rows`` (a stage table) that occur elsewhere: spans from the
        run's start."""
        if self.earlier_only:
            least = rows.groupBy("a", "w").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
            hits = rows.join(stage(least, "least"), ["a", "w"]).filter(F.col("doc_id") > F.col("lo"))
        else:
            twice = rows.groupBy("a", "w").agg(F.count("*").alias("c")).filter("c > 1")
            hits = rows.join(stage(twice, "twice"), ["a", "w"])
        return hits.groupBy("a", "u").agg(F.collect_set(F.struct(F.col("o").alias("b"), (F.col("o") + self.reach).alias("e"))).alias("pieces"))

    def document_spans(self, gone: DataFrame, shared: DataFrame, paths: DataFrame, flags: DataFrame, near: bool = False) -> DataFrame:
        """(span_doc, span_rk, spans): the covered spans [b, e) of each document, in units; the end of one
        that covers a whole run may lie beyond that of its document.  ``flags``: (a, u, pieces), and with
        ``near`` also near: spans of the shorter windows, which come out as a column of that name."""
        whole: Column = (F.col("d0") < F.col("d1")) if self.earlier_only else (F.col("c") > 1)
        kinds = {"spans": ("pieces", self.reach), **({"near": ("near", self.window)} if near else {})}
        some = F.col("pieces").isNotNull() | F.col("near").isNotNull() if near else F.col("pieces").isNotNull()
        marks = paths.join(flags, ["a", "u"], "left").withColumn("whole", F.coalesce(whole, F.lit(False))).filter(F.col("whole") | some).select("a", "u", "d0", "whole", *[k for k, _ in kinds.values()])
        hit = shared.join(stage(marks, "marks"), ["a", "u"])
        full = F.col("whole") & (F.col("doc_id") > F.col("d0")) if self.earlier_only else F.col("whole")
        one = lambda length: F.array(F.struct(F.col("s").alias("b"), (F.col("s") + F.col("n") + (length - 1)).alias("e")))
        parts = lambda name: F.transform(F.coalesce(name, F.expr("array()")), lambda x: F.struct((F.col("s") + x["b"]).alias("b"), (F.col("s") + x["e"]).alias("e")))
        found = hit.select("doc_id", "rk", *[F.when(full, one(length)).otherwise(parts(name)).alias(kind) for kind, (name, length) in kinds.items()])
        trunks = gone.select("doc_id", "rk", *[one(length).alias(kind) for kind, (_, length) in kinds.items()])
        any_ = F.size("spans") + F.size("near") if near else F.size("spans")
        return found.filter(any_ > 0).unionByName(trunks).groupBy(F.col("doc_id").alias("span_doc"), F.col("rk").alias("span_rk")).agg(*[F.flatten(F.collect_list(kind)).alias(kind) for kind in kinds])


def merged(b: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted maximal spans: overlapping or touching ones become one."""
    if not len(b):
        return b, e
    order = np.argsort(b, kind="stable")
    b, e = b[order], np.maximum.accumulate(e[order])
    first = np.concatenate(([True], b[1:] > e[:-1]))
    last = np.append(np.flatnonzero(first)[1:] - 1, len(b) - 1)
    return b[first], e[last]


def attach_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every document once, with its spans (null if none)."""
    return docs.join(spans, docs["doc_id"].eqNullSafe(spans["span_doc"]) & (docs["rk"] == spans["span_rk"]), "left").drop("span_doc", "span_rk")


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and ``rk``, which tells rows of one doc_id apart by their text."""
    return documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("rk", F.xxhash64("text"))
