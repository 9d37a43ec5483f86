"""Suffix-array dedup: exact removal of repeated byte strings.

A byte goes if a string of ``least`` bytes (400) that covers it also starts anywhere else, in the
same document or in another; strings lie inside one document and are judged on the input.  Shorter
repeats, from ``short`` bytes (280) on, stay and are reported: a passage of some fifty words often has
fewer than 400 bytes.

Runs of short strings with one minimiser (:mod:`pairforge.llm.spans`), each with the bytes up to the end
of the long strings that start in it, narrow the search to places where a minimiser occurs twice.  A
run or chain that occurs twice as a whole is repeated; where different runs share a minimiser, their
bytes are gathered by minimiser into collections of about ``COLLECTION_BYTES``, and the Burrows-Wheeler
transform of each collection is expanded breadth first (:mod:`pairforge.llm.bwt`): common prefixes come
out by increasing length, the short ones on the way, and the expansion stops at ``least``.  A minimiser
with more than ``MOST_RUNS`` different runs, too many for one collection, has its strings compared by
hash instead, which Spark can split over tasks.

Defined cases: null text is empty; a null doc_id is a document like any other; a row that occurs
twice repeats all of its strings of 400 bytes; a very long text is searched in overlapping parts, with
the result of the whole; an empty table gives no row.  Columns other than ``doc_id`` and ``text`` pass through, except for those named
like a result column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.bwt import repeated_starts
from pairforge.llm.common import BYTE_VALUE, prefix_hash, span_hash, stage
from pairforge.llm.spans import RepeatedSpans, attach_spans, byte_units, keyed, lists, merged

LEAST, SHORT = 400, 280
GRAM = 48
COLLECTION_BYTES = 1 << 19
#: Bytes of runs in one batch of rows.
GATHERED_BYTES = 4 << 20
#: A run has at most LEAST + SHORT - GRAM bytes, so the largest collection has about 1.3 MB more than that.
MOST_RUNS = 2048


def _search(least: int, short: int) -> RepeatedSpans:
    return RepeatedSpans(byte_units, min(short, least), min(GRAM, short, least), False, least)


def _gather(docs: DataFrame, least: int, short: int):
    """For branching runs their bytes; for those of minimisers with very many runs, the hashes of their
    strings of both lengths (``o``: offset in the run; short strings are marked by ~offset)."""
    schema = T.StructType([*_search(least, short).window_schema(docs), T.StructField("n", T.IntegerType()), T.StructField("bytes", T.BinaryType())])
    names = [f.name for f in schema.fields]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, need = lists(batch, "need")
            hot = np.asarray(need["hot"].cast(pa.int8())).astype(bool)
            a, u, s, n = (np.asarray(need[k]) for k in "ausn")
            ids, texts = batch.column(batch.schema.get_field_index("doc_id")), batch.column(batch.schema.get_field_index("text"))
            items: list[int] = []
            rows: list[int] = []
            held: list[bytes] = []
            size = 0

            def flush() -> pa.RecordBatch:
                none = pa.nulls(len(items))
                return pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(a[items]), pa.array(u[items]), none.cast(pa.int32()), none.cast(pa.int64()), pa.array(n[items].astype(np.int32)), pa.array(held, pa.binary())], names=names)

            for i in range(len(texts)):
                mine = range(off[i], off[i + 1])
                if not len(mine):
                    continue
                data = texts[i].as_py().encode()
                for k in (k for k in mine if not hot[k]):
                    items.append(k)
                    rows.append(i)
                    held.append(data[s[k] : s[k] + n[k] + least - 1])
                    size += len(held[-1])
                if size >= GATHERED_BYTES:
                    yield flush()
                    items, rows, held, size = [], [], [], 0
                for k in (k for k in mine if hot[k]):
                    part = np.frombuffer(data[s[k] : s[k] + n[k] + least - 1], np.uint8)
                    prefix = prefix_hash(BYTE_VALUE[part])
                    for length, mark in ((least, False), (short, True)):
                        o = np.arange(min(int(n[k]), len(part) - length + 1))
                        if not len(o):
                            continue
                        w = span_hash(prefix, o, o + length)
                        each = np.full(len(o), k)
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(np.full(len(o), i))), pa.array(a[each]), pa.array(u[each]), pa.array((~o if mark else o).astype(np.int32)), pa.array(w.view(np.int64)), pa.array(n[each].astype(np.int32)), pa.nulls(len(o), pa.binary())],
                            names=names,
                        )
            if items:
                yield flush()

    return scan, schema


_SPAN = pa.struct([("b", pa.int32()), ("e", pa.int32())])


def _ranges(starts: np.ndarray, length: int) -> list[dict[str, int]]:
    """Starts of strings of one length as the spans that they cover, neighbours joined."""
    if not len(starts):
        return []
    first = np.flatnonzero(np.concatenate(([True], starts[1:] > starts[:-1] + 1)))
    last = np.append(first[1:], len(starts)) - 1
    return [{"b": int(x), "e": int(y) + length} for x, y in zip(starts[first], starts[last], strict=True)]


def _expand(least: int, short: int):
    """Runs in order of their minimiser -> (a, u, pieces, near): what is repeated of each."""

    def one(group: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        near, far = repeated_starts([g[3] for g in group], *((short, least) if short < least else (least,) * 2), starts=[g[2] for g in group])
        rows = [(g[0], g[1], _ranges(y, least), _ranges(x, short)) for g, x, y in zip(group, near, far, strict=True)]
        rows = [r for r in rows if r[2] or r[3]]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(_SPAN)), pa.array([r[3] for r in rows], pa.list_(_SPAN))],
            names=["a", "u", "pieces", "near"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int, int, int, bytes]] = []
        held = 0
        for batch in batches:
            for a, u, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held >= COLLECTION_BYTES and group[-1][0] != a:
                    yield one(group)
                    group, held = [], 0
                group.append((a, u, n, data))
                held += len(data)
        if group:
            yield one(group)

    return scan


def repeated_spans(documents: DataFrame, least: int = LEAST, most_runs: int = MOST_RUNS, short: int = SHORT) -> DataFrame:
    """(span_doc, span_rk, spans, near): covered byte spans of the documents that have any, by strings of
    ``least`` bytes and by those of ``short`` bytes."""
    short = min(short, least)
    docs = keyed(documents)
    search = _search(least, short)
    gone, shared, paths = search.shared_runs(docs)
    need = paths.join(search.branching(paths), "a").withColumn("hot", F.col("n_paths") > most_runs)
    scan, schema = _gather(docs, least, short)
    gathered = stage(search.with_sources(docs, need).mapInArrow(scan, schema), "gathered")
    cold = gathered.filter(F.col("bytes").isNotNull()).select("a", "u", "n", "bytes").repartition("a").sortWithinPartitions("a", "u")
    spans = "array<struct<b:int,e:int>>"
    expanded = cold.mapInArrow(_expand(least, short), f"a long, u long, pieces {spans}, near {spans}")
    rows = gathered.filter(F.col("bytes").isNull()).select("a", "u", "o", "w", (F.col("o") < 0).alias("brief"))
    twice = stage(rows.groupBy("a", "brief", "w").agg(F.count("*").alias("c")).filter("c > 1").drop("c"), "twice")
    span = lambda o, length: F.struct(o.alias("b"), (o + length).alias("e"))
    hashed = rows.join(twice, ["a", "brief", "w"]).groupBy("a", "u").agg(
        F.collect_set(F.when(~F.col("brief"), span(F.col("o"), least))).alias("pieces"), F.collect_set(F.when(F.col("brief"), span(F.bitwise_not("o"), short))).alias("near")
    )
    return search.document_spans(gone, shared, paths, expanded.unionByName(hashed), near=True)


def remove_repeats(documents: DataFrame, least: int = LEAST, most_runs: int = MOST_RUNS, short: int = SHORT) -> DataFrame:
    """The documents with ``n_bytes``, ``n_removed``, ``n_spans``, ``n_repeated`` (bytes covered by strings of
    ``short`` bytes that also start elsewhere), ``spans`` (maximal, in bytes) and ``kept``: the bytes that
    stay (a cut may fall inside a character)."""
    spans = repeated_spans(documents, least, most_runs, short)
    results = ("n_bytes", "n_removed", "n_spans", "n_repeated", "spans", "kept")
    docs = documents.drop(*results, "rk", "near", "span_doc", "span_rk").withColumn("rk", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    joined = attach_spans(docs, spans)
    span_type = T.ArrayType(T.StructType([T.StructField("b", T.IntegerType()), T.StructField("e", T.IntegerType())]))
    passed = [f for f in joined.schema.fields if f.name not in ("rk", "spans", "near")]
    long = T.LongType()
    schema = T.StructType([*passed, *(T.StructField(n, long) for n in results[:4]), T.StructField("spans", span_type), T.StructField("kept", T.BinaryType())])
    names = [f.name for f in passed]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, b_all, e_all = _flat(batch, "spans")
            brief, b_brief, e_brief = _flat(batch, "near")
            total, gone, short_, pieces, kept = [], [], [], [], []
            for i, text in enumerate(batch.column(batch.schema.get_field_index("text"))):
                data = (text.as_py() or "").encode()
                n = len(data)
                b, e = b_all[at[i] : at[i + 1]], e_all[at[i] : at[i + 1]]
                inside = b + least <= n  # a run at the end of its document may have no string of this length
                b, e = merged(b[inside], np.minimum(e[inside], n))
                left = data
                if len(b):
                    cuts = [0, *np.column_stack((b, e)).ravel().tolist(), n]
                    left = b"".join(data[cuts[k] : cuts[k + 1]] for k in range(0, len(cuts), 2))
                x, y = merged(b_brief[brief[i] : brief[i + 1]], np.minimum(e_brief[brief[i] : brief[i + 1]], n))
                total.append(n)
                gone.append(n - len(left))
                short_.append(int((y - x).sum()))
                pieces.append([{"b": int(p), "e": int(q)} for p, q in zip(b, e, strict=True)])
                kept.append(left)
            counts = (total, gone, [len(p) for p in pieces], short_)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(n)) for n in names), *(pa.array(c, pa.int64()) for c in counts), pa.array(pieces, pa.list_(_SPAN)), pa.array(kept, pa.binary())], names=[*names, *results]
            )

    return joined.select(*names, "spans", "near").mapInArrow(cut, schema)


def _flat(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of a list of spans, and all their begins and ends."""
    at, found = lists(batch, column)
    return at, np.asarray(found["b"]).astype(np.int64), np.asarray(found["e"]).astype(np.int64)
