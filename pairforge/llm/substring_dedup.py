"""Substring dedup over word windows, compacted like the paths of a De Bruijn graph.

The windows of k words (k = 50) of all documents would be the edges of a De Bruijn graph.  No table of edges with node degrees is made, since it
would have a row for each window; what stands for the graph's nonbranching paths is cut inside each document (:mod:`pairforge.llm.spans`):
windows that follow each other and own one minimiser are a run, and runs are cut into chains by content.  Joins on (minimiser, content hash) find
the least document of each chain, then of the runs of chains that don't repeat whole; where different runs meet at one minimiser they are taken
apart into single windows.  Equal content means two equal 64-bit hashes; the text at the source is not compared again.  README.md says why.

A word goes if a window that covers it also starts in a document with a smaller doc_id.

Defined cases: null text has no words; documents of fewer words than a window lose none; a null
doc_id is neither smaller nor larger than another, so its rows lose nothing and take nothing; rows
with one doc_id take nothing from each other; repeated rows come out as often as they went in;
a very long text is searched in overlapping parts, with the result of the whole; an empty table gives no row.
Columns of the input other than ``doc_id`` and ``text`` pass through unchanged, except for those
named like a result column, which the result replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.common import stage
from pairforge.llm.spans import RepeatedSpans, attach_spans, keyed, lists, merged, window_rows, word_units

WINDOW = 50
GRAM = 8


def repeated_spans(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(span_doc, span_rk, spans): covered word spans of the documents that have any."""
    docs = keyed(documents)
    search = RepeatedSpans(word_units, window, min(GRAM, window), earlier_only=True)
    gone, shared, paths = search.shared_runs(docs)
    need = paths.join(search.branching(paths), "a", "left_semi")
    schema = search.window_schema(docs)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from window_rows(batch, word_units, window)

    rows = stage(search.with_sources(docs, need).mapInArrow(edges, schema), "edges")
    return search.document_spans(gone, shared, paths, search.repeated_windows(rows))


def remove_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with ``n_words``, ``n_removed``, ``spans`` (merged, in words) and ``kept``:
    the words that stay, joined by one space."""
    spans = repeated_spans(documents, window)
    results = ("n_words", "n_removed", "spans", "kept")
    docs = documents.drop(*results, "rk", "span_doc", "span_rk").withColumn("rk", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    joined = attach_spans(docs, spans)
    span_type = T.ArrayType(T.StructType([T.StructField("b", T.IntegerType()), T.StructField("e", T.IntegerType())]))
    passed = [f for f in joined.schema.fields if f.name not in ("rk", "spans")]
    schema = T.StructType([*passed, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", span_type), T.StructField("kept", T.StringType())])
    names = [f.name for f in passed]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = lists(batch, "spans")
            b_all, e_all = np.asarray(found["b"]), np.asarray(found["e"])
            total, gone, pieces, kept = [], [], [], []
            for i, text in enumerate(batch.column(batch.schema.get_field_index("text"))):
                words = (text.as_py() or "").encode().split()
                b, e = merged(b_all[at[i] : at[i + 1]], e_all[at[i] : at[i + 1]])
                left = words
                if len(b):
                    edges_ = [0, *np.column_stack((b, e)).ravel().tolist(), len(words)]
                    left = [w for k in range(0, len(edges_), 2) for w in words[edges_[k] : edges_[k + 1]]]
                total.append(len(words))
                gone.append(len(words) - len(left))
                pieces.append([{"b": int(x), "e": int(y)} for x, y in zip(b, e, strict=True)])
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(n)) for n in names), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(pieces, pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())]))), pa.array(kept, pa.string())],
                names=[*names, "n_words", "n_removed", "spans", "kept"],
            )

    return joined.select(*names, "spans").mapInArrow(cut, schema)
