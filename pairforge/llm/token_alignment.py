"""Alignment of two tokenizers over the same bytes, by DuckDB inside each Arrow partition.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library and reads space + text; B is a SentencePiece model
and reads the text, before which it puts a space.  Both then cover the same bytes.  Offsets where a token of each ends cut
the tokens into groups.

Inside a task, texts are cut before white space, where neither tokenizer joins characters (this is checked on both vocabularies;
texts with white space other than blanks and line ends are taken whole).  The *different* pieces of a chunk are tokenized once
and become two interval tables, (token, start, end) over the bytes laid end to end.  DuckDB aligns the tables: an ASOF join finds for
each token the first token of the other side that ends with it or later, a window sum over equal ends numbers the groups, and a
join on ends (or, for overlaps, on group and ranges) gives the links.  A document is put together from its pieces.

Links are counted in three steps: DuckDB counts id pairs inside each Arrow batch, Spark merges these partial counts, and
the counts go back to the documents' links: as a broadcast while the counted number of different pairs is at most
``BROADCAST_PAIRS``, beyond that by a Spark join.

Defined cases: a null or empty text, or one whose joined tokens differ from space + text, has no tokens: zeros and an empty
string; texts of any length are tokenized whole; repeated rows count like others; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.common import stage

#: Characters of text that are aligned at a time; bounds the memory of a task.  One longer text is taken alone.
CHUNK_CHARS = 1 << 20
#: Pieces whose alignment a task keeps (some 100 MB): two halves, the older of which goes when the newer one is full.
KEPT_PIECES = 240_000
#: Bytes of pieces that are tokenized in one call.
BLOCK_BYTES = 1 << 14
#: Different id pairs whose counts are broadcast, 16 bytes each.
BROADCAST_PAIRS = 4_000_000
#: Links of a batch whose pairs are counted together.
COUNT_LINKS = 1 << 22

LINKED = {"end": "a.e = b.e", "overlap": "a.g = b.g AND a.s < b.e AND b.s < a.e"}

_ALIGN = """
WITH a0 AS (
  SELECT a.i, a.id, a.s, a.e, (a.e = b.e)::INT AS cut FROM a ASOF JOIN b ON a.e <= b.e
), b0 AS (
  SELECT b.i, b.id, b.s, b.e, (a.e = b.e)::INT AS cut FROM b ASOF JOIN a ON b.e <= a.e
)
SELECT 'a' AS side, i, id, s, e, sum(cut) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) - cut AS g FROM a0
UNION ALL
SELECT 'b', i, id, s, e, sum(cut) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) - cut FROM b0
"""


def _plain_bytes() -> dict[str, int]:
    """The characters by which byte-level tokenizers write bytes: printable ones stand for themselves, the others
    follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class _Tokenizers:
    """Both tokenizers, the bytes of their ids, and whether texts may be cut before white space."""

    def __init__(self, source_a: str, source_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(source_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=source_b)
        of_char = _plain_bytes()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(of_char[c] for c in token) if all(c in of_char for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        definition = json.loads(source_a)
        model, before = definition["model"], definition.get("pre_tokenizer") or {}
        splits = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not definition.get("normalizer")
        joins = any("\n" in p or "▁" in p.lstrip("▁") for p in pieces)
        mark = [self.b.piece_to_id("▁"), *self.b.encode("\n")[1:]]
        self.cuts = bool(splits and not joins and self.b.encode("\n") == mark and len(mark) == 2)
        # merges in the order of their ids are ranks, which tiktoken takes: faster for pieces of ASCII, where both read the same classes of characters
        self.ranks = None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        order = [vocabulary.get(x + y, -1) for x, y in merges]
        if self.cuts and model.get("type") == "BPE" and not model.get("ignore_merges") and order == sorted(order) and min(order, default=-1) >= 256:
            ranks = {self.bytes_a[i]: i for token, i in model["vocab"].items() if all(c in of_char for c in token) and i <= order[-1]}
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
            if len(ranks) == order[-1] + 1:
                self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def whole(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for texts that begin with the space before them."""
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)], self.b.encode([x[1:] for x in texts], num_threads=1)

    def pieces(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for pieces cut before white space.  A line end before a piece keeps away the space that B puts before a text."""
        return [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)], [ids[2:] for ids in self.b.encode(["\n" + p for p in pieces], num_threads=1)]

    def blocks(self, blocks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of both for pieces joined to blocks: no token reaches over the cut between two pieces."""
        if self.ranks is not None and all(map(str.isascii, blocks)):
            of_a = map(self.ranks.encode_ordinary, blocks)
        else:
            of_a = (e.ids for e in self.a.encode_batch_fast(blocks, add_special_tokens=False))
        of_b = (ids[2:] for ids in self.b.encode(["\n" + x for x in blocks], num_threads=1))
        return tuple(np.concatenate([np.zeros(0, np.int64), *[np.array(x, np.int64) for x in of]]) for of in (of_a, of_b))


def _lengths(texts: list[str]) -> np.ndarray:
    """The UTF-8 bytes of each text."""
    return np.fromiter((len(x) if x.isascii() else len(x.encode()) for x in texts), np.int64, len(texts))


class _Aligner:
    """Documents to (n_a, n_b, n_groups, groups, links), through one DuckDB connection."""

    def __init__(self, tokenizers: _Tokenizers, linked: str):
        import duckdb

        self.t, self.linked = tokenizers, LINKED[linked]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.db.execute("SET preserve_insertion_order = false")
        self.type = np.dtype("<u2") if max(len(tokenizers.bytes_a), len(tokenizers.bytes_b)) <= 1 << 16 else np.dtype("<u4")
        def names(n: int, after: str) -> np.ndarray:
            return np.array([f"{i}{after}" for i in range(n)], dtype=object)

        n_a, n_b = len(tokenizers.bytes_a), len(tokenizers.bytes_b)
        self.inside_a, self.end_a, self.inside_b, self.end_b = names(n_a, ","), names(n_a, "|"), names(n_b, ","), names(n_b, ";")
        self.known: dict[str, tuple[int, str, bytes] | None] = {}
        self.before: dict[str, tuple[int, str, bytes] | None] = {}
        self.other_space = re.compile(r"[^\S \n]|[\x1c-\x1f]").search

    def aligned_pieces(self, pieces: list[str]) -> dict[str, tuple[int, str, bytes] | None]:
        """The alignment of each piece.  Pieces are tokenized in blocks and told apart by their bytes; those that end with
        white space, or hold B's own mark for a blank, alone."""
        out: dict[str, tuple[int, str, bytes] | None] = {}
        joined = [p for p in pieces if p[-1] not in " \n" and "▁" not in p]
        if len(joined) < len(pieces):
            alone = list(set(pieces).difference(joined))
            out.update(zip(alone, self.align(alone, *self.t.pieces(alone)), strict=True))
        for some in ([p for p in joined if p.isascii()], [p for p in joined if not p.isascii()]):
            if not some:
                continue
            length = _lengths(some)
            end = np.cumsum(length)
            cut = [0, *(np.flatnonzero(np.diff(end // BLOCK_BYTES)) + 1).tolist(), len(some)]
            flat = dict(zip("ab", self.t.blocks(["".join(some[lo:hi]) for lo, hi in zip(cut, cut[1:], strict=False)]), strict=True))
            counts = {}
            for s, size in (("a", self.t.size_a), ("b", self.t.size_b)):
                ends = np.cumsum(size[flat[s]])
                at = np.searchsorted(ends, end)
                if not len(ends) or at[-1] >= len(ends) or not np.array_equal(ends[at], end):
                    break
                counts[s] = np.diff(at, prepend=-1)
            if len(counts) == 2 and self.equal("".join(some).encode(), length, flat, counts):
                out.update(zip(some, self.grouped(flat, counts), strict=True))
            else:
                out.update(zip(some, self.align(some, *self.t.pieces(some)), strict=True))
        return out

    def equal(self, data: bytes, length: np.ndarray, flat: dict[str, np.ndarray], counts: dict[str, np.ndarray]) -> bool:
        """Whether the tokens of each text make up its bytes, on both sides."""
        for s, size, of in (("a", self.t.size_a, self.t.bytes_a), ("b", self.t.size_b, self.t.bytes_b)):
            ends = np.concatenate([[0], np.cumsum(size[flat[s]])])[np.concatenate([[0], np.cumsum(counts[s])])]
            if not np.array_equal(np.diff(ends), length) or b"".join(map(of.__getitem__, flat[s].tolist())) != data:
                return False
        return True

    def align(self, texts: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> list[tuple[int, str, bytes] | None]:
        """For each text: tokens of A, and of B times 2**32; the groups, each ended by ``;``; the links' ids.  None where the
        tokens' bytes differ from the text."""
        if not texts:
            return []
        flat = {s: np.fromiter(chain.from_iterable(ids), np.int64) for s, ids in (("a", ids_a), ("b", ids_b))}
        counts = {s: np.fromiter(map(len, ids), np.int64, len(ids)) for s, ids in (("a", ids_a), ("b", ids_b))}
        if self.equal("".join(texts).encode(), _lengths(texts), flat, counts):
            return self.grouped(flat, counts)
        t, out = self.t, [None] * len(texts)  # some differ: the others go on without them
        same = [k for k, x in enumerate(texts) if b"".join(map(t.bytes_a.__getitem__, ids_a[k])) == x.encode() == b"".join(map(t.bytes_b.__getitem__, ids_b[k]))]
        for k, got in zip(same, self.align([texts[k] for k in same], [ids_a[k] for k in same], [ids_b[k] for k in same]), strict=True):
            out[k] = got
        return out

    def grouped(self, flat: dict[str, np.ndarray], counts: dict[str, np.ndarray]) -> list[tuple[int, str, bytes]]:
        """:meth:`align` for texts whose tokens make up their bytes: all ids of a side in a row, and each text's number of them."""
        for s, size in (("a", self.t.size_a), ("b", self.t.size_b)):
            end = np.cumsum(size[flat[s]])
            self.db.register(s, pa.table({"i": np.arange(len(end), dtype=np.int32), "id": flat[s].astype(np.int32), "s": (end - size[flat[s]]).astype(np.int32), "e": end.astype(np.int32)}))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE grouped AS {_ALIGN}")
        group = {}
        for s in flat:
            got = self.db.execute(f"SELECT i, g::INT AS g FROM grouped WHERE side = '{s}'").fetchnumpy()
            group[s] = np.empty(len(flat[s]), np.int64)
            group[s][got["i"]] = got["g"]
        links = self.db.execute(f"SELECT a.i, a.id AS x, b.i AS j, b.id AS y FROM (FROM grouped WHERE side = 'a') a JOIN (FROM grouped WHERE side = 'b') b ON {self.linked}").fetchnumpy()
        links = {k: np.asarray(v) for k, v in links.items()}
        order = np.lexsort((links["j"], links["i"]))
        (a, ga), (b, gb) = (flat["a"], group["a"]), (flat["b"], group["b"])
        # A's tokens of a group come before B's; the last of each is followed by another mark
        merged = np.empty(len(a) + len(b), dtype=object)
        last_a, last_b = np.append(ga[1:] != ga[:-1], True), np.append(gb[1:] != gb[:-1], True)
        merged[np.arange(len(a)) + np.searchsorted(gb, ga, "left")] = np.where(last_a, self.end_a[a], self.inside_a[a])
        merged[np.arange(len(b)) + np.searchsorted(ga, gb, "right")] = np.where(last_b, self.end_b[b], self.inside_b[b])
        pairs = np.empty((len(order), 2), dtype=self.type)
        pairs[:, 0], pairs[:, 1] = links["x"][order], links["y"][order]
        cut_a = np.concatenate([[0], np.cumsum(counts["a"])])
        cut_all = (cut_a + np.concatenate([[0], np.cumsum(counts["b"])])).tolist()
        width, packed = 2 * self.type.itemsize, pairs.tobytes()
        cut_links = (np.searchsorted(links["i"][order], cut_a) * width).tolist()
        strings, numbers = merged.tolist(), (counts["a"] + (counts["b"] << 32)).tolist()
        return [(numbers[k], "".join(strings[cut_all[k] : cut_all[k + 1]]), packed[cut_links[k] : cut_links[k + 1]]) for k in range(len(numbers))]

    def known_pieces(self, pieces: list[str]) -> list[tuple[int, str, bytes] | None]:
        """The alignments of different pieces; those met before are kept."""
        if len(self.known) > KEPT_PIECES // 2:
            self.before, self.known = self.known, {}
        new = set(pieces).difference(self.known)
        again = new.intersection(self.before)
        self.known.update((p, self.before[p]) for p in again)
        self.known.update(self.aligned_pieces(list(new - again)))
        return list(map(self.known.__getitem__, pieces))

    def documents(self, texts: list[str | None]) -> list[tuple[int, int, int, str, bytes]]:
        """(n_a, n_b, n_groups, groups, links) of each text."""
        out = [(0, 0, 0, "", b"")] * len(texts)
        cut = [k for k, x in enumerate(texts) if x and self.t.cuts and (x.isascii() and x.replace("\n", "").isprintable() or not self.other_space(x))]
        whole = [k for k in {k for k, x in enumerate(texts) if x}.difference(cut)]
        spaced = [" " + texts[k] for k in whole]
        for k, got in zip(whole, self.align(spaced, *self.t.whole(spaced)), strict=True):
            if got:
                out[k] = (got[0] & 0xFFFFFFFF, got[0] >> 32, got[1].count(";"), got[1][:-1], got[2])
        if not cut:
            return out
        spaced = [" " + texts[k] for k in cut]
        data = np.frombuffer("".join(spaced).encode(), np.uint8)
        begin = np.concatenate([[0], np.cumsum(_lengths(spaced))])[:-1]
        white = (data == 0x20) | (data == 0x0A)
        first = white & np.concatenate([[True], ~white[:-1]])
        first[begin] = True
        offsets = np.append(np.flatnonzero(first), len(data)).astype(np.int64)
        # each different piece once; the texts are numbers of pieces
        coded = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        got, of = self.known_pieces(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), coded.indices.to_numpy()
        at = np.searchsorted(offsets, begin)
        bad = np.logical_or.reduceat(np.array([g is None for g in got])[of], at)
        got = [g or (0, "", b"") for g in got]
        n = np.add.reduceat(np.array([g[0] for g in got], np.int64)[of], at).tolist()
        width = 2 * self.type.itemsize
        held = np.frombuffer(b"".join(g[2] for g in got), np.dtype(f"V{width}"))
        size = np.array([len(g[2]) for g in got], np.int64) // width
        from_ = (np.cumsum(size) - size)[of]
        size = size[of]
        upto = np.concatenate([[0], np.cumsum(size)])
        links = held[np.repeat(from_ - upto[:-1], size) + np.arange(upto[-1])].tobytes()
        strings = list(map([g[1] for g in got].__getitem__, of.tolist()))
        ends = [*at.tolist(), len(of)]
        upto = (upto[ends] * width).tolist()
        for d, k in enumerate(cut):
            if not bad[d]:
                groups = "".join(strings[ends[d] : ends[d + 1]])
                out[k] = (n[d] & 0xFFFFFFFF, n[d] >> 32, groups.count(";"), groups[:-1], links[upto[d] : upto[d + 1]])
        return out


def aligned(documents: DataFrame, path_a: str, path_b: str, linked: str = "end") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, links), a row for each document.  ``groups`` is written
    ``a1,a2|b1;a3|b2,b3``; ``links`` holds little-endian pairs of ids, of 16 bits each where both vocabularies allow it, else 32.
    ``linked``: "end" for tokens that end together, "overlap" for tokens that share a byte."""
    spark = documents.sparkSession
    with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:
        sources = spark.sparkContext.broadcast((f.read(), g.read()))
    long = T.LongType()
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), *[T.StructField(n, long) for n in ("n_a", "n_b", "n_groups", "n_links")], T.StructField("groups", T.StringType()), T.StructField("links", T.BinaryType())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # a task keeps some hundred thousand small objects, none in a cycle; looking for cycles took a fourth of its time
        try:
            yield from align_all(batches)
        finally:
            gc.enable()
            gc.collect()

    def align_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner(_Tokenizers(*sources.value), linked)
        width = 2 * aligner.type.itemsize
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            lo = 0
            while lo < len(texts):
                chunk, size = [], 0
                while lo + len(chunk) < len(texts) and (size < CHUNK_CHARS or not chunk):
                    chunk.append(texts[lo + len(chunk)].as_py())
                    size += len(chunk[-1] or "")
                n_a, n_b, n_g, groups, links = zip(*aligner.documents(chunk), strict=True)
                n_l = [len(x) // width for x in links]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, len(chunk)), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_g, n_l)], pa.array(groups, pa.string()), pa.array(links, pa.binary())], names=names)
                lo += len(chunk)

    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _codes(links: pa.Array, width: int) -> np.ndarray:
    """One 64-bit number for each link of a column of links: A's id times 2**32 and B's."""
    pairs = np.frombuffer(b"".join(x.as_py() for x in links), np.dtype(f"<u{width // 2}")).astype(np.int64).reshape(-1, 2)
    return (pairs[:, 0] << 32) | pairs[:, 1]


def _groups_of_rows(batch: pa.RecordBatch, most: int, width: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``most`` links."""
    ends = np.cumsum(batch.column(batch.schema.get_field_index("n_links")).to_numpy())
    lo = 0
    while lo < batch.num_rows:
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")), lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def pair_counts(links: DataFrame, width: int = 4) -> DataFrame:
    """(pair, b, n): how many links of the corpus hold each id pair, and B's id.  DuckDB counts inside Arrow batches,
    Spark merges.  ``width``: bytes of one link."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        for batch in batches:
            for rows in _groups_of_rows(batch, COUNT_LINKS, width):
                db.register("links", pa.table({"pair": _codes(rows.column(rows.schema.get_field_index("links")), width)}))
                yield from db.sql("SELECT pair, count(*)::BIGINT AS n FROM links GROUP BY pair").to_arrow_table().combine_chunks().to_batches()

    counted = links.select("n_links", "links").mapInArrow(partial, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    return counted.select("pair", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "n")


def with_counts(rows: DataFrame, width: int = 4, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``rows`` (a stage table of :func:`aligned`, ``groups`` may be left out) with ``n_best``, the links whose pair has the
    highest count of its B id, and ``count_sum``, the sum of the links' counts."""
    spark = rows.sparkSession
    counts = stage(pair_counts(rows, width), "pairs")
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    pairs = stage(counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "counts")
    if pairs.limit(broadcast_pairs + 1).count() > broadcast_pairs:
        return _joined_counts(rows, pairs, width)
    table = pairs.select("pair", F.when(F.col("best"), -F.col("n")).otherwise(F.col("n")).alias("n")).toArrow().sort_by("pair")
    held = spark.sparkContext.broadcast((table.column("pair").to_numpy(), table.column("n").to_numpy()))
    others = [f for f in rows.schema.fields if f.name != "links"]
    schema = T.StructType([*others, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = held.value
        for batch in batches:
            for part in _groups_of_rows(batch, COUNT_LINKS, width):
                links = part.column(part.schema.get_field_index("links"))
                counts = n[np.searchsorted(keys, _codes(links, width))] if len(keys) else np.zeros(0, np.int64)
                ends = np.concatenate([[0], np.cumsum(part.column(part.schema.get_field_index("n_links")).to_numpy())])
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (counts < 0, np.abs(counts))]
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(f.name)) for f in others], *[pa.array((x[ends[1:]] - x[ends[:-1]]).astype(np.int64)) for x in sums]], names=[f.name for f in schema.fields])

    return rows.mapInArrow(look_up, schema)


def _joined_counts(rows: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """The same by Spark joins: links as rows, counted inside each document before they are shuffled."""
    numbered = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _groups_of_rows(batch, COUNT_LINKS // 8, width):
                sizes = part.column(part.schema.get_field_index("n_links")).to_numpy()
                row = np.repeat(part.column(part.schema.get_field_index("_row")).to_numpy(), sizes)
                both, k = np.unique(np.stack([row, _codes(part.column(part.schema.get_field_index("links")), width)]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), pa.array(k.astype(np.int64))], names=["_row", "pair", "k"])

    links = numbered.select("_row", "n_links", "links").mapInArrow(opened, "_row bigint, pair bigint, k bigint")
    sums = links.join(pairs, "pair").groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"), F.sum(F.col("k") * F.col("n")).alias("count_sum"))
    out = numbered.drop("links").join(sums, "_row", "left").drop("_row")
    return out.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")})
