"""SimHash near-duplicates through pivot distance tables.

Fingerprints: 64 bits over the 3-word shingles of the ASCII-lower-cased text (repeats count);
a bit is 1 if it is set in over half of the shingles' XXH64 values.

Fingerprints link at ``RADIUS`` (3) or fewer differing bits.  The search works on the *different*
fingerprints, however many documents share each:

1. Each fingerprint's Hamming distances to ``PIVOTS`` reference fingerprints form its row of the
   distance table.  Two fingerprints within the radius differ by at most the radius in every
   coordinate.
2. Candidate pairs come from blocks: the 64 bits are cut into 6 blocks, and two fingerprints
   within 3 bits agree in at least 3 of them, so each pair meets under one of 20 keys of about 32
   bits.  Pairs whose largest coordinate difference exceeds the radius are discarded, and the
   survivors verified bit by bit.
3. A key that more than ``MOST_UNDER_KEY`` fingerprints share would give a number of pairs that
   grows with the square of the group.  There, every fingerprint is put under all values within
   two bits of it outside the key (those within one are its *near* values).  Two fingerprints within
   3 bits meet at a value that is near to one of them, and the members of a value that has a near
   member are linked to the least near member if verified: rows grow with the group, no link is lost.

Components come from alternating large-star and small-star rounds over the verified links
(:mod:`pairforge.llm.components`), in stage tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.common import stage

RADIUS = 3
PIVOTS = 16
BLOCKS = 6
MOST_UNDER_KEY = 64
SHINGLE = 3
SEED = 42


_U = np.uint64
_P1, _P2, _P3, _P4, _P5 = (_U(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))  # the constants of XXH64


def _turn(x: np.ndarray, r: int) -> np.ndarray:
    return (x << _U(r)) | (x >> _U(64 - r))


def xxh64_slices(data: bytes, start: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of data[start : start + size] for many slices at once.  Slices of under 32 bytes, nearly all
    shingles, take a vectorised form of the public algorithm; longer ones the library."""
    from xxhash import xxh64_intdigest

    padded = data + bytes(8)
    eight = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    four = np.ndarray((len(data) + 1,), np.dtype("<u4"), padded, strides=(1,))
    one = np.frombuffer(padded, np.uint8)
    out = _U(seed) + _P5 + size.astype(_U)
    at, left = start.copy(), size.copy()
    short = size < 32
    for _ in range(3):
        k = np.flatnonzero(short & (left >= 8))
        lane = _turn(eight[at[k]] * _P2, 31) * _P1
        out[k] = _turn(out[k] ^ lane, 27) * _P1 + _P4
        at[k] += 8
        left[k] -= 8
    k = np.flatnonzero(short & (left >= 4))
    out[k] = _turn(out[k] ^ (four[at[k]].astype(_U) * _P1), 23) * _P2 + _P3
    at[k] += 4
    left[k] -= 4
    for _ in range(3):
        k = np.flatnonzero(short & (left >= 1))
        out[k] = _turn(out[k] ^ (one[at[k]].astype(_U) * _P5), 11) * _P1
        at[k] += 1
        left[k] -= 1
    out ^= out >> _U(33)
    out *= _P2
    out ^= out >> _U(29)
    out *= _P3
    out ^= out >> _U(32)
    for i in np.flatnonzero(~short).tolist():
        out[i] = xxh64_intdigest(data[start[i] : start[i] + size[i]], seed)
    return out


#: Shingles whose bits are counted together.
_PART = 1 << 15


def _fingerprints(texts: list[bytes]) -> np.ndarray:
    """The fingerprint of each text (words in lower case, joined by one space; no text is empty)."""
    data = b"\n".join(texts)
    raw = np.frombuffer(data, np.uint8)
    ends = np.append(np.flatnonzero(raw <= 0x20), len(raw))  # joined words hold no other white space
    ends = ends[np.append(np.isin(raw[ends[:-1]], (0x20, 0x0A)), True)]
    begins = np.concatenate(([0], ends[:-1] + 1))
    last = np.append(raw[ends[:-1]] == 0x0A, True)
    doc = np.concatenate(([0], np.cumsum(last[:-1])))
    words = np.bincount(doc, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(words)[:-1]))
    shingles = np.maximum(words - SHINGLE + 1, 1)
    of = np.repeat(np.arange(len(texts)), shingles)
    k = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    to = np.minimum(k + SHINGLE, first[of] + words[of]) - 1
    h = xxh64_slices(data, begins[k], ends[to] - begins[k])
    total = np.zeros((len(texts), 64), dtype=np.int64)
    for lo in range(0, len(h), _PART):
        part, owner = h[lo : lo + _PART], of[lo : lo + _PART]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        head = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        total[owner[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int32)
    return np.packbits(2 * total > shingles[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


#: Bytes of text whose shingles are hashed together; a longer text is taken alone.
_TOGETHER = 1 << 19


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""
    schema = T.StructType([documents.schema["doc_id"], T.StructField("fp", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.zeros(len(batch), dtype=np.uint64)
            rows: list[int] = []
            texts: list[bytes] = []
            held = 0

            def flush() -> None:
                if rows:
                    fp[rows] = _fingerprints(texts)

            for i, text in enumerate(batch.column(1)):
                joined = b" ".join((text.as_py() or "").encode().lower().split())
                if not joined:
                    continue
                rows.append(i)
                texts.append(joined)
                held += len(joined)
                if held >= _TOGETHER:
                    flush()
                    rows, texts, held = [], [], 0
            flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return documents.select("doc_id", "text").mapInArrow(scan, schema)


_EDGES = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]
#: The bits of each key: all choices of BLOCKS - RADIUS blocks.
_MASKS = [sum(((1 << _EDGES[b + 1]) - (1 << _EDGES[b])) for b in kept) for kept in combinations(range(BLOCKS), BLOCKS - RADIUS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _references(n: int) -> list[int]:
    """Reference fingerprints: fixed pseudo-random ones, the same in every run."""
    return [int(x) for x in np.random.default_rng(64).integers(-(2**63), 2**63 - 1, n, dtype=np.int64)]


def distance_table(prints: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """``prints`` (fp) with its Hamming distances to the references, eight in each of the 64-bit
    columns d0, d1, ... (a distance takes one byte)."""
    refs = _references(pivots)
    packed = []
    for k in range(0, pivots, 8):
        word: Column = F.lit(0).cast("long")
        for j, r in enumerate(refs[k : k + 8]):
            word = word.bitwiseOR(F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(r))).cast("long"), 8 * j))
        packed.append(word.alias(f"d{k // 8}"))
    return prints.select("*", *packed)


def _within_pivots(left: str, right: str, radius: int, pivots: int) -> Column:
    """The largest coordinate difference is at most ``radius``."""
    tests = []
    for j in range(pivots):
        a, b = (F.shiftrightunsigned(F.col(f"{side}.d{j // 8}"), 8 * (j % 8)).bitwiseAND(F.lit(255)) for side in (left, right))
        tests.append(F.abs(a - b) <= radius)
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _around(hot: DataFrame) -> DataFrame:
    """(key, v, fp, near) for rows (key, combo, fp): all v within two bits of fp outside the key."""
    shapes = []
    for m in _MASKS:
        free = [np.uint64(1 << b) for b in range(64) if not m >> b & 1]
        one = np.array([0, *free], dtype=np.uint64)
        two = np.array([a | b for a, b in combinations(free, 2)], dtype=np.uint64)
        shapes.append((np.concatenate((one, two)), len(one)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, combo, fp = (np.asarray(c) for c in batch.columns)
            for c in np.unique(combo):
                flips, near = shapes[c]
                rows = np.flatnonzero(combo == c)
                for lo in range(0, len(rows), 256):
                    part = rows[lo : lo + 256]
                    v = (fp[part].view(np.uint64)[:, None] ^ flips[None, :]).ravel().view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(key[part], len(flips))), pa.array(v), pa.array(np.repeat(fp[part], len(flips))), pa.array(np.tile(np.arange(len(flips)) < near, len(part)))], names=["key", "v", "fp", "near"]
                    )

    return hot.select("key", "combo", "fp").mapInArrow(scan, "key long, v long, fp long, near boolean")


def links(prints: DataFrame, radius: int = RADIUS, pivots: int = PIVOTS, most: int = MOST_UNDER_KEY) -> DataFrame:
    """Verified links (x, y), x < y, that connect all of the different fingerprints ``prints`` (fp)
    that lie within ``radius`` (at most 3) of each other.  Under keys of more than ``most``
    fingerprints, links may stand for others: they connect the same components."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the blocks are cut for a radius of at most {RADIUS}")
    words = [f"d{k}" for k in range((pivots + 7) // 8)]
    keys = F.array(*[F.struct(F.lit(c).alias("combo"), F.xxhash64(F.lit(c), F.col("fp").bitwiseAND(F.lit(_signed(m)))).alias("key")) for c, m in enumerate(_MASKS)])
    keyed = prints.select("fp", F.inline(keys))
    shared = keyed.groupBy("key").agg(F.count("*").alias("under")).filter("under > 1")
    # a row for each key of a fingerprint is sized as one for each fingerprint: no join here is left to be a broadcast
    rows = stage(distance_table(keyed.hint("merge").join(shared, "key"), pivots), "keys")
    cold = rows.filter(F.col("under") <= most).select("key", "fp", *words)
    l, r = cold.alias("l"), cold.alias("r")
    close = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= radius
    pairs = l.hint("merge").join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.fp") < F.col("r.fp")) & _within_pivots("l", "r", radius, pivots)).filter(close).select(F.col("l.fp").alias("x"), F.col("r.fp").alias("y"))
    hot = rows.filter(F.col("under") > most)
    if hot.isEmpty():
        return pairs.distinct()
    around = stage(_around(hot), "around")
    hub = around.groupBy("key", "v").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"), F.count("*").alias("n")).filter("hub IS NOT NULL AND n > 1")
    spokes = around.hint("merge").join(hub, ["key", "v"]).filter(F.col("fp") != F.col("hub")).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= radius)
    return pairs.union(spokes.select(F.least("fp", "hub").alias("x"), F.greatest("fp", "hub").alias("y"))).distinct()


def near_duplicates(documents: DataFrame, radius: int = RADIUS, most: int = MOST_UNDER_KEY) -> DataFrame:
    """(doc_id, fp, component_id): every document with its fingerprint and the smallest doc_id that
    it reaches over links, itself included.

    Defined cases: a null text is empty and has fingerprint zero, as do all texts without words.
    Rows with a null doc_id take part in no group: their component_id is the least doc_id with
    the same fingerprint's component, or null.  Repeated rows come out as often as they went in.
    A very long text is hashed as a whole; an empty table gives no row; columns other than ``doc_id`` and ``text`` are not carried.
    """
    from pairforge.llm.components import components

    docs = stage(fingerprints(documents), "fingerprints")
    prints = stage(docs.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("id")), "prints")
    near = links(prints, radius, most=most)
    x, y = prints.select(F.col("fp").alias("x"), F.col("id").alias("u")), prints.select(F.col("fp").alias("y"), F.col("id").alias("v"))
    found = components(near.hint("merge").join(x, "x").hint("merge").join(y, "y").select("u", "v"))
    named = prints.hint("merge").join(found, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return docs.hint("merge").join(named, "fp", "left").select("doc_id", "fp", "component_id")


def deduplicate(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The documents that lead their group: one of each component, the one with the smallest
    doc_id.  Rows that share this doc_id are one document.  Rows with a null doc_id stay only if no
    other document is in their group."""
    groups = near_duplicates(documents, radius)
    go = groups.filter("component_id IS NOT NULL AND (doc_id IS NULL OR doc_id <> component_id)").select(F.col("doc_id").alias("gone")).distinct()
    return documents.join(go, documents["doc_id"] == go["gone"], "left_anti")
