"""Language identification by the nearest of several centroids for each language.

A text is a vector of letter n-grams: each letter, and each letter with its two neighbours (other
characters count as a gap), lower-cased and hashed into ``BUCKETS`` places; weights are
(1 + ln tf) * idf, and the vector has length 1.  Document frequencies are those of all labelled texts.
For each language the vectors of a bounded sample are clustered by cosine; a text gets the language
of the nearest centroid.  It is marked as rejected if it lies farther from that centroid than nearly
all labelled texts of the language that are nearest to it.

Defined cases: ``und`` and score 0 for a null text, a text without a letter, and any text if
nothing was learned (no labelled row).  Rows with a null doc_id are never learned from.  Of centroids at
the same distance the first counts, in the order of the language's name; repeated rows are predicted alike;
a very long text is one vector, of all its letters; an empty table gives no row, and further columns are ignored.  Every value of ``lang`` is
learned; centroids are kept sparse, and compared in blocks of ``BLOCK``, so that rare values cost little memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.common import broadcast_if_small, stage

BUCKETS = 1 << 13
CENTROIDS = 4
#: Bound of the fitted sample: documents of all languages together.
SAMPLE = 1600
#: Texts of each language in the sample, however many languages there are (the bound is then this times their number).
LEAST_TEXTS = 16
#: Centroids that are compared at a time.
BLOCK = 512
#: A text is rejected below this share of the cosine that all but 1 % of a centroid's texts reach.
REJECT = 0.5
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows that nothing is learned from (a null id: true)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


#: A bit for each code point: whether it is a letter.  Made by the driver, since it takes longer than many a task.
_LETTER_BITS = np.packbits(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
_table: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point whether it is a letter; unpacked once in a task."""
    if not _table:
        _table.append(np.unpackbits(_LETTER_BITS).astype(bool))
    return _table[0]


def _groups(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, counts by row and bucket, letters by row), for up to 64 rows at a time."""
    letters = _letters()
    lo = 0
    while lo < len(texts):
        hi, size, part = lo, 0, []
        while hi < len(texts) and hi - lo < 64 and (size < 1 << 19 or hi == lo):
            part.append((texts[hi] or "").lower())
            size += len(part[-1])
            hi += 1
        lens = np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 2
        code = np.frombuffer((" " + "  ".join(part) + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        is_letter = letters[code]
        c = np.where(is_letter, code, 32).astype(np.uint32)
        at = np.flatnonzero(is_letter)
        row = np.repeat(np.arange(len(part)), lens)[at]
        one = (c[at] * np.uint32(0x9E3779B1)) >> np.uint32(19)
        three = ((c[at - 1] * np.uint32(0x85EBCA6B)) ^ (c[at] * np.uint32(0xC2B2AE35)) ^ (c[at + 1] * np.uint32(0x27D4EB2F))) * np.uint32(0x9E3779B1) >> np.uint32(19)
        flat = np.concatenate((row * BUCKETS + one, row * BUCKETS + three))
        counts = np.bincount(flat, minlength=len(part) * BUCKETS).reshape(len(part), BUCKETS)
        yield lo, counts, np.bincount(row, minlength=len(part))
        lo = hi


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def _weights(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(counts.shape, dtype=np.float32)
    some = counts > 0
    out[some] = 1 + np.log(counts[some].astype(np.float32))
    return out


def _cluster(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds: (centroids, each row's cluster)."""
    k = min(k, len(x))
    seeds = [int(np.argmax(x @ x.mean(axis=0)))]
    near = x @ x[seeds[0]]
    while len(seeds) < k:
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds]
    for _ in range(12):
        of = np.argmax(x @ c.T, axis=1)
        c = _unit(np.stack([x[of == j].sum(axis=0) if (of == j).any() else c[j] for j in range(len(c))]))
    return c, np.argmax(x @ c.T, axis=1)


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts of ``rows`` with a letter, and of those with each bucket."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for _, counts, n_letters in _groups(batch.column(0).to_pylist()):
                df[:BUCKETS] += (counts > 0).sum(axis=0)
                df[BUCKETS] += (n_letters > 0).sum()
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["bucket", "n"])

    df = np.zeros(BUCKETS + 1, dtype=np.int64)
    for r in rows.select("text").mapInArrow(scan, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r["bucket"]] = r["n"]
    return int(df[BUCKETS]), df[:BUCKETS]


class Centroids:
    """The centroids of a model in dense blocks; a single block, the usual case, is made once."""

    def __init__(self, model: dict):
        self.sparse = model["c"]
        self.first = self._block(0)

    def _block(self, lo: int) -> np.ndarray:
        some = self.sparse[lo : lo + BLOCK]
        out = np.zeros((len(some), BUCKETS), np.float32)
        for row, (ids, values) in zip(out, some, strict=True):
            row[ids] = values
        return out

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        for lo in range(0, len(self.sparse), BLOCK):
            yield lo, self._block(lo) if lo else self.first

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the nearest centroid, the first of equal ones, and its cosine."""
        best, cosine = np.zeros(len(x), np.int64), np.full(len(x), -np.inf, np.float32)
        for lo, block in self.blocks():
            cos = x @ block.T
            at = np.argmax(cos, axis=1)
            top = cos[np.arange(len(x)), at]
            nearer = top > cosine
            best[nearer], cosine[nearer] = at[nearer] + lo, top[nearer]
        return best, cosine

    def own(self, x: np.ndarray, of: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The same, of the centroids ``of`` each row."""
        best, cosine = np.zeros(len(x), np.int64), np.full(len(x), -np.inf, np.float32)
        for i, mine in enumerate(of):
            for k in mine.tolist():
                ids, values = self.sparse[k]
                if (c := np.float32(x[i, ids] @ values)) > cosine[i]:
                    best[i], cosine[i] = k, c
        return best, cosine


def _least_cosines(rows: DataFrame, model: dict) -> dict[int, float]:
    """For each centroid the cosine that all but 1 % of the texts of ``rows`` reach whose language has
    it and to which no other one of the language is nearer."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        centroids = Centroids(m)
        own: dict[str, list[int]] = {}
        for k, j in enumerate(m["of"].tolist()):
            own.setdefault(m["langs"][j], []).append(k)
        own = {k: np.array(v) for k, v in own.items()}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for lo, counts, n_letters in _groups(batch.column(0).to_pylist()):
                at = [i for i in range(len(counts)) if n_letters[i] and langs[lo + i] in own]
                x = _unit(_weights(counts[at]) * m["idf"]) if at else np.zeros((0, BUCKETS), np.float32)
                best, cos = centroids.own(x, [own[langs[lo + i]] for i in at])
                yield pa.RecordBatch.from_arrays([pa.array(best.astype(np.int32)), pa.array(cos.astype(float))], names=["centroid", "cos"])

    near = rows.select("text", "lang").mapInArrow(scan, "centroid int, cos double")
    return {r["centroid"]: r["least"] for r in near.groupBy("centroid").agg(F.percentile_approx("cos", 0.01, 10000).alias("least")).collect()}


def fit(labelled: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> dict:
    """Learn from ``labelled`` (doc_id, text, lang).  The sample is bounded by ``sample`` rows in
    all, dealt evenly over the languages by the order of a hash of doc_id; it only gives the centroids."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    sizes = stage(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    n_langs = sizes.count()
    empty = {"langs": [], "of": np.zeros(0, np.int64), "c": [], "idf": np.ones(BUCKETS, np.float32), "least": np.zeros(0)}
    if not n_langs:
        return empty
    each = max(sample // n_langs, LEAST_TEXTS)
    # thinned by a hash first, so that the texts of a language that are put in order are few
    thin = sizes.select("lang", F.least(F.lit(1.0), 1.3 * each / F.col("n") + 20 / F.col("n")).alias("share"))
    order = F.xxhash64(F.lit("sample"), F.col("doc_id"))
    picked = rows.withColumn("o", order).join(broadcast_if_small(thin, 100_000), "lang").filter((F.col("o") / F.lit(2.0**64) + 0.5) < F.col("share")).select("o", "lang", "text")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, counts, _ in _groups(batch.column(2).to_pylist()):
                ids = [np.flatnonzero(r).astype(np.int32) for r in counts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(ids)), batch.column(1).slice(lo, len(ids)), pa.array([i.tobytes() for i in ids], pa.binary()), pa.array([r[i].astype(np.int32).tobytes() for r, i in zip(counts, ids, strict=True)], pa.binary())],
                    names=["o", "lang", "ids", "counts"],
                )

    lang_type = rows.schema["lang"].dataType.simpleString()
    features = picked.mapInArrow(featurise, f"o long, lang {lang_type}, ids binary, counts binary").filter(F.length("ids") > 0)
    chosen = features.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("o", F.xxhash64("ids", "counts")))).filter(F.col("k") <= each)
    by: dict[str, list] = {}
    for r in sorted(chosen.collect(), key=lambda r: (r["lang"], r["k"])):
        by.setdefault(r["lang"], []).append(r)
    if not by:
        return empty
    n_texts, df = document_frequencies(rows)
    idf = (np.log((1 + n_texts) / (1 + df)) + 1).astype(np.float32)
    langs, of, c = sorted(by), [], []
    for j, k in enumerate(langs):
        counts = np.zeros((len(by[k]), BUCKETS), dtype=np.int32)
        for row, r in zip(counts, by[k], strict=True):
            row[np.frombuffer(r["ids"], np.int32)] = np.frombuffer(r["counts"], np.int32)
        found, _ = _cluster(_unit(_weights(counts) * idf), centroids)
        of += [j] * len(found)
        c += [((ids := np.flatnonzero(f)).astype(np.int32), f[ids].astype(np.float32)) for f in found]
    model = {"langs": langs, "of": np.array(of), "c": c, "idf": idf, "least": np.zeros(len(c))}
    for m, least in _least_cosines(rows, model).items():
        model["least"][m] = REJECT * least
    return model


def predict(documents: DataFrame, model: dict) -> DataFrame:
    """``documents`` (doc_id, text) with lang_pred, score and rejected, in place of the text."""
    held = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([documents.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        centroids = Centroids(m)
        for batch in batches:
            for lo, counts, n_letters in _groups(batch.column(1).to_pylist()):
                n = len(counts)
                if len(m["c"]):
                    best, cos = centroids.nearest(_unit(_weights(counts) * m["idf"]))
                    score = np.clip(cos.astype(float), 0, 1)
                    known = n_letters > 0
                    lang = [m["langs"][m["of"][b]] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                    score, far = np.where(known, score, 0.0), ~known | (score < m["least"][best])
                else:
                    lang, score, far = [UNKNOWN] * n, np.zeros(n), np.ones(n, dtype=bool)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(lang, pa.string()), pa.array(score), pa.array(far)], names=["doc_id", "lang_pred", "score", "rejected"])

    return documents.select("doc_id", "text").mapInArrow(scan, schema)
