"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are boosted on a bounded sample of labelled documents; each path of each tree is a
conjunction of comparisons on statistics.  A logistic model over these rules and over the
standardised statistics is fitted with a lasso penalty, most weights become zero, and what is
left is compiled into Spark column expressions: scoring a document needs no model object.

The statistics of a whole text are taken in Arrow batches (:func:`with_statistics`), all of them
ratios that do not depend on the language.

Defined cases: null and empty texts have all statistics zero and get a score like any other;
rows with a null doc_id or label are not learned from; if the labelled sample is empty or holds
one class only, the score is the share of label 1 (0.5 if there is none); repeated rows get one score; a very long
text is one row of statistics; an empty table gives no row.  Columns of the input
pass through; those named like a statistic or ``score`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.common import chunks, mix, word_hashes, word_spans

#: Bound of the fitted sample: labelled rows, by the order of a hash of doc_id.
SAMPLE = 6000
THRESHOLD = 0.3
TREES, DEPTH, BINS = 40, 3, 32
LASSO = 0.0015

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letter": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100)),
    "digit": b"0123456789",
    "bang": b"!?",
    "symbol": b"#$%&*@^~=+_\\/",
    "bar": b"|<>{}[]",
    "stop": b".,;:",
    "newline": b"\n",
}
STATISTICS = (
    "s_words", "s_word_bytes", "s_upper", "s_digit", "s_bang", "s_symbol", "s_bar", "s_stop", "s_newline", "s_distinct", "s_top", "s_same_next", "s_new_next", "s_odd_end", "s_long", "s_short", "s_letters",
)


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The statistics of each row of a chunk, one column for each of ``STATISTICS``."""
    n = len(off) - 1
    out = np.zeros((n, len(STATISTICS)))
    start, end, rows = word_spans(data, off)
    if not len(start):
        return out
    size = np.diff(off)
    lut = np.zeros((len(_CLASSES), 256), dtype=np.uint8)
    for k, members in enumerate(_CLASSES.values()):
        lut[k, np.frombuffer(members, np.uint8)] = 1
    per: dict[str, np.ndarray] = {}
    at = np.minimum(off[:-1], len(data) - 1)
    for k, name in enumerate(_CLASSES):
        per[name] = np.where(size > 0, np.add.reduceat(lut[k][data], at, dtype=np.int64), 0)
    words = np.diff(rows)
    of = np.repeat(np.arange(n), words)
    some = np.maximum(words, 1)
    h = word_hashes(data, start, end)
    order = np.argsort(mix(h + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    ho, oo = h[order], of[order]
    head = np.flatnonzero(np.concatenate(([True], (ho[1:] != ho[:-1]) | (oo[1:] != oo[:-1]))))
    times = np.diff(np.append(head, len(ho)))
    distinct = np.bincount(oo[head], minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, oo[head], times)
    follows = of[1:] == of[:-1]
    same = np.bincount(of[1:][follows & (h[1:] == h[:-1])], minlength=n)
    pair = mix(h[:-1] * np.uint64(3) + h[1:] + of[1:].astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))[follows]
    pairs_distinct = np.bincount(of[1:][follows][np.unique(pair, return_index=True)[1]], minlength=n)
    bytes_ = end - start
    odd = 1 - lut[list(_CLASSES).index("letter")][data[end - 1]] - lut[list(_CLASSES).index("stop")][data[end - 1]]
    letters = np.maximum(per["letter"], 1)
    used = np.maximum(size, 1)
    columns = (
        np.log1p(words), np.bincount(of, bytes_, n) / some, per["upper"] / letters, per["digit"] / used, per["bang"] / some, per["symbol"] / some, per["bar"] / some, per["stop"] / some, per["newline"] / some,
        distinct / some, top / some, same / some, pairs_distinct / np.maximum(words - 1, 1), np.bincount(of, odd, n) / some, np.bincount(of, bytes_ > 20, n) / some, np.bincount(of, bytes_ < 3, n) / some, per["letter"] / used,
    )
    for k, c in enumerate(columns):
        out[:, k] = np.where(words > 0, c, 0)
    return out


def with_statistics(documents: DataFrame) -> DataFrame:
    """``documents`` (with a ``text`` column) and the statistics of each whole text."""
    docs = documents.drop(*STATISTICS)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(s, T.DoubleType()) for s in STATISTICS)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(data, off) for _, data, off in chunks(batch, "text")]
            s = np.concatenate(found) if found else np.zeros((0, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(s[:, k]) for k in range(s.shape[1]))], names=[*batch.schema.names, *STATISTICS])

    return docs.mapInArrow(scan, schema)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, greater, threshold), sorted


@dataclass
class RuleModel:
    """score = sigmoid(bias + sum of rule weights that hold + sum of linear weights)."""

    bias: float = 0.0
    rules: list[tuple[float, Rule]] = field(default_factory=list)
    linear: list[tuple[float, int, float, float]] = field(default_factory=list)  # weight, statistic, low, high

    def column(self) -> Column:
        """The score as a Spark expression over the statistics."""

        def test(c: tuple[int, bool, float]) -> Column:
            s = F.col(STATISTICS[c[0]])
            return s > F.lit(c[2]) if c[1] else s <= F.lit(c[2])

        terms = [F.lit(float(self.bias))]
        terms += [F.when(reduce(lambda x, y: x & y, map(test, rule)), F.lit(w)).otherwise(F.lit(0.0)) for w, rule in self.rules]
        terms += [F.lit(w) * F.least(F.greatest(F.col(STATISTICS[k]), F.lit(lo)), F.lit(hi)) for w, k, lo, hi in self.linear]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(add, terms)))

    def describe(self) -> list[str]:
        """The rules in words, heaviest first."""
        return [f"{w:+.3f}  " + " and ".join(f"{STATISTICS[k]} {'>' if up else '<='} {t:.4g}" for k, up, t in rule) for w, rule in sorted(self.rules, key=lambda r: -abs(r[0]))]


def _tree(x: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, weight: np.ndarray, rows: np.ndarray, path: Rule, found: set[Rule], step: np.ndarray) -> None:
    """Grow one path of a boosted regression tree on binned statistics; paths go to ``found``."""
    g, h = residual[rows], weight[rows]
    if path:
        found.add(tuple(sorted(path)))
    best = (1e-6, -1, -1)
    if len(path) < DEPTH and len(rows) >= 40:
        base = g.sum() ** 2 / (h.sum() + 1)
        for k, c in enumerate(cuts):
            b = x[rows, k]
            gs, hs, ns = (np.cumsum(np.bincount(b, v, len(c) + 1))[:-1] for v in (g, h, np.ones(len(rows))))
            ok = (ns >= 15) & (ns <= len(rows) - 15)
            gain = np.where(ok, gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - base, -1)
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), k, int(gain.argmax()))
    if best[1] < 0:
        step[rows] = g.sum() / (h.sum() + 1)
        return
    _, k, j = best
    left = x[rows, k] <= j
    for up, part in ((False, rows[left]), (True, rows[~left])):
        _tree(x, cuts, residual, weight, part, (*path, (k, up, float(cuts[k][j]))), found, step)


def fit_arrays(s: np.ndarray, y: np.ndarray) -> RuleModel:
    """Fit on statistics ``s`` and labels ``y`` (0 or 1)."""
    if not len(y) or y.min() == y.max():
        p = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return RuleModel(bias=float(np.log(p / (1 - p))))
    rng = np.random.default_rng(7)
    cuts = [np.unique(np.quantile(s[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(s.shape[1])]
    x = np.stack([np.searchsorted(c, s[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    f = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    found: set[Rule] = set()
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        rows = np.sort(rng.permutation(len(y))[: max(200, len(y) // 2)])
        step = np.zeros(len(y))
        _tree(x, cuts, y - p, p * (1 - p), rows, (), found, step)
        f += 0.3 * step
    rules = sorted(found)
    lo, hi = np.quantile(s, 0.02, axis=0), np.quantile(s, 0.98, axis=0)
    spread = np.maximum(np.clip(s, lo, hi).std(axis=0), 1e-9)
    design = np.stack([np.all([(s[:, k] > t) == up for k, up, t in r], axis=0) for r in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
    full = np.concatenate((design, 0.4 * np.clip(s, lo, hi) / spread), axis=1)
    centre = full.mean(axis=0)
    a = full - centre
    rate = 4.0 * len(y) / max(np.linalg.norm(a, 2) ** 2, 1e-9)
    w = z = np.zeros(a.shape[1])
    b = float(np.log(y.mean() / (1 - y.mean())))
    t = 1.0
    for _ in range(400):  # accelerated proximal gradient
        p = 1 / (1 + np.exp(-(a @ z + b)))
        grad = a.T @ (p - y) / len(y)
        b -= float((p - y).mean()) * 2
        new = z - rate * grad
        new = np.sign(new) * np.maximum(np.abs(new) - rate * LASSO, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    n = len(rules)
    bias = b - float(centre @ w)
    linear = [(float(0.4 * w[n + k] / spread[k]), k, float(lo[k]), float(hi[k])) for k in range(s.shape[1]) if w[n + k]]
    return RuleModel(bias=bias, rules=[(float(w[i]), rules[i]) for i in range(n) if w[i]], linear=linear)


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """Learn from the documents that ``labels`` (doc_id, quality) marks.  At most ``sample`` labels
    are used, the first by a hash of doc_id; so the joined side is bounded and broadcast."""
    picked = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", F.col("quality").cast("double").alias("label")).orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "label").limit(sample)
    rows = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    got = with_statistics(rows).select("doc_id", "label", *STATISTICS).orderBy("doc_id", *STATISTICS).limit(2 * sample).collect()
    s = np.array([[r[c] for c in STATISTICS] for r in got]).reshape(len(got), len(STATISTICS))
    return fit_arrays(s, np.array([float(r["label"] > 0) for r in got]))


def score(documents: DataFrame, model: RuleModel) -> DataFrame:
    """``documents`` with the statistics and ``score``."""
    return with_statistics(documents.drop("score")).withColumn("score", model.column())
