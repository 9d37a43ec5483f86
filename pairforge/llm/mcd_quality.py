"""Quality rules with robust multivariate outliers, in native expressions.

Statistics of each whole text (words are runs of non-white-space):
``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (characters of ``#*$%&|<>``),
``n_dup_lines`` (lines with a word that equal an earlier line of the text), ``n_repeat_words`` (words
in 8-word windows that the text holds twice or more, the first included).

Base rules fail a text of fewer than 20 words or with over 30 % repeated words.  For the others,
smoothed rates are transformed by logarithms and a minimum-covariance-determinant estimate is made for
each language and source.  Concentration steps keep the three quarters of the rows with the least
Mahalanobis distance and estimate mean and covariance anew.  They run from three deterministic starts at
once: medians with quartile spreads, medians with the covariance of spatial signs, and the plain mean and
covariance; of the three results the one with the least determinant is kept for each group (of equal ones
the first).  The covariance is scaled up where the median distance is more than that of a normal sample
with as many dimensions as vary in the group; it is not scaled down, since floors make ordinary
distances small on purpose.  A text is rejected if its squared distance exceeds ``CUTOFF``.  Every step
is a group-by with partial aggregation (means, covariances, percentile sketches) and a join with one row
for each group, which is broadcast while the groups are counted to be few.

Rates are smoothed so that a short text's noise is not taken for an outlier: its word length counts with
``PRIOR`` words of the group's median length, its symbols, repeated lines and repeated passages (of
``2 * WINDOW`` words, both places counted) with ``PRIOR`` words that have none.

Defined cases: null texts have no words and fail; null languages and sources are groups of their
own; repeated rows count as often as they are there, and ties of the distance all stay; a very long text
is one row of statistics; an empty table gives no row; sources with fewer than ``LEAST_GROUP`` usable texts in a language are estimated together, and
where even that is too few, nothing is rejected.  In most groups three quarters of the texts have no
symbol, repeated line or passage at all, and the covariance is singular; ``FLOOR`` is added to each
axis.  For counts it is such that one symbol or repeated line alone never rejects a text of usual word
length, while two can if the text is short; a repeated passage longer than ``WINDOW`` words can.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import stage

LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
SUBSET = 0.75
STEPS = 4
LEAST_GROUP = 50
#: Medians of chi-square with 1 to 4 degrees of freedom, and the 0.999 quantile with 4.
CHI2_MEDIANS, CUTOFF = (0.4549, 1.3863, 2.3660, 3.3567), 18.467
#: Words by which each rate is smoothed.
PRIOR = (50, 200, 200, 200)
#: Share of CUTOFF that one symbol, one repeated line and one passage of the least length reach at most.
ONE = (2 / 3, 2 / 3, 1)
#: Standard deviations added against singular covariances; those of the counts follow from ONE.
FLOOR = (0.01, *(math.log1p(100.0 / p) / math.sqrt(share * CUTOFF) for p, share in zip(PRIOR[1:], ONE, strict=True)))
DIMENSIONS = len(FLOOR)
_Z = [f"z{k}" for k in range(DIMENSIONS)]
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(documents: DataFrame) -> DataFrame:
    """``documents`` (with a ``text`` column) and the five statistics."""
    d = documents.drop(*STATISTICS).withColumn("_ws", F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), ""))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    d = d.withColumn("_lines", lines)
    n = F.size("_ws")
    d = d.withColumn("_windows", F.when(n > WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_ws", i, WINDOW)))))
    # only texts in which some window repeats are sorted
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    d = d.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("_sorted", lambda s, j: (s["h"] == F.get(F.col("_sorted"), j - 1)["h"]) | (s["h"] == F.get(F.col("_sorted"), j + 1)["h"]))
    d = d.withColumn("_at", F.when(F.col("_sorted").isNotNull(), F.sort_array(F.transform(twice, lambda s: s["i"]))))
    covered = F.aggregate(F.transform("_at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_at"), j + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    return d.select(
        *documents.drop(*STATISTICS).columns,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_ws", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count("text", F.lit("[#*$%&|<>]")), F.lit(0)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def transformed(usual: Column) -> list[Column]:
    """The statistic vector: word length and the rates of symbols, repeated lines and passages, smoothed.
    ``usual`` is the group's usual word length."""
    n = F.col("n_words")
    length = F.log(F.greatest(F.col("word_chars") + PRIOR[0] * usual, F.lit(1)) / (n + PRIOR[0]))
    events = ("n_symbols", 1), ("n_dup_lines", 1), ("n_repeat_words", 2 * WINDOW)
    return [length, *(F.log1p(100.0 / size * F.col(c) / (n + p)) for (c, size), p in zip(events, PRIOR[1:], strict=True))]


#: Groups up to which one row for each is broadcast (under 50 MB); beyond it rows and groups are shuffled.
BROADCAST_GROUPS = 200_000
_GROUP = ("g_lang", "g_source", "g_rest")
_START = (*_GROUP, "g_start")
STARTS = 3


def _with_group(rows: DataFrame, groups: DataFrame, keys: tuple[str, ...] = _GROUP, few: bool = True) -> DataFrame:
    """``rows`` with the columns of their group's row; null keys meet null keys."""
    g = groups.withColumnsRenamed({k: f"r_{k}" for k in keys})
    on = None
    for k in keys:
        same = rows[k].eqNullSafe(g[f"r_{k}"])
        on = same if on is None else on & same
    return rows.join(F.broadcast(g) if few else g, on, "left").drop(*[f"r_{k}" for k in keys])


_PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i + 1)]
_MEANS = [f"m{k}" for k in range(DIMENSIONS)]
_COVARIANCES = [f"c{i}{j}" for i, j in _PAIRS]


def _moments(rows: DataFrame, keys: tuple[str, ...], axes: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.avg(z).alias(m) for z, m in zip(axes, _MEANS, strict=True)], *[F.covar_pop(axes[i], axes[j]).alias(f"c{i}{j}") for i, j in _PAIRS])


def _starts(rows: DataFrame, few: bool) -> DataFrame:
    """The first estimates of each group, one row for each start, factored."""
    q = rows.groupBy(*_GROUP).agg(*[F.percentile_approx(z, [0.25, 0.5, 0.75], 2000).alias(f"q{z}") for z in _Z])
    spread = [F.greatest((F.col(f"q{z}")[2] - F.col(f"q{z}")[0]) / 1.349, F.lit(FLOOR[k])) for k, z in enumerate(_Z)]
    middle = stage(q.select(*_GROUP, *[F.col(f"q{z}")[1].alias(m) for z, m in zip(_Z, _MEANS, strict=True)], *[s.alias(f"s{k}") for k, s in enumerate(spread)]), "mcd")
    widths = [F.col(f"s{k}") for k in range(DIMENSIONS)]
    plain = middle.select(*_GROUP, F.lit(0).alias("g_start"), *_MEANS, *[(widths[i] * widths[i] if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _PAIRS])
    # spatial signs: directions from the median, in units of the spreads
    x = _with_group(rows, middle, few=few).withColumns({f"x{k}": (F.col(f"z{k}") - F.col(f"m{k}")) / widths[k] for k in range(DIMENSIONS)})
    size = F.sqrt(sum((F.col(f"x{k}") * F.col(f"x{k}") for k in range(1, DIMENSIONS)), F.col("x0") * F.col("x0")))
    signs = x.withColumn("size", F.greatest(size, F.lit(1e-9))).withColumns({f"x{k}": F.col(f"x{k}") / F.col("size") for k in range(DIMENSIONS)})
    shape = _moments(signs.select(*_GROUP, *[f"x{k}" for k in range(DIMENSIONS)]), _GROUP, [f"x{k}" for k in range(DIMENSIONS)]).drop(*_MEANS)
    turned = _with_group(shape, middle, few=few).select(*_GROUP, F.lit(1).alias("g_start"), *_MEANS, *[(DIMENSIONS * F.col(f"c{i}{j}") * widths[i] * widths[j]).alias(f"c{i}{j}") for i, j in _PAIRS])
    usual = _moments(rows, _GROUP, _Z).select(*_GROUP, F.lit(2).alias("g_start"), *_MEANS, *_COVARIANCES)
    return _factored(plain.unionByName(turned).unionByName(usual), _START)


def _factored(e: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``e`` with the Cholesky factor and the log determinant of the floored covariance of each group."""
    for i, j in _PAIRS:
        s = F.col(f"c{i}{j}") + (F.lit(FLOOR[i] ** 2) if i == j else F.lit(0.0))
        for k in range(j):
            s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        e = e.withColumn(f"l{i}{j}", F.sqrt(F.greatest(s, F.lit(FLOOR[i] ** 2 / 4))) if i == j else s / F.col(f"l{j}{j}"))
    det = sum((F.log(f"l{k}{k}") for k in range(1, DIMENSIONS)), F.log("l00"))
    return e.select(*keys, *_MEANS, *_COVARIANCES, *[f"l{i}{j}" for i, j in _PAIRS], (2 * det).alias("log_det"))


def _distances(rows: DataFrame, estimate: DataFrame, keys: tuple[str, ...] = _GROUP, few: bool = True) -> DataFrame:
    """``rows`` with ``d2``, the squared Mahalanobis distance from their group's estimate."""
    r = _with_group(rows, estimate, keys, few)
    for i in range(DIMENSIONS):
        s = F.col(f"z{i}") - F.col(f"m{i}")
        for j in range(i):
            s = s - F.col(f"l{i}{j}") * F.col(f"y{j}")
        r = r.withColumn(f"y{i}", s / F.col(f"l{i}{i}"))
    return r.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, DIMENSIONS)), F.col("y0") * F.col("y0"))).select(*rows.columns, "d2")


def estimates(rows: DataFrame, steps: int = STEPS, few: bool = True) -> DataFrame:
    """The MCD estimate of each group of ``rows`` (group keys and z0...).  A stage table with one row
    for each group."""
    now = stage(_starts(rows, few), "mcd")
    each = rows.withColumn("g_start", F.explode(F.array(*[F.lit(k) for k in range(STARTS)])))
    for _ in range(steps):
        d = _distances(each, now, _START, few)
        most = stage(d.groupBy(*_START).agg(F.percentile_approx("d2", SUBSET, 2000).alias("most")), "mcd")
        kept = _with_group(d, most, _START, few).filter("d2 <= most")
        now = stage(_factored(_moments(kept, _START, _Z), _START), "mcd")
    rest = [c for c in now.columns if c not in _START]
    best = now.groupBy(*_GROUP).agg(F.min_by(F.struct(*rest), F.struct(F.round("log_det", 9), "g_start")).alias("e")).select(*_GROUP, "e.*")
    # axes that don't vary add nothing to the median distance
    vary = sum((F.col(f"c{k}{k}") > FLOOR[k] ** 2).cast("int") for k in range(DIMENSIONS))
    best = stage(best, "mcd")
    middle = stage(_distances(rows, best, _GROUP, few).groupBy(*_GROUP).agg(F.percentile_approx("d2", 0.5, 2000).alias("mid")), "mcd")
    usual = F.element_at(F.array(*[F.lit(x) for x in CHI2_MEDIANS]), F.greatest(vary, F.lit(1)))
    scaled = _with_group(best, middle, _GROUP, few).withColumn("scale", F.greatest(F.col("mid") / usual, F.lit(1.0)))
    scaled = scaled.withColumns({c: F.col(c) * F.col("scale") for c in _COVARIANCES})
    return stage(_factored(scaled, _GROUP), "mcd")


def judge(documents: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, lang, source, the statistics, base_failed, d2, kept) for every row."""
    s = stage(with_statistics(documents.select("doc_id", "lang", "source", "text")).drop("text").withColumn("base_failed", base_failed()), "statistics")
    usable = s.filter(~F.col("base_failed"))
    sizes = stage(usable.groupBy(F.col("lang").alias("n_lang"), F.col("source").alias("n_source")).agg(F.count("*").alias("n")), "sizes")
    few = sizes.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    sizes = F.broadcast(sizes) if few else sizes
    on = s["lang"].eqNullSafe(sizes["n_lang"]) & s["source"].eqNullSafe(sizes["n_source"])
    rest = F.coalesce(F.col("n"), F.lit(0)) < LEAST_GROUP
    rows = s.join(sizes, on, "left").withColumns({"g_rest": rest}).withColumns({"g_lang": F.col("lang"), "g_source": F.when(~F.col("g_rest"), F.col("source"))}).drop("n", "n_lang", "n_source")
    length = F.percentile_approx(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)), 0.5, 2000)
    groups = rows.filter(~F.col("base_failed")).groupBy(*_GROUP).agg(F.count("*").alias("n"), length.alias("usual"))
    groups = stage(groups.select(*_GROUP, (F.col("n") >= LEAST_GROUP).alias("enough"), "usual"), "groups")
    z = dict(zip(_Z, transformed(F.coalesce("usual", F.lit(5.0))), strict=True))
    rows = stage(_with_group(rows, groups, _GROUP, few).withColumns(z).drop("usual"), "vectors")
    e = estimates(rows.filter("NOT base_failed AND enough").select(*_GROUP, *_Z), few=few)
    d = _distances(rows, e, _GROUP, few)
    kept = ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)
    return d.select("doc_id", "lang", "source", *STATISTICS, "base_failed", "d2", kept.alias("kept"))
