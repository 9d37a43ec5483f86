"""TF-IDF and vector similarity, global percentiles, rank correlation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairforge.functions.arrays import literal, unit
from pairforge.functions.text import preprocess
from pairforge.operators import blocked, postings
from pairforge.operators.blocked import products
from pairforge.operators.ranks import positions_by_runs, with_positions
from pairforge.sources.stages import BROADCAST_ROWS, stage


def word_grams(df: DataFrame, key: str, text: str, least_length: int = 2) -> DataFrame:
    """(key, gram, tf): 1- and 2-grams of words of at least two characters."""
    w = df.select(key, F.filter(F.split(preprocess(F.col(text)), " "), lambda t: F.length(t) >= least_length).alias("w"))
    two = F.zip_with(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    return w.select(key, F.explode(F.concat("w", F.filter(two, lambda x: x.isNotNull()))).alias("gram")).groupBy(key, "gram").agg(F.count("*").alias("tf"))


def char_grams(df: DataFrame, key: str, text: str, sizes: tuple[int, ...] = (3, 4, 5)) -> DataFrame:
    """(key, gram, tf): character n-grams inside words padded by one space on each side."""
    w = df.select(key, F.explode(F.split(preprocess(F.col(text)), " ")).alias("w")).filter("w <> ''").withColumn("p", F.concat(F.lit(" "), "w", F.lit(" ")))
    n = F.length("p")

    def of_size(k: int):
        return F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(F.col("p"), i, F.lit(k)))

    grams = F.concat(*[F.when(n >= k, of_size(k)).otherwise(F.array().cast("array<string>")) for k in sizes])
    return w.select(key, F.explode(grams).alias("gram")).groupBy(key, "gram").agg(F.count("*").alias("tf"))


def tfidf(counts: DataFrame, key: str, n_docs: DataFrame, sublinear: bool = True, min_df: int = 1, max_df_ratio: float = 1.0, weight: float = 1.0) -> DataFrame:
    """(key, gram, w): weights tf * (ln((1 + n) / (1 + df)) + 1), of length ``weight`` for each key."""
    df = counts.groupBy("gram").agg(F.count("*").alias("df")).join(F.broadcast(n_docs)).filter((F.col("df") >= min_df) & (F.col("df") <= max_df_ratio * F.col("n")))
    tf = 1 + F.log("tf") if sublinear else F.col("tf").cast("double")
    raw = counts.join(df, "gram").select(key, "gram", (tf * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("w"))
    size = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    return raw.join(size, key).select(key, "gram", (weight * F.col("w") / F.col("size")).alias("w"))


def hybrid(df: DataFrame, key: str, text: str, char_weight: float = 0.5) -> DataFrame:
    """Word and character blocks, each of length 1 (characters: ``char_weight``), as one long table."""
    n = df.agg(F.count("*").alias("n"))
    words = tfidf(word_grams(df, key, text), key, n).withColumn("gram", F.concat(F.lit("w:"), "gram"))
    chars = tfidf(char_grams(df, key, text), key, n, min_df=2, weight=char_weight).withColumn("gram", F.concat(F.lit("c:"), "gram"))
    return words.union(chars)


def sparse_cosine(left: DataFrame, right: DataFrame, normalise: bool = False) -> DataFrame:
    """(cid, oid, cosine) of the pairs that share a term, by an equi-join on it."""
    out = left.join(right.withColumnRenamed("w", "v"), "gram").groupBy("cid", "oid").agg(F.sum(F.col("w") * F.col("v")).alias("cosine"))
    if not normalise:
        return out
    a = left.groupBy("cid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("na"))
    b = right.groupBy("oid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("nb"))
    return out.join(a, "cid").join(b, "oid").select("cid", "oid", (F.col("cosine") / (F.col("na") * F.col("nb"))).alias("cosine"))


#: Word and character blocks of a hybrid vector.
HYBRID = (postings.Part(), postings.Part(chars=True, min_df=2, weight=0.5))


def tfidf_cosines(texts: DataFrame, right: str, parts: tuple[postings.Part, ...], normalise: bool = False, frequent: int = BROADCAST_ROWS, held_terms: int = postings.HELD_TERMS) -> DataFrame:
    """(side, cid, oid, cosine) of the texts (side, id, text) of other sides with those of the side ``right`` with which they share a gram, in TF-IDF vectors of
    ``parts``, fitted on all texts.  With ``normalise`` vectors of several parts get the length 1.

    Tasks hold the right vectors; where these have over ``held_terms`` terms, vectors meet as blocks.  Where the right side has over ``frequent`` different
    grams, vectors are made as long tables and meet by a join on the gram."""
    counts = [postings.gram_counts(texts, right, p, frequent) for p in parts]
    if any(c is None for c in counts):
        keyed = texts.select(F.struct("side", "id").alias("key"), "text")
        n = texts.agg(F.count("*").alias("n"))
        rows = [tfidf((char_grams if p.chars else word_grams)(keyed, "key", "text"), "key", n, p.sublinear, p.min_df, p.max_df, p.weight).withColumn("gram", F.concat(F.lit(f"{k}:"), "gram")) for k, p in enumerate(parts)]
        w = stage(reduce(DataFrame.union, rows), "grams")
        out = sparse_cosine(w.filter(F.col("key.side") != right).withColumnRenamed("key", "cid"), w.filter(F.col("key.side") == right).withColumnRenamed("key", "oid"), normalise)
        return out.select("cid.side", F.col("cid.id").alias("cid"), F.col("oid.id").alias("oid"), "cosine")
    held = postings.held_products(texts, right, parts, counts, normalise, held_terms)
    if held is not None:
        return held
    made = [postings.tfidf_lists(texts, right, p, counts=c) for p, c in zip(parts, counts, strict=True)]

    def of_part(k: int) -> Column:
        return F.transform("terms", lambda x: F.shiftleft(x, 1).bitwiseOR(F.lit(k).cast("long"))).alias("terms")

    own = [m.select("side", "id", of_part(k), "w", F.when(F.col("size") > 0, p.weight**2).otherwise(0.0).alias("part")) for k, (m, p) in enumerate(zip(made, parts, strict=True))]
    rows = own[0]
    if len(parts) > 1:
        rows = reduce(DataFrame.union, own).groupBy("side", "id").agg(F.flatten(F.collect_list("terms")).alias("terms"), F.flatten(F.collect_list("w")).alias("w"), F.sum("part").alias("part"))
    rows = rows.filter(F.size("terms") > 0)
    if normalise:
        rows = rows.withColumn("w", F.transform("w", lambda x: x / F.sqrt("part")))
    rows = stage(rows, "vectors")
    found = postings.products(rows.filter(F.col("side") != right).select(F.struct("side", "id").alias("cid"), "terms", "w"), rows.filter(F.col("side") == right).select(F.col("id").alias("oid"), "terms", "w"))
    return found.select("cid.side", F.col("cid.id").alias("cid"), "oid", "cosine")


def dense_cosines(left: DataFrame, right: DataFrame, vectors: dict[str, str], vector: str = "b") -> DataFrame:
    """(cid, oid, and a cosine for each of ``vectors``: name -> column of ``left``) with ``vector`` of
    ``right``, doubles.  All pairs are the result; they are made block by block (:mod:`pairforge.operators.blocked`)."""
    return products(left, right, "cid", "oid", vectors, vector)


def dense_cosine(left: DataFrame, right: DataFrame) -> DataFrame:
    """(cid, oid, cosine) of every pair of (cid, a) and (oid, b)."""
    return dense_cosines(left, right, {"cosine": "a"})


def clipped_cosine(cosine: Column) -> Column:
    """The cosine as a similarity in [0, 1]: no vector and no number count as 0."""
    return F.when(F.isnan(cosine) | cosine.isNull(), 0.0).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def blended(full: Column, focused: Column, share: float) -> Column:
    """Unit vectors of a full and a focused text, mixed."""
    return F.zip_with(unit(full), unit(focused), lambda x, y: (1 - share) * x + share * y)


#: ``monotonically_increasing_id`` counts rows in the low bits and partitions above them.
_ROW_BITS = 33


def position(df: DataFrame, keys: list, name: str, buckets: int | None = None) -> DataFrame:
    """A global 0-based position by ``keys`` of any type without a single-partition sort: ranges are sorted once, rows count inside
    them, and the sizes of the ranges before (one number each) are added."""
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_place", _ROW_BITS).cast("int")
    sizes = {r[0]: r[1] for r in ranged.groupBy(part.alias("part")).agg(F.count("*")).collect()}
    before = [sum(sizes.get(q, 0) for q in range(p)) for p in range(max(sizes, default=0) + 1)]
    inside = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return ranged.withColumn(name, F.element_at(literal(before, "bigint"), part + 1) + inside).drop("_place")


def percentile_ranks(df: DataFrame, names: dict[str, str], ties: list[str], ranges: str | None = None) -> DataFrame:
    """Position / (n - 1) in [0, 1] for each column of ``names`` (column -> name of its rank); equal values get different ranks, in the
    order of ``ties``.  ``df`` is made once, however many columns there are.  For ``ranges``, where all columns are floating numbers, see
    :func:`pairforge.operators.ranks.positions_by_runs`."""
    positions = {c: f"_pos_{name}" for c, name in names.items()}
    placed, n = positions_by_runs(df, positions, ties, ranges=ranges) if ranges else with_positions(stage(df, "ranked"), positions, ties)
    return placed.withColumns({name: F.col(f"_pos_{name}") / F.lit(max(n - 1, 1)) for name in names.values()}).drop(*[f"_pos_{name}" for name in names.values()])


def percentile_rank(df: DataFrame, value: str, ties: list[str], name: str) -> DataFrame:
    return percentile_ranks(df, {value: name}, ties)


def spearman(df: DataFrame, group: str, a: str, b: str) -> DataFrame:
    """(group, rho): the correlation of average ranks inside each group."""

    def average_rank(c: str):
        return F.rank().over(W.partitionBy(group).orderBy(c)) + (F.count("*").over(W.partitionBy(group, c)) - 1) / 2.0

    return df.withColumns({"_ra": average_rank(a), "_rb": average_rank(b)}).groupBy(group).agg(F.corr("_ra", "_rb").alias("rho"))


def separation(df: DataFrame, group: str, value: str, ties: str, top: int = 3) -> DataFrame:
    """(group, separation): the mean of the ``top`` largest values less the mean of the rest."""
    r = df.withColumn("_r", F.row_number().over(W.partitionBy(group).orderBy(F.col(value).desc(), ties)))
    return r.groupBy(group).agg((F.avg(F.when(F.col("_r") <= top, F.col(value))) - F.avg(F.when(F.col("_r") > top, F.col(value)))).alias("separation"))


def spearman_of_vectors(left: DataFrame, right: DataFrame, vectors: tuple[str, str], vector: str = "b", digits: int = 9, held_bytes: int = blocked.HELD_BYTES) -> DataFrame:
    """(cid, rho) of :func:`spearman` over the rounded cosines of two vectors of each row of ``left`` (unique cid) with all of ``right``, without a row for
    each pair.  Where the right vectors, counted first, don't fit into ``held_bytes`` of a task, pairs are formed and ranked by windows."""
    size = right.agg(F.sum(8.0 * F.size(vector))).first()[0] or 0
    if size <= held_bytes:
        return blocked.rank_correlations(left, right, "cid", "oid", vectors, vector, digits)
    both = dense_cosines(left, right, {"_a": vectors[0], "_b": vectors[1]}, vector)
    return spearman(both.withColumns({c: F.round(c, digits) for c in ("_a", "_b")}), "cid", "_a", "_b")


def separation_of_vectors(left: DataFrame, right: DataFrame, left_vector: str = "a", vector: str = "b", digits: int = 9, top: int = 3) -> DataFrame:
    """(cid, separation) of :func:`separation` over the rounded cosines of each row of ``left`` (unique cid) with all of ``right``, without a row
    for each pair: equal values are exchangeable, so counts, sums and the largest values of blocks are enough."""
    found = blocked.largest(left, right, "cid", "oid", left_vector, vector, top, digits)
    best = F.aggregate("top", F.lit(0.0), lambda s, x: s + x)
    rest = F.when(F.col("n") > top, (F.col("total") - best) / (F.col("n") - top))
    return found.select("cid", (best / F.nullif(F.size("top"), F.lit(0)) - rest).alias("separation"))


def percentiles_of_vectors(left: DataFrame, right: DataFrame, names: list[str], left_vector: str = "a", vector: str = "b", digits: int = 9, excess_digits: int = 8, held_bytes: int = blocked.HELD_BYTES) -> DataFrame:
    """(cid, oid, ``names``): :func:`percentile_ranks` over all pairs of the rounded cosine and, where a second name is given, of its excess over the mean of its cid,
    without a row for each pair in a stage table or a shuffle.  Where keys are not unique, vectors are null, hold a null or differ in length, or the right ones, counted
    first, don't fit into ``held_bytes`` of a task, pairs are staged and placed as rows."""

    def about(df: DataFrame, key: str, v: str):
        whole = F.col(key).isNotNull() & F.col(v).isNotNull() & ~F.exists(v, lambda x: x.isNull())
        return df.agg(F.count("*"), F.count_distinct(key), F.coalesce(F.every(whole), F.lit(True)), F.min(F.size(v)), F.max(F.size(v))).first()

    a, b = about(left, "cid", left_vector), about(right, "oid", vector)
    lengths = {x for x in (a[3], a[4], b[3], b[4]) if x is not None}
    if all(x[0] == x[1] and x[2] for x in (a, b)) and len(lengths) <= 1 and 0 not in lengths and b[0] * 8 * max(lengths, default=0) <= held_bytes:
        return blocked.percentiles(left, right, "cid", "oid", left_vector, vector, names, digits, excess_digits)
    c = dense_cosines(left, right, {"_cosine": left_vector}, vector).withColumn("_cosine", F.round("_cosine", digits))
    values = ["_cosine", "_excess"][: len(names)]
    if len(names) > 1:
        c = c.withColumn("_excess", F.round(F.col("_cosine") - F.avg("_cosine").over(W.partitionBy("cid")), excess_digits))
    return percentile_ranks(c, dict(zip(values, names, strict=True)), ["cid", "oid"]).select("cid", "oid", *names)
