"""Corpus vocabulary and shared-evidence operators (equi-joins on tokens, never a cross join)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions.text import static_tokens
from pairforge.operators import postings
from pairforge.operators.similarity import position
from pairforge.sources.stages import broadcast_if_small, stage


def token_rows(df: DataFrame, key: str, text: str, generic: list[str] | None = None) -> DataFrame:
    """(key, token): each different token of each text once."""
    return df.select(key, F.explode(static_tokens(F.col(text), generic)).alias("token"))


def protected_terms(df: DataFrame, sector: str | None = None) -> DataFrame:
    """Tokens that stay however common they are: sector labels, ontology and bridge terms."""
    fixed = sorted({*dims.SECTOR_ONTOLOGY, *(v for vs in dims.SECTOR_ONTOLOGY.values() for v in vs), *(t for r in dims.BRIDGE_RULES for t in r[2])})
    out = df.sparkSession.createDataFrame([(t,) for t in fixed], "token string")
    return out.union(df.select(F.explode(static_tokens(F.col(sector))))).distinct() if sector else out


def document_frequency(tokens: DataFrame, n_docs: DataFrame) -> DataFrame:
    """(token, cnt, n, idf, doc_ratio) from token rows; ``n_docs`` is one row with ``n``."""
    df = tokens.groupBy("token").agg(F.count("*").alias("cnt")).join(F.broadcast(n_docs))  # one row
    return df.withColumns({"idf": F.log(F.col("n") / (1 + F.col("cnt"))) + 1.0, "doc_ratio": F.col("cnt") / F.col("n")})


def is_common(cnt: Column, ratio: Column) -> Column:
    return (cnt >= dims.COMMON_MIN_DOCS) & (ratio >= dims.COMMON_RATIO)


def vocabulary(corpus: DataFrame, protected: DataFrame, domain_tokens: DataFrame) -> DataFrame:
    """The vocabulary of ``corpus``: (key, text), one row for each text."""
    n = corpus.agg(F.greatest(F.count("*"), F.lit(1)).alias("n"))
    return vocabulary_of_tokens(token_rows(corpus, "key", "text"), n, protected, domain_tokens)


def vocabulary_of_tokens(tokens: DataFrame, n_docs: DataFrame, protected: DataFrame, domain_tokens: DataFrame) -> DataFrame:
    """(token, cnt, n, idf, doc_ratio, is_common, is_protected, is_domain) from token rows made before.

    ``domain_tokens``: (token) from sector and requirement texts; ``n_docs``: one row with ``n``.
    """
    df = document_frequency(tokens, n_docs)
    p = protected.select("token", F.lit(True).alias("is_protected"))
    d = domain_tokens.select("token").union(protected.select("token")).distinct().filter(F.length("token") >= 4).select("token", F.lit(True).alias("is_domain"))
    out = df.join(p, "token", "left").join(d, "token", "left").na.fill(False, ["is_protected", "is_domain"])
    return out.withColumn("is_common", is_common(F.col("cnt"), F.col("doc_ratio")) & ~F.col("is_protected"))


def usable_terms(vocab: DataFrame) -> DataFrame:
    """(token, cnt, n, idf, strict): the domain terms that count as evidence."""
    usable = vocab.filter(F.col("is_domain") & ~F.col("is_common") & (F.col("idf") >= dims.MIN_EVIDENCE_IDF) & ~F.col("token").isin(dims.NON_CAPABILITY_TERMS))
    return usable.select("token", "cnt", "n", "idf", (F.col("doc_ratio") <= dims.EVIDENCE_MAX_DOC_RATIO).alias("strict"))


def evidence_terms(left: DataFrame, right: DataFrame, vocab: DataFrame) -> DataFrame:
    """(cid, oid, token, idf, strict): shared domain terms of each pair, by an equi-join on the
    token.  Both sides are reduced to usable domain terms first, so the join carries no filler."""
    o = right.join(usable_terms(vocab).drop("cnt", "n"), "token")  # the small side carries the weights
    return left.join(o, "token").select("cid", "oid", "token", "idf", "strict")


#: Terms in more than this share of all texts, and in more than so many, are heavy.
HEAVY_SHARE, HEAVY_TEXTS = 0.02, 500
#: Texts of a heavy term that meet under one key.
SALTED_TEXTS = 100_000
#: Bits of a mask that one column holds.
WORD_BITS = 62


def _masked(tokens: DataFrame, key: str, heavy: DataFrame, words: int) -> DataFrame:
    """(key, m0, m1, ..): the heavy terms of each text as bits."""
    own = tokens.join(F.broadcast(heavy), "token")
    bit = F.expr("shiftleft(1L, shift)")
    return own.groupBy(key).agg(*[F.coalesce(F.bit_or(F.when(F.col("word") == w, bit)), F.lit(0)).cast("long").alias(f"m{w}") for w in range(words)])


def _heavy_pairs(left: DataFrame, right: DataFrame, heavy: DataFrame, words: int) -> DataFrame:
    """(cid, oid, m0, m1, ..): every pair with a heavy term in common, once, and the common ones as bits.  A pair meets under each common
    term and is kept under the first; texts of one term are dealt over several keys by a hash, and the other side goes to each of them."""
    c = _masked(left, "cid", heavy, words).select("cid", *[F.col(f"m{w}").alias(f"c{w}") for w in range(words)])
    o = _masked(right, "oid", heavy, words).select("oid", *[F.col(f"m{w}").alias(f"o{w}") for w in range(words)])
    places = F.from_json(F.lit(json.dumps([{k: r[k] for k in ("word", "shift", "salts")} for r in heavy.collect()])), "array<struct<word:int,shift:int,salts:int>>")

    def opened(df: DataFrame, key: str, side: str) -> DataFrame:
        """A row for each heavy term of each text."""
        held = F.array(*[F.col(f"{side}{w}") for w in range(words)])
        own = F.filter(places, lambda x: F.get(held, x["word"]).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), x["shift"])) != 0)
        return df.select("*", F.explode(own).alias("x")).select(key, *[f"{side}{w}" for w in range(words)], "x.*")

    c = opened(c, "cid", "c").withColumn("salt", F.pmod(F.xxhash64("cid"), F.col("salts")).cast("int")).drop("salts")
    o = opened(o, "oid", "o").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    met = c.join(o, ["word", "shift", "salt"])
    both = [F.col(f"c{w}").bitwiseAND(F.col(f"o{w}")) for w in range(words)]
    first = F.lit(False)
    for w in range(words):
        none_before = F.lit(True)
        for x in both[:w]:
            none_before = none_before & (x == 0)
        first = first | ((F.col("word") == w) & none_before & (both[w].bitwiseAND(F.expr("shiftleft(1L, shift) - 1")) == 0))
    return met.filter(first).select("cid", "oid", *[x.alias(f"m{w}") for w, x in enumerate(both)])


def shared_evidence(left: DataFrame, right: DataFrame, vocab: DataFrame, heavy_share: float = HEAVY_SHARE, heavy_texts: int = HEAVY_TEXTS, salted: int = SALTED_TEXTS, scored: int = 10, shown: int = 8) -> DataFrame:
    """(cid, oid, n_terms, evidence_score, terms) as :func:`evidence` of :func:`evidence_terms`, without a row for each heavy term of each pair.

    A term in very many texts would put all of them under one key of the join, and itself into every pair.  Such terms, counted in the
    vocabulary, leave the join and become bits: a pair gets the bits that both texts have, in one row.  Heavy terms are the most
    frequent, hence last in the order of evidence, so they follow the light ones in the pair's list."""
    usable = stage(usable_terms(vocab), "usable")
    is_heavy = (F.col("cnt") > heavy_texts) & (F.col("cnt") > heavy_share * F.col("n"))
    found = sorted(usable.filter(is_heavy).collect(), key=lambda r: (-r["idf"], r["token"]))
    light_terms = usable.filter(~is_heavy).drop("cnt", "n")
    entry = F.struct((-F.col("idf")).alias("w"), "token", "strict")
    light = left.join(right.join(light_terms, "token"), "token").select("cid", "oid", entry.alias("term"))
    if not found:
        return _evidence(light.groupBy("cid", "oid").agg(F.sort_array(F.collect_list("term")).alias("l")), F.size("l"), scored, shown)
    words = -(-len(found) // WORD_BITS)
    rows = [(r["token"], k // WORD_BITS, k % WORD_BITS, -(-r["cnt"] // salted)) for k, r in enumerate(found)]
    heavy = left.sparkSession.createDataFrame(rows, "token string, word int, shift int, salts int")
    masks = [f"m{w}" for w in range(words)]
    pairs = _heavy_pairs(left, right, heavy, words).withColumn("term", F.lit(None).cast(light.schema["term"].dataType))
    g = light.withColumns({m: F.lit(0).cast("long") for m in masks}).unionByName(pairs).groupBy("cid", "oid")
    g = g.agg(F.sort_array(F.collect_list("term")).alias("light"), *[F.max(m).alias(m) for m in masks])  # bits below the sign: the greater is the pair's
    terms = F.from_json(F.lit(json.dumps([{"w": -r["idf"], "token": r["token"], "strict": r["strict"], "at": k} for k, r in enumerate(found)])), "array<struct<w:double,token:string,strict:boolean,at:int>>")
    held = F.array(*masks)
    common = F.filter(terms, lambda x: F.get(held, F.floor(x["at"] / WORD_BITS).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), x["at"] % WORD_BITS)) != 0)
    any_ = sum((F.bit_count(m) for m in masks[1:]), F.bit_count(masks[0]))
    plain = F.transform(common, lambda x: F.struct(x["w"].alias("w"), x["token"].alias("token"), x["strict"].alias("strict")))
    g = g.withColumn("n", F.size("light") + any_).withColumn("l", F.when(any_ > 0, F.concat("light", plain)).otherwise(F.col("light")))
    return _evidence(g, F.col("n"), scored, shown)


def evidence_by_blocks(left: DataFrame, right: DataFrame, vocab: DataFrame, scored: int = 10, shown: int = 8) -> DataFrame:
    """(cid, oid, n_terms, evidence_score, terms) as :func:`evidence` of :func:`evidence_terms`: each text is one row with the ranks of its usable terms, and
    blocks of texts meet (:mod:`pairforge.operators.postings`), so no row for each term of each pair is shuffled."""
    terms = stage(usable_terms(vocab).join(right.select("token").distinct(), "token").select("token", "idf", "strict", (-F.col("idf")).alias("_w")), "usable")
    ranks = stage(position(terms, ["_w", "token"], "rank"), "term-ranks")
    near = broadcast_if_small(ranks)
    c = left.join(near.select("token", "rank"), "token").groupBy("cid").agg(F.sort_array(F.collect_list("rank")).alias("ranks"))
    entry = F.sort_array(F.collect_list(F.struct("rank", "idf", "strict", "token")))
    o = right.join(near, "token").groupBy("oid").agg(entry.alias("x")).select("oid", F.col("x.rank").alias("ranks"), "x.idf", "x.strict", "x.token")
    return postings.evidence(c, o, scored, shown)


def _evidence(g: DataFrame, n: Column, scored: int, shown: int) -> DataFrame:
    """The score and the shown terms of pairs with ``l``, their terms in order: lenient terms count, strict ones score and are
    shown (all are shown if none is strict)."""
    g = g.withColumn("s", F.filter("l", lambda x: x["strict"]))
    total = F.aggregate(F.slice("s", 1, scored), F.lit(0.0), lambda a, x: a - x["w"])
    show = F.when(F.size("s") > 0, F.col("s")).otherwise(F.col("l"))
    return g.select("cid", "oid", n.cast("long").alias("n_terms"), (1 - F.exp(-total / 8.0)).alias("evidence_score"), F.transform(F.slice(show, 1, shown), lambda x: x["token"]).alias("terms"))


def evidence(terms: DataFrame, scored: int = 10, shown: int = 8) -> DataFrame:
    """(cid, oid, n_terms, evidence_score, terms) of the rows of :func:`evidence_terms`."""
    entry = F.struct((-F.col("idf")).alias("w"), "token", "strict")
    return _evidence(terms.groupBy("cid", "oid").agg(F.sort_array(F.collect_list(entry)).alias("l")), F.size("l"), scored, shown)


def g1_terms(pairs: DataFrame, limit: int = 5) -> DataFrame:
    """(cid, oid, terms) of the first generation: domain words of four letters that are not blacklisted, by
    idf and length; where a pair has none, shorter ones of some idf."""
    kept = pairs.filter(~F.col("token").isin(dims.EXPLANATION_BLACKLIST_G1))
    long = F.length("token") >= 4
    entry = F.struct((-F.col("idf")).alias("w"), (-F.length("token")).alias("l"), "token")
    g = kept.groupBy("cid", "oid").agg(F.sort_array(F.collect_list(F.when(long, entry))).alias("a"), F.sort_array(F.collect_list(F.when(~long & (F.col("idf") >= dims.G1_FALLBACK_IDF), entry))).alias("b"))
    ranked = F.when(F.size("a") > 0, F.col("a")).otherwise(F.col("b"))
    return g.withColumn("r", ranked).filter(F.size("r") > 0).select("cid", "oid", F.transform(F.slice("r", 1, limit), lambda x: x["token"]).alias("terms"))
