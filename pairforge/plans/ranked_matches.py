"""The flagship plan: companies ranked for each opportunity by shared evidence, sector and percentile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions.arrays import half_up
from pairforge.operators.ranking import ranked
from pairforge.operators.similarity import percentile_rank
from pairforge.operators.vocabulary import evidence_by_blocks, evidence_terms, protected_terms, token_rows, vocabulary_of_tokens
from pairforge.sources.stages import stage


def _sides(companies: DataFrame, opportunities: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tokens of companies, of opportunities, the vocabulary of both); each text is tokenised once."""
    c, o = stage(token_rows(companies, "cid", "text"), "tokens"), stage(token_rows(opportunities, "oid", "text"), "tokens")
    n = companies.select("cid").union(opportunities.select("oid")).agg(F.greatest(F.count("*"), F.lit(1)).alias("n"))
    return c, o, vocabulary_of_tokens(c.select("token").union(o.select("token")), n, protected_terms(opportunities), o.select("token"))


def shared_terms(companies: DataFrame, opportunities: DataFrame) -> DataFrame:
    """(cid, oid, token, idf, strict): a row for each shared term."""
    return evidence_terms(*_sides(companies, opportunities))


def evidence_of_pairs(companies: DataFrame, opportunities: DataFrame) -> DataFrame:
    """(cid, oid, n_terms, evidence_score, terms): a row for each pair with a shared term."""
    return evidence_by_blocks(*_sides(companies, opportunities))


def ranked_matches(companies: DataFrame, opportunities: DataFrame, top: int = 3) -> DataFrame:
    """(oid, cid, rank, n_terms, evidence, sector, final): the best ``top`` companies of each opportunity.

    Pairs come from an equi-join on shared domain terms, so pairs without evidence never exist; texts
    are tokenised once; the percentile is taken over range partitions.
    """
    found = evidence_of_pairs(companies, opportunities).filter(F.col("n_terms") >= dims.MIN_EVIDENCE_TERMS)
    pairs = found.join(companies.select("cid", F.col("sector").alias("cs")), "cid").join(opportunities.select("oid", F.col("sector").alias("os")), "oid")
    scored = pairs.select("cid", "oid", "n_terms", half_up(F.col("evidence_score"), 6).alias("evidence"), F.when(F.col("cs") == F.col("os"), 1.0).otherwise(0.0).alias("sector"))
    w = dims.WEIGHTS_G3
    final = (w["profile"] + w["product"]) * F.col("pct") + w["sector"] * F.col("sector") + w["evidence"] * F.col("evidence")
    fused = percentile_rank(scored, "evidence", ["cid", "oid"], "pct").withColumn("final", half_up(final, 6))
    best = ranked(fused, "oid", [F.col("final").desc(), "cid"], "rank").filter(F.col("rank") <= top)
    return best.select("oid", "cid", "rank", "n_terms", half_up(F.col("evidence"), 4).alias("evidence"), "sector", half_up(F.col("final"), 4).alias("final"))
