"""The independent check of an export: every figure is derived again from its inputs, layer by layer."""

from __future__ import annotations

from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions.arrays import agreement
from pairforge.operators import scoring as O

#: How far a figure may lie from its recomputation, and an implied penalty from a legal one.
TOLERANCE, PENALTY_TOLERANCE = 0.0021, 0.02


def legal_factors() -> list[float]:
    """Products of every choice of penalties, the empty one included."""
    return sorted({round(prod(c), 6) for k in range(len(dims.PENALTY_FACTORS) + 1) for c in combinations(dims.PENALTY_FACTORS, k)})


def _composed(final: Column, base: Column, tolerance: float) -> Column:
    """The score is the floor, or the evidence times a product of penalties."""
    floor = F.abs(final - 0.05) <= tolerance
    implied = F.when(base > 1e-9, final / base).otherwise(1.0)
    legal = F.exists(F.array(*map(F.lit, legal_factors())), lambda p: F.abs(implied - p) <= PENALTY_TOLERANCE)
    return floor | ((final <= base + tolerance) & legal)


def verification(export: DataFrame, weights: dict[str, float] | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """(layer, checked, violations) over exported rows.

    ``export``: oid, cid, the exported sector_similarity, profile_similarity, product_similarity,
    value_chain_score, final_score, decision, match_type, opportunity_status, rank; and what they are
    derived from: company_node, opportunity_node, sem_profile, sem_product, required_roles, role,
    second_role, model, gate (null: not in the log), votes ("k/n"), human.
    """
    c = F.col
    far = lambda a, b: F.abs(a - b) > tolerance
    w = {k: v for k, v in (weights or dims.WEIGHTS_G4).items() if v > 0}
    exported = {"sector": c("sector_similarity"), "profile": c("profile_similarity"), "product": c("product_similarity")}
    base = O.fused(w, exported, normalise=True)
    k, n = agreement(c("votes"))
    light = F.coalesce(n, F.lit(3)) <= 1
    group = W.partitionBy("oid").orderBy("rank", "cid")
    tier, before = O.tier_index(c("decision")), F.lag(O.tier_index(c("decision"))).over(group)
    unsorted = (before > tier) | ((before == tier) & (F.lag("final_score").over(group) < c("final_score")))
    rows = export.withColumns({"_unsorted": F.coalesce(unsorted, F.lit(False)), "_gap": c("rank") != F.row_number().over(group)})
    status = O.opportunity_status(export, "oid").withColumnRenamed("status", "_status")
    rows = rows.join(status, "oid")
    graded = c("gate").isNotNull()
    layers = {
        "1 sector_similarity": (F.lit(True), far(O.taxonomy_similarity(c("company_node"), c("opportunity_node")), c("sector_similarity"))),
        "2a profile_similarity": (F.lit(True), far(c("sem_profile"), c("profile_similarity"))),
        "2b product_similarity": (F.lit(True), far(c("sem_product"), c("product_similarity"))),
        "3 value_chain_score": (F.lit(True), far(O.value_chain_score(c("required_roles"), c("role"), c("second_role")), c("value_chain_score"))),
        "4 composition": (F.lit(True), ~_composed(c("final_score"), base, tolerance)),
        "5 decision": (graded, graded & (O.decide_g4(c("final_score"), c("gate"), c("human"), light) != c("decision"))),
        "6a match_type": (F.lit(True), O.match_type(c("decision"), c("value_chain_score"), c("model"), c("role")) != c("match_type")),
        "6b opportunity_status": (F.lit(True), c("_status") != c("opportunity_status")),
        "7 rank": (F.lit(True), c("_unsorted") | c("_gap")),
    }
    cells = [F.struct(F.lit(name).alias("layer"), F.count_if(used).alias("checked"), F.count_if(F.coalesce(bad, F.lit(True))).alias("violations")) for name, (used, bad) in layers.items()]
    return rows.agg(F.array(*cells).alias("l")).select(F.inline("l"))
