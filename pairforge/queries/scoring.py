"""Sector scores, taxonomy, value chain, fusion, decisions and rankings over supplier x nation pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions.arrays import clamp, half_up
from pairforge.operators import ranking as R
from pairforge.operators import scoring as O
from pairforge.operators.similarity import position
from pairforge.queries.base import PAIRS_SQL, pairs, pick, pp, pp0, sql_list, sql_map, sql_pick, sql_text, t, toks

S = SparkSession

SECTORS = ["Industrial Manufacturing", "ICT Hardware", "Pharmaceutical", "MedTech", "Oil, Gas, Energy & Water", "Mining", "Telecommunications", "Electrical Equipment", "Healthcare", "", "Agri Food", "Semiconductors", "industrial  manufacturing!"]
CAPABILITIES = [["electronics", "cables"], ["assembly"], ["precision", "chemical"], ["imaging", "data", "software"], ["sterile", "cleanroom", "chemicals"], ["refining", "synthesis"], ["device", "devices"], []]
G0_SECTORS = ["ICT", "Telecom", "ict-hardware", "MedTech", "Health care", "Healthcare", "Pharma", "Life Sciences", "Mining", ""]
NODES = ["", *sorted({*dims.TAXONOMY, *(leaf for leaves in dims.TAXONOMY.values() for leaf in leaves)}), "unheard of"]


def _sides(s: S, d: str) -> DataFrame:
    """Different (company sector, opportunity sector, capabilities) are scored once and joined back."""
    c = t(s, d, "supplier").select(F.col("s_suppkey").alias("cid"), pick(SECTORS, F.col("s_suppkey")).alias("cs"), pick([" ".join(x) for x in CAPABILITIES], F.floor(F.col("s_suppkey") / 3)).alias("cap"))
    o = t(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("oid"), pick(SECTORS, F.col("n_nationkey") * 5).alias("os"))
    return c.crossJoin(o)


def _scored(s: S, d: str, with_score) -> DataFrame:
    p = _sides(s, d)
    kinds = p.select("cs", "os", "cap").distinct().withColumn("tokens", F.filter(F.split("cap", " "), lambda x: x != ""))
    return p.join(with_score(kinds, "cs", "os", "tokens").drop("tokens"), ["cs", "os", "cap"])


def sector_score(s: S, d: str) -> DataFrame:
    return _scored(s, d, O.with_sector_score).select("cid", "oid", F.round("sector_score", 6).alias("sector_score"), "sector_label", "bridge_name", "sector_reason")


def g1_sector_score(s: S, d: str) -> DataFrame:
    return _scored(s, d, O.with_g1_sector_score).select("cid", "oid", F.round("sector_score", 6).alias("sector_score"), "sector_label")


def g0_sector_match(s: S, d: str) -> DataFrame:
    return pairs(s, d).select("cid", "oid", O.g0_sector_match(pick(G0_SECTORS, F.col("cid")), pick(G0_SECTORS, F.col("oid") * 3)).alias("sector_match"))


def taxonomy_similarity(s: S, d: str) -> DataFrame:
    return pairs(s, d).select("cid", "oid", F.round(O.taxonomy_similarity(pick(NODES, F.col("cid")), pick(NODES, F.col("oid"))), 3).alias("similarity"))


def value_chain_score(s: S, d: str) -> DataFrame:
    o = F.col("oid")
    needs = F.when(o % 7 == 0, F.array().cast("array<string>")).otherwise(F.array(pick(dims.ROLES, o), pick(dims.ROLES, o * 5 + 2), pick(dims.ROLES, o + 7), pick(dims.ROLES, o + 9)))
    return pairs(s, d).select("cid", "oid", O.value_chain_score(needs, pick([*dims.ROLES, ""], F.col("cid")), pick([*dims.ROLES, ""], F.col("cid") * 3 + 1)).alias("score"))


_DIMS = list(dict.fromkeys([*dims.CORE_DIMS, *dims.STRATEGIC_DIMS, *dims.LOCALIZATION_DIMS]))


def readiness(s: S, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    entries = [F.struct(F.lit(n).alias("key"), F.when((k + i) % 5 != 0, ((k * 7 + i * 13) % 100) / 100.0).alias("value")) for i, n in enumerate(_DIMS)]
    m = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))
    return t(s, d, "supplier").select("s_suppkey", O.readiness(m, dims.CORE_DIMS).alias("core"), O.readiness(m, dims.STRATEGIC_DIMS).alias("strategic"), O.readiness(m, dims.LOCALIZATION_DIMS).alias("localization"))


def _p(*names: str) -> list:
    return [F.col(n) for n in names]


def _with_penalties(s: S, d: str) -> DataFrame:
    factor, names = O.penalties(*_p("sector", "profile", "product", "chain", "role", "lead"))
    return pairs(s, d).withColumns({"factor": factor, "names": names})


def penalties(s: S, d: str) -> DataFrame:
    return _with_penalties(s, d).select("cid", "oid", F.round("factor", 6).alias("factor"), F.array_join("names", ",").alias("names"))


def fusion_g3(s: S, d: str) -> DataFrame:
    """Fusion and label; the label reads the unrounded value."""
    f = O.fused(dims.WEIGHTS_G3, {k: F.col(k) for k in dims.WEIGHTS_G3})
    return pairs(s, d).withColumn("f", f).select("cid", "oid", half_up(F.col("f")).alias("final_score"), O.decision_g3(*_p("f", "qualified", "linked", "verdict", "bridge_only")).alias("ai_decision"))


def qualification(s: S, d: str) -> DataFrame:
    """Qualified, soft-candidate and link flags, and the cap on unseen optimism."""
    n = F.col("cid") % 5
    label = F.when(F.col("sector") >= 0.9, "Exact").otherwise(O.score_label(F.col("sector")))
    q = O.qualification(n, label, *_p("sector", "profile", "product", "bridge_only"))
    capped = O.unseen_cap(F.col("decision"), q["qualified"], F.col("verdict"), ["Good Match", "Excellent Match"])
    return pairs(s, d).select("cid", "oid", *[v.alias(k) for k, v in q.items()], capped.alias("capped"))


def _decided(s: S, d: str) -> DataFrame:
    parts = {"sector": F.col("sector"), "profile": F.col("profile"), "product": F.col("product")}
    p = _with_penalties(s, d).withColumn("final", O.fusion_g4(parts, F.col("factor")))
    return p.withColumn("decided", O.decide_g4(*_p("final", "verdict", "human", "light")))


def fusion_g4(s: S, d: str) -> DataFrame:
    return _decided(s, d).select("cid", "oid", F.col("final").alias("final_score"), O.tier(F.col("final")).alias("tier"))


def decide_g4(s: S, d: str) -> DataFrame:
    return _decided(s, d).select("cid", "oid", F.col("decided").alias("decision"))


def _typed(s: S, d: str) -> DataFrame:
    return _decided(s, d).withColumn("match_type", O.match_type(*_p("decided", "chain", "model", "role")))


def match_type(s: S, d: str) -> DataFrame:
    return _typed(s, d).select("cid", "oid", "match_type")


def opportunity_status(s: S, d: str) -> DataFrame:
    return O.opportunity_status(_typed(s, d).select("oid", F.col("decided").alias("decision"), "match_type"), "oid")


def confidence_g4(s: S, d: str) -> DataFrame:
    p = _with_penalties(s, d)
    c = O.confidence_g4((F.col("cid") * 37) % 900, F.col("evidence"), F.array("sector", "profile", "product", "chain", "evidence"), F.col("votes"), F.col("sector"), F.size("names") > 0)
    return p.withColumn("confidence", c).select("cid", "oid", "confidence", O.confidence_label(F.col("confidence")).alias("label"))


def report_fields(s: S, d: str) -> DataFrame:
    return pairs(s, d).select("cid", "oid", O.report_role(F.col("verdict")).alias("role"), O.report_confidence(F.col("human"), F.col("votes")).alias("confidence"))


def g1_scores(s: S, d: str) -> DataFrame:
    """First generation: strict sector filter, soft match, proxy score, fusion, label, band."""
    score = O.g1_soft_sector(*_p("sector"), F.col("cid") % 3 != 0, *_p("profile", "product"), F.col("sector") < 0.1)
    p = pairs(s, d).withColumn("s", score).filter(F.col("s") >= dims.SECTOR_MIN_G1).withColumn("ai", O.g1_proxy(*_p("profile", "product", "s")))
    final = O.g1_fusion(*_p("profile", "product", "s", "ai"))
    return p.select("cid", "oid", half_up(F.col("ai")).alias("ai_score"), half_up(final).alias("final_score"), O.decision_g1(*_p("s", "profile", "product", "ai", "verdict")).alias("ai_decision"), O.semantic_band(F.col("product")).alias("band"))


def g0_scores(s: S, d: str) -> DataFrame:
    """Legacy: yes / no replies as .95 / .3, fusion .4 .4 .2, ranks inside batches of ten sources."""
    reply = F.when(F.lower(F.coalesce("verdict", F.lit(""))).startswith("yes"), 0.95).when(F.col("verdict").isNull(), 0.0).otherwise(0.3)
    p = pairs(s, d).withColumn("final_score", O.g0_fusion(*_p("profile", "product"), reply))
    return R.batch_rank(p, "cid", "oid", [F.col("final_score").desc(), "cid"], "rank").select("cid", "oid", F.col("batch").cast("long").alias("batch"), "final_score", "rank")


def g2_scores(s: S, d: str) -> DataFrame:
    """Second generation: decision coerced, fusion, rank by (final, product), global id by (company, rank)."""
    p = pairs(s, d).withColumn("final_score", O.g2_fusion(*_p("profile", "product", "verdict")))
    p = R.ranked(p, "oid", [F.col("final_score").desc(), F.col("product").desc(), "cid"], "rank")
    return position(p.select("cid", "oid", "final_score", "rank", F.greatest("profile", "product").alias("sector_similarity")), ["cid", "rank", "oid"], "_at").select((F.col("_at") + 1).alias("id"), "cid", "oid", "final_score", "rank", "sector_similarity")


def match_value_rank(s: S, d: str) -> DataFrame:
    p = pairs(s, d)
    return R.ranked(p, "oid", [F.col("match_value").desc(), F.col("profile").desc(), "cid"], "rank").select("cid", "oid", "rank", O.match_value_band(F.col("match_value")).alias("band"), O.match_path_g2(F.col("sector") >= 0.7, F.greatest("profile", "product")).alias("path"))


def match_value_bands(s: S, d: str) -> DataFrame:
    return pairs(s, d).groupBy(O.match_value_band(F.col("match_value")).alias("band")).agg(F.count("*").alias("n"))


def triage(s: S, d: str) -> DataFrame:
    c, o = F.col("cid"), F.col("oid")
    fields = O.triage(F.col("sector") >= 0.9, (c + o) % 11 == 0, ((c * 3 + o) % 4).cast("int"), F.when((c + o) % 9 == 0, 1).otherwise(0), F.col("product"), F.col("profile"))
    return pairs(s, d).select("cid", "oid", *[v.alias(k) for k, v in fields.items()])


def triage_counts(s: S, d: str) -> DataFrame:
    p = triage(s, d)
    return p.agg(*[F.count_if(c).alias(c) for c in p.columns if c.startswith("hit_")], F.count_if("triage_pass").alias("passed"), F.count_if(~F.col("triage_pass")).alias("filtered"))


def unit_clamp(s: S, d: str) -> DataFrame:
    return t(s, d, "events").select("event_id", clamp(F.col("value") / 50.0 - 0.3).alias("result"))


def rank_opportunity(s: S, d: str) -> DataFrame:
    return R.qualified_rank(pairs(s, d), "oid", "profile", ["cid"], "rank").select("cid", "oid", "rank")


def rank_company(s: S, d: str) -> DataFrame:
    return R.qualified_rank(pairs(s, d), "cid", "profile", ["oid"], "rank").select("cid", "oid", "rank")


def rank_both(s: S, d: str) -> DataFrame:
    p = R.ranked(pairs(s, d), "cid", [F.col("profile").desc(), "oid"], "company_rank")
    return R.ranked(p, "oid", [F.col("profile").desc(), "cid"], "opportunity_rank").select("cid", "oid", "company_rank", "opportunity_rank")


def topn_gate(s: S, d: str) -> DataFrame:
    """Pairs for the gate (rank <= 3 among the qualified), and the views: 5 for each opportunity, 3 for each company."""
    p = R.qualified_rank(R.qualified_rank(pairs(s, d), "oid", "profile", ["cid"], "ro"), "cid", "profile", ["oid"], "rc")
    return p.filter("ro <= 5 OR rc <= 3").select("cid", "oid", (F.coalesce("ro", F.lit(99)) <= 3).alias("gate"), (F.coalesce("ro", F.lit(99)) <= 5).alias("opportunity_view"), (F.coalesce("rc", F.lit(99)) <= 3).alias("company_view"))


def pursue_rank(s: S, d: str) -> DataFrame:
    """Ranks by tier then score, and each opportunity's lead tier and score on all its rows."""
    p = _decided(s, d).withColumn("ti", O.tier_index(F.col("decided")))
    order = ["ti", F.col("final").desc(), "cid"]
    p = R.first_of_group(R.ranked(p, "oid", order, "pursue_rank"), "oid", order, {"lead_tier": "decided", "lead_score": "final"})
    return p.select("cid", "oid", "pursue_rank", "lead_tier", "lead_score")


def export_top(s: S, d: str) -> DataFrame:
    """The export: five best pairs of each company, rejected ones included, three-place numbers."""
    p = R.ranked(_decided(s, d), "cid", [F.col("final").desc(), "oid"], "rank").filter("rank <= 5")
    p = p.withColumns({"recommended_engagement": F.concat(F.lit("call "), F.col("cid").cast("string")), "suggested_localization_model": F.col("model")}).withColumns(O.blanked(F.col("decided")))
    return p.select("cid", "oid", "rank", clamp(F.col("final")).alias("final_score"), "decided", F.col("suggested_localization_model").alias("model"), F.col("recommended_engagement").alias("engagement"))


QUERIES = {
    "sector_score": sector_score, "g1_sector_score": g1_sector_score, "g0_sector_match": g0_sector_match, "taxonomy_similarity": taxonomy_similarity, "value_chain_score": value_chain_score,
    "readiness": readiness, "penalties": penalties, "fusion_g3": fusion_g3, "qualification": qualification, "fusion_g4": fusion_g4, "decide_g4": decide_g4, "match_type": match_type,
    "opportunity_status": opportunity_status, "confidence_g4": confidence_g4, "report_fields": report_fields, "g1_scores": g1_scores, "g0_scores": g0_scores, "g2_scores": g2_scores,
    "match_value_rank": match_value_rank, "match_value_bands": match_value_bands, "triage": triage, "triage_counts": triage_counts, "unit_clamp": unit_clamp, "rank_opportunity": rank_opportunity,
    "rank_company": rank_company, "rank_both": rank_both, "topn_gate": topn_gate, "pursue_rank": pursue_rank, "export_top": export_top,
}

# --- SQL -----------------------------------------------------------------------------------------


def _list_map(table: dict) -> str:
    return "MAP {" + ", ".join(f"{sql_text(k)}: {sql_list(v)}" for k, v in table.items()) + "}"


def _bag(x: str, token_map: dict, ontology: dict, generic: list[str] | None = None) -> str:
    canon = f"list_distinct([coalesce({sql_map(token_map)}[w], w) for w in {toks(x, generic)}])"
    return f"list_distinct(list_concat({canon}, flatten([coalesce({_list_map(ontology)}[w], []) for w in {canon}])))"


def _group_hit(groups: list[list[str]]) -> str:
    return " OR ".join(f"(list_has_any(c, {sql_list(g)}) AND list_has_any(o, {sql_list(g)}))" for g in groups)


def _crossed(a: list[str], b: list[str]) -> str:
    a, b = sql_list(a), sql_list(b)
    return f"((list_has_any(c, {a}) AND list_has_any(o, {b})) OR (list_has_any(c, {b}) AND list_has_any(o, {a})))"


SIDES_SQL = (
    f"SELECT cid, oid, cs, os, list_filter(string_split(cap, ' '), lambda x: x <> '') AS cap FROM (SELECT s_suppkey AS cid, {sql_pick(SECTORS, 's_suppkey')} AS cs, "
    f"{sql_pick([' '.join(x) for x in CAPABILITIES], 's_suppkey // 3')} AS cap FROM supplier) CROSS JOIN (SELECT n_nationkey::BIGINT AS oid, {sql_pick(SECTORS, 'n_nationkey * 5')} AS os FROM nation)"
)
_label = "CASE WHEN {s} >= 0.8 THEN 'Strong' WHEN {s} >= 0.5 THEN 'Moderate' WHEN {s} > 0 THEN 'Weak' ELSE 'No' END"
_jac = "coalesce(len(list_intersect(c, o)) / nullif(len(list_distinct(list_concat(c, o))), 0), 0.0)"
_hits = lambda terms: f"list_distinct(list_intersect(cap, {sql_list(terms)}))"
_gen = sql_list(dims.GENERIC_BRIDGE_TERMS)
_fire = [f"base < 0.5 AND {s} > base AND {_crossed(a, b)} AND len({_hits(terms)}) >= {n} AND len(list_filter({_hits(terms)}, lambda h: NOT list_contains({_gen}, h))) > 0" for a, b, terms, s, _, n in dims.BRIDGE_RULES]
_generic1 = [*dims.GENERIC_TERMS, *dims.GENERIC_TERMS_G1]
_fire1 = [f"base < 0.5 AND {s} > base AND {_crossed(a, b)} AND list_has_any(cap, {sql_list(terms)})" for a, b, terms, s, _, _ in dims.BRIDGE_RULES_G1]
# the first rule that crosses decides, whether or not it beats the base
_cross1 = [f"{_crossed(a, b)} AND list_has_any(cap, {sql_list(terms)})" for a, b, terms, _, _, _ in dims.BRIDGE_RULES_G1]
_families = {**{f: f for f in dims.TAXONOMY}, **{leaf: f for f, leaves in dims.TAXONOMY.items() for leaf in leaves}}
_affinity = {"|".join(sorted(k)): v for k, v in dims.FAMILY_AFFINITY.items()}
_compat = {f"{n}|{r}": s for n, r, s in dims.ROLE_COMPATIBILITY}
_mean = lambda names: f"round(({' + '.join(f'coalesce(d[{sql_text(n)}], 0.3)' for n in names)}) / {len(names)} + 1e-9, 3)"
_dims_map = "MAP_FROM_ENTRIES(list_filter([" + ", ".join(f"{{'k': {sql_text(n)}, 'v': CASE WHEN (s_suppkey + {i}) % 5 <> 0 THEN ((s_suppkey * 7 + {i} * 13) % 100) / 100.0::DOUBLE END}}" for i, n in enumerate(_DIMS)) + "], lambda e: e.v IS NOT NULL))"
_PEN = [
    ("product_only_similarity", "product >= 0.7 AND profile < 0.45 AND sector < 0.4", 0.65), ("sector_mismatch", "sector < 0.25", 0.75), ("value_chain_mismatch", "chain < 0.3", 0.70),
    ("supplier_to_developer", "role IN ('Raw Material Supplier', 'Distributor') AND lead IN ('Developer', 'Research Company', 'OEM')", 0.70),
    ("business_model_mismatch", "role IN ('Investor', 'Service Provider') AND lead IN ('Contract Manufacturer', 'OEM')", 0.70),
]
_factor = " * ".join(f"(CASE WHEN {c} THEN {f} ELSE 1.0 END)::DOUBLE" for _, c, f in _PEN)
_names = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {sql_text(n)} END" for n, c, _ in _PEN) + "], lambda x: x IS NOT NULL)"
_tier_names = [n for _, n in dims.TIERS]
_tier = lambda s: "CASE " + " ".join(f"WHEN {s} >= {c} THEN {sql_text(n)}" for c, n in dims.TIERS[:-1]) + f" ELSE {sql_text(dims.TIERS[-1][1])} END"
_total = sum(dims.WEIGHTS_G4.values())
_base4 = " + ".join(f"{w / _total} * {k}" for k, w in dims.WEIGHTS_G4.items() if w)
_at = {n: i for i, n in enumerate(_tier_names)}
_index = f"list_position({sql_list(_tier_names)}, {_tier('final')}) - 1"
DECIDED = f"""
pr AS ({PAIRS_SQL}), pe AS (SELECT *, {_factor} AS factor, {_names} AS names FROM pr),
fi AS (SELECT *, round(greatest(0.05, ({_base4}) * factor) + 1e-9, 3) AS final FROM pe),
ix AS (SELECT *, CASE WHEN human = 'Disagree' THEN {_at['Poor Match']} WHEN human = 'Agree' THEN least({_index}, {_at['Good Match']}) WHEN verdict = 'No' THEN greatest({_index}, {_at['Weak Match']})
  WHEN verdict IN ('Partial', 'Direct', 'Yes') AND light THEN greatest({_index}, {_at['Potential Match']}) WHEN verdict = 'Partial' THEN greatest({_index}, {_at['Strong Match']})
  WHEN verdict IN ('Direct', 'Yes') THEN {_index} ELSE greatest({_index}, {_at['Potential Match']}) END AS ti FROM fi),
de AS (SELECT *, {sql_list(_tier_names)}[ti + 1] AS decided FROM ix),
ty AS (SELECT *, CASE WHEN decided IN ('Weak Match', 'Poor Match') THEN 'Not a target' WHEN chain >= 0.95 AND decided = 'Excellent Match' THEN 'Anchor candidate'
  WHEN role IN ({sql_list(dims.SUPPLIER_ROLES)[1:-1]}) OR model IN ('Supplier localization', 'Distribution partnership') THEN 'Supplier localization'
  WHEN model = 'Joint venture' OR (role IN ({sql_list(dims.BUILDER_ROLES)[1:-1]}) AND chain >= 0.5) OR chain >= 0.7 THEN 'JV partner' WHEN chain >= 0.3 THEN 'Supplier localization' ELSE 'Ecosystem player' END AS match_type FROM de)
"""
_g3 = "0.3 * profile + 0.3 * product + 0.25 * sector + 0.15 * evidence"
_dec3 = """CASE WHEN NOT qualified OR verdict IN ('No', 'Not Run') THEN 'Low Fit' WHEN verdict IN ('Direct', 'Yes') THEN CASE WHEN f >= 0.6 THEN 'High Fit' ELSE 'Good Fit' END
  WHEN verdict = 'Partial' THEN 'Partner Fit' WHEN NOT linked THEN CASE WHEN f >= 0.55 THEN 'Review Needed' ELSE 'Low Fit' END
  WHEN bridge_only THEN CASE WHEN f >= 0.7 THEN 'Good Fit' WHEN f >= 0.5 THEN 'Review Needed' ELSE 'Low Fit' END
  WHEN f >= 0.85 THEN 'High Fit' WHEN f >= 0.7 THEN 'Good Fit' WHEN f >= 0.5 THEN 'Review Needed' ELSE 'Low Fit' END"""
_slabel = "CASE WHEN sector >= 0.9 THEN 'Exact' WHEN sector >= 0.8 THEN 'Strong' WHEN sector >= 0.5 THEN 'Moderate' WHEN sector > 0 THEN 'Weak' ELSE 'No' END"
_soft = f"({_slabel} IN ('No', 'Unknown') AND cid % 5 >= 2 AND greatest(profile, product) >= 0.6)"
_real = f"({_slabel} IN ('Exact', 'Strong', 'Moderate'))"
_qual = f"(NOT {_soft} AND sector >= 0.35 AND cid % 5 >= 2)"
_band = "CASE WHEN match_value >= 90 THEN 'Exceptional (90+)' WHEN match_value >= 75 THEN 'Strong (75-89)' WHEN match_value >= 60 THEN 'Moderate (60-74)' WHEN match_value >= 40 THEN 'Weak (40-59)' WHEN match_value >= 20 THEN 'Poor (20-39)' ELSE 'No fit (<20)' END"
_T = """pr AS ({p}), tr AS (SELECT cid, oid, sector >= 0.9 AS a, (cid + oid) % 11 = 0 AS b, (cid * 3 + oid) % 4 AS kw, CASE WHEN (cid + oid) % 9 = 0 THEN 1 ELSE 0 END AS inp, product, profile FROM pr),
tg AS (SELECT *, kw >= 2 AS c, inp >= 1 AS d, product >= 0.8 AS e, profile >= 0.82 AS f FROM tr)""".format(p=PAIRS_SQL)
_TRIAGE = f"""WITH {_T} SELECT cid, oid, a OR b OR c OR d OR e OR f AS triage_pass,
  CASE WHEN a THEN 'sector_overlap' WHEN b THEN 'value_chain_adjacent' WHEN c THEN 'capability_keywords' WHEN d THEN 'input_overlap' WHEN e THEN 'signal_product_similarity' WHEN f THEN 'signal_profile_similarity' ELSE 'filtered' END AS pass_reason,
  CASE WHEN a OR b OR c OR d OR e OR f THEN concat_ws(' + ', CASE WHEN a THEN 'sector_overlap' END, CASE WHEN b THEN 'value_chain_adjacent' END, CASE WHEN c THEN 'capability_keywords:' || kw END, CASE WHEN d THEN 'input_overlap:' || inp END,
    CASE WHEN e THEN 'signal_product_sim:' || printf('%.3f', product) END, CASE WHEN f THEN 'signal_profile_sim:' || printf('%.3f', profile) END)
  ELSE 'no_pass overlap=' || a::INT || ', adj=' || b::INT || ', capability_kw=' || kw || ', inputs=' || inp || ', signal_product_sim=' || printf('%.3f', product) || ', signal_profile_sim=' || printf('%.3f', profile) END AS triage_reason,
  a AS hit_sector_overlap, b AS hit_value_chain_adjacent, c AS hit_capability_keywords, d AS hit_input_overlap, e AS hit_signal_product_similarity, f AS hit_signal_profile_similarity FROM tg"""
_comp = "[sector, profile, product, chain, evidence]"
_votes = "CASE WHEN votes NOT LIKE '%/%' THEN 0.5 WHEN split_part(votes, '/', 2)::INT <= 1 THEN 0.55 ELSE split_part(votes, '/', 1)::INT / split_part(votes, '/', 2)::INT END"
_needs = f"CASE WHEN oid % 7 = 0 THEN []::VARCHAR[] ELSE [{sql_pick(dims.ROLES, 'oid')}, {sql_pick(dims.ROLES, 'oid * 5 + 2')}, {sql_pick(dims.ROLES, 'oid + 7')}, {sql_pick(dims.ROLES, 'oid + 9')}] END"
_vc = f"list_max(flatten([[CASE WHEN needs[i] = r THEN 1.0 ELSE coalesce({sql_map(_compat)}[needs[i] || '|' || r], 0.2) END * (1.0 - 0.1 * (i - 1)) for r in list_filter([r1, r2], lambda z: z <> '')] for i in range(1, least(len(needs), 3) + 1)]))"
_rankq = "row_number() OVER (PARTITION BY {g}, qualified ORDER BY profile DESC, {t})"
_tax = f"""WITH n AS (SELECT cid, oid, {sql_pick(NODES, 'cid')} AS a, {sql_pick(NODES, 'oid')} AS b FROM ({PAIRS_SQL})), f AS (SELECT *, coalesce({sql_map(_families)}[a], '') AS fa, coalesce({sql_map(_families)}[b], '') AS fb FROM n)
  SELECT cid, oid, round((CASE WHEN a = '' OR b = '' THEN 0.3 WHEN a = b THEN 1.0 WHEN fa <> '' AND fa = fb THEN CASE WHEN a = fa OR b = fb THEN 0.8 ELSE 0.65 END
    WHEN fa <> '' AND fb <> '' THEN coalesce({sql_map(_affinity)}[least(fa, fb) || '|' || greatest(fa, fb)], 0.1) ELSE 0.15 END)::DOUBLE, 3) AS similarity FROM f"""
_reply = "CASE WHEN verdict IS NULL THEN 0.0 WHEN lower(verdict) LIKE 'yes%' THEN 0.95 ELSE 0.3 END"
_g0bag = lambda x: " OR ".join(f"(list_contains({sql_list(g)}, a) AND list_contains({sql_list(g)}, b))" for g in dims.SECTOR_GROUPS_G0)

SQL = {
    "sector_score": f"""WITH p AS ({SIDES_SQL}), b AS (SELECT *, {_bag('cs', dims.SECTOR_TOKEN_MAP, dims.SECTOR_ONTOLOGY)} AS c, {_bag('os', dims.SECTOR_TOKEN_MAP, dims.SECTOR_ONTOLOGY)} AS o FROM p),
      g AS (SELECT *, greatest({_jac}, CASE WHEN {_group_hit(dims.SECTOR_GROUPS)} THEN 0.75 ELSE 0.0 END)::DOUBLE AS base, len(c) = 0 OR len(o) = 0 AS unknown, {pp('cs')} = {pp('os')} AS exact FROM b),
      r AS (SELECT *, CASE {' '.join(f'WHEN {f} THEN {i}' for i, f in enumerate(_fire))} END AS rule FROM g),
      s AS (SELECT *, (CASE WHEN unknown THEN 0.0 WHEN exact THEN 1.0 ELSE coalesce([{', '.join(str(x[3]) for x in dims.BRIDGE_RULES)}][rule + 1]::DOUBLE, base) END)::DOUBLE AS score FROM r)
      SELECT cid, oid, round(score, 6) AS sector_score, CASE WHEN unknown THEN 'Unknown' WHEN exact THEN 'Exact' ELSE {_label.format(s='score')} END AS sector_label,
        CASE WHEN NOT unknown AND NOT exact THEN {sql_list([x[4] for x in dims.BRIDGE_RULES])}[rule + 1] END AS bridge_name,
        CASE WHEN unknown THEN 'Sector text missing or uninformative.' WHEN exact THEN 'Exact sector match: ''' || cs || '''.'
          WHEN rule IS NOT NULL THEN 'Cross-sector bridge (' || {sql_list([x[4] for x in dims.BRIDGE_RULES])}[rule + 1] || ') via capabilities: ' || array_to_string(list_sort(list_distinct(list_intersect(cap, [{', '.join(sql_list(x[2]) for x in dims.BRIDGE_RULES)}][rule + 1])))[1:6], ', ') || '.'
          WHEN len(list_intersect(c, o)) > 0 THEN 'Shared sector terms: ' || array_to_string(list_sort(list_distinct(list_intersect(c, o)))[1:5], ', ') || '.'
          WHEN base >= 0.75 THEN 'Sector families align (same broader industry group).' ELSE 'No direct sector overlap (''' || cs || ''' vs ''' || os || ''').' END AS sector_reason FROM s""",
    "g1_sector_score": f"""WITH p AS ({SIDES_SQL}), b AS (SELECT *, {_bag('cs', dims.SECTOR_TOKEN_MAP_G1, dims.SECTOR_ONTOLOGY_G1, _generic1)} AS c, {_bag('os', dims.SECTOR_TOKEN_MAP_G1, dims.SECTOR_ONTOLOGY_G1, _generic1)} AS o FROM p),
      g AS (SELECT *, greatest({_jac}, CASE WHEN {_group_hit(dims.SECTOR_GROUPS_G1)} THEN 0.75 ELSE 0.0 END)::DOUBLE AS base, len(c) = 0 OR len(o) = 0 AS unknown, {pp('cs')} = {pp('os')} AS exact FROM b),
      r AS (SELECT *, CASE {' '.join(f'WHEN {f} THEN {i}' for i, f in enumerate(_cross1))} END AS rule FROM g),
      q AS (SELECT *, [{', '.join(str(x[3]) for x in dims.BRIDGE_RULES_G1)}][rule + 1]::DOUBLE AS bs FROM r)
      SELECT cid, oid, round((CASE WHEN unknown THEN 0.0 WHEN exact THEN 1.0 WHEN base < 0.5 AND coalesce(bs, 0) > base THEN bs ELSE base END)::DOUBLE, 6) AS sector_score,
        CASE WHEN unknown THEN 'Unknown' WHEN exact THEN 'Exact' WHEN base < 0.5 AND coalesce(bs, 0) > base THEN {sql_list([x[4] for x in dims.BRIDGE_RULES_G1])}[rule + 1] ELSE {_label.format(s='base')} END AS sector_label FROM q""",
    "g0_sector_match": f"""WITH n AS (SELECT cid, oid, {pp0(sql_pick(G0_SECTORS, 'cid'))} AS a, {pp0(sql_pick(G0_SECTORS, 'oid * 3'))} AS b FROM ({PAIRS_SQL}))
      SELECT cid, oid, CASE WHEN a = '' OR b = '' THEN 'Unknown' WHEN a = b OR {_g0bag('')} THEN 'Yes' ELSE 'No' END AS sector_match FROM n""",
    "taxonomy_similarity": _tax,
    "value_chain_score": f"""WITH n AS (SELECT cid, oid, {_needs} AS needs, {sql_pick([*dims.ROLES, ''], 'cid')} AS r1, {sql_pick([*dims.ROLES, ''], 'cid * 3 + 1')} AS r2 FROM ({PAIRS_SQL}))
      SELECT cid, oid, CASE WHEN len(needs) = 0 OR r1 = '' THEN 0.3::DOUBLE ELSE round(coalesce({_vc}, 0.0)::DOUBLE, 3) END AS score FROM n""",
    "readiness": f"WITH m AS (SELECT s_suppkey, {_dims_map} AS d FROM supplier) SELECT s_suppkey, {_mean(dims.CORE_DIMS)} AS core, {_mean(dims.STRATEGIC_DIMS)} AS strategic, {_mean(dims.LOCALIZATION_DIMS)} AS localization FROM m",
    "penalties": f"SELECT cid, oid, round({_factor}, 6) AS factor, array_to_string({_names}, ',') AS names FROM ({PAIRS_SQL})",
    "fusion_g3": f"SELECT cid, oid, round(f + 1e-9, 3) AS final_score, {_dec3} AS ai_decision FROM (SELECT *, ({_g3})::DOUBLE AS f FROM ({PAIRS_SQL}))",
    "qualification": f"""SELECT cid, oid, {_qual} AS qualified, {_soft} AS soft, {_real} OR bridge_only AS real_link, bridge_only AND NOT {_real} AS bridge_only,
      CASE WHEN {_qual} AND verdict IS NULL AND decision IN ('Good Match', 'Excellent Match') THEN 'Review Needed' ELSE decision END AS capped FROM ({PAIRS_SQL})""",
    "fusion_g4": f"WITH {DECIDED} SELECT cid, oid, final AS final_score, {_tier('final')} AS tier FROM fi",
    "decide_g4": f"WITH {DECIDED} SELECT cid, oid, decided AS decision FROM de",
    "match_type": f"WITH {DECIDED} SELECT cid, oid, match_type FROM ty",
    "opportunity_status": f"""WITH {DECIDED}, g AS (SELECT oid, bool_or(decided IN ('Excellent Match', 'Strong Match', 'Good Match')) AS v, bool_or(decided IN ('Excellent Match', 'Strong Match', 'Good Match') AND match_type = 'Anchor candidate') AS a FROM ty GROUP BY oid)
      SELECT oid, CASE WHEN NOT v THEN 'No viable target in current universe' WHEN a THEN 'Anchor candidate identified' ELSE 'No anchor in universe - JV/supplier options only' END AS status FROM g""",
    "confidence_g4": f"""WITH {DECIDED}, x AS (SELECT cid, oid, 0.3 * (least(1.0, ((cid * 37) % 900) / 600) * 0.5 + 0.5) + 0.25 * evidence + 0.25 * (1 - least(1.0, list_stddev_pop({_comp}) * 2)) + 0.2 * ({_votes})
        - CASE WHEN sector < 0.5 THEN 0.15 ELSE 0 END - CASE WHEN len(names) > 0 THEN 0.1 ELSE 0 END AS s FROM pe), y AS (SELECT cid, oid, round(100 * least(1.0, greatest(0.0, s)))::INT AS confidence FROM x)
      SELECT cid, oid, confidence, CASE WHEN confidence >= 70 THEN 'High' WHEN confidence >= 45 THEN 'Medium' ELSE 'Low' END AS label FROM y""",
    "report_fields": f"""SELECT cid, oid, CASE WHEN verdict IN ('Direct', 'Yes') THEN 'Can build it' ELSE 'Supplier / partner' END AS role,
      CASE WHEN human = 'Agree' THEN 'Confirmed by analyst' WHEN votes NOT LIKE '%/%' THEN 'Medium' WHEN split_part(votes, '/', 1) = split_part(votes, '/', 2) THEN 'High (unanimous)' ELSE 'Medium (' || votes || ' votes)' END AS confidence FROM ({PAIRS_SQL})""",
    "g1_scores": f"""WITH s AS (SELECT *, CASE WHEN sector < 0.1 AND cid % 3 <> 0 AND greatest(profile, product) >= 0.08 THEN greatest(sector, 0.35) ELSE sector END::DOUBLE AS s FROM ({PAIRS_SQL})),
      a AS (SELECT *, 0.5 * s + 0.25 * profile + 0.25 * product AS ai, 0.45 * s + 0.3 * profile + 0.25 * product AS proof, 0.5 * profile + 0.5 * product AS sem FROM s WHERE s >= 0.2)
      SELECT cid, oid, round(ai + 1e-9, 3) AS ai_score, round(0.35 * profile + 0.35 * product + 0.2 * s + 0.1 * ai + 1e-9, 3) AS final_score,
        CASE WHEN verdict = 'No' THEN 'Low Fit' WHEN verdict = 'Yes' THEN CASE WHEN proof >= 0.42 OR ai >= 0.75 THEN 'High Fit' ELSE 'Good Fit' END WHEN proof >= 0.52 AND sem >= 0.08 THEN 'High Fit' WHEN proof >= 0.34 AND sem >= 0.05 THEN 'Good Fit' WHEN proof >= 0.22 THEN 'Review Needed' ELSE 'Low Fit' END AS ai_decision,
        CASE WHEN product >= 0.2 THEN 'Very Strong' WHEN product >= 0.12 THEN 'Strong' WHEN product >= 0.08 THEN 'Moderate' WHEN product >= 0.04 THEN 'Weak' ELSE 'Very Weak' END AS band FROM a""",
    "g0_scores": f"""WITH f AS (SELECT cid, oid, cid // 10 AS batch, round(0.4 * profile + 0.4 * product + 0.2 * ({_reply}) + 1e-9, 3) AS final_score FROM ({PAIRS_SQL}))
      SELECT cid, oid, batch, final_score, row_number() OVER (PARTITION BY batch, oid ORDER BY final_score DESC, cid)::INT AS rank FROM f""",
    "g2_scores": f"""WITH f AS (SELECT *, round(0.3 * (lower(coalesce(verdict, '')) = 'yes')::INT + 0.3 * profile + 0.4 * product + 1e-9, 3) AS final_score FROM ({PAIRS_SQL})),
      r AS (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY final_score DESC, product DESC, cid)::INT AS rank FROM f)
      SELECT row_number() OVER (ORDER BY cid, rank, oid) AS id, cid, oid, final_score, rank, greatest(profile, product) AS sector_similarity FROM r""",
    "match_value_rank": f"SELECT cid, oid, row_number() OVER (PARTITION BY oid ORDER BY match_value DESC, profile DESC, cid)::INT AS rank, {_band} AS band, CASE WHEN sector >= 0.7 THEN 'sector_overlap' WHEN greatest(profile, product) >= 0.85 THEN 'soft_match' ELSE 'weak_overlap' END AS path FROM ({PAIRS_SQL})",
    "match_value_bands": f"SELECT {_band} AS band, count(*) AS n FROM ({PAIRS_SQL}) GROUP BY 1",
    "triage": _TRIAGE,
    "triage_counts": f"WITH t AS ({_TRIAGE}) SELECT " + ", ".join(f"count_if(hit_{k})::BIGINT AS hit_{k}" for k in ("sector_overlap", "value_chain_adjacent", "capability_keywords", "input_overlap", "signal_product_similarity", "signal_profile_similarity")) + ", count_if(triage_pass)::BIGINT AS passed, count_if(NOT triage_pass)::BIGINT AS filtered FROM t",
    "unit_clamp": "SELECT event_id, round(least(greatest(value / 50.0 - 0.3, 0.0), 1.0)::DOUBLE, 3) AS result FROM events",
    "rank_opportunity": f"SELECT cid, oid, CASE WHEN qualified THEN {_rankq.format(g='oid', t='cid')}::INT END AS rank FROM ({PAIRS_SQL})",
    "rank_company": f"SELECT cid, oid, CASE WHEN qualified THEN {_rankq.format(g='cid', t='oid')}::INT END AS rank FROM ({PAIRS_SQL})",
    "rank_both": f"SELECT cid, oid, row_number() OVER (PARTITION BY cid ORDER BY profile DESC, oid)::INT AS company_rank, row_number() OVER (PARTITION BY oid ORDER BY profile DESC, cid)::INT AS opportunity_rank FROM ({PAIRS_SQL})",
    "topn_gate": f"""WITH r AS (SELECT cid, oid, CASE WHEN qualified THEN {_rankq.format(g='oid', t='cid')} ELSE 99 END AS ro, CASE WHEN qualified THEN {_rankq.format(g='cid', t='oid')} ELSE 99 END AS rc FROM ({PAIRS_SQL}))
      SELECT cid, oid, ro <= 3 AS gate, ro <= 5 AS opportunity_view, rc <= 3 AS company_view FROM r WHERE ro <= 5 OR rc <= 3""",
    "pursue_rank": f"WITH {DECIDED} SELECT cid, oid, row_number() OVER w::INT AS pursue_rank, first_value(decided) OVER w AS lead_tier, first_value(final) OVER w AS lead_score FROM de WINDOW w AS (PARTITION BY oid ORDER BY ti, final DESC, cid)",
    "export_top": f"""WITH {DECIDED}, r AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY final DESC, oid)::INT AS rank FROM de)
      SELECT cid, oid, rank, final AS final_score, decided, CASE WHEN decided IN ('Weak Match', 'Poor Match') THEN 'Not recommended' ELSE model END AS model, CASE WHEN decided IN ('Weak Match', 'Poor Match') THEN '' ELSE 'call ' || cid END AS engagement FROM r WHERE rank <= 5""",
}
