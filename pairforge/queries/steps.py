"""Texts from templates, later steps of the generations, verification, diagnostics and whole plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions.text import static_tokens, without_common
from pairforge.operators import feedback as B
from pairforge.operators import ranking as R
from pairforge.operators import scoring as O
from pairforge.operators import similarity as Z
from pairforge.operators import templates as T
from pairforge.operators import verification as V
from pairforge.operators.providers import resolve_backends
from pairforge.plans import engine
from pairforge.queries import scoring as Q
from pairforge.queries.base import PAIRS_SQL, VOCAB_CTE, opportunities, pairs, pick, pp, sql_list, sql_map, sql_pick, t, toks
from pairforge.queries.feedback import _C, consortium
from pairforge.queries.matching import _vocab

S = SparkSession


def _terms(name: str, k: int):
    """Up to six terms of a pair; none for one pair of three."""
    c = F.col("cid") * k + F.col("oid")
    return F.when(c % 3 == 0, F.array().cast("array<string>")).otherwise(F.slice(F.array(*[F.concat(F.lit(f"{name}{i}-"), F.col("oid").cast("string")) for i in range(6)]), F.lit(1), (c % 6 + 1).cast("int")))


def template_texts(s: S, d: str) -> DataFrame:
    """All template texts of a first-generation pair."""
    p = pairs(s, d).withColumns({"a": _terms("p", 2), "b": _terms("q", 5), "company": F.concat(F.lit("Firm "), F.col("cid").cast("string")), "deal": F.concat(F.lit("Deal "), F.col("oid").cast("string"))})
    decided = pick(["High Fit", "Good Fit", "Review Needed", "Low Fit"], F.col("cid") + F.col("oid"))
    p = p.withColumns({"decided": decided, "meaning": T.semantic_meaning(F.col("a"), F.col("b"), F.col("profile") / 5, F.col("product") / 5), "pr": T.overlap_reason(F.col("a"), F.lit("No profile overlap.")), "qr": T.overlap_reason(F.col("b"), F.lit("No product overlap."))})
    reply = F.when(F.col("verdict") == "Yes", "looks right")
    return p.select(
        "cid", "oid", T.explanation(*[F.col(c) for c in ("company", "deal", "decided")], F.lit("Same sector."), *[F.col(c) for c in ("meaning", "pr", "qr")], F.lit("rule-based"), reply).alias("explanation"),
        T.insight(*[F.col(c) for c in ("company", "deal", "decided")], F.lit("Same sector.")).alias("insight"), T.suggested_plan(*[F.col(c) for c in ("company", "decided", "a", "b")]).alias("plan"),
        T.match_reason(F.col("decided"), F.lit("Same sector."), F.col("pr"), F.col("qr")).alias("reason"),
    )


def assigned_frames(s: S, d: str) -> DataFrame:
    return t(s, d, "customer").select("c_custkey", *[v.alias(k) for k, v in T.assigned_frames(F.col("c_custkey")).items()])


def g1_after_gate(s: S, d: str) -> DataFrame:
    """The proxy gives way to the reply's confidence, and the score is made anew."""
    p = pairs(s, d).withColumn("ai_score", O.g1_proxy(F.col("profile"), F.col("product"), F.col("sector")))
    return O.with_g1_gate(p, F.col("verdict").isin("Yes", "No"), F.col("evidence")).select("cid", "oid", F.round("ai_score", 6).alias("ai_score"), "final_score")


def g1_common_sector(s: S, d: str) -> DataFrame:
    """First-generation sector scores where the corpus makes two words common."""
    common = s.createDataFrame([("industrial",), ("hardware",)], "token string")
    return Q._scored(s, d, lambda p, a, b, c: O.with_g1_sector_score(p, a, b, c, common)).select("cid", "oid", F.round("sector_score", 6).alias("sector_score"), "sector_label")


def corpus_tokens(s: S, d: str) -> DataFrame:
    """Tokens of the items without those that are common in the corpus."""
    common = _vocab(s, d).filter("is_common").agg(F.sort_array(F.collect_set("token")).alias("common"))
    o = opportunities(s, d).join(F.broadcast(common))  # one row
    return o.select("oid", F.array_join(F.array_sort(without_common(static_tokens(F.col("text")), F.col("common"))), " ").alias("tokens"))


def combined_documents(s: S, d: str) -> DataFrame:
    """The cleaned text of all of an entity's fields, blank ones left out; whether two labels are literally
    the same, and the best similarity of a pair."""
    p = pairs(s, d).withColumns({"a": pick(["Mining", " mining!", "", "MedTech"], F.col("cid")), "b": pick(["MINING", "medtech", ""], F.col("oid"))})
    text = O.combined_text([F.concat(F.lit("Firm "), F.col("cid").cast("string")), F.col("a"), F.when(F.col("oid") % 2 == 0, F.col("role"))])
    return p.select("cid", "oid", text.alias("combined"), O.literal_sector(F.col("a"), F.col("b")).alias("literal"), O.combined_similarity(*[F.col(c) for c in ("sector", "profile", "product", "chain")]).alias("best"))


def clipped_cosine(s: S, d: str) -> DataFrame:
    """Cosines as similarities; a vector of zeros is similar to nothing."""
    e = t(s, d, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    zero = F.when(F.col("vec_id") % 7 == 0, F.transform("v", lambda x: x * 0.0)).otherwise(F.col("v"))
    c = Z.dense_cosine(e.filter("vec_id % 25 <> 0").select(F.col("vec_id").alias("cid"), zero.alias("a")), e.filter("vec_id % 25 = 0").select(F.col("vec_id").alias("oid"), F.col("v").alias("b")))
    return c.select("cid", "oid", F.round(Z.clipped_cosine(F.col("cosine")), 9).alias("similarity"))


def first_rows(s: S, d: str) -> DataFrame:
    """The first row of each company, by its best pair."""
    return R.first_rows(pairs(s, d), "cid", [F.col("profile").desc(), F.col("oid")]).select("cid", "oid", "decision")


def head_limit(s: S, d: str) -> DataFrame:
    """A debugging limit that gives the same rows each time: the first in the order of their key."""
    return R.head(t(s, d, "part"), 25, [F.col("p_retailprice").desc(), F.col("p_partkey")]).select("p_partkey", "p_retailprice")


def matches_first(s: S, d: str) -> DataFrame:
    """Opportunities with matches come first, then by name: their place on the page."""
    n = pairs(s, d).groupBy("oid").agg(F.count_if((F.col("verdict") == "Direct") & (F.col("oid") % 3 != 0) & F.col("qualified")).alias("n")).withColumn("name", F.concat(F.lit("deal "), F.col("oid").cast("string")))
    return Z.position(n, R.order_first_with_matches("n", "name"), "place").select("oid", "n", "place")


def export_order(s: S, d: str) -> DataFrame:
    """The block order of the export: lead tier, lead score, opportunity, rank."""
    p = Q._decided(s, d).withColumn("ti", O.tier_index(F.col("decided")))
    order = ["ti", F.col("final").desc(), "cid"]
    p = R.first_of_group(R.ranked(p, "oid", order, "pursue_rank"), "oid", order, {"lead_tier": "ti", "lead_score": "final"})
    return Z.position(p, [F.col("lead_tier"), F.col("lead_score").desc(), F.col("oid"), F.col("pursue_rank")], "place").select("cid", "oid", "place")


def run_triage(s: S, d: str) -> DataFrame:
    """The triage engine from signals to ranked, numbered rows."""
    c, o = F.col("cid"), F.col("oid")
    p = pairs(s, d).select("cid", "oid", "profile", "product", (F.col("sector") >= 0.9).alias("overlap"), ((c + o) % 11 == 0).alias("adjacent"), ((c * 3 + o) % 4).cast("int").alias("keywords"), F.when((c + o) % 9 == 0, 1).otherwise(0).alias("inputs"), F.col("chain").alias("struct_product"))
    replies = pairs(s, d).filter("(cid + oid) % 3 <> 0").select("cid", "oid", pick(["Yes", "No", "Maybe", "yes "], c + o).alias("ai_decision"))
    return engine.run_triage(p, replies).select("id", "cid", "oid", "ai_decision", "final_score", "rank", "triage_pass")


def _taxonomy_sides(s: S, d: str) -> tuple[DataFrame, ...]:
    p = pairs(s, d)
    k, o = F.col("s_suppkey"), F.col("n_nationkey").cast("long")
    dims_ = F.map_from_entries(F.array(*[F.struct(F.lit(n), ((k * 7 + i) % 100) / 100.0) for i, n in enumerate(dims.CORE_DIMS)]))
    firms = t(s, d, "supplier").select(k.alias("cid"), pick(Q.NODES, k).alias("normalized_sector"), pick(dims.ROLES, k).alias("value_chain_role"), pick([*dims.ROLES, ""], k * 3 + 1).alias("secondary_role"), ((k % 10) / 10.0).alias("classification_confidence"), dims_.alias("readiness"), ((k * 37) % 900).alias("length"))
    deals = t(s, d, "nation").select(o.alias("oid"), pick(Q.NODES, o * 3).alias("normalized_sector"), F.array(pick(dims.ROLES, o), pick(dims.ROLES, o * 5 + 2)).alias("required_roles"))
    verdicts = p.filter("(cid + oid) % 4 <> 0").select("cid", "oid", F.col("verdict").alias("gate"), "votes", "human", "model")
    return p.select("cid", "oid", F.col("profile").alias("sem_profile"), F.col("product").alias("sem_product")), firms, deals, verdicts


def run_taxonomy(s: S, d: str) -> DataFrame:
    """The taxonomy engine from similarities and enrichment to the exported rows."""
    out = engine.run_taxonomy(*_taxonomy_sides(s, d))
    return out.select("cid", "oid", F.round("sector", 3).alias("sector"), "value_chain", "final_score", "decision", "match_type", "status", "company_rank", "opportunity_rank", "pursue_rank", "lead_decision", "lead_score")


def verification(s: S, d: str) -> DataFrame:
    """An export of the taxonomy engine checked again; some rows were changed by hand."""
    out = engine.run_taxonomy(*_taxonomy_sides(s, d))
    firms = t(s, d, "supplier").select(F.col("s_suppkey").alias("cid"), pick(Q.NODES, F.col("s_suppkey")).alias("company_node"))
    deals = t(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("oid"), pick(Q.NODES, F.col("n_nationkey") * 3).alias("opportunity_node"))
    odd = lambda k, good, bad: F.when((F.col("cid") + 3 * F.col("oid")) % 29 == k, bad).otherwise(good)
    export = out.join(firms, "cid").join(deals, "oid").select(
        "cid", "oid", "company_node", "opportunity_node", F.col("profile").alias("sem_profile"), F.col("product").alias("sem_product"), "required_roles", F.col("value_chain_role").alias("role"), F.col("secondary_role").alias("second_role"), "model",
        "gate", F.when(F.col("light"), "1/1").otherwise("3/3").alias("votes"), "human", odd(1, F.col("sector"), F.lit(0.987)).alias("sector_similarity"), odd(2, F.col("profile"), F.col("profile") + 0.1).alias("profile_similarity"),
        F.col("product").alias("product_similarity"), odd(3, F.col("value_chain"), F.lit(-1.0)).alias("value_chain_score"), odd(4, F.col("final_score"), F.lit(0.999)).alias("final_score"),
        odd(5, F.col("decision"), F.lit("Poor Match")).alias("decision"), odd(6, F.col("match_type"), F.lit("none")).alias("match_type"), F.col("status").alias("opportunity_status"), F.col("pursue_rank").alias("rank"),
    )
    return V.verification(export)


def diagnostics_report(s: S, d: str) -> DataFrame:
    """All figures of a run but its time."""
    p = R.qualified_rank(pairs(s, d), "oid", "profile", ["cid"], "rank_for_opportunity")
    p = p.withColumns({"raw_profile_cosine": F.col("profile"), "agreement": F.col("votes"), "changed": F.coalesce(F.col("human") == "Disagree", F.lit(False))})
    away = pairs(s, d).groupBy("oid").agg(F.bool_or(F.col("qualified") & (F.col("oid") % 4 != 0)).alias("q")).filter("NOT q")
    fixed = {"embedding_mode": F.lit("tfidf"), "duplicate_rows_merged": F.lit(3), "calibration_labels": F.lit("insufficient"), "calibration_human_labels": F.lit(5), "rubric_version": F.lit("abcdef01"), "gate_verdict_flips_vs_prev": F.lit(2), "calibration_auc_final_score": F.lit("insufficient")}
    return B.diagnostics(p, 17, away, consortium(s, d), "oid", fixed)


def run_timestamp(s: S, d: str) -> DataFrame:
    """The run's time: UTC, ISO text."""
    return t(s, d, "region").select("r_regionkey", B.run_timestamp().rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$").alias("well_formed"))


def sector_report(s: S, d: str) -> DataFrame:
    """The dry run's figures on sectors, with the first blank names."""
    k = F.col("c_custkey")
    firms = t(s, d, "customer").select("c_custkey", F.concat(F.lit(" "), "c_name").alias("company_name"), pick(["Mining", "", " MedTech ", "Mining", None], k).alias("sector"), F.when(k % 3 == 0, "x").otherwise(F.lit(" ")).alias("industry_field"), F.when(k % 4 == 0, "SA").alias("country_field"))
    cache = t(s, d, "nation").select(F.col("n_name").alias("key"))
    return B.sector_report(firms, cache, ["industry_field", "business_unit_field", "country_field"], "c_custkey")


SETTINGS = [
    (0, {}), (1, {"public_key": "k"}), (2, {"hosted": "true", "hosted_endpoint": "e", "hosted_key": "k", "hosted_chat": "c"}), (3, {"hosted": "1", "hosted_endpoint": "e", "hosted_key": "k", "hosted_chat": "c", "public_key": "p"}),
    (4, {"hosted": "yes", "hosted_endpoint": "e", "hosted_key": "k", "hosted_embed": "m", "public_key": "p", "chat_provider": "hosted"}), (5, {"hosted": "1", "hosted_endpoint": " ", "hosted_key": "k", "hosted_chat": "c"}),
    (6, {"hosted": "1", "hosted_endpoint": "e", "hosted_key": "k", "hosted_chat": "c", "public_key": "p", "chat_provider": "public"}), (7, {"public_key": "k", "offline": "1"}),
]


def backends(s: S, d: str) -> DataFrame:
    """Which provider answers chat and which embeds, for several settings."""
    rows = [(k, b.chat or "", b.embed or "") for k, b in ((k, resolve_backends(x)) for k, x in SETTINGS)]
    return s.createDataFrame(rows, "k int, chat string, embed string")


def page_payload(s: S, d: str) -> DataFrame:
    """The review page's payload for each opportunity: matches by score with their kind, the consortium."""
    p = pairs(s, d).withColumns({"opportunity": F.concat(F.lit("deal "), F.col("oid").cast("string")), "company": F.concat(F.lit("firm "), F.col("cid").cast("string")), "company_sector": F.lit("Mining"), "opportunity_sector": pick(["Mining", "MedTech"], F.col("oid"))})
    p = p.withColumns({"validated_fit": F.coalesce(F.col("verdict").isin("Direct", "Partial") & (F.col("oid") % 3 != 1) & (F.col("cid") < 9), F.lit(False)), "gate_explanation": F.concat(F.lit("e"), F.col("cid").cast("string")), "final_score": F.col("profile")})
    rows = consortium(s, d).withColumn("opportunity", F.concat(F.lit("deal "), F.col("oid").cast("string")))
    return B.page_payload(p, rows).select("opportunity", "n", "place", "payload")


QUERIES = {
    "template_texts": template_texts, "assigned_frames": assigned_frames, "g1_after_gate": g1_after_gate, "g1_common_sector": g1_common_sector, "corpus_tokens": corpus_tokens, "combined_documents": combined_documents,
    "clipped_cosine": clipped_cosine, "first_rows": first_rows, "head_limit": head_limit, "matches_first": matches_first, "export_order": export_order, "run_triage": run_triage, "run_taxonomy": run_taxonomy,
    "verification": verification, "diagnostics_report": diagnostics_report, "run_timestamp": run_timestamp, "sector_report": sector_report, "backends": backends, "page_payload": page_payload,
}

# --- SQL -----------------------------------------------------------------------------------------

_list = lambda name, k: f"CASE WHEN (cid * {k} + oid) % 3 = 0 THEN []::VARCHAR[] ELSE ([{', '.join(f'{chr(39)}{name}{i}-{chr(39)} || oid' for i in range(6))}])[1:((cid * {k} + oid) % 6 + 1)::INT] END"
_why = lambda x, none: f"CASE WHEN len({x}) > 0 THEN 'Shared keywords: ' || array_to_string({x}, ', ') || '.' ELSE '{none}' END"
_mean4 = "((profile / 5 + product / 5) / 2.0)"
_bandof = f"CASE WHEN {_mean4} >= 0.2 THEN 'Very Strong' WHEN {_mean4} >= 0.12 THEN 'Strong' WHEN {_mean4} >= 0.08 THEN 'Moderate' WHEN {_mean4} >= 0.04 THEN 'Weak' ELSE 'Very Weak' END"
_common = lambda kind, x: f"CASE WHEN len({x}) > 0 THEN ' {kind} concepts in common: ' || array_to_string({x}, ', ') || '.' ELSE ' {kind} concepts overlap is limited.' END"
_generic1 = [*dims.GENERIC_TERMS, *dims.GENERIC_TERMS_G1]


def _common_bag(x: str) -> str:
    canon = f"list_distinct([coalesce({sql_map(dims.SECTOR_TOKEN_MAP_G1)}[w], w) for w in list_filter({toks(x, _generic1)}, lambda z: z NOT IN ('industrial', 'hardware'))])"
    return f"list_distinct(list_concat({canon}, flatten([coalesce({Q._list_map(dims.SECTOR_ONTOLOGY_G1)}[w], []) for w in {canon}])))"


_TAX = f"""pr AS (SELECT * FROM ({PAIRS_SQL})),
sd AS (SELECT *, {sql_pick(Q.NODES, 'cid')} AS a, {sql_pick(Q.NODES, 'oid * 3')} AS b, {sql_pick(dims.ROLES, 'cid')} AS r1, {sql_pick([*dims.ROLES, ''], 'cid * 3 + 1')} AS r2, [{sql_pick(dims.ROLES, 'oid')}, {sql_pick(dims.ROLES, 'oid * 5 + 2')}] AS needs,
  CASE WHEN (cid + oid) % 4 <> 0 THEN verdict END AS gate, CASE WHEN (cid + oid) % 4 <> 0 THEN human END AS hum, CASE WHEN (cid + oid) % 4 <> 0 THEN model END AS mod_ FROM pr),
ff AS (SELECT *, coalesce({sql_map(Q._families)}[a], '') AS fa, coalesce({sql_map(Q._families)}[b], '') AS fb FROM sd),
sc AS (SELECT *, (CASE WHEN a = '' OR b = '' THEN 0.3 WHEN a = b THEN 1.0 WHEN fa <> '' AND fa = fb THEN CASE WHEN a = fa OR b = fb THEN 0.8 ELSE 0.65 END
    WHEN fa <> '' AND fb <> '' THEN coalesce({sql_map(Q._affinity)}[least(fa, fb) || '|' || greatest(fa, fb)], 0.1) ELSE 0.15 END)::DOUBLE AS sec, round(coalesce({Q._vc}, 0.0)::DOUBLE, 3) AS vc FROM ff),
pn AS (SELECT *, (CASE WHEN product >= 0.7 AND profile < 0.45 AND sec < 0.4 THEN 0.65 ELSE 1.0 END * CASE WHEN sec < 0.25 THEN 0.75 ELSE 1.0 END * CASE WHEN vc < 0.3 THEN 0.7 ELSE 1.0 END
    * CASE WHEN r1 IN ('Raw Material Supplier', 'Distributor') AND needs[1] IN ('Developer', 'Research Company', 'OEM') THEN 0.7 ELSE 1.0 END * CASE WHEN r1 IN ('Investor', 'Service Provider') AND needs[1] IN ('Contract Manufacturer', 'OEM') THEN 0.7 ELSE 1.0 END)::DOUBLE AS factor FROM sc),
fi AS (SELECT *, round(greatest(0.05, ({0.20 / 0.55} * sec + {0.20 / 0.55} * profile + {0.15 / 0.55} * product) * factor) + 1e-9, 3) AS final FROM pn),
rk AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY final DESC, oid)::INT AS company_rank, row_number() OVER (PARTITION BY oid ORDER BY final DESC, cid)::INT AS opportunity_rank FROM fi),
lt AS (SELECT *, opportunity_rank > 3 AS lig FROM rk WHERE company_rank <= 5),
ix AS (SELECT *, CASE WHEN hum = 'Disagree' THEN {Q._at['Poor Match']} WHEN hum = 'Agree' THEN least({Q._index}, {Q._at['Good Match']}) WHEN gate = 'No' THEN greatest({Q._index}, {Q._at['Weak Match']})
  WHEN gate IN ('Partial', 'Direct', 'Yes') AND lig THEN greatest({Q._index}, {Q._at['Potential Match']}) WHEN gate = 'Partial' THEN greatest({Q._index}, {Q._at['Strong Match']})
  WHEN gate IN ('Direct', 'Yes') THEN {Q._index} ELSE greatest({Q._index}, {Q._at['Potential Match']}) END AS ti FROM lt),
de AS (SELECT *, {sql_list(Q._tier_names)}[ti + 1] AS decided FROM ix),
ty AS (SELECT *, CASE WHEN decided IN ('Weak Match', 'Poor Match') THEN 'Not a target' WHEN vc >= 0.95 AND decided = 'Excellent Match' THEN 'Anchor candidate'
  WHEN r1 IN ({sql_list(dims.SUPPLIER_ROLES)[1:-1]}) OR coalesce(mod_, '') IN ('Supplier localization', 'Distribution partnership') THEN 'Supplier localization'
  WHEN coalesce(mod_, '') = 'Joint venture' OR (r1 IN ({sql_list(dims.BUILDER_ROLES)[1:-1]}) AND vc >= 0.5) OR vc >= 0.7 THEN 'JV partner' WHEN vc >= 0.3 THEN 'Supplier localization' ELSE 'Ecosystem player' END AS match_type FROM de),
os AS (SELECT oid, CASE WHEN NOT bool_or(decided IN ('Excellent Match', 'Strong Match', 'Good Match')) THEN 'No viable target in current universe' WHEN bool_or(decided IN ('Excellent Match', 'Strong Match', 'Good Match') AND match_type = 'Anchor candidate') THEN 'Anchor candidate identified'
  ELSE 'No anchor in universe - JV/supplier options only' END AS status FROM ty GROUP BY oid),
ex AS (SELECT *, row_number() OVER w::INT AS pursue_rank, first_value(decided) OVER w AS lead_decision, first_value(final) OVER w AS lead_score FROM ty JOIN os USING (oid) WINDOW w AS (PARTITION BY oid ORDER BY ti, final DESC, cid))"""
_G2T = f"""tr AS (SELECT cid, oid, profile, product, sector >= 0.9 OR (cid + oid) % 11 = 0 OR (cid * 3 + oid) % 4 >= 2 OR (cid + oid) % 9 = 0 OR chain >= 0.8 OR profile >= 0.82 AS ok FROM ({PAIRS_SQL})),
de AS (SELECT *, CASE WHEN NOT ok THEN 'Filtered' WHEN (cid + oid) % 3 <> 0 AND (cid + oid) % 4 IN (0, 3) THEN 'Yes' ELSE 'No' END AS a FROM tr)"""

SQL = {
    "template_texts": f"""WITH p AS (SELECT *, {_list('p', 2)} AS a, {_list('q', 5)} AS b, 'Firm ' || cid AS c, 'Deal ' || oid AS o, {sql_pick(['High Fit', 'Good Fit', 'Review Needed', 'Low Fit'], 'cid + oid')} AS d FROM ({PAIRS_SQL})),
      m AS (SELECT *, 'Semantic alignment is ' || {_bandof} || ' (profile=' || printf('%.3f', profile / 5) || ', product=' || printf('%.3f', product / 5) || ').' || {_common('Profile', 'a')} || {_common('Product/service', 'b')} AS mean, {_why('a', 'No profile overlap.')} AS pr, {_why('b', 'No product overlap.')} AS qr FROM p)
      SELECT cid, oid, 'Decision: ' || d || ' for ' || c || ' on ''' || o || '''. Why: Same sector. ' || mean || ' Profile evidence: ' || pr || ' Product evidence: ' || qr || ' Validation: rule-based.' || CASE WHEN verdict = 'Yes' THEN ' LLM confirmation: looks right' ELSE '' END AS explanation,
        c || ' is classified as ''' || d || ''' for ''' || o || '''. Primary fit signal: Same sector.' AS insight,
        CASE d WHEN 'High Fit' THEN 'Move directly to proposal and stakeholder meetings' WHEN 'Good Fit' THEN 'Run a short qualification session, then submit proposal' WHEN 'Review Needed' THEN 'Perform targeted validation before client-facing commitment'
          ELSE 'Keep as low priority unless strategic considerations require follow-up' END || '. Position ' || c || ' using profile strengths in ' || CASE WHEN len(a) > 0 THEN array_to_string(a[1:4], ', ') ELSE 'core profile strengths' END
          || '. Anchor solution design around ' || CASE WHEN len(b) > 0 THEN array_to_string(b[1:4], ', ') ELSE 'delivery-relevant products/services' END || '. Confirm compliance, timeline, and execution model before final commitment.' AS plan,
        d || '. Sector: Same sector. Profile: ' || pr || ' Product: ' || qr AS reason FROM m""",
    "assigned_frames": f"SELECT c_custkey, {sql_pick(dims.ENGAGEMENT_VERBS, 'c_custkey')} AS engagement_verb, {sql_pick(dims.RISK_LENSES, 'c_custkey')} AS risk_lens FROM customer",
    "g1_after_gate": f"""WITH a AS (SELECT *, CASE WHEN coalesce(verdict IN ('Yes', 'No'), false) THEN evidence ELSE 0.5 * sector + 0.25 * profile + 0.25 * product END AS ai FROM ({PAIRS_SQL}))
      SELECT cid, oid, round(ai, 6) AS ai_score, round(0.35 * profile + 0.35 * product + 0.2 * sector + 0.1 * ai + 1e-9, 3) AS final_score FROM a""",
    "g1_common_sector": Q.SQL["g1_sector_score"].replace(Q._bag("cs", dims.SECTOR_TOKEN_MAP_G1, dims.SECTOR_ONTOLOGY_G1, _generic1), _common_bag("cs")).replace(Q._bag("os", dims.SECTOR_TOKEN_MAP_G1, dims.SECTOR_ONTOLOGY_G1, _generic1), _common_bag("os")),
    "corpus_tokens": f"WITH {VOCAB_CTE} SELECT o.oid, array_to_string(list_sort(list(token) FILTER (WHERE token IS NOT NULL)), ' ') AS tokens FROM op o LEFT JOIN (SELECT oid, token FROM otok JOIN vocab USING (token) WHERE NOT is_common) k USING (oid) GROUP BY o.oid",
    "combined_documents": f"""WITH p AS (SELECT *, {sql_pick(['Mining', ' mining!', '', 'MedTech'], 'cid')} AS a, {sql_pick(['MINING', 'medtech', ''], 'oid')} AS b FROM ({PAIRS_SQL}))
      SELECT cid, oid, {pp("concat_ws(' ', 'Firm ' || cid, a, CASE WHEN oid % 2 = 0 THEN role END)")} AS combined, ({pp('a')} <> '' AND {pp('a')} = {pp('b')})::INT AS literal, greatest(sector, profile, product, chain) AS best FROM p""",
    "clipped_cosine": """WITH a AS (SELECT vec_id AS cid, embedding::DOUBLE[] AS v, vec_id % 7 = 0 AS z FROM embeddings WHERE vec_id % 25 <> 0), b AS (SELECT vec_id AS oid, embedding::DOUBLE[] AS w FROM embeddings WHERE vec_id % 25 = 0)
      SELECT cid, oid, CASE WHEN z THEN 0.0 ELSE round(least(greatest(list_dot_product(v, w) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(w, w))), 0.0), 1.0), 9) END::DOUBLE AS similarity FROM a CROSS JOIN b""",
    "first_rows": f"SELECT cid, oid, decision FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY profile DESC, oid) AS r FROM ({PAIRS_SQL})) WHERE r = 1",
    "head_limit": "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25",
    "matches_first": f"WITH n AS (SELECT oid, count_if(coalesce(verdict = 'Direct', false) AND oid % 3 <> 0 AND qualified)::BIGINT AS n FROM ({PAIRS_SQL}) GROUP BY oid) SELECT oid, n, row_number() OVER (ORDER BY n = 0, 'deal ' || oid) - 1 AS place FROM n",
    "export_order": f"WITH {Q.DECIDED}, r AS (SELECT *, row_number() OVER w AS pr, first_value(ti) OVER w AS lt, first_value(final) OVER w AS ls FROM de WINDOW w AS (PARTITION BY oid ORDER BY ti, final DESC, cid)) SELECT cid, oid, row_number() OVER (ORDER BY lt, ls DESC, oid, pr) - 1 AS place FROM r",
    "run_triage": f"""WITH {_G2T}, f AS (SELECT *, round(0.3 * (a = 'Yes')::INT + 0.3 * profile + 0.4 * product + 1e-9, 3) AS final_score FROM de), r AS (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY final_score DESC, product DESC, cid)::INT AS rank FROM f)
      SELECT row_number() OVER (ORDER BY cid, rank, oid) AS id, cid, oid, a AS ai_decision, final_score, rank, ok AS triage_pass FROM r""",
    "run_taxonomy": f"WITH {_TAX} SELECT cid, oid, round(sec, 3) AS sector, vc AS value_chain, final AS final_score, decided AS decision, match_type, status, company_rank, opportunity_rank, pursue_rank, lead_decision, lead_score FROM ex",
    "verification": f"""WITH {_TAX}, o AS (SELECT *, (cid + 3 * oid) % 29 AS m FROM ex),
      v AS (SELECT *, CASE WHEN m = 4 THEN 0.999 ELSE final END AS f, CASE WHEN m = 5 THEN 'Poor Match' ELSE decided END AS dc, CASE WHEN m = 6 THEN 'none' ELSE match_type END AS mt, CASE WHEN m = 3 THEN -1.0 ELSE vc END AS v2, CASE WHEN m = 1 THEN 0.987 ELSE sec END AS s2, CASE WHEN m = 2 THEN profile + 0.1 ELSE profile END AS p2 FROM o),
      w AS (SELECT *, {0.20 / 0.55} * s2 + {0.20 / 0.55} * p2 + {0.15 / 0.55} * product AS base FROM v),
      t2 AS (SELECT *, list_position({sql_list(Q._tier_names)}, {Q._tier('f')}) - 1 AS fx, list_position({sql_list(Q._tier_names)}, dc) AS dx FROM w),
      d2 AS (SELECT *, {sql_list(Q._tier_names)}[1 + CASE WHEN hum = 'Disagree' THEN 5 WHEN hum = 'Agree' THEN least(fx, 2) WHEN gate = 'No' THEN greatest(fx, 4) WHEN gate IN ('Partial', 'Direct', 'Yes') AND lig THEN greatest(fx, 3) WHEN gate = 'Partial' THEN greatest(fx, 1) WHEN gate IN ('Direct', 'Yes') THEN fx ELSE greatest(fx, 3) END] AS due FROM t2),
      y AS (SELECT *, CASE WHEN dc IN ('Weak Match', 'Poor Match') THEN 'Not a target' WHEN v2 >= 0.95 AND dc = 'Excellent Match' THEN 'Anchor candidate' WHEN r1 IN ({sql_list(dims.SUPPLIER_ROLES)[1:-1]}) OR coalesce(mod_, '') IN ('Supplier localization', 'Distribution partnership') THEN 'Supplier localization'
        WHEN coalesce(mod_, '') = 'Joint venture' OR (r1 IN ({sql_list(dims.BUILDER_ROLES)[1:-1]}) AND v2 >= 0.5) OR v2 >= 0.7 THEN 'JV partner' WHEN v2 >= 0.3 THEN 'Supplier localization' ELSE 'Ecosystem player' END AS due_type, lag(dx) OVER w AS ld, lag(f) OVER w AS lf, row_number() OVER w AS rn FROM d2 WINDOW w AS (PARTITION BY oid ORDER BY pursue_rank, cid)),
      s3 AS (SELECT oid, CASE WHEN NOT bool_or(dc IN ('Excellent Match', 'Strong Match', 'Good Match')) THEN 'No viable target in current universe' WHEN bool_or(dc IN ('Excellent Match', 'Strong Match', 'Good Match') AND mt = 'Anchor candidate') THEN 'Anchor candidate identified' ELSE 'No anchor in universe - JV/supplier options only' END AS due_status FROM y GROUP BY oid),
      z AS (SELECT * FROM y JOIN s3 USING (oid)), n AS (SELECT count(*) AS n, count(gate) AS g FROM z)
      SELECT layer, checked, violations::BIGINT AS violations FROM (SELECT '1 sector_similarity' AS layer, (SELECT n FROM n) AS checked, count_if(abs(sec - s2) > 0.0021)::BIGINT AS violations FROM z UNION ALL SELECT '2a profile_similarity', (SELECT n FROM n), count_if(abs(profile - p2) > 0.0021) FROM z UNION ALL SELECT '2b product_similarity', (SELECT n FROM n), 0
      UNION ALL SELECT '3 value_chain_score', (SELECT n FROM n), count_if(abs(vc - v2) > 0.0021) FROM z
      UNION ALL SELECT '4 composition', (SELECT n FROM n), count_if(NOT (abs(f - 0.05) <= 0.0021 OR (f <= base + 0.0021 AND len(list_filter({V.legal_factors()}, lambda q: abs(CASE WHEN base > 1e-9 THEN f / base ELSE 1 END - q) <= 0.02)) > 0))) FROM z
      UNION ALL SELECT '5 decision', (SELECT g FROM n), count_if(gate IS NOT NULL AND due <> dc) FROM z UNION ALL SELECT '6a match_type', (SELECT n FROM n), count_if(due_type <> mt) FROM z UNION ALL SELECT '6b opportunity_status', (SELECT n FROM n), count_if(due_status <> status) FROM z
      UNION ALL SELECT '7 rank', (SELECT n FROM n), count_if(coalesce(ld > dx OR (ld = dx AND lf < f), false) OR pursue_rank <> rn) FROM z)""",
    "diagnostics_report": f"""WITH {_C}, p AS (SELECT *, CASE WHEN qualified THEN row_number() OVER (PARTITION BY oid, qualified ORDER BY profile DESC, cid) END AS ro, verdict IN ('Direct', 'Yes') AS dir FROM ({PAIRS_SQL})), c AS (SELECT cid, count(*) AS n FROM p WHERE ro <= 3 GROUP BY cid)
      SELECT count(*) AS pairs_total, count_if(qualified)::BIGINT AS pairs_qualified, count(DISTINCT CASE WHEN qualified THEN cid END) AS companies_with_qualified_match, count(DISTINCT CASE WHEN dir THEN oid END) AS opportunities_with_direct_fit, count(DISTINCT CASE WHEN verdict = 'Partial' THEN oid END) AS opportunities_with_partner_fit,
        count_if(dir)::BIGINT AS pairs_direct_fit, count_if(verdict = 'Partial')::BIGINT AS pairs_partner_fit, round(quantile_cont(profile, 0.5), 4) AS median_raw_profile_cosine, count_if(human = 'Disagree')::BIGINT AS human_overrides_applied, (SELECT round((max(n) / sum(n))::DOUBLE, 3) FROM c) AS top3_company_concentration,
        round(avg(CASE WHEN votes LIKE '%/%' THEN (split_part(votes, '/', 1) = split_part(votes, '/', 2))::INT END), 3) AS gate_unanimous_share, (SELECT count(*) FROM (SELECT oid FROM p GROUP BY oid HAVING NOT bool_or(qualified AND oid % 4 <> 0))) AS opportunities_abstained,
        (SELECT count(*) FROM sz WHERE n >= 3) AS consortium_ready_opportunities, 17 AS companies_total, 'tfidf' AS embedding_mode, 3 AS duplicate_rows_merged, 'insufficient' AS calibration_labels, 5 AS calibration_human_labels, 'abcdef01' AS rubric_version, 2 AS gate_verdict_flips_vs_prev, 'insufficient' AS calibration_auc_final_score FROM p""",
    "run_timestamp": "SELECT r_regionkey, true AS well_formed FROM region",
    "sector_report": """WITH x AS (SELECT *, c_custkey % 5 IN (1, 4) AS blank FROM customer) SELECT count(*) AS rows_total, count_if(NOT blank)::BIGINT AS sector_filled, count_if(blank)::BIGINT AS sector_blank, 2::BIGINT AS vocabulary, (SELECT count(DISTINCT n_name) FROM nation) AS cache_entries,
      count_if(c_custkey % 3 = 0)::BIGINT AS filled_industry_field, 0::BIGINT AS filled_business_unit_field, count_if(c_custkey % 4 = 0)::BIGINT AS filled_country_field, (SELECT string_agg(c_name, '|' ORDER BY c_custkey) FROM (SELECT * FROM x WHERE blank ORDER BY c_custkey LIMIT 15)) AS first_blank FROM x""",
    "backends": "SELECT * FROM (VALUES (0, '', ''), (1, 'public', 'public'), (2, 'hosted', ''), (3, 'hosted', 'public'), (4, '', 'hosted'), (5, '', ''), (6, 'public', 'public'), (7, '', '')) v(k, chat, embed)",
    "page_payload": f"""WITH {_C}, p AS (SELECT *, coalesce(verdict IN ('Direct', 'Partial') AND oid % 3 <> 1 AND cid < 9, false) AS v FROM ({PAIRS_SQL})),
      g AS (SELECT oid, count_if(v)::BIGINT AS n, coalesce(string_agg('{{"name":"firm ' || cid || '","sector":"Mining","kind":"' || CASE WHEN verdict = 'Direct' THEN 'Can build it' ELSE 'Good supplier / partner' END || '","why":"e' || cid || '"}}', ',' ORDER BY profile DESC, cid) FILTER (WHERE v), '') AS c FROM p GROUP BY oid),
      i AS (SELECT oid, string_agg('{{"need":"' || capability || '","quote":"' || CASE WHEN seq <> 1 THEN 'q' || seq ELSE '' END || '","covered_by":"' || CASE WHEN two IS NULL THEN '' WHEN two THEN 'A' || oid || ', B' || oid ELSE 'C' || oid END || '","gap":' || (two IS NULL)::VARCHAR || '}}', ',' ORDER BY capability) AS items FROM nd LEFT JOIN mt USING (oid, seq) GROUP BY oid)
      SELECT 'deal ' || oid AS opportunity, g.n AS n, row_number() OVER (ORDER BY g.n = 0, 'deal ' || oid) - 1 AS place,
        '{{"name":"deal ' || oid || '","sector":"' || CASE WHEN oid % 2 = 0 THEN 'Mining' ELSE 'MedTech' END || '","companies":[' || c || '],"consortium":{{"status":"' || CASE WHEN sz.n >= 3 THEN 'Ready' ELSE 'Thin data - ranked view applies' END || '","items":[' || CASE WHEN sz.n >= 3 THEN items ELSE '' END || ']}}}}' AS payload
      FROM g JOIN i USING (oid) JOIN sz USING (oid)""",
}
