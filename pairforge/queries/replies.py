"""What follows a model's reply: replies are dealt over driver tables, broken and missing ones among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions import arrays as A
from pairforge.functions import text as X
from pairforge.operators import matching_text as M
from pairforge.operators import providers as P
from pairforge.queries.base import PAIRS_SQL, pairs, pick, sql_pick, sql_text, t
from pairforge.sources import readers
from pairforge.sources.stages import missing_from_cache

S = SparkSession
FENCE = "```"
REPLIES = [
    '{"decision": "Yes", "confidence": 0.75, "fit": "direct supplier", "explanation": " ok ", "email": "a.b@x.org"}', FENCE + 'json\n{"decision": "no", "confidence": 1.5, "fit": "Partial", "email": "none"}\n' + FENCE,
    "Yes, it fits. Write to c@d.com.", "no idea", None, '{"decision": "perhaps", "confidence": -1, "fit": "No"}', "{broken",
]
SECTOR_REPLIES = ["Mining", " MedTech ", "Space", None, ""]
NODES = ["Mining", "medtech", "Robotics", "", None]


def _cust(s: S, d: str) -> DataFrame:
    return t(s, d, "customer").withColumn("k", F.col("c_custkey"))


def to_list(s: S, d: str) -> DataFrame:
    """H1: lists with blanks, nulls and no list at all."""
    a = F.when(F.col("k") % 4 == 0, F.lit(None).cast("array<string>")).otherwise(F.array("c_name", F.lit("  "), F.lit(None).cast("string"), F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))))
    return _cust(s, d).select("c_custkey", F.array_join(A.to_list(a), "|").alias("result"))


def _lists(k: str = "k") -> list:
    one = lambda i: F.when((F.col(k) + i) % 3 != 0, F.array(F.concat(F.lit(f"x{i} "), F.col(k).cast("string")), F.lit(" ")))
    return [one(i) for i in range(4)]


def entity_text(s: S, d: str) -> DataFrame:
    a = _lists()
    none = F.array().cast("array<string>")
    return _cust(s, d).select("c_custkey", P.entity_text(*a).alias("opportunity"), P.entity_text(*a[:3]).alias("company"), P.entity_text(F.when(F.col("k") % 2 == 0, none)).alias("none"))


def brief_text(s: S, d: str) -> DataFrame:
    a = _lists()
    fields = dict(zip(["Named products", "Named services", "Operating regions", "Core strengths"], a, strict=True))
    history, chain = pick(["1990 as a forge", "Not stated in source", ""], F.col("k")), pick(["OEM", "other"], F.col("k"))
    return _cust(s, d).select("c_custkey", P.brief_card(pick(["Makes steel", ""], F.col("k")), fields, history, chain, a[0]).alias("result"))


def parsed_reply(s: S, d: str) -> DataFrame:
    """H8: replies with and without a fence; null where there is no JSON."""
    j = P.reply_json(pick(REPLIES, F.col("k")), "decision string, confidence double")
    return _cust(s, d).select("c_custkey", j["decision"].alias("decision"), j["confidence"].alias("confidence"))


def first_reply(s: S, d: str) -> DataFrame:
    """S16: of the replies of several models the first that can be read."""
    return _cust(s, d).select("c_custkey", P.first_readable([pick(REPLIES, F.col("k") + 3 * i) for i in range(3)], "decision string")["decision"].alias("decision"))


def _sent(s: S, d: str) -> DataFrame:
    return pairs(s, d).withColumn("triage_pass", F.col("profile") >= 0.4).withColumn("suggested_plan", F.array(F.lit("a"), F.col("role"), F.lit(" "), F.lit("c"), F.lit("d")))


def batched_decisions(s: S, d: str) -> DataFrame:
    """M4 and P9: replies of two pairs of three; pairs that were not sent are stamped."""
    replies = pairs(s, d).filter("(cid + oid) % 3 <> 0").select("cid", "oid", pick(["Yes", " yes ", "No", "Maybe", None], F.col("cid") + F.col("oid")).alias("ai_decision"))
    out = P.filtered_stamp(P.batched_decisions(_sent(s, d), replies, ["cid", "oid"]))
    return out.select("cid", "oid", "ai_decision", "ai_score", F.array_join("suggested_plan", "|").alias("plan"), F.size("match_reason").cast("long").alias("n_reasons"))


def scored_decision(s: S, d: str) -> DataFrame:
    """H11 of the scored generation: coerced values, three texts each."""
    k = F.col("k")
    df = _cust(s, d).select(
        "c_custkey", pick(["yes", "NO ", "Maybe", None], k).alias("ai_decision"), pick(["55", "-3", "140", "x", None], k).alias("match_value"), pick([" high", "MEDIUM", "sure", None], k).alias("match_confidence"),
        F.when(k % 2 == 0, F.array(F.lit("one"), F.lit(" "))).alias("suggested_plan"), F.array(F.lit("r1"), F.lit("r2"), F.lit("r3"), F.lit("r4")).alias("match_reason"),
    )
    out = P.scored_decision(df)
    return out.select("c_custkey", "ai_decision", "match_value", "match_confidence", F.array_join("suggested_plan", "|").alias("plan"), F.array_join("match_reason", "|").alias("reason"))


def single_reply_g1(s: S, d: str) -> DataFrame:
    said, conf = P.single_reply_g1(pick(REPLIES, F.col("k")))
    return _cust(s, d).select("c_custkey", said.alias("decision"), conf.alias("confidence"))


def single_reply_g0(s: S, d: str) -> DataFrame:
    said, score = P.single_reply_g0(pick(REPLIES, F.col("k")))
    return _cust(s, d).select("c_custkey", said.alias("decision"), score.alias("score"))


def graded_reply(s: S, d: str) -> DataFrame:
    g = P.graded_reply(pick(REPLIES, F.col("k")))
    return _cust(s, d).select("c_custkey", g["fit"].alias("fit"), g["confidence"].alias("confidence"), g["explanation"].alias("explanation"))


def gate_prompt(s: S, d: str) -> DataFrame:
    """M7 and F22: the prompt's fields are cut; empty ones are left out."""
    b = t(s, d, "benchmark")
    return b.select("item_id", F.md5(P.gate_prompt({"Name": F.concat(F.lit("firm "), F.col("item_id").cast("string")), "Sector": F.lit(" ")}, {"Description": F.repeat("text", 9)}, 300).cast("binary")).alias("prompt"))


def row_bundle(s: S, d: str) -> DataFrame:
    """the lookup record of a company, long texts cut."""
    docs = t(s, d, "documents")
    out = docs.select("doc_id", P.row_bundle({"company_name": F.concat(F.lit(" doc "), F.col("doc_id").cast("string")), "company_profile": F.col("text"), "country_field": F.col("lang")}).alias("b"))
    return out.select("doc_id", F.md5(F.col("b.company_profile").cast("binary")).alias("profile"), F.col("b.company_name").alias("name"), F.col("b.country_field").alias("country"), F.col("b.website_field").alias("website"))


def row_context(s: S, d: str) -> DataFrame:
    """preferred fields of a row, or all of them where no preferred one is filled."""
    k = F.col("c_custkey")
    df = t(s, d, "customer").select(F.when(k % 3 == 0, F.lit(" ")).otherwise(F.col("c_name")).alias("NAME"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("profile"), k.cast("string").alias("Key"))
    return df.select(F.col("Key").cast("long").alias("c_custkey"), X.row_context(df, ["Name", "Profile", "Website"]).alias("result"))


def email_column(s: S, d: str) -> DataFrame:
    """the e-mail column by its name, ``Email`` if there is none."""
    n = t(s, d, "nation")
    return s.createDataFrame([(1, readers.email_column(n)), (2, readers.email_column(n.withColumnRenamed("n_name", " Work  E-MAIL"))), (3, readers.email_column(n.withColumnRenamed("n_name", "E-Mail")))], "k int, found string")


def _entries(s: S, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    return t(s, d, "nation").filter("n_nationkey % 3 <> 0").select(F.col("n_name").alias("sector"), F.when(k % 2 == 0, F.lit(" ")).otherwise(F.lower("n_name")).alias("canonical"), F.array(F.lit("s "), F.lit("")).alias("synonyms"), F.lit(None).cast("array<string>").alias("sub_domains"), F.array(k.cast("string")).alias("adjacent_domains"))


def ontology_entries(s: S, d: str) -> DataFrame:
    """M1: a sector without a reply stands for itself."""
    n = t(s, d, "nation").select(F.col("n_name").alias("sector"))
    e = P.ontology_entries(n.union(n), _entries(s, d))
    return e.select("sector", "canonical", F.array_join("synonyms", "|").alias("synonyms"), F.size("sub_domains").cast("long").alias("subs"), F.array_join("adjacent_domains", "|").alias("adjacent"))


def unanswered(s: S, d: str) -> DataFrame:
    """Sectors that still need a reply: cache misses and items without an answer are the same anti-join."""
    n = t(s, d, "nation").select(F.col("n_name").alias("sector"))
    return P.all_answered(n, _entries(s, d), "sector").intersect(missing_from_cache(n, _entries(s, d), "sector"))


def company_enrichment(s: S, d: str) -> DataFrame:
    c = t(s, d, "supplier").select(F.col("s_suppkey").alias("cid"), pick(NODES, F.col("s_suppkey") + 1).alias("sector"))
    k = F.col("cid")
    r = c.filter("cid % 3 <> 0").select(
        "cid", pick(NODES, k).alias("normalized_sector"), pick([dims.ROLES[0], "Wizard", None], k).alias("value_chain_role"), pick([dims.ROLES[2], ""], k).alias("secondary_role"),
        F.when(k % 4 != 0, 0.9).alias("classification_confidence"), F.create_map(F.lit("rd_capability"), (k % 10) / 10.0).alias("readiness"),
    )
    out = P.company_enrichment(c, r, "cid")
    return out.select("cid", "normalized_sector", "value_chain_role", "secondary_role", "classification_confidence", F.try_element_at("readiness", F.lit("rd_capability")).alias("rd"))


def opportunity_enrichment(s: S, d: str) -> DataFrame:
    o = t(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("oid"), pick(NODES, F.col("n_nationkey") + 1).alias("sector"))
    k = F.col("oid")
    r = o.filter("oid % 3 <> 0").select("oid", pick(NODES, k).alias("normalized_sector"), F.when(k % 4 != 0, F.array(F.lit("Wizard"), *[pick(dims.ROLES, k + i) for i in range(4)])).alias("required_roles"))
    return P.opportunity_enrichment(o, r, "oid").select("oid", "normalized_sector", F.array_join("required_roles", "|").alias("roles"))


def narratives(s: S, d: str) -> DataFrame:
    k = F.col("k")
    df = _cust(s, d).select("c_custkey", pick([" the Saudi FDA approved", "none"], k).alias("strengths"), F.array(F.lit("Saudi FDA rules"), F.lit(" "), F.lit("b"), F.lit("c"), F.lit("d")).alias("match_reason"), pick(["joint venture", "", "not recommended"], k).alias("suggested_localization_model"), pick(["Good Match", "Poor Match"], k).alias("decision"))
    out = P.narrative(df, "decision")
    return out.select("c_custkey", "strengths", F.array_join("match_reason", "|").alias("reasons"), F.col("suggested_localization_model").alias("model"))


def export_fit(s: S, d: str) -> DataFrame:
    return _cust(s, d).select("c_custkey", P.export_fit(pick(["direct", "PARTIAL ", "Error: timeout", "no", None], F.col("k"))).alias("fit"))


def closed_pick(s: S, d: str) -> DataFrame:
    labels = s.createDataFrame([("Mining",), ("MedTech",)], "label string")
    return P.closed_picks(_cust(s, d).select("c_custkey", pick(SECTOR_REPLIES, F.col("k")).alias("reply")), "reply", labels, "sector").select("c_custkey", "sector")


def sector_inference(s: S, d: str) -> DataFrame:
    k = F.col("c_custkey")
    c = t(s, d, "customer").select(k.alias("company_id"), F.concat(F.lit("Firm  "), "c_name").alias("company_name"), F.when(k % 3 == 0, "Energy").otherwise(F.lit(" ")).alias("sector"))
    key = F.concat(F.lit("id:"), k.cast("string"), F.lit(":firm "), F.lower("c_name"))
    cache = t(s, d, "customer").filter("c_custkey % 4 <> 0").select(key.alias("key"), pick(SECTOR_REPLIES, k).alias("sector"), F.lit("web").alias("source"))
    return P.sector_inference(c, cache, ["Mining", "MedTech"]).select("company_id", "effective_sector", "inferred", "source")


def email_reply(s: S, d: str) -> DataFrame:
    return _cust(s, d).select("c_custkey", P.email_reply(pick(REPLIES, F.col("k"))).alias("email"))


def need_cover(s: S, d: str) -> DataFrame:
    """M11: cover entries name validated companies only."""
    n = t(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("oid"))
    cover = n.select("oid", F.lit(0).alias("pos"), F.lit("steel").alias("need"), F.array(*[F.struct(F.concat(F.lit(x), F.col("oid").cast("string")).alias("name"), F.lit("w").alias("why")) for x in "AB"]).alias("companies"))
    allowed = n.filter("oid % 3 <> 0").select("oid", F.concat(pick(["A", "B"], F.col("oid")), F.col("oid").cast("string")).alias("name"))
    return P.need_cover(cover, allowed, "oid").select("oid", "need", F.array_join(F.transform("companies", lambda x: x["name"]), "|").alias("names"))


def structured_extraction(s: S, d: str) -> DataFrame:
    """M12: the five lists of a structured brief; adjacent sectors resolved to the closed vocabulary."""
    reply = pick(['{"required_capabilities": ["Casting ", ""], "adjacent_value_chain_sectors": ["MINING", "ict sector"]}', FENCE + '\n{"required_inputs": ["ore"], "capability_keywords": null}\n' + FENCE, "none", None], F.col("oid"))
    o = t(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("oid")).withColumn("reply", reply)
    out = P.structured_brief(o, "reply")
    labels = s.createDataFrame([("Mining",), ("MedTech",)], "label string")
    raw = out.select(F.col("oid").alias("id"), F.explode("adjacent_value_chain_sectors").alias("raw"))
    found = M.adjacent_label(raw, labels).filter("resolved IS NOT NULL").groupBy(F.col("id").alias("oid")).agg(F.array_sort(F.collect_set("resolved")).alias("a"))
    joined = out.join(found, "oid", "left")
    return joined.select("oid", *[F.array_join(c, "|").alias(c) for c in ("required_capabilities", "required_inputs", "capability_keywords")], F.coalesce(F.array_join("a", "|"), F.lit("")).alias("adjacent"))


def default_backfill(s: S, d: str) -> DataFrame:
    """P13: an older checkpoint without some columns, and with texts where numbers belong."""
    k = F.col("k")
    old = _cust(s, d).select("c_custkey", pick(["3", "x", None, " 4 "], k).alias("signal_sector_overlap"), F.when(k % 2 == 0, k % 4 == 0).alias("triage_pass"), pick([" why ", None], k).alias("triage_reason"))
    return P.with_defaults(old).drop("sector_inference_evidence")


def text_fill_in(s: S, d: str) -> DataFrame:
    """J4: an older pair table gets its texts from the two sources; what isn't found is empty."""
    p = pairs(s, d).select("cid", "oid")
    c = t(s, d, "supplier").filter("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("cid"), F.concat(F.lit(" "), "s_name").alias("company_name"), F.lit(None).cast("string").alias("company_profile"))
    o = t(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("oid"), F.col("n_name").alias("opportunity_name"))
    return P.filled_in(P.filled_in(p, c, "cid", ["company_name", "company_profile"]), o, "oid", ["opportunity_name"])


QUERIES = {
    "to_list": to_list, "entity_text": entity_text, "brief_text": brief_text, "parsed_reply": parsed_reply, "first_reply": first_reply, "batched_decisions": batched_decisions, "scored_decision": scored_decision,
    "single_reply_g1": single_reply_g1, "single_reply_g0": single_reply_g0, "graded_reply": graded_reply, "gate_prompt": gate_prompt, "row_bundle": row_bundle, "row_context": row_context, "email_column": email_column,
    "ontology_entries": ontology_entries, "unanswered": unanswered, "company_enrichment": company_enrichment, "opportunity_enrichment": opportunity_enrichment, "narratives": narratives, "export_fit": export_fit,
    "closed_pick": closed_pick, "sector_inference": sector_inference, "email_reply": email_reply, "need_cover": need_cover, "structured_extraction": structured_extraction, "default_backfill": default_backfill,
    "text_fill_in": text_fill_in,
}

# --- SQL -----------------------------------------------------------------------------------------

_n = len(REPLIES)


def _by_reply(values: list, cast: str = "") -> str:
    """What becomes of each of REPLIES, written out by hand."""
    assert len(values) == _n
    return "CASE c_custkey % 7 " + " ".join(f"WHEN {i} THEN {sql_text(v) if isinstance(v, str) else 'NULL' if v is None else v}" for i, v in enumerate(values)) + f" END{cast}"


_item = lambda i, k: f"CASE WHEN ({k} + {i}) % 3 <> 0 THEN 'x{i} ' || {k} END"
_some = lambda n, k="c_custkey": "list_filter([" + ", ".join(_item(i, k) for i in range(n)) + "], lambda x: x IS NOT NULL)"
_labels = ["Named products", "Named services", "Operating regions", "Core strengths"]


def _node_map() -> str:
    nodes = {**{n: n for n in dims.TAXONOMY}, **{leaf: leaf for leaves in dims.TAXONOMY.values() for leaf in leaves}, **dims.SECTOR_SYNONYMS}
    return "MAP {" + ", ".join(f"{sql_text(k)}: {sql_text(v)}" for k, v in nodes.items()) + "}"


def _label(x: str) -> str:
    return f"coalesce({_node_map()}[lower(trim(coalesce({x}, '')))], '')"


def _node_or(a: str, b: str) -> str:
    return f"coalesce(nullif({_label(a)}, ''), {_label(b)})"


SQL = {
    "to_list": "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name || '|' || c_mktsegment END AS result FROM customer",
    "entity_text": f"SELECT c_custkey, coalesce(nullif(array_to_string({_some(4)}, ' '), ''), 'n/a') AS opportunity, coalesce(nullif(array_to_string({_some(3)}, ' '), ''), 'n/a') AS company, 'n/a' AS \"none\" FROM customer",
    "brief_text": "SELECT c_custkey, concat_ws(chr(10), CASE WHEN c_custkey % 2 = 0 THEN 'Summary: Makes steel' END, " + ", ".join(f"{sql_text(n + ': ')} || {_item(i, 'c_custkey')}" for i, n in enumerate(_labels))
      + f", CASE WHEN c_custkey % 3 = 0 THEN 'Founded/history: 1990 as a forge' END, CASE WHEN c_custkey % 2 = 0 THEN 'Value-chain position: OEM' END, 'Inferred (not directly stated): ' || {_item(0, 'c_custkey')}) AS result FROM customer",
    "parsed_reply": f"SELECT c_custkey, {_by_reply(['Yes', 'no', None, None, None, 'perhaps', None])} AS decision, {_by_reply([0.75, 1.5, None, None, None, -1, None], '::DOUBLE')} AS confidence FROM customer",
    "first_reply": "SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'perhaps' WHEN 3 THEN NULL WHEN 4 THEN 'Yes' WHEN 5 THEN 'perhaps' WHEN 6 THEN 'perhaps' END AS decision FROM customer",
    "batched_decisions": f"""WITH p AS (SELECT *, CASE WHEN (cid + oid) % 3 <> 0 AND (cid + oid) % 5 IN (0, 1) THEN 'Yes' ELSE 'No' END AS a FROM ({PAIRS_SQL}))
      SELECT cid, oid, CASE WHEN profile >= 0.4 THEN a ELSE 'Filtered' END AS ai_decision, CASE WHEN profile >= 0.4 AND a = 'Yes' THEN 1 ELSE 0 END::INT AS ai_score, CASE WHEN profile >= 0.4 THEN 'a|' || role || '| |c|d' ELSE '' END AS plan, CASE WHEN profile >= 0.4 THEN 0 ELSE 3 END::BIGINT AS n_reasons FROM p""",
    "scored_decision": """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS ai_decision, CASE c_custkey % 5 WHEN 0 THEN 55 WHEN 2 THEN 100 ELSE 0 END::INT AS match_value,
      CASE c_custkey % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS match_confidence, CASE WHEN c_custkey % 2 = 0 THEN 'one||' ELSE '||' END AS plan, 'r1|r2|r3' AS reason FROM customer""",
    "single_reply_g1": f"SELECT c_custkey, {_by_reply(['Yes', 'No', 'Yes', 'No', 'Not Run', 'No', 'No'])} AS decision, {_by_reply([0.75, 1.0, 0.8, 0.2, 0.0, 0.0, 0.2], '::DOUBLE')} AS confidence FROM customer",
    "single_reply_g0": f"SELECT c_custkey, {_by_reply(['No', 'No', 'Yes', 'No', 'Error', 'No', 'No'])} AS decision, {_by_reply([0.3, 0.3, 0.95, 0.3, 0.0, 0.3, 0.3], '::DOUBLE')} AS score FROM customer",
    "graded_reply": f"SELECT c_custkey, {_by_reply(['Direct', 'Partial', None, None, None, 'No', None])} AS fit, {_by_reply([0.75, 1.0, None, None, None, 0.0, None], '::DOUBLE')} AS confidence, {_by_reply(['ok', '', None, None, None, '', None])} AS explanation FROM customer",
    "gate_prompt": "SELECT item_id, md5('COMPANY' || chr(10) || 'Name: firm ' || item_id || chr(10) || chr(10) || 'OPPORTUNITY' || chr(10) || 'Description: ' || trim(substring(trim(repeat(text, 9), ' '), 1, 300), ' ')) AS prompt FROM benchmark",
    "row_bundle": "SELECT doc_id, md5(substring(trim(coalesce(text, ''), ' '), 1, 2400)) AS profile, 'doc ' || doc_id AS name, trim(coalesce(lang, '')) AS country, '' AS website FROM documents",
    "row_context": """WITH x AS (SELECT c_custkey, concat_ws(chr(10), CASE WHEN c_custkey % 3 <> 0 THEN 'Name: ' || c_name END, CASE WHEN c_custkey % 2 = 0 THEN 'Profile: ' || c_mktsegment END) AS r FROM customer)
      SELECT c_custkey, CASE WHEN r <> '' THEN r ELSE 'Key: ' || c_custkey END AS result FROM x""",
    "email_column": "SELECT * FROM (VALUES (1, 'Email'), (2, 'Email'), (3, 'E-Mail')) v(k, found)",
    "ontology_entries": "SELECT n_name AS sector, CASE WHEN n_nationkey % 3 = 0 OR n_nationkey % 2 = 0 THEN n_name ELSE lower(n_name) END AS canonical, CASE WHEN n_nationkey % 3 <> 0 THEN 's' ELSE '' END AS synonyms, 0::BIGINT AS subs, CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey::VARCHAR ELSE '' END AS adjacent FROM nation",
    "unanswered": "SELECT n_name AS sector FROM nation WHERE n_nationkey % 3 = 0",
    "company_enrichment": f"""WITH c AS (SELECT s_suppkey AS cid, {sql_pick(NODES, 's_suppkey + 1')} AS sector, {sql_pick(NODES, 's_suppkey')} AS ns, s_suppkey % 3 <> 0 AS r FROM supplier)
      SELECT cid, CASE WHEN r THEN {_node_or('ns', 'sector')} ELSE {_label('sector')} END AS normalized_sector, CASE WHEN r AND cid % 3 = 0 THEN {sql_text(dims.ROLES[0])} ELSE '' END AS value_chain_role, CASE WHEN r AND cid % 2 = 0 THEN {sql_text(dims.ROLES[2])} ELSE '' END AS secondary_role,
        CASE WHEN r AND cid % 4 <> 0 THEN 0.9 ELSE 0.2 END::DOUBLE AS classification_confidence, CASE WHEN r THEN (cid % 10) / 10.0::DOUBLE END AS rd FROM c""",
    "opportunity_enrichment": f"""WITH o AS (SELECT n_nationkey::BIGINT AS oid, {sql_pick(NODES, 'n_nationkey + 1')} AS sector, {sql_pick(NODES, 'n_nationkey')} AS ns, n_nationkey % 3 <> 0 AS r FROM nation)
      SELECT oid, CASE WHEN r THEN {_node_or('ns', 'sector')} ELSE {_label('sector')} END AS normalized_sector, CASE WHEN r AND oid % 4 <> 0 THEN {" || '|' || ".join(sql_pick(dims.ROLES, f'oid + {i}') for i in range(3))} ELSE 'Contract Manufacturer' END AS roles FROM o""",
    "narratives": """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'the SFDA approved' ELSE 'none' END AS strengths, 'SFDA rules|b|c' AS reasons,
      CASE WHEN c_custkey % 3 = 0 THEN 'Joint venture' WHEN c_custkey % 3 = 2 THEN 'Not recommended' WHEN c_custkey % 2 = 0 THEN 'Supplier localization' ELSE 'Not recommended' END AS model FROM customer""",
    "export_fit": "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Direct' WHEN 1 THEN 'Partial' WHEN 2 THEN 'Error: timeout' ELSE 'None' END AS fit FROM customer",
    "closed_pick": "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Mining' WHEN 1 THEN 'MedTech' ELSE 'UNKNOWN' END AS sector FROM customer",
    "sector_inference": """WITH x AS (SELECT c_custkey AS k, c_custkey % 3 <> 0 AND c_custkey % 4 <> 0 AND c_custkey % 5 IN (0, 1) AS u FROM customer)
      SELECT k AS company_id, CASE WHEN u THEN CASE k % 5 WHEN 0 THEN 'Mining' ELSE 'MedTech' END WHEN k % 3 = 0 THEN 'Energy' ELSE '' END AS effective_sector, u AS inferred, CASE WHEN u THEN 'web' ELSE 'none' END AS source FROM x""",
    "email_reply": f"SELECT c_custkey, {_by_reply(['a.b@x.org', '', 'c@d.com', '', '', '', ''])} AS email FROM customer",
    "need_cover": "SELECT n_nationkey::BIGINT AS oid, 'steel' AS need, CASE WHEN n_nationkey % 3 = 0 THEN '' WHEN n_nationkey % 2 = 0 THEN 'A' || n_nationkey ELSE 'B' || n_nationkey END AS names FROM nation",
    "structured_extraction": "SELECT n_nationkey::BIGINT AS oid, CASE WHEN n_nationkey % 4 = 0 THEN 'Casting' ELSE '' END AS required_capabilities, CASE WHEN n_nationkey % 4 = 1 THEN 'ore' ELSE '' END AS required_inputs, '' AS capability_keywords, CASE WHEN n_nationkey % 4 = 0 THEN 'Mining' ELSE '' END AS adjacent FROM nation",
    "default_backfill": """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 3 WHEN 3 THEN 4 ELSE 0 END::INT AS signal_sector_overlap, c_custkey % 4 = 0 AS triage_pass, CASE WHEN c_custkey % 2 = 0 THEN 'why' ELSE '' END AS triage_reason, false AS sector_was_inferred, 'none' AS sector_inference_source,
      false AS signal_value_chain_adjacent, 0::INT AS signal_capability_keyword_count, 0::INT AS signal_input_overlap_count, 0.0::DOUBLE AS signal_product_similarity, 0.0::DOUBLE AS signal_profile_similarity FROM customer""",
    "text_fill_in": f"SELECT cid, oid, CASE WHEN cid % 3 <> 0 THEN s_name ELSE '' END AS company_name, '' AS company_profile, n_name AS opportunity_name FROM ({PAIRS_SQL}) JOIN supplier ON s_suppkey = cid JOIN nation ON n_nationkey = oid",
}
