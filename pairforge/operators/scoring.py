"""Sector scores, taxonomy, value chain, penalties, fusion, decisions: row-level expressions."""

from __future__ import annotations

from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions.arrays import agreement, expanded, half_up, jaccard, mapped, overlaps
from pairforge.functions.text import preprocess, preprocess_g0, static_tokens, without_common

# --- sector scores ------------------------------------------------------------------------------


def sector_bag(sector: Column, generation: int = 3, common: Column | None = None) -> Column:
    """The canonical tokens of a sector label and what the ontology lists under them.  ``common``: the
    tokens that the corpus makes meaningless, as an array."""
    g1 = generation == 1
    tokens = static_tokens(sector, [*dims.GENERIC_TERMS, *dims.GENERIC_TERMS_G1] if g1 else None)
    if common is not None:
        tokens = without_common(tokens, common)
    return expanded(mapped(tokens, dims.SECTOR_TOKEN_MAP_G1 if g1 else dims.SECTOR_TOKEN_MAP), dims.SECTOR_ONTOLOGY_G1 if g1 else dims.SECTOR_ONTOLOGY)


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _crossed(c: Column, o: Column, a: list[str], b: list[str]) -> Column:
    return (overlaps(c, a) & overlaps(o, b)) | (overlaps(c, b) & overlaps(o, a))


def base_sector_score(c: Column, o: Column, groups: list[list[str]]) -> Column:
    group_hit = _any([overlaps(c, g) & overlaps(o, g) for g in groups])
    return F.greatest(jaccard(c, o), F.when(group_hit, 0.75).otherwise(0.0))


def bridge(c: Column, o: Column, capability: Column, base: Column) -> Column:
    """The first bridge rule that fires and beats ``base``: a struct (score, name, terms), null if none."""
    generic = F.array(*map(F.lit, dims.GENERIC_BRIDGE_TERMS))
    out = None
    for a, b, terms, score, name, least in dims.BRIDGE_RULES:
        hits = F.array_intersect(capability, F.array(*map(F.lit, terms)))
        fires = _crossed(c, o, a, b) & (F.size(hits) >= least) & (F.size(F.array_except(hits, generic)) > 0) & (F.lit(score) > base) & (base < 0.5)
        value = F.struct(F.lit(score).alias("score"), F.lit(name).alias("name"), F.array(*map(F.lit, terms)).alias("terms"))
        out = F.when(fires, value) if out is None else out.when(fires, value)
    return out


def score_label(score: Column) -> Column:
    return F.when(score >= 0.80, "Strong").when(score >= 0.50, "Moderate").when(score > 0, "Weak").otherwise("No")


def with_sector_score(pairs: DataFrame, company: str, opportunity: str, capability: str) -> DataFrame:
    """sector_score, sector_label, bridge_name and sector_reason for pairs; ``capability`` is a token array.

    Bags are made once for each different pair of labels when the caller passes those; here they are
    columns, computed before the rules use them.
    """
    p = pairs.withColumns({"_c": sector_bag(F.col(company)), "_o": sector_bag(F.col(opportunity))})
    p = p.withColumn("_base", base_sector_score(F.col("_c"), F.col("_o"), dims.SECTOR_GROUPS))
    p = p.withColumn("_bridge", bridge(F.col("_c"), F.col("_o"), F.col(capability), F.col("_base")))
    unknown = (F.size("_c") == 0) | (F.size("_o") == 0)
    exact = preprocess(F.col(company)) == preprocess(F.col(opportunity))
    p = p.withColumn("sector_score", F.when(unknown, 0.0).when(exact, 1.0).otherwise(F.coalesce("_bridge.score", "_base")))
    p = p.withColumn("sector_label", F.when(unknown, "Unknown").when(exact, "Exact").otherwise(score_label(F.col("sector_score"))))
    p = p.withColumn("bridge_name", F.when(~unknown & ~exact, F.col("_bridge.name")))
    shared = F.array_sort(F.array_intersect("_c", "_o"))
    hits = F.array_sort(F.array_intersect(F.col(capability), F.coalesce("_bridge.terms", F.array().cast("array<string>"))))
    reason = (
        F.when(unknown, "Sector text missing or uninformative.")
        .when(exact, F.concat(F.lit("Exact sector match: '"), F.col(company), F.lit("'.")))
        .when(F.col("bridge_name").isNotNull(), F.concat(F.lit("Cross-sector bridge ("), F.col("bridge_name"), F.lit(") via capabilities: "), F.array_join(F.slice(hits, 1, 6), ", "), F.lit(".")))
        .when(F.size(shared) > 0, F.concat(F.lit("Shared sector terms: "), F.array_join(F.slice(shared, 1, 5), ", "), F.lit(".")))
        .when(F.col("_base") >= 0.75, "Sector families align (same broader industry group).")
        .otherwise(F.concat(F.lit("No direct sector overlap ('"), F.col(company), F.lit("' vs '"), F.col(opportunity), F.lit("').")))
    )
    return p.withColumn("sector_reason", reason).drop("_c", "_o", "_base", "_bridge")


def with_g1_sector_score(pairs: DataFrame, company: str, opportunity: str, capability: str, common: DataFrame | None = None) -> DataFrame:
    """The first generation: one hit makes a bridge, a bridge has its own label.  ``common`` (token): its
    vocabulary protects no word, so common tokens leave sector labels too.  They are at least a fixed
    share of the documents, so there are few of them, whatever the corpus: they travel as one row."""
    if common is not None:
        pairs = pairs.join(F.broadcast(common.agg(F.sort_array(F.collect_set("token")).alias("_common"))))
    words = F.col("_common") if common is not None else None
    p = pairs.withColumns({"_c": sector_bag(F.col(company), 1, words), "_o": sector_bag(F.col(opportunity), 1, words)}).drop("_common")
    p = p.withColumn("_base", base_sector_score(F.col("_c"), F.col("_o"), dims.SECTOR_GROUPS_G1))
    rule = None
    for a, b, terms, score, label, _ in dims.BRIDGE_RULES_G1:
        fires = _crossed(F.col("_c"), F.col("_o"), a, b) & overlaps(F.col(capability), terms)
        value = F.struct(F.lit(score).alias("score"), F.lit(label).alias("label"))
        rule = F.when(fires, value) if rule is None else rule.when(fires, value)
    p = p.withColumn("_rule", rule)
    unknown = (F.size("_c") == 0) | (F.size("_o") == 0)
    exact = preprocess(F.col(company)) == preprocess(F.col(opportunity))
    bridged = (F.col("_base") < 0.5) & (F.coalesce(F.col("_rule.score"), F.lit(0.0)) > F.col("_base"))
    p = p.withColumn("sector_score", F.when(unknown, 0.0).when(exact, 1.0).when(bridged, F.col("_rule.score")).otherwise(F.col("_base")))
    label = F.when(unknown, "Unknown").when(exact, "Exact").when(bridged, F.col("_rule.label")).otherwise(score_label(F.col("_base")))
    return p.withColumn("sector_label", label).drop("_c", "_o", "_base", "_rule")


def g0_sector_match(company: Column, opportunity: Column) -> Column:
    a, b = preprocess_g0(company), preprocess_g0(opportunity)
    together = _any([a.isin(g) & b.isin(g) for g in dims.SECTOR_GROUPS_G0])
    return F.when((a == "") | (b == ""), "Unknown").when((a == b) | together, "Yes").otherwise("No")


# --- taxonomy and value chain -------------------------------------------------------------------


def family(node: Column) -> Column:
    families = {leaf: f for f, leaves in dims.TAXONOMY.items() for leaf in leaves} | {f: f for f in dims.TAXONOMY}
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in families.items() for x in kv]), node), F.lit(""))


def taxonomy_similarity(a: Column, b: Column, fa: Column | None = None, fb: Column | None = None) -> Column:
    """1 for one node, .8 / .65 inside a family, else the families' affinity; unknown nodes .3 or .15.
    ``fa`` and ``fb``: families found elsewhere (a node that is its own family is a root)."""
    fa, fb = (family(a) if fa is None else fa), (family(b) if fb is None else fb)
    pair = F.concat_ws("|", F.least(fa, fb), F.greatest(fa, fb))
    affinity = F.create_map(*[x for (p, q), s in dims.FAMILY_AFFINITY.items() for x in (F.lit("|".join(sorted((p, q)))), F.lit(s))])
    return (
        F.when((F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == ""), 0.30)
        .when(a == b, 1.0)
        .when((fa != "") & (fa == fb), F.when((a == fa) | (b == fb), 0.80).otherwise(0.65))
        .when((fa != "") & (fb != ""), F.coalesce(F.try_element_at(affinity, pair), F.lit(dims.BASE_CROSS_FAMILY)))
        .otherwise(0.15)
    )


def value_chain_score(needs: Column, role: Column, second: Column) -> Column:
    """The best compatibility of a company's roles with the first three needs, later ones discounted."""
    table = F.create_map(*[x for n, r, s in dims.ROLE_COMPATIBILITY for x in (F.lit(f"{n}|{r}"), F.lit(s))])
    roles = F.filter(F.array(role, second), lambda r: r.isNotNull() & (r != ""))
    one = lambda n, i, r: F.when(n == r, 1.0).otherwise(F.coalesce(F.try_element_at(table, F.concat(n, F.lit("|"), r)), F.lit(dims.ROLE_DEFAULT))) * (1.0 - 0.1 * i)
    best = F.array_max(F.flatten(F.transform(F.slice(needs, 1, 3), lambda n, i: F.transform(roles, lambda r: one(n, i, r)))))
    missing = (F.coalesce(F.size(needs), F.lit(0)) < 1) | (F.coalesce(role, F.lit("")) == "")
    return F.when(missing, 0.30).otherwise(F.round(F.coalesce(best, F.lit(0.0)), 3))


def readiness(dim: Column, names: list[str]) -> Column:
    """The mean of some dimensions of a map, missing ones counting as 0.3."""
    return half_up(reduce(add, [F.coalesce(F.try_element_at(dim, F.lit(n)), F.lit(dims.READINESS_DEFAULT)) for n in names]) / len(names))


def penalties(sector: Column, profile: Column, product: Column, chain: Column, role: Column, lead: Column) -> tuple[Column, Column]:
    """(factor, names) of the penalties that apply; they multiply."""
    role, lead = F.coalesce(role, F.lit("")), F.coalesce(lead, F.lit(""))
    rules = [
        ("product_only_similarity", (product >= 0.70) & (profile < 0.45) & (sector < 0.40), 0.65),
        ("sector_mismatch", sector < 0.25, 0.75),
        ("value_chain_mismatch", chain < 0.30, 0.70),
        ("supplier_to_developer", role.isin("Raw Material Supplier", "Distributor") & lead.isin("Developer", "Research Company", "OEM"), 0.70),
        ("business_model_mismatch", role.isin("Investor", "Service Provider") & lead.isin("Contract Manufacturer", "OEM"), 0.70),
    ]
    factor = reduce(mul, [F.when(t, F.lit(f)).otherwise(F.lit(1.0)) for _, t, f in rules])
    return factor, F.filter(F.array(*[F.when(t, F.lit(n)) for n, t, _ in rules]), lambda x: x.isNotNull())


# --- fusion and decisions -----------------------------------------------------------------------


def fused(weights: dict[str, float], parts: dict[str, Column], normalise: bool = False) -> Column:
    total = sum(weights.values()) if normalise else 1.0
    return reduce(add, [F.lit(w / total) * parts[k] for k, w in weights.items() if w and k in parts])


def fusion_g4(parts: dict[str, Column], factor: Column, weights: dict[str, float] | None = None) -> Column:
    return half_up(F.greatest(F.lit(0.05), fused(weights or dims.WEIGHTS_G4, parts, normalise=True) * factor))


def decision_g3(final: Column, qualified: Column, linked: Column, verdict: Column, bridge_only: Column) -> Column:
    v = F.coalesce(verdict, F.lit(""))
    return (
        F.when(~qualified | v.isin("No", "Not Run"), "Low Fit")
        .when(v.isin("Direct", "Yes"), F.when(final >= 0.60, "High Fit").otherwise("Good Fit"))
        .when(v == "Partial", "Partner Fit")
        .when(~linked, F.when(final >= 0.55, "Review Needed").otherwise("Low Fit"))
        .when(bridge_only, F.when(final >= 0.70, "Good Fit").when(final >= 0.50, "Review Needed").otherwise("Low Fit"))
        .when(final >= 0.85, "High Fit")
        .when(final >= 0.70, "Good Fit")
        .when(final >= 0.50, "Review Needed")
        .otherwise("Low Fit")
    )


def decision_g1(sector: Column, profile: Column, product: Column, ai: Column, verdict: Column) -> Column:
    semantic, proof, v = 0.5 * profile + 0.5 * product, 0.45 * sector + 0.30 * profile + 0.25 * product, F.coalesce(verdict, F.lit(""))
    return (
        F.when(v == "No", "Low Fit")
        .when(v == "Yes", F.when((proof >= 0.42) | (ai >= 0.75), "High Fit").otherwise("Good Fit"))
        .when((proof >= 0.52) & (semantic >= 0.08), "High Fit")
        .when((proof >= 0.34) & (semantic >= 0.05), "Good Fit")
        .when(proof >= 0.22, "Review Needed")
        .otherwise("Low Fit")
    )


def semantic_band(score: Column) -> Column:
    return F.when(score >= 0.20, "Very Strong").when(score >= 0.12, "Strong").when(score >= 0.08, "Moderate").when(score >= 0.04, "Weak").otherwise("Very Weak")


def tier(score: Column) -> Column:
    out = None
    for cut, name in dims.TIERS[:-1]:
        out = F.when(score >= cut, name) if out is None else out.when(score >= cut, name)
    return out.otherwise(dims.TIERS[-1][1])


_TIER_NAMES = [n for _, n in dims.TIERS]


def tier_index(t: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, _TIER_NAMES)), t) - 1


def decide_g4(final: Column, gate: Column, human: Column, light: Column) -> Column:
    """The tier index is bounded: people outrank the gate, the gate outranks the score."""
    i, g, h = tier_index(tier(final)), F.coalesce(gate, F.lit("")), F.coalesce(human, F.lit(""))
    at = {n: F.lit(k) for k, n in enumerate(_TIER_NAMES)}
    index = (
        F.when(h == "Disagree", at["Poor Match"])
        .when(h == "Agree", F.least(i, at["Good Match"]))
        .when(g == "No", F.greatest(i, at["Weak Match"]))
        .when(g.isin("Partial", "Direct", "Yes") & light, F.greatest(i, at["Potential Match"]))
        .when(g == "Partial", F.greatest(i, at["Strong Match"]))
        .when(g.isin("Direct", "Yes"), i)
        .otherwise(F.greatest(i, at["Potential Match"]))
    )
    return F.element_at(F.array(*map(F.lit, _TIER_NAMES)), (index + 1).cast("int"))


def match_type(decision: Column, chain: Column, model: Column, role: Column) -> Column:
    model, role = F.coalesce(model, F.lit("")), F.coalesce(role, F.lit(""))
    return (
        F.when(decision.isin("Weak Match", "Poor Match"), "Not a target")
        .when((chain >= 0.95) & (decision == "Excellent Match"), "Anchor candidate")
        .when(role.isin(dims.SUPPLIER_ROLES) | model.isin("Supplier localization", "Distribution partnership"), "Supplier localization")
        .when((model == "Joint venture") | (role.isin(dims.BUILDER_ROLES) & (chain >= 0.50)) | (chain >= 0.70), "JV partner")
        .when(chain >= 0.30, "Supplier localization")
        .otherwise("Ecosystem player")
    )


def opportunity_status(rows: DataFrame, key: str) -> DataFrame:
    """(key, status) from (decision, match_type) rows."""
    vetted = F.col("decision").isin("Excellent Match", "Strong Match", "Good Match")
    g = rows.groupBy(key).agg(F.bool_or(vetted).alias("v"), F.bool_or(vetted & (F.col("match_type") == "Anchor candidate")).alias("a"))
    return g.select(key, F.when(~F.col("v"), "No viable target in current universe").when(F.col("a"), "Anchor candidate identified").otherwise("No anchor in universe - JV/supplier options only").alias("status"))


def confidence_g4(company_length: Column, class_confidence: Column, components: Column, votes: Column, sector: Column, penalized: Column, opportunity_length: Column | None = None) -> Column:
    """0 to 100 from completeness, class confidence, agreement of the components and of the votes."""
    full = F.least(F.lit(1.0), company_length / 600) * 0.5 + F.least(F.lit(1.0), (opportunity_length if opportunity_length is not None else F.lit(1500)) / 1500) * 0.5
    n = F.size(components)
    mean = F.aggregate(components, F.lit(0.0), lambda a, x: a + x) / n
    spread = F.sqrt(F.aggregate(F.transform(components, lambda x: (x - mean) * (x - mean)), F.lit(0.0), lambda a, x: a + x) / n)
    k, of = agreement(votes)
    vote = F.when(of.isNull() | k.isNull(), 0.5).when(of <= 1, 0.55).otherwise(k / of)
    score = 0.30 * full + 0.25 * class_confidence + 0.25 * (1.0 - F.least(F.lit(1.0), spread * 2.0)) + 0.20 * vote
    score = score - F.when(sector < 0.5, 0.15).otherwise(0.0) - F.when(penalized, 0.10).otherwise(0.0)
    return F.round(100 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))).cast("int")


def confidence_label(c: Column) -> Column:
    return F.when(c >= 70, "High").when(c >= 45, "Medium").otherwise("Low")


def report_role(verdict: Column) -> Column:
    return F.when(F.coalesce(verdict, F.lit("")).isin("Direct", "Yes"), "Can build it").otherwise("Supplier / partner")


def report_confidence(human: Column, votes: Column) -> Column:
    parts = F.split(F.coalesce(votes, F.lit("")), "/")
    return (
        F.when(F.coalesce(human, F.lit("")) == "Agree", "Confirmed by analyst")
        .when(F.size(parts) < 2, "Medium")
        .when(F.get(parts, F.lit(0)) == F.get(parts, F.lit(1)), "High (unanimous)")
        .otherwise(F.concat(F.lit("Medium ("), votes, F.lit(" votes)")))
    )


# --- second generation --------------------------------------------------------------------------


def triage(sector: Column, adjacent: Column, keywords: Column, inputs: Column, product: Column, profile: Column) -> dict[str, Column]:
    """The six signals, whether any fired, the first one, and the reason text."""
    t = dims.TRIAGE
    three = lambda c: F.format_string("%.3f", c)
    signals = {
        "sector_overlap": (sector, F.lit("sector_overlap")),
        "value_chain_adjacent": (adjacent, F.lit("value_chain_adjacent")),
        "capability_keywords": (keywords >= t["keywords"], F.format_string("capability_keywords:%d", keywords)),
        "input_overlap": (inputs >= t["inputs"], F.format_string("input_overlap:%d", inputs)),
        "signal_product_similarity": (product >= t["product"], F.concat(F.lit("signal_product_sim:"), three(product))),
        "signal_profile_similarity": (profile >= t["profile"], F.concat(F.lit("signal_profile_sim:"), three(profile))),
    }
    send = _any([s for s, _ in signals.values()])
    fail = F.concat(
        F.format_string("no_pass overlap=%d, adj=%d, capability_kw=%d, inputs=%d, ", sector.cast("int"), adjacent.cast("int"), keywords, inputs),
        F.lit("signal_product_sim="), three(product), F.lit(", signal_profile_sim="), three(profile),
    )
    passed = F.concat_ws(" + ", *[F.when(s, text) for s, text in signals.values()])
    first = F.coalesce(*[F.when(s, F.lit(n)) for n, (s, _) in signals.items()], F.lit("filtered"))
    return {"triage_pass": send, "pass_reason": first, "triage_reason": F.when(send, passed).otherwise(fail)} | {f"hit_{n}": s for n, (s, _) in signals.items()}


def match_path_g2(overlap: Column, combined: Column) -> Column:
    return F.when(overlap, "sector_overlap").when(combined >= dims.SOFT_MATCH_G2, "soft_match").otherwise("weak_overlap")


def match_value_band(v: Column) -> Column:
    bands = [(90, "Exceptional (90+)"), (75, "Strong (75-89)"), (60, "Moderate (60-74)"), (40, "Weak (40-59)"), (20, "Poor (20-39)")]
    out = None
    for cut, name in bands:
        out = F.when(v >= cut, name) if out is None else out.when(v >= cut, name)
    return out.otherwise("No fit (<20)")


# --- one step of each generation over scored pairs -------------------------------------------------


def qualification(terms: Column, label: Column, sector: Column, profile: Column, product: Column, bridged: Column) -> dict[str, Column]:
    """Whether a pair qualifies, is only a soft candidate, is really linked, or by a bridge only."""
    soft = label.isin("No", "Unknown") & (terms >= dims.MIN_EVIDENCE_TERMS) & (F.greatest(profile, product) >= dims.SOFT_MATCH_MIN)
    real = label.isin("Exact", "Strong", "Moderate")
    qualified = ~soft & (sector >= dims.MIN_SECTOR_SCORE) & (terms >= dims.MIN_EVIDENCE_TERMS)
    return {"qualified": qualified, "soft": soft, "real_link": real | bridged, "bridge_only": bridged & ~real}


def unseen_cap(decision: Column, qualified: Column, verdict: Column, optimistic: list[str]) -> Column:
    """A qualified pair that the gate never saw is no better than Review Needed."""
    return F.when(qualified & verdict.isNull() & decision.isin(optimistic), "Review Needed").otherwise(decision)


def g1_soft_sector(sector: Column, evident: Column, profile: Column, product: Column, none: Column) -> Column:
    """Without a sector link, domain evidence and some similarity make a weak one."""
    return F.when(none & evident & (F.greatest(profile, product) >= dims.SOFT_MIN_G1), F.greatest(sector, F.lit(0.35))).otherwise(sector)


def g1_fusion(profile: Column, product: Column, sector: Column, ai: Column) -> Column:
    w = dims.WEIGHTS_G1
    return w["profile"] * profile + w["product"] * product + w["sector"] * sector + w["ai"] * ai


def g1_proxy(profile: Column, product: Column, sector: Column) -> Column:
    """What stands for the model's score until the gate has run."""
    return 0.5 * sector + 0.25 * profile + 0.25 * product


def with_g1_gate(pairs: DataFrame, replied: Column, confidence: Column) -> DataFrame:
    """First-generation pairs after the gate: where a reply came, its confidence replaces the proxy in
    ai_score, and the final score is made anew from it."""
    ai = F.when(replied, confidence).otherwise(F.col("ai_score"))
    p = pairs.withColumn("ai_score", ai)
    return p.withColumn("final_score", half_up(g1_fusion(F.col("profile"), F.col("product"), F.col("sector"), F.col("ai_score"))))


def g0_fusion(profile: Column, product: Column, reply: Column) -> Column:
    return half_up(0.4 * profile + 0.4 * product + 0.2 * reply)


def g2_fusion(profile: Column, product: Column, decision: Column) -> Column:
    w = dims.WEIGHTS_G2
    yes = (F.lower(F.trim(F.coalesce(decision, F.lit("")))) == "yes").cast("int")
    return half_up(w["ai"] * yes + w["profile"] * profile + w["product"] * product)


def combined_similarity(sector: Column, profile: Column, product: Column, sparse: Column) -> Column:
    """The best of a pair's similarities, the sparse one included."""
    return F.greatest(sector, profile, product, sparse)


def combined_text(fields: list[Column]) -> Column:
    """All of an entity's fields as one cleaned text."""
    return preprocess(F.concat_ws(" ", *fields))


def literal_sector(a: Column, b: Column) -> Column:
    """1 if two labels are the same after cleaning, and not empty."""
    return F.when((preprocess(a) != "") & (preprocess(a) == preprocess(b)), 1).otherwise(0)


REJECTED = ["Weak Match", "Poor Match"]


def blanked(decision: Column) -> dict[str, Column]:
    """What a rejected pair shows of its engagement and its localization model."""
    out = decision.isin(REJECTED)
    return {"recommended_engagement": F.when(out, "").otherwise(F.col("recommended_engagement")), "suggested_localization_model": F.when(out, "Not recommended").otherwise(F.col("suggested_localization_model"))}
