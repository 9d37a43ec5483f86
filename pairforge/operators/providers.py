"""What follows a model's reply: every model-made input is a table, and these functions make it usable.

A provider table holds one reply for each key; missing and broken replies fall back to fixed defaults,
so that a run never depends on a call that failed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions.arrays import exactly_three, strip_fence, to_list
from pairforge.functions.text import first_email, labelled, normalize_localization, normalize_terminology, parse_fit, safe_str, sector_label
from pairforge.sources.stages import broadcast_if_small

_TEXTS = "array<string>"


def reply_json(reply: Column, schema: str) -> Column:
    """The reply's JSON as a struct; null if it can't be read."""
    return F.from_json(strip_fence(reply), schema)


def ontology_entries(sectors: DataFrame, replies: DataFrame) -> DataFrame:
    """(sector, canonical, synonyms, sub_domains, adjacent_domains) for every sector: an unanswered one
    stands for itself."""
    out = sectors.select("sector").distinct().join(replies, "sector", "left")
    named = F.when(safe_str(F.col("canonical")) != "", safe_str(F.col("canonical"))).otherwise(F.col("sector"))
    return out.select("sector", named.alias("canonical"), *[to_list(F.col(c)).alias(c) for c in ("synonyms", "sub_domains", "adjacent_domains")])


def entity_text(*lists: Column) -> Column:
    """Extracted products, services, materials or capabilities as one text; ``n/a`` if there are none."""
    text = F.array_join(F.flatten(F.array(*[to_list(c) for c in lists])), " ")
    return F.when(text == "", "n/a").otherwise(text)


def brief_text(fields: dict[str, Column]) -> Column:
    """A fact card as labelled lines; list fields are joined, empty ones left out."""
    return labelled([(k, F.array_join(to_list(v), ", ")) for k, v in fields.items()])


def brief_card(summary: Column, lists: dict[str, Column], history: Column, chain_position: Column, inferred: Column) -> Column:
    """A canonical brief as labelled lines: its summary, its lists, and what else it states; a line says
    so if it states nothing."""
    stated = lambda c, blank: F.when((safe_str(c) != "") & (F.lower(safe_str(c)) != blank), safe_str(c))
    joined = [(k, F.array_join(to_list(v), "; ")) for k, v in lists.items()]
    lines = [("Summary", safe_str(summary)), *joined, ("Founded/history", stated(history, "not stated in source")), ("Value-chain position", stated(chain_position, "other")), ("Inferred (not directly stated)", F.array_join(to_list(inferred), "; "))]
    text = labelled(lines)
    return F.when(text == "", "No canonical brief available.").otherwise(text)


def first_readable(replies: list[Column], schema: str) -> Column:
    """The JSON of the first reply that holds any; null if none does."""
    first = schema.split()[0]
    parsed = [reply_json(r, schema) for r in replies]
    return F.coalesce(*[F.when(j[first].isNotNull(), j) for j in parsed])


#: Long fields of a lookup record are cut here.
BUNDLE_CHARS = 2400
_BUNDLE = "company_name company_profile product_services industry_field business_unit_field hq_field country_field website_field".split()


def row_bundle(fields: dict[str, Column], most: int = BUNDLE_CHARS) -> Column:
    """The lookup record of a company; absent fields are empty."""
    value = lambda n: F.substring(safe_str(fields[n]), 1, most) if n in ("company_profile", "product_services") else safe_str(fields[n])
    return F.struct(*[(value(n) if n in fields else F.lit("")).alias(n) for n in _BUNDLE])


def structured_brief(opportunities: DataFrame, reply: str) -> DataFrame:
    """The five lists of a structured brief from a JSON reply; unreadable replies give empty lists."""
    names = ["required_capabilities", "required_inputs", "adjacent_value_chain_sectors", "precedent_industries", "capability_keywords"]
    j = reply_json(F.col(reply), ", ".join(f"{n} {_TEXTS}" for n in names))
    return opportunities.withColumn("_j", j).withColumns({n: to_list(F.col("_j")[n]) for n in names}).drop("_j")


#: Columns that older checkpoints lack, with their type and default.
DEFAULTS = {
    "sector_was_inferred": ("boolean", False), "sector_inference_source": ("string", "none"), "sector_inference_evidence": ("string", ""),
    "signal_sector_overlap": ("int", 0), "signal_value_chain_adjacent": ("boolean", False), "signal_capability_keyword_count": ("int", 0), "signal_input_overlap_count": ("int", 0),
    "signal_product_similarity": ("double", 0.0), "signal_profile_similarity": ("double", 0.0), "triage_pass": ("boolean", False), "triage_reason": ("string", ""),
}


def with_defaults(df: DataFrame) -> DataFrame:
    """Every column of DEFAULTS in its type: missing columns, nulls and unreadable values get the default."""
    out = {}
    for name, (kind, default) in DEFAULTS.items():
        have = F.col(name) if name in df.columns else F.lit(None)
        value = F.trim(have.cast("string")) if kind == "string" else F.trim(have.cast("string")).try_cast(kind)
        out[name] = F.coalesce(value, F.lit(default).cast(kind))
    return df.withColumns(out)


def filled_in(pairs: DataFrame, source: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """Text columns that ``pairs`` lacks, from their source by key; what isn't found is empty."""
    wanted = [c for c in texts if c not in pairs.columns]
    out = pairs.join(source.select(key, *[c for c in wanted if c in source.columns]), key, "left") if wanted else pairs
    return out.withColumns({c: safe_str(F.col(c)) if c in out.columns else F.lit("") for c in texts})


def decision(reply: Column) -> Column:
    """Yes or No; anything else is No."""
    return F.when(F.lower(safe_str(reply)) == "yes", "Yes").otherwise("No")


def scored_decision(df: DataFrame) -> DataFrame:
    """Coerced ai_decision, match_value (0 to 100), match_confidence, and three plan and reason texts."""
    conf = F.initcap(safe_str(F.col("match_confidence")))
    return df.withColumns(
        {
            "ai_decision": decision(F.col("ai_decision")),
            "match_value": F.least(F.greatest(F.coalesce(F.col("match_value").cast("string").try_cast("int"), F.lit(0)), F.lit(0)), F.lit(100)),
            "match_confidence": F.when(conf.isin("Low", "Medium", "High"), conf).otherwise("Low"),
            "suggested_plan": exactly_three(F.col("suggested_plan")),
            "match_reason": exactly_three(F.col("match_reason")),
        }
    )


def batched_decisions(pairs: DataFrame, replies: DataFrame, keys: list[str]) -> DataFrame:
    """Every pair that was sent with its decision; a pair the reply left out is No."""
    r = replies.select(*keys, decision(F.col("ai_decision")).alias("_d"))
    return pairs.join(r, keys, "left").withColumn("ai_decision", F.coalesce("_d", F.lit("No"))).drop("_d")


def filtered_stamp(df: DataFrame, send: str = "triage_pass") -> DataFrame:
    """Pairs that were not sent: Filtered, score 0, no plan, and three texts that say why."""
    none = F.array().cast(_TEXTS)
    sent = F.coalesce(F.col(send), F.lit(False))
    out = df.withColumn("ai_decision", F.when(sent, F.col("ai_decision")).otherwise("Filtered")).withColumn("ai_score", F.when(F.col("ai_decision") == "Yes", 1).otherwise(0))
    plan = F.col("suggested_plan") if "suggested_plan" in df.columns else none
    reason = F.col("match_reason") if "match_reason" in df.columns else none
    return out.withColumns({"suggested_plan": F.when(sent, plan).otherwise(none), "match_reason": F.when(sent, reason).otherwise(F.array(*map(F.lit, dims.FILTERED_REASONS)))})


def single_reply_g1(reply: Column) -> tuple[Column, Column]:
    """(decision, confidence) of the first generation: JSON, else a reply that begins with yes; no reply
    is Not Run."""
    j = reply_json(reply, "decision string, confidence double")
    readable = j["decision"].isNotNull()
    yes = F.lower(safe_str(reply)).startswith("yes")
    said = F.when(reply.isNull(), "Not Run").when(readable, decision(j["decision"])).otherwise(F.when(yes, "Yes").otherwise("No"))
    conf = F.when(reply.isNull(), 0.0).when(readable, F.coalesce(j["confidence"], F.lit(0.0))).otherwise(F.when(yes, 0.8).otherwise(0.2))
    return said, F.least(F.greatest(conf, F.lit(0.0)), F.lit(1.0))


def single_reply_g0(reply: Column) -> tuple[Column, Column]:
    """(decision, score) of the legacy script."""
    yes = F.lower(F.trim(reply)).startswith("yes")
    return F.when(reply.isNull(), "Error").when(yes, "Yes").otherwise("No"), F.when(reply.isNull(), 0.0).when(yes, 0.95).otherwise(0.3)


def graded_reply(reply: Column) -> Column:
    """(fit, confidence, explanation) of a graded vote; null if the reply can't be read."""
    j = reply_json(reply, "fit string, confidence double, explanation string")
    return F.when(j["fit"].isNotNull(), F.struct(parse_fit(j["fit"]).alias("fit"), F.least(F.greatest(F.coalesce(j["confidence"], F.lit(0.0)), F.lit(0.0)), F.lit(1.0)).alias("confidence"), safe_str(j["explanation"]).alias("explanation")))


def company_enrichment(companies: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    """normalized_sector, role, second role, confidence and readiness; without a reply the sector comes from
    the synonyms, the role is blank, the confidence .2 and the readiness empty."""
    r = replies.select(key, "normalized_sector", "value_chain_role", "secondary_role", "classification_confidence", "readiness")
    role = lambda c: F.when(F.col(c).isin(dims.ROLES), F.col(c)).otherwise("")
    node = F.when(sector_label(F.col("normalized_sector")) != "", sector_label(F.col("normalized_sector"))).otherwise(sector_label(F.col("sector")))
    return companies.join(r, key, "left").withColumns(
        {
            "normalized_sector": node, "value_chain_role": role("value_chain_role"), "secondary_role": role("secondary_role"),
            "classification_confidence": F.coalesce("classification_confidence", F.lit(0.2)),
            "readiness": F.coalesce("readiness", F.create_map().cast("map<string,double>")),
        }
    )


def opportunity_enrichment(opportunities: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    """normalized_sector and up to three required roles; without a reply a contract manufacturer is needed."""
    r = replies.select(key, "normalized_sector", "required_roles")
    roles = F.slice(F.filter(to_list(F.col("required_roles")), lambda x: x.isin(dims.ROLES)), 1, 3)
    node = F.when(sector_label(F.col("normalized_sector")) != "", sector_label(F.col("normalized_sector"))).otherwise(sector_label(F.col("sector")))
    return opportunities.join(r, key, "left").withColumns({"normalized_sector": node, "required_roles": F.when(F.size(roles) > 0, roles).otherwise(F.array(F.lit("Contract Manufacturer")))})


def narrative(df: DataFrame, decision_column: str) -> DataFrame:
    """Official names in every text field, the model on the menu, up to three reasons."""
    texts = ["strengths", "risks", "recommended_engagement", "profile_match_reason", "product_match_reason", "executive_summary"]
    out = df.withColumns({c: normalize_terminology(F.trim(c)) for c in texts if c in df.columns})
    reasons = F.transform(F.slice(to_list(F.col("match_reason")), 1, 3), normalize_terminology)
    return out.withColumns({"match_reason": reasons, "suggested_localization_model": normalize_localization(F.col("suggested_localization_model"), F.col(decision_column))})


def export_fit(reply: Column) -> Column:
    """Direct, Partial or None; an error mark stays, so that a failure is not a silent No."""
    v = safe_str(reply)
    return F.when(F.lower(v).startswith("error"), v).when(F.lower(v).isin("direct", "partial"), F.initcap(v)).otherwise("None")


def closed_pick(reply: Column, allowed: list[str]) -> Column:
    """A sector of the closed vocabulary, else UNKNOWN."""
    return F.when(safe_str(reply).isin(allowed), safe_str(reply)).otherwise("UNKNOWN")


def closed_picks(df: DataFrame, reply: str, allowed: DataFrame, name: str) -> DataFrame:
    """``df`` with :func:`closed_pick` as ``name`` against a table of labels (label) of any size."""
    labels = broadcast_if_small(allowed.select(F.col("label").alias("_label")).distinct())
    out = df.withColumn("_reply", safe_str(F.col(reply))).join(labels, F.col("_reply") == F.col("_label"), "left")
    return out.withColumn(name, F.coalesce("_label", F.lit("UNKNOWN"))).drop("_label", "_reply")


def sector_inference(companies: DataFrame, cache: DataFrame, allowed: list[str]) -> DataFrame:
    """Blank sectors filled from the cache (key, sector, source); ``inferred`` marks them."""
    key = F.concat(F.lit("id:"), F.col("company_id").cast("string"), F.lit(":"), F.lower(F.regexp_replace(F.trim("company_name"), r"\s+", " ")))
    c = cache.select(F.col("key").alias("_k"), closed_pick(F.col("sector"), allowed).alias("_s"), F.col("source").alias("_src"))
    blank = safe_str(F.col("sector")) == ""
    got = companies.withColumn("_key", key).join(c, F.col("_key") == F.col("_k"), "left")
    use = blank & (F.coalesce("_s", F.lit("UNKNOWN")) != "UNKNOWN")
    return got.withColumns({"effective_sector": F.when(use, F.col("_s")).otherwise(safe_str(F.col("sector"))), "inferred": use, "source": F.when(use, F.col("_src")).otherwise("none")}).drop("_key", "_k", "_s", "_src")


def all_answered(items: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    """Items without a reply: a run that needs all of them stops if this isn't empty."""
    return items.join(replies, key, "left_anti")


def email_reply(reply: Column) -> Column:
    """The e-mail of a JSON reply, else the first one in its text."""
    j = first_email(reply_json(reply, "email string")["email"])
    return F.when(j != "", j).otherwise(first_email(reply))


def gate_prompt(company: dict[str, Column], opportunity: dict[str, Column], most: int = 1800) -> Column:
    """The text a gate is asked with; only its inputs matter for caching and the rubric version."""
    cut = lambda d: labelled([(k, F.substring(safe_str(v), 1, most)) for k, v in d.items()])
    return F.concat(F.lit("COMPANY\n"), cut(company), F.lit("\n\nOPPORTUNITY\n"), cut(opportunity))


def need_cover(cover: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Cover entries (key, pos, need, companies) with only those companies that are validated for the key."""
    a = allowed.groupBy(key).agg(F.collect_set("name").alias("_ok"))
    return cover.join(a, key, "left").withColumn("companies", F.filter("companies", lambda c: F.array_contains(F.coalesce("_ok", F.array().cast(_TEXTS)), c["name"]))).drop("_ok")


class Backends(NamedTuple):
    """Which provider answers chat prompts and which embeds texts; none: offline."""

    chat: str | None = None
    chat_models: tuple[str, ...] = ()
    embed: str | None = None
    embed_model: str | None = None


def resolve_backends(settings: dict[str, str], public_chat: tuple[str, ...] = (), public_embed: str | None = None) -> Backends:
    """Chat and embeddings are resolved apart, since a hosted account may offer only one of them.

    ``settings``: offline, hosted (a truth word), hosted_endpoint, hosted_key, hosted_chat, hosted_embed
    (deployment names), public_key, chat_provider (auto, hosted or public).  What the hosted account doesn't
    offer the public one does, but for chat if the provider is fixed as hosted.
    """
    get = lambda k: (settings.get(k) or "").strip()
    true = lambda k: get(k).lower() in ("1", "true", "yes", "on")
    if true("offline"):
        return Backends()
    provider = get("chat_provider") or "auto"
    out = Backends()
    if true("hosted") and get("hosted_endpoint").rstrip("/") and get("hosted_key"):
        if get("hosted_chat") and provider != "public":
            out = out._replace(chat="hosted", chat_models=(get("hosted_chat"),))
        if get("hosted_embed"):
            out = out._replace(embed="hosted", embed_model=get("hosted_embed"))
    if get("public_key"):
        if not out.chat and provider != "hosted":
            out = out._replace(chat="public", chat_models=tuple(public_chat))
        if not out.embed:
            out = out._replace(embed="public", embed_model=public_embed)
    return out
