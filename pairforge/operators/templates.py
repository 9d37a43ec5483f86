"""Explanations made from fixed sentences; sentences that must match are fixed values of :mod:`pairforge.dims`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions.arrays import rotating
from pairforge.operators.scoring import semantic_band


def _listed(terms: Column, most: int | None = None) -> Column:
    return F.array_join(F.slice(terms, 1, most) if most else terms, ", ")


def _some(terms: Column) -> Column:
    return F.coalesce(F.size(terms), F.lit(0)) > 0


def overlap_reason(terms: Column, fallback: Column) -> Column:
    """The shared keywords, or a fallback text."""
    return F.when(_some(terms), F.concat(F.lit("Shared keywords: "), _listed(terms), F.lit("."))).otherwise(fallback)


def semantic_meaning(profile_terms: Column, product_terms: Column, profile: Column, product: Column) -> Column:
    """How close two texts are in words: the band of the mean, both similarities, and common concepts."""
    def common(kind: str, terms: Column) -> Column:
        return F.when(_some(terms), F.concat(F.lit(f" {kind} concepts in common: "), _listed(terms), F.lit("."))).otherwise(f" {kind} concepts overlap is limited.")

    head = F.concat(F.lit("Semantic alignment is "), semantic_band((profile + product) / 2.0), F.format_string(" (profile=%.3f, product=%.3f).", profile, product))
    return F.concat(head, common("Profile", profile_terms), common("Product/service", product_terms))


def explanation(company: Column, opportunity: Column, decision: Column, sector: Column, meaning: Column, profile: Column, product: Column, validation: Column, reply: Column) -> Column:
    text = F.format_string("Decision: %s for %s on '%s'. Why: %s %s Profile evidence: %s Product evidence: %s Validation: %s.", decision, company, opportunity, sector, meaning, profile, product, validation)
    said = F.coalesce(reply, F.lit(""))
    return F.when(said == "", text).otherwise(F.concat(text, F.lit(" LLM confirmation: "), said))


def insight(company: Column, opportunity: Column, decision: Column, sector: Column) -> Column:
    return F.format_string("%s is classified as '%s' for '%s'. Primary fit signal: %s", company, decision, opportunity, sector)


def suggested_plan(company: Column, decision: Column, profile_terms: Column, product_terms: Column, most: int = 4) -> Column:
    """The next step that a decision asks for, anchored in the strongest terms."""
    steps = F.create_map(*[F.lit(x) for kv in dims.NEXT_STEPS.items() for x in kv])
    step = F.coalesce(F.try_element_at(steps, decision), F.lit(dims.NEXT_STEP_OTHERWISE))
    focus = lambda terms, blank: F.when(_some(terms), _listed(terms, most)).otherwise(blank)
    return F.format_string(
        "%s. Position %s using profile strengths in %s. Anchor solution design around %s. Confirm compliance, timeline, and execution model before final commitment.",
        step, company, focus(profile_terms, "core profile strengths"), focus(product_terms, "delivery-relevant products/services"),
    )


def match_reason(decision: Column, sector: Column, profile: Column, product: Column) -> Column:
    return F.format_string("%s. Sector: %s Profile: %s Product: %s", decision, sector, profile, product)


def assigned_frames(index: Column) -> dict[str, Column]:
    """The engagement verb and the leading risk lens of a row, dealt in turn by its index."""
    return {"engagement_verb": rotating(dims.ENGAGEMENT_VERBS, index), "risk_lens": rotating(dims.RISK_LENSES, index)}
