"""Votes, verdict logs, analyst overrides, abstention, drift, calibration, consortium, regression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions.text import preprocess, quote_in_text, report_clean, safe_str
from pairforge.operators.containment import either_way
from pairforge.operators.ranking import latest, order_first_with_matches
from pairforge.operators.ranks import quantiles as exact_quantiles
from pairforge.operators.scoring import report_confidence, report_role
from pairforge.operators.similarity import position
from pairforge.sources.stages import stage

# --- the voted gate ------------------------------------------------------------------------------


def counted_votes(votes: DataFrame, pair: str, first: int = 3, more: int = 2) -> DataFrame:
    """The votes that count: the first ``first`` rounds, and ``more`` if those are not unanimous."""
    w = W.partitionBy(pair).orderBy("round")
    r = votes.withColumn("_k", F.row_number().over(w))
    head = F.when(F.col("_k") <= first, F.col("fit"))
    split = F.size(F.collect_set(head).over(W.partitionBy(pair))) > 1
    return r.withColumn("_split", split).filter((F.col("_k") <= first) | (F.col("_split") & (F.col("_k") <= first + more))).drop("_k", "_split")


def majority(votes: DataFrame, pair: str) -> DataFrame:
    """(pair, fit, confidence, agreement, explanation): ties go to the more cautious verdict."""
    order = F.array(*map(F.lit, dims.VERDICT_ORDER))
    by = votes.groupBy(pair, "fit").agg(F.count("*").alias("k"), F.avg("confidence").alias("mean"), F.max_by("explanation", F.struct("confidence", -F.col("round"))).alias("explanation"))
    best = F.max_by(F.struct("fit", "k", "mean", "explanation"), F.struct("k", -F.array_position(order, F.col("fit")))).alias("b")
    g = by.groupBy(pair).agg(F.sum("k").alias("n"), best)
    return g.select(pair, F.col("b.fit").alias("fit"), F.round(F.col("b.k") / F.col("n") * F.col("b.mean"), 2).alias("confidence"), F.concat_ws("/", "b.k", "n").alias("agreement"), F.col("b.explanation").alias("explanation"))


def vote_depth(rank: Column, top: int = 3, exported: Column | None = None) -> Column:
    """3 votes for the first ranks, 1 for other exported rows, else none."""
    return F.when(rank <= top, 3).when(exported if exported is not None else F.lit(True), 1).otherwise(0)


def unanimous_share(df: DataFrame, votes: str) -> DataFrame:
    p = F.split(F.col(votes), "/")
    return df.filter(F.contains(F.col(votes), F.lit("/"))).agg(F.round(F.coalesce(F.avg((F.get(p, F.lit(0)) == F.get(p, F.lit(1))).cast("int")), F.lit(0.0)), 3).alias("unanimous_share"))


def exemplars(log: DataFrame, targets: DataFrame, keys: list[str], order: str, text: Column, most: int = 8) -> DataFrame:
    """(keys, exemplars): for each pair of ``targets`` the last ``most`` precedent lines of other pairs,
    oldest first; of the same age in the order of their keys.  A pair's last line counts; its own is left out, so that it is judged on its own.

    Whatever the pair, its lines are among the last ``most`` + 1 of all: these few rows are broadcast."""
    lines = latest(log, keys, order).select(F.struct(*keys).alias("_p"), F.struct(F.col(order).alias("o"), *keys, text.alias("t")).alias("_l"))
    last = lines.orderBy(F.col("_l").desc()).limit(most + 1).agg(F.sort_array(F.collect_list(F.struct("_l", "_p"))).alias("_all"))
    out = targets.select(*keys).join(F.broadcast(last))  # one row
    others = F.filter("_all", lambda x: ~x["_p"].eqNullSafe(F.struct(*keys)))
    kept = F.slice(others, F.greatest(F.size(others) - most + 1, F.lit(1)), F.lit(most))
    return out.select(*keys, F.transform(kept, lambda x: x["_l"]["t"]).alias("exemplars"))


# --- overrides, drift, abstention ----------------------------------------------------------------


def human_overrides(df: DataFrame) -> DataFrame:
    """validated_fit and ai_decision after the analyst's ``human`` label (1, 0 or null), and ``changed``."""
    no = (F.col("human") == 0) & (F.col("validated_fit") | (F.col("ai_decision") != "Low Fit"))
    yes = (F.col("human") == 1) & ~F.col("validated_fit")
    gloomy = F.col("ai_decision").isin("", "Low Fit", "Review Needed")
    no, yes = F.coalesce(no, F.lit(False)), F.coalesce(yes, F.lit(False))
    return df.withColumns(
        {
            "changed": no | yes,
            "ai_decision": F.when(no, "Low Fit").when(yes & gloomy, "Partner Fit").otherwise(F.col("ai_decision")),
            "validated_fit": F.when(no, False).when(yes, True).otherwise(F.col("validated_fit")),
        }
    )


def verdict_flips(now: DataFrame, log: DataFrame, keys: list[str], order: str, rubric: Column) -> DataFrame:
    """Graded pairs of ``now`` (verdict, and agreement and human_verdict if there) whose last logged
    decision differs, with that decision and its time."""
    ts = F.col("ts") if "ts" in log.columns else F.lit("")
    last = latest(log, keys, order).select(*keys, F.col("decision").alias("previous_verdict"), F.coalesce(ts.cast("string"), F.lit("")).alias("previous_ts"), F.col("rubric").alias("_rubric"))
    d = now.filter(F.col("verdict").isin("Direct", "Partial", "Yes", "No")).join(last, keys).filter("verdict <> previous_verdict")
    changed = F.when(F.coalesce("_rubric", F.lit("")) != rubric, "yes").otherwise("no")
    extra = {c: F.coalesce(F.col(c), F.lit("")) if c in now.columns else F.lit("") for c in ("agreement", "human_verdict")}
    return d.withColumn("rubric_changed", changed).withColumns(extra).select(*keys, "previous_verdict", "previous_ts", "rubric_changed", F.col("verdict").alias("new_verdict"), "agreement", "human_verdict")


def abstentions(pairs: DataFrame, key: str, company: str, gate_ran: bool = True) -> DataFrame:
    """(key, status, best_candidate): groups without a qualified row, or graded without a validated one."""
    graded = F.coalesce(F.col("verdict").isin("Direct", "Partial", "Yes", "No"), F.lit(False))
    order = F.struct("final_score", -F.col(company))
    g = pairs.groupBy(key).agg(
        F.bool_or("qualified").alias("q"), F.bool_or(graded).alias("g"), F.bool_or("validated_fit").alias("v"),
        F.max_by(company, order).alias("all_best"), F.max_by(F.when(graded, F.col(company)), F.when(graded, order)).alias("graded_best"),
    )
    none, bad = ~F.col("q"), F.lit(gate_ran) & F.col("g") & ~F.col("v")
    return g.filter(none | bad).select(key, F.when(none, "No qualified candidate").otherwise("No validated fit (no Direct or Partial)").alias("status"), F.when(none, F.col("all_best")).otherwise(F.col("graded_best")).alias("best_candidate"))


# --- calibration ---------------------------------------------------------------------------------


def label_pool(log: DataFrame, reviews: DataFrame, keys: list[str], order: str, rubric: Column, current: DataFrame) -> DataFrame:
    """(keys, final_score, y, weight): the last logged verdict of each pair, overridden by reviews.  ``current``: the scores of the pairs there are.

    A review of a pair that was never logged counts with its score in ``current`` (keys, final_score); a
    pair that is in neither no longer exists and is left out."""
    last = latest(log, keys, order)
    y = F.col("decision").isin("Direct", "Partial", "Yes").cast("int")
    pool = last.select(*keys, F.col("final_score").alias("s"), y.alias("y"), F.when(F.coalesce("rubric", F.lit("")) == rubric, 1.0).otherwise(dims.OLD_RUBRIC_WEIGHT).alias("w"))
    h = reviews.select(*keys, F.col("label").alias("h"))
    both = pool.join(h, keys, "full")
    both = both.join(current.select(*keys, F.col("final_score").alias("c")), keys, "left").withColumn("s", F.coalesce("s", "c"))
    known = both.filter(F.col("s").isNotNull() | F.col("y").isNotNull())
    return known.select(*keys, F.col("s").alias("final_score"), F.coalesce("h", "y").alias("y"), F.when(F.col("h").isNotNull(), dims.HUMAN_LABEL_WEIGHT).otherwise(F.col("w")).alias("weight"))


#: Newton steps of the fit, and how far one step may move a number.
NEWTON_STEPS, LONGEST_STEP = 15, 4.0


def newton_step(points: DataFrame, a: float, b: float) -> tuple[float, float]:
    """One Newton step from intercept ``a`` and slope ``b`` of the weighted logistic loss with half the squared slope as penalty: gradient and
    Hessian are five sums over ``points`` (x, y, w)."""
    p = 1 / (1 + F.exp(-(a + b * F.col("x"))))
    d, h, x = F.col("w") * (p - F.col("y")), F.col("w") * p * (1 - p), F.col("x")
    g0, g1, h0, h1, h2 = points.agg(F.sum(d), F.sum(d * x), F.sum(h), F.sum(h * x), F.sum(h * x * x)).first()
    g1, h2 = g1 + b, h2 + 1
    det = max(h0 * h2 - h1 * h1, 1e-12)
    step = ((h2 * g0 - h1 * g1) / det, (h0 * g1 - h1 * g0) / det)
    return tuple(v - min(max(s, -LONGEST_STEP), LONGEST_STEP) for v, s in zip((a, b), step, strict=True))


def calibrate(pool: DataFrame, scored: DataFrame, score: str = "final_score", steps: int = NEWTON_STEPS) -> DataFrame:
    """``scored`` with match_probability from a regularised logistic fit by Newton steps; null if the pool is too small
    (30 pairs, 8 of each class).  Each step is one aggregation; equal scores of a class are added up before."""
    n, pos = pool.agg(F.count("*"), F.sum("y")).first()
    if n < 30 or pos < 8 or n - pos < 8:
        return scored.withColumn("match_probability", F.lit(None).cast("double"))
    points = stage(pool.filter(F.col("final_score").isNotNull() & F.col("y").isNotNull()).groupBy(F.col("final_score").alias("x"), "y").agg(F.sum("weight").alias("w")), "points")
    a = b = 0.0
    for _ in range(steps):
        a, b = newton_step(points, a, b)
    return scored.withColumn("match_probability", F.round(1 / (1 + F.exp(-(a + b * F.col(score)))), 3))


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """The area under the ROC curve by rank sums over score values (ties count half): one row.  The
    negatives below each value are counted in range partitions, then across them."""
    v = stage(df.groupBy(score).agg(F.sum(label).alias("p"), F.sum(1 - F.col(label)).alias("n")), "values")
    ranged = stage(v.repartitionByRange(F.col(score)).withColumn("_part", F.spark_partition_id()), "ranged")
    first = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = ranged.groupBy("_part").agg(F.sum("n").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(first), F.lit(0)).alias("_before"))  # a row for each partition
    inside = F.coalesce(F.sum("n").over(W.partitionBy("_part").orderBy(score).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("_inside", inside).join(F.broadcast(before), "_part")
    below = F.col("_before") + F.col("_inside") + F.col("n") / 2.0
    return placed.agg(F.round(F.sum(F.col("p") * below) / (F.sum("p") * F.sum("n")), 6).alias("auc"))


# --- consortium ----------------------------------------------------------------------------------


def verified_needs(needs: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Needs (key, capability, quote) whose quote really stands in the source text (key, text)."""
    return needs.filter(F.trim("capability") != "").join(texts, key).filter(quote_in_text(F.col("quote"), F.col("text"))).drop("text")


def consortium(needs: DataFrame, cover: DataFrame, key: str, least: int = 3) -> DataFrame:
    """(key, status, need, source_quote, covered_by, why, gap): thin rows for groups with under ``least``
    needs; else a row for each need with the first covering entry whose wording equals or contains it.

    ``needs``: (key, seq, capability, quote); ``cover``: (key, pos, need, companies: array of (name, why)).
    Of entries with the same wording the first gives the place and the last the companies.
    """
    sizes = needs.groupBy(key).agg(F.count("*").alias("n"))
    blank = [F.lit("").alias(c) for c in ("need", "source_quote", "covered_by", "why", "gap")]
    thin = sizes.filter(F.col("n") < least).select(key, F.lit("Thin data - ranked view applies").alias("status"), *blank)
    ready = needs.join(sizes.filter(F.col("n") >= least), key).withColumn("_nc", preprocess(F.col("capability")))
    c = cover.select(F.col(key).alias("_k"), "pos", preprocess(F.col("need")).alias("_c"), "companies").filter("_c <> ''")
    c = c.groupBy("_k", "_c").agg(F.min("pos").alias("pos"), F.max_by("companies", "pos").alias("companies"))
    # each different wording of a need is looked up once; one without a word is in every entry
    words = ready.select(F.col(key).alias("_k"), "_nc").distinct()
    met = either_way(words, "_nc", c, "_c", ["_k"]).join(c, ["_k", "_c"])
    met = met.select("_k", "_nc", "pos", "companies").union(words.filter("_nc = ''").join(c, "_k").select("_k", "_nc", "pos", "companies"))
    entry = met.groupBy(F.col("_k").alias(key), "_nc").agg(F.min_by("companies", "pos").alias("companies"))
    first = ready.join(entry, [key, "_nc"], "left")
    names = F.array_join(F.transform("companies", lambda x: x["name"]), ", ")
    whys = F.array_join(F.transform("companies", lambda x: F.concat(x["name"], F.lit(": "), F.coalesce(x["why"], F.lit("")))), " | ")
    gap = F.when(F.coalesce(F.size("companies"), F.lit(0)) < 1, "GAP").otherwise("")
    rows = first.select(key, F.lit("Ready").alias("status"), F.col("capability").alias("need"), F.coalesce("quote", F.lit("")).alias("source_quote"), F.coalesce(names, F.lit("")).alias("covered_by"), F.coalesce(whys, F.lit("")).alias("why"), gap.alias("gap"))
    return rows.union(thin)


# --- regression report ---------------------------------------------------------------------------


def dropped(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that were Yes in ``base`` and are not in ``new``."""
    yes = F.col("ai_decision") == "Yes"
    return base.filter(yes).select(*keys).distinct().join(new.filter(yes).select(*keys).distinct(), keys, "left_anti")


def retained(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """baseline_yes, new_yes, still_yes and the retained share in percent: one row."""
    yes = F.col("ai_decision") == "Yes"
    b, n = base.filter(yes).select(*keys).distinct().withColumn("b", F.lit(1)), new.filter(yes).select(*keys).distinct().withColumn("n", F.lit(1))
    t = b.join(n, keys, "full").agg(F.count("b").alias("baseline_yes"), F.count("n").alias("new_yes"), F.count(F.when(F.col("b").isNotNull() & F.col("n").isNotNull(), 1)).alias("still_yes"))
    return t.withColumn("retained_pct", F.round(100.0 * F.try_divide(F.col("still_yes"), F.col("baseline_yes")), 3))


def regression_summary(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Dropped pairs by their reason in ``new``: count and mean score; a missing reason is a group."""
    detail = dropped(base, new, keys).join(new, keys, "left")
    return detail.groupBy("triage_reason").agg(F.count("*").alias("n"), F.avg("final_score").alias("mean_final_score"))


# --- plain reports -------------------------------------------------------------------------------


def report_sheets(pairs: DataFrame, abstained: DataFrame, needs: DataFrame) -> dict[str, DataFrame]:
    """The three sheets of the plain report, in the words of a reader who knows no tiers.

    ``pairs``: (opportunity, company, verdict, gate_explanation, human, votes, final_score, validated_fit);
    ``abstained``: (opportunity, best_candidate, detail); ``needs``: (opportunity, need, covered_by, why).
    """
    matches = pairs.filter("validated_fit").select(
        report_clean(F.col("opportunity")).alias("Opportunity"), report_clean(F.col("company")).alias("Matched company"), report_role(F.col("verdict")).alias("Role"),
        report_clean(F.col("gate_explanation")).alias("Why it matches"), report_confidence(F.col("human"), F.col("votes")).alias("Confidence"), report_clean(F.col("human")).alias("Your verdict"),
    )
    none = abstained.filter("opportunity <> '-'").select(
        report_clean(F.col("opportunity")).alias("Opportunity"), F.lit("No suitable company in the current list").alias("Finding"),
        report_clean(F.col("best_candidate")).alias("Closest candidate (not a fit)"), report_clean(F.col("detail")).alias("Detail"),
    )
    covered = report_clean(F.col("covered_by"))
    gaps = needs.filter(F.length("need") > 0).select(
        report_clean(F.col("opportunity")).alias("Opportunity"), report_clean(F.col("need")).alias("What it needs"),
        F.when(covered == "", "NOBODY YET (gap)").otherwise(covered).alias("Covered by"), report_clean(F.col("why")).alias("Notes"),
    )
    return {"Matches": matches, "No match": none, "Needs and gaps": gaps}


def _counted(df: DataFrame, label: str) -> DataFrame:
    """One line: how many rows, and of which sectors, the most frequent first."""
    by = df.groupBy("sector").agg(F.count("*").alias("n"))
    parts = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "sector", "n")))
    return by.agg(F.concat(F.lit(f"{label}: "), F.sum("n").cast("string"), F.lit(" ("), F.array_join(F.transform(parts, lambda x: F.concat(x["sector"], F.lit(" "), x["n"].cast("string"))), ", "), F.lit(")")).alias("line"))


def summary_lines(pairs: DataFrame, companies: DataFrame, opportunities: DataFrame) -> DataFrame:
    """(part, k, line): the lines of the run's summary; part and k give their order.

    ``pairs``: exported rows with oid, opportunity_name, company_name, decision, match_type, final_score,
    confidence_score and status; the two others have (name, sector).
    """
    spark = pairs.sparkSession
    status = pairs.select("opportunity_name", "status").distinct()
    n = opportunities.agg(F.count("*").alias("n"))
    found = status.agg(F.count_if(F.col("status") == "Anchor candidate identified").alias("a"), F.count_if(F.col("status") == "No viable target in current universe").alias("z")).join(F.broadcast(n))  # one row each
    anchors = found.select(F.format_string("Anchor candidates identified: %d of %d opportunities; without a viable target: %d", "a", "n", "z").alias("line"))
    one = lambda part, df: df.select(F.lit(part).alias("part"), F.lit(0).alias("k"), "line")
    text = lambda part, line: one(part, spark.range(1).select(F.lit(line).alias("line")))
    listed = lambda part, df, order: position(df, order, "k").select(F.lit(part).alias("part"), F.col("k").cast("int").alias("k"), "line")
    states = status.withColumn("line", F.format_string("- %s: %s", "opportunity_name", "status"))
    vetted = pairs.filter(F.col("decision").isin("Excellent Match", "Strong Match", "Good Match"))
    score, sure = F.col("final_score").cast("string"), F.col("confidence_score").cast("string")
    pursue = vetted.withColumn("line", F.concat(F.format_string("- %s -> %s: %s, %s, score ", "company_name", "opportunity_name", "decision", "match_type"), score, F.lit(", confidence "), sure))
    parts = [
        text(0, "# Matching run: dataset verdict"), one(1, _counted(companies, "Companies")), one(2, _counted(opportunities, "Opportunities")), one(3, anchors),
        text(4, "## Per-opportunity status"), listed(5, states, [F.col("opportunity_name")]), text(6, "## Pursue list"), listed(7, pursue, [F.col("final_score").desc(), F.col("company_name"), F.col("opportunity_name")]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def write_summary(lines: DataFrame, path: str) -> None:
    """The summary as one Markdown file: a line for each row, so one task writes it."""
    lines.orderBy("part", "k").select("line").coalesce(1).write.mode("overwrite").text(path)


def page_payload(pairs: DataFrame, consortium_rows: DataFrame) -> DataFrame:
    """(opportunity, n, place, payload): what the review page shows for each opportunity, as JSON: its
    matches by score and its consortium; opportunities with matches come first.

    ``pairs``: opportunity, opportunity_sector, company, company_sector, verdict, gate_explanation, final_score,
    validated_fit; ``consortium_rows``: opportunity, status, need, source_quote, covered_by, gap.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    kind = F.when(F.col("verdict").isin("Direct", "Yes"), "Can build it").otherwise("Good supplier / partner")
    card = F.struct(text("company").alias("name"), text("company_sector").alias("sector"), kind.alias("kind"), text("gate_explanation").alias("why"))
    matched = F.when(F.col("validated_fit"), F.struct((-F.col("final_score")).alias("o"), "company", card.alias("card")))
    cards = F.transform(F.sort_array(F.collect_list(matched)), lambda x: x["card"])
    g = pairs.groupBy("opportunity").agg(F.min(text("opportunity_sector")).alias("sector"), cards.alias("companies"))
    item = F.struct(text("need").alias("need"), text("source_quote").alias("quote"), text("covered_by").alias("covered_by"), (F.col("gap") == "GAP").alias("gap"))
    items = F.sort_array(F.collect_list(F.when(F.col("status") == "Ready", item)))
    c = consortium_rows.groupBy("opportunity").agg(F.struct(F.min("status").alias("status"), items.alias("items")).alias("consortium"))
    rows = g.join(c, "opportunity", "left").withColumn("n", F.size("companies").cast("long"))
    shown = F.to_json(F.struct(F.col("opportunity").alias("name"), "sector", "companies", "consortium"), {"ignoreNullFields": "false"})
    return position(rows, order_first_with_matches("n", "opportunity"), "place").select("opportunity", "n", "place", shown.alias("payload"))


def diagnostics(pairs: DataFrame, companies: int, abstained: DataFrame, consortium_rows: DataFrame, key: str, fixed: dict[str, Column]) -> DataFrame:
    """The run's figures in one row.  ``pairs``: cid, oid, qualified, verdict, rank_for_opportunity,
    raw_profile_cosine, agreement, changed (by an analyst); ``fixed``: what other steps report (mode, rows
    merged, labels, rubric, flips, AUC and the like)."""
    direct, partial = F.col("verdict").isin("Direct", "Yes"), F.col("verdict") == "Partial"
    per = pairs.filter("rank_for_opportunity <= 3").groupBy("cid").agg(F.count("*").alias("n")).agg(F.round(F.max("n") / F.sum("n"), 3).alias("top3_company_concentration"))
    one = pairs.agg(
        F.count("*").alias("pairs_total"), F.count_if("qualified").alias("pairs_qualified"), F.count_distinct(F.when(F.col("qualified"), F.col("cid"))).alias("companies_with_qualified_match"),
        F.count_distinct(F.when(direct, F.col("oid"))).alias("opportunities_with_direct_fit"), F.count_distinct(F.when(partial, F.col("oid"))).alias("opportunities_with_partner_fit"),
        F.count_if(direct).alias("pairs_direct_fit"), F.count_if(partial).alias("pairs_partner_fit"), F.round(F.lit(exact_quantiles(pairs, "raw_profile_cosine", [0.5])[0]).cast("double"), 4).alias("median_raw_profile_cosine"),
        F.count_if("changed").alias("human_overrides_applied"),
    )
    share = unanimous_share(pairs, "agreement").withColumnRenamed("unanimous_share", "gate_unanimous_share")
    gone = abstained.agg(F.count("*").alias("opportunities_abstained"))
    ready = consortium_rows.filter("status = 'Ready'").agg(F.count_distinct(key).alias("consortium_ready_opportunities"))
    out = one
    for other in (per, share, gone, ready):  # one row each
        out = out.join(F.broadcast(other))
    return out.withColumns({"companies_total": F.lit(companies), **fixed})


def sector_report(companies: DataFrame, cache: DataFrame, optional: list[str], order: str, most: int = 15) -> DataFrame:
    """What a dry run says of the sectors, in one row: filled and blank labels, the closed vocabulary, cache
    entries (key), filled rows of each optional column (0 where there is none), and the first names whose
    sector is blank."""
    blank = safe_str(F.col("sector")) == ""
    label = F.when(~blank, safe_str(F.col("sector")))
    have = {c: F.count_if(safe_str(F.col(c)) != "") if c in companies.columns else F.lit(0).cast("long") for c in optional}
    one = companies.agg(F.count("*").alias("rows_total"), F.count_if(~blank).alias("sector_filled"), F.count_if(blank).alias("sector_blank"), F.count_distinct(label).alias("vocabulary"), *[v.alias(f"filled_{c}") for c, v in have.items()])
    entries = cache.agg(F.count_distinct("key").alias("cache_entries"))
    first = companies.filter(blank).orderBy(order).limit(most).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.substring(safe_str(F.col("company_name")), 1, 120).alias("n")))).alias("l"))
    names = first.select(F.array_join(F.transform("l", lambda x: x["n"]), "|").alias("first_blank"))
    return one.join(F.broadcast(entries)).join(F.broadcast(names))  # one row each


def run_timestamp() -> Column:
    """Now, in UTC, as ISO text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
