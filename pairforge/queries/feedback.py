"""Votes, verdict logs, overrides, drift, abstention, calibration, diagnostics and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairforge.operators import feedback as B
from pairforge.operators import ranking as R
from pairforge.operators.ranks import quantiles as exact_quantiles
from pairforge.queries.base import PAIRS_SQL, pairs, pick, sql_pick, t
from pairforge.sources.readers import human_label, human_reviews

S = SparkSession
DEC = ["Direct", "Partial", "No", "Not Run"]
LABELS5 = ["High Fit", "Low Fit", "Review Needed", "", "Partner Fit"]
REVIEWS = ["agree", "Not a fit", "maybe", "YES", "0", " true ", "disagree"]


def _votes(s: S, d: str) -> DataFrame:
    """Conversations as votes: a turn is a round, the role decides the verdict."""
    fit = F.when(F.col("role") == "user", "Direct").when(F.col("role") == "assistant", "Partial").otherwise("No")
    return t(s, d, "conversations").select(F.col("conv_id").alias("pair"), F.col("turn").alias("round"), fit.alias("fit"), ((F.length("text") % 100) / 100.0).alias("confidence"), F.md5(F.col("text").cast("binary")).alias("explanation"))


def majority_vote(s: S, d: str) -> DataFrame:
    return B.majority(B.counted_votes(_votes(s, d), "pair"), "pair")


def unanimous_share(s: S, d: str) -> DataFrame:
    return B.unanimous_share(majority_vote(s, d), "agreement")


def vote_depth(s: S, d: str) -> DataFrame:
    p = R.ranked(pairs(s, d), "oid", [F.col("profile").desc(), "cid"], "rank")
    return p.select("cid", "oid", B.vote_depth(F.col("rank"), exported=F.col("rank") <= 20).alias("votes"))


def _log(s: S, d: str) -> DataFrame:
    """Events as a verdict log: the pair is user and type, the order time then id."""
    k = F.floor("value").cast("long")
    return t(s, d, "events").select("user_id", "event_type", F.struct("ts", "event_id").alias("o"), "event_id", "ts", pick(DEC, k).alias("decision"), pick(["r1", "r2"], F.col("event_id")).alias("rubric"), (F.pmod(k, F.lit(100)) / 100.0).alias("final_score"))


def latest_verdict(s: S, d: str) -> DataFrame:
    return R.latest(_log(s, d), ["user_id", "event_type"], "o").select("user_id", "event_type", "event_id", "decision")


def verdict_flips(s: S, d: str) -> DataFrame:
    """The last verdict of odd events against the log of even ones."""
    log = _log(s, d)
    keys = ["user_id", "event_type"]
    now = R.latest(log.filter("event_id % 2 = 1"), keys, "o").select(*keys, F.col("decision").alias("verdict"), F.col("rubric").alias("agreement"))
    return B.verdict_flips(now, log.filter("event_id % 2 = 0"), keys, "o", F.lit("r1"))


def exemplars(s: S, d: str) -> DataFrame:
    keys = ["user_id", "event_type"]
    lines = B.exemplars(_log(s, d), _log(s, d).select(*keys).distinct(), keys, "o", F.concat_ws(":", F.col("user_id").cast("string"), "event_type", "decision"))
    return lines.select(*keys, F.array_join("exemplars", "|").alias("exemplars"))


def review_labels(s: S, d: str) -> DataFrame:
    c = t(s, d, "customer")
    return c.select("c_custkey", human_label(pick(REVIEWS, F.col("c_custkey"))).alias("label"))


def reviews_last_wins(s: S, d: str) -> DataFrame:
    c = t(s, d, "customer").select(F.col("c_mktsegment").alias("company"), (F.col("c_nationkey") % 5).cast("string").alias("opportunity"), pick(REVIEWS, F.col("c_custkey")).alias("verdict"), F.col("c_custkey").alias("seq"))
    return human_reviews(c, "seq")


def human_overrides(s: S, d: str) -> DataFrame:
    """labels: toxic = 0 is validated, quality is the analyst's label for two rows of three."""
    k = F.col("doc_id")
    p = t(s, d, "labels").select("doc_id", (F.col("toxic") == 0).alias("validated_fit"), pick(LABELS5, k).alias("ai_decision"), F.when(k % 3 != 0, F.col("quality")).alias("human"))
    return B.human_overrides(p).select("doc_id", "validated_fit", "ai_decision", "changed")


def abstention(s: S, d: str) -> DataFrame:
    p = pairs(s, d).withColumn("qualified", F.col("qualified") & (F.col("oid") % 4 != 0)).withColumn("validated_fit", F.coalesce(F.col("verdict").isin("Direct", "Partial", "Yes"), F.lit(False)) & (F.col("oid") % 4 != 1))
    return B.abstentions(p.withColumn("final_score", F.col("profile")), "oid", "cid")


def _scored_labels(s: S, d: str) -> DataFrame:
    return t(s, d, "documents").select("doc_id", ((F.col("n_chars") % 997) / 997.0).alias("final_score")).join(t(s, d, "labels"), "doc_id")


def auc(s: S, d: str) -> DataFrame:
    return B.auc(_scored_labels(s, d), "final_score", "quality")


def calibration(s: S, d: str) -> DataFrame:
    log = _log(s, d).drop("o").withColumn("o", F.struct("ts", "event_id"))
    keys = ["user_id", "event_type"]
    reviews = log.filter("event_id % 50 = 0").groupBy(*keys).agg(F.max((F.col("decision") == "Direct").cast("int")).alias("label"))
    pool = B.label_pool(log, reviews, keys, "o", F.lit("r1"), log.groupBy(*keys).agg(F.max("final_score").alias("final_score")))
    return B.calibrate(pool, R.latest(log, keys, "o").select(*keys, "final_score"))


def label_pool(s: S, d: str) -> DataFrame:
    """Reviews of logged pairs, of pairs that only the current table has, and of pairs that are gone."""
    keys = ["user_id", "event_type"]
    log = _log(s, d)
    reviews = log.filter("event_id % 50 = 0").groupBy(*keys).agg(F.max((F.col("decision") == "Direct").cast("int")).alias("label"))
    current = log.filter("user_id % 3 = 0").groupBy(*keys).agg(F.max("final_score").alias("final_score"))
    return B.label_pool(log.filter("user_id % 2 = 0"), reviews, keys, "o", F.lit("r1"), current)


def diagnostics(s: S, d: str) -> DataFrame:
    p = R.qualified_rank(pairs(s, d), "oid", "profile", ["cid"], "ro").withColumn("direct", F.col("verdict").isin("Direct", "Yes"))
    per = p.filter("ro <= 3").groupBy("cid").agg(F.count("*").alias("n")).agg(F.round(F.max("n") / F.sum("n"), 3).alias("top3_concentration"))
    one = p.agg(
        F.count("*").alias("pairs_total"), F.count_if("qualified").alias("pairs_qualified"), F.count_distinct("cid").alias("companies_total"), F.count_distinct(F.when(F.col("qualified"), F.col("cid"))).alias("companies_qualified"),
        F.count_distinct(F.when(F.col("direct"), F.col("oid"))).alias("opportunities_direct"), F.count_distinct(F.when(F.col("verdict") == "Partial", F.col("oid"))).alias("opportunities_partner"),
        F.count_if("direct").alias("pairs_direct"), F.count_if(F.col("verdict") == "Partial").alias("pairs_partner"), F.round(F.lit(exact_quantiles(p, "profile", [0.5])[0]), 4).alias("median_profile"),
    )
    return one.join(F.broadcast(per))  # one row each


def quantiles(s: S, d: str) -> DataFrame:
    q = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    found = exact_quantiles(t(s, d, "orders"), "o_totalprice", q)
    return s.range(1).select(*[F.round(F.lit(v).cast("double"), 4).alias(f"p{int(x * 100)}") for x, v in zip(q, found, strict=True)])


def value_counts(s: S, d: str) -> DataFrame:
    return pairs(s, d).groupBy("decision", "verdict").agg(F.count("*").alias("n"))


def _exports(s: S, d: str) -> tuple[DataFrame, DataFrame]:
    k = (F.col("cid") + F.col("oid")) % 4
    base = pairs(s, d).select("cid", "oid", pick(["Yes", "No", "Filtered"], F.col("cid") * 7 + F.col("oid")).alias("ai_decision"))
    new = pairs(s, d).filter((F.col("cid") + F.col("oid")) % 13 != 0).select("cid", "oid", pick(["Yes", "No", "Yes", "Filtered"], F.col("cid") + F.col("oid") * 5).alias("ai_decision"), F.when(k != 0, F.concat(F.lit("reason"), k.cast("string"))).alias("triage_reason"), F.col("profile").alias("final_score"))
    return base, new


def regression_diff(s: S, d: str) -> DataFrame:
    return B.dropped(*_exports(s, d), ["cid", "oid"])


def regression_summary(s: S, d: str) -> DataFrame:
    return B.regression_summary(*_exports(s, d), ["cid", "oid"]).withColumn("mean_final_score", F.round("mean_final_score", 6))


def retained(s: S, d: str) -> DataFrame:
    return B.retained(*_exports(s, d), ["cid", "oid"])


def rank_qa(s: S, d: str) -> DataFrame:
    """Ranked by score alone, so ties in the order of products show as violations."""
    p = pairs(s, d).withColumn("f", F.round("profile", 1)).withColumn("dec", F.when(F.col("verdict") == "Yes", "Yes").otherwise("No"))
    return R.rank_qa(R.ranked(p, "oid", [F.col("f").desc(), "cid"], "rank"), "oid", "rank", "f", "product", "dec")


def rank_gaps(s: S, d: str) -> DataFrame:
    p = R.ranked(pairs(s, d), "oid", [F.col("profile").desc(), "cid"], "rank").withColumn("rank", F.when((F.col("oid") % 6 == 0) & (F.col("rank") == 2), 3).otherwise(F.col("rank")))
    return R.contiguous(p, "oid", "rank")


def verified_needs(s: S, d: str) -> DataFrame:
    """Needs of benchmark items: a quote is the start of the item, an invented one, or too short."""
    b = t(s, d, "benchmark")
    w = F.split("text", " ")
    quote = F.when(F.col("item_id") % 3 == 0, F.array_join(F.slice(w, 2, 6), " ")).when(F.col("item_id") % 3 == 1, F.lit("never said in any text")).otherwise(F.array_join(F.slice(w, 1, 2), " "))
    needs = b.select("item_id", F.concat(F.lit("need "), F.col("item_id").cast("string")).alias("capability"), quote.alias("quote"))
    return B.verified_needs(needs, b.select("item_id", "text"), "item_id").select("item_id", "capability", "quote")


CAPS = ["Steel casting", "cable assembly", "clean-room filling", "water treatment", "logistics"]
COVER = ["Casting of steel", "Cable assembly!", "filling", "Water treatment and reuse", "", "CABLE  assembly"]


def _needs(s: S, d: str) -> tuple[DataFrame, DataFrame]:
    n = t(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("oid"))
    needs = n.select("oid", F.explode(F.sequence(F.lit(0), F.col("oid").cast("int") % 5)).alias("seq")).withColumn("capability", pick(CAPS, F.col("seq"))).withColumn("quote", F.when(F.col("seq") != 1, F.concat(F.lit("q"), F.col("seq").cast("string"))))
    name = lambda x: F.concat(F.lit(x), F.col("oid").cast("string"))
    firms = F.when((F.col("pos") % 2 == 0) | (F.col("pos") == 5), F.array(F.struct(name("A").alias("name"), F.lit("makes it").alias("why")), F.struct(name("B").alias("name"), F.lit(None).cast("string").alias("why")))).otherwise(F.array(F.struct(name("C").alias("name"), F.lit("near").alias("why"))))
    cover = n.select("oid", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("pos")).filter((F.col("oid") + F.col("pos")) % 3 != 0).withColumn("need", pick(COVER, F.col("pos"))).withColumn("companies", firms)
    return needs, cover


def consortium(s: S, d: str) -> DataFrame:
    return B.consortium(*_needs(s, d), "oid")


def review_payload(s: S, d: str) -> DataFrame:
    """The nested payload of the review page: each opportunity with its three best companies, those with
    matches first."""
    p = R.qualified_rank(pairs(s, d), "oid", "profile", ["cid"], "rank").filter("rank <= 3")
    g = p.groupBy("oid").agg(F.sort_array(F.collect_list(F.struct("rank", "cid"))).alias("c"))
    return g.select("oid", F.size("c").cast("long").alias("n"), F.to_json(F.transform("c", lambda x: F.struct(x["rank"].alias("rank"), x["cid"].alias("cid")))).alias("payload"))


def folder_summary(s: S, d: str) -> DataFrame:
    """Files by category: count and characters (documents stand in for files, their source for the name)."""
    return t(s, d, "documents").groupBy(F.col("source").alias("category")).agg(F.count("*").alias("files"), F.sum("n_chars").alias("chars"))


QUERIES = {
    "majority_vote": majority_vote, "unanimous_share": unanimous_share, "vote_depth": vote_depth, "latest_verdict": latest_verdict, "verdict_flips": verdict_flips, "exemplars": exemplars,
    "review_labels": review_labels, "reviews_last_wins": reviews_last_wins, "human_overrides": human_overrides, "abstention": abstention, "auc": auc, "calibration": calibration, "label_pool": label_pool,
    "diagnostics": diagnostics, "quantiles": quantiles, "value_counts": value_counts, "regression_diff": regression_diff, "regression_summary": regression_summary, "retained": retained, "rank_qa": rank_qa,
    "rank_gaps": rank_gaps, "verified_needs": verified_needs, "consortium": consortium, "review_payload": review_payload, "folder_summary": folder_summary,
}

# --- SQL -----------------------------------------------------------------------------------------

_VOTES = """v0 AS (SELECT conv_id AS pair, turn AS round, CASE role WHEN 'user' THEN 'Direct' WHEN 'assistant' THEN 'Partial' ELSE 'No' END AS fit, (length(text) % 100) / 100.0::DOUBLE AS confidence, md5(text) AS explanation,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
v1 AS (SELECT *, count(DISTINCT CASE WHEN k <= 3 THEN fit END) OVER (PARTITION BY pair) > 1 AS split FROM v0), v AS (SELECT * FROM v1 WHERE k <= 3 OR (split AND k <= 5)),
f AS (SELECT pair, fit, count(*) AS k, avg(confidence) AS mean, first(explanation ORDER BY confidence DESC, round) AS explanation FROM v GROUP BY pair, fit),
b AS (SELECT *, sum(k) OVER (PARTITION BY pair) AS n, row_number() OVER (PARTITION BY pair ORDER BY k DESC, list_position(['No', 'Partial', 'Direct'], fit)) AS r FROM f),
m AS (SELECT pair, fit, round((k / n * mean)::DOUBLE, 2) AS confidence, k::VARCHAR || '/' || n::VARCHAR AS agreement, explanation FROM b WHERE r = 1)"""
_k = "floor(value)::BIGINT"
_LOG = f"lg AS (SELECT user_id, event_type, ts, event_id, {sql_pick(DEC, f'(({_k}) % 4 + 4)')} AS decision, {sql_pick(['r1', 'r2'], 'event_id')} AS rubric, ((({_k}) % 100 + 100) % 100) / 100.0::DOUBLE AS final_score FROM events)"
_last = "row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC)"
_POOL = f"""{_LOG}, la AS (SELECT * FROM (SELECT *, {_last} AS r FROM lg WHERE user_id % 2 = 0) WHERE r = 1), cu AS (SELECT user_id, event_type, max(final_score) AS c FROM lg WHERE user_id % 3 = 0 GROUP BY ALL), rv AS (SELECT user_id, event_type, max((decision = 'Direct')::INT) AS h FROM lg WHERE event_id % 50 = 0 GROUP BY ALL)"""
_lab = "CASE WHEN lower(trim({v})) IN ('agree', 'yes', 'fit', '1', 'true') THEN 1 WHEN lower(trim({v})) IN ('disagree', 'no', 'not a fit', 'notfit', '0', 'false') THEN 0 END"
_EXPORTS = f"""pr AS ({PAIRS_SQL}), ba AS (SELECT cid, oid, {sql_pick(['Yes', 'No', 'Filtered'], 'cid * 7 + oid')} AS ai_decision FROM pr),
ne AS (SELECT cid, oid, {sql_pick(['Yes', 'No', 'Yes', 'Filtered'], 'cid + oid * 5')} AS ai_decision, CASE WHEN (cid + oid) % 4 <> 0 THEN 'reason' || (cid + oid) % 4 END AS triage_reason, profile AS final_score FROM pr WHERE (cid + oid) % 13 <> 0),
dr AS (SELECT cid, oid FROM ba WHERE ai_decision = 'Yes' EXCEPT SELECT cid, oid FROM ne WHERE ai_decision = 'Yes')"""
_q = "qualified AND oid % 4 <> 0"
_v = "coalesce(verdict IN ('Direct', 'Partial', 'Yes'), false) AND oid % 4 <> 1"
_g = "verdict IN ('Direct', 'Partial', 'Yes', 'No')"
_rq = "CASE WHEN qualified THEN row_number() OVER (PARTITION BY oid, qualified ORDER BY profile DESC, cid) END"
_norm = "trim(regexp_replace(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_\\s\\p{{Z}}]', ' ', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g'))"
_quote = "CASE WHEN item_id % 3 = 0 THEN array_to_string(string_split(text, ' ')[2:7], ' ') WHEN item_id % 3 = 1 THEN 'never said in any text' ELSE array_to_string(string_split(text, ' ')[1:2], ' ') END"
_C = f"""nd AS (SELECT oid, seq, {sql_pick(CAPS, 'seq')} AS capability FROM (SELECT n_nationkey::BIGINT AS oid, unnest(range(0, n_nationkey % 5 + 1)) AS seq FROM nation)),
cw AS (SELECT oid, pos, {_norm.format(x=sql_pick(COVER, 'pos'))} AS need, pos % 2 = 0 OR pos = 5 AS two FROM (SELECT n_nationkey::BIGINT AS oid, unnest(range(0, 6)) AS pos FROM nation) WHERE (oid + pos) % 3 <> 0),
cv AS (SELECT oid, need, min(pos) AS pos, arg_max(two, pos) AS two FROM cw GROUP BY oid, need),
sz AS (SELECT oid, count(*) AS n FROM nd GROUP BY oid),
mt AS (SELECT nd.oid, nd.seq, arg_min(two, pos) AS two FROM nd JOIN cv ON cv.oid = nd.oid AND need <> '' AND (contains(need, {_norm.format(x='capability')}) OR contains({_norm.format(x='capability')}, need)) GROUP BY ALL)"""

SQL = {
    "majority_vote": f"WITH {_VOTES} SELECT pair, fit, confidence, agreement, explanation FROM m",
    "unanimous_share": f"WITH {_VOTES} SELECT round(coalesce(avg((split_part(agreement, '/', 1) = split_part(agreement, '/', 2))::INT), 0.0), 3) AS unanimous_share FROM m",
    "vote_depth": f"WITH r AS (SELECT cid, oid, row_number() OVER (PARTITION BY oid ORDER BY profile DESC, cid) AS r FROM ({PAIRS_SQL})) SELECT cid, oid, CASE WHEN r <= 3 THEN 3 WHEN r <= 20 THEN 1 ELSE 0 END AS votes FROM r",
    "latest_verdict": f"WITH {_LOG} SELECT user_id, event_type, event_id, decision FROM (SELECT *, {_last} AS r FROM lg) WHERE r = 1",
    "verdict_flips": f"""WITH {_LOG}, a AS (SELECT * FROM (SELECT *, {_last} AS r FROM lg WHERE event_id % 2 = 1) WHERE r = 1), b AS (SELECT * FROM (SELECT *, {_last} AS r FROM lg WHERE event_id % 2 = 0) WHERE r = 1)
      SELECT a.user_id, a.event_type, a.decision AS new_verdict, b.decision AS previous_verdict, rtrim(rtrim(strftime(b.ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS previous_ts, CASE WHEN b.rubric <> 'r1' THEN 'yes' ELSE 'no' END AS rubric_changed, a.rubric AS agreement, '' AS human_verdict FROM a JOIN b USING (user_id, event_type)
      WHERE a.decision IN ('Direct', 'Partial', 'Yes', 'No') AND a.decision <> b.decision""",
    "exemplars": f"""WITH {_LOG}, l AS (SELECT * FROM (SELECT *, {_last} AS r FROM lg) WHERE r = 1), x AS (SELECT a.user_id, a.event_type, b.user_id || ':' || b.event_type || ':' || b.decision AS line, b.ts, b.event_id, row_number() OVER (PARTITION BY a.user_id, a.event_type ORDER BY b.ts DESC, b.event_id DESC) AS k
      FROM l a JOIN l b ON (a.user_id, a.event_type) <> (b.user_id, b.event_type)) SELECT user_id, event_type, string_agg(line, '|' ORDER BY ts, event_id) AS exemplars FROM x WHERE k <= 8 GROUP BY ALL""",
    "review_labels": f"SELECT c_custkey, {_lab.format(v=sql_pick(REVIEWS, 'c_custkey'))} AS label FROM customer",
    "reviews_last_wins": f"WITH r AS (SELECT c_mktsegment AS company, (c_nationkey % 5)::VARCHAR AS opportunity, {_lab.format(v=sql_pick(REVIEWS, 'c_custkey'))} AS label, c_custkey FROM customer) SELECT company, opportunity, arg_max(label, c_custkey) AS label FROM r WHERE label IS NOT NULL GROUP BY ALL",
    "human_overrides": f"""WITH p AS (SELECT doc_id, toxic = 0 AS v, {sql_pick(LABELS5, 'doc_id')} AS a, CASE WHEN doc_id % 3 <> 0 THEN quality END AS h FROM labels),
      q AS (SELECT *, coalesce(h = 0 AND (v OR a <> 'Low Fit'), false) AS n, coalesce(h = 1 AND NOT v, false) AS y FROM p)
      SELECT doc_id, CASE WHEN n THEN false WHEN y THEN true ELSE v END AS validated_fit, CASE WHEN n THEN 'Low Fit' WHEN y AND a IN ('', 'Low Fit', 'Review Needed') THEN 'Partner Fit' ELSE a END AS ai_decision, n OR y AS changed FROM q""",
    "abstention": f"""WITH g AS (SELECT oid, bool_or({_q}) AS q, bool_or(coalesce({_g}, false)) AS g, bool_or({_v}) AS v, first(cid ORDER BY profile DESC, cid) AS ab, first(cid ORDER BY profile DESC, cid) FILTER (WHERE {_g}) AS gb FROM ({PAIRS_SQL}) GROUP BY oid)
      SELECT oid, CASE WHEN NOT q THEN 'No qualified candidate' ELSE 'No validated fit (no Direct or Partial)' END AS status, CASE WHEN NOT q THEN ab ELSE gb END AS best_candidate FROM g WHERE NOT q OR (g AND NOT v)""",
    "auc": """WITH s AS (SELECT (n_chars % 997) / 997.0::DOUBLE AS x, quality AS y FROM documents JOIN labels USING (doc_id))
      SELECT round(sum(CASE WHEN a.x > b.x THEN 1.0 WHEN a.x = b.x THEN 0.5 ELSE 0.0 END)::DOUBLE / count(*), 6) AS auc FROM s a JOIN s b ON a.y = 1 AND b.y = 0""",
    "calibration": f"""WITH RECURSIVE {_LOG}, la AS (SELECT * FROM (SELECT *, {_last} AS r FROM lg) WHERE r = 1), rv AS (SELECT user_id, event_type, max((decision = 'Direct')::INT) AS h FROM lg WHERE event_id % 50 = 0 GROUP BY ALL),
      pool AS (SELECT la.final_score AS x, coalesce(h, (decision IN ('Direct', 'Partial', 'Yes'))::INT) AS y, (CASE WHEN h IS NOT NULL THEN 3.0 WHEN rubric = 'r1' THEN 1.0 ELSE 0.6 END)::DOUBLE AS w FROM la LEFT JOIN rv USING (user_id, event_type)),
      points AS (SELECT x, y, sum(w) AS w FROM pool GROUP BY x, y),
      steps AS (
        SELECT 0 AS k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b
        UNION ALL
        SELECT k + 1, a - least(greatest((h2 * g0 - h1 * g1) / det, -{B.LONGEST_STEP}), {B.LONGEST_STEP}), b - least(greatest((h0 * g1 - h1 * g0) / det, -{B.LONGEST_STEP}), {B.LONGEST_STEP})
        FROM (SELECT *, greatest(h0 * h2 - h1 * h1, 1e-12) AS det FROM (
          SELECT k, a, b, sum(d) AS g0, sum(d * x) + b AS g1, sum(h) AS h0, sum(h * x) AS h1, sum(h * x * x) + 1 AS h2
          FROM (SELECT k, a, b, x, w * (p - y) AS d, w * p * (1 - p) AS h FROM (SELECT *, 1 / (1 + exp(-(a + b * x))) AS p FROM steps, points WHERE k < {B.NEWTON_STEPS})) GROUP BY k, a, b)))
      SELECT user_id, event_type, final_score, CASE WHEN (SELECT count(*) >= 30 AND sum(y) >= 8 AND count(*) - sum(y) >= 8 FROM pool) THEN round(1 / (1 + exp(-(a + b * final_score))), 3) END AS match_probability
      FROM la, steps WHERE k = {B.NEWTON_STEPS}""",
    "label_pool": f"""WITH {_POOL}, bo AS (SELECT *, coalesce(final_score, c) AS s FROM (SELECT * FROM la FULL JOIN rv USING (user_id, event_type)) LEFT JOIN cu USING (user_id, event_type))
      SELECT user_id, event_type, s AS final_score, coalesce(h, (decision IN ('Direct', 'Partial', 'Yes'))::INT) AS y, (CASE WHEN h IS NOT NULL THEN 3.0 WHEN rubric = 'r1' THEN 1.0 ELSE 0.6 END)::DOUBLE AS weight FROM bo WHERE s IS NOT NULL""",
    "diagnostics": f"""WITH p AS (SELECT *, {_rq} AS ro, verdict IN ('Direct', 'Yes') AS direct FROM ({PAIRS_SQL})), c AS (SELECT cid, count(*) AS n FROM p WHERE ro <= 3 GROUP BY cid)
      SELECT count(*) AS pairs_total, count_if(qualified)::BIGINT AS pairs_qualified, count(DISTINCT cid) AS companies_total, count(DISTINCT CASE WHEN qualified THEN cid END) AS companies_qualified, count(DISTINCT CASE WHEN direct THEN oid END) AS opportunities_direct,
        count(DISTINCT CASE WHEN verdict = 'Partial' THEN oid END) AS opportunities_partner, count_if(direct)::BIGINT AS pairs_direct, count_if(verdict = 'Partial')::BIGINT AS pairs_partner, round(quantile_cont(profile, 0.5), 4) AS median_profile,
        (SELECT round((max(n) / sum(n))::DOUBLE, 3) FROM c) AS top3_concentration FROM p""",
    "quantiles": "SELECT " + ", ".join(f"round(quantile_cont(o_totalprice, {x}), 4) AS p{int(x * 100)}" for x in [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]) + " FROM orders",
    "value_counts": f"SELECT decision, verdict, count(*) AS n FROM ({PAIRS_SQL}) GROUP BY ALL",
    "regression_diff": f"WITH {_EXPORTS} SELECT cid, oid FROM dr",
    "regression_summary": f"WITH {_EXPORTS} SELECT triage_reason, count(*) AS n, round(avg(final_score), 6) AS mean_final_score FROM dr LEFT JOIN ne USING (cid, oid) GROUP BY triage_reason",
    "retained": f"""WITH {_EXPORTS}, b AS (SELECT DISTINCT cid, oid FROM ba WHERE ai_decision = 'Yes'), n AS (SELECT DISTINCT cid, oid FROM ne WHERE ai_decision = 'Yes'), x AS (SELECT (SELECT count(*) FROM b) AS baseline_yes, (SELECT count(*) FROM n) AS new_yes, (SELECT count(*) FROM (SELECT * FROM b INTERSECT SELECT * FROM n)) AS still_yes)
      SELECT *, round(100.0 * still_yes / nullif(baseline_yes, 0), 3)::DOUBLE AS retained_pct FROM x""",
    "rank_qa": f"""WITH p AS (SELECT cid, oid, round(profile, 1) AS f, product, CASE WHEN verdict = 'Yes' THEN 'Yes' ELSE 'No' END AS d FROM ({PAIRS_SQL})), r AS (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY f DESC, cid) AS rank FROM p),
      l AS (SELECT *, lag(f) OVER w AS lf, lag(product) OVER w AS lp FROM r WINDOW w AS (PARTITION BY oid ORDER BY rank))
      SELECT oid, count_if(lf < f OR (lf = f AND lp < product))::BIGINT AS order_violations, bool_or(d = 'Yes') AND NOT bool_or(d = 'Yes' AND rank = 1) AS top_not_yes FROM l GROUP BY oid""",
    "rank_gaps": f"""WITH r AS (SELECT oid, row_number() OVER (PARTITION BY oid ORDER BY profile DESC, cid)::INT AS k FROM ({PAIRS_SQL})), x AS (SELECT oid, CASE WHEN oid % 6 = 0 AND k = 2 THEN 3 ELSE k END AS rank FROM r),
      g AS (SELECT oid, count(rank) AS n, min(rank) AS lo, max(rank) AS hi, count(DISTINCT rank) AS d FROM x GROUP BY oid) SELECT * FROM g WHERE lo <> 1 OR hi <> n OR d <> n""",
    "verified_needs": f"WITH n AS (SELECT item_id, 'need ' || item_id AS capability, {_quote} AS quote, text FROM benchmark) SELECT item_id, capability, quote FROM n WHERE len(string_split({_norm.format(x='quote')}, ' ')) >= 4 AND contains({_norm.format(x='text')}, {_norm.format(x='quote')})",
    "consortium": f"""WITH {_C} SELECT oid, 'Ready' AS status, capability AS need, CASE WHEN seq <> 1 THEN 'q' || seq ELSE '' END AS source_quote, CASE WHEN two IS NULL THEN '' WHEN two THEN 'A' || oid || ', B' || oid ELSE 'C' || oid END AS covered_by,
        CASE WHEN two IS NULL THEN '' WHEN two THEN 'A' || oid || ': makes it | B' || oid || ': ' ELSE 'C' || oid || ': near' END AS why, CASE WHEN two IS NULL THEN 'GAP' ELSE '' END AS gap FROM nd JOIN sz USING (oid) LEFT JOIN mt USING (oid, seq) WHERE n >= 3
      UNION ALL SELECT oid, 'Thin data - ranked view applies', '', '', '', '', '' FROM sz WHERE n < 3""",
    "review_payload": f"""WITH p AS (SELECT cid, oid, {_rq} AS rank FROM ({PAIRS_SQL})) SELECT oid, count(*) AS n, '[' || string_agg('{{"rank":' || rank || ',"cid":' || cid || '}}', ',' ORDER BY rank) || ']' AS payload FROM p WHERE rank <= 3 GROUP BY oid""",
    "folder_summary": "SELECT source AS category, count(*) AS files, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY source",
}
