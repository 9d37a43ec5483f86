"""Table adapters and SQL fragments shared by the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.sources.stages import read_table

LANGS = ["de", "en", "es", "fr"]


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def pick(items: list, index: Column) -> Column:
    """items[index mod n]."""
    return F.element_at(F.array(*[F.lit(x) for x in items]), (F.pmod(index, F.lit(len(items))) + 1).cast("int"))


def sql_text(x) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(sql_text(x) for x in items) + "]"


def sql_pick(items: list, index: str) -> str:
    return f"{sql_list(items)}[(({index}) % {len(items)} + 1)::INT]"


def sql_map(table: dict) -> str:
    return "MAP {" + ", ".join(f"{sql_text(k)}: {sql_text(v) if isinstance(v, str) else v}" for k, v in table.items()) + "}"


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cid, text, sector): documents as companies, their language as sector."""
    return t(spark, sf_dir, "documents").select(F.col("doc_id").alias("cid"), "text", F.col("lang").alias("sector"))


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(oid, text, sector): benchmark items as opportunities, languages dealt in turn as sectors."""
    return t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("oid"), "text", pick(LANGS, F.col("item_id")).alias("sector"))


COMPANIES_SQL = "SELECT doc_id AS cid, text, lang AS sector FROM documents"
OPPORTUNITIES_SQL = f"SELECT item_id AS oid, text, {sql_pick(LANGS, 'item_id')} AS sector FROM benchmark"

NOT_WORD = r"[^\p{L}\p{N}_\s\p{Z}]"
SPACES = r"[\s\p{Z}]+"


def pp(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '{NOT_WORD}', ' ', 'g'), '{SPACES}', ' ', 'g'))"


def pp0(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '{NOT_WORD}', '', 'g'), '{SPACES}', ' ', 'g'))"


def toks(x: str, generic: list[str] | None = None) -> str:
    drop = sql_list([*dims.STOPWORDS, *(dims.GENERIC_TERMS if generic is None else generic)])
    return f"list_distinct(list_filter(string_split({pp(x)}, ' '), lambda w: length(w) > 2 AND NOT regexp_full_match(w, '\\p{{Nd}}+') AND NOT list_contains({drop}, w)))"


# --- supplier x nation pairs with derived signals: every value follows from the two keys ----------
ROLE, MENU = dims.ROLES, dims.LOCALIZATION_MENU
VERDICTS = ["Direct", "Partial", "No", "Yes", "Not Run", None]
HUMANS = ["Agree", None, "Disagree", None, None]
VOTES = ["3/3", "2/3", "1/1", "4/5", ""]
DECISIONS = [n for _, n in dims.TIERS]
_NUMBERS = {"profile": (37, 11), "product": (53, 29), "sector": (17, 71), "evidence": (91, 7), "chain": (43, 59)}


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cid"))
    n = t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("oid"))
    c, o = F.col("cid"), F.col("oid")
    p = s.crossJoin(n)  # every pair is wanted; one side has 25 rows at every scale
    return p.select(
        "cid", "oid", *[(((c * a + o * b) % 1000) / 1000.0).alias(k) for k, (a, b) in _NUMBERS.items()],
        pick(ROLE, c + o).alias("role"), pick(ROLE, o * 5).alias("lead"), pick(MENU, c * 3 + o).alias("model"), pick(VERDICTS, c * 7 + o).alias("verdict"),
        pick(HUMANS, c + o * 3).alias("human"), pick(VOTES, c + o * 2).alias("votes"), ((c + o) % 3 == 0).alias("light"), ((c * 3 + o) % 4 != 0).alias("qualified"),
        ((c + o) % 3 != 0).alias("linked"), ((c + 2 * o) % 5 == 0).alias("bridge_only"), pick(DECISIONS, c * 5 + o * 7).alias("decision"), ((c * 11 + o) % 101).alias("match_value"),
    )


PAIRS_SQL = "SELECT cid, oid, " + ", ".join(f"((cid * {a} + oid * {b}) % 1000) / 1000.0::DOUBLE AS {k}" for k, (a, b) in _NUMBERS.items()) + (
    f", {sql_pick(ROLE, 'cid + oid')} AS role, {sql_pick(ROLE, 'oid * 5')} AS lead, {sql_pick(MENU, 'cid * 3 + oid')} AS model, {sql_pick(VERDICTS, 'cid * 7 + oid')} AS verdict, "
    f"{sql_pick(HUMANS, 'cid + oid * 3')} AS human, {sql_pick(VOTES, 'cid + oid * 2')} AS votes, (cid + oid) % 3 = 0 AS light, (cid * 3 + oid) % 4 <> 0 AS qualified, "
    f"(cid + oid) % 3 <> 0 AS linked, (cid + 2 * oid) % 5 = 0 AS bridge_only, {sql_pick(DECISIONS, 'cid * 5 + oid * 7')} AS decision, (cid * 11 + oid) % 101 AS match_value "
    "FROM (SELECT s_suppkey AS cid FROM supplier) CROSS JOIN (SELECT n_nationkey::BIGINT AS oid FROM nation)"
)

VOCAB_CTE = f"""
co AS ({COMPANIES_SQL}), op AS ({OPPORTUNITIES_SQL}),
ctok AS (SELECT cid, unnest({toks('text')}) AS token FROM co),
otok AS (SELECT oid, unnest({toks('text')}) AS token FROM op),
nn AS (SELECT greatest((SELECT count(*) FROM co) + (SELECT count(*) FROM op), 1) AS n),
prot AS (SELECT DISTINCT unnest({sql_list(sorted({*dims.SECTOR_ONTOLOGY, *(v for vs in dims.SECTOR_ONTOLOGY.values() for v in vs), *(x for r in dims.BRIDGE_RULES for x in r[2])}))}) AS token),
cnts AS (SELECT token, count(*) AS cnt FROM (SELECT token FROM ctok UNION ALL SELECT token FROM otok) GROUP BY token),
vocab AS (
  SELECT token, cnt, n, ln(n / (1 + cnt)) + 1.0 AS idf, cnt / n AS doc_ratio,
    cnt >= {dims.COMMON_MIN_DOCS} AND cnt / n >= {dims.COMMON_RATIO} AND token NOT IN (SELECT token FROM prot) AS is_common,
    token IN (SELECT token FROM prot) AS is_protected,
    length(token) >= 4 AND (token IN (SELECT token FROM prot) OR token IN (SELECT token FROM otok)) AS is_domain
  FROM cnts, nn
),
usable AS (
  SELECT token, idf, doc_ratio <= {dims.EVIDENCE_MAX_DOC_RATIO} AS strict FROM vocab
  WHERE is_domain AND NOT is_common AND idf >= {dims.MIN_EVIDENCE_IDF} AND NOT list_contains({sql_list(dims.NON_CAPABILITY_TERMS)}, token)
),
ev AS (SELECT cid, oid, token, idf, strict FROM ctok JOIN (SELECT oid, token, idf, strict FROM otok JOIN usable USING (token)) USING (token)),
evs AS (
  SELECT cid, oid, count(*) AS n_terms,
    list({{'w': -idf, 'token': token}} ORDER BY -idf, token) FILTER (WHERE strict) AS s, list({{'w': -idf, 'token': token}} ORDER BY -idf, token) AS l
  FROM ev GROUP BY cid, oid
),
evidence AS (
  SELECT cid, oid, n_terms, 1 - exp(coalesce(list_sum([x.w for x in coalesce(s, [])[1:10]]), 0.0) / 8.0) AS evidence_score,
    [x.token for x in (CASE WHEN len(coalesce(s, [])) > 0 THEN s ELSE l END)[1:8]] AS terms FROM evs
)
"""
