"""Scalar text and array functions, each over a whole driver table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions import arrays as A
from pairforge.functions import text as X
from pairforge.queries.base import NOT_WORD, SPACES, pick, pp, pp0, sql_list, sql_map, sql_pick, sql_text, t, toks

S = SparkSession

# Short literal texts, dealt over the rows of a table, so that every pattern really occurs.
FOUNDING = [
    "Acme Corp was founded in 1990 and is headquartered in Berlin. It makes sulfuric acid.", "Listed on NASDAQ, the firm engages in the provision of water-treatment chemicals.",
    "Established in 1985, it is a global, publicly-traded maker of cables.", "It was founded by two brothers, and since 2004 it casts steel.", "No trivia here.",
]
PRICES = ["Assembly hub in Saudi Arabia. Copper 9,800 USD/ton, supplied by SABIC.", "Demand of 12.5 million ton in the Gulf and Asia-Pacific.", "The Americas pay 40 % more, NEOM 3 billion SAR.", "Plain words."]
SUFFIXES = [" LLC", " & Sons Co Ltd", " Company", ", Inc.", " Holding", " Corp. Ltd."]
TERMS = ["the Saudi FDA approved it", "Saudi FDA rules", "Saudi Food and Drug Authority (SFDA) and Saudi FDA", "a Saudi Arabian FDA letter, Saudi Food and Drug Authority", "nothing"]
MODELS = ["joint venture", "A Greenfield manufacturing site", "venture", "OEM", "not recommended at all", "", "licensing and technology transfer now"]
FITS = ["Direct", " direct match ", "yes", "YES!", "Partial", "supplier only", "Partner", "no", ""]
REVIEWS = ["agree", "Not a fit", "maybe", "YES", "0", " true ", "disagree"]
LABELS = ["MedTech", "Pharmaceutical", "Oil,  Gas, Energy & Water", "Robotics", "ict", "Unknown field", "", "Mining"]


def _docs(s: S, d: str) -> DataFrame:
    return t(s, d, "documents")


def _by_doc(expr, name: str = "result"):
    return lambda s, d: _docs(s, d).select("doc_id", expr(F.col("text")).alias(name))


def canonical_name(s: S, d: str) -> DataFrame:
    name = F.concat("s_name", pick(SUFFIXES, F.col("s_suppkey")))
    return t(s, d, "supplier").select("s_suppkey", X.canonical_name(name).alias("result"))


def _cust(items: list[str], expr):
    return lambda s, d: t(s, d, "customer").select("c_custkey", expr(pick(items, F.col("c_custkey"))).alias("result"))


def focus_company(s: S, d: str) -> DataFrame:
    return t(s, d, "customer").select("c_custkey", X.focus_company(F.concat(pick(FOUNDING, F.col("c_custkey")), F.lit(" "), "c_name")).alias("result"))


def focus_opportunity(s: S, d: str) -> DataFrame:
    return t(s, d, "benchmark").select("item_id", X.focus_opportunity(F.concat(pick(PRICES, F.col("item_id")), F.lit(" "), "text")).alias("result"))


def strip_html(s: S, d: str) -> DataFrame:
    return t(s, d, "pages").select("page_id", X.strip_html(F.col("html")).alias("result"))


def snippets(s: S, d: str) -> DataFrame:
    return t(s, d, "pages").select("page_id", F.posexplode(X.snippets(F.col("html"))).alias("pos", "snippet"))


def first_email(s: S, d: str) -> DataFrame:
    return _docs(s, d).select("doc_id", X.first_email(F.col("text")).alias("result"))


#: Different first words of quotes that go to the tasks; more of them are joined.
MOST_STARTS = 20_000


def quote_in_text(s: S, d: str) -> DataFrame:
    """Documents that hold a whole benchmark text.  Candidates meet on a hash of the item's first four words, so that
    only those pairs are compared in full."""
    four = lambda i: F.xxhash64(*[F.get("w", i + j) for j in range(4)])
    q = t(s, d, "benchmark").select("item_id", X.preprocess(F.col("text")).alias("q")).withColumn("w", F.split("q", " ")).filter(F.size("w") >= 4)
    q = q.select("item_id", "q", four(F.lit(0)).alias("k"))
    docs = _docs(s, d).select("doc_id", X.preprocess(F.col("text")).alias("x")).withColumn("w", F.split("x", " "))
    # neither filters nor explode on what is made here: they would be pushed down with a copy of all of it
    docs = docs.select("doc_id", "x", F.when(F.size("w") >= 4, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("w") - 4), four))).alias("ks"))
    starts = [r[0] for r in q.select("k").distinct().limit(MOST_STARTS + 1).collect()]
    if len(starts) <= MOST_STARTS:  # a text's row holds the few starts that occur in it, and no other
        met = docs.select("doc_id", "x", F.explode_outer(F.filter("ks", lambda k: k.isin(starts))).alias("k")).join(q, "k")
    else:
        near = docs.select("doc_id", F.explode_outer("ks").alias("k")).join(q.select("k", "item_id"), "k").select("doc_id", "item_id").distinct()
        met = near.join(q.select("item_id", "q"), "item_id").join(docs.select("doc_id", "x"), "doc_id")
    return met.filter(F.contains("x", F.col("q"))).select("doc_id", "item_id")


def clip_evidence(s: S, d: str) -> DataFrame:
    return _docs(s, d).select("doc_id", X.clip_evidence(F.col("text")).alias("result"))


def localization(s: S, d: str) -> DataFrame:
    from pairforge.queries.base import DECISIONS

    return t(s, d, "customer").select("c_custkey", X.normalize_localization(pick(MODELS, F.col("c_custkey")), pick(DECISIONS, F.floor(F.col("c_custkey") / 7))).alias("result"))


def normalize_key(s: S, d: str) -> DataFrame:
    return t(s, d, "part").select("p_partkey", X.normalize_key(F.concat(F.lit("  "), F.upper("p_name"), F.lit("-_É#9"))).alias("result"))


def exactly_three(s: S, d: str) -> DataFrame:
    return _docs(s, d).select("doc_id", F.array_join(A.exactly_three(F.split("text", "\n")), "|").alias("result"))


def json_lists(s: S, d: str) -> DataFrame:
    """Lines to JSON and back to trimmed non-blank lists; broken JSON is the empty list."""
    j = F.when(F.col("doc_id") % 7 == 0, F.lit("{not json")).otherwise(F.to_json(F.split("text", "\n")))
    return _docs(s, d).select("doc_id", F.array_join(A.parse_json_list(j), "|").alias("result"), F.size(A.parse_json_list(j)).cast("long").alias("n"))


def rubric_version(s: S, d: str) -> DataFrame:
    return t(s, d, "benchmark").select("item_id", A.rubric_version(F.col("item_id").cast("string"), F.col("text")).alias("result"))


def context_lines(s: S, d: str) -> DataFrame:
    c = t(s, d, "customer").withColumn("seg", F.when(F.col("c_custkey") % 5 == 0, F.lit("  ")).otherwise(F.col("c_mktsegment")))
    return c.select("c_custkey", X.labelled([("Name", F.col("c_name")), ("Segment", F.col("seg")), ("Nation", F.col("c_nationkey").cast("string"))]).alias("result"))


def rotating_verbs(s: S, d: str) -> DataFrame:
    return t(s, d, "customer").select("c_custkey", A.rotating(dims.ENGAGEMENT_VERBS, F.col("c_custkey")).alias("verb"))


def report_clean(s: S, d: str) -> DataFrame:
    return t(s, d, "part").select("p_partkey", X.report_clean(F.concat("p_name", F.lit(" — a  –  b\n"), F.col("p_size").cast("string"))).alias("result"))


def sector_stats(s: S, d: str) -> DataFrame:
    """Blank and filled labels, vocabulary size, e-mails found: the dry-run statistics."""
    lab = pick(LABELS, F.col("c_custkey"))
    return t(s, d, "customer").agg(F.count_if(F.trim(lab) == "").alias("blank"), F.count_if(F.trim(lab) != "").alias("filled"), F.count_distinct(F.when(F.trim(lab) != "", lab)).alias("labels"), F.count("c_mktsegment").alias("segments"))


QUERIES = {
    "preprocess": _by_doc(X.preprocess), "preprocess_g0": _by_doc(X.preprocess_g0), "safe_str": _by_doc(X.safe_str), "drop_control": _by_doc(X.drop_control),
    "tokenize": _by_doc(lambda c: F.array_join(F.array_sort(X.static_tokens(c)), " ")), "canonical_sector": _by_doc(X.canonical_sector),
    "canonical_name": canonical_name, "focus_company": focus_company, "focus_opportunity": focus_opportunity, "strip_html": strip_html, "snippets": snippets,
    "first_email": first_email, "quote_in_text": quote_in_text, "clip_evidence": clip_evidence, "normalize_terminology": _cust(TERMS, X.normalize_terminology),
    "normalize_localization": localization, "parse_fit": _cust(FITS, X.parse_fit), "sector_label": _cust(LABELS, X.sector_label), "normalize_key": normalize_key,
    "exactly_three": exactly_three, "json_lists": json_lists, "rubric_version": rubric_version, "context_lines": context_lines, "rotating_verbs": rotating_verbs, "report_clean": report_clean, "sector_stats": sector_stats,
}


def _doc_sql(expr: str) -> str:
    return f"SELECT doc_id, {expr} AS result FROM documents"


def _cust_sql(items: list[str], expr) -> str:
    return f"SELECT c_custkey, {expr(sql_pick(items, 'c_custkey'))} AS result FROM customer"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACES}', ' ', 'g'))"


def _terms_sql(x: str) -> str:
    for pattern, name in dims.GLOSSARY:
        x = f"regexp_replace({x}, {sql_text(pattern)}, {sql_text(name)}, 'g')"
    return x


def _menu_sql(v: str, decision: str) -> str:
    v = f"lower(trim(coalesce({v}, '')))"
    whens = " ".join(f"WHEN contains({v}, {sql_text(m.lower())}) OR ({v} <> '' AND contains({sql_text(m.lower())}, {v})) THEN {sql_text(m)}" for m in dims.LOCALIZATION_MENU)
    return f"CASE {whens} WHEN contains({v}, 'not recommend') THEN 'Not recommended' WHEN {decision} IN ('Excellent Match', 'Strong Match', 'Good Match') THEN 'Supplier localization' ELSE 'Not recommended' END"


_fit = "CASE WHEN starts_with({v}, 'direct') OR {v} = 'yes' THEN 'Direct' WHEN starts_with({v}, 'partial') OR starts_with({v}, 'supplier') OR starts_with({v}, 'partner') THEN 'Partial' ELSE 'No' END"
_nodes = {**{n: n for n in dims.TAXONOMY}, **{leaf: leaf for leaves in dims.TAXONOMY.values() for leaf in leaves}, **dims.SECTOR_SYNONYMS}
_suffix = "|".join(dims.LEGAL_SUFFIXES)
_lines = "list_filter([trim(x) for x in string_split(text, chr(10))], lambda x: x <> '')"
_email_chars = ".,;:()[]<>\"''"

SQL = {
    "preprocess": _doc_sql(pp("text")), "preprocess_g0": _doc_sql(pp0("text")), "safe_str": _doc_sql("trim(coalesce(text, ''), ' ')"),
    "drop_control": _doc_sql(r"regexp_replace(coalesce(text, ''), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')"),
    "tokenize": _doc_sql(f"array_to_string(list_sort({toks('text')}), ' ')"),
    "canonical_sector": _doc_sql(f"trim(replace({pp('text')}, ' and ', ' '))"),
    "canonical_name": f"SELECT s_suppkey, trim(regexp_replace({pp('replace(lower(s_name || ' + sql_pick(SUFFIXES, 's_suppkey') + chr(41) + ', ' + sql_text('&') + ', ' + sql_text(' and ') + ')')}, '(^|\\s)({_suffix})(\\s+({_suffix}))*$', '')) AS result FROM supplier",
    "focus_company": f"SELECT c_custkey, {_collapse('regexp_replace(' + sql_pick(FOUNDING, 'c_custkey') + chr(32) + '||' + sql_text(' ') + '|| c_name, ' + sql_text('(?i)' + '|'.join(dims.JUNK_PHRASES)) + ', ' + sql_text(' ') + ', ' + sql_text('g') + ')')} AS result FROM customer",
    "focus_opportunity": "SELECT item_id, " + _collapse(f"regexp_replace(regexp_replace({sql_pick(PRICES, 'item_id')} || ' ' || text, {sql_text('(?i)' + dims.PRICE_NUMBER)}, ' ', 'g'), {sql_text('(?i)' + dims.GEOGRAPHY)}, ' ', 'g')") + " AS result FROM benchmark",
    "strip_html": "SELECT page_id, " + _collapse("regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g')") + " AS result FROM pages",
    "snippets": f"""
      WITH p AS (SELECT page_id, list_filter([{_collapse("regexp_replace(x, '<[^>]+>', ' ', 'g')")} for x in regexp_extract_all(coalesce(html, ''), '(?s)<p[^>]*>(.*?)</p>', 1)], lambda s: length(s) >= 24)[1:5] AS found FROM pages),
      q AS (SELECT page_id, unnest(found) AS snippet, unnest(range(0, len(found))) AS pos FROM p)
      SELECT page_id, pos::INT AS pos, substring(snippet, 1, 900) AS snippet FROM q""",
    "first_email": f"""
      WITH e AS (SELECT doc_id, lower(trim(regexp_extract(coalesce(text, ''), '({dims.EMAIL})', 1), '{_email_chars}')) AS e FROM documents)
      SELECT doc_id, CASE WHEN regexp_full_match(e, '{dims.EMAIL}') THEN e ELSE '' END AS result FROM e""",
    "quote_in_text": f"""
      WITH q AS (SELECT item_id, {pp('text')} AS q FROM benchmark), x AS (SELECT doc_id, {pp('text')} AS x FROM documents)
      SELECT doc_id, item_id FROM x JOIN q ON len(string_split(q, ' ')) >= 4 AND contains(x, q)""",
    "clip_evidence": _doc_sql("CASE WHEN length(trim(text, ' ')) <= 200 THEN trim(text, ' ') ELSE substring(trim(text, ' '), 1, 199) || '…' END"),
    "normalize_terminology": _cust_sql(TERMS, _terms_sql),
    "normalize_localization": f"SELECT c_custkey, {_menu_sql(sql_pick(MODELS, 'c_custkey'), sql_pick([n for _, n in dims.TIERS], 'c_custkey // 7'))} AS result FROM customer",
    "parse_fit": _cust_sql(FITS, lambda x: _fit.format(v=f"lower(trim({x}))")),
    "sector_label": _cust_sql(LABELS, lambda x: f"coalesce({sql_map(_nodes)}[{_collapse(f'lower(trim({x}))')}], '')"),
    "normalize_key": "SELECT p_partkey, " + _collapse("regexp_replace(translate(lower(trim('  ' || upper(p_name) || '-_É#9')), '-_', '  '), '[^a-z0-9\\s]', ' ', 'g')") + " AS result FROM part",
    "exactly_three": _doc_sql(f"array_to_string(list_concat({_lines}, ['', '', ''])[1:3], '|')"),
    "json_lists": f"SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE array_to_string({_lines}, '|') END AS result, CASE WHEN doc_id % 7 = 0 THEN 0 ELSE len({_lines}) END::BIGINT AS n FROM documents",
    "rubric_version": "SELECT item_id, substring(md5(item_id::VARCHAR || text), 1, 8) AS result FROM benchmark",
    "context_lines": "SELECT c_custkey, concat_ws(chr(10), 'Name: ' || c_name, CASE WHEN c_custkey % 5 <> 0 THEN 'Segment: ' || c_mktsegment END, 'Nation: ' || c_nationkey::VARCHAR) AS result FROM customer",
    "rotating_verbs": f"SELECT c_custkey, {sql_pick(dims.ENGAGEMENT_VERBS, 'c_custkey')} AS verb FROM customer",
    "report_clean": "SELECT p_partkey, " + _collapse("translate(p_name || ' — a  –  b' || chr(10) || p_size::VARCHAR, '—–', '--')") + " AS result FROM part",
    "sector_stats": f"SELECT count_if(trim({sql_pick(LABELS, 'c_custkey')}) = '')::BIGINT AS blank, count_if(trim({sql_pick(LABELS, 'c_custkey')}) <> '')::BIGINT AS filled, count(DISTINCT nullif(trim({sql_pick(LABELS, 'c_custkey')}), '')) AS labels, count(c_mktsegment) AS segments FROM customer",
}
