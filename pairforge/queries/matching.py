"""Vocabulary, evidence and similarity over document x benchmark pairs, and vectors over embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions import arrays as A
from pairforge.functions.text import preprocess, static_tokens
from pairforge.operators import assignment as G
from pairforge.operators import matching_text as M
from pairforge.operators import similarity as Z
from pairforge.operators import vocabulary as V
from pairforge.operators.postings import Part
from pairforge.plans.ranked_matches import evidence_of_pairs, ranked_matches, shared_terms
from pairforge.queries.base import COMPANIES_SQL, LANGS, OPPORTUNITIES_SQL, VOCAB_CTE, companies, opportunities, pick, pp, sql_list, sql_map, sql_pick, sql_text, t

S = SparkSession


def _vocab(s: S, d: str) -> DataFrame:
    c, o = companies(s, d), opportunities(s, d)
    corpus = c.select(F.concat(F.lit("c"), F.col("cid").cast("string")).alias("key"), "text").union(o.select(F.concat(F.lit("o"), F.col("oid").cast("string")), "text"))
    return V.vocabulary(corpus, V.protected_terms(o), V.token_rows(o, "oid", "text").select("token"))


def vocabulary(s: S, d: str) -> DataFrame:
    return _vocab(s, d).select("token", "cnt", F.round("idf", 6).alias("idf"), F.round("doc_ratio", 6).alias("doc_ratio"), "is_common", "is_protected", "is_domain")


def document_frequency(s: S, d: str) -> DataFrame:
    return V.token_rows(companies(s, d), "cid", "text").groupBy("token").agg(F.count("*").alias("cnt"))


def common_tokens(s: S, d: str) -> DataFrame:
    return _vocab(s, d).filter("is_common").select("token", "cnt")


def _terms(s: S, d: str) -> DataFrame:
    return shared_terms(companies(s, d), opportunities(s, d))


def evidence_terms(s: S, d: str) -> DataFrame:
    return _terms(s, d).select("cid", "oid", "token", "strict")


def evidence_score(s: S, d: str) -> DataFrame:
    return evidence_of_pairs(companies(s, d), opportunities(s, d)).select("cid", "oid", "n_terms", F.round("evidence_score", 6).alias("evidence_score"), F.array_join("terms", " ").alias("terms"))


def g1_terms(s: S, d: str) -> DataFrame:
    return V.g1_terms(_terms(s, d)).select("cid", "oid", F.array_join("terms", " ").alias("terms"))


def ranked(s: S, d: str) -> DataFrame:
    return ranked_matches(companies(s, d), opportunities(s, d))


def _tfidf(s: S, d: str, *parts: Part) -> DataFrame:
    docs = companies(s, d).select(F.lit("c").alias("side"), F.col("cid").alias("id"), "text").union(opportunities(s, d).select(F.lit("o"), "oid", "text"))
    return Z.tfidf_cosines(docs, "o", parts).select("cid", "oid", F.round("cosine", 6).alias("cosine"))


def tfidf_word(s: S, d: str) -> DataFrame:
    return _tfidf(s, d, Part(sublinear=False))


def sparse_score(s: S, d: str) -> DataFrame:
    return _tfidf(s, d, Part(max_df=0.95))


def tfidf_hybrid(s: S, d: str) -> DataFrame:
    return _tfidf(s, d, *Z.HYBRID)


def _vectors(s: S, d: str) -> tuple[DataFrame, DataFrame]:
    e = t(s, d, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    return e.filter("vec_id % 10 <> 0").select(F.col("vec_id").alias("cid"), F.col("v").alias("a"), "label"), e.filter("vec_id % 10 = 0").select(F.col("vec_id").alias("oid"), F.col("v").alias("b"))


def _cosines(s: S, d: str) -> DataFrame:
    a, b = _vectors(s, d)
    return Z.dense_cosine(a, b).withColumn("cosine", F.round("cosine", 9))


def cosine_dense(s: S, d: str) -> DataFrame:
    return _cosines(s, d)


def _with_focus(s: S, d: str) -> tuple[DataFrame, DataFrame]:
    """Left vectors with a second one of the focused text (here the reverse), mixed at the fixed share."""
    a, b = _vectors(s, d)
    return a.withColumn("f", Z.blended(F.col("a"), F.reverse("a"), dims.EMBED_FOCUS_BLEND)), b


def focus_blend(s: S, d: str) -> DataFrame:
    return Z.dense_cosines(*_with_focus(s, d), {"cosine": "f"}).withColumn("cosine", F.round("cosine", 9))


def _nearest(share: Column, digits: int) -> Column:
    """A share in [0, 1] rounded half up, without the decimals of ``round``."""
    return F.floor(share * 10.0**digits + 0.5) / 10.0**digits


def percentile_rank(s: S, d: str) -> DataFrame:
    return Z.percentiles_of_vectors(*_vectors(s, d), ["pct"]).select("cid", "oid", _nearest(F.col("pct"), 9).alias("pct"))


def specificity(s: S, d: str) -> DataFrame:
    """0.65 of the percentile of the cosine and 0.35 of that of its excess over the company's mean."""
    p = Z.percentiles_of_vectors(*_vectors(s, d), ["p1", "p2"])
    return p.select("cid", "oid", _nearest((1 - dims.SPECIFICITY_BLEND) * F.col("p1") + dims.SPECIFICITY_BLEND * F.col("p2"), 6).alias("semantic"))


def _rhos(s: S, d: str) -> DataFrame:
    return Z.spearman_of_vectors(*_with_focus(s, d), ("a", "f"))


def spearman(s: S, d: str) -> DataFrame:
    return _rhos(s, d).select("cid", F.round("rho", 6).alias("rho"))


def spearman_by_label(s: S, d: str) -> DataFrame:
    a, _ = _vectors(s, d)
    r = _rhos(s, d).join(a.select("cid", "label"), "cid")
    return r.groupBy("label").agg(F.round(F.avg("rho"), 6).alias("mean"), F.round(F.min("rho"), 6).alias("min"), F.count("*").alias("n"))


def separation(s: S, d: str) -> DataFrame:
    return Z.separation_of_vectors(*_vectors(s, d)).select("cid", F.round("separation", 6).alias("separation"))


def jaccard(s: S, d: str) -> DataFrame:
    """Sets of different words of neighbouring documents (ids k and k + 1)."""
    w = companies(s, d).select("cid", static_tokens(F.col("text")).alias("w"))
    n = w.select((F.col("cid") - 1).alias("cid"), F.col("w").alias("v"))
    return w.join(n, "cid").select("cid", F.round(A.jaccard(F.col("w"), F.col("v")), 6).alias("jaccard"))


def entity_resolution(s: S, d: str) -> DataFrame:
    """One document for each normalised text: the longest, the least id on ties, and how many merged."""
    k = companies(s, d).select("cid", F.md5(preprocess(F.col("text")).cast("binary")).alias("k"), F.length("text").alias("n"))
    return k.groupBy("k").agg(F.min_by("cid", F.struct(-F.col("n"), "cid")).alias("cid"), F.count("*").alias("merged")).select("cid", "merged")


PHRASES = ["therhean", "the and", "onthin ation", "x", "  ", "erentily ndsh"]


def _phrased(s: S, d: str) -> DataFrame:
    return companies(s, d).select("cid", "text", F.array(*[F.lit(p) for p in PHRASES]).alias("phrases"))


def keyword_match(s: S, d: str) -> DataFrame:
    return M.keyword_hits(_phrased(s, d), "phrases", "text").select("cid", F.col("hits").cast("long").alias("hits"))


def keyword_match_plain(s: S, d: str) -> DataFrame:
    return M.keyword_hits(_phrased(s, d), "phrases", "text", stemmed=False).select("cid", F.col("hits").cast("long").alias("hits"))


RAW = ["Pharma & Biotech", "oil and gas", "PHARMA", "renewable energy", "gas", "Healthcare and life", "chemicals plant", "", "ict", "Chemical Manufacturing and more"]
ALLOWED = ["Pharma & Biotech", "Oil and Gas", "Healthcare and Life Sciences", "Chemical Manufacturing", "Information and Communication Technology", "Renewable Energy Semiconductor Manufacturing"]


def adjacent_label(s: S, d: str) -> DataFrame:
    raw = t(s, d, "customer").select(F.col("c_custkey").alias("id"), pick(RAW, F.col("c_custkey")).alias("raw"))
    return M.adjacent_label(raw, s.createDataFrame([(x,) for x in ALLOWED], "label string"))


ONTOLOGY = {"CleanTech": ["WaterTech", "Desalination", "Renewable Energy"], "ICT": ["ICT Hardware", "Telecom & Networks", "5G"], "Energy": ["Renewable Energy", "Oil and Gas"], "Telecom and Networks": ["5G", "Fiber"]}
ONTOLOGY_LABELS = [*ONTOLOGY, "Mining", "oil & gas"]


def _bags(df: DataFrame, label) -> DataFrame:
    m = F.create_map(*[x for k, v in ONTOLOGY.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    none = F.array().cast("array<string>")
    entry = F.struct(F.col("label").alias("canonical"), none.alias("synonyms"), F.try_element_at(m, F.col("label")).alias("sub_domains"), none.alias("adjacent_domains"))
    return df.withColumn("label", label).withColumn("bag", M.ontology_bag(F.col("label"), entry))


def ontology_overlap(s: S, d: str) -> DataFrame:
    a = _bags(t(s, d, "supplier").select(F.col("s_suppkey").alias("cid")), pick(ONTOLOGY_LABELS, F.col("cid")))
    b = _bags(t(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("oid")), pick(ONTOLOGY_LABELS, F.col("oid") * 5 + 1))
    return M.ontology_overlap(a, b)


def email_enrichment(s: S, d: str) -> DataFrame:
    """Customers without an e-mail of their own take those of suppliers with the same derived name."""
    c, p = F.col("c_custkey"), F.col("s_suppkey")
    context = F.when(c % 3 == 0, F.concat(F.lit("mail me: Info"), c.cast("string"), F.lit("@Example.COM."))).otherwise(F.lit("none"))
    targets = t(s, d, "customer").select(c.alias("id"), F.concat(F.lit("Name-"), (c % 40).cast("string")).alias("name"), context.alias("context"))
    sources = t(s, d, "supplier").select(p.alias("sid"), F.concat(F.lit("name "), (p % 50).cast("string")).alias("name"), F.when(p % 4 != 0, F.concat(F.lit("s"), p.cast("string"), F.lit("@example.org"))).otherwise("").alias("email"))
    return M.email_from_rows(targets, sources, "name", "context")


def ordered_assignment(s: S, d: str) -> DataFrame:
    """Suppliers in their order take the first free customer under the first of their three keys that has one."""
    c, p = F.col("c_custkey"), F.col("s_suppkey")
    word = lambda w, k: F.concat(F.lit(w), k.cast("string"))
    targets = t(s, d, "customer").select(c.alias("target"), F.array(word("name ", c % 40), word("slug ", c % 60)).alias("keys"))
    sources = t(s, d, "supplier").select(p.alias("source"), F.array(word("name ", p % 5 + 38), word("slug ", p * 7 % 70), word("name ", p % 3)).alias("keys"))
    return G.assigned(sources, targets)


QUERIES = {
    "ordered_assignment": ordered_assignment, "ranked_matches": ranked, "vocabulary": vocabulary, "document_frequency": document_frequency, "common_tokens": common_tokens, "evidence_terms": evidence_terms,
    "evidence_score": evidence_score, "g1_terms": g1_terms, "tfidf_word": tfidf_word, "sparse_score": sparse_score, "tfidf_hybrid": tfidf_hybrid, "cosine_dense": cosine_dense,
    "focus_blend": focus_blend, "percentile_rank": percentile_rank, "specificity": specificity, "spearman": spearman, "spearman_by_label": spearman_by_label, "separation": separation,
    "jaccard": jaccard, "entity_resolution": entity_resolution, "keyword_match": keyword_match, "keyword_match_plain": keyword_match_plain, "adjacent_label": adjacent_label,
    "ontology_overlap": ontology_overlap, "email_enrichment": email_enrichment,
}


_w = dims.WEIGHTS_G3
RANKED_SQL = f"""
WITH {VOCAB_CTE},
sc AS (
  SELECT e.cid, e.oid, e.n_terms, round(e.evidence_score + 1e-9, 6) AS evidence, CASE WHEN c.sector = o.sector THEN 1.0 ELSE 0.0 END AS sector
  FROM evidence e JOIN co c USING (cid) JOIN op o USING (oid) WHERE e.n_terms >= {dims.MIN_EVIDENCE_TERMS}
),
p AS (SELECT *, (row_number() OVER (ORDER BY evidence, cid, oid) - 1) / greatest(1, count(*) OVER () - 1) AS pct FROM sc),
f AS (SELECT *, round({_w['profile'] + _w['product']} * pct + {_w['sector']} * sector + {_w['evidence']} * evidence + 1e-9, 6) AS final FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY final DESC, cid) AS rank FROM f)
SELECT oid, cid, rank::INT AS rank, n_terms, round(evidence + 1e-9, 4) AS evidence, sector, round(final + 1e-9, 4) AS final FROM r WHERE rank <= 3
"""


def _grams_sql(sublinear: bool, max_df: float) -> str:
    tf = "1 + ln(tf)" if sublinear else "tf::DOUBLE"
    return f"""
WITH d AS (SELECT 'c' || doc_id AS key, text FROM documents UNION ALL SELECT 'o' || item_id, text FROM benchmark),
w AS (SELECT key, list_filter(string_split({pp('text')}, ' '), lambda x: length(x) >= 2) AS w FROM d),
g AS (SELECT key, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) AS gram FROM w),
c AS (SELECT key, gram, count(*) AS tf FROM g GROUP BY ALL),
n AS (SELECT count(*) AS n FROM d),
df AS (SELECT gram, count(*) AS df FROM c GROUP BY gram),
raw AS (SELECT key, gram, ({tf}) * (ln((1 + n) / (1 + df)) + 1) AS w FROM c JOIN df USING (gram), n WHERE df <= {max_df} * n),
z AS (SELECT key, sqrt(sum(w * w)) AS z FROM raw GROUP BY key),
v AS (SELECT key, gram, w / z AS w FROM raw JOIN z USING (key))
SELECT a.key[2:]::BIGINT AS cid, b.key[2:]::BIGINT AS oid, round(sum(a.w * b.w), 6) AS cosine
FROM v a JOIN v b USING (gram) WHERE a.key[1] = 'c' AND b.key[1] = 'o' GROUP BY a.key, b.key
"""


HYBRID_SQL = f"""
WITH d AS (SELECT 'c' || doc_id AS key, text FROM documents UNION ALL SELECT 'o' || item_id, text FROM benchmark),
n AS (SELECT count(*) AS n FROM d),
w AS (SELECT key, list_filter(string_split({pp('text')}, ' '), lambda x: x <> '') AS w FROM d),
l AS (SELECT key, list_filter(w, lambda x: length(x) >= 2) AS w FROM w),
g AS (
  SELECT key, 'w' AS kind, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) AS gram FROM l
  UNION ALL
  SELECT key, 'c', p[i:i + k - 1] FROM (SELECT key, p, k, unnest(range(1, length(p) - k + 2)) AS i FROM (SELECT key, ' ' || unnest(w) || ' ' AS p FROM w) CROSS JOIN (SELECT unnest([3, 4, 5]) AS k) WHERE length(p) >= k)
),
c AS (SELECT key, kind, gram, count(*) AS tf FROM g GROUP BY ALL),
df AS (SELECT kind, gram, count(*) AS df FROM c GROUP BY ALL),
raw AS (SELECT key, kind, gram, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w FROM c JOIN df USING (kind, gram), n WHERE df >= CASE kind WHEN 'c' THEN 2 ELSE 1 END),
z AS (SELECT key, kind, sqrt(sum(w * w)) / (CASE WHEN kind = 'c' THEN 0.5 ELSE 1.0 END) AS z FROM raw GROUP BY key, kind),
v AS (SELECT key, kind, gram, w / z AS w FROM raw JOIN z USING (key, kind))
SELECT a.key[2:]::BIGINT AS cid, b.key[2:]::BIGINT AS oid, round(sum(a.w * b.w), 6) AS cosine
FROM v a JOIN v b USING (kind, gram) WHERE a.key[1] = 'c' AND b.key[1] = 'o' GROUP BY a.key, b.key
"""

COSINE = """
e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS z FROM embeddings),
cs AS (SELECT a.vec_id AS cid, b.vec_id AS oid, a.label AS label, round(list_dot_product(a.v, b.v) / (greatest(a.z, 1e-12) * greatest(b.z, 1e-12)), 9) AS cosine
  FROM e a JOIN e b ON a.vec_id % 10 <> 0 AND b.vec_id % 10 = 0)
"""
_b = dims.EMBED_FOCUS_BLEND
BLEND = f"""
bl AS (SELECT vec_id, [{1 - _b} * v[i] / greatest(z, 1e-12) + {_b} * v[len(v) + 1 - i] / greatest(z, 1e-12) for i in range(1, len(v) + 1)] AS v FROM e WHERE vec_id % 10 <> 0),
bs AS (SELECT a.vec_id AS cid, b.vec_id AS oid, round(list_dot_product(a.v, b.v) / (greatest(sqrt(list_dot_product(a.v, a.v)), 1e-12) * greatest(b.z, 1e-12)), 9) AS cosine
  FROM bl a JOIN e b ON b.vec_id % 10 = 0)
"""
SPEARMAN = f"""
WITH {COSINE}, {BLEND},
j AS (SELECT cs.cid, cs.label, cs.cosine AS x, bs.cosine AS y FROM cs JOIN bs USING (cid, oid)),
r AS (SELECT cid, label, rank() OVER (PARTITION BY cid ORDER BY x) + (count(*) OVER (PARTITION BY cid, x) - 1) / 2.0 AS a,
  rank() OVER (PARTITION BY cid ORDER BY y) + (count(*) OVER (PARTITION BY cid, y) - 1) / 2.0 AS b FROM j),
rho AS (SELECT cid, label, corr(a, b) AS rho FROM r GROUP BY cid, label)
"""
_phr = sql_list([p.strip() for p in PHRASES])
_words = "list_filter(regexp_extract_all(lower({x}), '([a-zA-Z][a-zA-Z0-9\\-]{{1,}})', 1), lambda w: length(w) > 2)"


def _bag_sql(label: str) -> str:
    m = "MAP {" + ", ".join(f"{sql_text(k)}: {sql_list(v)}" for k, v in ONTOLOGY.items()) + "}"
    return f"list_distinct([trim(replace({pp('x')}, ' and ', ' ')) for x in list_concat([{label}], coalesce({m}[{label}], []))])"


SQL = {
    "ordered_assignment": """
      WITH RECURSIVE s AS (SELECT row_number() OVER (ORDER BY s_suppkey) AS i, s_suppkey AS source, ['name ' || (s_suppkey % 5 + 38), 'slug ' || (s_suppkey * 7 % 70), 'name ' || (s_suppkey % 3)] AS keys FROM supplier),
      tk AS (SELECT c_custkey AS target, unnest(['name ' || (c_custkey % 40), 'slug ' || (c_custkey % 60)]) AS key FROM customer),
      g AS (
        SELECT 0::BIGINT AS i, NULL::BIGINT AS source, NULL::BIGINT AS target, NULL::VARCHAR AS key, []::BIGINT[] AS taken
        UNION ALL
        SELECT s.i, s.source, c.target, c.key, CASE WHEN c.target IS NULL THEN g.taken ELSE list_append(g.taken, c.target) END FROM g JOIN s ON s.i = g.i + 1 LEFT JOIN LATERAL (
          SELECT tk.target, tk.key FROM tk WHERE list_contains(s.keys, tk.key) AND NOT list_contains(g.taken, tk.target) ORDER BY list_position(s.keys, tk.key), tk.target LIMIT 1) c ON true)
      SELECT target, source, key FROM g WHERE target IS NOT NULL""",
    "ranked_matches": RANKED_SQL,
    "vocabulary": f"WITH {VOCAB_CTE} SELECT token, cnt, round(idf, 6) AS idf, round(doc_ratio, 6) AS doc_ratio, is_common, is_protected, is_domain FROM vocab",
    "document_frequency": f"WITH {VOCAB_CTE} SELECT token, count(*) AS cnt FROM ctok GROUP BY token",
    "common_tokens": f"WITH {VOCAB_CTE} SELECT token, cnt FROM vocab WHERE is_common",
    "evidence_terms": f"WITH {VOCAB_CTE} SELECT cid, oid, token, strict FROM ev",
    "evidence_score": f"WITH {VOCAB_CTE} SELECT cid, oid, n_terms, round(evidence_score, 6) AS evidence_score, array_to_string(terms, ' ') AS terms FROM evidence",
    "g1_terms": f"WITH {VOCAB_CTE} SELECT cid, oid, array_to_string((list(token ORDER BY -idf, -length(token), token))[1:5], ' ') AS terms FROM ev WHERE length(token) >= 4 AND NOT list_contains({sql_list(dims.EXPLANATION_BLACKLIST_G1)}, token) GROUP BY cid, oid",
    "tfidf_word": _grams_sql(False, 1.0), "sparse_score": _grams_sql(True, 0.95), "tfidf_hybrid": HYBRID_SQL,
    "cosine_dense": f"WITH {COSINE} SELECT cid, oid, cosine FROM cs",
    "focus_blend": f"WITH {COSINE}, {BLEND} SELECT cid, oid, cosine FROM bs",
    "percentile_rank": f"WITH {COSINE} SELECT cid, oid, round((row_number() OVER (ORDER BY cosine, cid, oid) - 1) / greatest(1, count(*) OVER () - 1), 9) AS pct FROM cs",
    "specificity": f"""WITH {COSINE}, x AS (SELECT cid, oid, cosine, round(cosine - avg(cosine) OVER (PARTITION BY cid), 8) AS excess FROM cs),
      p AS (SELECT cid, oid, (row_number() OVER (ORDER BY cosine, cid, oid) - 1) / greatest(1, count(*) OVER () - 1) AS p1, (row_number() OVER (ORDER BY excess, cid, oid) - 1) / greatest(1, count(*) OVER () - 1) AS p2 FROM x)
      SELECT cid, oid, round({1 - dims.SPECIFICITY_BLEND} * p1 + {dims.SPECIFICITY_BLEND} * p2, 6) AS semantic FROM p""",
    "spearman": SPEARMAN + "SELECT cid, round(rho, 6) AS rho FROM rho",
    "spearman_by_label": SPEARMAN + "SELECT label, round(avg(rho), 6) AS mean, round(min(rho), 6) AS min, count(*) AS n FROM rho GROUP BY label",
    "separation": f"WITH {COSINE}, r AS (SELECT cid, cosine, row_number() OVER (PARTITION BY cid ORDER BY cosine DESC, oid) AS r FROM cs) SELECT cid, round(avg(cosine) FILTER (WHERE r <= 3) - avg(cosine) FILTER (WHERE r > 3), 6) AS separation FROM r GROUP BY cid",
    "jaccard": f"WITH {VOCAB_CTE}, w AS (SELECT cid, list(token) AS w FROM ctok GROUP BY cid), a AS (SELECT co.cid, coalesce(w, []) AS w FROM co LEFT JOIN w USING (cid)) SELECT a.cid, round(coalesce(len(list_intersect(a.w, b.w)) / nullif(len(list_distinct(list_concat(a.w, b.w))), 0), 0.0), 6) AS jaccard FROM a JOIN a b ON b.cid = a.cid + 1",
    "entity_resolution": f"SELECT arg_min(cid, (-length(text), cid)) AS cid, count(*) AS merged FROM (SELECT doc_id AS cid, text, {pp('text')} AS k FROM documents) GROUP BY k",
    "keyword_match_plain": f"SELECT doc_id AS cid, len(list_filter(list_filter({_phr}, lambda p: length(p) >= 2), lambda p: contains(lower(text), lower(p)) OR (len({_words.format(x='p')}) > 0 AND len(list_filter({_words.format(x='p')}, lambda w: NOT contains(lower(text), w))) = 0)))::BIGINT AS hits FROM documents",
    "adjacent_label": f"""
      WITH r AS (SELECT c_custkey AS id, {sql_pick(RAW, 'c_custkey')} AS raw FROM customer), a AS (SELECT unnest({sql_list(ALLOWED)}) AS label),
      m AS (SELECT DISTINCT raw, trim(raw) AS s, lower(trim(raw)) AS low, {sql_map(dims.ADJACENT_ALIASES)}[lower(trim(raw))] AS alias FROM r),
      x AS (SELECT raw, s, low, alias, (SELECT max(label) FROM a WHERE label = s) AS e, (SELECT CASE WHEN count(*) = 1 THEN max(label) END FROM a WHERE lower(label) = low) AS c,
        (SELECT max(label) FROM a WHERE label = alias) AS al, (SELECT CASE WHEN count(*) = 1 THEN max(label) END FROM a WHERE length(low) >= 6 AND (contains(lower(label), low) OR contains(low, lower(label)))) AS u FROM m)
      SELECT id, raw, CASE WHEN s = '' THEN NULL ELSE coalesce(e, c, al, u) END AS resolved FROM r JOIN x USING (raw)""",
    "ontology_overlap": f"""
      WITH a AS (SELECT s_suppkey AS cid, {sql_pick(ONTOLOGY_LABELS, 's_suppkey')} AS label FROM supplier), b AS (SELECT n_nationkey::BIGINT AS oid, {sql_pick(ONTOLOGY_LABELS, 'n_nationkey * 5 + 1')} AS label FROM nation)
      SELECT cid, oid FROM (SELECT cid, {_bag_sql('label')} AS x FROM a) JOIN (SELECT oid, {_bag_sql('label')} AS y FROM b) ON list_has_any(x, y)""",
    "email_enrichment": """
      WITH c AS (SELECT c_custkey AS id, 'name ' || (c_custkey % 40) AS k, CASE WHEN c_custkey % 3 = 0 THEN 'info' || c_custkey || '@example.com' ELSE '' END AS own FROM customer),
      e AS (SELECT id, k, row_number() OVER (PARTITION BY k ORDER BY id) AS n FROM c WHERE own = ''),
      s AS (SELECT 'name ' || (s_suppkey % 50) AS k, 's' || s_suppkey || '@example.org' AS mail, row_number() OVER (PARTITION BY s_suppkey % 50 ORDER BY s_suppkey) AS n FROM supplier WHERE s_suppkey % 4 <> 0)
      SELECT id, own AS email, 'row' AS found FROM c WHERE own <> '' UNION ALL
      SELECT id, coalesce(mail, ''), CASE WHEN mail IS NULL THEN 'none' ELSE 'name' END FROM e LEFT JOIN s USING (k, n)""",
}
