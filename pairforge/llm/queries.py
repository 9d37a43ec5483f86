"""The registered queries of the training-data operators, and their DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm import balanced_sharding, chat_formatting, clustered_layout, decontamination, language_id, mcd_quality, packing, quality_rules_model, simhash, site_style_tree, substring_dedup, suffix_dedup, token_alignment
from pairforge.llm.common import stage, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    out = language_id.predict(docs, model)
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.match(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.size("near").cast("long").alias("n_near"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~language_id.held_out(F.col("doc_id")))
    out = quality_rules_model.score(docs, quality_rules_model.fit(docs, labels))
    predicted = (F.col("score") >= quality_rules_model.THRESHOLD).cast("int").alias("predicted")
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style_tree.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = packing.pack(table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mcd_quality.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *mcd_quality.STATISTICS, "base_failed", "kept")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_formatting.format_conversations(table(spark, sf_dir, "conversations"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), short=suffix_dedup.LEAST)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = token_alignment.aligned(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model")))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    rows = stage(out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "links"), "aligned")
    return token_alignment.with_counts(rows).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = balanced_sharding.sharded(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_clustered_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimensions = clustered_layout.document_dimensions()
    laid = clustered_layout.layout(table(spark, sf_dir, "documents"), dimensions)
    bounds = F.concat_ws(",", *[f"{side}{k}" for k in range(len(dimensions)) for side in ("lo", "hi")]).alias("file_bounds")
    out = clustered_layout.with_queries(laid, dimensions)
    return out.select("doc_id", "z", "position", "file", "files_touched", "files_matching", bounds)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), k AS (
  SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS key
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM d WHERE len(ws) >= 50)
), least AS (
  SELECT key, min(doc_id) AS lo FROM k GROUP BY key HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM k JOIN least USING (key) WHERE lo < doc_id
), w AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS q FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS t
  FROM w ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[p:p + 9], ' ') AS key
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM b WHERE len(ws) > 0)
), places AS (
  SELECT doc_id, m, p, array_to_string(ws[p:p + m - 1], ' ') AS key
  FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT m FROM win) WHERE len(ws) >= m)
), hits AS (
  SELECT doc_id, item_id, m, p FROM places JOIN win USING (m, key)
), per AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id
), cov AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hits) GROUP BY doc_id
), tk AS (
  SELECT doc_id, unnest(ws) AS term, unnest(range(0, len(ws))) AS pos FROM d
), ph AS (
  SELECT DISTINCT ws[p:p + 9] AS w FROM (SELECT ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM b WHERE len(ws) > 0 AND item_id IS NOT NULL)
), pt AS (
  SELECT w, unnest(w) AS term, unnest(range(0, len(w))) AS o FROM ph
), df AS (
  SELECT term, count(*) AS df FROM tk GROUP BY term
), rk AS (
  SELECT w, list({'df': coalesce(df, 0), 'o': o, 'term': pt.term} ORDER BY coalesce(df, 0), o) AS r FROM pt LEFT JOIN df USING (term) GROUP BY w
), pk AS (
  SELECT w, r[1].term AS t1, r[1].o AS o1, coalesce(list_filter(r, lambda x: x.term <> r[1].term)[1], r[2]) AS s FROM rk WHERE r[1].df > 0
), ca AS (
  SELECT a.doc_id, w, a.pos - o1 AS start, min(abs(q.pos - (a.pos - o1 + s.o))) AS gap
  FROM pk JOIN tk a ON a.term = t1 JOIN tk q ON q.doc_id = a.doc_id AND q.term = s.term AND abs(q.pos - (a.pos - o1 + s.o)) <= 2 GROUP BY a.doc_id, w, a.pos - o1
  UNION ALL SELECT a.doc_id, w, a.pos - o1, 0 FROM pk JOIN tk a ON a.term = t1 WHERE s IS NULL
), nr AS (
  SELECT doc_id, count(*) AS n_near FROM ca JOIN d USING (doc_id) WHERE NOT (gap = 0 AND start >= 0 AND ws[start + 1:start + len(w)] = w) GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN nr USING (doc_id)
"""

OP8_SQL = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id
), once AS (
  SELECT min(conv_id) AS conv_id, turns, len(turns) AS n FROM c GROUP BY turns
), kept AS (
  SELECT a.* FROM once a WHERE NOT EXISTS (SELECT 1 FROM once b WHERE b.n > a.n AND b.turns[1] = a.turns[1] AND b.turns[1:a.n] = a.turns)
)
SELECT conv_id, n::BIGINT AS n_turns,
  array_to_string([('<|im_start|>' || replace(x.role, '<|', '<' || chr(8203) || '|') || chr(10) || replace(x.text, '<|', '<' || chr(8203) || '|') || '<|im_end|>' || chr(10)) for x in turns], '') AS rendered
FROM kept
"""

OP13_SQL = r"""
WITH bits AS (
  SELECT list(t ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
    FROM (SELECT unnest(range(0, 256))::BIGINT AS b))
), v AS (
  SELECT doc_id, source, lang, coalesce(strlen(text), -1) AS length,
    xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 365 AS date
  FROM documents, bits
), c AS (
  SELECT doc_id,
    (8 * (rank() OVER (ORDER BY source NULLS FIRST) - 1)) // (count(*) OVER ()) AS c0,
    (8 * (rank() OVER (ORDER BY lang NULLS FIRST) - 1)) // (count(*) OVER ()) AS c1,
    (8 * (rank() OVER (ORDER BY length NULLS FIRST) - 1)) // (count(*) OVER ()) AS c2,
    (8 * (rank() OVER (ORDER BY date NULLS FIRST) - 1)) // (count(*) OVER ()) AS c3
  FROM v
), z AS (
  SELECT *, (c0 >> 2 & 1) * 2048 + (c1 >> 2 & 1) * 1024 + (c2 >> 2 & 1) * 512 + (c3 >> 2 & 1) * 256 + (c0 >> 1 & 1) * 128 + (c1 >> 1 & 1) * 64
    + (c2 >> 1 & 1) * 32 + (c3 >> 1 & 1) * 16 + (c0 >> 0 & 1) * 8 + (c1 >> 0 & 1) * 4 + (c2 >> 0 & 1) * 2 + (c3 >> 0 & 1) * 1 AS z FROM c
), p AS (
  SELECT *, row_number() OVER (ORDER BY z, doc_id NULLS FIRST) - 1 AS position FROM z
), f AS (
  SELECT *, position // 1000 AS file FROM p
), bounds AS (
  SELECT file, min(c0) AS l0, max(c0) AS h0, min(c1) AS l1, max(c1) AS h1, min(c2) AS l2, max(c2) AS h2, min(c3) AS l3, max(c3) AS h3 FROM f GROUP BY file
), q AS (
  SELECT DISTINCT z, c0, c1, c2, c3 FROM f
), touched AS (
  SELECT z, count(*) AS n FROM q JOIN bounds ON c0 BETWEEN l0 AND h0 AND c1 BETWEEN l1 AND h1 AND l2 <= c2 + 1 AND h2 >= c2 - 1 AND l3 <= c3 + 1 AND h3 >= c3 - 1 GROUP BY z
), matching AS (
  SELECT q.z, count(DISTINCT e.file) AS n FROM q JOIN (SELECT DISTINCT file, c0, c1, c2, c3 FROM f) e
    ON e.c0 = q.c0 AND e.c1 = q.c1 AND e.c2 BETWEEN q.c2 - 1 AND q.c2 + 1 AND e.c3 BETWEEN q.c3 - 1 AND q.c3 + 1 GROUP BY q.z
)
SELECT doc_id, z::BIGINT AS z, position::BIGINT AS position, f.file::BIGINT AS file, touched.n AS files_touched, matching.n AS files_matching,
  concat_ws(',', l0, h0, l1, h1, l2, h2, l3, h3) AS file_bounds
FROM f JOIN bounds USING (file) JOIN touched USING (z) JOIN matching USING (z)
"""


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_html_extraction": op5_html_extraction,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_sharding": op12_sharding,
    "op13_clustered_layout": op13_clustered_layout,
}

SQL: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op3_decontamination": OP3_SQL,
    "op8_chat_formatting": OP8_SQL,
    "op13_clustered_layout": OP13_SQL,
}
