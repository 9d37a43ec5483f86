"""The pipeline's stages, and each query that has SQL, over the smallest tables."""

import zlib

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from pairforge.llm import queries
from pairforge.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def test_stages_work_on_what_the_one_before_kept(spark):
    docs = table(spark, SF, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, SF), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in last.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert corpus_pipeline.run(spark, SF).select(key).exceptAll(last.select(key)).isEmpty()


def test_run_equals_brute_force(spark):
    """All five stages over the smallest tables in plain Python, but for the fitted scores."""
    import public_tokenizers
    import xxhash
    from tokenizers import Tokenizer

    from pairforge.llm.packing import lengths
    from tests.llm.test_search import _brute_match
    from tests.llm.test_spans import brute_words

    good = {r.doc_id for r in queries.QUERIES["op4_quality_classifier"](spark, SF).filter("predicted = 1").collect()}
    docs = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect() if r.doc_id in good)

    def fingerprint(text):
        w = (text or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(len(w) - 2, 1))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {i: fingerprint(x) for i, x in docs}
    root = {i: i for i in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in fp:
        for j in fp:
            if i < j and (fp[i] ^ fp[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    docs = [(i, x) for i, x in docs if find(i) == i]
    cut = brute_words(docs, 50)
    docs = [(i, cut[i][2] if cut[i][1] else x) for i, x in docs if not cut[i][1] or cut[i][1] < cut[i][0]]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    leaked = {r[0] for r in _brute_match(docs, items, 10) if r[2]}
    docs = [(i, x) for i, x in docs if i not in leaked]
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    want = []
    for i, x in docs:
        ids = [*tokenizer.encode(x or "", add_special_tokens=False).ids, 2]
        at = 0
        for n in lengths(len(ids)):
            want.append((i, at, n, zlib.crc32(b"".join(k.to_bytes(4, "little") for k in ids[at : at + n])), len(ids)))
            at += n
    got = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_stages_take_an_empty_table(spark, none):
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, none, SF).count() == 0


def test_stages_keep_columns_that_are_named_like_results(spark, odd):
    """Nulls, empty texts, repeated rows, ties, and further columns named like results: values stay as they are."""
    names = [c for c in odd.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    whole = sorted(((r.doc_id, r.text) for r in odd.collect()), key=str)
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, odd, SF)
        assert out.columns == odd.columns and out.schema["n_chars"].dataType == odd.schema["n_chars"].dataType
        rows = out.collect()
        assert all(r[c] == "clash" for r in rows for c in names), name
        if name in ("quality_classifier", "benchmark_decontamination"):
            assert {(r.doc_id, r.text) for r in rows} <= set(whole)
    got = corpus_pipeline.substring_dedup_stage(spark, odd, SF).collect()
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got if r.doc_id in (1, 2)) == [(1, "a b c " * 40, 240)] * 2  # 2 repeats 1 whole
    assert {r.doc_id for r in corpus_pipeline.benchmark_decontamination(spark, odd, SF).collect()} == {1, 2, 3, 4, 5, 6, 7, None}
    got = [r.doc_id for r in corpus_pipeline.simhash_dedup(spark, odd, SF).collect()]
    assert sorted(i for i in got if i is not None) == [1, 1, 3, 6, 7]  # 3, 4 and 5 have no word; 2 equals 1


def test_stages_work_without_the_other_columns(spark, odd):
    docs = odd.select("doc_id", "text")
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, SF).columns == ["doc_id", "text"], name


def _rows(df):
    return sorted(map(str, df[sorted(df.columns)].astype(object).where(pd.notna(df), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert _rows(queries.QUERIES[name](spark, SF).toPandas()) == _rows(con.sql(queries.SQL[name]).df())
