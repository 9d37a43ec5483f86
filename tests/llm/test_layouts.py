"""Token alignment, sharding and the clustered layout against brute force."""

import random
import zlib
from collections import Counter
from itertools import product

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairforge.llm import balanced_sharding, clustered_layout, queries, token_alignment
from pairforge.llm.common import stage

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
A, B = str(P.path("byte_bpe_50k.json")), str(P.path("piece_bpe_32k.model"))
ODD_TEXTS = [
    None, "", " ", "  ", "\n", " \n x", "a  b", "a\n\n b ", "x\ty", "a b c", "naïve Straße — “q” 日本語 <|endoftext|> </s> <0x41> it's I'LL don't", "a▁b", "ﬁ x", "a\r\nb", "trail  ",
    "t\x1cu", "\x00 a", "x" * 5000, "'s 's a's", "é ​ z", "word " * 3000,
]


def tokenizers():
    with open(A) as f, open(B, "rb") as g:
        return token_alignment._Tokenizers(f.read(), g.read())


def groups_and_links(t, text, linked="end"):
    """(tokens of A, of B, groups, their string, links) by comparing every pair of tokens."""
    if not text:
        return 0, 0, 0, "", []
    a, b = t.a.encode(" " + text, add_special_tokens=False).ids, t.b.encode(text)
    if not b"".join(t.bytes_a[i] for i in a) == (" " + text).encode() == b"".join(t.bytes_b[i] for i in b):
        return 0, 0, 0, "", []
    ends = [np.cumsum([len(of[i]) for i in ids]).tolist() for ids, of in ((a, t.bytes_a), (b, t.bytes_b))]
    common, lo, out = sorted({*ends[0]} & {*ends[1]}), [0, 0], []
    for c in common:
        hi = [e.index(c) + 1 for e in ends]
        out.append("|".join(",".join(map(str, ids[x:y])) for ids, x, y in zip((a, b), lo, hi)))
        lo = hi
    begin = [[0, *e[:-1]] for e in ends]
    if linked == "end":
        at = {e: k for k, e in enumerate(ends[1])}
        links = [(x, b[at[e]]) for x, e in zip(a, ends[0]) if e in at]
    else:
        links = [(a[i], b[j]) for i, j in product(range(len(a)), range(len(b))) if begin[0][i] < ends[1][j] and begin[1][j] < ends[0][i]]
    return len(a), len(b), len(common), ";".join(out), links


@pytest.mark.parametrize("linked", ["end", "overlap"])
def test_alignment_kernel_equals_brute_force(linked):
    t = tokenizers()
    assert t.cuts and t.ranks is not None
    rng = random.Random(1)
    texts = ODD_TEXTS[:-1] + ["".join(rng.choice("ab '\n\t .,A9é▁ 　日s") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    texts += pd.read_parquet(f"{SF}/documents.parquet").text.str[:400].head(60).tolist()
    if linked == "overlap":
        texts = [x and x[:300] for x in texts]
    aligner = token_alignment._Aligner(t, linked)
    for x, got in zip(texts, aligner.documents(texts), strict=True):
        links = [tuple(p) for p in np.frombuffer(got[4], aligner.type).reshape(-1, 2).tolist()]
        assert (*got[:4], links) == groups_and_links(t, x, linked), repr(x)[:80]


def test_alignment_counts_over_the_corpus(spark):
    docs = spark.createDataFrame([(k % 17, x) for k, x in enumerate(ODD_TEXTS)] + [(None, "the same"), (5, "the same"), (5, "the same")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("clash") for c in ("n_a", "links", "groups", "pair", "n")}).repartition(3)
    rows = stage(token_alignment.aligned(docs, A, B), "aligned")
    t = tokenizers()
    want = [(r.doc_id, groups_and_links(t, r.text)) for r in docs.collect()]
    count = Counter(p for _, w in want for p in w[4])
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(highest.get(b, 0), n)
    want = sorted(((str(i), *w[:4], len(w[4]), sum(count[p] == highest[p[1]] for p in w[4]), sum(count[p] for p in w[4])) for i, w in want))
    for most in (token_alignment.BROADCAST_PAIRS, 3):  # the second goes by a Spark join
        got = token_alignment.with_counts(rows, broadcast_pairs=most).collect()
        assert sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.groups, r.n_links, r.n_best, r.count_sum) for r in got) == want
    assert token_alignment.with_counts(stage(token_alignment.aligned(docs.limit(0), A, B), "none")).count() == 0


def check_shards(rows, shards):
    """Counts differ by one at most, slots are gapless."""
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert set(by) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_sharding_of_the_fixture(spark):
    out = queries.op12_sharding(spark, SF).collect()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    text = docs.set_index("doc_id").text.fillna("")
    assert sorted(r.doc_id for r in out) == sorted(docs.doc_id)
    assert all(r["size"] == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.law == "rows" and r.grown_shard is None for r in out)
    check_shards(out, 24)


@pytest.mark.parametrize("hot, copies, free", [(0, 40, 500), (400, 60, 300), (0, 400, 0), (900, 0, 0), (7, 3, 2), (0, 0, 5)])
def test_sharding_keeps_groups_together(spark, hot, copies, free):
    rows = [(k, "hot") for k in range(hot)] + [(10_000 + k, f"copy {k // 3}") for k in range(copies)] + [(20_000 + k, f"free {k}") for k in range(free)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = balanced_sharding.sharded(df, shards=6)
    out = got.collect()
    check_shards(out, 6)
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in rows)
    cut = balanced_sharding.divided(got).first()
    by_hash = Counter((x, random.Random(i).randrange(6)) for i, x in rows)
    cut_by_hash = sum(n - max(c for (y, _), c in by_hash.items() if y == x) for x, n in Counter(x for _, x in rows).items() if n > 1)
    if len(rows) > 100:
        # all but a few groups at the borders stay whole; a group of several shards' size is spread over few
        small = [x for x, n in Counter(x for _, x in rows).items() if 1 < n <= 3]
        shards_of = {}
        for r in out:
            shards_of.setdefault(r.grp, set()).add(r.shard)
        sizes = Counter(r.grp for r in out)
        torn = sum(len(v) > 1 for g, v in shards_of.items() if sizes[g] <= 3)
        assert torn <= max(0.2 * len(small), 6)
        assert not small or cut["cut"] < 0.5 * cut_by_hash + hot


def test_sharding_of_odd_rows(spark, odd, none):
    got = balanced_sharding.sharded(odd.withColumns({c: F.lit("clash") for c in ("grp", "row", "shard", "slot", "size")})).collect()
    check_shards(got, 24)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd.collect())
    assert all(r["size"] == 8 and r.text_crc32 == 0 for r in got if r.doc_id in (3, 4))
    assert balanced_sharding.sharded(none).count() == 0


def layout_of(rows, cells=8, per_file=1000):
    """The layout of (doc_id, text, lang, source) rows, by counting."""
    def key(v):
        return (v is not None, v.encode() if isinstance(v, str) else v if v is not None else 0)

    values = [(s, lang, -1 if t is None else len(t.encode()), None if i is None else zlib.crc32(str(i).encode()) % 365) for i, t, lang, s in rows]
    n, coordinates = len(rows), []
    for d in range(4):
        held = sorted(key(v[d]) for v in values)
        coordinates.append([cells * held.index(key(v[d])) // n for v in values])
    bits = cells.bit_length() - 1
    z = [sum((coordinates[d][k] >> b & 1) << (4 * b + 3 - d) for b in range(bits) for d in range(4)) for k in range(n)]
    c = list(zip(*coordinates, strict=True))
    order = sorted(range(n), key=lambda k: (z[k], key(rows[k][0])))
    file = {k: p // per_file for p, k in enumerate(order)}
    members = {}
    for k, f in file.items():
        members.setdefault(f, []).append(c[k])
    bounds = {f: [(min(x[d] for x in m), max(x[d] for x in m)) for d in range(4)] for f, m in members.items()}
    reach = (0, 0, 1, 1)
    out = []
    for p, k in enumerate(order):
        touched = sum(all(lo - r <= x <= hi + r for x, r, (lo, hi) in zip(c[k], reach, b)) for b in bounds.values())
        matching = sum(any(all(abs(x - y) <= r for x, y, r in zip(c[k], m, reach)) for m in ms) for ms in members.values())
        out.append((str(rows[k][0]), z[k], p, file[k], touched, matching, ",".join(f"{lo},{hi}" for lo, hi in bounds[file[k]])))
    return out


def laid_out(df, per_file):
    dims = clustered_layout.document_dimensions()
    out = clustered_layout.with_queries(clustered_layout.layout(df, dims, file_rows=per_file), dims)
    bounds = F.concat_ws(",", *[f"{s}{k}" for k in range(4) for s in ("lo", "hi")])
    return sorted((tuple(r) for r in out.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("None")), "z", "position", "file", "files_touched", "files_matching", bounds).collect()), key=lambda r: r[2])


def test_layout_equals_brute_force(spark, odd, none):
    rng = random.Random(4)
    rows = [(k, "x" * rng.choice([0, 5, 5, 5, 9, 40]), rng.choice([None, "en", "en", "en", "dé", "z"]), rng.choice(["hot"] * 5 + ["a", "é", None, ""])) for k in range(600)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({c: F.lit("clash") for c in ("z", "row", "file", "key", "v0", "c0")}).repartition(5)
    assert laid_out(df, 25) == layout_of(rows, per_file=25)
    got, want = laid_out(odd, 3), layout_of([(r.doc_id, r.text, r.lang, r.source) for r in odd.collect()], per_file=3)
    assert [x[:4] for x in got] == [x[:4] for x in want]
    assert laid_out(none, 10) == []


def test_layout_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.SQL["op13_clustered_layout"]).df()
    got = queries.op13_clustered_layout(spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert got[columns].sort_values("position").astype(str).values.tolist() == want[columns].sort_values("position").astype(str).values.tolist()


def test_layout_files_hold_their_rows(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    laid = clustered_layout.layout(df, clustered_layout.document_dimensions(), file_rows=50)
    clustered_layout.write_files(df, laid, str(tmp_path / "files"))
    back = spark.read.parquet(str(tmp_path / "files")).groupBy("file").agg(F.count("*").alias("n"), F.min("position").alias("lo"), F.max("position").alias("hi")).collect()
    assert all(r.n == 50 or r.file == max(x.file for x in back) for r in back) and all(r.lo // 50 == r.hi // 50 == r.file for r in back)
