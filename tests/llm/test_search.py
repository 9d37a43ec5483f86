"""Decontamination, quality rules, SimHash and components against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pairforge.llm import components, decontamination, mcd_quality, simhash

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _words(t):
    return _WORD.findall("".join(c.lower() if c.isascii() else c for c in (t or "")))


def _brute_match(docs, items, size):
    wins = {}
    for i, t in items:
        w = _words(t)
        for p in range(max(len(w) - size, 0) + 1) if w else ():
            wins.setdefault(tuple(w[p : p + size]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = _words(t), set(), set()
        for m in {len(k) for k in wins}:
            for p in range(len(w) - m + 1):
                if ids := wins.get(tuple(w[p : p + m])):
                    hit.update(range(p, p + m))
                    found |= ids
        out.append((d, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_decontamination_equals_brute_force(spark, broadcast_rows):
    rng = random.Random(3)
    vocab = ["the", "of", "Ab", "ß", "x1", "é-e", "zeta", "eta", "rho"] + [f"t{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 3, 9, 10, 14, 25])))) for i in range(30)] + [(30, None), (31, "!!"), (None, "the of"), (32, "the the the"), (33, items_text := "rho eta zeta x1")]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 60)))) for i in range(80)]
    docs += [(100 + i, f"pre, {t} | post {t}") for i, (_, t) in enumerate(items) if t]
    docs += [(200, None), (201, ""), (1, items_text), (None, items_text), (None, None), (202, "THE THE THE THE")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit("clash"))
    got = decontamination.match(d, spark.createDataFrame(items, "item_id long, text string"), size=10, broadcast_rows=broadcast_rows).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in got), key=str) == _brute_match(docs, [x for x in items if x[0] is not None], 10)


def test_decontamination_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "beta x gamma"), (3, "alpha alpha"), (4, "x x x x")], "doc_id long, text string")
    got = {r.doc_id: r for r in decontamination.match(docs, items).collect()}
    assert got[1].n_hit == 3 and got[2].n_hit == 0 and any(abs(n.gap) == 1 for n in got[2].near)
    assert not got[3].near and not got[4].near and not got[1].near  # an exact match is no proximity match


def test_decontamination_judges_rows_that_share_an_id_by_their_own_text(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = [(None, "alpha beta gamma"), (None, "nothing here"), (None, "alpha x beta gamma"), (5, "alpha beta gamma"), (5, "nothing here"), (5, "alpha beta gamma"), (5, None)]
    got = decontamination.match(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert sorted(((r.doc_id, r.text, r.n_hit, len(r.phrases), len(r.near)) for r in got), key=str) == sorted(
        ((i, t, 3 * (t == "alpha beta gamma"), int(t == "alpha beta gamma"), int(t == "alpha x beta gamma")) for i, t in docs), key=str
    )


def test_decontamination_of_a_very_long_text(spark):
    item = "one two three four five six seven eight nine ten"
    text = "pad " * 300_000 + item + " pad" * 5
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = {r.doc_id: r for r in decontamination.match(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).select("doc_id", "n_words", "n_hit").collect()}
    assert (got[1].n_words, got[1].n_hit, got[2].n_hit) == (300_015, 10, 0)


def test_decontamination_empty_sides(spark, odd, none):
    items = spark.createDataFrame([(1, "a b c a b c a b c a b")], "item_id long, text string")
    assert decontamination.match(none, items).count() == 0
    assert {r.n_hit for r in decontamination.match(odd, items.limit(0)).collect()} == {0}
    got = decontamination.match(odd, items).collect()
    assert len(got) == odd.count() and {r.n_hit for r in got if r.doc_id in (1, 2)} == {119}


def _brute_statistics(t):
    t = t or ""
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", t) if x]
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), dup, len(covered)


def test_quality_statistics_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", " \n", "a\n a\na\n\n", "# * | < >", "x " * 9, "é b c\x0bd"] + [" ".join(rng.choices("abc", k=rng.randint(0, 80))) + rng.choice(["", "\nq q\nq q\n"]) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    for r in mcd_quality.with_statistics(df).collect():
        assert tuple(r[c] for c in mcd_quality.STATISTICS) == _brute_statistics(r.text), repr(r.text)


def test_mcd_rejects_outliers_and_keeps_the_rest(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(30, 300))), rng.choice(["en", None]), rng.choice(["s1", "s1", f"r{i}"])) for i in range(500)]
    bad = [(1000 + i, " ".join(word() + "***###" for _ in range(80)), "en", "s1") for i in range(40)]
    got = {r.doc_id: r for r in mcd_quality.judge(spark.createDataFrame(rows + bad, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[1000 + i].kept for i in range(40))
    assert sum(got[i].kept for i in range(500)) >= 498


def test_mcd_rejects_outliers_of_each_dimension(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))
    line = lambda n: " ".join(word() for _ in range(n))
    text = lambda n, again=(): "\n".join(rng.sample([line(5) for _ in range(n)] + list(again), n + len(again)))
    rows = [(i, text(rng.randint(5, 60))) for i in range(300)]
    long_words = [(1000 + i, " ".join(word() + word() for _ in range(150))) for i in range(5)]
    symbols = [(2000 + i, text(28) + "\n" + "# " * 10) for i in range(5)]
    lines = [(3000 + i, text(28, [f"a{i} b", f"a{i} b"] * 6)) for i in range(5)]
    passages = [(4000 + i, f"{line(60)} {x} {line(60)} {x} {line(60)}") for i in range(5) for x in [line(20)]]
    once = [(5000 + i, f"{line(10)}\nsee also\n{line(10)}\nsee also\n") for i in range(5)]
    df = spark.createDataFrame(rows + long_words + symbols + lines + passages + once, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    got = {r.doc_id: r for r in mcd_quality.judge(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {r.n_dup_lines for i, r in got.items() if 4000 <= i < 5000} == {r.n_repeat_words for i, r in got.items() if 3000 <= i < 4000} == {0}
    assert [i for i, r in got.items() if 1000 <= i < 5000 and r.kept] == []
    assert sum(got[i].kept for i in range(300)) >= 298 and all(got[i].kept for i, _ in once)


def test_mcd_estimate_equals_brute_force(spark):
    """The same concentration steps in plain numpy, over the best of all starts: estimates and determinant."""
    from pyspark.sql import Row

    m = mcd_quality
    rng = np.random.default_rng(6)
    z = rng.normal(size=(400, 4)) @ np.array([[0.3, 0.1, 0, 0], [0, 0.5, 0.2, 0], [0, 0, 0.6, 0], [0.2, 0, 0, 0.7]])
    z[:90] += [2.0, 4.0, -3.0, 5.0]  # a second cloud that the plain mean is drawn to
    rows = spark.createDataFrame([Row(g_lang="x", g_source="s", g_rest=False, **{f"z{k}": float(v[k]) for k in range(4)}) for v in z])
    got = m.estimates(rows).first()
    floor2 = np.diag(np.square(m.FLOOR))

    def cut(d, share):  # the value that percentile_approx gives: the least one that covers the share
        return np.sort(d)[int(np.ceil(share * len(d))) - 1]

    def d2(mean, cov):
        y = np.linalg.solve(np.linalg.cholesky(cov + floor2), (z - mean).T)
        return (y * y).sum(axis=0)

    med = np.array([cut(z[:, k], 0.5) for k in range(4)])
    width = np.array([max((cut(z[:, k], 0.75) - cut(z[:, k], 0.25)) / 1.349, m.FLOOR[k]) for k in range(4)])
    x = (z - med) / width
    sign = x / np.linalg.norm(x, axis=1, keepdims=True)
    starts = [(med, np.diag(width**2)), (med, 4 * np.cov(sign.T, bias=True) * np.outer(width, width)), (z.mean(axis=0), np.cov(z.T, bias=True))]
    ends = []
    for mean, cov in starts:
        for _ in range(m.STEPS):
            d = d2(mean, cov)
            kept = z[d <= cut(d, m.SUBSET)]
            mean, cov = kept.mean(axis=0), np.cov(kept.T, bias=True)
        ends.append((np.linalg.slogdet(cov + floor2)[1], mean, cov))
    _, mean, cov = min(ends, key=lambda e: e[0])
    scale = max(cut(d2(mean, cov), 0.5) / m.CHI2_MEDIANS[3], 1.0)
    assert np.allclose([got[f"m{k}"] for k in range(4)], mean, atol=1e-6)
    assert np.allclose([got[f"c{i}{j}"] for i, j in m._PAIRS], [scale * cov[i, j] for i, j in m._PAIRS], atol=1e-6)


def test_mcd_odd_rows(odd, none):
    got = mcd_quality.judge(odd).collect()
    assert len(got) == odd.count() and not any(r.kept for r in got if r.base_failed)
    assert mcd_quality.judge(none).count() == 0


def _brute_fingerprint(t):
    w = (t or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_vectorised_hashes_equal_the_library():
    rng = random.Random(8)
    data = bytes(rng.randrange(256) for _ in range(4000))
    start = np.array([rng.randrange(3900) for _ in range(3000)] + [3999, 0])
    size = np.minimum(np.array([rng.randrange(80) for _ in range(3000)] + [1, 0]), len(data) - start)
    got = simhash.xxh64_slices(data, start, size)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a : a + n], 42) for a, n in zip(start, size, strict=True)]


def test_near_duplicates_equal_union_of_all_close_pairs(spark):
    """The whole query against brute force: fingerprints, links and components."""
    from pairforge.llm import queries

    rng = random.Random(12)
    words = [f"v{i}" for i in range(300)]
    docs = []
    for i in range(60):
        base = rng.choices(words, k=rng.choice([0, 1, 2, 5, 60, 400]))
        docs.append((3 * i, " ".join(base)))
        for j in (1, 2):
            copy = list(base)
            if copy:
                copy[rng.randrange(len(copy))] = f"e{i}{j}"
            docs.append((3 * i + j, "  ".join(copy).upper() if j == 2 else " ".join(copy)))
    out = simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()

    def fingerprint(text):
        w = text.encode().lower().split()
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(len(w) - 2, 1))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {i: fingerprint(t) for i, t in docs}
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
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in out} == {i: (fp[i], find(i)) for i in fp}
    assert queries.QUERIES["op9_simhash_dedup"]


def test_fingerprints_equal_brute_force(spark, odd, none):
    texts = [None, "", "One", "one TWO", "A b C", "ÄB c d e", "q w e r t y " * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fp & (2**64 - 1) for r in simhash.fingerprints(df).collect()}
    assert got == {i: _brute_fingerprint(t) for i, t in enumerate(texts)}
    near = simhash.near_duplicates(odd).collect()
    assert len(near) == odd.count() and {r.component_id for r in near if r.doc_id in (3, 4, 5)} == {3}
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.deduplicate(none).count() == 0


def _brute_components(n, links):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("most", [64, 1])
def test_links_connect_what_brute_force_connects(spark, most):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fps = list(base)
    for b in base[:15]:
        x = int(b)
        for _ in range(8):
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(bit)
            fps.append(np.uint64(x))
    fps = np.unique(np.array(fps, dtype=np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    at = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    got = [(at[r.x], at[r.y]) for r in simhash.links(df, most=most).collect()]
    want = [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 3]
    assert _brute_components(len(fps), got) == _brute_components(len(fps), want)
    assert all(int(fps[a] ^ fps[b]).bit_count() <= 3 for a, b in got)
    if most == 64:
        assert {tuple(sorted(p)) for p in got} == {tuple(sorted(p)) for p in want}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(200, 200), (300, 299)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[100 + i] == 100 for i in range(1, 20)) and got[300] == 299
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_items_digest_of_the_query(spark):
    from pairforge.llm import queries

    out = queries.op3_decontamination(spark, "/root/testdata/sf0.001").filter("n_items = 0").first()
    assert out.items_sha256 == hashlib.sha256(b"").hexdigest() and not out.contaminated


def test_chats_collapse_like_brute_force(spark):
    from pairforge.llm import chat_formatting

    rng = random.Random(4)
    talks = []
    for _ in range(40):
        talk = [(rng.choice(["user", "assistant"]), rng.choice(["a", "b", "<|im_end|>", ""])) for _ in range(rng.randint(1, 6))]
        talks += [talk[:k] for k in rng.sample(range(1, len(talk) + 1), rng.randint(1, len(talk)))]
    rows = [(i, k, role, text) for i, talk in enumerate(talks) for k, (role, text) in enumerate(talk)]
    rows += [rows[0], (None, 0, "user", "a"), (900, 1, None, "z"), (900, None, "user", None)]
    talks = {i: talk for i, talk in enumerate(talks)} | {900: [("user", ""), ("", "z")]}
    kept = {}
    for i, talk in sorted(talks.items()):
        if not any(o[: len(talk)] == talk and (len(o) > len(talk) or j < i) for j, o in talks.items()):
            kept[i] = len(talk)
    got = chat_formatting.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit("clash"))).collect()
    assert {r.conv_id: r.n_turns for r in got} == kept
    assert all("<|im_end|><|" not in r.rendered and r.rendered.count("<|im_start|>") == r.n_turns for r in got)


def test_chat_of_very_many_turns(spark):
    from pairforge.llm import chat_formatting

    df = spark.range(30_000).selectExpr("1L AS conv_id", "id AS turn", "'user' AS role", "concat('t', id) AS text")
    got = chat_formatting.format_conversations(df.union(df.filter("turn < 20000").selectExpr("2L", "turn", "role", "text"))).collect()
    assert [(r.conv_id, r.n_turns) for r in got] == [(1, 30_000)]


def test_joins_of_near_duplicates_are_never_left_to_be_a_broadcast(spark, monkeypatch):
    """A row for each key of a fingerprint is sized by Spark as one for each fingerprint."""
    from pairforge.llm import common

    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.stage(df, name)

    monkeypatch.setattr(simhash, "stage", kept)
    monkeypatch.setattr(components, "stage", kept)
    docs = spark.createDataFrame([(i, " ".join(f"w{(i % 20) * 100 + k}" for k in range(40)) + (" end" if i % 3 else "")) for i in range(60)], "doc_id long, text string")
    for most in (64, 1):
        out = simhash.near_duplicates(docs, most=most)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        assert {r.doc_id: r.component_id for r in out.collect()}[20] == 0  # its copy
    assert sum("SortMergeJoin" in p for p in plans) > 6 and not [p for p in plans if "BroadcastHashJoin" in p]
