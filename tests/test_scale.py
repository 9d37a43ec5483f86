"""Blocked products, positions by counting, heavy terms, ordered assignment, folders and checkpoints against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairforge.operators import assignment, blocked, containment, feedback, matching_text, postings, runs
from pairforge.operators import similarity as Z
from pairforge.operators import vocabulary as V
from pairforge.operators.assignment import assigned, emails_from_persons
from pairforge.operators.blocked import grid, products
from pairforge.operators.postings import Part
from pairforge.operators.ranks import Intervals, positions_by_runs, quantiles, range_of, with_positions
from pairforge.queries import matching
from pairforge.queries import texts as text_queries
from pairforge.sources import folders, readers, stages


def cosine(u, v):
    if u is None or v is None or len(u) != len(v) or None in u or None in v:
        return None
    return sum(p * q for p, q in zip(u, v)) / (max(sum(p * p for p in u) ** 0.5, 1e-12) * max(sum(q * q for q in v) ** 0.5, 1e-12))


def test_products_equal_single_cosines(spark):
    rng = np.random.default_rng(1)
    vector = lambda: [float(x) for x in rng.normal(size=5)]
    left = [(k, vector(), vector()) for k in range(120)] + [(1000, None, [1.0] * 5), (1001, [1.0, 2.0], [0.0] * 5), (1002, [1.0, None, 2.0, 3.0, 4.0], [1.0] * 5), (1003, [], []), (None, [1.0] * 5, None)]
    right = [(k, vector()) for k in range(30)] + [(100, None), (101, []), (102, [3.0, 4.0])]
    a = spark.createDataFrame(left, "cid long, f array<double>, g array<double>").repartition(5)
    b = spark.createDataFrame(right, "oid long, b array<double>").repartition(3)
    df = products(a, b, "cid", "oid", {"x": "f", "y": "g"}, "b", block_bytes=400)
    plan = df._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    got = {(r.cid, r.oid): (r.x, r.y) for r in df.collect()}
    assert len(got) == len(left) * len(right)
    for c, f, g in left:
        for o, v in right:
            for want, x in zip((cosine(f, v), cosine(g, v)), got[c, o]):
                assert (want is None) == (x is None) and (want is None or abs(want - x) < 1e-12)
    assert products(a.limit(0), b, "cid", "oid", {"x": "f"}, "b").count() == 0
    assert "BroadcastHashJoin" not in plan  # a broadcast would hold the copies for all cells


def test_ranks_and_largest_values_need_no_pairs(spark):
    rng = np.random.default_rng(4)
    vector = lambda: [float(x) for x in rng.integers(-1, 2, size=4)]  # few values: many ties, and vectors of zeros
    left = [(k, vector(), vector()) for k in range(70)] + [(1000, None, vector()), (1001, [1.0, 2.0], vector()), (1002, [0.0] * 4, vector())]
    a = spark.createDataFrame(left, "cid long, a array<double>, f array<double>").repartition(5)
    b = spark.createDataFrame([(k, vector()) for k in range(40)] + [(100, None), (101, [3.0, 4.0])], "oid long, b array<double>").repartition(3)
    pairs = Z.dense_cosines(a, b, {"x": "a", "y": "f"}).withColumns({c: F.round(c, 9) for c in "xy"}).cache()
    rows = lambda df: {r[0]: None if r[1] is None else round(r[1], 9) for r in df.collect()}
    varied = {r[0] for r in pairs.groupBy("cid").agg(F.count_distinct(F.coalesce("x", F.lit(-9.0))).alias("n"), F.count_distinct(F.coalesce("y", F.lit(-9.0))).alias("m")).filter("n > 1 AND m > 1").collect()}
    want = rows(Z.spearman(pairs.filter(F.col("cid").isin(list(varied))), "cid", "x", "y")) | {k: None for k, _, _ in left if k not in varied}
    assert rows(Z.spearman_of_vectors(a, b, ("a", "f"))) == want and 1000 not in varied
    assert rows(Z.separation_of_vectors(a, b)) == rows(Z.separation(pairs, "cid", "x", "oid"))
    assert blocked.rank_correlations(a, b, "cid", "oid", ("a", "f"), "b", 9, block_bytes=300).count() == len(left)
    assert rows(blocked.rank_correlations(a, b, "cid", "oid", ("a", "f"), "b", 9, block_bytes=300)) == want
    few = blocked.largest(a, b, "cid", "oid", "a", "b", 3, 9, block_bytes=300)
    assert {r.cid: (r.n, [round(x, 9) for x in r.top]) for r in few.collect()} == {r.cid: (r.n, r.top) for r in pairs.groupBy("cid").agg(F.count("x").alias("n"), F.slice(F.sort_array(F.collect_list("x"), asc=False), 1, 3).alias("top")).collect()}
    pairs.unpersist()


def test_percentiles_of_vectors_make_no_row_for_a_pair_before_the_last(spark, monkeypatch):
    rng = np.random.default_rng(7)
    vectors = lambda keys: [(int(k), [float(x) for x in rng.integers(-1, 2, size=4)]) for k in keys]  # many ties, and vectors of zeros
    left, right = vectors(rng.permutation(90) - 30), vectors(rng.permutation(37))
    a, b = spark.createDataFrame(left, "cid long, a array<double>").repartition(5), spark.createDataFrame(right, "oid long, b array<double>").repartition(3)
    rows = lambda df: {(r.cid, r.oid): tuple(r)[2:] for r in df.collect()}
    unit = lambda v: np.array(v) / max(np.linalg.norm(v), 1e-12)
    value = {(c, o): np.floor(abs(x := float(unit(u) @ unit(v))) * 1e9 + 0.5) * np.sign(x) for c, u in left for o, v in right}
    mean = {c: sum(value[c, o] for o, _ in right) / (1e9 * len(right)) for c, _ in left}
    excess = {k: np.floor(abs(x := v / 1e9 - mean[k[0]]) * 1e8 + 0.5) * np.sign(x) for k, v in value.items()}
    place = lambda d: {k: i / (len(d) - 1) for i, k in enumerate(sorted(d, key=lambda k: (d[k], k)))}
    p, q = place(value), place(excess)
    want = {k: (p[k], q[k]) for k in p}
    assert rows(Z.percentiles_of_vectors(a, b, ["p", "q"])) == want
    assert rows(blocked.percentiles(a, b, "cid", "oid", "a", "b", ["p", "q"], 9, 8, run_values=200, merged_values=50)) == want
    one = rows(Z.percentiles_of_vectors(a, b, ["p"]))
    assert one == {k: v[:1] for k, v in want.items()} == rows(Z.percentiles_of_vectors(a, b, ["p"], held_bytes=0))
    assert Z.percentiles_of_vectors(a.union(spark.createDataFrame([(500, None), (0, [1.0] * 4)], a.schema)), b, ["p", "q"]).count() == 92 * 37  # a null and a key twice: as rows
    assert Z.percentiles_of_vectors(a, b.limit(0), ["p"]).count() == 0
    made = []
    monkeypatch.setattr(Z, "stage", lambda df, name="stage": made.append(name) or stages.stage(df, name))
    assert matching.percentile_rank(spark, "/root/testdata/sf0.001").count() == 22500 and not made  # "ranked" with all pairs before
    assert matching.specificity(spark, "/root/testdata/sf0.001").count() == 22500 and not made


def test_positions_by_runs_take_ranges_that_are_there(spark):
    rng = random.Random(5)
    keys = sorted(rng.sample(range(-1000, 1000), 60))
    rows = [(k, o, rng.choice([0.5, None, rng.random()])) for k in keys for o in range(9)]
    bounds = [keys[k] for k in (7, 8, 30, 55)]
    df = spark.createDataFrame(rows, "k long, o long, v double").withColumn("part", range_of(F.col("k"), bounds))
    assert all(r.part == sum(b <= r.k for b in bounds) for r in df.collect())
    assert spark.range(1).select(range_of(F.lit(None).cast("long"), bounds)).first()[0] == len(bounds) and spark.range(1).select(range_of(F.lit(7), [])).first()[0] == 0
    got, n = positions_by_runs(df.repartition(3, "part"), {"v": "at"}, ["k", "o"], run_rows=20, ranges="part")
    want, m = positions_by_runs(df, {"v": "at"}, ["k", "o"])
    place = lambda x: {(r.k, r.o): r.at for r in x.collect()}
    assert n == m == len(rows) and place(got) == place(want) and sorted(place(got).values()) == list(range(n))


def test_intervals_of_many_runs_are_even():
    """With few points for each run these lay on the same places of all: at 2,000 runs the largest interval was 60 times its share."""
    rng, many = np.random.default_rng(1), 2000
    values = rng.normal(0, 1e8, (many, 400)).astype(np.int64)
    ends = runs._ends(np.concatenate([runs._looked_at(x, runs.SEEN_EACH, (k % 60 << 33) + k // 60) for k, x in enumerate(values)]), many)
    size = np.bincount(np.searchsorted(ends, values.ravel(), "right"), minlength=many)
    assert size.max() < 4 * values.size / many
    assert runs._looked_at(np.array([7]), 16, 5).tolist() == [7] and not len(runs._looked_at(np.zeros(0, np.int64), 16, 5))


def test_grid_sends_the_smaller_side_more_often():
    assert grid(1000, 1, 32) == (32, 1) and grid(1, 1000, 32) == (1, 32) and grid(0, 0, 32) == (1, 1)
    rows, columns = grid(400, 100, 64)
    assert rows > columns and rows * columns <= 64


_VALUES = {
    "normal": lambda r: r.gauss(0, 1),
    "few": lambda r: 0.0 if r.random() < 0.6 else 0.25 if r.random() < 0.5 else r.random(),
    "odd": lambda r: r.choice([None, math.nan, math.inf, -math.inf, 1e308, -1e308, 0.0, 5e-324, 1.0, math.exp(r.uniform(-300, 300))]),
    "one": lambda r: 7.5,
}


@pytest.mark.parametrize("kind", _VALUES)
def test_positions_and_quantiles_equal_sorting(spark, kind):
    rng = random.Random(3)
    rows = [(k % 50, k // 50, _VALUES[kind](rng)) for k in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "cid long, oid long, v double").repartition(6).cache()
    order = lambda r: (((0, 0.0) if r[2] is None else (2, 0.0) if r[2] != r[2] else (1, r[2])), r[0], r[1])
    out, n = with_positions(df, {"v": "p"}, ["cid", "oid"])
    assert n == 3000 and sorted((r.p, r.cid, r.oid) for r in out.collect()) == [(k, c, o) for k, (c, o, _) in enumerate(sorted(rows, key=order))]
    if kind != "odd":  # no interval holds more than its share, however many values are equal
        tree = Intervals(df, ["v", "cid", "oid"])
        assert max(b - a for a, b in zip(tree.before, [*tree.before[1:], tree.n])) <= -(-3000 // 16) + 1
    known = sorted(v for _, _, v in rows if v is not None and v == v)
    shares = [0, 0.1, 0.25, 0.5, 0.753, 0.99, 1]
    for x, got in zip(shares, quantiles(df, "v", shares, few=50)):
        k = x * (len(known) - 1)
        lo, hi = known[math.floor(k)], known[math.ceil(k)]
        want = lo + (k % 1) * (hi - lo)
        assert got == want or abs(got - want) <= 1e-9 * abs(want) or (got != got and want != want)
    df.unpersist()


def test_positions_of_other_types_and_of_nothing(spark):
    none = spark.createDataFrame([], "cid long, v double")
    assert with_positions(none, {"v": "p"}, ["cid"])[0].collect() == [] and quantiles(none, "v", [0.5]) == [None]
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "s string, v int")
    assert {r.v: (r.p, r.q) for r in with_positions(df, {"v": "p", "s": "q"}, ["v"])[0].collect()} == {1: (0, 2), 2: (1, 1), 3: (2, 0)}


def test_heavy_terms_count_as_in_the_join(spark):
    """Half of the terms are in half of all texts, more of them than one mask holds."""
    rng = random.Random(2)
    words = [f"word{k:03d}" for k in range(150)]
    side = lambda n: [(i, w) for i in range(n) for k, w in enumerate(words) if rng.random() < (0.5 if k < 75 else 0.05)]
    left, right = side(60), side(25)
    c, o = spark.createDataFrame(left, "cid long, token string"), spark.createDataFrame(right, "oid long, token string")
    vocab = [(w, n, 1000, math.log(1000 / (1 + n)) + 1.0, 0.5 if n > 44 else 0.01, w == "word003", False, True) for w, n in Counter(w for _, w in left + right).items()]
    vocab = spark.createDataFrame(vocab, "token string, cnt long, n long, idf double, doc_ratio double, is_common boolean, is_protected boolean, is_domain boolean")
    rows = lambda df: sorted((r.cid, r.oid, r.n_terms, round(r.evidence_score, 9), tuple(r.terms)) for r in df.collect())
    want = rows(V.evidence(V.evidence_terms(c, o, vocab)))
    for texts in (0, 20, 10**9):
        assert rows(V.shared_evidence(c, o, vocab, heavy_share=0.0, heavy_texts=texts, salted=7)) == want
    blocks = V.evidence_by_blocks(c, o, vocab)
    assert rows(blocks) == want
    text = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in text and "Generate" in text  # blocks meet; pairs aren't grouped


@pytest.mark.parametrize("n_keys", [3, 40])
def test_assignment_equals_the_sequence(spark, n_keys):
    rng = random.Random(5)
    targets = [(k, [f"k{rng.randint(0, n_keys)}" for _ in range(rng.randint(0, 2))]) for k in rng.sample(range(1000), 60)]
    sources = [(k, [f"k{min(rng.randint(0, n_keys), rng.randint(0, n_keys))}" for _ in range(rng.randint(0, 4))]) for k in rng.sample(range(1000), 80)] + [(2000, None), (2001, [None])]
    got = assigned(spark.createDataFrame(sources, "source long, keys array<string>"), spark.createDataFrame(targets, "target long, keys array<string>"))
    taken, want = set(), set()
    for s, keys in sorted(sources):
        for key in keys or []:
            t = next((t for t, own in sorted(targets) if key in own and t not in taken), None)
            if t is not None:
                taken.add(t)
                want.add((t, s, key))
                break
    assert {(r.target, r.source, r.key) for r in got.collect()} == want


def test_assignment_rounds_do_not_grow_with_the_sources(spark, monkeypatch):
    sources = [(k, [f"name {k % 5 + 38}", f"slug {k * 7 % 70}", f"name {k % 3}"]) for k in range(1, 601)]
    targets = [(k, [f"name {k % 40}", f"slug {k % 60}"]) for k in range(1, 9001)]
    made = Counter()
    monkeypatch.setattr(assignment, "stage", lambda df, name: (made.update([name]), stages.stage(df, name))[1])
    monkeypatch.setattr(assignment, "BUCKETS", 7, raising=False)  # keys span buckets of both sides
    got = assigned(spark.createDataFrame(sources, "source long, keys array<string>"), spark.createDataFrame(targets, "target long, keys array<string>"))
    taken, want = set(), set()
    for s, keys in sources:
        free = next(((t, key) for key in keys for t, own in targets if key in own and t not in taken), None)
        if free:
            taken.add(free[0])
            want.add((free[0], s, free[1]))
    assert {(r.target, r.source, r.key) for r in got.collect()} == want
    assert made["met"] <= 5  # rounds


def test_files_keep_their_own_headers(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text("Name,Email\nann,a@x.org\n")
    (tmp_path / "two.csv").write_text('﻿Sector,Name,Phone\nMining,"bob ""B"",\nltd",77\nICT,"",\n')
    (tmp_path / "three.csv").write_text("First,last,first,\nEve,Adams,Eve,eve@x.org and more\n")
    (tmp_path / "bad.csv").write_text('"never ends\nx,y\n')
    (tmp_path / "empty.csv").write_text("\n\n")
    (tmp_path / "note.txt").write_text("no table")
    rows, broken = folders.read_folder(spark, str(tmp_path))
    got = {(r.Name, r.Email, r.Sector, r.Phone) for r in rows.filter("coalesce(Name, Email, Sector, Phone) IS NOT NULL").collect()}
    assert got == {("ann", "a@x.org", None, None), ('bob "B",\nltd', None, "Mining", "77"), (None, None, "ICT", None)} or got == {("ann", "a@x.org", None, None), ('bob "B",\nltd', None, "Mining", "77"), ("", None, "ICT", None)}
    assert "first.1" in rows.columns and "column 3" in rows.columns
    assert [r.file.rsplit("/", 1)[1] for r in broken.collect()] == ["bad.csv"]
    persons = folders.person_rows(rows)
    assert {(r.email, tuple(r["keys"])) for r in persons.collect()} == {("a@x.org", ()), ("eve@x.org", ("eve adams",))}
    targets = spark.createDataFrame([(1, ["nobody"]), (2, ["eve adams", "eve"]), (3, ["eve adams"])], "target long, keys array<string>")
    assert [(r.target, r.email) for r in emails_from_persons(targets, persons).collect()] == [(2, "eve@x.org")]


def test_reviews_keep_quoted_rows(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "1.csv").write_text('company,opportunity,verdict\n"Say ""Hi"", Ltd",X,agree\n"two\nlines",X,agree\nacme,X,agree\n')
    (tmp_path / "r" / "2.csv").write_text("company,opportunity,verdict\nacme,X,disagree\n")
    assert {(r.company, r.label) for r in readers.read_reviews(spark, str(tmp_path / "r")).collect()} == {('Say "Hi", Ltd', 1), ("two\nlines", 1), ("acme", 0)}


def test_checkpoints_follow_their_inputs(spark, tmp_path):
    path = str(tmp_path / "cp")
    three, nine = spark.range(3).toDF("a"), spark.range(9).toDF("a")
    made = lambda df, *of: sorted(tuple(r) for r in stages.checkpoint(df, path, *of).collect())
    assert len(made(three)) == 3 and len(made(nine)) == 9 and len(made(three)) == 3
    dear, other = three.withColumn("b", F.rand(1)), three.withColumn("b", F.rand(2))
    first = made(dear, [three])
    assert made(other, [three]) == first  # resumed
    assert made(other, [three], {"model": "x"}) != first
    assert len(made(nine.withColumn("b", F.rand(3)), [nine], {"model": "x"})) == 9
    assert made(three.withColumn("c", F.lit(1)), [three]) == [(k, 1) for k in range(3)]


def test_containment_equals_brute_force(spark):
    rng = random.Random(5)
    text = lambda most: "".join(rng.choice("abé𝒳 ") for _ in range(rng.randint(0, most)))
    longs = [(rng.randint(0, 2), text(9)) for _ in range(150)] + [(0, None), (1, "a" * 5000 + "b")] * 2
    shorts = [(rng.randint(0, 2), text(4)) for _ in range(120)] + [(1, "aab"), (1, "a" * 4000), (2, None)]
    a, b = spark.createDataFrame(longs, "k int, x string"), spark.createDataFrame(shorts, "k int, y string")
    got = sorted((r.k, r.x, r.y) for r in containment.contained(a, "x", b, "y", ["k"]).collect())
    assert got == sorted({(k, x, y) for k, x in longs for j, y in shorts if k == j and x and y and y in x}) and len(got) > 300
    both = sorted((r.x, r.y) for r in containment.either_way(a, "x", b, "y").collect())
    assert both == sorted({(x, y) for _, x in longs for _, y in shorts if x and y and (y in x or x in y)})
    none = containment.contained(a.limit(0), "x", b, "y")
    assert none.columns == ["x", "y"] and none.count() == 0


def test_labels_and_needs_without_a_nested_loop(spark):
    labels = [(f"Sector number {k} of many",) for k in range(3000)] + [("Plain",), ("plain",), ("Twin label",), ("twin label",)]
    raw = [(1, "sector NUMBER 17 of many"), (2, "number 2999"), (3, "number 299"), (4, "PLAIN"), (5, "plain"), (6, "a plain thing"), (7, None), (8, ""), (9, "about sector number 5 of many more"), (10, " sector number 8 of many "), (10, " sector number 8 of many ")]
    out = matching_text.adjacent_label(spark.createDataFrame(raw, "id long, raw string"), spark.createDataFrame(labels, "label string"))
    assert {r.id: r.resolved for r in out.collect()} == {1: labels[17][0], 2: labels[2999][0], 3: None, 4: None, 5: "plain", 6: None, 7: None, 8: None, 9: labels[5][0], 10: labels[8][0]}
    assert out.count() == 10
    needs = [(1, k, t, None) for k, t in enumerate(["Steel casting", "casting", "!", "glass", "Casting"])] + [(2, 0, "casting", "q")]
    cover = [(1, 1, "casting", [("A", "x")]), (1, 0, "steel casting line", [("B", "y")]), (1, 2, "", [("C", "z")])]
    view = feedback.consortium(spark.createDataFrame(needs, "oid int, seq int, capability string, quote string"), spark.createDataFrame(cover, "oid int, pos int, need string, companies array<struct<name:string,why:string>>"), "oid")
    rows = sorted((r.oid, r.status[:5], r.need, r.covered_by, r.gap) for r in view.collect())
    assert rows == [(1, "Ready", "!", "B", ""), (1, "Ready", "Casting", "B", ""), (1, "Ready", "Steel casting", "B", ""), (1, "Ready", "casting", "B", ""), (1, "Ready", "glass", "", "GAP"), (2, "Thin ", "", "", "")]
    for plan in (out, view):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_tfidf_by_postings_equals_long_tables(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abé𝒳z") for _ in range(min(rng.randint(1, 7), rng.randint(1, 7))))
    texts = [(rng.choice("cp"), k, " ".join(word() for _ in range(rng.randint(0, 30)))) for k in range(80)] + [("o", k, " ".join(word() for _ in range(rng.randint(0, 12)))) for k in range(25)] + [("c", 500, None), ("o", 501, ""), ("c", 502, "x" * 3000)]
    df = spark.createDataFrame(texts, "side string, id long, text string").repartition(3)
    rows = lambda x: {(r.side, r.cid, r.oid): round(r.cosine, 9) for r in x.collect()}
    for parts in ((Part(sublinear=False),), (Part(max_df=0.2),), Z.HYBRID):
        want = rows(Z.tfidf_cosines(df, "o", parts, True, frequent=1))  # the right side has more grams: long tables
        got = rows(Z.tfidf_cosines(df, "o", parts, True))
        assert len(want) > 300 and {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    made = lambda frequent: {(r.side, r.id): (sorted(zip(r.terms, [round(x, 9) for x in r.w]))) for r in postings.tfidf_lists(df.filter("side <> 'o' OR id < 3"), "o", Part(), frequent).collect()}
    assert made(60) == made(10**6)  # with few grams known, the others are joined


def test_tfidf_writes_neither_left_vectors_nor_rows_for_rare_grams(spark, monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(2, 5)))
    texts = [("c", k, " ".join(word() for _ in range(40))) for k in range(60)] + [("o", k, " ".join(word() for _ in range(8))) for k in range(20)]
    df = spark.createDataFrame([*texts, ("c", None, "abc def"), ("c", 60, None)], "side string, id long, text string").repartition(3)
    rows = lambda x: {(r.side, r.cid, r.oid): round(r.cosine, 9) for r in x.collect()}
    made = []
    for module in (postings, Z):
        monkeypatch.setattr(module, "stage", lambda d, name="stage": made.append(name) or stages.stage(d, name))
    for normalise in (False, True):
        made.clear()
        held = Z.tfidf_cosines(df, "o", Z.HYBRID, normalise)
        assert not {"vectors", "left-terms", "frequencies"} & set(made)  # all of these before
        assert "Generate" not in held._jdf.queryExecution().optimizedPlan().toString()
        assert len(rows(held)) > 900 and rows(held) == rows(Z.tfidf_cosines(df, "o", Z.HYBRID, normalise, held_terms=0))
    few = postings.gram_counts(df, "o", Part(), block_grams=50, range_chars=100)
    many = postings.gram_counts(df, "o", Part())
    squares = lambda x: {(r.side, r.id): round(r.square, 9) for r in x.squares.collect()}
    assert squares(few) == squares(many) and (few.df == many.df).all() and len(squares(many)) == 82


def test_quotes_meet_texts_without_a_row_for_each_gram(spark, tmp_path, monkeypatch):
    quotes = [(1, "One two, three four five"), (2, "two three four five"), (3, "five six seven"), (4, "four five four five four"), (5, None)]
    texts = [(1, "zero one two three four five six"), (2, "one two three four"), (3, "x four five four five four five four five"), (4, None), (5, "One  TWO three four five"), (6, "")]
    spark.createDataFrame(quotes, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    few = text_queries.quote_in_text(spark, str(tmp_path))
    assert {tuple(r) for r in few.collect()} == {(1, 1), (1, 2), (3, 4), (5, 1), (5, 2)}
    assert "Aggregate" not in few._jdf.queryExecution().optimizedPlan().toString()  # starts are sought in the row, and no row for each gram is shuffled
    monkeypatch.setattr(text_queries, "MOST_STARTS", 1)
    assert sorted(text_queries.quote_in_text(spark, str(tmp_path)).collect()) == sorted(few.collect())
