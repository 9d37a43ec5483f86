"""Unit fixtures of the matching operators: literal rows with expected values."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairforge.functions import arrays as A
from pairforge.functions import text as X
from pairforge.operators import feedback as B
from pairforge.operators import matching_text as M
from pairforge.operators import ranking as R
from pairforge.operators import scoring as O
from pairforge.operators import similarity as Z
from pairforge.sources import folders, readers, stages


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit(*values):
    return [F.lit(v) for v in values]


def test_text_functions(spark):
    t = one(spark, X.focus_company(F.lit("Harbour Pumps was incorporated; established 1962, it is headquartered in Oslo. Its foundry casts bronze valves and impellers for desalination.")))
    assert "1962" not in t and "headquartered" not in t and "bronze valves and impellers for desalination" in t
    t = one(spark, X.focus_opportunity(F.lit("A cable yard near Jeddah for 3.5 million USD; Aramco buys 40 % of the armoured cable."))).lower()
    assert not any(w in t for w in ("jeddah", "aramco", "3.5", "40")) and "armoured cable" in t
    names = [("Nordic Casting & forging", "nordic casting and forging"), ("Blue Rock LLC", "blue rock"), ("Fjord & Daughters Company, Inc.", "fjord and daughters"), ("Company of Weavers", "company of weavers"), ("Ltd Inc", ""), (None, "")]
    for raw, want in names:
        assert one(spark, X.canonical_name(F.lit(raw).cast("string"))) == want
    source = F.lit("The plant needs certified, high-purity copper foil suppliers!")
    for quote, want in (("high-purity copper foil suppliers", True), ("High purity; copper FOIL suppliers", True), ("needs a large smelter here", False), ("copper foil", False)):
        assert one(spark, X.quote_in_text(F.lit(quote), source)) is want
    assert one(spark, X.preprocess(F.lit("  Größe, x_1 – OK!  "))) == "größe x_1 ok"
    assert one(spark, X.preprocess_g0(F.lit("ICT-Hardware & co."))) == "icthardware co"
    assert one(spark, X.first_email(F.lit("write to <Info@Example.COM>, now"))) == "info@example.com"
    assert [one(spark, X.parse_fit(F.lit(v))) for v in ("direct fit", "YES", "supplier", "nope", None)] == ["Direct", "Direct", "Partial", "No", "No"]
    assert [one(spark, X.sector_label(F.lit(v))) for v in ("MedTech", "Pharmaceutical", "Oil, Gas, Energy & Water")] == ["medical devices", "pharmaceutical manufacturing", "energy"]


def test_terminology_is_not_fixed_twice(spark):
    for raw, want in (("the Saudi FDA", "the SFDA"), ("Saudi Food and Drug Authority", "Saudi Food and Drug Authority (SFDA)"), ("Saudi Food and Drug Authority (SFDA)", "Saudi Food and Drug Authority (SFDA)"), ("plain", "plain")):
        got = one(spark, X.normalize_terminology(F.lit(raw)))
        assert got == want and one(spark, X.normalize_terminology(F.lit(got))) == want


def sector(spark, a, b, capability):
    df = spark.createDataFrame([(a, b, capability)], "a string, b string, cap array<string>")
    return O.with_sector_score(df, "a", "b", "cap").first()


def test_sector_score(spark):
    r = sector(spark, "  medtech!", "MedTech", [])
    assert (r.sector_score, r.sector_label, r.bridge_name) == (1.0, "Exact", None) and r.sector_reason.startswith("Exact sector match")
    r = sector(spark, "ICT Hardware", "Healthcare", ["software", "imaging", "x"])
    assert (r.sector_score, r.bridge_name) == (0.52, "ICT ↔ Medical") and r.sector_reason.endswith("via capabilities: imaging, software.")
    assert sector(spark, "ICT Hardware", "Healthcare", ["software", "data"]).bridge_name is None  # generic words only
    assert sector(spark, "ICT Hardware", "Healthcare", ["imaging"]).bridge_name is None  # one word only
    assert sector(spark, "", "Healthcare", ["imaging"]).sector_label == "Unknown"


def test_decision_g3_at_every_step(spark):
    """Each cut from both sides, for each state of link and verdict."""
    cuts = {
        (True, None, False): [(0.85, "High Fit"), (0.70, "Good Fit"), (0.50, "Review Needed"), (0.0, "Low Fit")],
        (True, None, True): [(0.70, "Good Fit"), (0.50, "Review Needed"), (0.0, "Low Fit")],
        (False, None, False): [(0.55, "Review Needed"), (0.0, "Low Fit")],
        (True, "Yes", False): [(0.60, "High Fit"), (0.0, "Good Fit")],
        (True, "Partial", True): [(0.0, "Partner Fit")],
        (True, "Not Run", False): [(0.0, "Low Fit")],
    }
    rows, want = [], []
    for (linked, verdict, bridge), steps in cuts.items():
        for i, (cut, label) in enumerate(steps):
            rows += [(cut + 1e-6, True, linked, verdict, bridge), (cut + 1e-6, False, linked, verdict, bridge)]
            want += [label, "Low Fit"]
            if cut:
                rows.append((cut - 1e-6, True, linked, verdict, bridge))
                want.append(steps[i + 1][1])
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, f double, q boolean, l boolean, v string, b boolean")
    got = df.select("k", O.decision_g3(*[F.col(c) for c in "fqlvb"]).alias("x")).orderBy("k").collect()
    assert [r.x for r in got] == want


def votes(spark, *fits):
    df = spark.createDataFrame([(1, i, f, 0.5 + i / 10, f"e{i}") for i, f in enumerate(fits) if f], "pair int, round int, fit string, confidence double, explanation string")
    return B.majority(B.counted_votes(df, "pair"), "pair").first()


def test_voting(spark):
    assert votes(spark, "Direct", "Direct", "No")[1:4] == ("Direct", 0.37, "2/3")
    r = votes(spark, "Direct", "Partial", "No")
    assert (r.fit, r.agreement) == ("No", "1/3")
    assert votes(spark, "Partial", "Partial", "Partial", "No", "No").agreement == "3/3"
    assert votes(spark, "Direct", "Direct", "No", "Direct", "Direct").agreement == "4/5"


def test_taxonomy_and_value_chain(spark):
    sim = lambda a, b: one(spark, O.taxonomy_similarity(*lit(a, b)))
    assert sim("industrial manufacturing", "ict hardware") == 0.45 and sim("industrial chemicals", "pharmaceutical manufacturing") == 0.55
    assert sim("biotechnology", "pharmaceutical manufacturing") == 0.65 and sim("robotics", "robotics") == 1.0 and sim("industrial", "industrial manufacturing") == 0.80
    assert sim("mining & minerals", "pharmaceutical manufacturing") <= 0.2 and sim("", "robotics") == 0.30
    vc = lambda needs, role: one(spark, O.value_chain_score(F.array(*lit(*needs)), F.lit(role), F.lit("")))
    assert vc(["Developer"], "Raw Material Supplier") <= 0.2 and vc(["Developer"], "Research Company") >= 0.85 and 0.4 <= vc(["Developer"], "Contract Manufacturer") <= 0.6
    assert vc(["OEM", "Developer"], "Developer") == 0.9


def test_penalties(spark):
    factor, names = O.penalties(*lit(0.2, 0.4, 0.8, 0.15, "Raw Material Supplier", "Developer"))
    got = one(spark, names)
    assert {"supplier_to_developer", "sector_mismatch", "product_only_similarity", "value_chain_mismatch"} == set(got) and one(spark, factor) < 0.5


@pytest.mark.parametrize(
    ("final", "gate", "human", "light", "want"),
    [
        (0.8, "No", None, False, "Weak Match"), (0.8, "Partial", None, False, "Strong Match"), (0.4, None, "Agree", False, "Good Match"), (0.9, "Direct", "Disagree", False, "Poor Match"),
        (0.8, None, None, False, "Potential Match"), (0.8, "Direct", None, True, "Potential Match"), (0.8, "No", None, True, "Weak Match"), (0.3, "Direct", None, True, "Weak Match"), (0.75, "Yes", None, False, "Excellent Match"),
    ],
)
def test_decide_g4(spark, final, gate, human, light, want):
    assert one(spark, O.decide_g4(F.lit(final), F.lit(gate).cast("string"), F.lit(human).cast("string"), F.lit(light))) == want


def test_match_type_and_status(spark):
    kind = lambda *a: one(spark, O.match_type(*lit(*a)))
    assert kind("Weak Match", 0.9, "Joint venture", "OEM") == "Not a target"
    assert kind("Excellent Match", 0.95, "Joint venture", "OEM") == "Anchor candidate"
    assert kind("Strong Match", 0.5, "", "OEM") == kind("Good Match", 0.75, "", "") == kind("Good Match", 0.1, "Joint venture", "") == "JV partner"
    assert kind("Good Match", 0.9, "", "Distributor") == "Supplier localization" and kind("Good Match", 0.1, "", "") == "Ecosystem player"
    rows = [(1, "Poor Match", "Not a target"), (2, "Good Match", "Supplier localization"), (3, "Excellent Match", "Anchor candidate")]
    got = dict(O.opportunity_status(spark.createDataFrame(rows, "k int, decision string, match_type string"), "k").collect())
    assert got[1].startswith("No viable") and got[2].startswith("No anchor") and got[3].startswith("Anchor")


def test_confidence(spark):
    c = one(spark, O.confidence_g4(F.lit(600), F.lit(0.8), F.array(*lit(0.5, 0.55, 0.5, 0.6, 0.5)), F.lit("3/3"), F.lit(1.0), F.lit(False)))
    assert 0 <= c <= 100 and one(spark, O.confidence_label(F.lit(c))) == "High"
    assert one(spark, O.confidence_g4(F.lit(0), F.lit(0.2), F.array(*lit(0.0, 1.0)), F.lit(""), F.lit(0.1), F.lit(True))) < c


def test_human_feedback(spark):
    reviews = spark.createDataFrame([("A", "X", "agree", 1), ("B", "X", "Not a fit", 2), ("C", "X", "maybe", 3), ("A", "X", "no", 4)], "company string, opportunity string, verdict string, seq int")
    assert {(r.company, r.label) for r in readers.human_reviews(reviews, "seq").collect()} == {("A", 0), ("B", 0)}
    p = spark.createDataFrame([("A", True, "Partner Fit", 0), ("B", False, "Low Fit", 1), ("C", True, "Partner Fit", None)], "c string, validated_fit boolean, ai_decision string, human int")
    got = {r.c: (r.validated_fit, r.ai_decision, r.changed) for r in B.human_overrides(p).collect()}
    assert got == {"A": (False, "Low Fit", True), "B": (True, "Partner Fit", True), "C": (True, "Partner Fit", False)}
    again = B.human_overrides(B.human_overrides(p).drop("changed"))
    assert again.filter("changed").count() == 0


def test_verdict_flips(spark):
    log = spark.createDataFrame([("A", 1, "Direct", "r1"), ("A", 2, "Partial", "old"), ("B", 1, "Partial", "r1")], "k string, o int, decision string, rubric string")
    now = spark.createDataFrame([("A", "No"), ("B", "Partial"), ("C", None)], "k string, verdict string")
    got = B.verdict_flips(now, log, ["k"], "o", F.lit("r1")).collect()
    assert [(r.k, r.previous_verdict, r.rubric_changed, r.new_verdict, r.agreement) for r in got] == [("A", "Partial", "yes", "No", "")]


def test_calibration_needs_a_pool_and_is_monotone(spark):
    scored = spark.createDataFrame([(0.1,), (0.5,), (0.9,)], "final_score double")
    small = spark.createDataFrame([(0.1, 0, 1.0)], "final_score double, y int, weight double")
    assert B.calibrate(small, scored).filter("match_probability IS NOT NULL").count() == 0
    pool = spark.createDataFrame([(i / 60, int(i > 30 or i % 7 == 0), 1.0) for i in range(60)], "final_score double, y int, weight double")
    p = [r.match_probability for r in B.calibrate(pool, scored).orderBy("final_score").collect()]
    assert 0 < p[0] < p[1] < p[2] < 1


def test_calibration_equals_newton_steps(spark):
    """The regularised fit against plain Newton steps: the intercept is free, the slope pays half its square."""
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 1, 120)
    y = (rng.uniform(0, 1, 120) < 1 / (1 + np.exp(3 - 6 * x))).astype(int)
    w = rng.choice([0.6, 1.0, 3.0], 120)
    pool = spark.createDataFrame([(float(a), int(b), float(c)) for a, b, c in zip(x, y, w, strict=True)], "final_score double, y int, weight double")
    grid = [0.05, 0.3, 0.5, 0.77, 0.99]
    got = B.calibrate(pool, spark.createDataFrame([(g,) for g in grid], "final_score double")).orderBy("final_score").collect()
    beta, z = np.zeros(2), np.column_stack((np.ones(120), x))
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        grad = z.T @ (w * (p - y)) + np.array([0, beta[1]])
        beta -= np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + np.diag([0, 1]), grad)
    want = [1 / (1 + np.exp(-(beta[0] + beta[1] * g))) for g in grid]
    assert np.allclose([r.match_probability for r in got], want, atol=2e-3)


def test_keyword_hits_equal_brute_force(spark):
    rng = random.Random(2)
    words = "cable cables assembly assemble assembling casting cast steel steels relational relate hopping hop x".split()
    rows = []
    for k in range(150):
        phrases = [rng.choice(["", " "]) + " ".join(rng.choices(words, k=rng.randint(0, 3))) for _ in range(rng.randint(0, 5))]
        rows.append((k, phrases if k % 10 else None, " ".join(rng.choices(words, k=rng.randint(0, 6))) if k % 7 else None))
    got = {r.k: r.hits for r in M.keyword_hits(spark.createDataFrame(rows, "k int, ph array<string>, t string"), "ph", "t").collect()}

    def parts(text):
        return [w for w in re.findall(r"[a-zA-Z][a-zA-Z0-9\-]{1,}", (text or "").lower()) if len(w) > 2]

    def hits(phrases, text):
        held = {M.porter_stem(w) for w in parts(text)}
        n = 0
        for p in (p.strip() for p in phrases or []):
            mine = {M.porter_stem(w) for w in parts(p)}
            n += len(p) >= 2 and (p.lower() in (text or "").lower() or bool(mine) and mine <= held)
        return n

    assert got == {k: hits(p, t) for k, p, t in rows}


def test_exemplars_leave_the_own_pair_out(spark):
    log = spark.createDataFrame([(k, k * 10, f"line {k}") for k in range(12)] + [(3, 999, "line 3 again")], "pair int, o int, t string")
    targets = spark.createDataFrame([(3,), (11,), (77,)], "pair int")
    got = {r.pair: r.exemplars for r in B.exemplars(log, targets, ["pair"], "o", F.col("t")).collect()}
    assert got[3] == [f"line {k}" for k in (4, 5, 6, 7, 8, 9, 10, 11)]
    assert got[11] == [f"line {k}" for k in (4, 5, 6, 7, 8, 9, 10)] + ["line 3 again"]
    assert got[77] == [f"line {k}" for k in (5, 6, 7, 8, 9, 10, 11)] + ["line 3 again"]


def test_reviews_of_pairs_without_a_verdict_count(spark):
    log = spark.createDataFrame([("A", 1, "Direct", "r", 0.7)], "k string, o int, decision string, rubric string, final_score double")
    reviews = spark.createDataFrame([("A", 0), ("B", 1), ("C", 1)], "k string, label int")
    current = spark.createDataFrame([("A", 0.1), ("B", 0.4)], "k string, final_score double")
    got = {r.k: (r.final_score, r.y, r.weight) for r in B.label_pool(log, reviews, ["k"], "o", F.lit("r"), current).collect()}
    assert got == {"A": (0.7, 0, 3.0), "B": (0.4, 1, 3.0)}


def test_ids_come_from_a_column_or_from_places(spark):
    df = spark.createDataFrame([("b", "7"), ("a", "x"), ("c", None)], "name string, companyId string")
    assert [r.id for r in readers.identified(df, "company", "id").orderBy("name").collect()] == [0, 7, 0]
    assert [r.at for r in readers.identified(df.drop("companyId"), "company", "at", [F.col("name")]).orderBy("name").collect()] == [1, 2, 3]
    assert readers.id_column(spark.createDataFrame([(1,)], ["Id"]), "x") == "Id"


def test_stage_tables_are_removed(spark):
    df = stages.stage(spark.range(3), "gone")
    assert df.count() == 3
    path = stages._made[-1][1]
    stages.remove_stages()
    assert readers.first_existing(spark, [path]) is None and not stages._made


def test_positions_are_a_permutation(spark):
    df = spark.createDataFrame([(i, float(i * 7919 % 13)) for i in range(200)], "k int, v double")
    got = Z.percentile_rank(df, "v", ["k"], "p").orderBy("v", "k").collect()
    assert [round(r.p * 199) for r in got] == list(range(200)) and got[0].p == 0 and got[-1].p == 1
    assert Z.percentile_rank(df.limit(0), "v", ["k"], "p").count() == 0


def test_char_grams_pad_words(spark):
    df = spark.createDataFrame([(1, "ab a")], "k int, t string")
    got = {(r.gram, r.tf) for r in Z.char_grams(df, "k", "t").collect()}
    assert got == {(" ab", 1), ("ab ", 1), (" ab ", 1), (" a ", 1)}


def test_ranks(spark):
    df = spark.createDataFrame([(1, 1, 0.5, True), (1, 2, 0.9, False), (1, 3, 0.5, True)], "g int, k int, s double, qualified boolean")
    assert {r.k: r.r for r in R.qualified_rank(df, "g", "s", ["k"], "r").collect()} == {1: 1, 2: None, 3: 2}


def test_stems_and_labels(spark):
    words = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "plastered": "plaster", "motoring": "motor", "hopping": "hop", "relational": "relat", "conditional": "condit", "digitizer": "digit", "adjustable": "adjust", "probate": "probat", "rate": "rate", "controlling": "control"}
    assert {w: M.porter_stem(w) for w in words} == words
    df = spark.createDataFrame([(1, ["cable assembly", "steel casting", "x"], "We assemble cables and cast steel")], "k int, ph array<string>, t string")
    assert M.keyword_hits(df, "ph", "t").first().hits == 1
    assert M.keyword_hits(df, "ph", "t", stemmed=False).first().hits == 0


def test_arrays(spark):
    assert one(spark, A.exactly_three(F.array(*lit(" a ", "", "b")))) == ["a", "b", ""]
    assert one(spark, A.parse_json_list(F.lit('["x", " ", "y"]'))) == ["x", "y"] and one(spark, A.parse_json_list(F.lit("{broken"))) == []
    assert one(spark, A.strip_fence(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}'
    assert len(one(spark, A.rubric_version(*lit("a", "b")))) == 8


def test_sources_and_sinks(spark, tmp_path):
    raw = spark.createDataFrame([("Quarry Bros LLC", "makes cables", "cables", "ICT"), ("QUARRY BROS", "makes cables and more", "cables", "ICT"), ("Other", None, "steel", None)], ["Company Name", " company profile", "Product/Services", "Sector"])
    c = readers.companies(raw)
    assert sorted(r.company_name for r in c.collect()) == ["Other", "QUARRY BROS"] and {"combined", "combined_focused", "products_clean"} <= set(c.columns)
    o = readers.opportunities(spark.createDataFrame([("Hub", "ICT", "Copper 9,800 USD in Saudi Arabia")], ["What is the opportunity name?", "Sector", "What is the opportunity description?"]))
    assert "saudi" not in o.first().requirement_focused.lower()
    with pytest.raises(KeyError):
        readers.companies(raw.drop("Sector"))
    both = readers.union_sheets([raw, spark.range(3)], readers.companies)
    assert both.count() == 2
    stages.append_jsonl(spark.createDataFrame([("t", "A", "X", "Direct")], "ts string, company string, opportunity string, decision string"), str(tmp_path / "log"))
    stages.append_jsonl(spark.createDataFrame([("u", "A", "X", "No")], "ts string, company string, opportunity string, decision string"), str(tmp_path / "log"))
    log = readers.read_verdicts(spark, str(tmp_path / "log"))
    assert R.latest(log, ["company", "opportunity"], "ts").first().decision == "No"
    assert readers.read_verdicts(spark, str(tmp_path / "none")).count() == 0 and readers.read_reviews(spark, str(tmp_path / "none")).count() == 0
    stages.write_csv(spark.range(2), str(tmp_path / "csv" / "sub"))
    assert folders.read_folder(spark, str(tmp_path / "csv"))[0].count() == 2
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "Energy_plan.txt").write_text("a\nb")
    assert readers.read_documents(spark, str(tmp_path / "docs")).first()[1:] == ("Energy", "a\nb", 3, 1)
    assert readers.email_column(spark.createDataFrame([(1,)], ["E-Mail "])) == "E-Mail "
