"""End-to-end plans and what follows a model's reply."""

import pytest
from pyspark.sql import functions as F

from pairforge.operators import providers as P
from pairforge.plans import engine
from pairforge.sources import stages
from pairforge.streaming import verdict_log


@pytest.fixture(scope="module")
def sides(spark):
    firms = [
        (1, "Alpha", "Industrial Manufacturing", "makes switchgear cables sensors and electronics enclosures", "cables sensors enclosures"),
        (2, "Beta", "ICT Hardware", "assembles antennas baseband servers", "antennas baseband servers"),
        (3, "Gamma", "Mining", "digs ore", "ore"),
        (4, "Delta", "Pharmaceutical", "fills sterile vials formulation", "vials formulation"),
    ]
    deals = [(10, "Antenna plant", "ICT Hardware", "antennas baseband cables sensors wiring plant"), (11, "Vial line", "Pharmaceutical", "sterile vials formulation filling line")]
    return spark.createDataFrame(firms, "cid long, name string, sector string, combined string, products string"), spark.createDataFrame(deals, "oid long, title string, sector string, requirement string")


def test_calibrated_engine(spark, sides):
    c, o = sides
    votes = spark.createDataFrame([(2, 10, r, "Direct", 0.9, "fits") for r in range(3)] + [(4, 11, r, f, 0.5, "e") for r, f in enumerate(["No", "No", "Partial", "No", "No"])], "cid long, oid long, round int, fit string, confidence double, explanation string")
    views = engine.run_calibrated(c, o, votes, spark.createDataFrame([(1, 10, 0)], "cid long, oid long, label int"))
    rows = {(r.cid, r.oid): r for r in views["All_Pairs"].collect()}
    assert len(rows) == 8 and all(0 <= r.sem_profile <= 1 and r.final_score <= 1 for r in rows.values())
    assert rows[2, 10].verdict == "Direct" and rows[2, 10].validated_fit and rows[2, 10].ai_decision in ("High Fit", "Good Fit")
    assert rows[4, 11].verdict == "No" and rows[4, 11].agreement == "4/5" and rows[4, 11].ai_decision == "Low Fit"
    assert rows[1, 10].ai_decision == "Low Fit" and not rows[1, 10].validated_fit
    assert not rows[3, 11].qualified and rows[3, 11].rank_for_opportunity is None
    assert {r.oid for r in views["Abstentions"].collect()} == {11}
    assert views["Opportunity_View"].count() >= 2
    plain = engine.run_calibrated(c, o)
    assert plain["Abstentions"].filter("status LIKE 'No validated%'").count() == 0


def test_calibrated_engine_with_vectors_log_and_consortium(spark, sides):
    c, o = sides
    firm = lambda k: [float(k == j) + 0.1 for j in range(3)]
    a = spark.createDataFrame([(k, firm(k % 3), firm(k % 3), firm(k % 3), None if k == 3 else firm(0)) for k in range(1, 5)], "cid long, profile array<double>, profile_focused array<double>, product array<double>, product_focused array<double>")
    b = spark.createDataFrame([(10, firm(2), firm(2)), (11, firm(1), firm(0))], "oid long, requirement array<double>, requirement_focused array<double>")
    votes = spark.createDataFrame([(2, 10, r, "Direct", 0.9, "fits") for r in range(3)], "cid long, oid long, round int, fit string, confidence double, explanation string")
    log = spark.createDataFrame([(2, 10, "t1", "No", "r0", 0.5)] + [(100 + k, 10, "t0", "Direct" if k > 20 or k % 5 == 0 else "No", "r1", k / 40) for k in range(40)], "cid long, oid long, ts string, decision string, rubric string, final_score double")
    needs = spark.createDataFrame([(10, k, f"need {k}", "q") for k in range(3)], "oid long, seq int, capability string, quote string")
    cover = spark.createDataFrame([(10, 0, "need 1 and more", [("Beta", "near")])], "oid long, pos int, need string, companies array<struct<name:string,why:string>>")
    views = engine.run_calibrated(c, o, votes, None, 3, log, "r1", "ts", needs, cover, (a, b))
    rows = {(r.cid, r.oid): r for r in views["All_Pairs"].collect()}
    assert len(rows) == 8 and rows[2, 10].profile == pytest.approx(1) and rows[3, 10].product == 0
    share = rows[1, 11].profile  # firm 1 against a mix of 1 and 0
    assert 0.5 < share < 1 and share > rows[2, 11].profile
    assert all(0 < r.match_probability < 1 for r in rows.values())
    flips = [(r.cid, r.oid, r.previous_verdict, r.rubric_changed, r.new_verdict) for r in views["Verdict_Changes"].collect()]
    assert flips == ([(2, 10, "No", "yes", "Direct")] if rows[2, 10].verdict == "Direct" else [])
    assert sorted((r.need, r.gap) for r in views["Consortium_View"].collect()) == [("need 0", "GAP"), ("need 1", ""), ("need 2", "GAP")]
    d = views["Diagnostics"].first()
    assert (d.pairs_total, d.companies_total, d.consortium_ready_opportunities, d.verdict_flips, d.calibrated) == (8, 4, 1, len(flips), True)


def test_taxonomy_engine(spark, sides):
    c, o = sides
    pairs = c.select("cid").crossJoin(o.select("oid")).withColumns({"sem_profile": F.lit(0.9), "sem_product": F.lit(0.9)})
    replies = spark.createDataFrame([(2, "ict hardware", "OEM", "bad role", 0.9, {"jv_potential": 0.8})], "cid long, normalized_sector string, value_chain_role string, secondary_role string, classification_confidence double, readiness map<string,double>")
    firms = P.company_enrichment(c, replies, "cid").withColumn("length", F.length("combined"))
    deals = P.opportunity_enrichment(o, spark.createDataFrame([(10, "ict hardware", ["OEM", "nonsense"])], "oid long, normalized_sector string, required_roles array<string>"), "oid")
    verdicts = spark.createDataFrame([(2, 10, "Direct", "3/3", "Agree", "")], "cid long, oid long, gate string, votes string, human string, model string")
    rows = {(r.cid, r.oid): r for r in engine.run_taxonomy(pairs, firms.drop("name", "sector", "combined", "products"), deals.drop("title", "sector", "requirement"), verdicts).collect()}
    assert rows[2, 10].decision == "Excellent Match" and rows[2, 10].match_type == "Anchor candidate" and rows[2, 10].pursue_rank == 1
    assert rows[2, 10].status == "Anchor candidate identified" and rows[3, 10].lead_decision == "Excellent Match"
    assert "value_chain_mismatch" not in rows[2, 10].penalties and rows[4, 11].decision == "Potential Match"


def test_triage_engine(spark):
    pairs = spark.createDataFrame([(1, 1, 0.9, 0.1, False, False, 0, 0, 0.1), (2, 1, 0.1, 0.2, False, False, 1, 0, 0.1), (3, 1, 0.1, 0.9, True, False, 2, 0, 0.1)], "cid long, oid long, profile double, product double, overlap boolean, adjacent boolean, keywords int, inputs int, struct_product double")
    out = {r.cid: r for r in engine.run_triage(pairs, spark.createDataFrame([(3, 1, " YES ")], "cid long, oid long, ai_decision string")).collect()}
    assert [out[k].ai_decision for k in (1, 2, 3)] == ["No", "Filtered", "Yes"] and out[3].rank == 1 and {r.id for r in out.values()} == {1, 2, 3}
    assert out[3].triage_reason == "sector_overlap + capability_keywords:2" and out[2].triage_reason.startswith("no_pass overlap=0, adj=0, capability_kw=1")


def test_replies(spark):
    df = spark.createDataFrame([('```json\n{"decision": "Yes", "confidence": 1.7}\n```',), ("yes, it does",), ("not json",), (None,)], "r string")
    said, conf = P.single_reply_g1(F.col("r"))
    assert [tuple(r) for r in df.select(said, conf).collect()] == [("Yes", 1.0), ("Yes", 0.8), ("No", 0.2), ("Not Run", 0.0)]
    said, score = P.single_reply_g0(F.col("r"))
    assert [tuple(r) for r in df.select(said, score).collect()][1:] == [("Yes", 0.95), ("No", 0.3), ("Error", 0.0)]
    one = spark.createDataFrame([("YES", "250", "very", ["a"], None)], "ai_decision string, match_value string, match_confidence string, suggested_plan array<string>, match_reason array<string>")
    r = P.scored_decision(one).first()
    assert (r.ai_decision, r.match_value, r.match_confidence, r.suggested_plan, r.match_reason) == ("Yes", 100, "Low", ["a", "", ""], ["", "", ""])
    entries = P.ontology_entries(spark.createDataFrame([("ICT",), ("New",)], "sector string"), spark.createDataFrame([("ICT", " ", ["IT"], None, [""])], "sector string, canonical string, synonyms array<string>, sub_domains array<string>, adjacent_domains array<string>"))
    assert {tuple(map(str, r)) for r in entries.collect()} == {("ICT", "ICT", "['IT']", "[]", "[]"), ("New", "New", "[]", "[]", "[]")}
    mail = spark.createDataFrame([('{"email": "A@b.org"}',), ("write to c@d.net.",), (None,)], "r string")
    assert [r[0] for r in mail.select(P.email_reply(F.col("r"))).collect()] == ["a@b.org", "c@d.net", ""]
    firms = spark.createDataFrame([(1, "A  b", ""), (2, "C", "ICT"), (3, "D", None)], "company_id long, company_name string, sector string")
    got = {r.company_id: (r.effective_sector, r.inferred) for r in P.sector_inference(firms, spark.createDataFrame([("id:1:a b", "Mining", "web"), ("id:3:d", "Odd", "web")], "key string, sector string, source string"), ["Mining", "ICT"]).collect()}
    assert got == {1: ("Mining", True), 2: ("ICT", False), 3: ("", False)}


def test_verdict_stream(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "latest")
    write = lambda rows: spark.createDataFrame(rows, "ts string, company string, opportunity string, decision string").coalesce(1).write.mode("append").json(log)
    for rows in ([("1", "A", "X", "Direct"), ("2", "A", "X", "No"), ("1", "B", "X", "Partial")], [("3", "A", "X", "Partial")]):
        write(rows)
        verdict_log.keep_latest(verdict_log.read_log(spark, log), out, str(tmp_path / "cp")).awaitTermination()
    assert {(r.company, r.decision) for r in verdict_log.current(spark, out).collect()} == {("A", "Partial"), ("B", "Partial")}


def test_calibrated_engine_makes_what_is_asked_for(spark, sides, monkeypatch):
    made, keep = [], engine.stage
    monkeypatch.setattr(engine, "stage", lambda df, name="stage": made.append((name, df.columns)) or keep(df, name))
    c, o = sides
    every = engine.run_calibrated(c, o)
    some = engine.run_calibrated(c, o, views=("Abstentions",), explained=False)
    assert list(some) == ["Abstentions"] and sorted(some["Abstentions"].collect()) == sorted(every["Abstentions"].collect())
    names = [n for n, _ in made]
    assert "pairs" not in names and names.count("decided") == 1  # pairs are staged once before they are ranked, not again where one view is asked for
    explained = [{"terms", "sector_reason"} & set(x) for n, x in made if n == "scored"]
    assert explained == [{"terms", "sector_reason"}, set()]
    twice = engine.score_pairs(c.union(c.filter("cid = 3")), o, explained=False)  # a key that is there twice meets itself in the join of its sector, too
    assert twice.filter("cid = 3").count() == 2 * 2 * 2


def test_calibrated_engine_ranks_pairs_where_they_are_made(spark, sides, monkeypatch):
    from pairforge.operators import similarity

    made = []
    monkeypatch.setattr(similarity, "stage", lambda df, name="stage": made.append(name) or stages.stage(df, name))
    c, o = sides
    pairs = engine.score_pairs(c, o, explained=False)
    assert "ranked" not in made and "_range" not in pairs.columns  # all pairs were staged before they were sorted
    scores = lambda p: sorted((str(r.cid), r.oid, r.sem_profile, r.sem_product, r.final_score) for r in p.collect())
    monkeypatch.setattr(engine, "MOST_RANGES", 1)
    assert scores(pairs) == scores(engine.score_pairs(c, o, explained=False))
