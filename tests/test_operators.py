from datetime import date

import pytest
from pyspark.sql import functions as F

from leadrank import rules
from leadrank.operators import (evaluate, features, ground, history, lists, match, nested, points, quality, rank,
                                score, staging)

D = date


def inspections(spark, rows):
    """activity_nr, facility_id, name, zip5, naics, employees, insp_type, open_date, dust_program"""
    return spark.createDataFrame(
        [(r[0], r[1], r[2], "1 ELM", "TOWN", "MI", r[3], r[4], r[5], r[6], r[7], False, r[8]) for r in rows],
        "activity_nr long, facility_id string, estab_name string, site_address string, site_city string, "
        "site_state string, zip5 string, naics_code string, employees int, insp_type string, open_date date, "
        "review_required boolean, dust_program string")


def violations(spark, rows):
    """activity_nr, standard, viol_type, issuance_date, contest_date, final_order_date"""
    return spark.createDataFrame(
        [(r[0], "01001", r[1], r[2], r[3], 10.0, 20.0, r[4], r[5]) for r in rows],
        "activity_nr long, citation_id string, standard string, viol_type string, issuance_date date, "
        "current_penalty double, initial_penalty double, contest_date date, final_order_date date")


@pytest.fixture(scope="module")
def world(spark):
    fi = inspections(spark, [
        (1, "a", "OLD NAME", "48104", "321918", 50, "H", D(2020, 1, 1), None),
        (2, "a", "NEW NAME", None, "332710", None, "H", D(2024, 6, 30), None),
        (3, "b", "B CO", "48105", "999", None, "M", D(2023, 5, 1), None),
        (4, "c", "C CO", "48106", "337110", 5, "H", D(2023, 1, 1), "Combustible Dust NEP"),
        (5, "d", "D CO", "48107", None, None, "A", D(2021, 1, 1), "Silica emphasis program"),
    ])
    viol = violations(spark, [
        (1, "19100094 A01", "S", D(2021, 6, 29), None, None),       # a day before the window
        (2, "19100134 E01", "O", D(2023, 6, 30), None, None),
        (3, "19100212 A01", "S", D(2023, 7, 1), None, None),
        (4, "5A0001", "S", D(2023, 2, 1), None, None),              # dust because of the program
        (5, "19101000 A", "O", D(2020, 1, 1), D(2020, 3, 1), None),  # old, but still under contest
        (2, None, "S", D(2024, 6, 1), None, None),                  # no code: no evidence
    ])
    inj = spark.createDataFrame([(3, D(2015, 1, 1), "fatality"), (1, D(2019, 1, 1), "fatality"),
                                 (4, D(2023, 12, 1), "hospitalized"), (2, None, "hospitalized")],
                                "activity_nr long, event_date date, degree string")
    params = features.run_params(fi, viol)
    return fi, viol, inj, params, features.standard_lookup(viol)


def test_run_params(world):
    assert tuple(world[3].first()) == (D(2024, 6, 30), D(2021, 6, 30), D(2022, 6, 30))


def test_latest_values_skip_nulls(world):
    fi, _, _, params, _ = world
    a = features.facilities(fi, params).filter("facility_id = 'a'").first()
    assert (a.name, a.zip5, a.naics, a.employees, a.naics_conflict, a.name_variants, a.n_inspections,
            a.n_inspections_window) == ("NEW NAME", "48104", "332710", 50, True, 2, 2, 1)


def test_holds(world):
    fi, viol, inj, params, _ = world
    got = {r.facility_id: tuple(r)[1:] for r in features.holds(fi, viol, inj, params).collect()}
    assert got["a"] == (None, None, None)
    assert got["b"] == (D(2015, 1, 1), None, None)  # recent type M: the old matched death dates it
    assert got["c"] == (None, D(2023, 12, 1), None)
    assert got["d"] == (None, None, D(2020, 3, 1))


def test_rollup_equals_row_level(world):
    fi, viol, inj, params, lookup = world
    facts = features.facility_facts(fi, viol, inj, lookup, params)
    rolled = {r.facility_id: (r.dust_pts, r.evidence_date)
              for r in score.dust_level(facts).collect()}
    rows = score.dust_level(score.evidence_points(features.evidence(viol, fi, lookup, params)))
    flat = {r.facility_id: (r.dust_pts, r.evidence_date) for r in rows.collect()}
    assert rolled == {"a": (2, D(2023, 6, 30)), "b": (1, None), "c": (3, D(2023, 2, 1)), "d": (0, None)}
    assert all(rolled[k] == v for k, v in flat.items())


def test_score(spark, world):
    fi, viol, inj, params, lookup = world
    signals = spark.createDataFrame([("a", 0.5, ["X"], 1)], "facility_id string, release_lbs double, chemicals array<string>, forms int")
    s = {r.facility_id: r for r in score.score(
        features.facility_facts(fi, viol, inj, lookup, params), signals, params).collect()}
    a = s["a"]
    assert (a.industry_pts, a.dust_pts, a.recency_pts, a.size_pts, a.tri_air_pts, a.total) == (3, 2, 3, 2, 1, 11)
    assert (a.tier, a.confidence, a.hold_reason, a.outreach_eligible) == ("Hot", "Medium", None, True)
    assert (s["b"].tier, s["b"].hold_reason) == ("Archive", "fatality in the last 36 months")
    assert s["c"].hold_reason == "serious injury in the last 24 months" and not s["c"].outreach_eligible
    assert (s["d"].tier, s["d"].hold_reason) == ("Archive", "citation under contest")


@pytest.mark.parametrize("n, want", [(None, 0), (5, 0), (10, 1), (19, 1), (20, 2), (500, 2), (501, 1), (1000, 1), (1001, 0)])
def test_size_bands(spark, n, want):
    df = spark.createDataFrame([(n,)], "n int")
    assert df.select(score.size_points(F.col("n"))).first()[0] == want


def test_recency_edges(spark):
    days = [D(2023, 6, 30), D(2023, 6, 29), D(2022, 6, 30), D(2022, 6, 29), D(2021, 6, 30), D(2021, 6, 29), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d date")
    got = df.orderBy("i").select(score.recency_points(F.col("d"), F.lit(D(2024, 6, 30)))).collect()
    assert [r[0] for r in got] == [3, 2, 2, 1, 1, 0, 0]


def test_staging(spark):
    raw = spark.createDataFrame([
        ("1", " Mill ", "1 Elm", "T", "MI", "48104-22", "321", "12.0", "A", "H", "2020-01-02 00:00", "bad"),
        ("2", "X", "2 Elm", "T", "MI", "", "321", "5000", "A", "H", "2020-01-02", ""),
        ("3", "Y", "2 Elm", "T", "MI", None, "321", "7", "B", "H", "2020-01-02", None)],
        "activity_nr string, estab_name string, site_address string, site_city string, site_state string, "
        "site_zip string, naics_code string, nr_in_estab string, owner_type string, insp_type string, "
        "open_date string, close_case_date string")
    got = staging.inspections(raw).orderBy("activity_nr").collect()
    assert [(r.activity_nr, r.estab_name, r.zip5, r.employees_reported, r.employees, r.close_case_date) for r in got] == [
        (1, "Mill", "48104", 12, 12, None), (2, "X", None, 5000, None, None)]


def test_rank_over_many_partitions(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("g"), F.col("id")).repartition(9)
    ranked = rank.global_rank(df, [F.desc("g"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 501))
    assert [(r.g, r.id) for r in ranked] == sorted([(i % 7, i) for i in range(500)], key=lambda x: (-x[0], x[1]))
    # one group holds nearly all rows
    hot = spark.range(400).select(F.when(F.col("id") < 390, "hot").otherwise("rest").alias("g"), "id")
    got = rank.position_within(hot, ["g"], [F.desc("id")], "pos").collect()
    assert all(r.pos == (389 - r.id if r.g == "hot" else 399 - r.id) for r in got) and len(got) == 400


def test_nested_records_have_one_shape(spark, world):
    fi, viol, _, params, lookup = world
    many = viol.unionByName(violations(spark, [
        (4, "19100094 A01", "S", D(2023, 3, 1 + i % 28), None, None) for i in range(1200)]))
    ev = features.evidence(many, fi, lookup, params)
    got = nested.nested_inspections(ev).collect()
    assert len({r.facility_id for r in got}) == len(got)
    lists_of = {i.inspection_id: i.citations for r in got for i in r.inspections}
    assert len(lists_of) == sum(len(r.inspections) for r in got) and len(lists_of["4"]) >= 1200
    assert sum(map(len, lists_of.values())) == nested.kept_citations(ev).count()


def test_one_row_per_lead(spark):
    leads = spark.createDataFrame([("a", "48104", None), ("b", None, None), ("c", "1", "x")], "facility_id string, zip5 string, hold_reason string")
    places = spark.createDataFrame([("48104", 42.0, -83.0), ("48104", 41.0, -84.0), ("48104", 41.0, -82.0)], "zip5 string, lat double, lon double")
    got = {r.facility_id: (r.lat, r.lon) for r in lists.assemble(leads, places).collect()}
    assert got == {"a": (41.0, -84.0), "b": (None, None), "c": (None, None)}
    saved = spark.createDataFrame([("a", "audit"), ("a", "reached"), ("a", "nowhere")], "lead_id string, stage string")
    assert sorted(r.stage for r in lists.with_stage(leads, saved).collect()) == ["audit", "hold", "top"]
    dated = saved.withColumn("saved_at", F.when(F.col("stage") == "reached", 2).otherwise(1))
    assert sorted(r.stage for r in lists.with_stage(leads, dated).collect()) == ["hold", "reached", "top"]


def test_exact_amounts(spark):
    from leadrank.functions.values import amount
    texts = ["1,234.5", "0.000000000000000001", "0.0000000000000000001", "9" * 19, "9" * 20, "1e3", "-1", "x", " na ", "", None, "0", "1e-30"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(amount(F.col("t"))).collect()]
    assert [None if g is None else float(g) for g in got] == [1234.5, 1e-18, None, 1e19, None, 1000.0, None, None, 0.0, 0.0, 0.0, 0.0, None]


FORM_COLUMNS = ("year", "facility_name", "state", "zip", "chemical", "metal", "form_type", "unit", "fugitive_air",
                "stack_air", *match.NAICS_COLUMNS, "file_state")


def forms(spark, rows):
    """facility_name, zip, chemical, fugitive_air, naics_1, then overrides by role"""
    out = []
    for name, zip_code, chemical, air, naics, other in rows:
        row = {"year": "2024", "facility_name": name, "state": "MI", "zip": zip_code, "chemical": chemical,
               "metal": "YES", "form_type": "R", "unit": "Pounds", "fugitive_air": air, "stack_air": "NA",
               "naics_1": naics, "file_state": "MI", **other}
        out.append(tuple(row.get(c) for c in FORM_COLUMNS))
    return spark.createDataFrame(out, ", ".join(f"{c} string" for c in FORM_COLUMNS))


def test_unique_match(spark):
    fac = spark.createDataFrame([("f1", "Hill Forge Inc", "MI", "48104"), ("f2", "Twin Mill", "MI", "48105"),
                                 ("f3", "TWIN MILL LLC", "MI", "48105"), ("f4", "No Zip", "MI", None)],
                                "facility_id string, name string, state string, zip5 string")
    rows = forms(spark, [
        ("HILL FORGE", "48104-1", "LEAD", "1,000.25", "332", {}), ("Hill Forge, Inc.", "48104", " ZINC ", "0.5", "999", {}),
        ("HILL FORGE", "48104", "LEAD", "9", "332", {"metal": "NO"}), ("HILL FORGE", "48104", "LEAD", "9", "332", {"form_type": "A"}),
        ("HILL FORGE", "48104", "LEAD", "0", "332", {}), ("TWIN MILL", "48105", "LEAD", "1", "999", {"naics_6": " 3315"}),
        ("TWIN MILL", "48105", "LEAD", "1", "999", {}), ("NO ZIP", "", "LEAD", "1", "321", {}), ("GONE", "48104", "LEAD", "1", "111", {})])
    matched = match.matched_keys(rows, fac)
    assert [tuple(r) for r in match.air_signals(matched).collect()] == [("f1", 1000.75, ["LEAD", "ZINC"], 2)]
    assert tuple(match.match_stats(matched).first()) == (2, 1, 1, 1)
    bad = forms(spark, [("A", "1", "L", "x", "1", {}), ("A", "1", "L", "x", "1", {"metal": "no"}), ("A", "1", "L", "-1", "1", {}),
                        ("A", "1", "L", "1", "1", {"year": "2023"}), ("A", "1", "L", "1", "1", {"state": "OH"})])
    assert sorted(r.breach for r in match.form_contract_breaches(bad).collect()) == ["amount", "amount", "state", "year"]


def test_evaluation(spark):
    ranked = spark.createDataFrame([(f"f{i}", i) for i in range(1, 7)], "facility_id string, rank long")
    schema = "facility_id string, outcome string, qualified boolean, seq int"
    out = spark.createDataFrame([("f1", "Qualified", None, 1), ("f1", "???", None, 2), ("f2", "not now", True, 3), ("f3", None, True, 4),
                                 ("f9", "qualified", None, 5), ("f4", "unknown", None, 6), ("f2", "disqualified", None, 7)], schema)
    r = evaluate.evaluate_rankings(ranked, out, k=3).first()
    assert (r.k, r.precision_at_k, r.recall_at_k, r.lift_at_k, r.qualified_outcomes, r.total_leads, r.labeled_leads_at_k,
            r.labeled_coverage_at_k) == (3, 0.6667, 0.6667, 0.8889, 3, 6, 3, 1.0)
    none = evaluate.evaluate_rankings(ranked.filter("false"), out, k=3).first()
    assert (none.k, none.precision_at_k, none.recall_at_k, none.lift_at_k, none.qualified_outcomes, none.total_leads) == (0, None, 0.0, None, 0, 0)
    text_flag = spark.createDataFrame([("f1", "false", 1)], "facility_id string, qualified string, seq int")
    assert evaluate.resolve_outcomes(text_flag).count() == 0


def test_history(spark):
    schema = "as_of date, run_seq long, facility_id string"
    past = spark.createDataFrame([(D(2024, 1, m), m, f"f{m}") for m in range(1, 16)], schema)
    hot = spark.createDataFrame([("f15",), ("f14",), ("new",)], "facility_id string")
    ids = lambda df: sorted(r.facility_id for r in df.collect())
    assert ids(history.new_hot(hot, past, F.lit(D(2024, 2, 1)))) == ["f14", "new"]
    assert ids(history.new_hot(hot, past, F.lit(D(2024, 1, 15)))) == ["f15", "new"]  # re-run: against the date before
    assert ids(history.new_hot(hot, past.filter("false"), F.lit(D(2024, 2, 1)))) == []
    entry = spark.createDataFrame([(D(2024, 1, 3), "x"), (D(2024, 1, 3), "y")], "as_of date, facility_id string")
    kept = history.upsert_run(past, entry).collect()
    assert len({r.as_of for r in kept}) == 12 and sorted(r.facility_id for r in kept if r.as_of == D(2024, 1, 3)) == ["x", "y"]
    assert {r.run_seq for r in kept if r.as_of == D(2024, 1, 3)} == {16} and min(r.as_of for r in kept) == D(2024, 1, 3)


def test_write_run_replaces_its_date(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = lambda d, ids: spark.createDataFrame([(d, i) for i in ids], "as_of date, facility_id string")
    history.write_run(rows(D(2024, 1, 1), "ab"), path)
    history.write_run(rows(D(2024, 2, 1), "c"), path)
    history.write_run(rows(D(2024, 1, 1), "z"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("facility_id").collect()) == [("c",), ("z",)]


def test_stage_overrides_and_gaps(spark):
    leads = spark.createDataFrame([("a", None), ("b", "citation under contest"), ("c", None), ("d", None)],
                                  "facility_id string, hold_reason string")
    saved = spark.createDataFrame([("c", "audit"), ("d", "lost"), ("b", "reached")], "lead_id string, stage string")
    assert {r.facility_id: r.stage for r in lists.with_stage(leads, saved).collect()} == {
        "a": "top", "b": "reached", "c": "audit", "d": "top"}


def test_gate_stops(spark):
    schema = "check_no int, check_name string, bad_rows long, passed boolean, detail string"
    quality.require_passed(spark.createDataFrame([(1, "x", 0, True, "ok")], schema))
    with pytest.raises(RuntimeError, match="outputs not written"):
        quality.require_passed(spark.createDataFrame([(1, "x", 2, False, "2 bad rows")], schema))


def test_fit_to_box(spark):
    leads = spark.createDataFrame([(1, 42.0, -83.0), (2, 30.0, -97.0), (3, None, -90.0)], "id int, lat double, lon double")
    got = points.fitted(points.projected(leads)).collect()
    assert len(got) == 2 and {round(r.px, 6) for r in got} == {10.0, 990.0}
    assert min(round(r.py, 6) for r in got) == 10.0


DRAFT = ("draft_id string, facility_id string, attempt int, why_now string, "
         "talking_points array<struct<point:string,inspection_ids:array<string>>>, email_subject string, email_body string")


def test_grounding(spark):
    leads = spark.createDataFrame([("f1", "Hill Forge", "Town", "MI", "Metal", "332710", 45)],
                                  "facility_id string, name string, city string, state string, industry string, naics string, employees int")
    insp = spark.createDataFrame([("f1", 7001, D(2024, 1, 5), None, 2, 3)],
                                 "facility_id string, activity_nr long, opened date, dust_program string, citation_count long, other_citations long")
    cites = spark.createDataFrame([("f1", 7001, "29 CFR 1910.94(a)(1)", "Ventilation", "dust", "Serious", D(2024, 2, 1), 4500),
                                   ("f1", 7001, "29 CFR 1910.134(e)(1)", "Respirators", "adjacent", "Other", D(2024, 2, 1), 0)],
                                  "facility_id string, activity_nr long, standard string, title string, category string, type string, issued date, penalty_usd long")
    end = " Kind regards, The Field Team"
    good = ("good", "f1", 1, "Cited in 2024 with 2 citations and 4,500 in penalties.", [("Section 1910.94 in record 7001", ["7001"])],
            "A 20-minute call", "We saw one dust citation." + end)
    bad = ("bad", "f1", 1, "Fined 9,999.50 after 6 dust violations.", [("x", []), ("y", ["7001", "8"])], "Fatalities",
           "It costs $5 " + "word " * 200 + "bye" * 40)
    drafts = spark.createDataFrame([good, bad, ("bad", *good[1:2], 2, *good[3:])], DRAFT)
    found = ground.issues(drafts, leads, insp, cites, F.lit("2024-06-30"), "The Field Team")
    assert sorted(r.issue for r in found.filter("draft_id = 'bad' AND attempt = 1").collect()) == sorted([
        "talking point 1 cites no inspection ID", "talking point 2 cites unknown inspection ID 8",
        "why_now: number 9999.5 is not in the records",  # 6 and 5 stand in dates
        "why_now: '6 violations' doesn't match the records", "email_subject: mentions injury or death",
        "email_body: contains a dollar amount",
        "email_body: 204 words (limit 170)", "email_body: doesn't end with the 'The Field Team' sign-off"])
    assert found.filter("draft_id = 'good'").count() == 0
    verdict = {r.draft_id: (r.passed, r.first_try, r.attempts) for r in
               ground.verdicts(ground.attempt_results(drafts, found)).collect()}
    assert verdict == {"good": (True, True, 1), "bad": (True, False, 2)}
    assert ground.retry_table(drafts, found).select("draft_id").collect()[0][0] == "bad"
    assert {r.kind for r in found.collect()} == {k for _, k in rules.ISSUE_KINDS}
