"""Steps that many queries share: what they read, and that rare nulls keep their rows."""
from datetime import date

from leadrank import rules
from leadrank.functions import values
from leadrank.functions.codes import prefix_lookup
from leadrank.operators import features, ground, match, nested, quality
from leadrank.plans import catalog
from leadrank.plans.star_profile import StarTables
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_code_is_not_made_once_more_to_drop_null_ones(spark):
    assert "isnotnull(trim(" not in _plan(StarTables(spark, SMALL).evidence)


def test_names_are_counted_apart(spark):
    rows = [(n, f, f"{name}", "1 ELM", "TOWN", "MI", "48104", "321918", 50, "H", date(2024, 1, n), False, None)
            for n, (f, name) in enumerate([("a", "X"), ("a", "Y"), ("a", "X"), (None, "X"), (None, "Z"), ("b", "X")], 1)]
    fi = spark.createDataFrame(rows, "activity_nr long, facility_id string, estab_name string, site_address string, site_city string, "
                               "site_state string, zip5 string, naics_code string, employees int, insp_type string, open_date date, "
                               "review_required boolean, dust_program string")
    viol = spark.createDataFrame([(1, "1", None, "S", date(2024, 2, 1), None, None), (1, "2", "5A0001", "S", date(2024, 2, 1), None, None)],
                                 "activity_nr long, citation_id string, standard string, viol_type string, issuance_date date, "
                                 "contest_date date, final_order_date date").withColumns({"current_penalty": F.lit(1.0), "initial_penalty": F.lit(1.0)})
    injuries = spark.createDataFrame([], "activity_nr long, event_date date, degree string")
    params, lookup = features.run_params(fi, viol), features.standard_lookup(viol)
    facts = features.facility_facts(fi, viol, injuries, lookup, params)
    assert {r.facility_id: (r.name_variants, r.n_inspections) for r in facts.collect()} == {"a": (2, 3), None: (2, 2), "b": (1, 1)}
    assert facts.columns[:len(features.facilities(fi, params).columns)] == features.facilities(fi, params).columns
    assert "count(distinct" not in _plan(facts)
    # the citation without a code is no evidence
    assert [r.citation_id for r in features.evidence(viol, fi, lookup, params).collect()] == ["2"]


def test_the_gate_matches_forms_once_and_keeps_three_columns_of_evidence(spark):
    tables = catalog._gate_tables(StarTables(spark, SMALL))
    assert tables["evidence"].columns == ["facility_id", "activity_nr", "category"]
    files = tables["signals"].inputFiles()
    assert files and all("leadrank-matched" in f for f in files)



def test_citations_and_injuries_without_effect_are_not_grouped(spark):
    """Only citations that set a column of the rollup, and injuries of the two degrees, reach the grouping by record."""
    old, new, law = date(2001, 1, 1), date(2024, 2, 1), "5A0001"
    rows = [(1, law, "O", old, None, None), (2, law, "S", new, None, None), (3, "19100134", "O", new, None, None), (4, "19100134", "S", new, None, None),
            (5, law, "O", old, old, None), (6, law, "O", old, old, new), (7, None, "S", new, None, None), (8, law, "S", None, new, None), (9, "19101053", None, new, None, None)]
    viol = spark.createDataFrame(rows, "activity_nr long, standard string, viol_type string, issuance_date date, contest_date date, final_order_date date")
    lookup = spark.createDataFrame([(law, "General Duty Clause", "dust"), ("19100134", "Respirators", "other"), ("19101053", "Silica", "adjacent")],
                                   "standard string, title string, category string")
    got = {r.activity_nr: r for r in features.citation_rollup(viol, lookup, F.lit(date(2020, 1, 1))).collect()}
    assert set(got) == {2, 4, 5, 8, 9} and got[5].contest_day == old and got[5].dust_day is None and got[8].contest_day == new
    assert got[2].dust_day == new and got[4].serious and got[4].dust_day is None and got[9].plain_adjacent_day == new
    hurt = spark.createDataFrame([(1, None, "fatality"), (2, new, "hospitalized"), (3, new, "other"), (4, new, None)], "activity_nr long, event_date date, degree string")
    params = spark.createDataFrame([(new, date(2020, 1, 1), date(2020, 1, 1))], "as_of date, window_start date, injury_start date")
    assert {r.activity_nr: (r.fatal_undated, r.injured_day) for r in features.injury_rollup(hurt, params).collect()} == {1: (True, None), 2: (False, new)}


def test_costly_texts_are_worked_out_once(spark):
    """Names and amounts that a filter judges are not made again by the filter, and numbers keep their canonical form."""
    leads = spark.createDataFrame([("f1", "Alfa Mill", "AA", "44444"), ("f2", "", "AA", "44444"), ("f3", None, "AA", "44444")],
                                  "facility_id string, name string, state string, zip5 string")
    keys = match.entity_keys(leads)
    assert [r.facility_id for r in keys.collect()] == ["f1"] and _plan(keys).count(rules.RECORD_PREFIX) == 1
    blank = {f"naics_{i}": F.lit(None).cast("string") for i in range(1, 7)}
    forms = spark.createDataFrame([("Alfa", "x", "YES", "R", "pounds", "1,000.5", "na"), ("Beta", "x", "YES", "R", "pounds", "0", "0"),
                                   ("Gama", "x", "YES", "R", "pounds", "?", "2")],
                                  "facility_name string, chemical string, metal string, form_type string, unit string, fugitive_air string, "
                                  "stack_air string").withColumns({"state": F.lit("AA"), "zip": F.lit("44444"), **blank})
    made = match.metal_air_forms(forms)
    assert [(r.match_name, float(r.release)) for r in made.collect()] == [("ALFA", 1000.5)]
    assert _plan(made).count(r"\.\d{18}") == 2  # one for each of the two amounts
    texts = spark.createDataFrame([("007 0.50 0,0.0 1,234.00 10 1., 000.0 12",), (None,)], "t string")
    numbers = texts.select(values.numbers_in(F.col("t")).alias("n"))
    assert [r.n for r in numbers.collect()] == [["7", "0.5", "0", "1234", "10", "1", "12"], None]
    assert _plan(numbers).count("^0+") == 1


def test_wide_columns_of_facts_do_not_meet_the_rollups(spark):
    """Latest values are one maximum each, and names and places are not shuffled by record."""
    t = StarTables(spark, SMALL)
    plan = _plan(features.facility_facts(t.facility_inspections, t.violations, t.injuries, t.lookup, t.params))
    assert "max_by(" not in plan
    rows = [("a", 1, date(2024, 1, 1), "X"), ("a", 2, date(2024, 1, 1), "Y"), ("a", 2, date(2024, 1, 1), "Z"), ("a", 9, None, "W"),
            ("a", 3, date(2024, 2, 1), None), (None, 4, None, "V"), ("b", 5, date(2024, 1, 1), None)]
    fi = spark.createDataFrame(rows, "facility_id string, activity_nr long, open_date date, estab_name string")
    assert {r.facility_id: r.name for r in fi.groupBy("facility_id").agg(features.latest("estab_name", "name")).collect()} == {
        "a": "Z", None: "V", "b": None}


def test_records_are_counted_without_rows_of_evidence(spark):
    """Records and citations made by way of counts are those of the evidence rows, null and repeated keys included."""
    old, new = date(2001, 1, 1), date(2024, 2, 1)
    nep = rules.DUST_PROGRAM
    fi = spark.createDataFrame(
        [(1, "a", nep, new), (2, "a", None, new), (3, "b", nep, old), (4, "b", "Silica", new), (5, "b", None, new), (6, "b", None, new),
         (6, "b", None, old), (6, "c", None, old), (7, "c", nep, old), (7, "c", nep, new), (None, "c", nep, new), (8, None, nep, new)],
        "activity_nr long, facility_id string, dust_program string, open_date date")
    lookup = spark.createDataFrame([("5A", "General Duty Clause", "other"), ("R", "Respirators", "other"), ("S", "Silica", "adjacent"),
                                    ("D", "Dust", "dust"), ("N", None, "other"), ("U", "Unsorted", None), (None, "State or other rule", "other")],
                                   "standard string, title string, category string").withColumn("citation", F.col("standard"))
    rows = [(n, f"{i}", s, d) for n in (1, 2, 3, 5, 6, None) for i, (s, d) in enumerate(
        [("5A", new), ("5A", new), ("R", new), ("S", new), ("D", old), ("D", new), ("N", new), ("U", new), (None, new), ("S", None)])]
    rows += [(4, "1", "R", new), (7, "1", "U", new), (8, "1", "D", new), (9, "1", "D", new)]
    viol = spark.createDataFrame(rows, "activity_nr long, citation_id string, standard string, issuance_date date").withColumns(
        {"viol_type": F.lit("S"), "current_penalty": F.lit(1.0), "initial_penalty": F.lit(2.0),
         "contest_date": F.lit(None).cast("date"), "final_order_date": F.lit(None).cast("date")})
    params = spark.createDataFrame([(new, date(2020, 1, 1), date(2020, 1, 1))], "as_of date, window_start date, injury_start date")
    evidence = features.evidence(viol, fi, lookup, params)
    plain = lambda df, cols: sorted(map(str, df.select(*cols).collect()))
    counted = nested.counted_inspections(fi, features.citation_counts(viol, lookup, params), F.lit(date(2020, 1, 1)))
    kept = nested.kept_inspections(evidence)
    assert counted.count() > 5 and plain(counted, kept.columns) == plain(kept, kept.columns)
    cited = nested.kept_citations(features.citation_evidence(features.telling_citations(viol, lookup), fi, lookup, params))
    assert plain(cited, cited.columns) == plain(nested.kept_citations(evidence), cited.columns)
    known = F.col("facility_id").isNotNull() & F.col("activity_nr").isNotNull()
    deep = nested.nest(nested.records_with_items(counted.filter(known), cited))
    assert plain(deep, deep.columns) == plain(nested.nested_inspections(evidence.filter(known)), deep.columns)


def test_the_gate_makes_no_code_once_more_and_counts_withdrawn_pairs(spark):
    t = StarTables(spark, SMALL)
    tables = catalog._gate_tables(t)
    assert "isnotnull(trim(" not in _plan(quality.run_checks(tables, catalog._STATES25, "1996-01-01"))
    schema = "activity_nr long, citation_id string, standard string"
    blank = spark.createDataFrame([(1, "1", "A"), (1, "1", "A"), (2, "1", "A"), (None, "1", "A"), (3, None, "A"), (3, "1", None)], schema)
    gone = spark.createDataFrame([(1, "1", "A"), (1, "1", "A"), (1, "1", "A"), (4, "1", "A"), (None, "1", "A"), (3, None, "A"), (3, "1", None)], schema)
    checks = quality.run_checks(tables | {"violations": blank, "withdrawn": gone}, catalog._STATES25, "1996-01-01")
    assert [r.bad_rows for r in checks.filter("check_no = 4").collect()] == [6]


def test_topics_and_industries_are_sought_in_few_steps(spark):
    texts = ["A fatal injury and a lawsuit", "PRICED at cost only", "dust control", None]
    fields = spark.createDataFrame([("d", "f", 1, "body", x) for x in texts],
                                   "draft_id string, facility_id string, attempt int, field string, text string")
    found = ground.banned_topics(fields)
    assert sorted(r.topic for r in found.collect()) == ["injury or death", "legal action", "pricing"]
    assert "|".join(f"(?:{p})" for _, p in rules.BANNED_TOPICS) in _plan(found)
    assert "lambda" not in _plan(fields.select(prefix_lookup(F.col("text")).alias("fit")))
