from datetime import date

from pyspark.sql import functions as F

from leadrank import rules
from leadrank.functions import text, values
from leadrank.functions.codes import parse_codes, prefix_lookup, range_lookup


def one_column(spark, items, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_names(spark):
    got = one_column(spark, ["Blue Ridge Millwork Co.", "BLUE RIDGE MILLWORK COMPANY, INC", "Delta Tool, L.L.C.",
                             "Oak & Pine, Inc. dba Forest Shop", "2204518 - HILL FORGE LTD **", "The Co", None,
                             "Café Ébéniste SA", "ADBANK CORP"], text.normalize_name)
    assert got == ["BLUE RIDGE MILLWORK", "BLUE RIDGE MILLWORK", "DELTA TOOL", "OAK AND PINE", "HILL FORGE", "", "",
                   "CAF B NISTE SA", "ADBANK"]


def test_addresses(spark):
    got = one_column(spark, ["77 South Elm Street", "77 S. ELM ST", "5 Mill Road Suite 12", "12 Oak Ave #4", None],
                     text.normalize_address)
    # a hash sign has no word boundary before it, so the unit number stays
    assert got == ["77 S ELM ST", "77 S ELM ST", "5 MILL RD", "12 OAK AVE 4", ""]


def test_zip_codes(spark):
    raw = ["48104-2201", "123", "", None, "00000", "n/a"]
    assert one_column(spark, raw, text.zip5_padded) == ["48104", "00123", None, None, None, None]
    assert one_column(spark, raw, text.zip5_key) == ["48104", "00123", "", "", "00000", ""]


def test_similarity(spark):
    pairs = [("ALFA TOOL", "ALFA WORKS", True), ("RED OAK MILL", "OAK MILL", True), ("A B C", "D E F", False),
             ("", "A", False), ("A B C D", "B E F", False), ("A B", "B C", False), ("B A C", "A B", True)]
    df = spark.createDataFrame(pairs, "a string, b string, want boolean")
    bad = df.filter(text.names_similar(F.col("a"), F.col("b")) != F.col("want")).collect()
    assert bad == []


def test_readable(spark):
    assert one_column(spark, ["HILL AND DALE CNC SHOP OF U.S. LLC", "Mixed Case ltd", "THE A1 MILL", "334455 - X Y"],
                      text.pretty_name) == ["Hill and Dale CNC Shop of U.S. LLC", "Mixed Case ltd", "The A1 Mill", "X Y"]
    assert one_column(spark, ["O'FALLON", "saint-denis 3rd", None], text.title_case) == ["O'Fallon", "Saint-Denis 3Rd", ""]
    assert one_column(spark, ["=1+1", "-x", "@a", "\tb", "a=b", None], text.spreadsheet_safe) == [
        "'=1+1", "'-x", "'@a", "'\tb", "a=b", None]
    assert one_column(spark, ["Qualified ", "NOT NOW", "maybe", None], text.normalize_disposition) == [
        "qualified", "not_now", "unknown", "unknown"]


def test_codes_in_brackets_stay_together(spark):
    got = spark.createDataFrame([("a b (c d) e (f (g h) i j) k l) m (n o",), (None,)], "t string").select(text.keep_together(F.col("t"))).collect()
    assert [r[0] for r in got] == ["a b (c\u00a0d) e (f (g\u00a0h) i j) k l) m (n o", None]


def test_short_reason(spark):
    got = one_column(spark, [
        "Lead (29 CFR 1910.1025), issued Mar 4, 2001 during a X inspection.",
        "Dust evidence dated Mar 4, 2001, within 12 months of the Nov 4, 2001 data cut.",
        "700 employees at the site, just outside the 20–500 core range.", "80 employees at the site. 20–500 is the core range."],
        text.short_reason)
    assert got == ["Lead (29\u00a0CFR\u00a01910.1025) during a X inspection",
                   "Dust evidence dated Mar 4, 2001, within 12 months",
                   "700 employees at the site, just outside the 20–500 core range", "80 employees at the site"]


def test_numbers(spark):
    assert one_column(spark, ["12", "12.0", "12.5", "x", "", None, "12d", "99999999999"], values.try_int) == [
        12, 12, 13, None, None, None, None, None]
    assert [None if v is None else float(v) for v in one_column(
        spark, ["1,234.5", " na ", "N/A", "", None, "-1", "abc", "Infinity", "0"], values.amount)] == [
        1234.5, 0, 0, 0, 0, None, None, None, 0]
    assert one_column(spark, ["cut 1,200.50 and 007, then 3.0 or 5."], values.numbers_in) == [["1200.5", "7", "3", "5"]]


def test_dates(spark):
    days = [date(2024, 3, 31), date(2023, 5, 15)]
    assert one_column(spark, days, lambda c: values.months_before(c, 1), "date") == [date(2024, 2, 29), date(2023, 4, 15)]
    assert one_column(spark, [date(2024, 3, 5), None], values.readable_date, "date") == ["Mar 5, 2024", "no date"]


def test_half_even_penalty(spark):
    df = spark.createDataFrame([(2.5, 9.0), (3.5, None), (None, 7.5), (None, None)], "c double, i double")
    assert [r[0] for r in df.select(values.whole_penalty(F.col("c"), F.col("i"))).collect()] == [2, 4, 8, 0]


def test_codes(spark):
    cases = {
        "19100272 J01 II B": ("29 CFR 1910.272(j)(1)(ii)(B)", "Grain handling facilities", "dust"),
        "19100252 C06": ("29 CFR 1910.252(c)(6)", rules.WELDING_TITLE, "adjacent"),
        "19100252 B02": ("29 CFR 1910.252(b)(2)", "Welding, cutting, and brazing", "other"),
        "19109999": ("29 CFR 1910.9999", "1910.9999", "other"),
        "19040007": ("29 CFR 1904.7", "Injury and illness recordkeeping", "other"),
        "5a0001": ("OSH Act 5(a)(1)", "General Duty Clause", "other"),
        "408.1011(A)": ("MCL 408.1011", "Michigan general duty clause", "other"),
        "325.52003(2)": ("Mich. R 325.52003(2)", "MIOSHA Part 520 Ventilation Control", "dust"),
        "325.52099": ("Mich. R 325.52099", "MIOSHA occupational health rule", "other"),
        "408.10015": ("Mich. R 408.10015", "MIOSHA Part 1 Housekeeping", "adjacent"),
        "408.17605 (1)": ("Mich. R 408.17605(1)", "MIOSHA Part 76 Spray Finishing", "adjacent"),
        "408.10301": ("Mich. R 408.10301", "MIOSHA Part 3", "other"),
        "408.22112": ("Mich. R 408.22112", "MIOSHA Part 11 Recordkeeping", "other"),
        "408.30000": ("Mich. R 408.30000", "MIOSHA rule", "other"),
        "8 CCR 3314": ("8 CCR 3314", "State or other rule", "other"),
        "": ("unknown", "State or other rule", "other"),
    }
    df = spark.createDataFrame([(k,) for k in cases], "standard string")
    assert {r.standard: (r.citation, r.title, r.category) for r in parse_codes(df).collect()} == cases


def test_lookups(spark):
    assert [None if r is None else r.industry for r in one_column(
        spark, ["3252", "32541", "3315", "331", "321", None], prefix_lookup)] == [
        "Plastics, resins & composites", "Pharmaceutical & nutraceutical", "Foundries", None,
        "Woodworking, cabinets & furniture", None]
    got = one_column(spark, [1, 5, 9, 12], lambda c: range_lookup(
        c, ((1, 9, "first", "a"), (5, 12, "second", "b"))), "int")
    assert [g.title for g in got] == ["first", "first", "first", "second"]
