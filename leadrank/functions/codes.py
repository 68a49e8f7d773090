"""Citation codes: readable form, title and category.

The rule tables are small fixed literals, so each lookup is an expression inside
the scan stage and needs neither a join nor a shuffle.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from .text import literal_map, sql_literal, strip_ws, words

FEDERAL = r"^19\d\d\d{4}"
STATE = r"^(?:325|408)\.(\d{4,5})"
STATE_HEAD = r"^(325|408)\.(\d{4,5})([A-Za-z]?)\s*"


def range_lookup(number: Column, ranges) -> Column:
    """(title, category) of the first range, in list order, that holds `number`."""
    table = F.expr("array({})".format(", ".join(
        "named_struct('lo', {}, 'hi', {}, 'title', {}, 'category', {})".format(*map(sql_literal, r))
        for r in ranges)))
    return F.get(F.filter(table, lambda r: number.between(r["lo"], r["hi"])), F.lit(0))


def prefix_lookup(code: Column, industries=rules.INDUSTRIES) -> Column:
    """(industry, points) of the longest matching prefix; earlier entries win ties.

    One chain of conditions, so that it is compiled and stops at the first match.
    """
    flat = [(p, label, points) for label, prefixes, points in industries for p in prefixes]
    flat.sort(key=lambda r: -len(r[0]))
    entry = lambda r: F.expr("named_struct('prefix', {}, 'industry', {}, 'points', {})".format(*map(sql_literal, r)))
    return reduce(lambda acc, r: acc.when(code.startswith(r[0]), entry(r)), flat, F)


def paragraph_marks(rest: Column) -> Column:
    """'A01 I A' -> '(a)(1)(i)(A)': letter+number splits, later roman numerals go lower case."""
    def mark(token: Column, i: Column) -> Column:
        pair = F.concat(F.lit("("), F.lower(F.substring(token, 1, 1)), F.lit(")("),
                        F.substring(token, 2, 2).try_cast("int").cast("string"), F.lit(")"))
        roman = (i >= 1) & token.rlike("^[IVX]+$")
        return (F.when(token.rlike(r"^[A-Z]\d{2}$"), pair)
                .otherwise(F.concat(F.lit("("), F.when(roman, F.lower(token)).otherwise(token), F.lit(")"))))

    return F.array_join(F.transform(words(rest), mark), "")


def parse_codes(df: DataFrame, code: str = "standard") -> DataFrame:
    """Add citation, title and category of the raw code in column `code`.

    Shared parts are columns of their own, so each is computed once per row.
    """
    section_table = F.expr("map({})".format(", ".join(
        "{}, named_struct('title', {}, 'category', {})".format(*map(sql_literal, r))
        for r in rules.FEDERAL_SECTIONS)))
    raw, upper = F.col("_raw"), F.col("_upper")
    split = (df.withColumn("_raw", strip_ws(F.coalesce(code, F.lit("")))).withColumn("_upper", F.upper("_raw"))
             .withColumns({
                 "_family": F.when(upper.rlike(FEDERAL), "federal")
                 .when(upper.startswith("5A0001"), "duty").when(upper.startswith("408.1011"), "state duty")
                 .when(raw.rlike(STATE), F.substring(raw, 1, 3)).otherwise("none"),
                 "_part": F.substring(upper, 1, 4), "_rest": F.regexp_replace(F.substr(upper, F.lit(9)), r"^\s+", "")})
             .withColumns({
                 # federal: 19PP SSSS paragraphs; state plan: series.number
                 "_number": F.when(F.col("_family") == "federal", F.substring(upper, 5, 4))
                 .when(F.col("_family").isin("325", "408"), F.regexp_extract(raw, STATE, 1)).try_cast("int")}))

    family, part, rest, number = (F.col(f"_{c}") for c in ("family", "part", "rest", "number"))
    known = F.when(part == "1910", F.try_element_at(section_table, number))
    welding = ((part == "1910") & (number == rules.WELDING_SECTION) & rest.startswith(rules.WELDING_PARAGRAPH))
    health = range_lookup(number, rules.STATE_HEALTH_RANGES)
    safety_part = F.coalesce(F.nullif(F.floor(number / 100).cast("int") % 100, F.lit(0)), F.lit(1))
    split = split.withColumns({
        "_section": F.when(family == "federal", known), "_range": F.when(family == "325", health),
        "_welding": F.coalesce((family == "federal") & welding, F.lit(False)),
        "_safety": F.when((family == "408") & number.between(10000, 19999), safety_part)})

    section, in_range, safety = F.col("_section"), F.col("_range"), F.col("_safety")
    state_title = lambda c: F.concat(F.lit("MIOSHA "), c)
    citation = (
        F.when(family == "federal", F.concat(F.lit("29 CFR "), part, F.lit("."), number.cast("string"),
                                             paragraph_marks(rest)))
        .when(family == "duty", "OSH Act 5(a)(1)").when(family == "state duty", "MCL 408.1011")
        .when(family.isin("325", "408"), strip_ws(F.concat(
            F.lit("Mich. R "), F.regexp_replace(raw, STATE_HEAD, "$1.$2$3"))))
        .otherwise(F.when(raw == "", "unknown").otherwise(raw)))
    title = (
        F.when(F.col("_welding"), rules.WELDING_TITLE)
        .when(family == "federal", F.coalesce(
            section["title"], F.try_element_at(literal_map(rules.FEDERAL_PARTS), part),
            F.concat(part, F.lit("."), number.cast("string"))))
        .when(family == "duty", "General Duty Clause").when(family == "state duty", "Michigan general duty clause")
        .when(family == "325", state_title(F.coalesce(in_range["title"], F.lit("occupational health rule"))))
        .when((family == "408") & (number == rules.HOUSEKEEPING_RULE), "MIOSHA Part 1 Housekeeping")
        .when(safety.isNotNull(), state_title(F.coalesce(
            F.try_element_at(literal_map(rules.STATE_SAFETY_PARTS), safety),
            F.concat(F.lit("Part "), safety.cast("string")))))
        .when((family == "408") & number.between(22101, 22199), "MIOSHA Part 11 Recordkeeping")
        .when(family == "408", "MIOSHA rule").otherwise("State or other rule"))
    category = (
        F.when(F.col("_welding"), rules.ADJACENT)
        .when(family.isin("federal", "325"), F.coalesce(
            section["category"], in_range["category"], F.lit(rules.OTHER)))
        .when((family == "408") & (number == rules.HOUSEKEEPING_RULE), rules.ADJACENT)
        .when(safety.isNotNull(), F.coalesce(
            F.try_element_at(literal_map(rules.STATE_SAFETY_CATEGORY), safety), F.lit(rules.OTHER)))
        .otherwise(rules.OTHER))
    return split.withColumns({"citation": citation, "title": title, "category": category}).select(
        *df.columns, "citation", "title", "category")
