"""Raw text tables to typed tables: scope filters, semi-join cascade, typed staging."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.text import starts_with_any, zip5_padded
from ..functions.values import date_prefix, try_date_prefix, try_double, try_int


def scope_filter(raw: DataFrame, states=rules.TERRITORY, load_start: str = rules.LOAD_START,
                 prefixes=rules.DEFAULT_RULES.prefixes) -> DataFrame:
    """Territory, load date (ISO text compares as text) and industry prefixes."""
    return raw.filter(F.col("site_state").isin(*states) & (F.col("open_date") >= load_start)
                      & starts_with_any(F.col("naics_code"), prefixes))


def children_of(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of `child` whose key occurs in `parent`."""
    keys = parent.select(F.col(parent_key or key).alias(key))
    return child.join(keys, key, "left_semi")


def scoped_tables(raw: dict[str, DataFrame], **scope) -> dict[str, DataFrame]:
    """Keep in-scope inspections and, level by level, only the rows tied to them."""
    inspection = scope_filter(raw["inspection"], **scope)
    injury = children_of(raw["accident_injury"], inspection, "rel_insp_nr", "activity_nr")
    return {
        "inspection": inspection,
        "violation": children_of(raw["violation"], inspection, "activity_nr"),
        "emphasis_codes": children_of(raw["emphasis_codes"], inspection, "activity_nr"),
        "accident_injury": injury,
        "accident": children_of(raw["accident"], injury, "summary_nr"),
    }


def plausible_headcount(reported: Column) -> Column:
    return F.when(reported.between(1, 4999), reported)


def inspections(raw: DataFrame) -> DataFrame:
    """Privately owned establishments, typed. Implausible headcounts become null."""
    reported = try_int(F.col("nr_in_estab"))
    return raw.filter(F.col("owner_type") == "A").select(
        F.col("activity_nr").cast("long").alias("activity_nr"),
        F.trim("estab_name").alias("estab_name"),
        F.trim("site_address").alias("site_address"),
        F.trim("site_city").alias("site_city"),
        "site_state",
        zip5_padded(F.col("site_zip")).alias("zip5"),
        "naics_code",
        reported.alias("employees_reported"),
        plausible_headcount(reported).alias("employees"),
        "insp_type",
        date_prefix(F.col("open_date")).alias("open_date"),
        try_date_prefix(F.col("close_case_date")).alias("close_case_date"))


def violations(raw: DataFrame, inspections: DataFrame) -> DataFrame:
    """Citations that were not withdrawn and belong to a staged inspection."""
    typed = raw.filter(F.col("delete_flag").isNull()).select(
        F.col("activity_nr").cast("long").alias("activity_nr"),
        "citation_id",
        F.trim("standard").alias("standard"),
        "viol_type",
        date_prefix(F.col("issuance_date")).alias("issuance_date"),
        try_double(F.col("current_penalty")).alias("current_penalty"),
        try_double(F.col("initial_penalty")).alias("initial_penalty"),
        try_date_prefix(F.col("contest_date")).alias("contest_date"),
        try_date_prefix(F.col("final_order_date")).alias("final_order_date"))
    return children_of(typed, inspections, "activity_nr")


def dust_programs(raw: DataFrame, inspections: DataFrame) -> DataFrame:
    """Distinct (inspection, emphasis program) pairs."""
    value = F.upper("prog_value")
    typed = raw.filter(value.isin(*rules.PROGRAM_VALUES)).select(
        F.col("activity_nr").cast("long").alias("activity_nr"),
        F.when(value == rules.DUST_PROGRAM_VALUE, rules.DUST_PROGRAM)
        .otherwise(rules.SILICA_PROGRAM).alias("program"))
    return children_of(typed, inspections, "activity_nr").distinct()


def injuries(raw_injury: DataFrame, raw_accident: DataFrame, inspections: DataFrame) -> DataFrame:
    """Injuries with the date of their accident, tied to a staged inspection."""
    degree = try_double(F.col("degree_of_inj"))
    typed = raw_injury.join(raw_accident.select("summary_nr", "event_date"), "summary_nr").select(
        F.col("rel_insp_nr").cast("long").alias("activity_nr"),
        date_prefix(F.col("event_date")).alias("event_date"),
        F.when(degree == 1, "fatality").when(degree == 2, "hospitalized").otherwise("other").alias("degree"))
    return children_of(typed, inspections, "activity_nr")
