"""Entity features: latest values, evidence, holds, and the one-shuffle score inputs.

Two ways to the same facts:

* `evidence`, `holds`, `facilities` are row-level tables, for export and checks.
* `inspection_facts` + `facility_facts` serve scoring. Children are rolled up per
  record before any join (map-side partial aggregation, so a record that owns a
  third of all children costs one row per map task), then groupings by entity
  yield latest values, evidence dates and hold dates, joined at one row each.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.codes import parse_codes
from ..functions.values import months_before


# ------------------------------------------------------------------ parameters
def run_params(inspections: DataFrame, violations: DataFrame,
               score_rules=rules.DEFAULT_RULES) -> DataFrame:
    """One row: as-of date (newest record), evidence window start, injury window start."""
    newest = lambda df, c: df.agg(F.max(c).alias("d"))
    as_of = (newest(inspections, "open_date").unionByName(newest(violations, "issuance_date"))
             .agg(F.max("d").alias("as_of")))
    return as_of.select(
        "as_of",
        months_before(F.col("as_of"), score_rules.window_months).alias("window_start"),
        months_before(F.col("as_of"), score_rules.injury_months).alias("injury_start"))


def param(params: DataFrame, name: str) -> Column:
    """A run parameter as scalar subquery, so it reaches scans as a pushed-down value."""
    return params.select(name).scalar()


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row table: one scalar subquery, computed once, and no join."""
    one = one_row.select(F.struct(*one_row.columns).alias("_one")).scalar()
    return df.withColumn("_one", one).select(*df.columns, *[F.col("_one")[c].alias(c) for c in one_row.columns])


# ------------------------------------------------------------------- row tables
def standard_lookup(violations: DataFrame) -> DataFrame:
    """Every distinct code with its parsed form; codes are parsed once each."""
    return parse_codes(violations.select("standard").distinct())


def program_lists(dust_programs: DataFrame) -> DataFrame:
    """Distinct programs of a record in one ordered text. The program vocabulary is fixed and tiny."""
    return dust_programs.groupBy("activity_nr").agg(
        F.array_join(F.array_sort(F.collect_set("program")), "; ").alias("dust_program"))


def facility_inspections(inspections: DataFrame, facility_map: DataFrame | None,
                         dust_programs: DataFrame) -> DataFrame:
    """Records with their entity and program list. Without a map, records carry `facility_id` already."""
    mapped = inspections if facility_map is None else inspections.join(facility_map, "activity_nr")
    return mapped.join(program_lists(dust_programs), "activity_nr", "left")


def latest(column: str, alias: str | None = None) -> Column:
    """Newest non-null value; ties on the date go to the larger record number, then to the larger value."""
    newest = F.max(F.when(F.col(column).isNotNull(), F.struct("open_date", "activity_nr", column)))
    return newest[column].alias(alias or column)


def facility_aggregates(window_start: Column, name_variants: bool = True) -> list[Column]:
    prefix = F.substring("naics_code", 1, 3)
    return [
        latest("estab_name", "name"), latest("site_address", "address"), latest("site_city", "city"),
        latest("site_state", "state"), latest("zip5"), latest("naics_code", "naics"),
        # more than one distinct prefix is the same as smallest <> largest: no distinct needed
        F.coalesce(F.min(prefix) != F.max(prefix), F.lit(False)).alias("naics_conflict"),
        latest("employees"),
        *([F.count_distinct("estab_name").alias("name_variants")] if name_variants else []),
        F.count(F.lit(1)).alias("n_inspections"),
        F.bool_or("review_required").alias("facility_match_review_required"),
        F.count_if(F.col("open_date") >= window_start).alias("n_inspections_window"),
        F.min("open_date").alias("first_inspection"),
        F.max("open_date").alias("last_inspection"),
    ]


def facilities(facility_inspections: DataFrame, params: DataFrame) -> DataFrame:
    """One row per entity; location, industry and headcount from the newest record that has them."""
    return facility_inspections.groupBy("facility_id").agg(
        *facility_aggregates(param(params, "window_start")))


def is_dust_title(title: Column) -> Column:
    return (title.isin(*rules.GENERAL_DUTY_TITLES)
            | F.lower(title).contains(rules.HAZARD_COMMUNICATION))


def in_dust_program(program: Column) -> Column:
    return F.coalesce(program.contains("Combustible Dust"), F.lit(False))


def citation_evidence(violations: DataFrame, facility_inspections: DataFrame,
                      lookup: DataFrame, params: DataFrame) -> DataFrame:
    fi = facility_inspections.select("activity_nr", "facility_id", "dust_program", "open_date")
    # null-safe: a plain equality would make the scan work out each code once more, to drop the null ones;
    # after the join by record, so that short codes are shuffled and not their titles
    parsed = lookup.filter(F.col("standard").isNotNull()).withColumnRenamed("standard", "_standard")
    return (violations.filter(F.col("issuance_date") >= param(params, "window_start"))
            .join(fi, "activity_nr").join(parsed, F.col("standard").eqNullSafe(F.col("_standard")))
            .select(
                "facility_id", "activity_nr", F.lit("citation").alias("kind"),
                F.col("issuance_date").alias("evidence_date"), "citation_id", "citation", "title",
                F.when(in_dust_program(F.col("dust_program")) & is_dust_title(F.col("title")), rules.DUST)
                .otherwise(F.col("category")).alias("category"),
                "viol_type", "current_penalty", "initial_penalty", "contest_date", "final_order_date",
                "dust_program", "open_date"))


def may_be_kept() -> Column:
    """Codes that can be more than `other`: by their category or, in a dust program, by their title."""
    return (F.col("category") != rules.OTHER) | is_dust_title(F.col("title"))


def telling_citations(violations: DataFrame, lookup: DataFrame) -> DataFrame:
    """Citations of codes that can be more than `other`, picked by code before they meet their records."""
    codes = lookup.filter(may_be_kept()).select(F.col("standard").alias("_standard"))
    return violations.join(codes, F.col("standard").eqNullSafe(F.col("_standard")), "left_semi")


def citation_counts(violations: DataFrame, lookup: DataFrame, params: DataFrame) -> DataFrame:
    """Per record: its citations in the window, all, more than `other` and `other`, the latter two also as they count
    under a dust program (`nep_`). Rolled up before any join with records, so a record comes to it as one row."""
    other = F.col("category") == rules.OTHER
    parsed = lookup.filter(F.col("standard").isNotNull()).select(
        F.col("standard").alias("_standard"), (~other).alias("kept"), other.alias("other"), may_be_kept().alias("nep_kept"),
        (other & ~F.coalesce(is_dust_title(F.col("title")), F.lit(False))).alias("nep_other"))
    return (violations.filter(F.col("issuance_date") >= param(params, "window_start"))
            .join(parsed, F.col("standard").eqNullSafe(F.col("_standard"))).groupBy("activity_nr")
            .agg(F.count(F.lit(1)).alias("cited"), *[F.count_if(c).alias(c) for c in ("kept", "other", "nep_kept", "nep_other")]))


def program_evidence(facility_inspections: DataFrame, params: DataFrame) -> DataFrame:
    return (facility_inspections
            .filter(F.col("dust_program").isNotNull()
                    & (F.col("open_date") >= param(params, "window_start")))
            .select("facility_id", "activity_nr", F.lit("program_inspection").alias("kind"),
                    F.col("open_date").alias("evidence_date"),
                    F.concat(F.lit("Inspected under "), "dust_program").alias("title"),
                    F.lit(rules.ADJACENT).alias("category"), "dust_program", "open_date"))


def evidence(violations: DataFrame, facility_inspections: DataFrame, lookup: DataFrame,
             params: DataFrame) -> DataFrame:
    """Citations in the window plus inspections run under an emphasis program."""
    return citation_evidence(violations, facility_inspections, lookup, params).unionByName(
        program_evidence(facility_inspections, params), allowMissingColumns=True)


# --------------------------------------------------------------- record rollups
def citation_rollup(violations: DataFrame, lookup: DataFrame, window_start: Column) -> DataFrame:
    """Per record: newest citation date by class inside the window, serious flag, open contest.

    The contest date looks at every citation, the rest only at the window and at
    classified codes, hence the left join. Citations that set none of the columns
    are dropped before codes are joined and records grouped, so a record of only
    such citations has no row: join the result from the left.
    """
    parsed = lookup.select("standard", "category", is_dust_title(F.col("title")).alias("dust_title"))
    contested = F.col("contest_date").isNotNull() & F.col("final_order_date").isNull()
    classified = F.col("category").isNotNull() & (F.col("issuance_date") >= window_start)
    telling = (F.col("category").isin(rules.DUST, rules.ADJACENT) | F.col("dust_title")
               | F.col("viol_type").isin(*rules.SERIOUS_TYPES))
    day = lambda cond: F.max(F.when(classified & cond, F.col("issuance_date")))
    has = lambda c: F.col("category") == c
    recent = violations.filter((F.col("issuance_date") >= window_start) | contested)
    return recent.join(parsed, "standard", "left").filter((classified & telling) | contested).groupBy("activity_nr").agg(
        day(has(rules.DUST)).alias("dust_day"),
        day(F.col("dust_title")).alias("program_dust_day"),
        day(has(rules.ADJACENT)).alias("adjacent_day"),
        day(has(rules.ADJACENT) & ~F.col("dust_title")).alias("plain_adjacent_day"),
        F.bool_or(classified & F.col("viol_type").isin(*rules.SERIOUS_TYPES)).alias("serious"),
        F.max(F.when(F.col("final_order_date").isNull(), F.col("contest_date"))).alias("contest_day"))


def injury_rollup(injuries: DataFrame, params: DataFrame) -> DataFrame:
    """Per record and degree: newest event, newest event in its window, undated event. Records without an event of
    either degree have no row: join the result from the left."""
    def columns(degree: str, start: Column, name: str) -> list[Column]:
        hit = F.col("degree") == degree
        return [F.max(F.when(hit, F.col("event_date"))).alias(f"{name}_day"),
                F.max(F.when(hit & (F.col("event_date") >= start), F.col("event_date"))).alias(f"{name}_window_day"),
                F.bool_or(hit & F.col("event_date").isNull()).alias(f"{name}_undated")]

    return injuries.filter(F.col("degree").isin("fatality", "hospitalized")).groupBy("activity_nr").agg(
        *columns("fatality", param(params, "window_start"), "fatal"),
        *columns("hospitalized", param(params, "injury_start"), "injured"))


def incident_day(name: str, insp_type: str, start: Column) -> Column:
    """Date that sets the hold for one record, or null.

    A recent incident-type inspection counts even without a matched event; then
    all its matched events compete, whatever their age, and an undated event
    stands for the opening date.
    """
    by_type = (F.col("insp_type") == insp_type) & (F.col("open_date") >= start)
    undated = F.when(F.col(f"{name}_undated"), F.col("open_date"))
    return (F.when(by_type, F.coalesce(F.greatest(F.col(f"{name}_day"), undated), F.col("open_date")))
            .otherwise(F.col(f"{name}_window_day")))


def hold_aggregates(params: DataFrame) -> list[Column]:
    return [
        F.max(incident_day("fatal", "M", param(params, "window_start"))).alias("fatality_date"),
        F.max(incident_day("injured", "A", param(params, "injury_start"))).alias("hospitalization_date"),
        F.max("contest_day").alias("contested_date"),
    ]


def holds(facility_inspections: DataFrame, violations: DataFrame, injuries: DataFrame,
          params: DataFrame) -> DataFrame:
    """Per entity: newest fatality, serious injury and open contest that block outreach."""
    contests = (violations.filter(F.col("contest_date").isNotNull() & F.col("final_order_date").isNull())
                .groupBy("activity_nr").agg(F.max("contest_date").alias("contest_day")))
    return (facility_inspections.select("facility_id", "activity_nr", "insp_type", "open_date")
            .join(contests, "activity_nr", "left")
            .join(injury_rollup(injuries, params), "activity_nr", "left")
            .groupBy("facility_id").agg(*hold_aggregates(params)))


def evidence_aggregates() -> list[Column]:
    """Strongest-evidence inputs per entity from the record rollups."""
    nep = in_dust_program(F.col("dust_program"))
    return [
        F.max(F.greatest(F.col("dust_day"), F.when(nep, F.col("program_dust_day")))).alias("dust_date"),
        F.max(F.greatest(F.when(nep, F.col("plain_adjacent_day")).otherwise(F.col("adjacent_day")),
                         F.col("program_day"))).alias("adjacent_date"),
        F.coalesce(F.bool_or("serious"), F.lit(False)).alias("serious"),
    ]


def facility_facts(facility_inspections: DataFrame, violations: DataFrame, injuries: DataFrame,
                   lookup: DataFrame, params: DataFrame) -> DataFrame:
    """Latest values, evidence dates and hold dates of every entity.

    Three groupings by entity, joined at one row each: the wide columns are grouped as they are read and never meet
    the rollups by record, the dates are grouped by hash, and names are counted apart.
    """
    start = param(params, "window_start")
    records = (facility_inspections.select("facility_id", "activity_nr", "insp_type", "open_date", "dust_program")
               .join(citation_rollup(violations, lookup, start), "activity_nr", "left")
               .join(injury_rollup(injuries, params), "activity_nr", "left")
               .withColumn("program_day", F.when(F.col("dust_program").isNotNull()
                                                 & (F.col("open_date") >= start), F.col("open_date"))))
    dated = records.groupBy(F.col("facility_id").alias("_dated")).agg(*evidence_aggregates(), *hold_aggregates(params))
    # the distinct count goes apart: inside the wide grouping it would sort and shuffle the wide rows twice
    names = (facility_inspections.select(F.col("facility_id").alias("_named"), "estab_name").distinct()
             .groupBy("_named").agg(F.count("estab_name").alias("name_variants")))
    wide = facility_inspections.groupBy("facility_id").agg(*facility_aggregates(start, name_variants=False))
    at = wide.columns.index("n_inspections")
    same = F.col("facility_id").eqNullSafe
    return wide.join(names, same(F.col("_named"))).join(dated, same(F.col("_dated"))).select(
        *wide.columns[:at], "name_variants", *wide.columns[at:], *dated.columns[1:])
