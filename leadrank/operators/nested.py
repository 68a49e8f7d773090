"""Nested lead records: entity -> records[] -> citations[].

The flat form is the working form and the product at scale: `kept_citations` and
`kept_inspections` hold what a nested record shows, one row per citation and
inspection, and explanations, searches and draft checks run on them as joins and
groupings. Nesting is the last step before a document sink and has one shape at
every size: one document per lead, which therefore has to fit into memory.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.text import clean_chemical, pretty_name, public_hold, record_link, title_case, violation_label
from ..functions.values import whole_penalty
from .features import in_dust_program


def shown_evidence(evidence: DataFrame, shown: DataFrame) -> DataFrame:
    """Evidence, or records, of the shown entities only; reduces everything below to their rows."""
    return evidence.join(shown.select("facility_id"), "facility_id", "left_semi")


def _kept() -> Column:
    return (F.col("kind") == "citation") & (F.col("category") != rules.OTHER)


def _public() -> dict[str, Column]:
    """Public form of a citation's fields."""
    return {
        "standard": F.col("citation"), "title": F.col("title"), "category": F.col("category"),
        "type": violation_label(F.col("viol_type")), "issued": F.col("evidence_date"),
        "penalty_usd": whole_penalty(F.col("current_penalty"), F.col("initial_penalty")),
        "under_contest": F.col("contest_date").isNotNull() & F.col("final_order_date").isNull()}


def kept_citations(evidence: DataFrame) -> DataFrame:
    """Dust-related citations in public form."""
    return evidence.filter(_kept()).select(
        "facility_id", "activity_nr", "open_date", "dust_program", *[c.alias(name) for name, c in _public().items()])


def _record_aggregates() -> list[Column]:
    cited = F.col("kind") == "citation"
    other = cited & (F.col("category") == rules.OTHER)
    return [F.max("open_date").alias("opened"), F.max("dust_program").alias("dust_program"),
            F.count_if(cited & ~other).alias("citation_count"), F.count_if(other).alias("other_citations")]


def _worth_showing() -> Column:
    return (F.col("citation_count") > 0) | F.col("dust_program").isNotNull()


def kept_inspections(evidence: DataFrame) -> DataFrame:
    """Records with a dust-related citation or a program; other citations counted."""
    return evidence.groupBy("facility_id", "activity_nr").agg(*_record_aggregates()).filter(_worth_showing())


def counted_inspections(records: DataFrame, counts: DataFrame, window_start: Column) -> DataFrame:
    """As `kept_inspections`, from records (facility_id, activity_nr, dust_program, open_date) and their
    `features.citation_counts`: no row of evidence is made for a citation that is only counted.

    Rows of one record number have the same counts and programs, so those not worth showing go before the grouping.
    """
    nep = in_dust_program(F.col("dust_program"))
    n = lambda name: F.coalesce(F.when(nep, F.col(f"nep_{name}")).otherwise(F.col(name)), F.lit(0))
    evident = F.col("cited").isNotNull() | (F.col("dust_program").isNotNull() & (F.col("open_date") >= window_start))
    worth = (n("kept") > 0) | F.col("dust_program").isNotNull()
    return (records.join(counts, "activity_nr", "left").filter(evident & worth).groupBy("facility_id", "activity_nr")
            .agg(F.max("open_date").alias("opened"), F.max("dust_program").alias("dust_program"),
                 F.sum(n("kept")).alias("citation_count"), F.sum(n("other")).alias("other_citations")))


_SORT_KEY = ["category", "standard", "issued", "type", "penalty_usd"]
_ITEM = [*_SORT_KEY, "title", "under_contest"]


def records_with_items(inspections: DataFrame, citations: DataFrame) -> DataFrame:
    """`kept_inspections` with their `kept_citations` in a fixed order, as a list in each record."""
    key = ["facility_id", "activity_nr"]
    listed = citations.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*_ITEM))).alias("items"))
    empty = F.array().cast(listed.schema["items"].dataType)
    return inspections.join(listed, key, "left").withColumn("items", F.coalesce("items", empty))


def nested_inspections(evidence: DataFrame) -> DataFrame:
    """(facility_id, inspections[]): newest record first, citations in a fixed order.

    One grouping by record, one by entity. If `evidence` is bucketed by entity, neither needs an exchange.
    """
    public = _public()
    item = F.struct(*[public[name].alias(name) for name in _ITEM])
    records = evidence.groupBy("facility_id", "activity_nr").agg(
        *_record_aggregates(), F.array_sort(F.collect_list(F.when(_kept(), item))).alias("items")).filter(_worth_showing())
    return nest(records)


def nest(records: DataFrame) -> DataFrame:
    """(facility_id, inspections[]) from records with their items, in one grouping."""
    inspection = F.struct(
        F.date_diff(F.lit("9999-01-01").cast("date"), "opened").alias("_age"), "activity_nr",
        F.struct(
            F.col("activity_nr").cast("string").alias("inspection_id"), "opened", "dust_program",
            record_link(F.col("activity_nr")).alias("url"),
            F.transform("items", lambda c: F.struct(
                c["standard"].alias("standard"), c["title"].alias("title"), c["category"].alias("category"),
                c["type"].alias("type"), c["issued"].alias("issued"),
                c["penalty_usd"].alias("penalty_usd"), c["under_contest"].alias("under_contest")))
            .alias("citations"), "other_citations").alias("inspection"))
    return (records.groupBy("facility_id").agg(F.array_sort(F.collect_list(inspection)).alias("sorted"))
            .select("facility_id", F.transform("sorted", lambda x: x["inspection"]).alias("inspections")))


def shown_leads(leads: DataFrame) -> DataFrame:
    return leads.filter(F.col("tier").isin(rules.HOT, rules.WARM))


def public_lead(leads: DataFrame) -> DataFrame:
    """Flat public fields of a lead: readable name and city, public hold label."""
    return leads.withColumns({
        "name": pretty_name(F.col("name")), "city": title_case(F.col("city")),
        "hold": public_hold(F.col("hold_reason"))})


def lead_records(shown: DataFrame, evidence: DataFrame, reporting_year: int = rules.EMISSION_YEAR) -> DataFrame:
    """Nested record of every shown lead, from their evidence: one row per lead."""
    return lead_documents(shown, nested_inspections(evidence), reporting_year)


def lead_documents(shown: DataFrame, nested: DataFrame, reporting_year: int = rules.EMISSION_YEAR) -> DataFrame:
    """Nested record of every shown lead, from the lists of their records: one row per lead."""
    signal = F.when(F.col("release_lbs").isNotNull(), F.struct(
        "release_lbs", "chemicals", "forms", F.lit(reporting_year).alias("reporting_year")))
    score = F.struct(*[F.col(f"{k}_pts").alias(k) for k in
                       ("industry", "dust", "recency", "size", "tri_air")], F.col("total"))
    empty = F.array().cast(nested.schema["inspections"].dataType)
    return public_lead(shown).join(nested, "facility_id", "left").select(
        F.col("facility_id").alias("id"), "rank",
        "name", "city", "state", F.col("zip5").alias("zip"), "lat", "lon", "industry", "naics", "employees",
        score.alias("score"), signal.alias("tri_air_signal"), "tier", "confidence", "hold",
        "facility_match_review_required", "outreach_eligible", "dust_reason", "evidence_date",
        F.col("n_inspections").alias("inspections_since_2019"),
        F.coalesce("inspections", empty).alias("inspections"))


def facts(records: DataFrame, as_of: Column) -> DataFrame:
    """What a drafted text may rely on: a subset of the nested record."""
    return records.select(
        "id", F.struct(
            as_of.alias("as_of"),
            F.struct("name", "city", "state", "industry", "naics",
                     F.col("employees").alias("employees_at_site")).alias("facility"),
            F.transform("inspections", lambda i: F.struct(
                i["inspection_id"].alias("inspection_id"), i["opened"].alias("opened"),
                i["dust_program"].alias("dust_program"), F.size(i["citations"]).alias("citation_count"),
                F.transform(i["citations"], lambda c: F.struct(
                    *[c[n].alias(n) for n in ("standard", "title", "category", "type", "issued", "penalty_usd")]
                )).alias("citations"),
                i["other_citations"].alias("other_citations"))).alias("inspections")).alias("facts"))


def chemical_list(c: Column) -> Column:
    return F.array_join(F.transform(c, clean_chemical), ", ")
