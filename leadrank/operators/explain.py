"""Why a lead scores as it does: factor rows, reasons, spotlight, status, briefing."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.values import readable_date
from .features import attach, param
from .nested import chemical_list


def plain_number(c: Column, decimals: int = 1) -> Column:
    """Thousands separators, at most `decimals` decimals, no trailing zeros."""
    text = F.format_number(c.cast("double"), decimals)
    return F.regexp_replace(text, r"\.0+\z", "")


def dust_sources(citations: DataFrame, inspections: DataFrame, leads: DataFrame) -> DataFrame:
    """Per lead, the text of the first listed evidence item dated at its evidence date.

    List order: citations before program inspections, newer records first, then
    record number, category, code. One grouping with a smallest-key pick.
    """
    during = F.coalesce(F.concat(F.lit(" during a "), "dust_program", F.lit(" inspection")), F.lit(""))
    cited = citations.select(
        "facility_id", F.col("issued").alias("day"), "category", F.lit(0).alias("kind"),
        F.col("open_date").alias("opened"), "activity_nr", "standard",
        F.concat("title", F.lit(" ("), "standard", F.lit("), issued "),
                 readable_date(F.col("issued")), during).alias("text"))
    programs = inspections.filter(F.col("dust_program").isNotNull()).select(
        "facility_id", F.col("opened").alias("day"), F.lit("program").alias("category"),
        F.lit(1).alias("kind"), "opened", "activity_nr", F.lit("").alias("standard"),
        F.concat("dust_program", F.lit(" inspection, opened "), readable_date(F.col("opened"))).alias("text"))
    place = F.struct("kind", F.date_diff(F.lit("9999-01-01").cast("date"), "opened"), "activity_nr",
                     "category", "standard", "text")
    # first item per entity, day and class before the join, so an entity with a large
    # share of all items meets it as a few rows
    firsts = (cited.unionByName(programs).groupBy("facility_id", "day", "category")
              .agg(F.min(place).alias("first")))
    level = leads.select("facility_id", "dust_pts", F.col("evidence_date").alias("day"))
    fits = (((F.col("dust_pts") == 3) & (F.col("category") == rules.DUST))
            | ((F.col("dust_pts") == 2) & F.col("category").isin(rules.ADJACENT, "program")))
    return (firsts.join(level, ["facility_id", "day"]).filter(fits)
            .groupBy("facility_id").agg(F.min("first").alias("first"))
            .select("facility_id", F.col("first.text").alias("source_text")))


def reasons(leads: DataFrame, sources: DataFrame, params: DataFrame,
            reporting_year: int = rules.EMISSION_YEAR) -> DataFrame:
    """Add one reason text per factor: reason_industry, reason_dust, ..."""
    as_of = param(params, "as_of")
    when = F.concat(F.lit("Dust evidence dated "), readable_date(F.col("evidence_date")))
    window = F.expr("CASE recency_pts WHEN 3 THEN 12 WHEN 2 THEN 24 WHEN 1 THEN 36 END")
    people = F.concat(plain_number(F.col("employees")), F.lit(" employees at the site"))
    dot = F.lit(".")
    return leads.join(sources, "facility_id", "left").withColumns({
        "reason_industry": F.concat("industry", F.lit(" (NAICS "), "naics", F.lit(").")),
        "reason_dust":
            F.when(F.col("dust_pts") == 1, rules.REASONS["serious"])
            .when(F.col("dust_pts") == 0, rules.REASONS["no citations"])
            .otherwise(F.concat(F.coalesce("source_text", F.concat(
                "dust_reason", F.lit(", "), readable_date(F.col("evidence_date")))), dot)),
        "reason_recency":
            F.when(F.col("evidence_date").isNull(),
                   rules.REASONS["no dust"])
            .when(window.isNotNull(), F.concat(
                when, F.lit(", within "), window.cast("string"), F.lit(" months of the "),
                readable_date(as_of), F.lit(" data cut.")))
            .otherwise(F.concat(when, F.lit(", older than 36 months."))),
        "reason_size":
            F.when(F.col("employees").isNull(), rules.REASONS["no headcount"])
            .when(F.col("size_pts") == 2, F.concat(people, F.lit(rules.REASONS["core size"])))
            .when(F.col("size_pts") == 1, F.concat(people, F.lit(rules.REASONS["near size"])))
            .otherwise(F.concat(people, F.lit(rules.REASONS["other size"]))),
        "reason_tri_air":
            F.when(F.col("release_lbs").isNull(),
                   f"No {reporting_year} EPA TRI metal air release matched to this site.")
            .otherwise(F.concat(F.lit("Reported "), plain_number(F.col("release_lbs")),
                                F.lit(f" lb of metal air releases to EPA TRI for {reporting_year}: "),
                                chemical_list(F.col("chemicals")), dot)),
    }).drop("source_text")


def breakdown(explained: DataFrame) -> DataFrame:
    """Five rows per lead: factor, points, maximum, rule, reason."""
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(key).alias("factor"), F.lit(label).alias("label"),
                 F.lit(short).alias("short"), F.lit(top).alias("max_points"), F.lit(rule).alias("rule"),
                 F.coalesce(F.col(f"{key}_pts"), F.lit(0)).alias("points"),
                 F.col(f"reason_{key}").alias("reason"))
        for i, (key, label, short, top, rule) in enumerate(rules.FACTORS, 1)])
    return explained.select("facility_id", F.explode(rows).alias("f")).select("facility_id", "f.*")


def spotlight(explained: DataFrame) -> DataFrame:
    """The factor that best explains a lead: the first full one in fixed order, else the highest."""
    tops = {key: top for key, _, _, top, _ in rules.FACTORS}
    full = reduce(lambda acc, k: acc.when(F.col(f"{k}_pts") == tops[k], k), rules.SPOTLIGHT_ORDER[1:],
                  F.when(F.col(f"{rules.SPOTLIGHT_ORDER[0]}_pts") == tops[rules.SPOTLIGHT_ORDER[0]],
                         rules.SPOTLIGHT_ORDER[0]))
    keys = list(tops)
    best = F.greatest(*[F.col(f"{k}_pts") for k in keys])
    highest = reduce(lambda acc, k: acc.when(F.col(f"{k}_pts") == best, k), keys[1:],
                     F.when(F.col(f"{keys[0]}_pts") == best, keys[0]))
    named = explained.withColumn("spotlight", F.coalesce(full, highest))
    reason = reduce(lambda acc, k: acc.when(F.col("spotlight") == k, F.col(f"reason_{k}")), keys[1:],
                    F.when(F.col("spotlight") == keys[0], F.col(f"reason_{keys[0]}")))
    return named.withColumn("spotlight_reason", reason)


def lead_status(hold: Column, eligible: Column) -> Column:
    return (F.when(hold == "contested citation",
                   f"On hold: contested citation. {rules.REVIEW} {rules.NO_TALKING_POINT}")
            .when(hold.isNotNull(), F.concat(F.lit("On hold: "), hold, F.lit(f". {rules.REVIEW}")))
            .when(eligible, rules.READY).otherwise(rules.NOT_READY))


def why_label(tier: Column) -> Column:
    return F.concat(F.lit("Why it's "), tier)


def tier_line(total: Column, score_rules=rules.DEFAULT_RULES) -> Column:
    return F.concat(total.cast("string"), F.lit(
        f" of {rules.MAX_SCORE} points. Hot leads score {score_rules.hot_min}–{rules.MAX_SCORE} and have dust "
        f"evidence; Warm leads score {score_rules.warm_min}–{score_rules.hot_min - 1}."))


def briefing(leads: DataFrame, new_hot: DataFrame, has_previous: Column, gaps: DataFrame) -> DataFrame:
    """One row: headline count and label, counts of ready leads and gaps, newest evidence."""
    shown = leads.agg(
        F.count_if(F.col("tier") == rules.HOT).alias("hot_count"),
        F.least(F.count_if((F.col("tier") == rules.HOT) & F.col("outreach_eligible")),
                F.lit(rules.PRIORITY_SIZE)).alias("ready_count"),
        F.max("evidence_date").alias("newest_evidence"))
    fresh = new_hot.agg(F.count(F.lit(1)).alias("fresh"))
    missing = gaps.agg(F.count(F.lit(1)).alias("gap_count"))
    return attach(attach(shown, fresh), missing).select(
        F.when(has_previous, F.col("fresh")).otherwise(F.col("hot_count")).alias("headline_value"),
        F.when(~has_previous, "Hot leads in the territory")
        .when(F.col("fresh") == 1, "new Hot lead since the last run")
        .otherwise("new Hot leads since the last run").alias("headline_label"),
        "hot_count", "ready_count", "gap_count", "newest_evidence")
