"""The rubric: points, tier, confidence, hold, eligibility."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.codes import prefix_lookup
from ..functions.values import months_before
from .features import param


def _bands(cases: list[tuple[Column, int]]) -> Column:
    chain = reduce(lambda acc, c: acc.when(*c) if acc is not None else F.when(*c), cases, None)
    return chain.otherwise(0)


def recency_points(day: Column, as_of: Column, score_rules=rules.DEFAULT_RULES) -> Column:
    return _bands([(day >= months_before(as_of, months), points)
                   for points, months in score_rules.recency_bands])


def size_points(employees: Column, score_rules=rules.DEFAULT_RULES) -> Column:
    return _bands([(employees.between(low, high), points)
                   for points, low, high in score_rules.size_bands])


def confidence(employees: Column, conflict: Column) -> Column:
    doubts = employees.isNull().cast("int") + F.coalesce(conflict, F.lit(False)).cast("int")
    return F.element_at(F.array(F.lit("High"), F.lit("Medium"), F.lit("Low")), doubts + 1)


def hold_reason(fatality: Column, injury: Column, contest: Column, score_rules=rules.DEFAULT_RULES) -> Column:
    return (F.when(fatality.isNotNull(), f"fatality in the last {score_rules.window_months} months")
            .when(injury.isNotNull(), f"serious injury in the last {score_rules.injury_months} months")
            .when(contest.isNotNull(), "citation under contest"))


def evidence_points(evidence: DataFrame) -> DataFrame:
    """Strongest evidence per entity from the row-level table: level inputs in one grouping."""
    cited = F.col("kind") == "citation"
    day = lambda cond: F.max(F.when(cond, F.col("evidence_date")))
    return evidence.groupBy("facility_id").agg(
        day(cited & (F.col("category") == rules.DUST)).alias("dust_date"),
        day((cited & (F.col("category") == rules.ADJACENT)) | (F.col("kind") == "program_inspection"))
        .alias("adjacent_date"),
        F.coalesce(F.bool_or(cited & F.col("viol_type").isin(*rules.SERIOUS_TYPES)), F.lit(False))
        .alias("serious"))


def dust_level(df: DataFrame) -> DataFrame:
    """dust_pts, evidence_date and dust_reason from dust_date, adjacent_date and serious."""
    dust, adjacent = F.col("dust_date").isNotNull(), F.col("adjacent_date").isNotNull()
    return df.withColumns({
        "dust_pts": F.when(dust, 3).when(adjacent, 2).when(F.col("serious"), 1).otherwise(0),
        "evidence_date": F.coalesce("dust_date", "adjacent_date"),
        "dust_reason": F.when(dust, rules.DUST_REASONS[0]).when(adjacent, rules.DUST_REASONS[1])
                        .when(F.col("serious"), rules.DUST_REASONS[2]).otherwise(rules.DUST_REASONS[3]),
    })


def score(facts: DataFrame, signals: DataFrame, params: DataFrame,
          score_rules=rules.DEFAULT_RULES) -> DataFrame:
    """Score every entity of `facts`; the entity columns stay in the result."""
    as_of = param(params, "as_of")
    joined = facts.join(signals.select("facility_id", "release_lbs", "chemicals", "forms"),
                        "facility_id", "left")
    pts = ("industry_pts", "dust_pts", "recency_pts", "size_pts", "tri_air_pts")
    scored = dust_level(joined.withColumn("fit", prefix_lookup(F.col("naics"), score_rules.industries)))
    scored = scored.withColumns({
        "industry": F.col("fit.industry"),
        "industry_pts": F.coalesce("fit.points", F.lit(0)),
        "recency_pts": recency_points(F.col("evidence_date"), as_of, score_rules),
        "size_pts": size_points(F.col("employees"), score_rules),
        "tri_air_pts": (F.coalesce("release_lbs", F.lit(0.0)) > 0).cast("int"),
        "confidence": confidence(F.col("employees"), F.col("naics_conflict")),
        "hold_reason": hold_reason(F.col("fatality_date"), F.col("hospitalization_date"),
                                   F.col("contested_date"), score_rules),
    }).drop("fit")
    scored = scored.withColumn("total", reduce(lambda a, b: a + b, [F.col(p) for p in pts]))
    scored = scored.withColumn(
        "tier", F.when(F.col("dust_pts") == 0, rules.ARCHIVE)
        .when(F.col("total") >= score_rules.hot_min, rules.HOT)
        .when(F.col("total") >= score_rules.warm_min, rules.WARM).otherwise(rules.ARCHIVE))
    return scored.withColumn(
        "outreach_eligible", (F.col("tier") != rules.ARCHIVE) & F.col("hold_reason").isNull()
        & (F.col("confidence") != "Low"))
