"""Ranking evaluation against known outcomes: precision, recall and lift at K."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.text import normalize_disposition
from .features import attach

DEFAULT_K = 25


def resolve_outcomes(outcomes: DataFrame, positive_label: str = rules.POSITIVE_LABEL) -> DataFrame:
    """(facility_id, positive): the last known label of each entity.

    Columns: facility_id, outcome and/or disposition (text), qualified (boolean,
    optional), seq (order). A known text label wins over `qualified`; text in
    `qualified` is no label; unknown labels are ignored.
    """
    columns = outcomes.columns
    text = [F.col(c) for c in ("outcome", "disposition") if c in columns]
    label = normalize_disposition(F.coalesce(*text, F.lit("unknown")))
    boolean = "qualified" in columns and dict(outcomes.dtypes)["qualified"] == "boolean"
    fallback = F.col("qualified") if boolean else F.lit(None).cast("boolean")
    wanted = normalize_disposition(F.lit(positive_label))
    positive = F.when(label != "unknown", label == wanted).otherwise(fallback)
    return (outcomes.filter(F.col("facility_id").isNotNull())
            .select(F.col("facility_id").cast("string").alias("facility_id"), "seq", positive.alias("positive"))
            .filter(F.col("positive").isNotNull())
            .groupBy("facility_id").agg(F.max_by("positive", "seq").alias("positive")))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b)


def evaluate_rankings(ranked: DataFrame, outcomes: DataFrame, k: int | None = DEFAULT_K,
                      order: list[Column] | None = None,
                      positive_label: str = rules.POSITIVE_LABEL) -> DataFrame:
    """One row of measures over the first `k` rows of `ranked` (all rows if None).

    The first k rows come from a top-k, so the list is never fully sorted. An id
    that occurs twice in the list counts twice, as list positions do.
    """
    labels = resolve_outcomes(outcomes, positive_label)
    ids = ranked.select(F.col("facility_id").cast("string").alias("facility_id"))
    if k is not None:
        ids = (ranked.orderBy(*(order or [F.asc("rank")])).limit(k)
               .select(F.col("facility_id").cast("string").alias("facility_id")))
    head = ids.join(labels, "facility_id", "left").agg(
        F.count(F.lit(1)).alias("k"),
        F.count("positive").alias("labeled"),
        F.count_if("positive").alias("hits"))
    base = labels.agg(F.count(F.lit(1)).alias("n_labels"), F.count_if("positive").alias("positives"))
    size = ranked.agg(F.count(F.lit(1)).alias("total"))
    joined = attach(attach(head, base), size)
    precision = _ratio(F.col("hits"), F.col("labeled"))
    base_rate = F.col("positives") / F.greatest(F.col("n_labels"), F.lit(1))
    some = F.col("total") > 0
    return joined.select(
        "k",
        F.bround(precision, 4).alias("precision_at_k"),
        F.when(some, F.coalesce(F.bround(_ratio(F.col("hits"), F.col("positives")), 4), F.lit(0.0)))
        .otherwise(0.0).alias("recall_at_k"),
        F.bround(F.when(base_rate > 0, precision / base_rate), 4).alias("lift_at_k"),
        F.when(some, F.col("positives")).otherwise(0).alias("qualified_outcomes"),
        F.col("total").alias("total_leads"),
        F.col("labeled").alias("labeled_leads_at_k"),
        F.coalesce(F.bround(_ratio(F.col("labeled"), F.col("k")), 4), F.lit(0.0)).alias("labeled_coverage_at_k"))
