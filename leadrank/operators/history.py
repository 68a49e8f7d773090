"""Run history: new-Hot delta, latest runs kept, score snapshots, lead-list merge.

Runs are stored as rows (as_of, run_seq, facility_id), not as lists, so a run of
any size stays distributed. `run_seq` is the order in which runs were made.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.text import pretty_name, title_case
from .features import attach


def earlier_run(history: DataFrame, as_of: Column) -> DataFrame:
    """as_of of the most recently made run with another date; one row, or none."""
    return (history.filter(F.col("as_of") != as_of)
            .groupBy("as_of").agg(F.max("run_seq").alias("run_seq"))
            .orderBy(F.desc("run_seq")).limit(1).select(F.col("as_of").alias("previous_as_of")))


def new_hot(hot: DataFrame, history: DataFrame, as_of: Column) -> DataFrame:
    """Hot entities that were not Hot in the previous run; empty on the first run.

    A re-run of a date is compared with the date before it.
    """
    previous = earlier_run(history, as_of).scalar()
    seen = history.filter(F.col("as_of") == previous).select("facility_id")
    return hot.filter(previous.isNotNull()).join(seen, "facility_id", "left_anti")


def new_hot_list(fresh: DataFrame, ranked: DataFrame) -> DataFrame:
    """New Hot leads with rank, shown name, place, industry and score; ids come in the column facility_id."""
    return (ranked.join(fresh.select("facility_id"), "facility_id", "left_semi")
            .select("rank", "facility_id", pretty_name(F.col("name")).alias("name"), title_case(F.col("city")).alias("city"),
                    "state", "industry", "total", "hold_reason", "outreach_eligible"))


def run_record(counts: DataFrame, load_counts: DataFrame, checks: DataFrame, match_year: int) -> DataFrame:
    """One row about a run: lead counts, the year of the matched forms, load counts, check results.

    `counts` has one row, `load_counts` one per loaded table, `checks` one per check.
    """
    loads = load_counts.agg(F.array_sort(F.collect_list(F.struct("name", "n", "national", "rejected"))).alias("loads"))
    results = checks.agg(F.array_sort(F.collect_list(F.struct("check_no", "check_name", "bad_rows", "passed"))).alias("checks"),
                         F.count_if("passed").alias("checks_passed"))
    return attach(attach(counts, loads), results).withColumn("match_year", F.lit(match_year))


def upsert_run(history: DataFrame, entry: DataFrame, keep: int = rules.HISTORY_RUNS) -> DataFrame:
    """History with `entry` as the newest run: same-date rows replaced, latest `keep` runs kept.

    `entry` holds one as_of and needs no run_seq. Runs are ordered by when they
    were made, not by date.
    """
    as_of = entry.select("as_of").limit(1).scalar()
    next_seq = history.agg(F.coalesce(F.max("run_seq"), F.lit(0)) + 1).scalar()
    merged = (history.filter(F.col("as_of") != as_of)
              .unionByName(entry.withColumn("run_seq", next_seq.cast(dict(history.dtypes)["run_seq"]))))
    # at most `keep` rows, by the limit
    kept = (merged.groupBy("as_of").agg(F.max("run_seq").alias("run_seq"))
            .orderBy(F.desc("run_seq")).limit(keep).select("as_of"))
    return merged.join(F.broadcast(kept), "as_of", "left_semi")


def snapshot_score_run(ranked: DataFrame, as_of: Column, scored_at: Column,
                       score_version: str = rules.SCORE_VERSION) -> DataFrame:
    """Versioned snapshot rows of a scored list, with the feature values in a struct."""
    points = [F.coalesce(c, F.lit(0)).alias(name) for c, name in (
        ("industry_pts", "industry"), ("dust_pts", "dust"), ("recency_pts", "recency"),
        ("size_pts", "size"), ("tri_air_pts", "tri_air"))]
    return ranked.select(
        "facility_id", "name", "state", "tier", "confidence", "hold_reason",
        F.coalesce("outreach_eligible", F.lit(False)).alias("outreach_eligible"),
        F.lit(score_version).alias("score_version"),
        F.date_format(scored_at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("scored_at"),
        as_of.alias("as_of"), F.col("total").cast("int").alias("total"),
        F.struct(*points).alias("feature_values"), "evidence_date",
        F.col("dust_reason").alias("score_explanation"))


def write_run(rows: DataFrame, path: str) -> None:
    """Write one run into a table partitioned by as_of; a re-run replaces only its date."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("as_of").parquet(path))


def merge_leads(known: DataFrame, found: DataFrame) -> DataFrame:
    """Merge newly found leads into the known list.

    A found lead that is known is a re-signal: its fields are refreshed, but
    date_found and a status set by a person stay. Unknown ones are new.
    """
    fields = [c for c in known.columns if c not in ("lead_id", "date_found", "status")]
    k, f = known.alias("k"), found.withColumn("_found", F.lit(True)).alias("f")
    return k.join(f, F.col("k.lead_id") == F.col("f.lead_id"), "full_outer").select(
        F.coalesce("k.lead_id", "f.lead_id").alias("lead_id"),
        *[F.when(F.col("f._found"), F.col(f"f.{c}")).otherwise(F.col(f"k.{c}")).alias(c) for c in fields],
        F.coalesce("k.date_found", "f.date_found").alias("date_found"),
        F.coalesce("k.status", F.lit("New")).alias("status"),
        F.when(F.col("k.lead_id").isNull(), "new").when(F.col("f._found"), "re-signal")
        .otherwise("unchanged").alias("change"))


def handoff(leads: DataFrame, min_score: int = 3) -> DataFrame:
    """Leads passed on without manual review: enough score and more than low confidence."""
    return leads.filter((F.col("total") >= min_score) & (F.col("confidence") != "Low"))
