"""Data-quality gate: fourteen checks, each a count of bad rows.

Same-table predicates share one aggregation, cross-table checks are semi and anti
joins or partially aggregated counts. The result is one small table.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.text import starts_with_any
from .features import attach, param

CHECKS = rules.CHECKS


def _row(name: str, df: DataFrame, bad: Column, detail: Column) -> DataFrame:
    """One check result out of a one-row aggregate of `df`."""
    return df.select(F.lit(CHECKS.index(name) + 1).alias("check_no"), F.lit(name).alias("check_name"),
                     F.coalesce(bad, F.lit(0)).cast("long").alias("bad_rows"), detail.alias("detail_ok"))


def _count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _bad(counted: DataFrame) -> DataFrame:
    return counted.agg(F.sum("n").alias("bad"))


def _thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def not_exactly_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, n): keys of `left` that do not occur exactly once in `right`, with their row counts."""
    mine = left.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = right.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    return mine.join(counts, key, "left").filter(F.coalesce("_c", F.lit(0)) != 1)


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, n): non-null keys of `left` that `right` lacks, with their row counts (null keys are not judged).

    Rows are counted per key first, so a key with many rows is one row in the join.
    """
    counted = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(right.select(key), key, "left_anti")


def run_checks(t: dict[str, DataFrame], states=rules.TERRITORY, load_start: str = rules.LOAD_START,
               score_rules=rules.DEFAULT_RULES) -> DataFrame:
    """Check table: check_no, check_name, bad_rows, passed, detail.

    `t` holds inspections, facility_map, facilities, violations, withdrawn (raw
    rows marked as withdrawn: activity_nr, citation_id, standard), standard_lookup,
    scores, evidence, signals and run_params.
    """
    insp, viol, fac, scores = t["inspections"], t["violations"], t["facilities"], t["scores"]
    out: list[DataFrame] = []
    add = lambda *a: out.append(_row(*a))

    # inspections: one scan for three checks, the distinct count apart
    as_of = param(t["run_params"], "as_of")
    n_bad_dates = F.count_if((F.col("open_date") < F.lit(load_start).cast("date")) | (F.col("open_date") > as_of))
    per_record = insp.groupBy("activity_nr").agg(
        F.count(F.lit(1)).alias("n"), n_bad_dates.alias("bad_dates"),
        F.count_if(~F.col("employees").between(1, 4999)).alias("bad_heads"),
        F.count_if(F.col("employees_reported") >= 5000).alias("cleared"))
    # ids that are null count as rows but not as distinct ids
    i = per_record.agg(F.sum("n").alias("n"), F.count("activity_nr").alias("ids"),
                       *[F.sum(c).alias(c) for c in ("bad_dates", "bad_heads", "cleared")])
    add(CHECKS[0], i, F.col("n") - F.col("ids"), F.concat(_thousands(F.col("n")), F.lit(" inspections")))
    add(CHECKS[6], i, F.col("bad_dates"), F.lit(f"{load_start} to as-of date"))
    add(CHECKS[7], i, F.col("bad_heads"),
        F.concat(F.col("cleared").cast("string"), F.lit(" company-wide totals cleared")))

    f = fac.agg(F.count(F.lit(1)).alias("n"), F.count_if(
        ~F.col("state").isin(*states) | ~starts_with_any(F.col("naics"), score_rules.prefixes)).alias("bad"))
    mapped = attach(_bad(not_exactly_one(insp, t["facility_map"], "activity_nr")), f.select("n"))
    add(CHECKS[1], mapped, F.col("bad"), F.concat(_thousands(F.col("n")), F.lit(" facilities")))
    add(CHECKS[5], f, F.col("bad"), F.lit("states " + ", ".join(states)))

    orphans = attach(_bad(missing_keys(viol, insp, "activity_nr")), _count(viol))
    add(CHECKS[2], orphans, F.col("bad"), F.concat(_thousands(F.col("n")), F.lit(" citations")))

    key = ["activity_nr", "citation_id", "standard"]
    # count of joined pairs without forming them: product of the two counts per key
    # in one grouping of both; null keys go in the sum, as a filter would make each code once more to drop them
    both = (viol.select(*key, F.lit(1).alias("k"), F.lit(0).alias("w"))
            .unionByName(t["withdrawn"].select(*key, F.lit(0).alias("k"), F.lit(1).alias("w")))
            .groupBy(*key).agg(F.sum("k").alias("k"), F.sum("w").alias("w")))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    pairs = both.agg(F.sum(F.when(whole & (F.col("w") > 0), F.col("k") * F.col("w"))).alias("bad"))
    add(CHECKS[3], pairs, F.col("bad"), F.lit(rules.CHECK_NOTES["withdrawn"]))

    unclassified = attach(_bad(missing_keys(viol, t["standard_lookup"], "standard")),
                          _count(t["standard_lookup"]))
    add(CHECKS[4], unclassified, F.col("bad"), F.concat(_thousands(F.col("n")), F.lit(" distinct standards")))

    add(CHECKS[8], _bad(not_exactly_one(fac, scores, "facility_id")), F.col("bad"),
        F.lit(rules.CHECK_NOTES["scores"]))

    parts = reduce(lambda a, b: a + b, [F.col(f"{p}_pts") for p in
                                        ("industry", "dust", "recency", "size", "tri_air")])
    tier = (F.when(F.col("dust_pts") == 0, rules.ARCHIVE).when(F.col("total") >= score_rules.hot_min, rules.HOT)
            .when(F.col("total") >= score_rules.warm_min, rules.WARM).otherwise(rules.ARCHIVE))
    held = F.col("hold_reason").isNotNull()
    s = scores.agg(
        F.count_if(~F.col("total").between(0, rules.MAX_SCORE) | ~F.col("tri_air_pts").between(0, 1)
                   | (F.col("total") != parts)).alias("sums"),
        F.count_if(F.col("tier") != tier).alias("tiers"),
        F.count_if(F.col("outreach_eligible") & (held | (F.col("confidence") == "Low")
                                                 | (F.col("tier") == rules.ARCHIVE))).alias("eligible"),
        F.count_if(held).alias("held"))
    add(CHECKS[9], s, F.col("sums"), F.lit(rules.CHECK_NOTES["sums"]))
    add(CHECKS[10], s, F.col("tiers"), F.lit(rules.CHECK_NOTES["tiers"]))
    add(CHECKS[11], s, F.col("eligible"), F.concat(_thousands(F.col("held")), F.lit(" leads on hold")))

    backed = t["evidence"].filter(F.col("category").isin(rules.DUST, rules.ADJACENT)).select("facility_id")
    bare = scores.filter(F.col("tier") == rules.HOT).select("facility_id").join(backed, "facility_id", "left_anti")
    add(CHECKS[12], _count(bare, "bad"), F.col("bad"), F.lit(rules.CHECK_NOTES["backed"]))

    # scores and signals both hold one row per entity, so a grouping of the signals is enough
    positive = (t["signals"].groupBy("facility_id").agg(F.max("release_lbs").alias("_lbs")))
    tri = attach(scores.select("facility_id", "tri_air_pts").join(positive, "facility_id", "left")
                 .agg(F.count_if(F.col("tri_air_pts") != F.coalesce((F.col("_lbs") > 0).cast("int"), F.lit(0)))
                      .alias("bad")), _count(t["signals"]))
    add(CHECKS[13], tri, F.col("bad"), F.concat(_thousands(F.col("n")), F.lit(" matched facility signals")))

    table = reduce(lambda a, b: a.unionByName(b), out)
    return table.select(
        "check_no", "check_name", "bad_rows", (F.col("bad_rows") == 0).alias("passed"),
        F.when(F.col("bad_rows") == 0, F.col("detail_ok"))
        .otherwise(F.concat(_thousands(F.col("bad_rows")), F.lit(" bad rows"))).alias("detail"))


def require_passed(checks: DataFrame) -> None:
    """Stop a build unless every check passed (the table has one row per check)."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise RuntimeError("; ".join(f"{r.check_name}: {r.detail}" for r in failed)
                           + " - outputs not written")
