"""Exact, unique matching of outside emission forms to entities."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.text import normalize_name, starts_with_any, strip_ws, zip5_key
from ..functions.values import amount

NAICS_COLUMNS = tuple(f"naics_{i}" for i in range(1, 7))


def form_contract_breaches(forms: DataFrame, year: int = rules.EMISSION_YEAR) -> DataFrame:
    """Rows that must stop a load: wrong year, wrong state, unreadable amount in a selected form."""
    bad_amount = _selected() & (amount(F.col("fugitive_air")).isNull() | amount(F.col("stack_air")).isNull())
    breach = (F.when(strip_ws(F.coalesce("year", F.lit(""))) != str(year), "year")
              .when(F.upper(strip_ws(F.coalesce("state", F.lit("")))) != F.col("file_state"), "state")
              .when(bad_amount, "amount"))
    return forms.withColumn("breach", breach).filter(F.col("breach").isNotNull())


def _selected() -> Column:
    plain = lambda c: F.upper(strip_ws(F.coalesce(F.col(c), F.lit(""))))
    return (plain("metal") == "YES") & (plain("form_type") == "R") & (plain("unit") == "POUNDS")


def metal_air_forms(forms: DataFrame, prefixes=rules.DEFAULT_RULES.prefixes) -> DataFrame:
    """Metal release forms with a positive amount, summed per facility as written.

    A facility writes itself the same way on most of its forms, so the costly name
    normalisation runs once per spelling instead of once per form.
    """
    target = F.exists(F.array(*[strip_ws(F.coalesce(F.col(c), F.lit(""))) for c in NAICS_COLUMNS]),
                      lambda code: starts_with_any(code, prefixes))
    spelled = (forms.filter(_selected())
               # generated, so that the filter does not work the amounts out once more below
               .select("*", F.explode(F.array(amount(F.col("fugitive_air")) + amount(F.col("stack_air")))).alias("release"))
               .filter(F.col("release") > 0)
               .withColumns({"target": target, "chemical": strip_ws(F.coalesce("chemical", F.lit("")))})
               .groupBy("facility_name", "state", "zip").agg(
                   # chemical names come from the fixed list of reportable substances, which bounds the set
                   F.sum("release").alias("release"), F.collect_set("chemical").alias("chemicals"),
                   F.count(F.lit(1)).alias("forms"), F.count_if("target").alias("target_forms")))
    return spelled.select(normalize_name(F.col("facility_name")).alias("match_name"),
                          F.upper(strip_ws(F.col("state"))).alias("match_state"),
                          zip5_key(F.col("zip")).alias("match_zip"),
                          "release", "chemicals", "forms", "target_forms")


def entity_keys(facilities: DataFrame) -> DataFrame:
    """Match keys of entities: how many distinct entities carry a key, and the one if it is unique."""
    # generated, so that the filter does not normalise the names once more below
    return (facilities.select(
                "facility_id", F.explode(F.array(normalize_name(F.col("name")))).alias("match_name"),
                F.col("state").alias("match_state"), zip5_key(F.col("zip5")).alias("match_zip"))
            .filter((F.col("match_name") != "") & (F.col("match_state") != "") & (F.col("match_zip") != ""))
            .groupBy("match_name", "match_state", "match_zip")
            .agg(F.min("facility_id").alias("facility_id"),
                 (F.min("facility_id") == F.max("facility_id")).alias("unique_entity")))


def matched_keys(forms: DataFrame, facilities: DataFrame) -> DataFrame:
    """Forms summed per match key, each key with its verdict.

    Forms are aggregated to one row per key before the join, so a key that holds
    a large part of all forms reaches the join as a single row.
    """
    key = ["match_name", "match_state", "match_zip"]
    per_key = metal_air_forms(forms).groupBy(*key).agg(
        F.sum("release").alias("release"),
        F.array_distinct(F.flatten(F.collect_set("chemicals"))).alias("chemicals"),
        F.sum("forms").alias("forms"), F.sum("target_forms").alias("target_forms"))
    verdict = (F.when(F.col("unique_entity"), "matched")
               .when(F.col("unique_entity").isNotNull(), "ambiguous").otherwise("unmatched"))
    return per_key.join(entity_keys(facilities), key, "left").withColumn("verdict", verdict)


def air_signals(matched: DataFrame) -> DataFrame:
    """Per entity: released amount, sorted substance names, number of forms.

    An entity has one key and a matched key has one entity, so no second grouping is needed.
    """
    return matched.filter(F.col("verdict") == "matched").select(
        "facility_id", F.col("release").cast("double").alias("release_lbs"),
        F.array_sort("chemicals").alias("chemicals"), F.col("forms").cast("int").alias("forms"))


def match_stats(matched: DataFrame) -> DataFrame:
    """Form counts by verdict; missed forms count only for target industries."""
    forms = lambda v, c: F.coalesce(F.sum(F.when(F.col("verdict") == v, F.col(c))), F.lit(0)).cast("long")
    return matched.agg(
        forms("matched", "forms").alias("matched_forms"),
        forms("unmatched", "target_forms").alias("unmatched_forms"),
        forms("ambiguous", "target_forms").alias("ambiguous_forms"),
        F.count_if(F.col("verdict") == "matched").alias("facilities_with_signal"))
