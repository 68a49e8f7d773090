"""Lead lists and counts: folders, filters, sorts, zero-filled breakdowns."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.text import pretty_name
from ..session import stage_table
from .rank import lead_order, top
from .search import TrigramIndex, build_index


def assemble(scores: DataFrame, centroids: DataFrame) -> DataFrame:
    """Scored entities with the coordinates of their ZIP. Of several places with one ZIP the southernmost, then
    westernmost, counts, so every entity stays one row; places without coordinates do not count."""
    places = centroids.filter("lat IS NOT NULL AND lon IS NOT NULL").groupBy("zip5").agg(F.min(F.struct("lat", "lon")).alias("_at"))
    return (scores.join(places, "zip5", "left")
            .withColumns({"lat": F.col("_at.lat"), "lon": F.col("_at.lon")}).drop("_at"))


def with_stage(leads: DataFrame, overrides: DataFrame) -> DataFrame:
    """Stage of each lead: a valid saved one, else `hold` for held leads, else `top`.

    Of several valid stages saved for a lead, the one saved last counts (column `saved_at`), else the furthest along.
    """
    places = {s: i for i, (s, _) in enumerate(rules.STAGES)}
    place = F.coalesce(*[F.when(F.col("stage") == s, i) for s, i in places.items()])
    newest = [F.col("saved_at")] if "saved_at" in overrides.columns else []
    saved = (overrides.filter(F.col("stage").isin(*places)).groupBy(F.col("lead_id").alias("facility_id"))
             .agg(F.max_by("stage", F.struct(*newest, place)).alias("_saved")))
    default = F.when(F.col("hold_reason").isNotNull(), "hold").otherwise("top")
    return (leads.join(saved, "facility_id", "left")
            .withColumn("stage", F.coalesce("_saved", default)).drop("_saved"))


def with_signals(leads: DataFrame, citations: DataFrame, inspections: DataFrame) -> DataFrame:
    """Flag columns sig_<signal>; record-level flags are grouped once per entity."""
    by_program = inspections.groupBy("facility_id").agg(
        F.bool_or(F.col("dust_program") == rules.DUST_PROGRAM).alias("_nep"),
        F.bool_or(F.col("dust_program") == rules.SILICA_PROGRAM).alias("_silica_program"))
    by_code = citations.groupBy("facility_id").agg(
        F.bool_or(F.col("standard").contains(rules.SILICA_CITATION)).alias("_silica_code"))
    no = F.lit(False)
    industry = F.lower(F.coalesce("industry", F.lit("")))
    return (leads.join(by_program, "facility_id", "left").join(by_code, "facility_id", "left")
            .withColumns({
                "sig_nep": F.coalesce("_nep", no),
                "sig_silica": F.coalesce("_silica_program", no) | F.coalesce("_silica_code", no),
                "sig_tri": F.col("release_lbs").isNotNull(),
                "sig_wood": industry.contains("wood"),
                "sig_metal": industry.contains("metal")})
            .drop("_nep", "_silica_program", "_silica_code"))


def priority(leads: DataFrame, size: int = rules.PRIORITY_SIZE) -> DataFrame:
    """The best eligible Hot leads, a top-k."""
    return top(leads.filter((F.col("tier") == rules.HOT) & F.col("outreach_eligible")), size, lead_order())


def brief_candidates(leads: DataFrame, size: int = 25) -> DataFrame:
    return priority(leads, size)


def keyed(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row with the map `entries`: key -> struct of the columns. For a list whose length a limit bounds."""
    pair = F.struct(key, F.struct(*columns))
    return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("entries"))


def folder(leads: DataFrame, folder_id: str) -> DataFrame:
    if folder_id == "priority":
        return priority(leads)
    if folder_id in ("hot", "warm"):
        return leads.filter(F.col("tier") == folder_id.capitalize())
    if folder_id in ("hold", "reached", "contact", "audit"):
        return leads.filter(F.col("stage") == folder_id)
    return leads if folder_id == "all" else leads.filter(F.lit(False))


def search(leads: DataFrame, citations: DataFrame, query: str | None) -> DataFrame:
    """Leads whose shown name, city, ZIP or cited codes and titles contain `query`, any case."""
    q = (query or "").strip().lower()
    if not q:
        return leads
    cited = citations.filter(F.lower("standard").contains(q) | F.lower("title").contains(q)).select("facility_id")
    own = (F.lower(pretty_name(F.col("name"))).contains(q) | F.lower(F.coalesce("city", F.lit(""))).contains(q)
           | F.coalesce("zip5", F.lit("")).contains(q))
    hits = cited.distinct().withColumn("_cited", F.lit(True))
    return (leads.join(hits, "facility_id", "left")
            .filter(own | F.coalesce("_cited", F.lit(False))).drop("_cited"))


def search_index(leads: DataFrame, citations: DataFrame) -> TrigramIndex:
    """Index of all that `search` looks at."""
    own = leads.select("facility_id", pretty_name(F.col("name")).alias("a"), F.col("city").alias("b"), F.col("zip5").alias("c"))
    cited = citations.select("facility_id", F.col("standard").alias("a"), F.col("title").alias("b"), F.lit(None).cast("string").alias("c"))
    return build_index(own.unionByName(cited), "facility_id", [F.col(c) for c in "abc"])


def search_indexed(leads: DataFrame, citations: DataFrame, index: TrigramIndex, query: str | None) -> DataFrame:
    """As `search`, but only leads with all trigrams of the query are compared; `index` is of the same leads or more."""
    found = index.candidates((query or "").strip())
    if found is None:
        return search(leads, citations, query)
    found = stage_table(found, "candidates")
    return search(leads.join(found, "facility_id", "left_semi"), citations.join(found, "facility_id", "left_semi"), query)


def apply_filters(leads: DataFrame, citations: DataFrame, state: str | None = None,
                  industry: str | None = None, signal: str | None = None,
                  ready_only: bool = False, query: str | None = None, states=None) -> DataFrame:
    """All given filters together; a value that is no state, industry or signal means no filter."""
    wanted = []
    if state in (rules.TERRITORY if states is None else states):
        wanted.append(F.col("state") == state)
    if industry in [label for label, *_ in rules.INDUSTRIES]:
        wanted.append(F.col("industry") == industry)
    if signal in rules.SIGNALS:
        wanted.append(F.col(f"sig_{signal}"))
    if ready_only:
        wanted.append(F.col("outreach_eligible"))
    kept = leads.filter(reduce(lambda a, b: a & b, wanted)) if wanted else leads
    return search(kept, citations, query)


def sort_order(sort_id: str = "score") -> list[Column]:
    if sort_id == "evidence":
        return [F.desc_nulls_last("evidence_date"), *lead_order()]
    if sort_id == "name":
        return [F.collate("name", "UNICODE_CI_AI"), *lead_order()]
    return lead_order()


# ---------------------------------------------------------------------- counts
def tier_counts(leads: DataFrame) -> DataFrame:
    hot = F.col("tier") == rules.HOT
    held = F.col("hold_reason").isNotNull()
    return leads.agg(
        F.count(F.lit(1)).alias("facilities"),
        F.count_if(hot).alias("hot"),
        F.count_if(F.col("tier") == rules.WARM).alias("warm"),
        F.count_if(F.col("tier") == rules.ARCHIVE).alias("archive"),
        F.count_if(hot & F.col("outreach_eligible")).alias("hot_eligible"),
        F.count_if(hot & held).alias("held_hot"),
        F.count_if(hot & (F.col("confidence") == "Low") & ~held).alias("low_conf_hot"),
        F.count_if(held).alias("held_all"))


def zero_filled(counts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Counts for every value of a fixed dimension, in its order; missing ones are zero."""
    numbers = [c for c in counts.columns if c != key]
    return dimension.join(counts, key, "left").na.fill(0, numbers)


def hot_by(leads: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Hot and eligible Hot leads per value of `dimension`."""
    counts = leads.filter(F.col("tier") == rules.HOT).groupBy(key).agg(
        F.count(F.lit(1)).alias("hot"), F.count_if("outreach_eligible").alias("eligible"))
    return zero_filled(counts, dimension, key)


def industry_dimension(spark, industries=rules.INDUSTRIES) -> DataFrame:
    """The industries in priority order (a fixed list)."""
    return spark.createDataFrame([(i, label) for i, (label, _, _) in enumerate(industries, 1)],
                                 "position int, industry string")


def state_dimension(spark, states=rules.TERRITORY) -> DataFrame:
    return spark.createDataFrame(list(enumerate(states, 1)), "position int, state string")


def territory_stats(shown: DataFrame, territory: DataFrame) -> DataFrame:
    """Hot, the rest and all shown leads per state of the territory."""
    counts = shown.groupBy("state").agg(
        F.count_if(F.col("tier") == rules.HOT).alias("hot"),
        F.count_if(F.col("tier") != rules.HOT).alias("warm"), F.count(F.lit(1)).alias("total"))
    return zero_filled(counts, territory, "state")


def coverage_gaps(stats: DataFrame, notes: DataFrame) -> DataFrame:
    """States without a Hot lead for which a reason is known."""
    return stats.filter(F.col("hot") == 0).join(notes, "state")


def breakdown_bars(shown: DataFrame, key: str, dimension: DataFrame) -> DataFrame:
    """Bars per value, longest first; max_total scales them. Values outside the dimension count too."""
    counts = shown.groupBy(key).agg(
        F.count_if(F.col("tier") == rules.HOT).alias("hot"), F.count(F.lit(1)).alias("total"))
    # full_outer keeps both listed values without leads and unlisted values with leads
    bars = dimension.select(key, "position").join(counts, key, "full_outer").na.fill(0, ["hot", "total"])
    longest = counts.agg(F.greatest(F.coalesce(F.max("total"), F.lit(1)), F.lit(1))).scalar()
    return bars.select(key, "hot", (F.col("total") - F.col("hot")).alias("rest"), "total",
                       longest.alias("max_total"), "position").orderBy(
        F.desc("total"), F.asc_nulls_last("position"), key)


def folder_counts(leads: DataFrame) -> DataFrame:
    """Leads per folder in one pass."""
    eligible_hot = (F.col("tier") == rules.HOT) & F.col("outreach_eligible")
    in_stage = lambda s: F.count_if(F.col("stage") == s)
    return leads.agg(
        F.least(F.count_if(eligible_hot), F.lit(rules.PRIORITY_SIZE)).alias("priority"),
        F.count(F.lit(1)).alias("all"),
        F.count_if(F.col("tier") == rules.HOT).alias("hot"),
        F.count_if(F.col("tier") == rules.WARM).alias("warm"),
        *[in_stage(s).alias(s) for s in ("hold", "reached", "contact", "audit")])


def stage_counts(leads: DataFrame) -> DataFrame:
    return leads.agg(*[F.count_if(F.col("stage") == s).alias(s) for s, _ in rules.STAGES])


def signal_counts(leads: DataFrame) -> DataFrame:
    return leads.agg(*[F.count_if(f"sig_{s}").alias(s) for s in rules.SIGNALS])


def dimension_values(leads: DataFrame, key: str) -> DataFrame:
    return leads.select(key).distinct().orderBy(key)


def located(leads: DataFrame) -> DataFrame:
    return leads.dropna(subset=["lat", "lon"])


# ------------------------------------------------------------------ export rows
def csv_columns(ranked: DataFrame) -> DataFrame:
    """The 26 columns of the ranked lead file, in file order (fixed values)."""
    from .nested import public_lead
    return public_lead(ranked).select(
        "rank", "facility_id", "name", "city", "state", "zip5", "industry", "naics", "employees",
        "industry_pts", "dust_pts", "recency_pts", "size_pts", "tri_air_pts",
        F.col("release_lbs").alias("tri_air_release_lbs"),
        F.array_join("chemicals", "; ").alias("tri_air_chemicals"), "total", "tier", "confidence",
        "hold_reason", "facility_match_review_required", "outreach_eligible", "evidence_date",
        "dust_reason", "n_inspections", "last_inspection")


def screen_rows(ranked: DataFrame) -> DataFrame:
    """The 13 columns of the on-screen list export (fixed values); needs `hold` and `stage`."""
    from ..functions.text import literal_map
    status = (F.when(F.col("hold").isNotNull(), F.concat(F.lit("On hold: "), "hold"))
              .when(F.col("outreach_eligible"), "Ready").otherwise("Not ready"))
    stage = F.coalesce(F.try_element_at(literal_map(rules.STAGES), F.col("stage")), F.col("stage"))
    return ranked.select(
        F.col("rank").alias("Rank"), F.col("name").alias("Name"), F.col("city").alias("City"),
        F.col("state").alias("State"), F.col("zip5").alias("ZIP"), F.col("industry").alias("Industry"),
        F.col("employees").alias("Employees"), F.col("total").alias("Score"), F.col("tier").alias("Tier"),
        F.col("dust_reason").alias("Dust evidence"), F.col("evidence_date").alias("Evidence date"),
        status.alias("Status"), stage.alias("Pipeline stage"))
