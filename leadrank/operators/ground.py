"""Bulk grounding checks of drafted texts against the records they may rely on.

Drafts and facts are tables. Allowed numbers, counts and record ids are exploded
rows, so every test is a key join or anti join; nothing is gathered per lead.

Drafts: draft_id, facility_id, attempt, why_now, talking_points[{point,
inspection_ids[]}], email_subject, email_body.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import rules
from ..functions.text import words
from ..functions.values import numbers_in
from .features import attach

DRAFT = ["draft_id", "facility_id", "attempt"]


# ---------------------------------------------------------------- what is allowed
def allowed_numbers(leads: DataFrame, inspections: DataFrame, citations: DataFrame,
                    as_of: Column) -> DataFrame:
    """Distinct (facility_id, number) of everything a fact sheet shows."""
    def numbers(df: DataFrame, *parts) -> DataFrame:
        text = F.concat_ws(" ", *[p if isinstance(p, Column) else F.col(p).cast("string") for p in parts])
        return df.select("facility_id", F.explode(numbers_in(text)).alias("number"))

    dated = leads.withColumn("_as_of", as_of)
    return (numbers(dated, "_as_of", "name", "city", "state", "industry", "naics", "employees")
            .unionByName(numbers(inspections, "activity_nr", "opened", "dust_program",
                                 "citation_count", "other_citations"))
            .unionByName(numbers(citations, "standard", "title", "category", "type", "issued", "penalty_usd"))
            .distinct())


def allowed_counts(leads: DataFrame, inspections: DataFrame, citations: DataFrame) -> DataFrame:
    """Distinct (facility_id, allowed) counts: totals, per record, per category."""
    per_lead = inspections.groupBy("facility_id").agg(
        F.count(F.lit(1)).alias("n_inspections"), F.sum("citation_count").alias("n_citations"),
        F.sum("other_citations").alias("n_other"))
    is_cat = lambda c: F.count_if(F.col("category") == c)
    per_category = citations.groupBy("facility_id").agg(
        is_cat(rules.DUST).alias("dust"), is_cat(rules.ADJACENT).alias("adjacent"),
        is_cat(rules.OTHER).alias("other"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    totals = (leads.select("facility_id").join(per_lead, "facility_id", "left")
              .join(per_category, "facility_id", "left")
              .select("facility_id", F.explode(F.array(
                  zero("n_inspections"), zero("n_citations"), zero("n_citations") + zero("n_other"),
                  zero("dust"), zero("adjacent"), zero("other"), zero("dust") + zero("adjacent")))
                  .alias("allowed")))
    each = inspections.select("facility_id", F.explode(F.array("citation_count", "other_citations")).alias("allowed"))
    return totals.unionByName(each).distinct()


# -------------------------------------------------------------------- draft fields
def draft_fields(drafts: DataFrame) -> DataFrame:
    """(draft, field, text): the texts of a draft, one row each."""
    fixed = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text"))
                      for f in ("why_now", "email_subject", "email_body")])
    points = F.transform("talking_points", lambda p, i: F.struct(
        F.concat(F.lit("talking point "), (i + 1).cast("string")).alias("field"), p["point"].alias("text")))
    return drafts.select(*DRAFT, F.inline(F.concat(fixed, points)))


def ungrounded_numbers(fields: DataFrame, numbers: DataFrame) -> DataFrame:
    """Numbers of a text that the facts do not hold; offer lengths such as '20-minute' are exempt."""
    stated = fields.select(*DRAFT, "field", F.explode(numbers_in(
        F.regexp_replace("text", rules.OFFER_NUMBER, ""))).alias("number"))
    return stated.join(numbers, ["facility_id", "number"], "left_anti")


def wrong_counts(fields: DataFrame, counts: DataFrame) -> DataFrame:
    """Stated counts of citations, violations or inspections that match no allowed count."""
    group = lambda i: F.regexp_extract_all("text", F.lit(rules.COUNT_CLAIM), F.lit(i))
    claims = (fields.select(*DRAFT, "field", F.inline(F.arrays_zip(
        group(1).alias("value"), group(2).alias("noun"))))
        .withColumn("allowed", F.col("value").cast("long")))
    return claims.join(counts, ["facility_id", "allowed"], "left_anti").drop("allowed")


def source_ids(drafts: DataFrame) -> DataFrame:
    """(draft, point number, id); one row with a null id for a point without ids."""
    return (drafts.select(*DRAFT, F.posexplode("talking_points").alias("pos", "p"))
            .select(*DRAFT, (F.col("pos") + 1).alias("point_no"),
                    F.explode_outer("p.inspection_ids").alias("inspection_id")))


def bad_sources(drafts: DataFrame, inspections: DataFrame) -> DataFrame:
    """Points without a source and ids that are not in the lead's records."""
    ids = source_ids(drafts)
    known = inspections.select("facility_id", F.col("activity_nr").cast("string").alias("inspection_id"))
    return ids.join(known, ["facility_id", "inspection_id"], "left_anti")


def banned_topics(fields: DataFrame) -> DataFrame:
    hits = F.array(*[F.when(F.col("text").rlike(f"(?i){pattern}"), F.lit(topic))
                     for topic, pattern in rules.BANNED_TOPICS])
    # few texts mention any: one pattern of all finds them, and only these are judged by each
    any_topic = "|".join(f"(?:{pattern})" for _, pattern in rules.BANNED_TOPICS)
    return fields.filter(F.col("text").rlike(f"(?i){any_topic}")).select(*DRAFT, "field", F.explode(F.array_compact(hits)).alias("topic"))


def format_issues(drafts: DataFrame, sign_off: str, word_limit: int = rules.WORD_LIMIT) -> DataFrame:
    """Currency sign, over-long body, missing sign-off: one row per issue."""
    body = F.col("email_body")
    n = F.size(words(body))
    found = F.array(
        F.when(body.contains("$"), F.lit(rules.ISSUES["dollar"])),
        F.when(n > word_limit, F.concat(F.lit("email_body: "), n.cast("string"),
                                        F.lit(f" words (limit {word_limit})"))),
        F.when(~F.right(body, F.lit(80)).contains(sign_off),
               F.lit(f"email_body: doesn't end with the '{sign_off}' sign-off")))
    return drafts.select(*DRAFT, F.explode(F.array_compact(found)).alias("issue"))


# ------------------------------------------------------------------------ verdict
def issue_kind(issue: Column) -> Column:
    first, *rest = rules.ISSUE_KINDS
    chain = reduce(lambda acc, k: acc.when(issue.contains(k[0]), k[1]), rest,
                   F.when(issue.contains(first[0]), first[1]))
    return chain.otherwise("unusable response")


def issues(drafts: DataFrame, leads: DataFrame, inspections: DataFrame, citations: DataFrame,
           as_of: Column, sign_off: str) -> DataFrame:
    """Every issue of every draft: draft_id, facility_id, attempt, issue, kind."""
    fields = draft_fields(drafts)
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    point = text("talking point ", F.col("point_no").cast("string"))
    sources = bad_sources(drafts, inspections).withColumn("issue", F.when(
        F.col("inspection_id").isNull(), text(point, rules.ISSUES["no source"]))
        .otherwise(text(point, rules.ISSUES["unknown source"], F.col("inspection_id"))))
    numbers = ungrounded_numbers(fields, allowed_numbers(leads, inspections, citations, as_of)).withColumn(
        "issue", text(F.col("field"), ": number ", F.col("number"), " is not in the records"))
    counts = wrong_counts(fields, allowed_counts(leads, inspections, citations)).withColumn(
        "issue", text(F.col("field"), ": '", F.col("value"), " ", F.col("noun"), "' doesn't match the records"))
    topics = banned_topics(fields).withColumn("issue", text(F.col("field"), ": mentions ", F.col("topic")))
    found = [df.select(*DRAFT, "issue") for df in
             (sources, numbers, counts, topics, format_issues(drafts, sign_off))]
    return reduce(lambda a, b: a.unionByName(b), found).withColumn("kind", issue_kind(F.col("issue")))


def attempt_results(drafts: DataFrame, found: DataFrame) -> DataFrame:
    """Issue count and verdict of each attempt; an attempt passes without issues."""
    per_attempt = found.groupBy(*DRAFT).agg(F.count(F.lit(1)).alias("n_issues"))
    return drafts.select(*DRAFT).join(per_attempt, DRAFT, "left").select(
        *DRAFT, F.coalesce("n_issues", F.lit(0)).alias("n_issues"),
        F.col("n_issues").isNull().alias("passed"))


def verdicts(results: DataFrame) -> DataFrame:
    """Verdict per draft: its last attempt decides."""
    return results.groupBy("draft_id", "facility_id").agg(
        F.count(F.lit(1)).alias("attempts"), F.max_by("passed", "attempt").alias("passed"),
        F.sum("n_issues").alias("n_issues"),
        F.bool_or((F.col("attempt") == 1) & F.col("passed")).alias("first_try")).withColumn(
        "status", F.when(F.col("passed"), "verified").otherwise("needs human edit"))


def run_summary(verdict: DataFrame, usage: DataFrame, price_in: float, price_out: float) -> DataFrame:
    """One row: outcomes of a drafting run, tokens and cost (prices per million tokens)."""
    tokens = usage.agg(F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
                       F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"))
    counts = verdict.agg(
        F.count(F.lit(1)).alias("briefs"), F.count_if("first_try").alias("passed_first_try"),
        F.count_if((F.col("attempts") == 2) & F.col("passed")).alias("fixed_on_retry"),
        F.count_if(~F.col("passed")).alias("needs_human_edit"),
        F.coalesce(F.sum("n_issues"), F.lit(0)).alias("issues_caught"))
    cost = F.col("input_tokens") / 1e6 * price_in + F.col("output_tokens") / 1e6 * price_out
    return attach(counts, tokens).withColumn("cost_usd", F.bround(cost, 2))


def issue_kind_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def retry_table(drafts: DataFrame, found: DataFrame) -> DataFrame:
    """Failing first attempts with their issues: the input of a second drafting round.

    A draft's issues are bounded by its own text and points.
    """
    listed = found.groupBy(*DRAFT).agg(F.array_sort(F.collect_list("issue")).alias("issues"))
    return drafts.filter(F.col("attempt") == 1).join(listed, DRAFT)
