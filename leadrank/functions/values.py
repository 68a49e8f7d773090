"""Dates, numbers and amounts from text."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import rules
from .text import strip_ws

#: Two of these add up without loss.
AMOUNT = "decimal(37,18)"
_PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"


def date_prefix(c: Column) -> Column:
    """Date in the first ten characters; a bad date fails the job (ANSI cast)."""
    return F.substring(c, 1, 10).cast("date")


def try_date_prefix(c: Column) -> Column:
    return F.substring(c, 1, 10).try_cast("date")


def try_double(c: Column) -> Column:
    """Text to double; null unless the whole text is a plain number."""
    return F.when(c.rlike(_PLAIN_NUMBER), c.try_cast("double"))


def try_int(c: Column) -> Column:
    """Text to integer by rounding, so '12.0' is 12 and '12.5' is 13."""
    return F.round(try_double(c)).try_cast("int")


def months_before(d: Column, months: int) -> Column:
    """Same day `months` earlier, moved to the month end where that day is missing."""
    return F.add_months(d, -months)


def readable_date(d: Column) -> Column:
    return F.coalesce(F.date_format(d, "MMM d, yyyy"), F.lit("no date"))


def amount(c: Column) -> Column:
    """Reported amount as exact decimal: blank codes are zero, commas are dropped.

    Null marks a value that breaks the contract: not a number, negative, or beyond what an exact amount can hold
    (19 whole digits and 18 decimals), so nothing is rounded away.
    """
    text = F.upper(strip_ws(F.coalesce(c, F.lit(""))))
    plain = F.replace(text, F.lit(","), F.lit(""))
    parsed = plain.try_cast(AMOUNT)
    rounded = plain.rlike(r"\.\d{18}\d*[1-9]") | ((parsed == 0) & plain.rlike(r"^[^E]*[1-9]"))
    return (F.when(text.isin("", *rules.BLANK_AMOUNTS), F.lit(0).cast(AMOUNT))
            .when((parsed >= 0) & ~rounded, parsed))


def whole_penalty(current: Column, initial: Column) -> Column:
    """Current penalty, else the initial one, else zero; rounded half to even."""
    return F.bround(F.coalesce(current, initial, F.lit(0.0)), 0).cast("long")


def numbers_in(text: Column) -> Column:
    """Distinct numbers of a text in one canonical spelling."""
    def whole_part(t: Column) -> Column:
        return F.when(t.startswith("0"), F.regexp_replace(t, r"^0+(?=\d)", "")).otherwise(t)

    def fraction(t: Column) -> Column:
        return F.when(t.contains("."), F.regexp_replace(t, r"\.?0+\z", "")).otherwise(t)

    # one step after the other: inside one step, each use of a part would work it out again
    found = F.transform(F.regexp_extract_all(text, F.lit(rules.NUMBER), F.lit(0)), lambda t: F.replace(t, F.lit(","), F.lit("")))
    return F.array_distinct(F.transform(F.transform(found, whole_part), fraction))
