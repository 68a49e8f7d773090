"""Text columns: trimming, ZIP codes, names, addresses, display forms."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .. import rules

NO_BREAK = "\u00a0"


def sql_literal(v) -> str:
    """A number or text as SQL literal (rule tables become one parsed expression)."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)


def literal_map(pairs) -> Column:
    return F.expr("map({})".format(", ".join(sql_literal(v) for pair in pairs for v in pair)))


def strip_ws(c: Column) -> Column:
    """Drop white space of any kind at both ends (`trim` drops blanks only)."""
    return F.btrim(c, F.lit(" \t\n\r\x0b\f"))


def words(c: Column) -> Column:
    """White-space separated words, without empty ones."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def blank_words(c: Column) -> Column:
    """Words of a text whose only white space is the blank."""
    return F.filter(F.split(c, " "), lambda w: w != "")


def zip5_padded(c: Column) -> Column:
    """Digits only, padded or cut to five; all zeros means unknown."""
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    return F.nullif(F.substring(F.lpad(digits, 5, "0"), 1, 5), F.lit("00000"))


def zip5_key(c: Column) -> Column:
    """Digits only, first five, padded; nothing stays empty (matching key form)."""
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) > 0, F.lpad(F.substring(digits, 1, 5), 5, "0")).otherwise("")


def strip_record_prefix(c: Column) -> Column:
    """Drop an internal record number before the name and trailing stars."""
    body = F.regexp_replace(c, rules.RECORD_PREFIX, "")
    return strip_ws(F.rtrim(body, F.lit("* ")))


def plain_words(c: Column) -> Column:
    """Upper-case words made of letters and digits only."""
    spelled = F.replace(F.upper(c), F.lit("&"), F.lit(" AND "))
    return blank_words(F.regexp_replace(spelled, "[^A-Z0-9 ]+", " "))


def normalize_name(c: Column, suffixes=rules.LEGAL_SUFFIXES) -> Column:
    legal_part = F.split(F.upper(strip_record_prefix(F.coalesce(c, F.lit("")))),
                         rules.TRADE_NAME_CUT, 2)[0]
    joined = F.regexp_replace(F.array_join(plain_words(legal_part), " "), r"\bL L C\b", "LLC")
    dropped = ["", *suffixes]
    return F.array_join(F.filter(F.split(joined, " "), lambda w: ~w.isin(*dropped)), " ")


def normalize_address(c: Column, street_words=rules.STREET_WORDS) -> Column:
    street = F.split(F.upper(F.coalesce(c, F.lit(""))), rules.UNIT_CUT, 2)[0]
    short = literal_map(street_words)
    return F.array_join(
        F.transform(plain_words(street), lambda w: F.coalesce(F.try_element_at(short, w), w)), " ")


def token_jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words of two normalised names; null if one is empty."""
    ta, tb = words(a), words(b)
    share = F.size(F.array_intersect(ta, tb)) / F.size(F.array_union(ta, tb))
    return F.when((a != "") & (b != ""), share)


def names_similar(a: Column, b: Column, threshold: float = 0.5) -> Column:
    same_first = F.substring_index(a, " ", 1) == F.substring_index(b, " ", 1)
    return F.coalesce((a != "") & (b != "") & (same_first | (token_jaccard(a, b) >= threshold)),
                      F.lit(False))


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.right(c, F.length(c) - 1)))


def pretty_name(c: Column) -> Column:
    """Readable form of an all-capitals name; mixed-case names stay as they are."""
    name = strip_record_prefix(c)

    def word(w: Column, i: Column) -> Column:
        core = F.regexp_replace(w, r"^[.,]+|[.,]+\z", "")
        keep = core.isin(*rules.KEEP_UPPER) | ((F.length(core) <= 3) & ~core.rlike(r"^\p{L}+\z"))
        return (F.when(keep, w)
                .when(core.isin(*rules.SMALL_WORDS) & (i > 0), F.lower(w))
                .otherwise(capitalize(w)))

    shouting = name.rlike(r"\p{Lu}") & ~name.rlike(r"\p{Ll}")
    return F.when(shouting, F.array_join(F.transform(words(name), word), " ")).otherwise(name)


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter."""
    pieces = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(pieces, capitalize), "")


def starts_with_any(c: Column, prefixes) -> Column:
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in prefixes])


def spreadsheet_safe(c: Column) -> Column:
    """Neutralise cells a spreadsheet would run as a formula."""
    return F.when(c.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), c)).otherwise(c)


def clean_chemical(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)", ""), r"\s+", " "))


def normalize_disposition(c: Column) -> Column:
    label = F.regexp_replace(F.lower(strip_ws(c)), " ", "_")
    return F.when(label.isin(*rules.DISPOSITIONS), label).otherwise("unknown")


def record_link(c: Column) -> Column:
    return F.format_string(rules.RECORD_LINK, c.cast("string"))


def public_hold(c: Column) -> Column:
    """Short public label of a hold; incident details stay out."""
    return F.when(c.contains("contest"), "contested citation").when(c.isNotNull(), "recent serious incident")


def violation_label(c: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(rules.VIOLATION_TYPES), c), c)


def keep_together(c: Column) -> Column:
    """No-break blanks inside each innermost pair of brackets, so that a code in brackets is never split."""
    def part(text: Column, place: Column) -> Column:
        end = F.instr(text, ")")
        return F.when((place > 0) & (end > 0), F.concat(
            F.translate(F.substring(text, F.lit(1), end), " ", NO_BREAK), F.substr(text, end + 1))).otherwise(text)

    return F.array_join(F.transform(F.split(c, r"\("), part), "(")


def short_reason(c: Column) -> Column:
    """First sentence of a reason, without its date tails and data-cut tail, with codes in brackets kept together."""
    date = r"[A-Z][a-z]{2} \d{1,2}, \d{4}"
    first = F.regexp_replace(F.split(c, r"\.\s+(?=[A-Z][a-z]|\d)", 2)[0], r"\.\z", "")
    # only the first data-cut tail goes; the lazy head keeps any later one
    no_cut = F.regexp_replace(first, rf"^(.*?)\s+of the {date} data cut", "$1")
    return keep_together(F.regexp_replace(no_cut, rf",\s+(?:issued |opened )?{date}", ""))
