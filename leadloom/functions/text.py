"""Names, slugs, addresses, phones and e-mails as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.functions.urls import blank_to_null, strip

# Patterns and word lists that define the results.
LAX_PHONE = r"\+?1?\D*(\d{3})\D*(\d{3})\D*(\d{4})"
US_PHONE = r"(\+?1[\s\-\.]?)?(\(?\d{3}\)?)[\s\-\.]?(\d{3})[\s\-\.]?(\d{4})"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
STATE = r"\b([A-Z]{2})\b"
ZIP = r"\b(\d{5})(?:-\d{4})?\b"
COMPANY_SUFFIXES = (" llc", " inc", " ltd", " co", " corporation", " company")
COMPANY_WORDS = r"\b(llc|inc|corp|corporation|co|company|ltd|lp|llp|pllc|trust)\b"
NUMBER = r"([0-9]+(?:,[0-9]{3})*)"


def squish(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends, blank as null."""
    return blank_to_null(strip(F.regexp_replace(c, r"(?U)\s+", " ")))


def phone_lax(c: Column) -> Column:
    """Ten digits wherever three, three and four follow each other with anything but digits between. For short fields only."""
    return F.when(c.rlike(r"\d{3}") & c.rlike(LAX_PHONE), F.concat(*[F.regexp_extract(c, LAX_PHONE, i) for i in (1, 2, 3)]))


def phone_resolver(c: Column) -> Column:
    """All digits where there are ten or more."""
    digits = F.regexp_replace(c, r"\D", "")
    return F.when(F.length(digits) >= 10, digits)


def _us_digits(c: Column) -> Column:
    digits = F.regexp_replace(F.regexp_extract(c, US_PHONE, 0), r"\D", "")
    return F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)


def phone_expansion(c: Column) -> Column:
    """Ten digits of the first phone number in a text, without the country's 1."""
    return F.when(F.length(_us_digits(c)) == 10, _us_digits(c))


def phone_site(c: Column) -> Column:
    return blank_to_null(_us_digits(c))


def emails(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(EMAIL), F.lit(0))


def first_email(c: Column) -> Column:
    return blank_to_null(F.lower(F.regexp_extract(c, EMAIL, 0)))


def name_resolver(c: Column) -> Column:
    """Lower case without COMPANY_SUFFIXES, each removed wherever it stands, in that order."""
    return F.when(c != "", strip(reduce(lambda acc, s: F.replace(acc, F.lit(s), F.lit("")), COMPANY_SUFFIXES, F.lower(c))))


def name_canonical(c: Column) -> Column:
    """Lower-case words and digits without company words; empty for null."""
    plain = F.regexp_replace(F.lower(strip(c)), r"[^a-z0-9\s]", " ")
    return F.coalesce(F.trim(F.regexp_replace(F.regexp_replace(plain, COMPANY_WORDS, " "), r"\s+", " ")), F.lit(""))


def name_bbb(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", ""), r"\s+", " "))


def slug(city: Column, state: Column) -> Column:
    base = F.lower(strip(F.concat(city, F.lit("-"), state)))
    kept = F.regexp_replace(F.regexp_replace(base, r"[ _,]", "-"), r"[^\p{L}\p{N}\-]", "")
    return F.regexp_replace(F.regexp_replace(kept, "-{2,}", "-"), "^-|-$", "")


def address_parts(c: Column) -> Column:
    """The non-blank parts between commas and line ends."""
    return F.filter(F.transform(F.split(c, r",|\n"), strip), lambda p: p != "")


def address(c: Column) -> Column:
    """Struct of mailing_address, street, city, state and zip. The first two capitals that stand alone are the state and the
    first five digits the zip, wherever they are: "123 N Main St, Townsville, TN 37000" is in state "ST"."""
    raw = strip(F.coalesce(c, F.lit("")))
    parts = address_parts(raw)
    return F.struct(
        blank_to_null(raw).alias("mailing_address"),
        F.get(parts, F.lit(0)).alias("mailing_street"),
        F.get(parts, F.lit(1)).alias("mailing_city"),
        blank_to_null(F.regexp_extract(F.upper(raw), STATE, 1)).alias("mailing_state"),
        blank_to_null(F.regexp_extract(raw, ZIP, 1)).alias("mailing_zip"),
    )


def address_lines(c: Column) -> Column:
    """Struct of street, city, state and zip from up to three comma-separated parts; state and zip (with its extension) come
    from the third part, else from the whole."""
    raw = strip(F.coalesce(c, F.lit("")))
    parts = address_parts(raw)
    tail = F.coalesce(F.get(parts, F.lit(2)), F.lit(""))
    pick = lambda p: F.coalesce(blank_to_null(F.regexp_extract(tail, p, 1)), blank_to_null(F.regexp_extract(raw, p, 1)))
    return F.struct(
        F.get(parts, F.lit(0)).alias("street"), F.get(parts, F.lit(1)).alias("city"), pick(STATE).alias("state"), pick(r"\b(\d{5}(?:-\d{4})?)\b").alias("zip")
    )


def code_desc(c: Column) -> Column:
    """Struct of raw, code and desc of texts like "01 - PUBLIC"; without the dash all is desc."""
    raw = squish(c)
    at = F.instr(raw, " - ")
    code = F.when(at > 0, squish(F.substring(raw, F.lit(1), at)))
    desc = F.when(at > 0, squish(F.substring(raw, at + 3, F.length(raw)))).otherwise(raw)
    return F.struct(raw.alias("raw"), code.alias("code"), desc.alias("desc"))


def first_int(c: Column) -> Column:
    """The first number of a text, thousands' commas removed."""
    return F.replace(blank_to_null(F.regexp_extract(c, NUMBER, 1)), F.lit(","), F.lit("")).try_cast("bigint")


def money(c: Column) -> Column:
    pattern = r"\$?\s*([0-9]+(?:,[0-9]{3})*)(?:\.[0-9]{2})?"
    return F.replace(blank_to_null(F.regexp_extract(c, pattern, 1)), F.lit(","), F.lit("")).try_cast("bigint")


def truthy(c: Column, default: bool = False) -> Column:
    word = F.lower(strip(c.cast("string")))
    return F.when(word.isin("1", "true", "yes", "y", "on"), True).when(word.isin("0", "false", "no", "n", "off"), False).otherwise(F.lit(default))


def safe_int(c: Column, default: int | None = None) -> Column:
    """Whole numbers only; anything else is the default."""
    text = strip(c.cast("string"))
    return F.coalesce(F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")), F.lit(default).cast("bigint"))


def metric_int(c: Column, default: int = 0) -> Column:
    """Whole numbers, or others cut off at the point."""
    return F.coalesce(safe_int(c), strip(c.cast("string")).try_cast("double").try_cast("bigint"), F.lit(default).cast("bigint"))


def safe_rate(num: Column, den: Column, digits: int = 4) -> Column:
    return F.when(den <= 0, F.lit(0.0)).otherwise(F.round(num.cast("double") / den.cast("double"), digits))


def best_email(*candidates: Column, fallback: Column | None = None) -> Column:
    """The first candidate that is not blank."""
    last = fallback if fallback is not None else F.lit(None).cast("string")
    return F.coalesce(*[blank_to_null(c) for c in candidates], last)
