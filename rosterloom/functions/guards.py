"""Row guards: one column expression per rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterloom import vocabulary as V
from rosterloom.config import GuardLimits
from rosterloom.functions.text import WHITE, casefold, strip_invisible, strip_space

LIMITS = GuardLimits()


def tidy(value: Column) -> Column:
    """Invisible characters and outer white space removed."""
    return strip_space(strip_invisible(value))


def blank_to_null(value: Column) -> Column:
    return F.when(value != "", value)


def quoted(value: Column) -> Column:
    """The value in quotes: single ones unless it holds an apostrophe and no double quote."""
    escaped = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(value.contains("'") & ~value.contains('"'), double).otherwise(single)


def name_problem(value: Column, key: Column, limits: GuardLimits = LIMITS) -> Column:
    """Why a required name cannot be used, or null.  ``key`` is its placeholder key."""
    too_long = f"longer than {limits.name_max_length} characters"
    return (F.when(F.coalesce(value, F.lit("")) == "", V.NAME_EMPTY)
            .when(F.char_length(value) > limits.name_max_length, too_long)
            .when(value.contains("@"), V.NAME_LOOKS_LIKE_EMAIL)
            .when(value.rlike(r"\p{Nd}"), V.NAME_HAS_DIGITS)
            .when(~value.rlike(r"\p{L}"), V.NAME_HAS_NO_LETTERS)
            .when(key.isin(V.NAME_PLACEHOLDERS),
                  F.concat(F.lit("placeholder value "), quoted(value))))


def email_guard(value: Column, limits: GuardLimits = LIMITS) -> tuple[Column, Column]:
    """(usable address, case folded, or null; note or null)."""
    good = ((F.char_length(value) <= limits.email_max_length)
            & value.rlike(rf"\A[^@{WHITE}]+@[^@{WHITE}]+\.[^@{WHITE}.]+\z"))
    return (F.when(good, casefold(value)),
            F.when(value.isNotNull() & ~good, "input.email_invalid"))


def linkedin_guard(normalized: Column) -> tuple[Column, Column]:
    """(canonical profile address or null; note or null) from a normalised URL.

    Query and fragment, a regional subdomain and everything behind the slug go.
    """
    profile = F.regexp_extract(
        normalized, rf"\A(?:[a-z]{{2,3}}\.)?(linkedin\.com/(?:in|pub)/[^/?#{WHITE}]+)", 1)
    return (blank_to_null(profile),
            F.when(normalized.isNotNull() & (profile == ""), "input.linkedin_url_invalid"))


def org_guard(value: Column, key: Column, name: str,
              limits: GuardLimits = LIMITS) -> tuple[Column, Column]:
    """(company or location or null; note or null)."""
    too_long = F.char_length(value) > limits.field_max_length
    placeholder = key.isin(V.ORG_PLACEHOLDERS)
    return (F.when(~too_long & ~placeholder, value),
            F.when(value.isNull(), F.lit(None)).when(too_long, f"input.{name}_too_long")
            .when(placeholder, f"input.{name}_placeholder"))


def consent_parse(value: Column, key: Column) -> tuple[Column, Column]:
    """(true, false or null; note or null) from a consent answer."""
    answer = F.when(key.isin(V.CONSENT_YES), True).when(key.isin(V.CONSENT_NO), False)
    return (F.when(value.isNotNull(), answer),
            F.when(value.isNotNull() & answer.isNull(), "input.consent_unrecognised"))


def notes(*note: Column) -> Column:
    """The notes that apply, each once, in order."""
    return F.array_distinct(F.array_compact(F.array(*note)))


def consent_problem(consent: Column, limits: GuardLimits = LIMITS) -> Column:
    missing = F.lit(V.CONSENT_MISSING) if limits.require_consent else F.lit(None).cast("string")
    return F.when(consent == F.lit(False), V.CONSENT_WITHHELD).when(consent.isNull(), missing)


def reason_family(reason: Column) -> Column:
    """A reject reason without its later parts and without the quoted value at its end."""
    head = F.regexp_extract(reason, r"\A[^;]*", 0)
    return strip_space(F.regexp_replace(head, rf"'[^']*'[{WHITE}]*\z", ""))


# ------------------------------------------------------------------ dates and positions


def valid_date(value: Column) -> Column:
    """``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD`` with a plausible year, month and day."""
    pattern = (r"\A(?:19\d\d|20\d\d|2100)"
               r"(?:-(?:0[1-9]|1[0-2])(?:-(?:0[1-9]|[12]\d|3[01]))?)?\z")
    return value.rlike(pattern)


def is_current(position: Column) -> Column:
    return F.coalesce(position["is_primary"], F.lit(False)) | position["end_date"].isNull()


def start_year(start_date: Column) -> Column:
    """The year in the first four characters when they are digits."""
    head = F.left(start_date, F.lit(4))
    return F.when(head.rlike(r"\A\d{1,4}\z"), head.cast("int"))


def title_levels(levels: Column) -> Column:
    """Levels without nulls and blanks, each once, in order; never null."""
    kept = F.filter(levels, lambda x: x.isNotNull() & (x != ""))
    return F.array_distinct(F.coalesce(kept, F.array().cast("array<string>")))


def order_experience(experience: Column) -> Column:
    """Current positions first, then the latest start; equal ones keep their order."""
    keyed = F.transform(experience, lambda e, i: F.struct(
        (~is_current(e)).alias("past"), F.coalesce(e["start_date"], F.lit("")).alias("start"),
        i.alias("i"), e.alias("e")))

    def compare(a: Column, b: Column) -> Column:
        return (F.when(a["past"] != b["past"], F.when(a["past"], 1).otherwise(-1))
                .when(a["start"] > b["start"], -1).when(a["start"] < b["start"], 1)
                .when(a["i"] < b["i"], -1).when(a["i"] > b["i"], 1).otherwise(0))

    return F.transform(F.array_sort(keyed, compare), lambda s: s["e"])
