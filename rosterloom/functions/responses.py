"""Reading provider responses: headers, credits, waits, and profiles held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterloom.functions.guards import title_levels


def header(headers: Column, name: str) -> Column:
    """One header by name, whatever its case (``headers`` is map<string,string>)."""
    found = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name)
    return F.get(found, F.lit(0))["value"]


def _whole(text: Column) -> Column:
    plain = F.regexp_replace(F.trim(text), "_", "")
    return F.when(plain.rlike(r"\A[+-]?\d+\z"), plain.try_cast("int"))


def billable(kind: Column, http_status: Column) -> Column:
    return (http_status == 200) | ((kind == "identify") & (http_status == 404))


def credits_spent(kind: Column, http_status: Column, headers: Column) -> Column:
    """Credits of one call: the provider's header, else one for a billable response."""
    told = _whole(header(headers, "x-call-credits-spent"))
    return F.coalesce(told, F.when(billable(kind, http_status), 1).otherwise(0))


def first_number(text: Column) -> Column:
    """A number, or the smallest number of a JSON object of numbers, as double."""
    bare = F.trim(text)
    number = F.when(bare.rlike(r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"),
                    bare.try_cast("double"))
    members = F.map_values(F.from_json(
        F.when(bare.startswith("{"), bare), "map<string,string>"))
    numbers = F.transform(members, lambda m: m.try_cast("double"))
    return F.coalesce(number, F.array_min(F.array_compact(numbers)))


def seconds_until(text: Column, now: Column) -> Column:
    """Seconds from ``now`` to a UTC time such as ``2026-09-25 14:08:26``."""
    plain = F.regexp_replace(F.replace(F.trim(text), F.lit("T"), F.lit(" ")), r"Z\z", "")
    moment = F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm:ss"))
    return (F.unix_micros(moment) - F.unix_micros(now)) / F.lit(1_000_000.0)


def rate_limit_wait(headers: Column, now: Column) -> Column:
    """Seconds to wait after a 429 from the first header that says so; never negative."""
    told = [reading
            for name in ("retry-after", "x-ratelimit-reset")
            for reading in (first_number(header(headers, name)),
                            seconds_until(header(headers, name), now))]
    seconds = F.coalesce(*told)
    return F.when(seconds.isNotNull(), F.greatest(seconds, F.lit(0.0)))


def credits_remaining(headers: Column) -> Column:
    return first_number(header(headers, "x-totallimit-remaining")).cast("int")


# ------------------------------------------------------------------ VARIANT bodies


def kind_of(value: Column) -> Column:
    """Type name of a VARIANT value (``BOOLEAN``, ``OBJECT<...>``, ``VOID``, ...)."""
    return F.schema_of_variant(value)


def at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def shown(value: Column, path: str, dtype: str = "string") -> Column:
    """A field's value, or null where the provider hides it behind true or false."""
    found = at(value, path)
    return F.when(kind_of(found) != "BOOLEAN", F.try_variant_get(value, path, dtype))


def company_country(company: Column) -> Column:
    """``location_country`` when given, else the country inside ``location``."""
    given = F.try_variant_get(company, "$.location_country", "variant")
    return F.when(given.isNotNull(), shown(company, "$.location_country")).otherwise(
        shown(company, "$.location.country"))


def listed(value: Column, path: str) -> Column:
    """Elements of an array field; empty when null, hidden or absent."""
    return F.coalesce(F.try_variant_get(value, path, "array<variant>"),
                      F.array().cast("array<variant>"))


def _position(e: Column) -> Column:
    company, title = at(e, "$.company"), at(e, "$.title")
    levels = F.transform(listed(title, "$.levels"),
                         lambda v: F.when(kind_of(v) != "BOOLEAN",
                                          F.try_variant_get(v, "$", "string"))
                         .when(F.try_variant_get(v, "$", "boolean"), "True"))
    return F.struct(
        F.struct(*[shown(company, f"$.{n}").alias(n) for n in (
            "name", "id", "website", "industry", "size", "linkedin_url")],
            company_country(company).alias("location_country")).alias("company"),
        F.struct(*[shown(title, f"$.{n}").alias(n) for n in ("name", "role", "sub_role")],
                 title_levels(levels).alias("levels")).alias("title"),
        shown(e, "$.start_date").alias("start_date"), shown(e, "$.end_date").alias("end_date"),
        F.coalesce(F.try_variant_get(e, "$.is_primary", "boolean"), F.lit(False))
        .alias("is_primary"))


# Text fields of a provider's person record besides its id.
PROFILE_TEXTS = ("full_name", "first_name", "last_name", "linkedin_url", "location_name",
                 "location_country", "job_title", "job_title_role", "job_company_name",
                 "job_company_industry")


def profile_problem(data: Column) -> Column:
    """Why a person record (VARIANT) cannot be read as a profile, or null.

    The id must be text, other texts may be missing or hidden, years must be whole, and
    ``experience`` is a list of objects unless missing or hidden.
    """
    def kind(path: str) -> Column:
        found = kind_of(at(data, path))
        return F.when(~found.isin("VOID", "BOOLEAN"), found)

    def wrong(when: Column, text: str) -> Column:
        return F.when(when, text)

    key = kind_of(at(data, "$.id"))
    years = "$.inferred_years_experience"
    number = F.try_variant_get(data, years, "double")
    whole = F.when(kind(years) == "STRING", _whole(F.try_variant_get(data, years, "string"))
                   .isNotNull()).otherwise(F.coalesce(number == F.floor(number), F.lit(False)))
    return F.nullif(F.concat_ws(
        "; ", wrong(key.isNull(), "id: Field required"),
        wrong(key != "STRING", "id: Input should be a valid string"),
        *[wrong(kind(f"$.{n}") != "STRING", f"{n}: Input should be a valid string")
          for n in PROFILE_TEXTS],
        wrong(kind(years).isNotNull() & ~whole,
              "inferred_years_experience: Input should be a valid integer"),
        wrong(~kind("$.experience").startswith("ARRAY"),
              "experience: Input should be a valid list"),
        wrong(F.exists(listed(data, "$.experience"), lambda e: ~F.coalesce(
            kind_of(e).startswith("OBJECT"), F.lit(False))),
            "experience: Input should be an object")), F.lit(""))


def coerce_obscured(data: Column) -> Column:
    """A provider person record (VARIANT) as the typed profile struct.

    Hidden values become null, a missing or hidden ``experience`` becomes an empty list.
    """
    return F.struct(
        *[shown(data, f"$.{n}").alias(n) for n in ("id", *PROFILE_TEXTS)],
        shown(data, "$.inferred_years_experience", "int").alias("inferred_years_experience"),
        F.transform(listed(data, "$.experience"), _position).alias("experience"))


def response_error(body: Column) -> Column:
    """``error.message`` of a body, or the text of ``error`` when it is not an object."""
    error = at(body, "$.error")
    is_object = kind_of(error).startswith("OBJECT")
    text = F.when(is_object, F.try_variant_get(body, "$.error.message", "string")).otherwise(
        F.try_variant_get(body, "$.error", "string"))
    return F.when(~text.isin("", "false", "0"), text)
