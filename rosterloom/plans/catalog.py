"""Every operator as a registered query over the supplied tables.

``QUERIES`` maps a name to ``query(spark, folder) -> DataFrame``; ``ORACLES`` maps the names
that plain SQL can express to that SQL.  Lists appear as joined text and times as text, so
that both engines hash alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom import vocabulary as V
from rosterloom.config import CreditLimits, LadderConfig
from rosterloom.functions import guards as G
from rosterloom.functions import responses as R
from rosterloom.functions import text as X
from rosterloom.operators import breaker, credits, curate, erasure, matching, monitoring, validation
from rosterloom.plans import analytics, derived, pipeline, recorded
from rosterloom.plans import oracle as O
from rosterloom.plans.workspace import Workspace
from rosterloom.session import cut_lineage, scratch_path
from rosterloom.sources import identities, landing, retention, splits, store
from rosterloom.sources.snapshots import Publication
from rosterloom.streaming import jobs
from rosterloom.tables import conform_schema, stamp_version

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TIME = "yyyy-MM-dd HH:mm:ss"


def plain(df: DataFrame) -> DataFrame:
    """Flat columns: whole numbers as bigint, lists joined, times as text."""
    def flat(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, TIME)
        return column.alias(field.name)
    return df.select(*[flat(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None, recursive: str = "", **steps: str):
    """Registers a function of a workspace under ``name``, with its SQL when there is one."""
    def register(build: Callable[[Workspace], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain(build(Workspace(spark, folder)))
        if sql is not None:
            ORACLES[name] = O.compose(sql, recursive, **steps)
        return build
    return register


# ------------------------------------------------------------------ row expressions

_NORM_TEXT = O.norm("text")
_FOLD_TEXT = O.fold("text")


@query("normalize_text", f"""SELECT doc_id, length({_NORM_TEXT}) AS n, md5({_NORM_TEXT}) AS digest
       FROM documents""")
def _(w: Workspace) -> DataFrame:
    docs = w.table("documents").select("doc_id", X.normalize_text(F.col("text")).alias("t"))
    return docs.select("doc_id", F.char_length("t").alias("n"), F.md5("t").alias("digest"))


@query("normalize_email", """SELECT c_custkey, concat('user.', lower(c_name), '@example.com') AS email
       FROM customer""")
def _(w: Workspace) -> DataFrame:
    raw = F.concat(F.lit("  User."), "c_name", F.lit("@Example.COM "))
    return w.table("customer").select("c_custkey", X.normalize_email(raw).alias("email"))


@query("normalize_url", f"SELECT page_id, {O.url('url')} AS url FROM pages")
def _(w: Workspace) -> DataFrame:
    return w.table("pages").select("page_id", X.normalize_url(F.col("url")).alias("url"))


@query("lookup_key", "SELECT batch_id, row_number, lookup_key FROM planned")
def _(w: Workspace) -> DataFrame:
    return matching.plan_lookup(w.valid(), w.settings.ladder).select(
        "batch_id", "row_number", "lookup_key")


@query("strip_invisible", """SELECT conv_id, turn, md5(concat('a', replace(replace(replace(text,
       chr(10), ' '), chr(9), ' '), chr(13), ' '), ' b')) AS digest FROM conversations""")
def _(w: Workspace) -> DataFrame:
    dirty = F.concat(F.lit("﻿a​"), "text", F.lit("\t\x07b‍"))
    return w.table("conversations").select(
        "conv_id", "turn", F.md5(X.strip_invisible(dirty)).alias("digest"))


@query("fold_text", f"""SELECT doc_id, length({_FOLD_TEXT}) AS n, md5({_FOLD_TEXT}) AS digest
       FROM documents""")
def _(w: Workspace) -> DataFrame:
    docs = w.table("documents").select("doc_id", X.fold_text(F.col("text")).alias("t"))
    return docs.select("doc_id", F.char_length("t").alias("n"), F.md5("t").alias("digest"))


@query("placeholder_key", f"""SELECT conv_id, turn, md5({O.pkey('text')}) AS digest
       FROM conversations""")
def _(w: Workspace) -> DataFrame:
    keyed = w.table("conversations").select(
        "conv_id", "turn", X.placeholder_key(F.col("text")).alias("key"))
    return keyed.select("conv_id", "turn", F.md5("key").alias("digest"))


_NAME_SQL = O._name_problem


@query("name_problem", f"""SELECT batch_id, row_number,
       {_NAME_SQL('first_name', 'first_key')} AS first_problem,
       {_NAME_SQL('last_name', 'last_key')} AS last_problem FROM keyed""")
def _(w: Workspace) -> DataFrame:
    tidy = w.registrants().select("batch_id", "row_number", G.tidy(F.col("first_name")).alias("f"),
                                  G.tidy(F.col("last_name")).alias("l"))
    keyed = tidy.withColumn("fk", X.placeholder_key(F.col("f"))).withColumn(
        "lk", X.placeholder_key(F.col("l")))
    return keyed.select("batch_id", "row_number",
                        G.name_problem(F.col("f"), F.col("fk")).alias("first_problem"),
                        G.name_problem(F.col("l"), F.col("lk")).alias("last_problem"))


@query("email_guard", """SELECT batch_id, row_number, CASE WHEN email_ok THEN lower(email) END AS email,
       CASE WHEN email <> '' AND NOT email_ok THEN 'input.email_invalid' END AS note FROM keyed""")
def _(w: Workspace) -> DataFrame:
    rows = w.registrants().withColumn("email", G.blank_to_null(G.tidy(F.col("email"))))
    email, note = G.email_guard(F.col("email"))
    return rows.select("batch_id", "row_number", email.alias("email"), note.alias("note"))


@query("linkedin_guard", """SELECT batch_id, row_number, nullif(profile_url, '') AS linkedin_url,
       CASE WHEN linkedin_url <> '' AND profile_url = '' THEN 'input.linkedin_url_invalid' END
       AS note FROM keyed""")
def _(w: Workspace) -> DataFrame:
    given = G.tidy(F.col("linkedin_url"))
    rows = w.registrants().withColumn(
        "url", F.when(given != "", X.normalize_url(given)))
    url, note = G.linkedin_guard(F.col("url"))
    return rows.select("batch_id", "row_number", url.alias("linkedin_url"), note.alias("note"))


@query("org_guard", f"""SELECT batch_id, row_number,
       CASE WHEN company <> '' AND company_key NOT IN {O._list(V.ORG_PLACEHOLDERS)} THEN company END
       AS company, CASE WHEN company_key IN {O._list(V.ORG_PLACEHOLDERS)}
       THEN 'input.company_placeholder' END AS company_note,
       CASE WHEN location <> '' AND location_key NOT IN {O._list(V.ORG_PLACEHOLDERS)} THEN location
       END AS location, CASE WHEN location_key IN {O._list(V.ORG_PLACEHOLDERS)}
       THEN 'input.location_placeholder' END AS location_note FROM keyed""")
def _(w: Workspace) -> DataFrame:
    rows = w.registrants().select("batch_id", "row_number", *[
        G.blank_to_null(G.tidy(F.col(n))).alias(n) for n in ("company", "location")])
    keyed = rows.withColumn("ck", X.placeholder_key(F.col("company"))).withColumn(
        "lk", X.placeholder_key(F.col("location")))
    company, company_note = G.org_guard(F.col("company"), F.col("ck"), "company")
    place, place_note = G.org_guard(F.col("location"), F.col("lk"), "location")
    return keyed.select("batch_id", "row_number", company.alias("company"),
                        company_note.alias("company_note"), place.alias("location"),
                        place_note.alias("location_note"))


@query("consent_parse", f"""SELECT batch_id, row_number,
       CASE WHEN consent_key IN {O._list(V.CONSENT_YES)} THEN true
            WHEN consent_key IN {O._list(V.CONSENT_NO)} THEN false END AS consent,
       CASE WHEN consent <> '' AND consent_key NOT IN {O._list(V.CONSENT_YES + V.CONSENT_NO)}
            THEN 'input.consent_unrecognised' END AS note FROM keyed""")
def _(w: Workspace) -> DataFrame:
    rows = w.registrants().select("batch_id", "row_number", G.blank_to_null(
        G.tidy(F.col("consent"))).alias("consent"))
    keyed = rows.withColumn("key", X.placeholder_key(F.col("consent")))
    consent, note = G.consent_parse(F.col("consent"), F.col("key"))
    return keyed.select("batch_id", "row_number", consent.alias("consent"), note.alias("note"))


@query("notes", "SELECT batch_id, row_number, notes FROM cleaned")
def _(w: Workspace) -> DataFrame:
    return validation.clean_rows(w.registrants()).select("batch_id", "row_number", "notes")


@query("split_valid_invalid", """SELECT batch_id, row_number, reason IS NULL AS valid, first_name,
       last_name, CASE WHEN reason IS NULL THEN email END AS email, notes, reason FROM cleaned""")
def _(w: Workspace) -> DataFrame:
    valid, rejected = validation.split_valid_invalid(w.registrants())
    kept = ["batch_id", "row_number", "first_name", "last_name"]
    good = valid.select(*kept, "email", "notes", F.lit(True).alias("valid"),
                        F.lit(None).cast("string").alias("reason"))
    cleaned = validation.clean_rows(w.registrants()).select("batch_id", "row_number", "notes")
    bad = rejected.join(cleaned, ["batch_id", "row_number"]).select(
        "batch_id", "row_number", F.col("raw.first_name").alias("first_name"),
        F.col("raw.last_name").alias("last_name"), F.lit(None).cast("string").alias("email"),
        "notes", F.lit(False).alias("valid"), "reason")
    return good.unionByName(bad)


_FAMILIES = """SELECT batch_id, trim(regexp_replace(regexp_extract(reason, '^[^;]*'),
    '''[^'']*''\\s*$', '')) AS family, count(*) AS n, min(row_number) AS first_seen
    FROM rejected GROUP BY ALL"""
_TOP = """SELECT batch_id, string_agg(concat(family, ' x', n), '; ' ORDER BY nth) AS top_reasons
    FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, first_seen) AS nth
          FROM families) AS x WHERE nth <= 3 GROUP BY batch_id"""


@query("top_reasons", "SELECT batch_id, top_reasons FROM top", families=_FAMILIES, top=_TOP)
def _(w: Workspace) -> DataFrame:
    return validation.top_reasons(w.rejected(), ["batch_id"])


_DATE_RE = "^(19\\d\\d|20\\d\\d|2100)(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\\d|3[01]))?)?$"


@query("valid_date", f"""SELECT person_id, position_no, start_date,
       regexp_matches(start_date, '{_DATE_RE}') AS start_valid,
       regexp_matches(end_date, '{_DATE_RE}') AS end_valid FROM experience""")
def _(w: Workspace) -> DataFrame:
    return derived.experience_rows(w.spark, w.folder).select(
        "person_id", "position_no", "start_date", G.valid_date(F.col("start_date"))
        .alias("start_valid"), G.valid_date(F.col("end_date")).alias("end_valid"))


@query("employment_facts", """SELECT person_id, position_no,
       is_primary OR end_date IS NULL AS is_current,
       try_cast(left(start_date, 4) AS bigint) AS start_year FROM experience""")
def _(w: Workspace) -> DataFrame:
    held = derived.experience_rows(w.spark, w.folder).withColumn(
        "e", derived.position_struct())
    return held.select("person_id", "position_no", G.is_current(F.col("e")).alias("is_current"),
                       G.start_year(F.col("start_date")).alias("start_year"))


def bodies(w: Workspace) -> DataFrame:
    """Provider person records as JSON, some values hidden behind booleans."""
    e = F.col("e")
    position = F.struct(
        F.struct(e["company"]["name"].alias("name"), e["company"]["industry"].alias("industry"),
                 F.struct(e["company"]["location_country"].alias("country")).alias("location"))
        .alias("company"),
        F.struct(e["title"]["name"].alias("name"), e["title"]["role"].alias("role"),
                 F.array(F.col("level_a"), F.col("level_b"), F.lit(None)).alias("levels"))
        .alias("title"),
        "start_date", "end_date", "is_primary")
    held = (derived.experience_rows(w.spark, w.folder).withColumn("e", derived.position_struct())
            .groupBy("person_id").agg(F.array_sort(F.collect_list(F.struct(
                "position_no", position.alias("p")))).alias("h")))
    people = derived.profile_rows(w.spark, w.folder).join(held, "person_id", "left")
    body = F.to_json(F.struct(
        F.col("person_id").alias("id"), "full_name", "first_name", "last_name", "linkedin_url",
        F.lit(True).alias("location_name"), F.col("country").alias("location_country"),
        "job_title", F.lit(False).alias("job_title_role"),
        F.col("company_name").alias("job_company_name"),
        F.col("years_experience").alias("inferred_years_experience"),
        F.when(F.col("likelihood") < derived.HIDDEN_EMPLOYMENT, F.transform(
            "h", lambda s: s["p"])).alias("experience")),
        {"ignoreNullFields": "false"})
    return people.select("person_id", "likelihood", body.alias("body"))


_BODY_SQL = """SELECT p.person_id, p.full_name, cast(NULL AS varchar) AS location_name,
       country AS location_country, p.job_title, cast(NULL AS varchar) AS job_title_role,
       cast(years_experience AS bigint) AS years, coalesce(jobs, 0) AS jobs
       FROM profiles p LEFT JOIN doubts d ON p.person_id = d.person_id"""


@query("coerce_obscured", _BODY_SQL)
def _(w: Workspace) -> DataFrame:
    p = F.col("p")
    read = bodies(w).select("person_id", R.coerce_obscured(F.parse_json("body")).alias("p"))
    return read.select("person_id", p["full_name"].alias("full_name"),
                       p["location_name"].alias("location_name"),
                       p["location_country"].alias("location_country"),
                       p["job_title"].alias("job_title"),
                       p["job_title_role"].alias("job_title_role"),
                       p["inferred_years_experience"].alias("years"),
                       F.size(p["experience"]).alias("jobs"))


@query("title_levels", """SELECT person_id, position_no, CASE WHEN level_a = '' OR level_a = level_b
       THEN level_b ELSE concat(level_a, ',', level_b) END AS levels FROM experience""")
def _(w: Workspace) -> DataFrame:
    return derived.experience_rows(w.spark, w.folder).select(
        "person_id", "position_no", G.title_levels(F.array(
            "level_a", F.lit(None), "level_b", "level_a")).alias("levels"))


@query("company_country", """SELECT person_id, position_no, company_country FROM held""")
def _(w: Workspace) -> DataFrame:
    read = bodies(w).select("person_id", F.posexplode(F.coalesce(
        F.try_variant_get(F.parse_json("body"), "$.experience", "array<variant>"),
        F.array().cast("array<variant>"))).alias("position_no", "e"))
    company = F.try_variant_get("e", "$.company", "variant")
    return read.select("person_id", "position_no",
                       R.company_country(company).alias("company_country"))


@query("order_experience", """SELECT person_id, row_number() OVER (PARTITION BY person_id
       ORDER BY past, coalesce(start_date, '') DESC, position_no) - 1 AS sequence_no, company_name,
       start_date, end_date FROM held""")
def _(w: Workspace) -> DataFrame:
    ordered = w.people().select("person_id", F.posexplode(G.order_experience(
        F.col("profile.experience"))).alias("sequence_no", "e"))
    return ordered.select("person_id", "sequence_no", F.col("e.company.name").alias("company_name"),
                          F.col("e.start_date").alias("start_date"),
                          F.col("e.end_date").alias("end_date"))


def answered_calls(w: Workspace) -> DataFrame:
    """Provider calls with the headers a response would carry."""
    n = F.col("call_id") % 7
    spent = (F.when(n == 0, F.array(F.lit("X-Call-Credits-Spent"), F.lit("3")))
             .when(n == 1, F.array(F.lit("x-call-credits-spent"), F.lit("n/a"))))
    wait = (F.when(n == 2, F.array(F.lit("Retry-After"), F.lit("12.5")))
            .when(n == 3, F.array(F.lit("x-ratelimit-reset"), F.lit('{"minute": 60, "day": 7}')))
            .when(n == 4, F.array(F.lit("x-ratelimit-reset"), F.date_format(
                F.date_trunc("second", "requested_at") + F.expr("interval 90 seconds"), TIME)))
            .when(n == 5, F.array(F.lit("retry-after"), F.lit("-4"))))
    left = F.array(F.lit("X-TotalLimit-Remaining"), F.when(
        n == 6, "unlimited").otherwise((100000 - F.col("call_id")).cast("string")))
    kind = F.array(F.lit("X-Call-Credits-Type"), F.when(
        F.col("kind") == "identify", "person_identify").otherwise(""))
    pairs = F.transform(F.array_compact(F.array(spent, wait, left, kind)),
                        lambda a: F.struct(a[0].alias("key"), a[1].alias("value")))
    return (w.provider_calls().withColumn("requested_at", F.date_trunc("second", "requested_at"))
            .withColumn("headers", F.map_from_entries(pairs)))


@query("credits_spent", """SELECT call_id, cast(CASE WHEN call_id % 7 = 0 THEN 3
       WHEN http_status = 200 OR (kind = 'identify' AND http_status = 404) THEN 1 ELSE 0 END
       AS bigint) AS credits FROM calls""")
def _(w: Workspace) -> DataFrame:
    return answered_calls(w).select("call_id", R.credits_spent(
        F.col("kind"), F.col("http_status"), F.col("headers")).alias("credits"))


@query("rate_limit_wait", """SELECT call_id, CASE call_id % 7 WHEN 2 THEN 12.5 WHEN 3 THEN 7.0
       WHEN 4 THEN 90.0 WHEN 5 THEN 0.0 END::double AS wait FROM calls""")
def _(w: Workspace) -> DataFrame:
    wait = R.rate_limit_wait(F.col("headers"), F.col("requested_at"))
    return answered_calls(w).select("call_id", wait.alias("wait"))


@query("response_error", """SELECT call_id, CASE WHEN http_status = 500 THEN concat('failed ', call_id)
       WHEN http_status = 404 AND kind = 'enrich' THEN 'not here' END AS error FROM calls""")
def _(w: Workspace) -> DataFrame:
    text = F.concat(F.lit("failed "), F.col("call_id").cast("string"))
    body = (F.when(F.col("http_status") == 500, F.to_json(F.struct(
        F.struct(text.alias("message"), F.lit("server").alias("type")).alias("error"))))
        .when((F.col("http_status") == 404) & (F.col("kind") == "enrich"),
              F.lit('{"error": "not here"}'))
        .when(F.col("http_status") == 404, F.lit('{"error": {"message": ""}}'))
        .otherwise(F.lit('{"data": {}}')))
    return w.provider_calls().select("call_id", R.response_error(
        F.try_parse_json(body)).alias("error"))


@query("credits_remaining", """SELECT call_id, CASE WHEN call_id % 7 <> 6 THEN 100000 - call_id END
       AS remaining FROM calls""")
def _(w: Workspace) -> DataFrame:
    return answered_calls(w).select("call_id", R.credits_remaining(
        F.col("headers")).alias("remaining"))


@query("batch_id_for_object", """SELECT o_orderkey, concat(strftime(o_orderdate, '%Y%m%dT%H%M%S'), '-',
       left(sha256(concat('landing/incoming/', o_custkey, '.csv@v', o_orderkey)), 8)) AS batch_id
       FROM orders""")
def _(w: Workspace) -> DataFrame:
    key = F.concat(F.lit("incoming/"), F.col("o_custkey").cast("string"), F.lit(".csv"))
    version = F.concat(F.lit("v"), F.col("o_orderkey").cast("string"))
    return w.table("orders").select("o_orderkey", validation.batch_id_for_object(
        F.lit("landing"), key, version, F.col("o_orderdate").cast("timestamp")).alias("batch_id"))


# ------------------------------------------------------------------ file and batch decisions


@query("sniff_delimiter", """SELECT conv_id, turn, CASE WHEN greatest(a, b, c, d) = 0 THEN ','
       WHEN a = greatest(a, b, c, d) THEN ',' WHEN b = greatest(a, b, c, d) THEN ';'
       WHEN c = greatest(a, b, c, d) THEN chr(9) ELSE '|' END AS delimiter FROM (
       SELECT conv_id, turn, length(h) - length(replace(h, ',', '')) AS a,
       length(h) - length(replace(h, ';', '')) AS b, length(h) - length(replace(h, chr(9), '')) AS c,
       length(h) - length(replace(h, '|', '')) AS d FROM (
       SELECT conv_id, turn, concat(text, repeat('|', turn % 3), repeat(';', conv_id % 4)) AS h
       FROM conversations) AS x) AS y""")
def _(w: Workspace) -> DataFrame:
    header = F.concat("text", F.repeat(F.lit("|"), (F.col("turn") % 3).cast("int")),
                      F.repeat(F.lit(";"), (F.col("conv_id") % 4).cast("int")))
    return w.table("conversations").select(
        "conv_id", "turn", landing.sniff_delimiter(header).alias("delimiter"))


def header_files(w: Workspace) -> DataFrame:
    """One small file per customer, with varying headers."""
    k = F.col("c_custkey")

    def pick(options: list[str], step: int) -> Column:
        return F.element_at(F.array(*[F.lit(o) for o in options]),
                            (F.floor(k / step) % len(options) + 1).cast("int"))

    header = F.concat_ws(
        ",", pick(["First Name", "firstname", "Given-Name", "Vorname"], 1),
        pick(["Last Name", "SURNAME", "family name"], 4), pick(["E-mail", "mail", "Ticket"], 12),
        pick(["Company", "first name"], 36))
    text = F.concat(header, F.lit("\nAna,Lee,,Acme\n"))
    return w.table("customer").select(
        k.cast("string").alias("path"), text.alias("text"), F.lit(",").alias("delimiter"),
        F.array().cast("array<string>").alias("warnings"), F.lit(None).cast("string").alias("problem"))


@query("header_mapping", """SELECT cast(c_custkey AS varchar) AS path,
       CASE WHEN c_custkey % 4 = 3 AND c_custkey // 36 % 2 = 0 THEN NULL ELSE concat_ws(',',
         CASE WHEN c_custkey % 4 < 3 THEN 'first_name' END, 'last_name',
         CASE WHEN c_custkey // 12 % 3 < 2 THEN 'email' END,
         CASE WHEN c_custkey // 36 % 2 = 0 THEN 'company'
              WHEN c_custkey % 4 = 3 THEN 'first_name' END) END AS columns,
       CASE WHEN c_custkey % 4 = 3 AND c_custkey // 36 % 2 = 0 THEN NULL ELSE concat_ws(',',
         CASE WHEN c_custkey % 4 = 3 THEN 'Vorname' END,
         CASE WHEN c_custkey // 12 % 3 = 2 THEN 'Ticket' END) END AS ignored,
       CASE WHEN c_custkey % 4 < 3 AND c_custkey // 36 % 2 = 1 THEN 'first name'
            WHEN c_custkey % 4 = 3 AND c_custkey // 36 % 2 = 0 THEN NULL ELSE '' END AS doubled,
       CASE WHEN c_custkey % 4 = 3 AND c_custkey // 36 % 2 = 0 THEN concat(
         'missing required column(s) [''first_name'']; header was [''Vorname'', ''',
         CASE c_custkey // 4 % 3 WHEN 0 THEN 'Last Name' WHEN 1 THEN 'SURNAME'
              ELSE 'family name' END, ''', ''', CASE c_custkey // 12 % 3 WHEN 0 THEN 'E-mail'
              WHEN 1 THEN 'mail' ELSE 'Ticket' END, ''', ''Company'']') END AS problem
       FROM customer""")
def _(w: Workspace) -> DataFrame:
    mapped = landing.header_mapping(header_files(w))
    sound = F.col("problem").isNull()
    return mapped.select("path", *[F.when(sound, F.array_join(c, ",")).alias(n) for c, n in (
        ("columns", "columns"), ("ignored_columns", "ignored"), ("duplicate_columns", "doubled"))],
        "problem")


_VERDICT_STEPS = {"families": _FAMILIES, "top": _TOP, "sized": """SELECT batch_id, count(*) AS total,
    count(*) FILTER (reason IS NOT NULL) AS invalid,
    count(*) FILTER (reason IS NOT NULL AND NOT starts_with(reason, 'consent:')) AS layout_invalid,
    count(*) FILTER (reason IS NULL AND notes <> '') AS rows_with_notes
    FROM stricter GROUP BY batch_id"""}
# A third of the batches ask for names of at most four letters, so that whole files fail.
_STRICT = """SELECT * REPLACE (CASE WHEN reason IS NULL AND length(last_name) > 4
    AND cast(right(batch_id, 2) AS int) % 3 = 0 THEN 'last_name: longer than 4 characters'
    ELSE reason END AS reason) FROM cleaned"""
_STRICT_FAMILIES = _FAMILIES.replace("FROM rejected", "FROM stricter WHERE reason IS NOT NULL")
_STRICT_LAYOUT = _STRICT_FAMILIES.replace(
    "reason IS NOT NULL", "reason IS NOT NULL AND NOT starts_with(reason, 'consent:')")
_PROBLEM = """CASE WHEN invalid = total THEN concat('no valid rows: all ', total,
    ' data rows were rejected (', t.top_reasons, ')')
    WHEN total >= 5 AND layout_invalid / total > 0.5 THEN concat(layout_invalid, ' of ', total,
    ' rows rejected (', cast(round_even(100 * layout_invalid / total, 0) AS int),
    '%), above the 50% limit; the columns probably do not hold what the header says (',
    u.top_reasons, ')') END"""
_STRICT_STEPS = {"stricter": _STRICT, "families": _STRICT_FAMILIES, "top": _TOP,
                 "layout": _STRICT_LAYOUT, "toplayout": _TOP.replace("families", "layout"),
                 "sized": _VERDICT_STEPS["sized"]}


def stricter(w: Workspace) -> DataFrame:
    short = (F.col("reason").isNull() & (F.char_length("last_name") > 4)
             & (F.right("batch_id", F.lit(2)).cast("int") % 3 == 0))
    return w.cleaned().withColumn("reason", F.when(
        short, "last_name: longer than 4 characters").otherwise(F.col("reason")))


@query("file_verdict", f"""SELECT s.batch_id, total, invalid, layout_invalid, {_PROBLEM} AS problem
       FROM sized s LEFT JOIN top t ON s.batch_id = t.batch_id
       LEFT JOIN toplayout u ON s.batch_id = u.batch_id""", **_STRICT_STEPS)
def _(w: Workspace) -> DataFrame:
    files = w.registrants().select("batch_id").distinct()
    return validation.file_verdict(files, stricter(w), "batch_id")


@query("contract_dry_run", f"""SELECT s.batch_id, ({_PROBLEM}) IS NULL AS accepted,
       {_PROBLEM} AS reason, total - invalid AS rows_valid, invalid AS rows_invalid, rows_with_notes
       FROM sized s LEFT JOIN top t ON s.batch_id = t.batch_id
       LEFT JOIN toplayout u ON s.batch_id = u.batch_id""", **_STRICT_STEPS)
def _(w: Workspace) -> DataFrame:
    files = w.registrants().select("batch_id").distinct()
    return validation.contract_dry_run(files, stricter(w), "batch_id")


@query("dry_run_findings", """SELECT batch_id, row_number,
       CASE WHEN reason IS NOT NULL THEN 'rejected' ELSE 'note' END AS finding,
       coalesce(reason, replace(notes, ',', ', ')) AS detail FROM cleaned
       WHERE reason IS NOT NULL OR notes <> ''""")
def _(w: Workspace) -> DataFrame:
    return validation.dry_run_findings(w.cleaned(), "batch_id")


def triggers(w: Workspace) -> DataFrame:
    """Uploads announced more than once: every order is a delivery of its customer's file."""
    return w.table("orders").select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("batch_id"),
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("execution_id"),
        F.col("o_orderdate").cast("timestamp").alias("triggered_at"))


_TRIGGERS = """SELECT concat('u', o_custkey) AS batch_id, concat('run-', o_orderkey) AS execution_id,
    o_orderdate AS triggered_at FROM orders"""


@query("batch_claim", """SELECT batch_id, execution_id, strftime(triggered_at, '%Y-%m-%d %H:%M:%S')
       AS triggered_at, execution_id <> owner AS duplicate,
       CASE WHEN execution_id <> owner THEN owner ELSE '' END AS owner_execution FROM (
       SELECT t.*, coalesce(h.execution_id, first_value(t.execution_id) OVER (
         PARTITION BY t.batch_id ORDER BY t.triggered_at, t.execution_id)) AS owner
       FROM deliveries t LEFT JOIN held_claims h ON t.batch_id = h.batch_id) AS x""",
       deliveries=_TRIGGERS, held_claims="""SELECT concat('u', c_custkey) AS batch_id, 'earlier' AS
       execution_id FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def _(w: Workspace) -> DataFrame:
    claims = (w.table("customer").filter(F.col("c_mktsegment") == "MACHINERY")
              .select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("batch_id"),
                      F.lit("earlier").alias("execution_id")))
    return validation.batch_claim(triggers(w), claims)


# ------------------------------------------------------------------ matching


@query("plan_lookup", """SELECT batch_id, row_number, lookup_method, call_kind, lookup_key,
       concat_ws(';', CASE WHEN lookup_method = 'name_context' AND company IS NOT NULL
       THEN concat('company=', company) END,
       CASE WHEN lookup_method = 'email' THEN concat('email=', email) END,
       CASE WHEN lookup_method LIKE 'name%' THEN concat('first_name=', first_name) END,
       CASE WHEN lookup_method LIKE 'name%' THEN concat('last_name=', last_name) END,
       CASE WHEN lookup_method = 'name_context' AND location IS NOT NULL
       THEN concat('location=', location) END,
       CASE WHEN call_kind = 'enrich' THEN 'min_likelihood=4' END,
       CASE WHEN lookup_method = 'linkedin' THEN concat('profile=', linkedin_url) END) AS params
       FROM planned""")
def _(w: Workspace) -> DataFrame:
    sent = F.array_sort(F.transform(F.map_entries("params"), lambda e: F.concat(
        e["key"], F.lit("="), e["value"])))
    return matching.plan_lookup(w.valid()).select(
        "batch_id", "row_number", "lookup_method", "call_kind", "lookup_key",
        F.array_join(sent, ";").alias("params"))


CACHE = ("lookup_key string, status string, person_id string, likelihood double, batch_id string, "
         "updated_at timestamp, expires_at timestamp")


def cache(w: Workspace) -> DataFrame:
    """Answers kept from all batches, seen at the end of March."""
    fresh = w.results().withColumn("person_id", F.col("profile.id"))
    return matching.cache_upsert(fresh, w.spark.createDataFrame([], CACHE), F.lit("2024-03-31").cast("timestamp"))


_CACHE = """SELECT * FROM (SELECT lookup_key, status, person_id, likelihood, batch_id,
    requested_at AS updated_at, row_number() OVER (PARTITION BY lookup_key
      ORDER BY requested_at DESC, batch_id DESC) AS nth FROM results
    WHERE status IN ('matched', 'not_found', 'ambiguous')
      AND cast(requested_at AS timestamp) + INTERVAL 90 DAY > TIMESTAMP '2024-03-31') AS x
    WHERE nth = 1"""


@query("cache_upsert", "SELECT lookup_key, status, person_id, likelihood, batch_id, updated_at FROM kept",
       kept=_CACHE)
def _(w: Workspace) -> DataFrame:
    return cache(w).drop("expires_at")


@query("cache_lookup", """SELECT p.batch_id, p.row_number, k.lookup_key IS NOT NULL AS hit,
       k.person_id FROM planned p LEFT JOIN kept k ON p.lookup_key = k.lookup_key""", kept=_CACHE)
def _(w: Workspace) -> DataFrame:
    found = matching.cache_lookup(w.planned(), cache(w), F.lit("2024-03-31").cast("timestamp"))
    return found.select("batch_id", "row_number", "hit", F.col("stored.person_id").alias("person_id"))


@query("in_batch_cache", """SELECT batch_id, row_number, lookup_key, row_number() OVER (
       PARTITION BY batch_id, lookup_key ORDER BY row_number) > 1
       AND status IN ('matched', 'not_found', 'ambiguous') AS repeat FROM flagged""")
def _(w: Workspace) -> DataFrame:
    return matching.in_batch_cache(w.outcomes()).select(
        "batch_id", "row_number", "lookup_key", "repeat")


@query("match_strong", """SELECT batch_id, row_number, lookup_method, person_id, likelihood,
       cast(http_status AS bigint) AS http_status FROM answers WHERE call_kind = 'enrich'""")
def _(w: Workspace) -> DataFrame:
    return matching.match_strong(w.planned(), w.people()).select(
        "batch_id", "row_number", "lookup_method", "person_id", "likelihood", "http_status")


@query("match_identify", """SELECT batch_id, row_number, gate, person_id, likelihood, candidates,
       cast(http_status AS bigint) AS http_status FROM answers WHERE call_kind = 'identify'""")
def _(w: Workspace) -> DataFrame:
    return matching.match_identify(w.planned(), w.candidates()).select(
        "batch_id", "row_number", "gate", "person_id", "likelihood", "candidates", "http_status")


_ATTEMPTS = """SELECT user_id AS call_no, attempt, http_status,
    CASE WHEN attempt % 2 = 1 THEN 5.0 END AS wait FROM (
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt,
    CASE event_type WHEN 'error' THEN 500 WHEN 'view' THEN 429 WHEN 'signup' THEN 503
         WHEN 'click' THEN 404 ELSE 200 END AS http_status FROM events) AS x"""


@query("resolve_attempts", """SELECT call_no, chosen AS attempts, cast(http_status AS bigint) AS
       http_status, coalesce((SELECT sum(CASE WHEN b.http_status = 429 THEN coalesce(b.wait,
       2.0 ** b.attempt) ELSE 2.0 ** b.attempt END) FROM tries b WHERE b.call_no = c.call_no
       AND b.attempt < c.chosen), 0)::double AS waited FROM (SELECT call_no, http_status, attempt AS
       chosen, row_number() OVER (PARTITION BY call_no ORDER BY CASE WHEN http_status = 429
       OR http_status >= 500 THEN CASE WHEN attempt = 4 THEN 4 ELSE 100 - attempt END
       ELSE attempt END) AS nth FROM tries WHERE attempt <= 4) AS c WHERE nth = 1""", tries=_ATTEMPTS)
def _(w: Workspace) -> DataFrame:
    # Attempts of one call: all of a user's events in order; the operator stops at its own limit.
    from pyspark.sql import Window
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    status = (F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "view", 429)
              .when(F.col("event_type") == "signup", 503)
              .when(F.col("event_type") == "click", 404).otherwise(200))
    tries = (w.table("events").withColumn("attempt", F.row_number().over(order))
             .select(F.col("user_id").alias("call_no"), "attempt", status.alias("http_status"),
                     F.when(F.col("attempt") % 2 == 1, 5.0).alias("wait")))
    return matching.resolve_attempts(tries, keys=("call_no",)).select(
        "call_no", "attempts", "http_status", F.col("waited_seconds").alias("waited"))


@query("interpret_status", """SELECT batch_id, row_number, status, error_message FROM flagged""")
def _(w: Workspace) -> DataFrame:
    return w.outcomes().select("batch_id", "row_number", "status", "error_message")


@query("match_flags", """SELECT batch_id, row_number, match_flags FROM flagged""")
def _(w: Workspace) -> DataFrame:
    return matching.match_flags(w.outcomes().drop("match_flags")).select(
        "batch_id", "row_number", "match_flags")


# ------------------------------------------------------------------ credits and breaker

LIMITS = CreditLimits(enrich=900, identify=500, per_batch=40)


def batched_calls(w: Workspace) -> DataFrame:
    """Provider calls grouped into one batch per provider and day."""
    return w.provider_calls().select(
        "call_id", "provider", "requested_at", credits.month_of("requested_at").alias("month"),
        F.concat("provider", F.lit("-"), F.date_format("requested_at", "yyyyMMdd")).alias("batch_id"),
        F.col("call_id").alias("row_number"), "kind", "http_status",
        F.col("credits").cast("long").alias("credits"))


def opening(w: Workspace) -> DataFrame:
    """Balances brought forward: last month's calls of the busiest hours."""
    return (batched_calls(w).groupBy("provider", "month", "kind")
            .agg(F.countDistinct(F.hour("requested_at")).alias("spent")))


_BATCHED = """SELECT call_id, provider, requested_at, strftime(requested_at, '%Y-%m') AS month,
    concat(provider, '-', strftime(requested_at, '%Y%m%d')) AS batch_id, call_id AS row_number, kind,
    http_status, credits, row_number() OVER (PARTITION BY provider, strftime(requested_at, '%Y-%m')
      ORDER BY strftime(requested_at, '%Y%m%d'), call_id) AS seq FROM calls"""
_OPENING = """SELECT provider, month,
    count(DISTINCT hour(requested_at)) FILTER (kind = 'enrich') AS open_enrich,
    count(DISTINCT hour(requested_at)) FILTER (kind = 'identify') AS open_identify
    FROM batched GROUP BY provider, month"""
_ADMIT = """walk AS (
  SELECT o.provider, o.month, 0::bigint AS seq, open_enrich AS se, open_identify AS si, 0::bigint AS sb,
         '' AS batch_id, 0::bigint AS call_id, true AS admitted, cast(NULL AS varchar) AS reason
  FROM opening o
  UNION ALL
  SELECT n.provider, n.month, n.seq,
    CASE WHEN n.reason IS NULL AND n.kind = 'enrich' THEN n.se + n.credits ELSE n.se END,
    CASE WHEN n.reason IS NULL AND n.kind = 'identify' THEN n.si + n.credits ELSE n.si END,
    CASE WHEN n.reason IS NULL THEN n.sb + n.credits ELSE n.sb END,
    n.batch_id, n.call_id, n.reason IS NULL, n.reason FROM (
    SELECT m.*, CASE WHEN kind = 'enrich' AND se >= 900
        THEN 'enrich credit budget: monthly ceiling (900) reached'
      WHEN kind = 'identify' AND si >= 500
        THEN 'identify credit budget: monthly ceiling (500) reached'
      WHEN sb >= 40 THEN 'credit budget: batch cap (40) reached' END AS reason FROM (
      SELECT b.provider, b.month, b.seq, b.batch_id, b.call_id, b.kind, b.credits, w.se, w.si,
             CASE WHEN b.batch_id = w.batch_id THEN w.sb ELSE 0 END AS sb
      FROM walk w JOIN batched b ON b.provider = w.provider AND b.month = w.month
        AND b.seq = w.seq + 1) AS m) AS n)"""


@query("budget_admission", "SELECT call_id, admitted, reason FROM walk WHERE seq > 0",
       recursive=_ADMIT, batched=_BATCHED, opening=_OPENING)
def _(w: Workspace) -> DataFrame:
    return credits.budget_admission(batched_calls(w), opening(w), LIMITS).select(
        "call_id", "admitted", "reason")


def exhausting(w: Workspace) -> DataFrame:
    """Calls of which some met a 402."""
    return batched_calls(w).withColumn("http_status", F.when(
        (F.col("http_status") == 200) & (F.dayofmonth("requested_at") >= 20), 402)
        .otherwise(F.col("http_status")))


@query("pool_exhausted", """SELECT call_id, coalesce(max(CASE WHEN http_status = 200 AND
       day(requested_at) >= 20 THEN 1 ELSE 0 END) OVER (PARTITION BY provider, month, kind
       ORDER BY requested_at, call_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1
       AS exhausted FROM batched""", batched=_BATCHED)
def _(w: Workspace) -> DataFrame:
    return credits.pool_exhausted(exhausting(w)).select("call_id", "exhausted")


_BREAK = """folded AS (
  SELECT provider, 0::bigint AS seq, 0::bigint AS call_id, 0 AS failures, cast(NULL AS timestamp) AS
         until, false AS skipped, cast(NULL AS timestamp) AS shown
  FROM ordered GROUP BY provider
  UNION ALL
  SELECT o.provider, o.seq, o.call_id,
    CASE WHEN f.until > o.requested_at THEN f.failures WHEN NOT o.failed THEN 0
         WHEN f.failures + 1 >= 3 THEN 0 ELSE f.failures + 1 END,
    CASE WHEN f.until > o.requested_at THEN f.until WHEN NOT o.failed THEN NULL
         WHEN f.failures + 1 >= 3 THEN o.requested_at + INTERVAL 1800 SECOND ELSE f.until END,
    coalesce(f.until > o.requested_at, false),
    CASE WHEN f.until > o.requested_at THEN f.until END
  FROM folded f JOIN ordered o ON o.provider = f.provider AND o.seq = f.seq + 1)"""
_ORDERED = """SELECT provider, call_id, requested_at, http_status >= 500 OR http_status = 404 AS failed,
    row_number() OVER (PARTITION BY provider ORDER BY requested_at, call_id) AS seq FROM calls"""
_BREAK_SQL = """SELECT call_id, skipped, strftime(shown, '%Y-%m-%d %H:%M:%S') AS open_until
    FROM folded WHERE seq > 0"""
COOLDOWN = 1800


def failing(w: Workspace) -> DataFrame:
    return w.provider_calls().withColumn(
        "failed", (F.col("http_status") >= 500) | (F.col("http_status") == 404))


@query("circuit_breaker", _BREAK_SQL, recursive=_BREAK, ordered=_ORDERED)
def _(w: Workspace) -> DataFrame:
    return breaker.circuit_breaker(failing(w), 3, COOLDOWN, 6 * 3600).select(
        "call_id", "skipped", "open_until")


@query("credit_ledger", """SELECT provider, month, batch_id, kind, cast(sum(credits) AS bigint) AS
       credits FROM batched WHERE credits > 0 GROUP BY ALL""", batched=_BATCHED)
def _(w: Workspace) -> DataFrame:
    return credits.credit_ledger(batched_calls(w))


@query("credit_gauges", """SELECT call_id, cast(sum(credits) OVER (PARTITION BY provider, month, kind
       ORDER BY requested_at, call_id ROWS UNBOUNDED PRECEDING) AS bigint) AS month_to_date
       FROM batched""", batched=_BATCHED)
def _(w: Workspace) -> DataFrame:
    return credits.credit_gauges(batched_calls(w)).select("call_id", "month_to_date")


_GAUGED = """SELECT provider, kind, requested_at, cast(sum(credits) OVER (PARTITION BY provider, month,
    kind ORDER BY requested_at, call_id ROWS UNBOUNDED PRECEDING) AS bigint) AS g FROM batched"""


@query("credit_alarm", """SELECT provider, kind, strftime(period, '%Y-%m-%d %H:%M:%S') AS period_start,
       gauge, threshold, gauge >= threshold AS alarm,
       period = max(period) OVER (PARTITION BY provider, kind) AS latest FROM (
       SELECT provider, kind, time_bucket(INTERVAL 5 MINUTE, requested_at) AS period, max(g) AS gauge,
       CASE kind WHEN 'enrich' THEN 810 ELSE 450 END::bigint AS threshold
       FROM gauged GROUP BY ALL) AS x""", batched=_BATCHED, gauged=_GAUGED)
def _(w: Workspace) -> DataFrame:
    return credits.credit_alarm(credits.credit_gauges(batched_calls(w)), LIMITS)


# ------------------------------------------------------------------ curated build


def lossy(w: Workspace) -> tuple[DataFrame, DataFrame]:
    """Results of which some were lost, and the causes known for part of them."""
    lost = F.substring("lookup_key", 2, 1) == "0"
    gone = w.results().filter(lost)
    causes = gone.filter(F.substring("lookup_key", 3, 1) < "8").select(
        "batch_id", "row_number", F.lit("Lambda.Timeout").alias("error"),
        F.concat(F.lit("row "), F.col("row_number").cast("string")).alias("cause"))
    return w.results().filter(~lost), causes


@query("unrecorded_rows", """SELECT batch_id, row_number, 'error' AS status, lookup_method, lookup_key,
       CASE WHEN substr(lookup_key, 3, 1) < '8' THEN concat('Lambda.Timeout: row ', row_number)
       ELSE 'no result recorded: the enrich invocation failed after retries' END AS error_message
       FROM planned WHERE substr(lookup_key, 2, 1) = '0'""")
def _(w: Workspace) -> DataFrame:
    kept, causes = lossy(w)
    return curate.unrecorded_rows(w.valid(), kept, causes, w.built_at(), "recorded").select(
        "batch_id", "row_number", "status", "lookup_method", "lookup_key", "error_message")


_PERSON_COLUMNS = """person_id, provider, batch_id, batch_date, cast(input_row_number AS bigint) AS
    input_row_number, input_first_name, input_last_name, input_email, full_name, first_name, last_name,
    linkedin_url, location_country, current_job_title, current_company_name,
    cast(inferred_years_experience AS bigint) AS inferred_years_experience, match_likelihood,
    lookup_method, quality_flags, enriched_at"""
_ABSENT = ["location_name", "current_job_title_role", "current_company_industry", "pipeline_version"]


@query("dim_person", f"SELECT {_PERSON_COLUMNS} FROM dim_person")
def _(w: Workspace) -> DataFrame:
    return curate.dim_person(curate.first_per_person(w.results())).drop(*_ABSENT)


@query("fact_employment", """SELECT person_id, batch_id, batch_date, sequence_no, company_name,
       company_industry, company_location_country, title_name, title_role, title_levels, start_date,
       end_date, cast(start_year AS bigint) AS start_year, is_current FROM fact_employment""")
def _(w: Workspace) -> DataFrame:
    return curate.fact_employment(curate.first_per_person(w.results())).drop(
        "company_id", "company_website", "company_linkedin_url", "company_size", "title_sub_role",
        "pipeline_version")


@query("fact_lookup", """SELECT batch_id, batch_date, cast(row_number AS bigint) AS row_number,
       input_first_name, input_last_name, input_email, input_company, lookup_key, status,
       lookup_method, person_id, likelihood, cast(candidates AS bigint) AS candidates,
       cast(http_status AS bigint) AS http_status, error_message,
       cast(credits_consumed AS bigint) AS credits_consumed, cast(attempts AS bigint) AS attempts,
       raw_ref, quality_flags, requested_at FROM fact_lookup""")
def _(w: Workspace) -> DataFrame:
    return curate.fact_lookup(w.results(), w.rejected(), w.built_at(), "recorded").drop(
        "provider", "pipeline_version")


@query("quality_flags", """SELECT batch_id, row_number, concat_ws(',', nullif(notes, ''),
       nullif(match_flags, '')) AS quality_flags FROM results""")
def _(w: Workspace) -> DataFrame:
    return w.results().select("batch_id", "row_number", curate.quality_flags(
        F.col("notes"), F.col("match_flags")).alias("quality_flags"))


@query("status_counts", """SELECT batch_id, matched, cached, not_found, ambiguous, budget_deferred,
       provider_unavailable, error, rows_invalid AS invalid_input FROM counted""")
def _(w: Workspace) -> DataFrame:
    return curate.status_counts(w.curated("fact_lookup"))


_FLAG_MAP = """SELECT batch_id, string_agg(concat(flag, '=', n), ',' ORDER BY flag) AS flag_counts
    FROM (SELECT batch_id, flag, count(*) AS n FROM flags GROUP BY ALL) AS x GROUP BY batch_id"""


@query("batch_quality", """SELECT w.batch_id, rows_valid, rows_invalid, matched + cached AS rows_matched,
       flagged_matches, round(match_rate, 9) AS match_rate, coalesce(flag_counts, '') AS flag_counts
       FROM warned w LEFT JOIN flag_map m ON w.batch_id = m.batch_id""", flag_map=_FLAG_MAP)
def _(w: Workspace) -> DataFrame:
    counts = F.transform(F.map_entries("flag_counts"), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string")))
    return curate.batch_quality(w.curated("fact_lookup")).select(
        "batch_id", "rows_valid", "rows_invalid", "rows_matched", "flagged_matches",
        F.round("match_rate", 9).alias("match_rate"),
        F.array_join(F.array_sort(counts), ",").alias("flag_counts"))


@query("batch_warnings", "SELECT batch_id, warnings FROM warned")
def _(w: Workspace) -> DataFrame:
    return curate.batch_warnings(curate.batch_quality(w.curated("fact_lookup"))).select(
        "batch_id", F.array_join("warnings", "; ").alias("warnings"))


_QUALITY = """SELECT batch_id, batch_date, 'recorded' AS provider, rows_valid, rows_invalid,
    cast(rows_unrecorded AS bigint) AS rows_unrecorded, matched, cached, not_found, ambiguous,
    budget_deferred, provider_unavailable, error, round(match_rate, 9) AS match_rate, flagged_matches,
    cast(warning_count AS bigint) AS warning_count, warnings, credits_spent, persons, employment_rows,
    '2030-01-01 00:00:00' AS built_at FROM fact_batch_quality"""


def shown_quality(df: DataFrame) -> DataFrame:
    return (df.withColumn("match_rate", F.round("match_rate", 9)).drop("pipeline_version")
            .withColumn("warnings", F.array_join("warnings", "; ")))


@query("fact_batch_quality", _QUALITY)
def _(w: Workspace) -> DataFrame:
    lookup = w.curated("fact_lookup")
    warned = curate.batch_warnings(curate.batch_quality(lookup))
    return shown_quality(curate.fact_batch_quality(
        lookup, w.curated("dim_person"), w.curated("fact_employment"), w.built_at(), "recorded",
        warned))


_EXPECTED = "SELECT batch_id, count(*) AS rows FROM registrants GROUP BY batch_id"


def damaged(w: Workspace) -> dict[str, DataFrame]:
    """The curated tables with people missing, so that checks have something to find."""
    persons = w.curated("dim_person")
    return {"fact_lookup": w.curated("fact_lookup").filter(F.col("status") != "error"),
            "dim_person": persons.filter(F.col("match_likelihood") != 9.0),
            "fact_employment": w.curated("fact_employment")}


@query("check_tables", """SELECT e.batch_id, 'row_count' AS rule, concat('fact_lookup has ', n,
       ' rows for ', e.rows, ' input rows') AS detail FROM expected e JOIN (SELECT batch_id, count(*) AS n
       FROM fact_lookup WHERE status <> 'error' GROUP BY batch_id) AS l ON e.batch_id = l.batch_id
       WHERE n <> e.rows
       UNION ALL SELECT batch_id, 'orphan_employment', concat('fact_employment references ', count(
       DISTINCT person_id), ' person_id(s) missing from dim_person') FROM fact_employment f
       WHERE NOT EXISTS (SELECT 1 FROM dim_person d WHERE d.batch_id = f.batch_id
       AND d.person_id = f.person_id AND match_likelihood <> 9.0) GROUP BY batch_id""",
       expected=_EXPECTED)
def _(w: Workspace) -> DataFrame:
    expected = w.registrants().groupBy("batch_id").agg(F.count("*").alias("rows"))
    return curate.check_tables(damaged(w), expected)


@query("conform_schema", """SELECT batch_id, cast(row_number AS bigint) AS row_number, status,
       cast(credits_consumed AS bigint) AS credits_consumed, cast(NULL AS varchar) AS raw_ref FROM results""")
def _(w: Workspace) -> DataFrame:
    partial = w.results().select(
        "status", F.col("credits_consumed").cast("long").alias("credits_consumed"), "row_number",
        "batch_id")
    return conform_schema(partial, "fact_lookup").select(
        "batch_id", "row_number", "status", "credits_consumed", "raw_ref")


@query("stamp_version", """SELECT call_id, '9.9' AS pipeline_version,
       strftime(requested_at, '%Y-%m-%d %H:%M:%S') AS built_at,
       cast(extract(millisecond FROM requested_at) AS bigint) % 1000 AS ms FROM calls""")
def _(w: Workspace) -> DataFrame:
    stamped = stamp_version(w.provider_calls().select("call_id", "requested_at"), "9.9",
                            built_at=F.col("requested_at"))
    return stamped.select("call_id", "pipeline_version", "built_at",
                          (F.unix_millis("built_at") % 1000).alias("ms"))


@query("rebuild", _QUALITY)
def _(w: Workspace) -> DataFrame:
    # All batches, then those of a prefix once more: the others stay.
    path = scratch_path(w.spark, "rebuilt")
    for prefix in ("", "b000000-1"):
        pipeline.rebuild(w.results(), w.rejected(), path, w.built_at(), "recorded", prefix)
    return shown_quality(store.read_curated(w.spark, path, "fact_batch_quality"))


# ------------------------------------------------------------------ analyst questions


@query("who", """SELECT batch_date, full_name, current_job_title, current_company_name,
       location_country, linkedin_url, match_likelihood, lookup_method, quality_flags, enriched_at
       FROM dim_person""")
def _(w: Workspace) -> DataFrame:
    return analytics.who(w.curated("dim_person"))


_HELD_BY = """FROM fact_employment e JOIN dim_person p ON p.person_id = e.person_id
    AND p.batch_id = e.batch_id AND p.batch_date = e.batch_date"""


@query("companies", f"""SELECT p.batch_date, p.full_name, e.company_name, e.company_industry,
       e.start_date, e.end_date, e.is_current {_HELD_BY}""")
def _(w: Workspace) -> DataFrame:
    return analytics.companies(w.curated("dim_person"), w.curated("fact_employment"))


@query("roles", f"""SELECT p.batch_date, p.full_name, e.title_name, e.title_role, e.title_levels,
       e.company_name, e.start_date, e.end_date {_HELD_BY}""")
def _(w: Workspace) -> DataFrame:
    return analytics.roles(w.curated("dim_person"), w.curated("fact_employment"))


@query("outcomes", """SELECT batch_date, batch_id, status, lookup_method, count(*) AS rows,
       cast(sum(credits_consumed) AS bigint) AS credits, round(avg(likelihood), 1) AS avg_likelihood
       FROM fact_lookup GROUP BY ALL""")
def _(w: Workspace) -> DataFrame:
    return analytics.outcomes(w.curated("fact_lookup"))


_LATEST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id
    ORDER BY enriched_at DESC, batch_id DESC) AS recency FROM dim_person) AS x WHERE recency = 1"""


@query("latest_snapshot", """SELECT full_name, current_job_title, current_company_name,
       location_country, linkedin_url, match_likelihood, quality_flags, batch_date, batch_id
       FROM latest""", latest=_LATEST)
def _(w: Workspace) -> DataFrame:
    return analytics.latest_snapshot(w.curated("dim_person"))


@query("quality_trend", """SELECT batch_date, batch_id, rows_valid, rows_invalid, matched, cached,
       not_found, ambiguous, budget_deferred, provider_unavailable, error,
       round(match_rate, 2) AS match_rate, flagged_matches, cast(warning_count AS bigint) AS
       warning_count, warnings, credits_spent, persons FROM fact_batch_quality""")
def _(w: Workspace) -> DataFrame:
    return (analytics.quality_trend(w.curated("fact_batch_quality")).drop("pipeline_version")
            .withColumn("warnings", F.array_join("warnings", "; ")))


@query("top_companies", """SELECT company_name, count(DISTINCT person_id) AS people
       FROM fact_employment GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def _(w: Workspace) -> DataFrame:
    return analytics.top_companies(w.curated("fact_employment"))


@query("person_current", """SELECT person_id, full_name, current_job_title, current_company_name,
       location_country, linkedin_url, match_likelihood, lookup_method, quality_flags, enriched_at,
       batch_date, batch_id FROM latest""", latest=_LATEST)
def _(w: Workspace) -> DataFrame:
    analytics.create_person_current(w.curated("dim_person"))
    return w.spark.sql("SELECT * FROM person_current").drop("current_company_industry")


@query("row_outcomes", """SELECT batch_id, cast(row_number AS bigint) AS row_number, input_first_name,
       input_last_name, status, lookup_method, likelihood, cast(candidates AS bigint) AS candidates,
       cast(http_status AS bigint) AS http_status, cast(credits_consumed AS bigint) AS
       credits_consumed, cast(attempts AS bigint) AS attempts FROM fact_lookup""")
def _(w: Workspace) -> DataFrame:
    return analytics.row_outcomes(w.curated("fact_lookup"))


@query("batch_report", """SELECT batch_id, cast(row_number AS bigint) AS row_number,
       left(concat(trim(concat(coalesce(input_first_name, ''), ' ', coalesce(input_last_name, ''))),
       CASE WHEN input_company <> '' THEN concat(' @ ', input_company) ELSE '' END), 24) AS name,
       left(status, 16) AS status, coalesce(lookup_method, '-') AS method,
       coalesce(regexp_replace(cast(likelihood AS varchar), '\\.0$', ''), '') AS score,
       coalesce(cast(http_status AS varchar), '') AS http, cast(credits_consumed AS bigint) AS credits,
       cast(attempts AS bigint) AS attempts, CASE WHEN status = 'ambiguous' THEN concat(candidates,
       ' candidates') WHEN status IN ('error', 'invalid_input', 'budget_deferred')
       THEN left(coalesce(error_message, ''), 60) ELSE '' END AS note FROM fact_lookup""")
def _(w: Workspace) -> DataFrame:
    return analytics.batch_report(w.curated("fact_lookup"))


@query("calls_by_credit_type", """SELECT provider, CASE kind WHEN 'identify' THEN 'person_identify'
       ELSE 'enrich' END AS credit_type, count(*) AS calls, min(CASE WHEN call_id % 7 <> 6
       AND call_id <= 100000 THEN 100000 - call_id END) AS remaining FROM calls GROUP BY ALL""")
def _(w: Workspace) -> DataFrame:
    return analytics.calls_by_credit_type(answered_calls(w), ("provider",))


@query("reconcile_counts", """SELECT concat('batch ', e.batch_id) AS subject, e.rows AS expected,
       e.rows AS actual, true AS agrees FROM expected e
       UNION ALL SELECT 'person_current', count(DISTINCT person_id), count(DISTINCT person_id), true
       FROM dim_person""", expected=_EXPECTED)
def _(w: Workspace) -> DataFrame:
    return analytics.reconcile_counts(w.curated("fact_lookup"), w.curated("fact_batch_quality"),
                                      w.curated("dim_person"))


@query("idempotency_check", """SELECT c.batch_id AS source, credits_spent AS first_credits,
       cast(0 AS bigint) AS second_credits,
       (SELECT count(*) FROM dim_person d WHERE d.batch_id = c.batch_id) AS first_persons,
       (SELECT count(*) FROM dim_person d WHERE d.batch_id = c.batch_id) AS second_persons,
       budget_deferred + error AS not_cached, budget_deferred + error = 0 AS passed
       FROM counted c""")
def _(w: Workspace) -> DataFrame:
    # The first run's answers go into the cache, and the same files run again behind it.
    now = F.lit("2024-02-01").cast("timestamp")
    empty = w.spark.createDataFrame([], CACHE)
    kept = matching.cache_upsert(w.results().withColumn("person_id", F.col("profile.id")), empty, now)

    def renamed(df: DataFrame) -> DataFrame:
        return df.withColumn("batch_id", F.concat(F.lit("again-"), "batch_id"))

    again = pipeline.cached_results(renamed(w.valid()), kept, now, w.people(), w.candidates(),
                                    w.settings, derived.faults(w.planned()))
    stored = cut_lineage(again)
    lookup = curate.fact_lookup(stored, renamed(w.rejected()), w.built_at(), "recorded")
    people = curate.first_per_person(stored).groupBy("batch_id").agg(F.count("*").alias("persons"))
    second = (lookup.groupBy("batch_id").agg(F.sum("credits_consumed").alias("credits_spent"))
              .join(people, "batch_id", "left").fillna(0, ["persons"])
              .withColumn("source", F.regexp_replace("batch_id", "^again-", "")))
    first = w.curated("fact_batch_quality").withColumn("source", F.col("batch_id"))
    return analytics.idempotency_check(first, second, lookup)


# ------------------------------------------------------------------ files and tables at rest

LAYOUTS = [
    # (delimiter, encoding, headers in canonical column order)
    (",", "UTF-8", ["first_name", "last_name", "email", "company", "location", "linkedin_url",
                    "consent"]),
    (";", "UTF-8", ["First Name", "Surname", "E-mail", "Employer", "City", "LinkedIn", "Opt-in"]),
    ("|", "ISO-8859-1", ["given name", "family name", "mail", "organisation", "country",
                         "profile url", "permission"]),
    ("\t", "UTF-16", ["FIRST", "LAST", "Email Address", "Company Name", "Region",
                      "linkedin profile", "GDPR consent"]),
]


def landed_path(w: Workspace) -> str:
    """Registrants written as CSV files, one per batch, in four layouts.

    A registrant without a first name becomes an all-blank row, which is counted but skipped.
    """
    def write(path: str) -> None:
        rows = w.registrants().withColumns({n: F.when(
            F.col("first_name") == "", "").otherwise(F.col(n)) for n in V.INPUT_COLUMNS[1:]})
        layout = F.right("batch_id", F.lit(2)).cast("int") % len(LAYOUTS)
        for i, (sep, encoding, headers) in enumerate(LAYOUTS):
            chosen = rows.filter(layout == i).select("batch_id", "row_number", *[
                F.col(n).alias(h) for n, h in zip(V.INPUT_COLUMNS, headers, strict=True)])
            (chosen.repartition("batch_id").sortWithinPartitions("batch_id", "row_number")
             .drop("row_number").write.partitionBy("batch_id").option("header", "true")
             .option("sep", sep).option("encoding", encoding)
             .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
             .csv(f"{path}/layout={i}"))
    return w.path("landed", write)


def batch_of_path() -> Column:
    return F.regexp_extract("path", "batch_id=([^/]+)/", 1)


def landed(w: Workspace) -> DataFrame:
    return landing.landing_files(w.spark, landed_path(w)).withColumn("batch_id", batch_of_path())


@query("landing_files", "SELECT DISTINCT batch_id, true AS filled FROM registrants")
def _(w: Workspace) -> DataFrame:
    return landed(w).select("batch_id", (F.col("length") > 0).alias("filled"))


_FILE_PROFILE = """SELECT batch_id, CASE layout WHEN 3 THEN 'utf-16' WHEN 2 THEN
       CASE WHEN accents THEN 'cp1252' ELSE 'utf-8' END ELSE 'utf-8' END AS encoding,
       CASE layout WHEN 0 THEN ',' WHEN 1 THEN ';' WHEN 2 THEN '|' ELSE chr(9) END AS delimiter,
       CASE WHEN layout = 0 THEN 0 WHEN layout = 3 OR layout = 2 AND accents THEN 2 ELSE 1 END::bigint
       AS warnings, cast(NULL AS varchar) AS problem FROM (SELECT batch_id,
       cast(right(batch_id, 2) AS int) % 4 AS layout, bool_or(first_name <> '' AND regexp_matches(concat(
       first_name, last_name), '[^\\x00-\\x7F]')) AS accents FROM registrants GROUP BY batch_id) AS x"""


@query("file_profile", _FILE_PROFILE)
def _(w: Workspace) -> DataFrame:
    return landing.file_profile(landed(w)).select(
        "batch_id", "encoding", "delimiter", F.size("warnings").alias("warnings"), "problem")


_FILE_ROWS = """SELECT batch_id, row_number() OVER (PARTITION BY batch_id ORDER BY row_number)
    AS row_number, first_name, CASE WHEN first_name <> '' THEN last_name ELSE '' END AS last_name,
    CASE WHEN first_name <> '' THEN email ELSE '' END AS email,
    CASE WHEN first_name <> '' THEN company ELSE '' END AS company,
    CASE WHEN first_name <> '' THEN location ELSE '' END AS location,
    CASE WHEN first_name <> '' THEN linkedin_url ELSE '' END AS linkedin_url,
    CASE WHEN first_name <> '' THEN consent ELSE '' END AS consent FROM tidy"""


@query("csv_rows", _FILE_ROWS)
def _(w: Workspace) -> DataFrame:
    mapped = landing.header_mapping(landing.file_profile(landed(w)))
    return landing.csv_rows(mapped).select("batch_id", "row_number", *V.INPUT_COLUMNS)


def by_splits(w: Workspace) -> tuple[DataFrame, DataFrame]:
    return splits.registrants_by_splits(w.spark, landed_path(w))


@query("file_profile_by_splits", _FILE_PROFILE)
def _(w: Workspace) -> DataFrame:
    return by_splits(w)[0].select(batch_of_path().alias("batch_id"), "encoding", "delimiter",
                                  F.size("warnings").alias("warnings"), "problem")


@query("csv_rows_by_splits", "SELECT * FROM file_rows WHERE last_name <> ''", file_rows=_FILE_ROWS)
def _(w: Workspace) -> DataFrame:
    return by_splits(w)[1].select(batch_of_path().alias("batch_id"), "row_number", *V.INPUT_COLUMNS)


@query("row_numbering", "SELECT batch_id, row_number FROM file_rows WHERE last_name <> ''",
       file_rows=_FILE_ROWS)
def _(w: Workspace) -> DataFrame:
    _, rows = landing.registrants_of(landed(w))
    return rows.select("batch_id", "row_number")


def write_raw(w: Workspace, path: str) -> None:
    body = F.to_json(F.struct(F.col("http_status").alias("status"), "likelihood",
                              F.struct(F.col("person_id").alias("id")).alias("data")))
    paid = w.results().filter(F.col("status") != "cached").withColumn(
        "person_id", F.col("profile.id"))
    store.write_raw_responses(paid.select(
        "provider", "batch_date", "batch_id", "lookup_key",
        F.col("lookup_method").alias("method"), F.col("call_kind").alias("kind"), "attempts",
        F.date_format("requested_at", TIME).alias("requested_at"), "http_status",
        F.create_map(F.lit("x-call-credits-spent"), F.col("credits_consumed").cast("string"))
        .alias("headers"), body.alias("body")), path)


def raw_path(w: Workspace) -> str:
    return w.path("raw", lambda path: write_raw(w, path))


@query("raw_responses", """SELECT batch_id, lookup_key, lookup_method AS method,
       cast(http_status AS bigint) AS http_status, cast(credits_consumed AS varchar) AS spent,
       person_id, likelihood FROM results WHERE status <> 'cached'""")
def _(w: Workspace) -> DataFrame:
    return store.raw_responses(w.spark, raw_path(w)).select(
        "batch_id", "lookup_key", "method", "http_status",
        R.header(F.col("headers"), "x-call-credits-spent").alias("spent"),
        F.try_variant_get("body", "$.data.id", "string").alias("person_id"),
        F.try_variant_get("body", "$.likelihood", "double").alias("likelihood"))


@query("lookup_results", """SELECT batch_id, batch_date, row_number, status, lookup_method, person_id,
       likelihood, cast(http_status AS bigint) AS http_status, error_message,
       cast(credits_consumed AS bigint) AS credits_consumed, cast(attempts AS bigint) AS attempts,
       match_flags, requested_at FROM results""")
def _(w: Workspace) -> DataFrame:
    return w.results().select(
        "batch_id", "batch_date", "row_number", "status", "lookup_method",
        F.col("profile.id").alias("person_id"), "likelihood", "http_status", "error_message",
        "credits_consumed", "attempts", "match_flags", "requested_at")


def recorded_attempts(w: Workspace) -> DataFrame:
    """What the rows' own calls would have left on record, retries and odd answers included.

    A row calls unless an earlier row of its batch has an answer to its key that can be kept.
    """
    row = F.col("row_number")
    lost, garbled = row % 50 == 7, (row % 41 == 3) & (F.col("status") == "matched")
    profiles = w.people().select("person_id", F.to_json(F.col("profile").withField(
        "location_name", F.lit(True))).alias("data"))
    # A name stands for two people at most in the derived catalogue.
    named = w.candidates().groupBy("name_key").agg(F.array_sort(F.collect_list(F.struct(
        "person_id", "match_score"))).alias("found"))
    name = X.normalize_text(F.concat_ws(" ", "first_name", "last_name"))
    rows = (w.outcomes().select(
                "batch_id", "row_number", "lookup_key", "call_kind", "person_id", "likelihood",
                "http_status", "provider_error", "status", "requested_at", name.alias("name_key"))
            .withColumn("kept", F.col("status").isin(V.CACHEABLE_STATUSES) & ~lost & ~garbled))
    first = rows.filter("kept").groupBy("batch_id", "lookup_key").agg(
        F.min("row_number").alias("first"))
    calls = (rows.join(first, ["batch_id", "lookup_key"], "left")
             .filter(F.col("first").isNull() | (row <= F.col("first")))
             .join(profiles, "person_id", "left").join(named, "name_key", "left"))
    data = F.when(garbled, F.lit('{"id": 7}')).otherwise(F.col("data"))
    match = F.transform("found", lambda c: F.concat(
        F.lit('{"match_score": '), c["match_score"].cast("string"), F.lit(', "data": '),
        F.when(c["person_id"] == F.col("person_id"), data).otherwise(F.lit('{"id": "x"}')),
        F.lit("}")))
    body = (F.when(F.col("provider_error").isNotNull(), F.to_json(F.struct(F.struct(
                F.col("provider_error").alias("message")).alias("error"))))
            .when((F.col("http_status") == 200) & (F.col("call_kind") == "enrich"), F.concat(
                F.lit('{"likelihood": '), F.col("likelihood").cast("string"), F.lit(', "data": '),
                data, F.lit("}")))
            .when(F.col("http_status") == 200, F.concat(
                F.lit('{"matches": ['), F.array_join(match, ", "), F.lit("]}")))
            .otherwise("not json"))
    last = F.when((F.col("http_status") == 500) & ~lost, 4).otherwise(row % 3 + 1)
    final = F.col("attempt") == F.col("last")
    busy = F.when(F.col("attempt") % 2 == 1, 429).otherwise(503)
    header = (F.when(~final, F.create_map(F.lit("Retry-After"), F.lit("12.5")))
              .when(row % 5 == 0, F.create_map(F.lit("X-Call-Credits-Spent"), F.lit("2")))
              .when(row % 5 == 1, F.create_map(F.lit("x-call-credits-spent"), F.lit("n/a"))))
    return (calls.withColumn("last", last).withColumn("body", body)
            .withColumn("attempt", F.explode(F.sequence(F.lit(1), F.col("last"))))
            .select("batch_id", "row_number", "attempt",
                    (F.col("requested_at") + F.make_dt_interval(
                        mins=F.col("attempt") - 1)).alias("requested_at"),
                    F.when(final, F.when(~lost, F.col("http_status"))).otherwise(
                        F.when((F.col("http_status") == 500) & ~lost, 500).otherwise(busy))
                    .alias("http_status"),
                    header.alias("headers"), F.when(final & ~lost, F.col("body")).alias("body"),
                    F.when(final & lost, "connection reset").alias("failure")))


_RECORDED = {
    "fated": """SELECT *, row_number % 50 = 7 AS lost, row_number % 41 = 3 AND status = 'matched'
        AS garbled, CASE WHEN row_number % 50 = 7 OR (row_number % 41 = 3 AND status = 'matched')
        THEN 'error' ELSE status END AS fate FROM flagged""",
    "called": """SELECT *, coalesce(row_number > min(CASE WHEN fate IN ('matched', 'not_found',
        'ambiguous') THEN row_number END) OVER (PARTITION BY batch_id, lookup_key), false) AS served
        FROM fated"""}


@query("recorded_results", """SELECT batch_id, row_number, CASE WHEN served THEN 'cached' ELSE fate END
       AS status, CASE WHEN served OR fate = 'matched' THEN person_id END AS person_id,
       CASE WHEN served OR fate IN ('matched', 'ambiguous') THEN likelihood END AS likelihood,
       cast(CASE WHEN served OR fate <> 'error' THEN candidates END AS bigint) AS candidates,
       cast(CASE WHEN NOT served AND NOT lost THEN http_status END AS bigint) AS http_status,
       CASE WHEN served THEN NULL WHEN lost THEN 'transport error: connection reset'
            WHEN garbled THEN 'unparseable profile: id: Input should be a valid string'
            ELSE error_message END AS error_message,
       cast(CASE WHEN served OR lost THEN 0 WHEN row_number % 5 = 0 THEN 2 ELSE credits END AS bigint)
       AS credits_consumed, cast(CASE WHEN served THEN 0 WHEN http_status = 500 AND NOT lost THEN 4
       ELSE row_number % 3 + 1 END AS bigint) AS attempts,
       CASE WHEN served OR fate = 'matched' THEN match_flags ELSE '' END AS match_flags,
       strftime(cast(batch_date AS timestamp) + to_seconds(row_number), '%Y-%m-%d %H:%M:%S')
       AS requested_at FROM called""", **_RECORDED)
def _(w: Workspace) -> DataFrame:
    results = recorded.recorded_results(w.valid(), recorded_attempts(w), w.settings)
    return results.select(
        "batch_id", "row_number", "status", F.col("profile.id").alias("person_id"), "likelihood",
        "candidates", "http_status", "error_message", "credits_consumed", "attempts", "match_flags",
        "requested_at")


@query("write_curated", """SELECT 'dim_person' AS "table", batch_date, count(*) AS rows FROM dim_person
       GROUP BY batch_date UNION ALL SELECT 'fact_employment', batch_date, count(*) FROM fact_employment
       GROUP BY batch_date UNION ALL SELECT 'fact_lookup', batch_date, count(*) FROM fact_lookup
       GROUP BY batch_date UNION ALL SELECT 'fact_batch_quality', batch_date, count(*)
       FROM fact_batch_quality GROUP BY batch_date""")
def _(w: Workspace) -> DataFrame:
    path = scratch_path(w.spark, "publish")
    w.publish(path)
    counts = None
    for name in ("dim_person", "fact_employment", "fact_lookup", "fact_batch_quality"):
        part = (store.read_curated(w.spark, path, name).groupBy("batch_date")
                .agg(F.count("*").alias("rows"))
                .select(F.lit(name).alias("table"), "batch_date", "rows"))
        counts = part if counts is None else counts.unionByName(part)
    return counts


@query("verify_written", """SELECT 'fact_lookup' AS "table", concat(l.batch_id, ' holds ', count(*),
       ' rows, expected ', count(*) FILTER (status <> 'invalid_input')) AS problem FROM fact_lookup l
       GROUP BY l.batch_id HAVING count(*) FILTER (status = 'invalid_input') > 0""")
def _(w: Workspace) -> DataFrame:
    persons = w.curated("dim_person").groupBy("batch_id").agg(F.count("*").alias("rows"))
    # Expected on purpose without the rejected rows, so that every batch differs.
    lookups = w.valid().groupBy("batch_id").agg(F.count("*").alias("rows"))
    return store.verify_written(w.spark, w.curated_path(), {
        "dim_person": persons, "fact_lookup": lookups})


@query("rejected_rows_export", """SELECT batch_id, row_number, reason,
       nullif(raw_first_name, '') AS first_name, nullif(raw_last_name, '') AS last_name,
       nullif(raw_email, '') AS email, nullif(raw_company, '') AS company,
       nullif(raw_location, '') AS location, nullif(raw_linkedin_url, '') AS linkedin_url,
       nullif(raw_consent, '') AS consent FROM rejected""")
def _(w: Workspace) -> DataFrame:
    path = w.path("rejected", lambda p: store.rejected_rows_export(w.rejected(), p))
    back = store.read_export(w.spark, path).drop("batch_date")
    return back.withColumns({n: G.blank_to_null(F.col(n)) for n in V.INPUT_COLUMNS})


@query("quarantine_files", """SELECT batch_id, problem AS reason, true AS kept FROM (
       SELECT s.batch_id, """ + _PROBLEM + """ AS problem FROM sized s
       LEFT JOIN top t ON s.batch_id = t.batch_id LEFT JOIN toplayout u ON s.batch_id = u.batch_id)
       AS x WHERE problem IS NOT NULL""", **_STRICT_STEPS)
def _(w: Workspace) -> DataFrame:
    files = landed(w)
    verdict = validation.file_verdict(files.select("path", "batch_id"), stricter(w), "batch_id")
    kept = store.quarantine_files(files.drop("batch_id"), verdict)
    return kept.select(F.regexp_extract("source", "batch_id=([^/]+)/", 1).alias("batch_id"),
                       "reason", (F.octet_length("content") == F.col("length")).alias("kept"))


@query("redrive", """SELECT row_number, first_name, last_name, email, company, location, linkedin_url,
       consent FROM file_rows f WHERE last_name <> '' AND batch_id IN (SELECT batch_id FROM (
       SELECT s.batch_id, """ + _PROBLEM + """ AS problem FROM sized s
       LEFT JOIN top t ON s.batch_id = t.batch_id LEFT JOIN toplayout u ON s.batch_id = u.batch_id)
       AS x WHERE problem IS NOT NULL)""", file_rows=_FILE_ROWS, **_STRICT_STEPS)
def _(w: Workspace) -> DataFrame:
    files = landed(w)
    verdict = validation.file_verdict(files.select("path", "batch_id"), stricter(w), "batch_id")
    kept = store.quarantine_files(files.drop("batch_id"), verdict)
    # All are landed again, under paths of their own, and read like any landed file.
    again = store.redrive(kept, kept.select("path").distinct(), "20240301T000000")
    return landing.registrants_of(again)[1].select("row_number", *V.INPUT_COLUMNS)


@query("manifest", """SELECT batch_id, batch_date, cast(rows_valid AS varchar) AS rows_valid,
       cast(rows_invalid AS varchar) AS rows_invalid, cast(credits_spent AS varchar) AS credits_spent,
       cast(persons AS varchar) AS persons, cast(nullif(matched, 0) AS varchar) AS matched,
       CASE WHEN warnings = '' THEN 'none' ELSE warnings END AS notes,
       concat('curated/dim_person/batch_date=', batch_date) AS file
       FROM fact_batch_quality""")
def _(w: Workspace) -> DataFrame:
    path = w.path("manifests", lambda p: store.manifest(w.curated("fact_batch_quality"), p))
    lines = store.read_manifests(w.spark, path).drop("batch_date")
    field = {n: F.get_json_object("value", f"$.{p}").alias(n) for n, p in {
        "batch_date": "batch_date", "rows_valid": "rows_valid", "rows_invalid": "rows_invalid",
        "credits_spent": "credits_spent", "persons": "persons", "matched": "status_counts.matched",
        "notes": "quality.notes", "file": "files.dim_person"}.items()}
    return lines.select("batch_id", *field.values())


@query("catalog_tables", """SELECT l.batch_date, count(*) AS rows, count(d.person_id) AS people
       FROM fact_lookup l LEFT JOIN dim_person d ON l.batch_id = d.batch_id
       AND l.row_number = d.input_row_number GROUP BY l.batch_date""")
def _(w: Workspace) -> DataFrame:
    store.catalog_tables(w.spark, w.curated_path())
    return w.spark.sql("""SELECT l.batch_date, count(*) AS rows, count(d.person_id) AS people
        FROM fact_lookup l LEFT JOIN dim_person d ON l.batch_date = d.batch_date
        AND l.batch_id = d.batch_id AND l.row_number = d.input_row_number GROUP BY l.batch_date""")


# ------------------------------------------------------------------ erasure

_REQUESTS = """SELECT concat('req-', c_custkey) AS request_id,
    CASE WHEN c_custkey % 3 = 0 THEN concat('p', lpad(cast(floor(c_custkey / 7)::bigint AS varchar), 9,
      '0')) END AS person_id,
    CASE WHEN c_custkey % 3 = 1 THEN concat(' USER', floor(c_custkey / 7)::bigint, '@example.com ') END
      AS email,
    CASE WHEN c_custkey % 3 = 2 THEN upper(r.first_name) END AS first_name,
    CASE WHEN c_custkey % 3 = 2 THEN strip_accents(r.last_name) END AS last_name
    FROM customer c JOIN registrants r ON r.batch_id = concat('b', lpad(cast(floor(c_custkey / 10000)
      ::bigint AS varchar), 6, '0'), '-', lpad(cast(c_nationkey AS varchar), 2, '0'))
      AND r.row_number = c_custkey % 10000 + 1 WHERE c_acctbal > 9800
    UNION ALL SELECT 'req-nobody', 'p-none', 'nobody@example.com', NULL, NULL"""
_WANTED = f"""SELECT request_id, person_id, nullif(trim(lower(email)), '') AS email,
    CASE WHEN first_name <> '' AND last_name <> '' THEN concat({O.fold('first_name')}, '|',
      {O.fold('last_name')}) END AS name FROM requests"""
_MATCHES = f"""SELECT DISTINCT request_id, batch_id, row_number, part FROM (
    SELECT w.request_id, c.batch_id, c.row_number, 'row' AS part FROM wanted w JOIN
      (SELECT batch_id, row_number, email, person_id,
              concat({O.fold('first_name')}, '|', {O.fold('last_name')}) AS name FROM results) AS c
      ON w.person_id = c.person_id OR w.email = c.email OR w.name = c.name
    UNION ALL
    SELECT w.request_id, c.batch_id, c.row_number, 'rejected' FROM wanted w JOIN
      (SELECT batch_id, row_number, lower(raw_email) AS email,
              concat({O.fold('raw_first_name')}, '|', {O.fold('raw_last_name')}) AS name FROM rejected)
      AS c ON w.email = c.email OR w.name = c.name) AS x"""
_ITEMS = """SELECT DISTINCT request_id, batch_id, item, value FROM (
    SELECT request_id, batch_id, CASE part WHEN 'row' THEN 'row' ELSE 'rejected_row' END AS item,
           cast(row_number AS varchar) AS value FROM matches
    UNION ALL SELECT m.request_id, m.batch_id, 'lookup_key', lookup_key FROM matches m JOIN results r
      ON m.batch_id = r.batch_id AND m.row_number = r.row_number WHERE part = 'row'
    UNION ALL SELECT m.request_id, m.batch_id, 'raw_ref', raw_ref FROM matches m JOIN results r
      ON m.batch_id = r.batch_id AND m.row_number = r.row_number WHERE part = 'row'
    UNION ALL SELECT request_id, batch_id, 'source', concat('incoming/', batch_id, '.csv')
      FROM matches) AS x"""
_ERASE = {"requests": _REQUESTS, "wanted": _WANTED, "matches": _MATCHES, "items": _ITEMS,
          "kept": _CACHE}


def requests(w: Workspace) -> DataFrame:
    """Erasure requests of the richest customers, by id, e-mail or name, and one of nobody."""
    person = F.floor(F.col("c_custkey") / 7)
    names = w.registrants().select("batch_id", "row_number", "first_name", "last_name")
    chunk = F.floor(F.col("c_custkey") / 10000)
    asked = (w.table("customer").filter(F.col("c_acctbal") > 9800)
             .withColumn("batch_id", F.concat(F.lit("b"), F.lpad(chunk.cast("string"), 6, "0"),
                                              F.lit("-"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")))
             .withColumn("row_number", (F.col("c_custkey") % 10000 + 1).cast("int"))
             .join(names, ["batch_id", "row_number"]))
    way = F.col("c_custkey") % 3
    chosen = asked.select(
        F.concat(F.lit("req-"), F.col("c_custkey").cast("string")).alias("request_id"),
        F.when(way == 0, F.concat(F.lit("p"), F.lpad(person.cast("string"), 9, "0"))).alias("person_id"),
        F.when(way == 1, F.concat(F.lit(" USER"), person.cast("string"), F.lit("@example.com ")))
        .alias("email"),
        F.when(way == 2, F.upper("first_name")).alias("first_name"),
        F.when(way == 2, F.translate("last_name", "éíüë", "eiue")).alias("last_name"))
    nobody = w.spark.createDataFrame([("req-nobody", "p-none", "nobody@example.com", None, None)],
                                     chosen.schema)
    return chosen.unionByName(nobody)


def erasure_matches(w: Workspace) -> DataFrame:
    return w.stage("erasure_matches", lambda: erasure.subject_match(
        requests(w), w.valid(), w.rejected(), w.results()))


def erasure_items(w: Workspace) -> DataFrame:
    sources = w.registrants().select("batch_id").distinct().withColumn("source", F.concat(
        F.lit("incoming/"), "batch_id", F.lit(".csv")))
    return w.stage("erasure_items", lambda: erasure.erasure_items(
        erasure_matches(w), w.results(), sources))


@query("subject_match", "SELECT request_id, batch_id, row_number, part FROM matches", **_ERASE)
def _(w: Workspace) -> DataFrame:
    return erasure.subject_match(requests(w), w.valid(), w.rejected(), w.results())


def index_path(w: Workspace) -> str:
    """An index of all batches, from three publications."""
    def write(root: str) -> None:
        entries = cut_lineage(erasure.identity_entries(w.valid(), w.rejected(), w.results()))
        for part in range(3):
            publication = Publication(w.spark, root)
            identities.add(entries.filter(F.pmod(F.xxhash64("batch_id"), F.lit(3)) == part),
                           publication)
            publication.commit()
    return w.path("identities", write)


@query("subject_match_by_index", "SELECT request_id, batch_id, row_number, part FROM matches", **_ERASE)
def _(w: Workspace) -> DataFrame:
    return identities.subject_match(requests(w), index_path(w), w.valid(), w.rejected(), w.results())


@query("erasure_items", "SELECT request_id, batch_id, item, value FROM items", **_ERASE)
def _(w: Workspace) -> DataFrame:
    return erasure_items(w)


@query("erasure_plan", """SELECT request_id, batch_id, count(*) FILTER (item = 'row') AS rows,
       count(*) FILTER (item = 'rejected_row') AS rejected_rows,
       count(*) FILTER (item = 'lookup_key') AS lookup_keys,
       count(*) FILTER (item = 'raw_ref') AS raw_refs, count(*) FILTER (item = 'source') AS sources
       FROM items GROUP BY ALL""", **_ERASE)
def _(w: Workspace) -> DataFrame:
    return erasure.erasure_plan(erasure_items(w))


def erased(w: Workspace) -> str:
    """A copy of every layer below one folder, with the requests' subjects erased from it."""
    def write(folder: str) -> None:
        store.write_lookup_results(w.results(), f"{folder}/results")
        store.rejected_rows_export(w.rejected(), f"{folder}/rejected")
        write_raw(w, f"{folder}/raw")
        cache(w).write.parquet(f"{folder}/cache")
        w.publish(f"{folder}/curated")
        publication = Publication(w.spark, f"{folder}/identities")
        identities.add(erasure.identity_entries(w.valid(), w.rejected(), w.results()), publication)
        publication.commit()
        pipeline.erase(folder, erasure_matches(w), erasure_items(w), w.rejected(), w.built_at(),
                       "recorded")
    return w.path("erased", write)


@query("erase_rows", """SELECT 'row' AS part, r.batch_id, r.row_number FROM results r WHERE NOT EXISTS (
       SELECT 1 FROM matches m WHERE m.batch_id = r.batch_id AND m.row_number = r.row_number
       AND part = 'row') UNION ALL SELECT 'rejected', r.batch_id, r.row_number FROM rejected r
       WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.batch_id = r.batch_id
       AND m.row_number = r.row_number AND part = 'rejected')""", **_ERASE)
def _(w: Workspace) -> DataFrame:
    folder = erased(w)
    kept = [t.select(F.lit(p).alias("part"), "batch_id", "row_number") for t, p in (
        (store.lookup_results(w.spark, f"{folder}/results"), "row"),
        (store.read_export(w.spark, f"{folder}/rejected"), "rejected"))]
    return kept[0].unionByName(kept[1])


_LEFT_ROWS = """SELECT batch_id, email, first_name, last_name, person_id FROM results r
    WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.batch_id = r.batch_id
      AND m.row_number = r.row_number AND part = 'row')
    UNION ALL SELECT batch_id, raw_email, raw_first_name, raw_last_name, NULL FROM rejected r
    WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.batch_id = r.batch_id
      AND m.row_number = r.row_number AND part = 'rejected')"""
_KNOWN_BY = f"""SELECT batch_id, concat('id ', person_id) AS identity FROM left_rows
    WHERE person_id IS NOT NULL
    UNION SELECT batch_id, concat('email ', trim(lower(email))) FROM left_rows
    WHERE trim(coalesce(email, '')) <> ''
    UNION SELECT batch_id, concat('name ', {O.fold('first_name')}, '|', {O.fold('last_name')})
    FROM left_rows WHERE {O.fold('first_name')} <> '' AND {O.fold('last_name')} <> ''"""


@query("erase_index", "SELECT batch_id, count(*) AS identities FROM known_by GROUP BY batch_id",
       left_rows=_LEFT_ROWS, known_by=_KNOWN_BY, **_ERASE)
def _(w: Workspace) -> DataFrame:
    return identities.entries(w.spark, f"{erased(w)}/identities").groupBy("batch_id").agg(
        F.count("*").alias("identities"))


@query("erase_raw", """SELECT raw_ref, count(*) AS rows FROM results r WHERE status <> 'cached'
       AND NOT EXISTS (SELECT 1 FROM items i WHERE i.item = 'raw_ref' AND i.value = r.raw_ref)
       GROUP BY raw_ref""", **_ERASE)
def _(w: Workspace) -> DataFrame:
    left = store.raw_responses(w.spark, f"{erased(w)}/raw")
    return left.groupBy("raw_ref").agg(F.count("*").alias("rows"))


@query("purge_cache", """SELECT lookup_key, 'kept' AS state, cast(NULL AS varchar) AS request_id FROM kept
       WHERE lookup_key NOT IN (SELECT value FROM items WHERE item = 'lookup_key')
       UNION ALL SELECT k.lookup_key, 'gone', min(request_id) FROM kept k JOIN items i
       ON i.item = 'lookup_key' AND i.value = k.lookup_key GROUP BY k.lookup_key""", **_ERASE)
def _(w: Workspace) -> DataFrame:
    left, gone = (w.spark.read.parquet(f"{erased(w)}/{n}") for n in ("cache", "cache_gone"))
    return left.select("lookup_key", F.lit("kept").alias("state"),
                       F.lit(None).cast("string").alias("request_id")).unionByName(
        gone.select("lookup_key", F.lit("gone").alias("state"), "request_id"))


@query("erase_rebuild", """SELECT l.batch_id, count(*) AS rows, count(*) FILTER (status =
       'invalid_input') AS rows_invalid, cast(sum(credits_consumed) AS bigint) AS credits FROM fact_lookup l
       WHERE EXISTS (SELECT 1 FROM matches m WHERE m.batch_id = l.batch_id) AND NOT EXISTS (
       SELECT 1 FROM matches m WHERE m.batch_id = l.batch_id AND m.row_number = l.row_number
       AND (m.part = 'rejected') = (l.status = 'invalid_input')) GROUP BY l.batch_id""", **_ERASE)
def _(w: Workspace) -> DataFrame:
    quality = store.read_curated(w.spark, f"{erased(w)}/curated", "fact_batch_quality")
    return erasure.affected(quality, erasure_matches(w)).select(
        "batch_id", (F.col("rows_valid") + F.col("rows_invalid")).alias("rows"), "rows_invalid",
        F.col("credits_spent").alias("credits"))


@query("tombstone", f"""SELECT q.request_id, sha256(concat(coalesce(person_id, ''), '|',
       trim(lower(coalesce(email, ''))), '|', {O.fold('first_name')}, '|', {O.fold('last_name')}))
       AS subject_digest, coalesce(f.batches, 0) AS batches, coalesce(f.rows_erased, 0) AS rows_erased,
       coalesce(f.raw_objects, 0) AS raw_objects, coalesce(g.n, 0) AS cache_items_deleted,
       'operator' AS actor FROM requests q LEFT JOIN (
         SELECT request_id, count(DISTINCT batch_id) AS batches, count(*) FILTER (item LIKE '%row') AS
         rows_erased, count(DISTINCT value) FILTER (item = 'raw_ref') AS raw_objects FROM items
         GROUP BY request_id) AS f ON q.request_id = f.request_id
       LEFT JOIN (SELECT request_id, count(*) AS n FROM (SELECT k.lookup_key, min(request_id) AS
         request_id FROM kept k JOIN items i ON i.item = 'lookup_key' AND i.value = k.lookup_key
         GROUP BY k.lookup_key) AS x GROUP BY request_id) AS g ON q.request_id = g.request_id""",
       **_ERASE)
def _(w: Workspace) -> DataFrame:
    _, gone = erasure.purge_cache(cache(w), erasure_items(w))
    return erasure.tombstone(requests(w), erasure_items(w), gone, "operator", w.built_at()).drop("at")


# ------------------------------------------------------------------ streams and time


def priced(w: Workspace) -> DataFrame:
    status = (F.when(F.col("http_status") == 200, "matched")
              .when(F.col("http_status") == 404, "not_found").otherwise("error"))
    return w.provider_calls().select("requested_at", "provider", "kind", status.alias("status"),
                                     F.col("credits").cast("long").alias("credits"),
                                     F.floor(F.col("value") * 1000).alias("duration_ms"))


# ------------------------------------------------------------------ all call rules together

PROTECTED = pipeline.Settings(
    limits=CreditLimits(enrich=90, identify=50, per_batch=20),
    ladder=LadderConfig(breaker_threshold=2, breaker_cooldown_seconds=150))
_SHARED_DAYS = """SELECT * REPLACE (CASE WHEN early THEN 500 ELSE http_status END AS http_status,
      CASE WHEN early THEN 'error' ELSE status END AS status,
      CASE WHEN early THEN 'HTTP 500' ELSE error_message END AS error_message)
    FROM (SELECT *, strftime(DATE '2024-01-28' + cast(floor((cast(substr(batch_id, 2, 6) AS
      bigint) * 25 + cast(substr(batch_id, 9, 2) AS bigint)) / 3) AS integer), '%Y-%m-%d') AS day,
      http_status = 402 AND cast(substr(batch_id, 9, 2) AS bigint) < 20 AS early FROM flagged) AS x"""
_CALLS_IN_TURN = """SELECT f.*, row_number() OVER (ORDER BY f.batch_id, f.row_number) AS seq,
    concat(left(f.day, 7), '|', call_kind) AS pool,
    cast(f.day AS timestamp) + to_seconds(cast(coalesce(b.before, 0) + f.row_number AS integer))
      AS called_at
    FROM shared f JOIN (SELECT batch_id, sum(n) OVER (PARTITION BY day ORDER BY batch_id ROWS
        BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT day, batch_id,
        max(row_number) AS n FROM shared GROUP BY day, batch_id) AS x) AS b
    ON f.batch_id = b.batch_id"""
# One row after the other, with everything that earlier rows have left behind.
_WALK = """walk AS (
    SELECT cast(0 AS bigint) AS seq, '' AS decision, cast(NULL AS timestamp) AS shown,
      cast(map([], []) AS MAP(varchar, bigint)) AS spent, cast([] AS varchar[]) AS dry,
      cast('' AS varchar) AS batch, cast(0 AS bigint) AS used, cast([] AS varchar[]) AS cached,
      cast(0 AS bigint) AS failures, cast(NULL AS timestamp) AS until
    UNION ALL
    SELECT seq, decision, until_before,
      CASE WHEN decision = 'call' THEN map_concat(spent, map([pool], [had + credits])) ELSE spent END,
      CASE WHEN decision = 'call' AND http_status = 402 THEN list_append(dry, pool) ELSE dry END,
      batch_id, used + CASE WHEN decision = 'call' THEN credits ELSE 0 END,
      CASE WHEN decision = 'call' AND status IN ('matched', 'not_found', 'ambiguous')
           THEN list_append(cached, lookup_key) ELSE cached END,
      CASE WHEN decision <> 'call' THEN failures WHEN http_status < 500 THEN 0
           WHEN failures + 1 >= 2 THEN 0 ELSE failures + 1 END,
      CASE WHEN decision <> 'call' THEN until_before WHEN http_status < 500 THEN NULL
           WHEN failures + 1 >= 2 THEN called_at + INTERVAL 150 SECOND ELSE until_before END
    FROM (SELECT o.*, w.spent, w.dry, w.cached, w.failures, w.until AS until_before,
        coalesce(w.spent[o.pool], 0) AS had,
        CASE WHEN w.batch = o.batch_id THEN w.used ELSE 0 END AS used,
        CASE WHEN list_contains(w.cached, o.lookup_key) THEN 'cached'
             WHEN list_contains(w.dry, o.pool) THEN 'exhausted'
             WHEN coalesce(w.spent[o.pool], 0) >= CASE o.call_kind WHEN 'enrich' THEN 90 ELSE 50 END
               THEN 'month'
             WHEN CASE WHEN w.batch = o.batch_id THEN w.used ELSE 0 END >= 20 THEN 'cap'
             WHEN w.until > o.called_at THEN 'breaker' ELSE 'call' END AS decision
        FROM walk w JOIN inturn o ON o.seq = w.seq + 1) AS x)"""


@query("protected_results", """SELECT o.batch_id, o.row_number, CASE w.decision WHEN 'cached' THEN 'cached'
       WHEN 'call' THEN o.status WHEN 'breaker' THEN 'provider_unavailable' ELSE 'budget_deferred' END
       AS status, CASE w.decision WHEN 'call' THEN o.error_message
       WHEN 'exhausted' THEN concat('provider reported ', call_kind, ' credits exhausted (HTTP 402)')
       WHEN 'month' THEN concat(call_kind, ' credit budget: monthly ceiling (',
         CASE call_kind WHEN 'enrich' THEN 90 ELSE 50 END, ') reached')
       WHEN 'cap' THEN 'credit budget: batch cap (20) reached'
       WHEN 'breaker' THEN concat('provider circuit breaker open after consecutive failures; skipped '
         'without a call, retry after ', strftime(w.shown, '%Y-%m-%d %H:%M:%S'), ' UTC') END
       AS error_message, cast(CASE w.decision WHEN 'call' THEN credits ELSE 0 END AS bigint)
       AS credits_consumed, cast(CASE w.decision WHEN 'call' THEN 1 ELSE 0 END AS bigint) AS attempts
       FROM walk w JOIN inturn o ON w.seq = o.seq""", recursive=_WALK,
       shared=_SHARED_DAYS, inturn=_CALLS_IN_TURN)
def _(w: Workspace) -> DataFrame:
    # Three batches a day.  Pools run dry late only, so that ceilings, caps and breaker act before.
    nation = F.substring("batch_id", 9, 2).cast("int")
    turn = F.substring("batch_id", 2, 6).cast("int") * 25 + nation
    early = (F.col("http_status") == 402) & (nation < 20)
    day = F.date_add(F.lit("2024-01-28").cast("date"), F.floor(turn / 3).cast("int"))
    outcomes = pipeline.serial_clock(w.outcomes().withColumns({
        "batch_date": F.date_format(day, "yyyy-MM-dd"),
        "status": F.when(early, "error").otherwise(F.col("status")),
        "error_message": F.when(early, "HTTP 500").otherwise(F.col("error_message")),
        "http_status": F.when(early, 500).otherwise(F.col("http_status"))}))
    opening = w.spark.createDataFrame([], "provider string, month string, kind string, spent long")
    return pipeline.record(pipeline.settle_calls(outcomes, opening, PROTECTED)).select(
        "batch_id", "row_number", "status", "error_message", "credits_consumed", "attempts")


@query("hourly_dashboard", """SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS hour,
       count(*) FILTER (http_status = 200) AS matched, 0::bigint AS cached,
       count(*) FILTER (http_status = 404) AS not_found, 0::bigint AS ambiguous,
       0::bigint AS budget_deferred, 0::bigint AS provider_unavailable,
       count(*) FILTER (http_status = 500) AS error, 0::bigint AS invalid_input,
       cast(sum(credits) AS bigint) AS credits, max(d) AS max_duration_ms,
       min(d) FILTER (rank * 100 >= n * 95) AS p95_duration_ms FROM (
       SELECT *, row_number() OVER (PARTITION BY h ORDER BY d) AS rank,
              count(*) OVER (PARTITION BY h) AS n FROM (
         SELECT *, date_trunc('hour', requested_at) AS h, cast(floor(value * 1000) AS bigint) AS d
         FROM calls) AS x) AS y GROUP BY h""")
def _(w: Workspace) -> DataFrame:
    return monitoring.hourly_dashboard(priced(w))


@query("freshness_slo", """SELECT strftime(time_bucket(INTERVAL 5 MINUTE, finished_at),
       '%Y-%m-%d %H:%M:%S') AS period_start, count(*) AS batches, max(took) AS slowest_seconds,
       count(*) FILTER (took > 600) AS late, max(took) > 600 AS breached FROM (
       SELECT max(requested_at) AS finished_at, epoch(date_trunc('second', max(requested_at)))::bigint -
       epoch(date_trunc('second', min(requested_at)))::bigint AS took FROM calls
       GROUP BY provider, date_trunc('hour', requested_at)) AS x
       GROUP BY time_bucket(INTERVAL 5 MINUTE, finished_at)""")
def _(w: Workspace) -> DataFrame:
    batches = (w.provider_calls().groupBy("provider", F.date_trunc("hour", "requested_at").alias("h"))
               .agg(F.min("requested_at").alias("started_at"), F.max("requested_at").alias("finished_at"))
               .withColumn("batch_id", F.concat("provider", F.date_format("h", "yyyyMMddHH"))))
    return monitoring.freshness_slo(batches)


@query("retention", """SELECT person_id, batch_id, batch_date FROM dim_person
       WHERE batch_date > '2024-01-11'""")
def _(w: Workspace) -> DataFrame:
    kept = monitoring.retention(w.curated("dim_person"), "batch_date",
                                V.RETENTION_DAYS["landing"], F.lit("2024-02-10").cast("date"))
    return kept.select("person_id", "batch_id", "batch_date")


@query("expired_partitions", """SELECT batch_date, count(*) AS rows FROM dim_person
       WHERE batch_date <= '2024-01-11' GROUP BY batch_date""")
def _(w: Workspace) -> DataFrame:
    return monitoring.expired_partitions(w.curated("dim_person"), "batch_date",
                                         V.RETENTION_DAYS["landing"], F.lit("2024-02-10").cast("date"))


#: Clean-up of what the calls left: what a table has one row for (its keys of a call).
KEPT_PER = {"raw": ["call_id"], "landing": ["provider", "hour"], "quarantine": ["provider", "day"],
            "lookup_cache": ["value"], "batch_claims": ["provider", "hour"],
            "batch_counter": ["provider", "day"], "month_counter": ["provider", "kind", "day"],
            "exhausted_marker": ["provider", "kind", "hour"]}
CLEANED_AT = dt.datetime(2024, 2, 10, 11, 30)


def _left_sql() -> str:
    """Rows a clean-up leaves, by table and date; ages are set so that each limit falls among them."""
    return " UNION ALL ".join(f"""SELECT '{table}' AS "table", strftime(age, '%Y-%m-%d') AS batch_date,
        count(*) AS rows FROM (SELECT max(requested_at) - INTERVAL {days - 25} DAY AS age FROM
        (SELECT *, date_trunc('hour', requested_at) AS hour, date_trunc('day', requested_at) AS day
         FROM calls) AS c GROUP BY {", ".join(KEPT_PER[table])}) AS x
        WHERE age > TIMESTAMP '{CLEANED_AT}' - INTERVAL {days} DAY GROUP BY 2"""
                              for table, days in V.RETENTION_DAYS.items())


@query("clean_up", _left_sql())
def _(w: Workspace) -> DataFrame:
    root = scratch_path(w.spark, "expiring")
    calls = w.stage("calls", lambda: w.provider_calls().withColumns({
        "hour": F.date_trunc("hour", "requested_at"), "day": F.date_trunc("day", "requested_at")}))
    publication = Publication(w.spark, root)
    for rule in retention.RULES:
        age = F.max("requested_at") - F.make_dt_interval(F.lit(rule.days - 25))
        rows = calls.groupBy(*KEPT_PER[rule.table]).agg(age.alias("age"))
        retention.add(rows.select(F.col("age").alias(rule.age)), rule, publication)
    publication.commit()
    retention.clean_up(w.spark, root, CLEANED_AT)
    left = None
    for rule in retention.RULES:
        part = (retention.read(w.spark, root, rule.table, f"{rule.age} timestamp")
                .groupBy("batch_date").agg(F.count("*").alias("rows"))
                .select(F.lit(rule.table).alias("table"), "batch_date", "rows"))
        left = part if left is None else left.unionByName(part)
    return left


@query("batch_notifications", """SELECT q.batch_id, batch_date, coalesce(n, 0) AS row_errors,
       cast(warning_count AS bigint) AS warning_count, concat('Batch ', q.batch_id, ' completed with ',
       coalesce(n, 0), ' row error(s) out of ', rows_valid, ' rows',
       CASE WHEN n > 0 THEN concat(' (input rows ', a, ' to ', b, ')') ELSE '' END, ' and ',
       warning_count, ' data-quality warning(s): ', CASE WHEN warnings = '' THEN 'none' ELSE warnings END,
       '. Persons curated: ', persons, '.') AS message FROM fact_batch_quality q LEFT JOIN (
       SELECT batch_id, count(*) AS n, min(row_number) AS a, max(row_number) AS b FROM results
       WHERE substr(lookup_key, 2, 1) = '0' AND substr(lookup_key, 3, 1) < '8' GROUP BY batch_id) AS e
       ON q.batch_id = e.batch_id WHERE n > 0 OR warning_count > 0""")
def _(w: Workspace) -> DataFrame:
    return monitoring.batch_notifications(w.curated("fact_batch_quality"), lossy(w)[1])


@query("upload_stream", """SELECT batch_id, count(*) AS rows, count(*) FILTER (reason IS NOT NULL)
       AS rejected FROM cleaned WHERE first_name <> '' GROUP BY batch_id""")
def _(w: Workspace) -> DataFrame:
    target = scratch_path(w.spark, "uploaded")

    def build(files: DataFrame, _: int) -> None:
        # A micro-batch is a set of files: the batch plan runs on it unchanged.
        _, rows = landing.registrants_of(files.withColumn("batch_id", batch_of_path()))
        cleaned = validation.clean_rows(rows.drop("path"))
        (cleaned.withColumn("rejected", F.col("reason").isNotNull())
         .select("batch_id", "row_number", "rejected")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(target))

    jobs.upload_stream(w.spark, landed_path(w), scratch_path(w.spark, "uploads"),
                       build).awaitTermination()
    rows = w.spark.read.schema("row_number int, rejected boolean, batch_id string").parquet(target)
    return rows.groupBy("batch_id").agg(F.count("*").alias("rows"),
                                        F.count_if("rejected").alias("rejected"))


@query("upload_to_curated", """SELECT r.batch_id, r.rows_valid, coalesce(i.n, 0) AS rows_invalid,
       r.matched, r.cached, r.credits, coalesce(p.n, 0) AS persons, coalesce(e.n, 0) AS employment_rows
       FROM (SELECT batch_id, count(*) AS rows_valid, count(*) FILTER (status = 'matched') AS matched,
             count(*) FILTER (status = 'cached') AS cached,
             cast(sum(credits_consumed) AS bigint) AS credits FROM results GROUP BY batch_id) AS r
       LEFT JOIN (SELECT batch_id, count(*) AS n FROM cleaned WHERE first_name <> ''
             AND reason IS NOT NULL GROUP BY batch_id) AS i ON r.batch_id = i.batch_id
       LEFT JOIN (SELECT batch_id, count(*) AS n FROM dim_person GROUP BY batch_id) AS p
             ON r.batch_id = p.batch_id
       LEFT JOIN (SELECT batch_id, count(*) AS n FROM fact_employment GROUP BY batch_id) AS e
             ON r.batch_id = e.batch_id""")
def _(w: Workspace) -> DataFrame:
    root = scratch_path(w.spark, "arrived")
    build = pipeline.uploaded(w.people(), w.candidates(), w.built_at(), w.settings,
                              derived.faults(w.planned()))
    jobs.curated_stream(w.spark, landed_path(w), root, scratch_path(w.spark, "arrived-state"),
                        build, batch_of=batch_of_path(), files_per_trigger=100).awaitTermination()
    return store.read_curated(w.spark, root, "fact_batch_quality").select(
        "batch_id", "rows_valid", "rows_invalid", "matched", "cached",
        F.col("credits_spent").alias("credits"), "persons", "employment_rows")


def streamed(w: Workspace, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table as a stream of its files."""
    path = w.path(name, lambda p: build().write.parquet(p))
    return w.spark.readStream.schema(w.spark.read.parquet(path).schema).parquet(path)


_WINNERS = """won AS (
    SELECT batch_id, min(triggered_at) AS at FROM deliveries GROUP BY batch_id
    UNION ALL
    SELECT w.batch_id, min(d.triggered_at) FROM won w JOIN deliveries d ON w.batch_id = d.batch_id
      AND d.triggered_at >= w.at + INTERVAL 90 DAY GROUP BY w.batch_id)"""


@query("duplicate_deliveries", """SELECT w.batch_id, min(d.execution_id) AS execution_id,
       strftime(w.at, '%Y-%m-%d %H:%M:%S') AS triggered_at FROM won w JOIN deliveries d
       ON w.batch_id = d.batch_id AND w.at = d.triggered_at GROUP BY w.batch_id, w.at""",
       recursive=_WINNERS, deliveries=_TRIGGERS)
def _(w: Workspace) -> DataFrame:
    target = scratch_path(w.spark, "deliveries")
    jobs.first_deliveries(streamed(w, "triggers", lambda: triggers(w)), target,
                          scratch_path(w.spark, "deliveries-state")).awaitTermination()
    return w.spark.read.schema(jobs.CLAIMS).parquet(target).select(
        "batch_id", "execution_id", "triggered_at")


@query("breaker_stream", _BREAK_SQL, recursive=_BREAK, ordered=_ORDERED)
def _(w: Workspace) -> DataFrame:
    # The calls arrive in four parts, so that states are carried from one to the next.
    calls = failing(w)
    path, target = scratch_path(w.spark, "arrivals"), scratch_path(w.spark, "breaker")
    state = scratch_path(w.spark, "breaker-state")
    at = F.unix_seconds("requested_at")
    first, last = calls.agg(F.min(at), F.max(at)).first()
    part = F.floor((at - (first or 0)) * 4 / ((last or 0) - (first or 0) + 1))
    for number in range(4):
        calls.filter(part == number).write.mode("append").parquet(path)
        stream = w.spark.readStream.schema(calls.schema).parquet(path)
        jobs.breaker_stream(stream, target, state, 3, COOLDOWN).awaitTermination()
    return w.spark.read.parquet(f"{target}/decisions").select("call_id", "skipped", "open_until")


@query("credit_totals_stream", """SELECT provider, month, kind, cast(sum(credits) AS bigint) AS
       month_to_date FROM batched GROUP BY ALL""", batched=_BATCHED)
def _(w: Workspace) -> DataFrame:
    target = scratch_path(w.spark, "totals")
    calls = streamed(w, "batched", lambda: batched_calls(w))
    jobs.run_to_table(jobs.credit_totals_stream(calls), target,
                      scratch_path(w.spark, "totals-state"), "complete")
    return w.spark.read.parquet(target)


@query("hourly_stream", """SELECT strftime(date_trunc('hour', requested_at), '%Y-%m-%d %H:%M:%S') AS hour,
       CASE http_status WHEN 200 THEN 'matched' WHEN 404 THEN 'not_found' ELSE 'error' END AS status,
       count(*) AS rows, cast(sum(credits) AS bigint) AS credits FROM calls GROUP BY ALL""")
def _(w: Workspace) -> DataFrame:
    target = scratch_path(w.spark, "hours")
    calls = streamed(w, "priced", lambda: priced(w))
    jobs.run_to_table(jobs.hourly_stream(calls), target, scratch_path(w.spark, "hours-state"),
                      "update")
    return jobs.latest(w.spark, target, ["hour", "status"])
