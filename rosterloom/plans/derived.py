"""Inputs derived from the supplied tables.

Each text is plain SQL that Spark and an ANSI engine read alike, so a query and its check
start from the same rows.  All of them grow with the tables: seven customers form one
person (so people register repeatedly), people in pairs share a name (so name lookups can
be ambiguous), and a person whose customers owe too much is unknown to the provider.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PERSON = "cast(floor(c_custkey / 7) AS bigint)"
_PAIR = "cast(floor(c_custkey / 14) AS bigint)"
_ROUND = "cast(floor(c_custkey / 1176) AS bigint)"

_FIRST = (f"split_part('John|Jane|Alex|José|Ana|Mary Teresa|Bo|Zoë|Priya|Wei|Lars|Fatima', '|', "
          f"cast({_PAIR} % 12 + 1 AS int))")
_LAST = (f"concat(split_part('Doe|Smith|Lee|García|Müller|O''Brien|Nguyen', '|', "
         f"cast({_PAIR} % 7 + 1 AS int)), CASE WHEN {_ROUND} = 0 THEN '' ELSE "
         f"concat('-', translate(cast({_ROUND} AS string), '0123456789', 'abcdefghij')) END)")

_CHUNK = "cast(floor(c_custkey / 10000) AS bigint)"
_BATCH = (f"concat('b', lpad(cast({_CHUNK} AS string), 6, '0'), '-', "
          "lpad(cast(c_nationkey AS string), 2, '0'))")
# One batch a day, ten years round, so that batch order is time order.
_BATCH_DATE = (f"cast(DATE '2024-01-01' + cast(({_CHUNK} * 25 + c_nationkey) % 3650 AS int) "
               "AS string)")
_ROW = f"cast(c_custkey - 10000 * {_CHUNK} + 1 AS int)"

# Raw rows as a registration export holds them, before any guard.
REGISTRANTS = f"""
SELECT {_BATCH} AS batch_id, {_BATCH_DATE} AS batch_date, {_ROW} AS row_number,
       CASE WHEN c_custkey % 41 = 0 THEN 'test'
            WHEN c_custkey % 37 = 0 THEN concat('R', cast(c_custkey % 9 AS string))
            WHEN c_custkey % 43 = 0 THEN ''
            WHEN c_custkey % 47 = 0 THEN 'ana@example.com'
            WHEN c_custkey % 53 = 0 THEN '--'
            ELSE {_FIRST} END AS first_name,
       CASE WHEN c_custkey % 59 = 0 THEN ' N/A ' ELSE {_LAST} END AS last_name,
       CASE WHEN c_custkey % 6 = 0 THEN concat('User', cast({_PERSON} AS string), '@Example.com')
            WHEN c_custkey % 10 = 1 THEN 'broken@mail' ELSE '' END AS email,
       CASE WHEN c_custkey % 4 = 0 THEN 'n/a' WHEN c_custkey % 4 = 1 THEN c_mktsegment
            ELSE '' END AS company,
       CASE WHEN c_custkey % 8 = 2 THEN concat(' Nation ', cast(c_nationkey AS string))
            ELSE '' END AS location,
       CASE WHEN c_custkey % 9 = 3
                THEN concat('https://www.LinkedIn.com/in/User-', cast({_PERSON} AS string), '/?trk=1')
            WHEN c_custkey % 9 = 5
                THEN concat('http://sg.linkedin.com/in/user-', cast({_PERSON} AS string), '#top')
            WHEN c_custkey % 9 = 4 THEN 'not-a-profile' ELSE '' END AS linkedin_url,
       CASE WHEN c_custkey % 31 = 7 THEN 'opt-out' WHEN c_custkey % 5 = 0 THEN 'Yes'
            WHEN c_custkey % 29 = 1 THEN 'maybe' ELSE '' END AS consent
FROM customer"""

# One row per person the provider knows.
PROFILES = f"""
SELECT concat('p', lpad(cast(pn AS string), 9, '0')) AS person_id, pn AS person_no,
       concat('user', cast(pn AS string), '@example.com') AS email,
       concat('linkedin.com/in/user-', cast(pn AS string)) AS linkedin_url,
       lower(first_name) AS first_name,
       CASE WHEN pn % 23 = 3 THEN 'someone else' ELSE lower(last_name) END AS last_name,
       CASE WHEN pn % 17 = 5 THEN NULL WHEN pn % 23 = 3 THEN 'someone else'
            ELSE lower(concat(first_name, ' ', last_name)) END AS full_name,
       lower(segment) AS company_name,
       concat('nation ', cast(nation_no AS string)) AS country,
       CASE WHEN pn % 13 = 2 THEN NULL ELSE concat('title ', cast(pn % 19 AS string)) END AS job_title,
       cast(pn % 40 AS int) AS years_experience,
       cast(pn % 10 + 1 AS double) AS likelihood,
       cast(40 + (pn * 37) % 60 AS double) AS match_score
FROM (SELECT {_PERSON} AS pn, max({_FIRST}) AS first_name, max({_LAST}) AS last_name,
             max(c_mktsegment) AS segment, min(c_nationkey) AS nation_no,
             min(c_acctbal) AS lowest
      FROM customer GROUP BY {_PERSON}) AS people
WHERE lowest >= -400"""

# Positions held; at most seven per person because seven customer keys form a person.
EXPERIENCE = f"""
SELECT concat('p', lpad(cast({_PERSON} AS string), 9, '0')) AS person_id,
       cast(c_custkey - 7 * {_PERSON} AS int) AS position_no,
       concat('company ', cast(c_custkey % 97 AS string)) AS company_name,
       lower(c_mktsegment) AS company_industry,
       concat('nation ', cast(c_nationkey AS string)) AS company_country,
       concat('title ', cast(c_custkey % 19 AS string)) AS title_name,
       CASE WHEN c_custkey % 4 = 0 THEN 'engineering' WHEN c_custkey % 4 = 1 THEN 'sales' END AS title_role,
       CASE WHEN c_custkey % 3 = 0 THEN 'senior' ELSE '' END AS level_a,
       CASE WHEN c_custkey % 2 = 0 THEN 'senior' ELSE 'manager' END AS level_b,
       CASE WHEN c_custkey % 50 = 7 THEN '2020-13' WHEN c_custkey % 19 = 0 THEN NULL
            WHEN c_custkey % 3 = 0 THEN cast(1990 + c_custkey % 30 AS string)
            WHEN c_custkey % 3 = 1 THEN concat(cast(1990 + c_custkey % 30 AS string), '-0',
                                               cast(c_custkey % 9 + 1 AS string))
            ELSE concat(cast(1990 + c_custkey % 30 AS string), '-11-1', cast(c_custkey % 10 AS string))
            END AS start_date,
       CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 40 = 11 THEN '1985-01'
            ELSE concat(cast(1993 + c_custkey % 30 AS string), '-06') END AS end_date,
       c_custkey % 11 = 0 AS is_primary
FROM customer"""

# A person scored this high keeps the positions to themselves.
HIDDEN_EMPLOYMENT = 10.0

# Provider calls over a month, three providers, in time order.
PROVIDER_CALLS = """
SELECT event_id AS call_id, concat('prov', cast(user_id % 3 AS string)) AS provider,
       ts AS requested_at,
       CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'enrich' ELSE 'identify' END AS kind,
       CASE event_type WHEN 'error' THEN 500 WHEN 'view' THEN 404 WHEN 'signup' THEN 404
            ELSE 200 END AS http_status,
       CASE WHEN event_type IN ('purchase', 'click', 'signup') THEN 1 ELSE 0 END AS credits,
       value
FROM events"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers spread over tasks: what is made of a row costs far more than reading it."""
    return table(spark, folder, "customer").repartition("c_custkey")


def registrants(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(REGISTRANTS.replace("FROM customer", "FROM {customer}"),
                     customer=customers(spark, folder))


def profile_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(PROFILES.replace("FROM customer", "FROM {customer}"),
                     customer=customers(spark, folder))


def experience_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(EXPERIENCE.replace("FROM customer", "FROM {customer}"),
                     customer=customers(spark, folder))


def provider_calls(spark: SparkSession, folder: str) -> DataFrame:
    calls = spark.sql(PROVIDER_CALLS.replace("FROM events", "FROM {events}"),
                      events=table(spark, folder, "events"))
    return calls.withColumn("requested_at", F.col("requested_at").cast("timestamp"))


def position_struct() -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.struct(F.col("company_name").alias("name"), none.alias("id"), none.alias("website"),
                 F.col("company_industry").alias("industry"), none.alias("size"),
                 none.alias("linkedin_url"),
                 F.col("company_country").alias("location_country")).alias("company"),
        F.struct(F.col("title_name").alias("name"), F.col("title_role").alias("role"),
                 none.alias("sub_role"),
                 F.array("level_a", "level_b").alias("levels")).alias("title"),
        "start_date", "end_date", "is_primary")


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The provider's people: identifiers, scores and the nested profile document.

    Gathering positions into a list is safe here: a person has at most seven of them.
    """
    positions = (experience_rows(spark, folder)
                 .groupBy("person_id")
                 .agg(F.array_sort(F.collect_list(F.struct(
                     "position_no", position_struct().alias("e")))).alias("held")))
    people = profile_rows(spark, folder)
    none = F.lit(None).cast("string")
    profile = F.struct(
        F.col("person_id").alias("id"), "full_name", "first_name", "last_name", "linkedin_url",
        none.alias("location_name"), F.col("country").alias("location_country"),
        "job_title", none.alias("job_title_role"),
        F.when(F.col("job_title").isNotNull(), F.col("company_name")).alias("job_company_name"),
        none.alias("job_company_industry"),
        F.col("years_experience").alias("inferred_years_experience"),
        F.coalesce(F.when(F.col("likelihood") < HIDDEN_EMPLOYMENT,
                          F.transform("held", lambda h: h["e"])),
                   F.array()).alias("experience"))
    return people.join(positions, "person_id", "left").select(
        "person_id", "email", "linkedin_url", "first_name", "last_name", "full_name",
        "company_name", F.col("country").alias("location"), "likelihood", "match_score",
        profile.alias("profile"))


def faults(keys: DataFrame) -> DataFrame:
    """Recorded responses that were no answers, picked by the first digit of the key."""
    digit = F.left("lookup_key", F.lit(1))
    status = F.when(digit == "0", 500).when(digit == "1", 402).when(digit == "2", 400)
    text = F.when(digit == "1", "account maximum reached")
    return (keys.select("lookup_key").distinct()
            .select("lookup_key", status.alias("fault_status"), text.alias("provider_error"))
            .filter(F.col("fault_status").isNotNull()))
