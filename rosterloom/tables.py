"""The curated tables as Spark schemas, and the helpers that keep DataFrames on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMN = "batch_date"
DATABASE_NAME = "rosterloom"


TEXT, WHOLE, REAL = T.StringType(), T.IntegerType(), T.DoubleType()
FLAG, TIME, TEXTS = T.BooleanType(), T.TimestampType(), T.ArrayType(T.StringType())


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# Column names, order and types of the published tables.
CURATED = {
    "dim_person": _table(
        ("person_id", TEXT), ("provider", TEXT), ("batch_id", TEXT), ("input_row_number", WHOLE),
        ("input_first_name", TEXT), ("input_last_name", TEXT), ("input_email", TEXT),
        ("full_name", TEXT), ("first_name", TEXT), ("last_name", TEXT), ("linkedin_url", TEXT),
        ("location_country", TEXT), ("location_name", TEXT), ("current_job_title", TEXT),
        ("current_job_title_role", TEXT), ("current_company_name", TEXT),
        ("current_company_industry", TEXT), ("inferred_years_experience", WHOLE),
        ("match_likelihood", REAL), ("lookup_method", TEXT), ("quality_flags", TEXTS),
        ("pipeline_version", TEXT), ("enriched_at", TIME)),
    "fact_employment": _table(
        ("person_id", TEXT), ("batch_id", TEXT), ("sequence_no", WHOLE), ("company_name", TEXT),
        ("company_id", TEXT), ("company_website", TEXT), ("company_linkedin_url", TEXT),
        ("company_industry", TEXT), ("company_size", TEXT), ("company_location_country", TEXT),
        ("title_name", TEXT), ("title_role", TEXT), ("title_sub_role", TEXT),
        ("title_levels", TEXTS), ("start_date", TEXT), ("end_date", TEXT), ("start_year", WHOLE),
        ("is_current", FLAG), ("pipeline_version", TEXT)),
    "fact_lookup": _table(
        ("batch_id", TEXT), ("row_number", WHOLE), ("input_first_name", TEXT),
        ("input_last_name", TEXT), ("input_email", TEXT), ("input_company", TEXT),
        ("lookup_key", TEXT), ("status", TEXT), ("lookup_method", TEXT), ("person_id", TEXT),
        ("likelihood", REAL), ("candidates", WHOLE), ("http_status", WHOLE),
        ("error_message", TEXT), ("credits_consumed", WHOLE), ("attempts", WHOLE),
        ("provider", TEXT), ("raw_ref", TEXT), ("quality_flags", TEXTS),
        ("pipeline_version", TEXT), ("requested_at", TIME)),
    "fact_batch_quality": _table(
        ("batch_id", TEXT), ("provider", TEXT), ("pipeline_version", TEXT),
        ("rows_valid", WHOLE), ("rows_invalid", WHOLE), ("rows_unrecorded", WHOLE),
        ("matched", WHOLE), ("cached", WHOLE), ("not_found", WHOLE), ("ambiguous", WHOLE),
        ("budget_deferred", WHOLE), ("provider_unavailable", WHOLE), ("error", WHOLE),
        ("match_rate", REAL), ("flagged_matches", WHOLE), ("warning_count", WHOLE),
        ("warnings", TEXTS), ("credits_spent", WHOLE), ("persons", WHOLE),
        ("employment_rows", WHOLE), ("built_at", TIME)),
}

COMPANY = T.StructType([T.StructField(n, T.StringType()) for n in (
    "name", "id", "website", "industry", "size", "linkedin_url", "location_country")])
TITLE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("name", "role", "sub_role")]
    + [T.StructField("levels", T.ArrayType(T.StringType()))])
EXPERIENCE = T.StructType([
    T.StructField("company", COMPANY), T.StructField("title", TITLE),
    T.StructField("start_date", T.StringType()), T.StructField("end_date", T.StringType()),
    T.StructField("is_primary", T.BooleanType())])
PROFILE = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "id", "full_name", "first_name", "last_name", "linkedin_url", "location_name",
        "location_country", "job_title", "job_title_role", "job_company_name",
        "job_company_industry")]
    + [T.StructField("inferred_years_experience", T.IntegerType()),
       T.StructField("experience", T.ArrayType(EXPERIENCE))])


# One row per valid input row, as stored between the lookup and the curated build.
LOOKUP_RESULT = T.StructType(
    [*_table(
        ("batch_id", TEXT), ("batch_date", TEXT), ("row_number", WHOLE), ("first_name", TEXT),
        ("last_name", TEXT), ("email", TEXT), ("company", TEXT), ("location", TEXT),
        ("linkedin_url", TEXT), ("notes", TEXTS), ("lookup_key", TEXT), ("status", TEXT),
        ("provider", TEXT), ("lookup_method", TEXT), ("call_kind", TEXT)).fields,
     T.StructField("profile", PROFILE),
     *_table(
        ("likelihood", REAL), ("candidates", WHOLE), ("http_status", WHOLE),
        ("error_message", TEXT), ("credits_consumed", WHOLE), ("attempts", WHOLE),
        ("raw_ref", TEXT), ("match_flags", TEXTS), ("requested_at", TIME)).fields])


class SchemaMismatch(KeyError):
    """A DataFrame carries a column its curated table does not declare."""


def conform_schema(df: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Declared columns in declared order and type; missing ones null, unknown ones refused.

    ``keep`` names carrier columns (the partition column) that ride along behind.
    """
    schema = CURATED[table]
    unknown = sorted(set(df.columns) - set(schema.fieldNames()) - set(keep))
    if unknown:
        raise SchemaMismatch(f"{table}: unknown column(s) {unknown}")

    # ``DataFrame.to`` reorders, casts and fills in the nullable columns that are missing.
    carried = [f for f in df.schema.fields if f.name in keep]
    return df.to(T.StructType([*schema.fields, *carried]))


def stamp_version(df: DataFrame, version: str, **times: Column) -> DataFrame:
    """Mark each row with the version that produced it and with UTC times cut to the ms."""
    stamped = df.withColumn("pipeline_version", F.lit(version))
    for name, value in times.items():
        stamped = stamped.withColumn(name, F.date_trunc("millisecond", value.cast("timestamp")))
    return stamped


def create_table_sql(table: str, location: str, database: str = DATABASE_NAME) -> str:
    """DDL of one external Parquet table, rendered from the same schema the writer uses."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CURATED[table].fields)
    return (f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}, {PARTITION_COLUMN} string) "
            f"USING parquet PARTITIONED BY ({PARTITION_COLUMN}) LOCATION '{location}'")
