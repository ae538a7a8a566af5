"""Tables at rest: raw responses, results, curated tables, exports, quarantine, manifests."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom import vocabulary as V
from rosterloom.operators.curate import OutputCheckError
from rosterloom.session import cut_lineage, side_by_side
from rosterloom.sources import snapshots
from rosterloom.sources.snapshots import Publication, Snapshot
from rosterloom.tables import CURATED, LOOKUP_RESULT, PARTITION_COLUMN, create_table_sql


def batches_of(*frames: DataFrame) -> DataFrame:
    """The batches (batch_date, batch_id) that any of the frames has rows of."""
    every = None
    for df in frames:
        own = df.select(PARTITION_COLUMN, "batch_id")
        every = own if every is None else every.unionByName(own)
    return every.distinct()


def _folder(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    folder = _folder(spark, path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


# ------------------------------------------------------------------ raw and results


def write_raw_responses(responses: DataFrame, path: str) -> None:
    """Provider answers as JSON lines below provider / batch_date."""
    parts = ["provider", PARTITION_COLUMN]
    body = F.to_json(F.struct(*[c for c in responses.columns if c not in parts]))
    (responses.select(*parts, body.alias("value")).write.mode("append")
     .partitionBy(*parts).text(path))


def raw_ref() -> Column:
    """Where an answer lies, from its provider, date, batch and key."""
    return F.concat(F.lit("raw/provider="), "provider", F.lit("/batch_date="), PARTITION_COLUMN,
                    F.lit("/batch_id="), "batch_id", F.lit("/"), "lookup_key", F.lit(".json"))


def erase_raw_responses(spark: SparkSession, path: str, refs: DataFrame) -> None:
    """Rewrites the dates that hold answers named in ``refs`` (raw_ref) without them."""
    lines = _raw_lines(spark, path).withColumn("raw_ref", raw_ref())
    touched = lines.join(refs, "raw_ref", "left_semi").select(
        "provider", PARTITION_COLUMN).distinct()
    touched = cut_lineage(touched)
    kept = cut_lineage(lines.join(touched, ["provider", PARTITION_COLUMN], "left_semi")
                       .join(refs, "raw_ref", "left_anti")
                       .select("provider", PARTITION_COLUMN, "value"))
    (kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("provider", PARTITION_COLUMN).text(path))
    emptied = touched.join(kept.select("provider", PARTITION_COLUMN).distinct(),
                           ["provider", PARTITION_COLUMN], "left_anti")
    for row in emptied.toLocalIterator():
        folder = _folder(spark, f"{path}/provider={row[0]}/{PARTITION_COLUMN}={row[1]}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _raw_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.schema("value string, provider string, batch_date string").text(path)
    named = F.from_json("value", "batch_id string, lookup_key string")
    return lines.select("*", named.alias("n")).select("provider", PARTITION_COLUMN, "value", "n.*")


def raw_responses(spark: SparkSession, path: str) -> DataFrame:
    """Stored answers with their partitions; ``body`` is VARIANT, since its schema is open."""
    schema = ("batch_id string, lookup_key string, method string, kind string, attempts int, "
              "requested_at string, http_status int, headers map<string,string>, body string")
    lines = spark.read.schema("value string, provider string, batch_date string").text(path)
    read = F.from_json("value", schema)
    return (lines.select("provider", PARTITION_COLUMN, read.alias("r"))
            .select("provider", PARTITION_COLUMN, "r.*").withColumn("raw_ref", raw_ref())
            .withColumn("body", F.try_parse_json("body")))


def write_lookup_results(results: DataFrame, path: str, built: DataFrame | None = None,
                         into: Publication | None = None) -> None:
    """Replaces the results of the batches in ``built``, by default those with rows.

    Here and below, with ``into`` the write waits for that publication's commit.
    """
    stored, spark = results.select(*LOOKUP_RESULT.fieldNames()), results.sparkSession
    publication = into or Publication(spark, path)
    publication.put("lookup_results", stored, batches_of(stored) if built is None else built,
                    lambda at: lookup_results(spark, path, at=at),
                    lambda w, target: w.parquet(target))
    if into is None:
        publication.commit()


def lookup_results(spark: SparkSession, path: str, batch_prefix: str | None = None,
                   at: Snapshot | None = None) -> DataFrame:
    """Stored results; files are sorted by batch, so a prefix reads little of them."""
    results = snapshots.read(spark, path, "lookup_results", LOOKUP_RESULT,
                             lambda reader, live: reader.parquet(*live), at)
    return results if batch_prefix is None else results.filter(
        F.col("batch_id").startswith(batch_prefix))


# ------------------------------------------------------------------ curated tables


def write_curated(tables: dict[str, DataFrame], path: str, built: DataFrame | None = None,
                  into: Publication | None = None) -> None:
    """Replaces the batches in ``built`` in all tables, by default those with rows in a table.

    Name the batches where one may have become empty.  All tables change in one commit.
    """
    spark = next(iter(tables.values())).sparkSession
    publication = into or Publication(spark, path)

    def put(name: str, df: DataFrame) -> None:
        stored = df.select(*CURATED[name].fieldNames(), PARTITION_COLUMN)
        publication.put(name, stored, batches_of(stored) if built is None else built,
                        lambda at: read_curated(spark, path, name, at), _write_curated)

    side_by_side(spark, *[functools.partial(put, *table) for table in tables.items()])
    if into is None:
        publication.commit()


def _write_curated(writer: DataFrameWriter, target: str) -> None:
    writer.option("compression", "snappy").parquet(target)


def read_curated(spark: SparkSession, path: str, name: str,
                 at: Snapshot | None = None) -> DataFrame:
    """One table in declared column order, with its partition column; empty ones included."""
    stored = T.StructType([*CURATED[name].fields, T.StructField(PARTITION_COLUMN, T.StringType())])
    return snapshots.read(spark, path, name, stored, lambda reader, live: reader.parquet(*live), at)


def _columns(spark: SparkSession, path: str, name: str) -> list[str]:
    """Column names in the files themselves, without the partition column."""
    live = snapshots.flat(snapshots.snapshot(spark, path).folders(path, name))
    return spark.read.parquet(*live).columns if live else CURATED[name].fieldNames()


def verify_written(spark: SparkSession, path: str, expected: dict[str, DataFrame]) -> DataFrame:
    """Differences between what was meant and what lies there: table, problem.

    ``expected``: per table a DataFrame of batch_id, rows.  Row counts read no column but
    batch_id, and the columns come from the files themselves.
    """
    found = None
    for name, wanted in expected.items():
        written = _columns(spark, path, name)
        actual = read_curated(spark, path, name).groupBy("batch_id").agg(
            F.count("*").alias("actual"))
        off = (wanted.join(actual, "batch_id", "full").fillna(0, ["rows", "actual"])
               .filter(F.col("rows") != F.col("actual"))
               .select(F.lit(name).alias("table"), F.concat(
                   "batch_id", F.lit(" holds "), F.col("actual").cast("string"),
                   F.lit(" rows, expected "), F.col("rows").cast("string")).alias("problem")))
        if written != CURATED[name].fieldNames():
            off = off.unionByName(spark.createDataFrame(
                [(name, "columns differ from the declared schema")],
                "table string, problem string"))
        found = off if found is None else found.unionByName(off)
    return found


def require_written(problems: DataFrame) -> None:
    first = problems.limit(1).collect()
    if first:
        raise OutputCheckError(f"{first[0]['table']}: {first[0]['problem']}")


def catalog_tables(spark: SparkSession, path: str, database: str | None = None) -> list[str]:
    """Makes the curated tables queryable by name.

    With a database: external tables whose partitions are the folders that are live now; as a
    partition has one folder, days that lie in several are brought into one first, in a commit.
    Without one: temporary views over the paths.
    """
    if database is None:
        for name in CURATED:
            read_curated(spark, path, name).createOrReplaceTempView(name)
        return list(CURATED)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    publication = Publication(spark, path)
    if any([publication.in_one_folder(n, lambda at, n=n: read_curated(spark, path, n, at),
                                      _write_curated) for n in CURATED]):
        publication.commit()
    shown = snapshots.snapshot(spark, path)
    for name in CURATED:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(create_table_sql(name, f"{path}/data/{name}", database))
        parts = [f"PARTITION ({day.replace('=', "='", 1)}') LOCATION '{folder}'"
                 for day, (folder,) in shown.folders(path, name).items()]
        if parts:
            spark.sql(f"ALTER TABLE {database}.{name} ADD {' '.join(parts)}")
    return [f"{database}.{name}" for name in CURATED]


# ------------------------------------------------------------------ exports


def rejected_export(rejected: DataFrame) -> DataFrame:
    """Rejected rows as the source owner gets them back: number, reason, raw fields."""
    raw = F.col("raw")
    return rejected.select("batch_id", "row_number", "reason",
                           *[raw[n].alias(n) for n in V.INPUT_COLUMNS], PARTITION_COLUMN)


#: Columns of the export's files, and the date that is its folder.
EXPORT = ("batch_id string, row_number int, reason string, "
          + ", ".join(f"{n} string" for n in V.INPUT_COLUMNS) + f", {PARTITION_COLUMN} string")


def rejected_rows_export(rejected: DataFrame, path: str, built: DataFrame | None = None,
                         into: Publication | None = None) -> None:
    """CSV files by date, rows by batch and in file order; replaces the batches in ``built``."""
    export, spark = rejected_export(rejected), rejected.sparkSession
    publication = into or Publication(spark, path)
    publication.put("rejected", export, batches_of(export) if built is None else built,
                    lambda at: read_export(spark, path, at),
                    lambda w, target: w.option("header", "true").option("escape", '"').csv(target))
    if into is None:
        publication.commit()


def read_export(spark: SparkSession, path: str, at: Snapshot | None = None) -> DataFrame:
    return snapshots.read(spark, path, "rejected", EXPORT, lambda reader, live: reader.option(
        "header", "true").option("escape", '"').csv(live), at)


def quarantine_files(files: DataFrame, verdict: DataFrame) -> DataFrame:
    """Turned-away files with their bytes, the reason, where they came from and when."""
    refused = verdict.filter(F.col("problem").isNotNull()).select(
        "path", F.col("problem").alias("reason"))
    kept = F.concat(F.date_format("modificationTime", "yyyyMMdd'T'HHmmss"), F.lit("-"),
                    F.element_at(F.split("path", "/"), -1))
    return files.join(refused, "path").select(
        kept.alias("path"), "modificationTime", "length", "content", "reason",
        F.col("path").alias("source"), F.col("modificationTime").alias("at"))


def redrive(quarantined: DataFrame, names: DataFrame, stamp: str) -> DataFrame:
    """Chosen quarantined files as new landed files, under a new path."""
    bare = F.regexp_replace("path", r"\A[^-]*-", "")
    return quarantined.join(names, "path", "left_semi").select(
        F.concat(F.lit(f"incoming/redrive/{stamp}/"), bare).alias("path"), "modificationTime",
        "length", "content")


def manifest_rows(quality: DataFrame, flag_counts: DataFrame | None = None) -> DataFrame:
    """One JSON document per batch: counts, credits, quality and where its tables lie."""
    counts = F.create_map(*[x for s in V.STATUSES if s != "invalid_input"
                            for x in (F.lit(s), F.col(s))], F.lit("invalid_input"),
                          F.col("rows_invalid"))
    present = F.map_filter(counts, lambda _, n: n > 0)
    report = F.struct(
        "rows_valid", "rows_invalid", "match_rate", "flagged_matches", "warnings",
        "warning_count", F.when(F.size("warnings") > 0, F.array_join("warnings", "; "))
        .otherwise("none").alias("notes"))
    files = F.create_map(*[x for t in CURATED for x in (F.lit(t), F.concat(
        F.lit(f"curated/{t}/batch_date="), "batch_date"))])
    body = F.struct(
        "batch_id", "batch_date", "provider", "pipeline_version", "rows_valid", "rows_invalid",
        "rows_unrecorded", present.alias("status_counts"), "credits_spent", "persons",
        "employment_rows", report.alias("quality"), files.alias("files"), "built_at")
    return quality.select("batch_id", PARTITION_COLUMN, F.to_json(body).alias("value"))


def manifest(quality: DataFrame, path: str, built: DataFrame | None = None,
             into: Publication | None = None) -> None:
    """JSON lines by date, one for each batch; replaces the batches in ``built``."""
    lines, spark = manifest_rows(quality), quality.sparkSession
    stored = lines.select("value", PARTITION_COLUMN, "batch_id")
    publication = into or Publication(spark, path)
    publication.put("manifest", stored, batches_of(stored) if built is None else built,
                    lambda at: read_manifests(spark, path, at), lambda w, target: w.text(target),
                    ["value", PARTITION_COLUMN])
    if into is None:
        publication.commit()


def read_manifests(spark: SparkSession, path: str, at: Snapshot | None = None) -> DataFrame:
    lines = snapshots.read(spark, path, "manifest", f"value string, {PARTITION_COLUMN} string",
                           lambda reader, live: reader.text(live), at)
    return lines.withColumn("batch_id", F.get_json_object("value", "$.batch_id"))
