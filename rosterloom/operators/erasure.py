"""Right to erasure, many subjects per job.

``requests``: request_id, person_id, email, first_name, last_name (any may be null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.functions.text import fold_text, normalize_email

ROW = ["batch_id", "row_number"]


def name_subject(full_name: Column) -> tuple[Column, Column]:
    """First and last name of ``First Middle Last``: split at the last blank."""
    words = F.filter(F.split(F.trim(full_name), r"\s+"), lambda w: w != "")
    enough = F.size(words) >= 2
    first = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), " ")
    return F.when(enough, first), F.when(enough, F.element_at(words, -1))


def usable_requests(requests: DataFrame) -> DataFrame:
    """Requests that name somebody: an id, an e-mail, or a first and a last name."""

    def given(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) != ""

    return requests.filter(given("person_id") | given("email")
                           | (given("first_name") & given("last_name")))


def _identities(df: DataFrame, email: Column, first: Column, last: Column,
                person_id: Column, *carry: str) -> DataFrame:
    """Long form: one row per identity a record or a request is known by.

    A name counts only when both parts are there.
    """
    keyed = df.select(*carry, person_id.alias("_id"), normalize_email(email).alias("_email"),
                      fold_text(first).alias("_first"), fold_text(last).alias("_last"))
    named = (F.col("_first") != "") & (F.col("_last") != "")
    entries = F.array(
        F.struct(F.lit("id").alias("by"), F.col("_id").alias("identity")),
        F.struct(F.lit("email").alias("by"),
                 F.when(F.col("_email") != "", F.col("_email")).alias("identity")),
        F.struct(F.lit("name").alias("by"),
                 F.when(named, F.concat_ws("\n", "_first", "_last")).alias("identity")))
    return keyed.select(*carry, F.inline(F.filter(entries, lambda e: F.coalesce(
        e["identity"], F.lit("")) != "")))


def subject_match(requests: DataFrame, rows: DataFrame, rejected: DataFrame,
                  results: DataFrame) -> DataFrame:
    """(request_id, batch_id, row_number, part): rows of any layer that hold a subject.

    ``part`` is ``row`` or ``rejected``.  Every record and request is brought to its
    identities first, so one equi-join finds id, e-mail and name matches; an OR over the
    three would be a nested loop.
    """
    records = _records(rows, rejected, results, *ROW)
    wanted = _identities(usable_requests(requests), F.col("email"), F.col("first_name"),
                         F.col("last_name"), F.col("person_id"), "request_id").distinct()
    return (records.join(wanted, ["by", "identity"])
            .select("request_id", *ROW, "part").distinct())


def _records(rows: DataFrame, rejected: DataFrame, results: DataFrame, *carry: str) -> DataFrame:
    """Identities of all records of the layers, and the ``part`` a record is of."""
    none = F.lit(None).cast("string")
    raw = F.col("raw")
    tagged = rejected.select(*carry, raw["email"].alias("email"),
                             raw["first_name"].alias("first_name"),
                             raw["last_name"].alias("last_name"))
    part = F.lit("row")
    return (
        _identities(rows, F.col("email"), F.col("first_name"), F.col("last_name"), none, *carry)
        .withColumn("part", part)
        .unionByName(_identities(tagged, F.col("email"), F.col("first_name"),
                                 F.col("last_name"), none, *carry)
                     .withColumn("part", F.lit("rejected")))
        .unionByName(_identities(results, F.col("email"), F.col("first_name"),
                                 F.col("last_name"), F.col("profile.id"), *carry)
                     .withColumn("part", part)))


def _key() -> Column:
    return F.xxhash64("by", "identity").alias("key")


def identity_entries(rows: DataFrame, rejected: DataFrame, results: DataFrame) -> DataFrame:
    """(key, batch_date, batch_id): which batches hold which identities, as hashes."""
    own = ["batch_date", "batch_id"]
    return _records(rows, rejected, results, *own).select(_key(), *own).distinct()


def request_keys(requests: DataFrame) -> DataFrame:
    """Hashes of what the requests' subjects are known by."""
    return _identities(usable_requests(requests), F.col("email"), F.col("first_name"),
                       F.col("last_name"), F.col("person_id")).select(_key()).distinct()


def erasure_items(matches: DataFrame, results: DataFrame, sources: DataFrame) -> DataFrame:
    """The dry run in long form: request_id, batch_id, item, value.

    Items are rows, rejected rows, cache keys, raw references and the operator's uploads that
    still hold the person.  Long form keeps a subject found in very many rows distributed.
    """
    number = F.col("row_number").cast("string")
    held = matches.filter(F.col("part") == "row").join(
        results.select(*ROW, "lookup_key", "raw_ref"), ROW)
    parts = [
        matches.select("request_id", "batch_id", F.when(F.col("part") == "row", "row")
                       .otherwise("rejected_row").alias("item"), number.alias("value")),
        held.select("request_id", "batch_id", F.lit("lookup_key").alias("item"),
                    F.col("lookup_key").alias("value")),
        held.select("request_id", "batch_id", F.lit("raw_ref").alias("item"),
                    F.col("raw_ref").alias("value")),
        matches.select("request_id", "batch_id").distinct().join(sources, "batch_id").select(
            "request_id", "batch_id", F.lit("source").alias("item"),
            F.col("source").alias("value")),
    ]
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every.filter(F.col("value").isNotNull()).distinct()


def erasure_plan(items: DataFrame) -> DataFrame:
    """What each batch holds about each subject, as counts."""

    def many(item: str, name: str) -> Column:
        return F.count_if(F.col("item") == item).alias(name)

    return items.groupBy("request_id", "batch_id").agg(
        many("row", "rows"), many("rejected_row", "rejected_rows"),
        many("lookup_key", "lookup_keys"), many("raw_ref", "raw_refs"), many("source", "sources"))


def erase_rows(table: DataFrame, matches: DataFrame, part: str = "row") -> DataFrame:
    """The table without the subjects' rows."""
    gone = matches.filter(F.col("part") == part).select(*ROW).distinct()
    return table.join(gone, ROW, "left_anti")


def affected(table: DataFrame, batches: DataFrame) -> DataFrame:
    """Only the rows of touched batches: what a dynamic overwrite has to write again."""
    return table.join(batches.select("batch_id").distinct(), "batch_id", "left_semi")


def erase_raw(raw: DataFrame, items: DataFrame) -> DataFrame:
    """Raw answers without those any erased row points at, also those paid by other batches."""
    refs = items.filter(F.col("item") == "raw_ref").select(F.col("value").alias("raw_ref"))
    return raw.join(refs.distinct(), "raw_ref", "left_anti")


def purge_cache(cache: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cache without the erased keys, the entries that really went, per request)."""
    keys = items.filter(F.col("item") == "lookup_key").select(
        "request_id", F.col("value").alias("lookup_key")).distinct()
    left = cache.join(keys.select("lookup_key").distinct(), "lookup_key", "left_anti")
    present = cache.select("lookup_key").join(keys, "lookup_key")
    # A key two requests share goes once: the first request counts it.
    gone = present.groupBy("lookup_key").agg(F.min("request_id").alias("request_id"))
    return left, gone


def subject_digest() -> Column:
    """What a tombstone keeps instead of the identity."""
    return F.sha2(F.concat_ws(
        "|", F.coalesce("person_id", F.lit("")), normalize_email(F.col("email")),
        fold_text(F.col("first_name")), fold_text(F.col("last_name"))), 256)


def tombstone(requests: DataFrame, items: DataFrame, gone: DataFrame, actor: str,
              at: Column) -> DataFrame:
    """One row per request, found or not: counts, actor and the identity's hash."""
    found = items.groupBy("request_id").agg(
        F.countDistinct("batch_id").alias("batches"),
        F.count_if(F.col("item").isin("row", "rejected_row")).alias("rows_erased"),
        F.countDistinct(F.when(F.col("item") == "raw_ref", F.col("value"))).alias("raw_objects"))
    deleted = gone.groupBy("request_id").agg(F.count("*").alias("cache_items_deleted"))
    return (usable_requests(requests)
            .select("request_id", subject_digest().alias("subject_digest"))
            .join(found, "request_id", "left").join(deleted, "request_id", "left")
            .fillna(0, ["batches", "rows_erased", "raw_objects", "cache_items_deleted"])
            .withColumn("actor", F.lit(actor)).withColumn("at", at))
