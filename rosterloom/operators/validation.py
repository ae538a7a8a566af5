"""Row and file verdicts: cleaning, valid and rejected rows, reasons, dry run, claims."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom import vocabulary as V
from rosterloom.config import GuardLimits
from rosterloom.functions import guards as G
from rosterloom.functions.text import WHITE, normalize_url, placeholder_key, strip_space
from rosterloom.session import cut_lineage

LIMITS = GuardLimits()
CLEAN = ["first_name", "last_name", "email", "company", "location", "linkedin_url"]


def percent(fraction: Column) -> Column:
    """A share as whole percent, halves to the even number."""
    return F.concat(F.bround(fraction * 100, 0).cast("int").cast("string"), F.lit("%"))


def clean_rows(rows: DataFrame, limits: GuardLimits = LIMITS) -> DataFrame:
    """Every guard applied: cleaned columns, ``notes``, ``raw`` and ``reason`` (null if valid).

    Three projections over one scan and no shuffle.  Rows whose seven fields are all blank
    are no rows at all.
    """
    carried = [c for c in rows.columns if c not in V.INPUT_COLUMNS]
    filled = rows.filter(F.concat_ws("", *V.INPUT_COLUMNS).rlike(f"[^{WHITE}]"))
    trimmed = filled.withColumns({n: strip_space(F.coalesce(F.col(n), F.lit("")))
                                  for n in V.INPUT_COLUMNS})
    tidied = trimmed.select(*carried, F.struct(*V.INPUT_COLUMNS).alias("raw"),
                            *[G.tidy(F.col(n)).alias(n) for n in V.INPUT_COLUMNS])
    keyed = tidied.select(
        *carried, "raw", "first_name", "last_name",
        *[G.blank_to_null(F.col(n)).alias(n) for n in V.OPTIONAL_COLUMNS],
        *[placeholder_key(F.col(n)).alias(f"{n}_key")
          for n in ("first_name", "last_name", "company", "location", "consent")],
        F.when(F.col("linkedin_url") != "", normalize_url(F.col("linkedin_url"))).alias("url"))

    email, email_note = G.email_guard(F.col("email"), limits)
    url, url_note = G.linkedin_guard(F.col("url"))
    company, company_note = G.org_guard(F.col("company"), F.col("company_key"), "company", limits)
    place, place_note = G.org_guard(F.col("location"), F.col("location_key"), "location", limits)
    consent, consent_note = G.consent_parse(F.col("consent"), F.col("consent_key"))

    def described(name: str) -> Column:
        problem = G.name_problem(F.col(name), F.col(f"{name}_key"), limits)
        return F.concat(F.lit(f"{name}: "), problem)

    names = F.concat_ws("; ", described("first_name"), described("last_name"))
    return keyed.select(
        *carried, "raw", "first_name", "last_name", email.alias("email"),
        company.alias("company"), place.alias("location"), url.alias("linkedin_url"),
        consent.alias("consent"),
        G.notes(email_note, url_note, company_note, place_note, consent_note).alias("notes"),
        F.coalesce(G.blank_to_null(names), G.consent_problem(consent, limits)).alias("reason"))


def valid_rows(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("reason").isNull()).drop("raw", "reason")


def rejected_rows(cleaned: DataFrame) -> DataFrame:
    kept = [c for c in cleaned.columns if c not in (*CLEAN, "consent", "notes")]
    return cleaned.filter(F.col("reason").isNotNull()).select(*kept)


def split_valid_invalid(rows: DataFrame, limits: GuardLimits = LIMITS,
                        kept: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows that may be looked up, and rows turned away with the reason and raw fields.

    ``kept`` cleans the rows once and keeps them as a table, for plans that read them repeatedly.
    """
    cleaned = clean_rows(rows, limits)
    if kept:
        cleaned = cut_lineage(cleaned)
    return valid_rows(cleaned), rejected_rows(cleaned)


def top_reasons(rejected: DataFrame, by: Sequence[str], limit: int = 3,
                order: str = "row_number") -> DataFrame:
    """The commonest reason families per group, as ``family xN; family xN``.

    Counting comes before ranking, so a file with very many rejected rows shuffles one row
    per family and task.  Equal counts keep the order in which the families first appear.
    """
    by = list(by)
    counted = (rejected.withColumn("family", G.reason_family(F.col("reason")))
               .groupBy(*by, "family")
               .agg(F.count("*").alias("n"), F.min(order).alias("first_seen")))
    ranked = counted.withColumn("rank", F.row_number().over(
        Window.partitionBy(*by).orderBy(F.desc("n"), "first_seen"))).filter(F.col("rank") <= limit)
    text = F.concat("family", F.lit(" x"), F.col("n").cast("string"))
    # At most ``limit`` rows per group are left to gather.
    listed = F.array_sort(F.collect_list(F.struct("rank", text.alias("text"))))
    return ranked.groupBy(*by).agg(
        F.array_join(F.transform(listed, lambda s: s["text"]), "; ").alias("top_reasons"))


def file_verdict(profile: DataFrame, cleaned: DataFrame, by: str = "path",
                 limits: GuardLimits = LIMITS) -> DataFrame:
    """One row per file: counts and why the file as a whole is turned away, or null.

    ``profile`` lists the files (a file without rows still gets its verdict); its own
    ``problem``, when it has one, wins.
    """
    has_reason = F.col("reason").isNotNull()
    layout = has_reason & ~F.col("reason").startswith("consent:")
    counts = cleaned.groupBy(by).agg(
        F.count("*").alias("total"), F.count_if(has_reason).alias("invalid"),
        F.count_if(layout).alias("layout_invalid"))
    every = top_reasons(cleaned.filter(has_reason), [by]).withColumnRenamed("top_reasons", "why")
    wrong = top_reasons(cleaned.filter(layout), [by]).withColumnRenamed("top_reasons", "why_layout")
    joined = (profile.join(counts, by, "left").join(every, by, "left").join(wrong, by, "left")
              .fillna(0, ["total", "invalid", "layout_invalid"]))
    total, invalid, bad = F.col("total"), F.col("invalid"), F.col("layout_invalid")
    number = {c: F.col(c).cast("string") for c in ("total", "layout_invalid")}
    limit = f"{limits.max_invalid_fraction:.0%}"
    problem = (
        F.when(total == 0, "input has a header but no data rows")
        .when(invalid == total, F.concat(
            F.lit("no valid rows: all "), number["total"], F.lit(" data rows were rejected ("),
            F.coalesce("why", F.lit("none")), F.lit(")")))
        .when((total >= limits.min_rows_for_fraction)
              & (bad / total > limits.max_invalid_fraction), F.concat(
            number["layout_invalid"], F.lit(" of "), number["total"], F.lit(" rows rejected ("),
            percent(bad / total), F.lit(f"), above the {limit} limit; the columns probably do "
                                        "not hold what the header says ("),
            F.coalesce("why_layout", F.lit("none")), F.lit(")"))))
    if "problem" in profile.columns:
        problem = F.coalesce(F.col("problem"), problem)
    kept = [c for c in profile.columns if c != "problem"]
    return joined.select(*kept, "total", "invalid", "layout_invalid", problem.alias("problem"))


def contract_dry_run(profile: DataFrame, cleaned: DataFrame, by: str = "path",
                     limits: GuardLimits = LIMITS) -> DataFrame:
    """What would happen to each file, writing nothing: verdict and counts."""
    noted = cleaned.groupBy(by).agg(
        F.count_if(F.col("reason").isNull() & (F.size("notes") > 0)).alias("rows_with_notes"))
    verdict = file_verdict(profile, cleaned, by, limits)
    kept = [c for c in profile.columns if c not in ("problem", "content", "text")]
    return verdict.join(noted, by, "left").select(
        *kept, F.col("problem").isNull().alias("accepted"), F.col("problem").alias("reason"),
        (F.col("total") - F.col("invalid")).alias("rows_valid"),
        F.col("invalid").alias("rows_invalid"),
        F.coalesce("rows_with_notes", F.lit(0)).alias("rows_with_notes"))


def dry_run_findings(cleaned: DataFrame, by: str = "path") -> DataFrame:
    """The dry run's row details in long form: rejected rows and rows with notes."""
    return cleaned.select(
        by, "row_number",
        F.when(F.col("reason").isNotNull(), "rejected").otherwise("note").alias("finding"),
        F.coalesce("reason", F.array_join("notes", ", ")).alias("detail"),
    ).filter(F.col("detail") != "")


def batch_id_for_object(bucket: Column, key: Column, identity: Column, modified: Column) -> Column:
    """Batch id of one object version: upload time and a short hash of where it lies."""
    digest = F.sha2(F.concat(bucket, F.lit("/"), key, F.lit("@"), identity), 256)
    return F.concat(F.date_format(modified, "yyyyMMdd'T'HHmmss"), F.lit("-"), F.left(digest, F.lit(8)))


#: How long a claim is held.
CLAIM_DAYS = 90


def batch_claim(triggers: DataFrame, claims: DataFrame, days: int = CLAIM_DAYS) -> DataFrame:
    """Which trigger owns its batch: the holder of an earlier claim, else the first here.

    ``claims`` may carry ``claimed_at``; a claim that had run out when the first trigger came
    holds nothing.  Only the winner per batch is shuffled whole (the minimum is combined
    map-side).
    """
    first = triggers.groupBy("batch_id").agg(
        F.min(F.struct("triggered_at", "execution_id")).alias("w"))
    since = F.col("claimed_at") if "claimed_at" in claims.columns else F.lit(None)
    held = claims.select("batch_id", F.col("execution_id").alias("held_by"),
                         since.cast("timestamp").alias("since"))
    until = F.col("since") + F.make_dt_interval(F.lit(days))
    alive = F.col("since").isNull() | (F.col("w.triggered_at").cast("timestamp") < until)
    owners = first.join(held, "batch_id", "left").select("batch_id", F.coalesce(
        F.when(alive, F.col("held_by")), "w.execution_id").alias("owner_execution"))
    duplicate = F.col("execution_id") != F.col("owner_execution")
    return triggers.join(owners, "batch_id").select(
        *triggers.columns, duplicate.alias("duplicate"),
        F.when(duplicate, F.col("owner_execution")).otherwise("").alias("owner_execution"))


def first_claims(triggers: DataFrame, claims: DataFrame, days: int = CLAIM_DAYS) -> DataFrame:
    """The delivery that wins each batch among triggers that lie less than ``days`` apart.

    A delivery within ``days`` of the batch's last claim is a repeat.  Of the others only the
    first can win, so the minimum is combined before the shuffle, however often one is repeated.
    """
    last = claims.groupBy("batch_id").agg(F.max("triggered_at").alias("claimed_at"))
    free = F.col("claimed_at").isNull() | (
        F.col("triggered_at") >= F.col("claimed_at") + F.make_dt_interval(F.lit(days)))
    return (triggers.join(last, "batch_id", "left").filter(free).groupBy("batch_id")
            .agg(F.min(F.struct("triggered_at", "execution_id")).alias("w"))
            .select("batch_id", "w.execution_id", "w.triggered_at"))


def release_claims(claims: DataFrame, crashed: DataFrame) -> DataFrame:
    """Claims without those of crashed executions, so that a retry can claim again."""
    return claims.join(crashed.select("batch_id", "execution_id"),
                       ["batch_id", "execution_id"], "left_anti")
