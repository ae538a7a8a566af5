"""Secret scan with corpus-wide ownership frequency, in Spark functions only.

Every text is searched for assignments, access keys and long hex runs (the base spans).  Splitting a
text at its matches gives the lengths between them, and running sums of lengths give the code-point
positions.  Then the digests of all values are counted over distinct repositories and owners:
values that many owners hold are examples copied from somewhere; values that few owners hold and
that look random are live-looking credentials.  Bare tokens anywhere in the corpus that equal a
live-looking value become spans of that value's kind (the added spans), unless they overlap a
base span of their document.

The owner is the part of the repository name before the first slash, or the whole name.  A null
repository counts as one repository and owner of its own.  Null texts count as empty; empty texts
have no spans.  Repeated rows stay rows of the result and don't change the counts of distinct
owners.  A value of several kinds adds spans of the kind listed first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import read
from rosterloom.session import cut_lineage

# Kinds as listed, their patterns, the group that holds the value, least lengths.
KINDS = ["assign", "access", "hex"]
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
              r"""([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
GROUP = {"assign": 2, "access": 0, "hex": 0}
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Whole tokens of the value alphabet that are long enough and hold a digit and a letter.
BARE = (r"(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z+/_.=-]*[0-9])(?=[0-9+/_.=-]*[A-Za-z])"
        r"[A-Za-z0-9+/_.=-]{12,}+")

#: A value that so many owners hold is an example.
EXAMPLE_OWNERS = 3
#: Of a live-looking value the characters differ at least so much.
LEAST_DISTINCT = 8
#: Words that mark a value as a stand-in.
STAND_INS = "(?i)example|sample|changeme|placeholder|your|dummy|test|xxxx|0000000|1234567"

SPAN = "struct<start:int,end:int,no:int,kind:string,value:string>"
BLOCK = 256


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluates ``value`` once and hands it on; a plain reference would repeat it in lambdas."""
    return F.transform(F.array(value), use)[0]


def _each(items: Column, use: Callable[[Column], Column]) -> Column:
    return F.transform(items, lambda x: use(x))


def _starts(lengths: Column) -> Column:
    """Running sums before each element, by blocks, so that many elements cost little."""
    zero = F.lit(0)

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda s, x: s + x)

    def with_lengths(n: Column) -> Column:
        numbers = F.sequence(zero, F.floor((F.size(n) - 1) / BLOCK).cast("int"))
        sums = F.transform(numbers, lambda b: total(F.slice(n, b * BLOCK + 1, F.lit(BLOCK))))
        return _let(sums, lambda s: F.flatten(F.transform(numbers, lambda b: _let(
            F.struct(total(F.slice(s, F.lit(1), b)).alias("base"),
                     F.slice(n, b * BLOCK + 1, F.lit(BLOCK)).alias("own")),
            lambda x: F.transform(F.sequence(zero, F.size(x["own"]) - 1), lambda i: (
                x["base"] + total(F.slice(x["own"], F.lit(1), i))))))))

    return F.when(F.size(lengths) > 0, with_lengths(lengths)).otherwise(
        F.array().cast("array<int>"))


def located(text: Column, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches as structs (start, end, value), code points; matches
    whose value is shorter than ``least`` are dropped afterwards."""
    found = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def placed(f: Column) -> Column:
        lengths = F.transform(f["whole"], lambda m, i: F.char_length(f["between"][i])
                              + F.char_length(m))
        return _let(_starts(lengths), lambda s: F.filter(
            F.transform(f["value"], lambda v, i: F.struct(
                (s[i] + F.char_length(f["between"][i])).alias("start"),
                (s[i] + F.char_length(f["between"][i]) + F.char_length(f["whole"][i]))
                .alias("end"), v.alias("value"))),
            lambda x: F.char_length(x["value"]) >= least))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), _let(found, placed)).otherwise(none)


def _base(text: Column) -> Column:
    """All base spans of a text, by start and then kind as listed."""
    # A run shorter than the least length can't be a match, and tells cheaply that none is there.
    cheap = {"assign": PATTERNS["assign"], "access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}"}
    parts = []
    for no, k in enumerate(KINDS):
        def named(x: Column, no: int = no, k: str = k) -> Column:
            return F.struct(x["start"], x["end"], F.lit(no).alias("no"), F.lit(k).alias("kind"),
                            x["value"])
        found = located(text, PATTERNS[k] if k == "assign" else cheap[k], GROUP[k], LEAST[k])
        parts.append(F.when(text.rlike(cheap[k]), _each(found, named))
            .otherwise(F.array().cast(f"array<{SPAN}>")))
    return F.array_sort(F.concat(*parts), lambda a, b: F.when(
        a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["no"] - b["no"]))


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def ownership(spans: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """For each digest of a value: kind, n_repos, n_owners, n_spans, verdict.

    ``spans`` has digest, no, kind, live_looking, repo, owner, one row for each span.
    """
    # Copies inside one repository are combined first, so a hot value costs a row for each of
    # its repositories, not for each of its copies.
    by_repo = spans.groupBy("digest", "repo", "owner").agg(
        F.count("*").alias("n"), F.min(F.struct("no", "kind")).alias("first"),
        F.max("live_looking").alias("live_looking"))
    seen = by_repo.groupBy("digest").agg(
        F.min("first")["kind"].alias("kind"), F.min("first")["no"].alias("no"),
        F.count_distinct(F.coalesce("repo", F.lit("\u0000"))).alias("n_repos"),
        F.count_distinct(F.coalesce("owner", F.lit("\u0000"))).alias("n_owners"),
        F.sum("n").alias("n_spans"), F.max("live_looking").alias("live_looking"))
    return seen.withColumn("verdict", F.when(F.col("n_owners") >= example_owners, "example")
                           .when(F.col("live_looking"), "live").otherwise("plain"))


def live_looking(value: Column) -> Column:
    characters = F.size(F.array_distinct(F.split(value, "")))
    return (characters >= LEAST_DISTINCT) & ~value.rlike(STAND_INS)


def scan(docs: DataFrame, keep: list[str], text: str = "text", repo: str = "source",
         example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """The columns ``keep`` of every row plus base and added spans and spans by verdict.

    ``base`` and ``added`` are arrays of (start, end, no, kind, digest); ``live`` has those of
    them whose value is live-looking and owned by few, ``examples`` those held by many.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(repo).alias("repo"),
        _base(body).alias("base"), located(body, BARE, 0, LEAST["assign"]).alias("bare"))
    # Values are replaced by their digests before anything is written.
    slim = found.select(
        *[f"k{i}" for i in range(len(keep))], "repo",
        F.transform("base", lambda x: F.struct(
            x["start"], x["end"], x["no"], x["kind"], digest(x["value"]).alias("digest"),
            live_looking(x["value"]).alias("live_looking"))).alias("base"),
        F.transform("bare", lambda x: F.struct(
            x["start"], x["end"], digest(x["value"]).alias("digest"))).alias("bare"))
    rows = cut_lineage(slim.withColumn("row", F.monotonically_increasing_id()))

    owner = F.substring_index("repo", "/", 1)
    spans = rows.select("repo", owner.alias("owner"), F.explode("base").alias("x")).select(
        "repo", "owner", "x.digest", "x.no", "x.kind", "x.live_looking")
    known = cut_lineage(ownership(spans, example_owners))

    at = rows.select("row", F.explode("base").alias("x")).select("row", "x.*")
    judged = (at.join(known.select("digest", "verdict"), "digest")
              .where("verdict <> 'plain'")
              .select("row", "verdict", F.lit(False).alias("is_added"),
                      F.struct("start", "end", "no", "kind", "digest").alias("span")))
    clear = ~F.exists("base", lambda b: (b["start"] < F.col("x.end"))
                      & (F.col("x.start") < b["end"]))
    bare = (rows.where(F.size("bare") > 0)
            .select("row", "base", F.explode("bare").alias("x")).where(clear)
            .select("row", "x.start", "x.end", "x.digest")
            .join(known.where("verdict = 'live'").select("digest", "no", "kind"), "digest")
            .select("row", F.lit("live").alias("verdict"), F.lit(True).alias("is_added"),
                    F.struct("start", "end", "no", "kind", "digest").alias("span")))
    per_row = judged.unionByName(bare).groupBy("row").agg(
        *[F.array_sort(F.collect_list(F.when(when, F.col("span")))).alias(name)
          for name, when in (("added", F.col("is_added")),
                             ("live", F.col("verdict") == "live"),
                             ("examples", F.col("verdict") == "example"))])
    none = F.array().cast(per_row.schema["added"].dataType)
    return rows.join(per_row, "row", "left").select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        F.transform("base", lambda x: F.struct(x["start"], x["end"], x["no"], x["kind"],
                                               x["digest"])).alias("base"),
        *[F.coalesce(c, none).alias(c) for c in ("added", "live", "examples")])


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(docs: DataFrame, text: str = "text", repo: str = "source",
             mask: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with live-looking credentials masked; examples stay.

    Spans depend on the text and the corpus, so they come back by the text's digest.
    """
    marked = docs.withColumn("__digest", F.sha2(text, 256))
    found = (scan(marked, ["__digest"], text, repo).where(F.size("live") > 0)
             .select("__digest", F.col("live").alias("__live")).dropDuplicates(["__digest"]))
    merged = F.aggregate("__live", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
                         lambda s, x: F.when(x["end"] <= s["at"], s).otherwise(F.struct(
                             x["end"].alias("at"),
                             F.concat(s["out"], F.when(
                                 x["start"] < s["at"], F.lit("")).otherwise(F.concat(
                                     F.substring(F.col(text), s["at"] + 1, x["start"] - s["at"]),
                                     F.lit(mask)))).alias("out"))),
                         lambda s: F.concat(s["out"], F.substring(
                             F.col(text), s["at"] + 1, F.char_length(text))))
    joined = marked.join(found, "__digest", "left")
    return joined.withColumn(text, F.when(F.col("__live").isNull(), F.col(text))
                             .otherwise(merged)).select(*docs.columns)


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(read(spark, folder, "documents", "doc_id", "text", "source"), ["doc_id"])
    everything = F.array_sort(F.concat("base", "added"), lambda a, b: F.when(
        a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["no"] - b["no"]))
    return found.select(
        "doc_id",
        *[F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}")
          for k in KINDS],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(everything).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        F.size("examples").cast("long").alias("n_examples"))
