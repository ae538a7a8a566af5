"""Landed CSV files: pick up, profile, split, map headers, number rows.

Files differ in encoding, delimiter and header, so one ``spark.read.csv`` cannot read them
together, and a read per layout would loop on the driver.  Most landed files are small, so here each
is handled as one row: bytes are judged and decoded by native expressions, the standard CSV
reader splits the text in an Arrow batch, and from there on everything is native again, without
any shuffle.  :mod:`splits` reads files of any size in parts and gives the same rows.
"""

from __future__ import annotations

import csv
import io
import sys

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom import vocabulary as V
from rosterloom.config import GuardLimits
from rosterloom.functions.text import WHITE, casefold_nfkc, strip_space

LIMITS = GuardLimits()
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
_LINE_ENDS = r"\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}"
_MARK = "\x1f"
_SPLIT = T.StructType([
    T.StructField("header", T.ArrayType(T.StringType())),
    T.StructField("records", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("lines", T.ArrayType(T.IntegerType())),
    T.StructField("error", T.StringType())])


def landing_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """Landed files with their bytes; later projections decide whether bytes are read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(path))


def sniff_delimiter(header: Column) -> Column:
    """The most frequent delimiter of a header line; ties and none go by preference."""
    counts = [F.length(header) - F.length(F.replace(header, F.lit(d), F.lit("")))
              for d in V.DELIMITERS]
    best = F.greatest(*counts)
    choice = F.when(best == 0, V.DELIMITERS[0])
    for delimiter, count in zip(V.DELIMITERS, counts, strict=True):
        choice = choice.when(count == best, delimiter)
    return choice


def header_line(text: Column) -> Column:
    """The first line that is not blank."""
    return F.regexp_extract(text, rf"[^{_LINE_ENDS}]*[^{WHITE}][^{_LINE_ENDS}]*", 0)


def too_big(limits: GuardLimits) -> Column:
    """Why a file is turned away by its length, where a limit is asked for."""
    size = F.col("length")
    if limits.max_input_bytes is None:
        return F.lit(None).cast("string")
    return F.when(size > limits.max_input_bytes, F.concat(
        F.lit("input is "), F.format_number(size, 0),
        F.lit(f" bytes, above the {limits.max_input_bytes:,} byte limit; split the file")))


def nul_problem(has_nul: Column) -> Column:
    return F.when(has_nul, "input contains NUL bytes; this is not a text CSV file")


def western(content: Column) -> Column:
    """Bytes as Windows-1252.  Latin-1 reads any byte and differs in 32 characters only."""
    high = "".join(chr(c) for c in range(0x80, 0xA0))
    return F.translate(F.decode(content, "ISO-8859-1"), high, V.CP1252_HIGH)


def notes_of(encoding: str, byte: str, offset: str, delimiter: str) -> Column:
    """Warnings about encoding (with the first byte that is no UTF-8) and delimiter."""
    encoding_note = (F.when(F.col(encoding) == "utf-16",
                            "encoding: UTF-16 file; decoded from its BOM")
                     .when(F.col(encoding) == "cp1252", F.concat(
                         F.lit("encoding: not valid UTF-8 (byte 0x"), F.col(byte),
                         F.lit(" at offset "), F.col(offset).cast("string"),
                         F.lit("); decoded as Windows-1252, check accented names"))))
    shown = F.when(F.col(delimiter) == "\t", "\\t").otherwise(F.col(delimiter))
    delimiter_note = F.when(F.col(delimiter) != ",", F.concat(
        F.lit("delimiter: '"), shown, F.lit("' detected instead of ','")))
    return F.array_compact(F.array(encoding_note, delimiter_note))


def file_profile(files: DataFrame, limits: GuardLimits = LIMITS) -> DataFrame:
    """Encoding, text, delimiter, warnings and the reason a file is no CSV, if it is none."""
    content = F.col("content")
    fits = files.withColumn("too_big", too_big(limits)).withColumn(
        "content", F.when(F.col("too_big").isNull(), content))
    plain = F.col("content").cast("string")
    bom8 = F.substring("content", 1, 3) == F.unhex(F.lit("EFBBBF"))
    bom16 = F.substring("content", 1, 2).isin(F.unhex(F.lit("FFFE")), F.unhex(F.lit("FEFF")))
    encoding = (F.when(bom8, "utf-8-sig").when(bom16, "utf-16")
                .when(F.is_valid_utf8(plain), "utf-8").otherwise("cp1252"))
    typed = fits.withColumn("encoding", F.when(F.col("content").isNotNull(), encoding))
    text = (F.when(F.col("encoding") == "utf-8-sig",
                   F.substring("content", 4, 2_000_000_000).cast("string"))
            .when(F.col("encoding") == "utf-16", F.decode("content", "UTF-16"))
            .when(F.col("encoding") == "utf-8", plain).otherwise(western(F.col("content"))))
    # Genuine replacement characters are masked by bytes of the same length first.
    masked = F.replace(plain, F.lit("�"), F.lit("???"))
    before = F.substring_index(F.make_valid_utf8(masked), "�", 1)
    offset = F.octet_length(before)
    byte = F.lower(F.hex(F.substring(F.col("content"), offset + 1, F.lit(1))))
    read = (typed.withColumn("_byte", byte).withColumn("_offset", offset).withColumn("text", text)
            .withColumn("has_nul", F.contains("text", F.lit("\x00")))
            .withColumn("text", F.regexp_replace("text", r"\A[\r\n]+", ""))
            .withColumn("delimiter", sniff_delimiter(header_line(F.col("text")))))
    problem = F.coalesce("too_big", nul_problem(F.col("has_nul")))
    kept = [c for c in files.columns if c != "content"]
    return read.select(
        *kept, "encoding", F.when(problem.isNull(), F.col("text")).alias("text"), "delimiter",
        notes_of("encoding", "_byte", "_offset", "delimiter").alias("warnings"),
        problem.alias("problem"))


@F.pandas_udf(_SPLIT)
def _split_csv(text: pd.Series, delimiter: pd.Series) -> pd.DataFrame:
    """Header and records of each CSV text, or why it is malformed."""
    csv.field_size_limit(sys.maxsize)
    rows = []
    for body, mark in zip(text, delimiter, strict=True):
        header, records, lines, error, count = None, [], [], None, 0
        if body is not None:
            reader = csv.reader(io.StringIO(body), delimiter=mark)
            try:
                for record in reader:
                    if not record:
                        continue
                    if header is None:
                        header = record
                        continue
                    count += 1
                    records.append(record)
                    lines.append(count)
            except csv.Error as exc:
                error = (f"malformed CSV header: {exc}" if header is None else
                         f"malformed CSV near line {reader.line_num + 1}: {exc}")
        rows.append((header, records, lines, error))
    return pd.DataFrame(rows, columns=["header", "records", "lines", "error"])


def canonical_headers(header: Column) -> Column:
    """Canonical name of every header cell; unknown headers pass through normalised.

    The cells are folded in one piece, joined by a separator that folding leaves alone.
    """
    joined = F.array_join(F.transform(header, lambda h: F.translate(h, _MARK, " ")), _MARK)
    cells = F.split(casefold_nfkc(joined), _MARK)
    aliases = F.create_map(*[F.lit(x) for name, spellings in V.HEADER_ALIASES.items()
                             for spelling in spellings for x in (spelling, name)])

    def named(cell: Column) -> Column:
        words = F.trim(F.regexp_replace(cell, r"[^\p{L}\p{N}_'\-]+", " "))
        key = F.translate(words, "- ", "__")
        return F.coalesce(F.try_element_at(aliases, key), key)

    return F.transform(cells, named)


def _listed(cells: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(
        cells, lambda c: F.concat(F.lit("'"), c, F.lit("'"))), ", "), F.lit("]"))


def header_mapping(profile: DataFrame) -> DataFrame:
    """Splits every file and claims canonical columns: the first header of a name wins.

    Adds header, canonical, records, lines, columns, ignored_columns and the warnings and
    problems of the header.  Row-local: no join against an alias table.
    """
    split = (profile.withColumn("csv", _split_csv("text", "delimiter"))
             .select("*", "csv.header", "csv.records", "csv.lines", "csv.error").drop("csv", "text"))
    return claimed(split)


def claimed(split: DataFrame) -> DataFrame:
    """Canonical columns of files whose header cells and CSV error are known; drops the error."""
    split = split.withColumn("canonical", canonical_headers(F.col("header")))
    cells = F.arrays_zip(F.col("header"), F.col("canonical"),
                         F.sequence(F.lit(1), F.size("header")).alias("at"))
    known = F.array(*[F.lit(c) for c in V.INPUT_COLUMNS])
    keyed = split.withColumn("cells", F.transform(cells, lambda c: F.struct(
        c["header"].alias("raw"), c["canonical"].alias("name"),
        (F.array_position(F.col("canonical"), c["canonical"]) == c["at"]).alias("claims"))))
    ignored = F.transform(F.filter("cells", lambda c: c["claims"] & ~F.array_contains(
        known, c["name"])), lambda c: c["raw"])
    doubled = F.transform(F.filter("cells", lambda c: ~c["claims"]), lambda c: c["raw"])
    used = F.transform(F.filter("cells", lambda c: c["claims"] & F.array_contains(
        known, c["name"])), lambda c: c["name"])
    required = F.array(*[F.lit(c) for c in V.REQUIRED_COLUMNS])
    missing = F.array_except(required, F.col("canonical"))
    problem = (F.coalesce(
        "problem", F.when(F.col("header").isNull(), F.coalesce(
            "error", F.lit("input file is empty or has no header row"))),
        F.when(F.size(missing) > 0, F.concat(
            F.lit("missing required column(s) "), _listed(missing), F.lit("; header was "),
            _listed(F.col("header")))),
        "error"))
    return (keyed.withColumn("problem", problem)
            .withColumn("columns", used).withColumn("ignored_columns", ignored)
            .withColumn("duplicate_columns", doubled)
            .withColumn("warnings", F.when(F.col("problem").isNull(), F.concat(
                "warnings", F.array_compact(F.array(
                    F.when(F.size("ignored_columns") > 0, F.concat(
                        F.lit("ignored_columns: "), F.array_join("ignored_columns", ", "))),
                    F.when(F.size("duplicate_columns") > 0, F.concat(
                        F.lit("duplicate_columns: "), F.array_join("duplicate_columns", ", "),
                        F.lit(" (first occurrence kept)")))))))
                .otherwise(F.col("warnings")))
            .drop("cells", "error"))


def csv_rows(mapped: DataFrame) -> DataFrame:
    """One row per record of the sound files: path, row_number and the seven raw columns.

    Short records are padded with blanks, surplus cells dropped.
    """
    kept = [c for c in ("path", "batch_id", "batch_date") if c in mapped.columns]
    sound = mapped.filter(F.col("problem").isNull()).select(
        *kept, "canonical", F.inline(F.arrays_zip(F.col("lines").alias("row_number"),
                                                  F.col("records").alias("cells"))))

    return named_cells(sound, kept)


def named_cells(rows: DataFrame, kept: list[str]) -> DataFrame:
    """The seven raw columns out of ``cells``, by the ``canonical`` header of each row's file."""
    def cell(name: str) -> Column:
        at = F.array_position("canonical", name)
        return F.when(at > 0, strip_space(F.coalesce(
            F.get("cells", (at - 1).cast("int")), F.lit("")))).otherwise("")

    return rows.select(*kept, F.col("row_number").cast("int").alias("row_number"),
                       *[cell(n).alias(n) for n in V.INPUT_COLUMNS])


def row_numbering(rows: DataFrame, limits: GuardLimits = LIMITS) -> DataFrame:
    """Rows that hold anything; all-blank ones are counted in the numbering but dropped."""
    return rows.filter(F.concat(*[F.col(c) for c in V.INPUT_COLUMNS]) != "")


def over_row_cap(rows: DataFrame, max_rows: int) -> DataFrame:
    """Files with more rows than the optional cap, and the reason to turn them away."""
    return (rows.groupBy("path").count().filter(F.col("count") > max_rows)
            .select("path", F.lit(f"input has more than {max_rows} rows; split the file")
                    .alias("problem")))


def registrants_of(files: DataFrame, limits: GuardLimits = LIMITS) -> tuple[DataFrame, DataFrame]:
    """(file profile with header facts, numbered rows) of landed files."""
    mapped = header_mapping(file_profile(files, limits))
    rows = row_numbering(csv_rows(mapped), limits)
    mapped, rows = capped(mapped, rows, limits)
    return mapped.drop("records", "lines"), rows


def capped(mapped: DataFrame, rows: DataFrame, limits: GuardLimits) -> tuple[DataFrame, DataFrame]:
    """Turns files away that have more rows than asked for."""
    if limits.max_rows is not None:
        over = over_row_cap(rows, limits.max_rows).withColumnRenamed("problem", "capped")
        mapped = (mapped.join(over, "path", "left")
                  .withColumn("problem", F.coalesce("problem", "capped")).drop("capped"))
        rows = rows.join(over_row_cap(rows, limits.max_rows), "path", "left_anti")
    return mapped, rows
