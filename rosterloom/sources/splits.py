"""Landed CSV files of any size, read by splits.

:mod:`landing` handles a file as one row, which suits very many small files.  Here a file is as
many tasks as it has splits, and gives the same profile and the same rows:

1. Spark's line reader gives the lines of every split (*block*).  Each block is summed up side by side:
   how many lines and records begin in it, and whether it ends inside a quoted field, for either
   state in which it may be entered and each delimiter it may turn out to have.
2. These small rows, one for each block, are walked in file order.  That gives every block the state
   it is entered in and the numbers of records and lines before it.
3. Each block is split into records by the standard CSV reader.  A record that goes on across splits
   comes in fragments, which meet by its number.

Lines of UTF-16 files end at two bytes: there the pieces between line feed bytes are numbered by
running sums of the true line ends among them and put together again, before step 1.  Nothing
holds more than a split, a record or one small row a block.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom import vocabulary as V
from rosterloom.config import GuardLimits
from rosterloom.functions.text import WHITE_CHARS
from rosterloom.operators.prefix import running_sums
from rosterloom.session import cut_lineage
from rosterloom.sources import landing

#: Lines of a transcoded file that count as one block.
LINES_PER_BLOCK = 65_536
#: Blocks whose facts are sent to every task; with more, lines are dealt out by block instead.
MOST_SENT = 100_000
_PIN = "spark.sql.files.minPartitionNum"
_STATES = len(V.DELIMITERS) * 2
_HIGH = {0x80 + i: c for i, c in enumerate(V.CP1252_HIGH)}
_FACTS = ("path string, block long, lines long, bytes long, blank long, head binary, first binary, "
          "bad long, bad_byte int, has_nul boolean, ends array<boolean>, counts array<long>")
_WALKED = ("path string, block long, wide boolean, delimiter string, western boolean, "
           "entered boolean, record long, line long")
_RECORDS = ("path string, record long, cells array<string>, block long, fragment string, "
            "delimiter string, line long, error string")


def lines_of(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """The bytes between line feeds: path, block (where the split begins), at (order), raw."""
    return (spark.read.option("lineSep", "\n").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").text(path)
            .select(F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at"),
                    F.col("_metadata.file_size").alias("length"),
                    F.lit(False).alias("wide"), F.col("value").cast("binary").alias("raw")))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of lines of one block: its key, whether the run opens the block, and the columns."""
    last = None
    for batch in batches:
        paths, blocks = batch.column("path").to_pylist(), batch.column("block").to_pylist()
        begin = 0
        for i in range(1, len(paths) + 1):
            if i == len(paths) or (paths[i], blocks[i]) != (paths[begin], blocks[begin]):
                key = (paths[begin], blocks[begin])
                yield key, key != last, batch.slice(begin, i - begin)
                last, begin = key, i


def ends_open(line: bytes | str, delimiter, quote, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line, as the CSV reader sees it.

    A quote opens a field only at its beginning; a doubled one is text; what follows a closing
    one up to the next delimiter is text too.
    """
    at, fresh = 0, not inside
    while True:
        if fresh:
            if line[at:at + 1] != quote:
                at = line.find(delimiter, at)
                if at < 0:
                    return False
                at += 1
                continue
            at += 1
        at = line.find(quote, at)
        if at < 0:
            return True
        if line[at + 1:at + 2] == quote:
            at, fresh = at + 2, False
            continue
        at = line.find(delimiter, at + 1)
        if at < 0:
            return False
        at, fresh = at + 1, True


def _text(line: bytes) -> str:
    try:
        return line.decode()
    except UnicodeDecodeError:
        return line.decode("latin-1").translate(_HIGH)


class _Facts:
    """What is told of one block before the state it is entered in is known."""

    def __init__(self) -> None:
        self.lines = self.bytes = self.blank = 0
        self.head = self.first = self.bad = self.bad_byte = None
        self.has_nul = False
        self.open = [False, True] * len(V.DELIMITERS)
        self.counts = [0] * _STATES
        self.plain = 0  # records begun on lines without quotes that are not counted yet

    def add(self, lines: list[bytes]) -> None:
        if self.head is None:
            self.head = lines[0][:4]
        if self.bad is None:
            try:
                b"\n".join(lines).decode()
            except UnicodeDecodeError as exc:
                self.bad, self.bad_byte = self.bytes + exc.start, exc.object[exc.start]
        for line in lines:
            self.lines += 1
            self.bytes += len(line) + 1
            filled = bool(line.strip(b"\r"))
            if not filled and self.blank == self.lines - 1:
                self.blank += 1  # line ends that open the file are stripped
            if self.first is None and filled and _text(line).strip(WHITE_CHARS):
                self.first = line
            self.has_nul = self.has_nul or b"\0" in line
            if b'"' not in line:
                self.plain += filled
                continue
            self.settle()
            for i in range(_STATES):
                self.counts[i] += filled and not self.open[i]
                self.open[i] = ends_open(line, V.DELIMITERS[i // 2].encode(), b'"', self.open[i])

    def settle(self) -> None:
        for i in range(_STATES):
            if not self.open[i]:
                self.counts[i] += self.plain
        self.plain = 0

    def row(self, key: tuple) -> tuple:
        self.settle()
        return (*key, self.lines, self.bytes, self.blank, self.head, self.first, self.bad,
                self.bad_byte, self.has_nul, self.open, self.counts)


_FACTS_ARROW = pa.schema([
    ("path", pa.string()), ("block", pa.int64()), ("lines", pa.int64()), ("bytes", pa.int64()),
    ("blank", pa.int64()), ("head", pa.binary()), ("first", pa.binary()), ("bad", pa.int64()),
    ("bad_byte", pa.int32()), ("has_nul", pa.bool_()), ("ends", pa.list_(pa.bool_())),
    ("counts", pa.list_(pa.int64()))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def block_facts(lines: DataFrame) -> DataFrame:
    """One row for each block of lines that lie in order within their partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, facts = None, None
        for at, opens, batch in _blocks(batches):
            if opens:
                if facts:
                    yield _batch([facts.row(key)], _FACTS_ARROW)
                key, facts = at, _Facts()
            facts.add(batch.column("raw").to_pylist())
        if facts:
            yield _batch([facts.row(key)], _FACTS_ARROW)

    return lines.select("path", "block", "raw").mapInArrow(run, _FACTS)


def transcoded(lines: DataFrame, sixteen: DataFrame) -> DataFrame:
    """Lines of the files in ``sixteen`` (path, little: the byte order), as UTF-8."""
    pieces = running_sums(
        lines.join(sixteen, "path").withColumn("size", F.octet_length("raw") + 1),
        ["path"], F.col("block"), ["at"], {"start": F.col("size")})
    end = F.col("start") + F.col("size") - 1  # where the line feed byte stands
    # Little-endian: a true line feed stands at an even place, its zero opens the next piece.
    opened = F.col("little") & (F.col("start") % 2 == 1) & (
        F.substring("raw", 1, 1) == F.unhex(F.lit("00")))
    closed = ~F.col("little") & (end % 2 == 1) & (
        F.substring("raw", -1, 1) == F.unhex(F.lit("00")))
    size = F.octet_length("raw")
    inner = (F.when(opened, F.substring(F.col("raw"), F.lit(2), size))
             .when(closed, F.substring(F.col("raw"), F.lit(1), size - 1)).otherwise(F.col("raw")))
    numbered = running_sums(
        pieces.select("path", "block", "at", "little", "start", opened.alias("opened"),
                      (opened | closed).alias("true"), inner.alias("raw")),
        ["path"], F.col("block"), ["at"], {"before": F.col("true").cast("long")})
    text = F.expr("listagg(raw, X'0A') WITHIN GROUP (ORDER BY start)")
    joined = numbered.groupBy("path", "little", (
        F.col("before") + F.col("opened").cast("long")).alias("at")).agg(text.alias("raw"))
    bare = F.when(F.col("at") == 0, F.substring(F.col("raw"), F.lit(3), F.octet_length("raw"))
                  ).otherwise(F.col("raw"))
    decoded = F.when(F.col("little"), F.decode(bare, "UTF-16LE")).otherwise(F.decode(bare, "UTF-16BE"))
    stored = cut_lineage(joined.select(
        "path", F.floor(F.col("at") / LINES_PER_BLOCK).alias("block"), "at",
        F.lit(True).alias("wide"), F.encode(decoded, "UTF-8").alias("raw")))
    return stored.repartition("path", "block").sortWithinPartitions("path", "block", "at")


def _walk(group: pa.Table) -> pa.Table:
    """The blocks of one file, with the state each is entered in and what lies before it."""
    rows = sorted(group.to_pylist(), key=lambda r: r["block"])
    out, inside, record, line = [], False, 0, 0
    leading = True
    for r in rows:
        out.append((r["path"], r["block"], r["wide"], r["delimiter"], r["western"], inside, record, line))
        i = 2 * V.DELIMITERS.index(r["delimiter"]) + inside
        record, inside = record + r["counts"][i], r["ends"][i]
        line += r["lines"] - (r["blank"] if leading else 0)
        leading = leading and r["blank"] == r["lines"]
    return pa.Table.from_batches([_batch(out, _WALKED_ARROW)])


_WALKED_ARROW = pa.schema([
    ("path", pa.string()), ("block", pa.int64()), ("wide", pa.bool_()),
    ("delimiter", pa.string()), ("western", pa.bool_()), ("entered", pa.bool_()), ("record", pa.int64()),
    ("line", pa.int64())])
_RECORDS_ARROW = pa.schema([
    ("path", pa.string()), ("record", pa.int64()), ("cells", pa.list_(pa.string())),
    ("block", pa.int64()), ("fragment", pa.string()), ("delimiter", pa.string()),
    ("line", pa.int64()), ("error", pa.string())])


def _cells(text: str, delimiter: str) -> tuple[list[str] | None, str | None, int]:
    """A record's cells, or why it is malformed and on which of its lines."""
    csv.field_size_limit(sys.maxsize)
    lines = text.split("\n")
    reader = csv.reader([*(x + "\n" for x in lines[:-1]), lines[-1]], delimiter=delimiter)
    try:
        return next(reader, []), None, reader.line_num
    except csv.Error as exc:
        return None, str(exc), reader.line_num


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of blocks whose entry is known; the one that is open at either end as a fragment."""
    held: list[str] = []
    info, inside, number, line, whole, out, size = None, False, 0, 0, True, [], 0

    def done(key: tuple, closed: bool) -> tuple:
        """The record that is held, whose first line is number ``line`` of the file."""
        text = "\n".join(held)
        if not (whole and closed):
            return (key[0], number, None, key[1], text, info[0], line, None)
        cells, error, at = _cells(text, info[0])
        return (key[0], number, cells, None, None, None, line + at, error)

    key = None
    for at, opens, batch in _blocks(batches):
        if opens:
            if held:
                out.append(done(key, not inside))
            key, held = at, []
            info = (batch.column("delimiter")[0].as_py(), batch.column("western")[0].as_py())
            inside = batch.column("entered")[0].as_py()
            number, line = (batch.column(c)[0].as_py() for c in ("record", "line"))
            whole, leading = not inside, line == 0
            number -= 1  # of the record before; each one that begins counts on
            seen = line
        for raw in batch.column("raw").to_pylist():
            text = (raw.decode("latin-1").translate(_HIGH) if info[1]
                    else raw.decode(errors="replace"))
            if not inside and leading and not text.strip("\r"):
                continue  # line ends that open the file
            if leading:
                text, leading = text.lstrip("\r"), False
            if not inside:
                if held:
                    out.append(done(key, True))
                    size += sum(map(len, held))
                    held = []
                if not text.strip("\r"):
                    seen += 1
                    continue
                number, line, whole = number + 1, seen, True
            held.append(text)
            seen += 1
            if '"' in text:
                inside = ends_open(text, info[0], '"', inside)
            if len(out) >= 10_000 or size > 16_000_000:
                yield _batch(out, _RECORDS_ARROW)
                out, size = [], 0
    if held:
        out.append(done(key, not inside))
    if out:
        yield _batch(out, _RECORDS_ARROW)


def _mended(fragments: DataFrame) -> DataFrame:
    """Records put together from their fragments, of which a split holds two at most."""
    whole = fragments.groupBy("path", "record", "delimiter").agg(
        F.expr("listagg(fragment, '\n') WITHIN GROUP (ORDER BY block)").alias("text"),
        F.min_by("line", "block").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                cells, error, at = _cells(r["text"], r["delimiter"])
                rows.append((r["path"], r["record"], cells, None, None, None, r["line"] + at,
                             error))
            if rows:
                yield _batch(rows, _RECORDS_ARROW)

    return whole.mapInArrow(run, _RECORDS)


def registrants_by_splits(spark: SparkSession, path: str, limits: GuardLimits = landing.LIMITS,
                          pattern: str = "*.csv") -> tuple[DataFrame, DataFrame]:
    """(file profile with header facts, numbered rows) of landed files, as from
    :func:`landing.registrants_of`, read by splits."""
    pinned = spark.conf.get(_PIN, None)
    # All reads must cut files alike, whatever executors come and go meanwhile.
    spark.conf.set(_PIN, pinned or str(spark.sparkContext.defaultParallelism))
    try:
        return _registrants(spark, path, limits, pattern)
    finally:
        if pinned is None:
            spark.conf.unset(_PIN)


def _registrants(spark: SparkSession, path: str, limits: GuardLimits,
                 pattern: str) -> tuple[DataFrame, DataFrame]:
    files = landing.landing_files(spark, path, pattern).select(
        F.col("_metadata.file_path").alias("path"), "modificationTime", "length")
    lines = lines_of(spark, path, pattern)
    if limits.max_input_bytes is not None:
        lines = lines.filter(F.col("length") <= limits.max_input_bytes)
    lines = lines.drop("length")
    facts = cut_lineage(block_facts(lines))
    mark = F.substring("head", 1, 2)
    little, big = F.unhex(F.lit("FFFE")), F.unhex(F.lit("FEFF"))
    sixteen = cut_lineage(facts.filter((F.col("block") == 0) & mark.isin(little, big)).select(
        "path", (mark == little).alias("little")))
    if not sixteen.isEmpty():
        wide = transcoded(lines, sixteen)
        lines = lines.unionByName(wide)
        facts = cut_lineage(facts.join(sixteen, "path", "left_anti").unionByName(
            block_facts(wide)))

    profile = cut_lineage(_profile(files, facts, sixteen, limits))
    # One row a block from here on: no file has more of them than splits.
    known = facts.join(profile.filter(F.col("problem").isNull()).select(
        "path", "delimiter", (F.col("encoding") == "utf-16").alias("wide"),
        (F.col("encoding") == "cp1252").alias("western")), "path")
    walked = cut_lineage(known.select("path", "block", "wide", "lines", "blank", "ends", "counts",
                                      "delimiter", "western")
                         .groupBy("path").applyInArrow(_walk, _WALKED))
    if walked.count() <= MOST_SENT:
        # Lines of UTF-16 files as they were read meet nothing, only the transcoded ones do.
        placed = lines.join(F.broadcast(walked), ["path", "block", "wide"])
    else:
        placed = lines.join(walked, ["path", "block", "wide"]).repartition(
            "path", "block").sortWithinPartitions("path", "block", "at")
    records = cut_lineage(placed.mapInArrow(_records, _RECORDS))
    fragments = records.filter("fragment is not null")
    if not fragments.isEmpty():
        records = cut_lineage(records.filter("fragment is null").unionByName(_mended(fragments)))
    _require_all(known, walked, records)

    error = F.when(F.col("record") == 0, F.concat(F.lit("malformed CSV header: "), "error")) \
        .otherwise(F.concat(F.lit("malformed CSV near line "), (F.col("line") + 1).cast("string"),
                            F.lit(": "), F.col("error")))
    errors = records.filter("error is not null").groupBy("path").agg(
        F.min_by(error, "line").alias("error"))
    heads = records.filter("record = 0").select("path", F.col("cells").alias("header"))
    mapped = cut_lineage(landing.claimed(
        profile.join(heads, "path", "left").join(errors, "path", "left")))
    sound = mapped.filter(F.col("problem").isNull()).select("path", "canonical")
    rows = landing.named_cells(
        records.filter("record > 0").select(
            "path", F.col("record").cast("int").alias("row_number"), "cells").join(sound, "path"),
        ["path"])
    return landing.capped(mapped, landing.row_numbering(rows, limits), limits)


def _profile(files: DataFrame, facts: DataFrame, sixteen: DataFrame,
             limits: GuardLimits) -> DataFrame:
    """What :func:`landing.file_profile` tells of a file, from the facts of its blocks."""
    placed = running_sums(facts.select("path", "block", "bytes", "bad", "bad_byte", "first", "has_nul"),
                          ["path"], F.col("block"), ["block"], {"offset": F.col("bytes")})
    told = placed.groupBy("path").agg(
        F.sum("bytes").alias("bytes"), F.bool_or("has_nul").alias("has_nul"),
        F.min(F.when(F.col("bad").isNotNull(), F.struct(
            (F.col("offset") + F.col("bad")).alias("at"), F.col("bad_byte").alias("byte"))))
        .alias("bad"),
        F.min(F.when(F.col("first").isNotNull(), F.struct("block", "first"))).alias("first"))
    seen = (files.join(told, "path", "left").join(
        sixteen.withColumn("wide", F.lit(True)).drop("little"), "path", "left"))
    # The line reader leaves out a UTF-8 mark at the beginning: three bytes are missing.
    marked = F.col("length") - F.col("bytes") >= 2
    encoding = (F.when(F.col("wide"), "utf-16").when(marked, "utf-8-sig")
                .when(F.col("bad").isNull(), "utf-8").otherwise("cp1252"))
    typed = seen.withColumn("encoding", F.when(
        landing.too_big(limits).isNull(), F.coalesce(encoding, F.lit("utf-8"))))
    line = F.col("first.first")
    text = F.when(F.col("encoding") == "cp1252", landing.western(line)).otherwise(
        line.cast("string"))
    return (typed.withColumn("offset", F.col("bad.at"))
            .withColumn("byte", F.lower(F.lpad(F.hex("bad.byte"), 2, "0")))
            .withColumn("delimiter", F.when(F.col("encoding").isNotNull(), landing.sniff_delimiter(
                landing.header_line(F.coalesce(text, F.lit(""))))))
            .select("path", "modificationTime", "length", "encoding", "delimiter",
                    landing.notes_of("encoding", "byte", "offset", "delimiter").alias("warnings"),
                    F.coalesce(landing.too_big(limits), landing.nul_problem(F.col("has_nul")))
                    .alias("problem")))


def _require_all(known: DataFrame, walked: DataFrame, records: DataFrame) -> None:
    """Raises unless the second reading met every record that the first one counted."""
    place = F.array_position(F.array(*[F.lit(d) for d in V.DELIMITERS]), F.col("delimiter")) - 1
    state = (place * 2 + F.col("entered").cast("long")).cast("int")
    counted = known.drop("delimiter", "western", "wide").join(walked, ["path", "block"]).agg(
        F.coalesce(F.sum(F.get("counts", state)), F.lit(0))).first()[0]
    met = records.count()
    if counted != met:
        raise RuntimeError(f"files changed while they were read: {met} records of {counted}")
