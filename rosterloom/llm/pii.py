"""Personal data by bootstrapped contextual extraction.

1. Every whole text is searched for four kinds of well-formed identifiers: the base spans, which
   always stay.  Their values are the seed entities.  Identifier-like runs that are no base span
   (digits with separators, addresses written with "(at)") are candidates.
2. Seeds and candidates have *patterns*: the two words before, the word on either side, the two
   words after.
3. Spark scores the graph of patterns and instances in turns.  A pattern's confidence for a kind
   is the share of that kind among the distinct values it surrounds; unknown values count
   against it.  An instance's confidence joins those of its patterns by noisy-or.  Instances
   above ``ACCEPT`` become known in the next turn, until a turn adds nothing.
4. Candidates that were accepted for a kind whose shape they fit become added spans, and so do
   those that are a seed of that kind in another spelling.

Precision comes first: a pattern needs ``SUPPORT`` distinct known values and ``TRUST``.  In text
whose words say nothing about the identifiers around them no span is added.

Null texts count as empty and have no spans; repeated rows give a row each and count once in the
graph, for it holds distinct pairs of pattern and value.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import read, slices
from rosterloom.session import cut_lineage

# Kinds as listed, and what makes a match valid.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match can't begin inside a run of digits, so the look-behind changes nothing but the time.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SUPPORT, TRUST, ACCEPT = 5, 0.9, 0.95
NUMERIC = re.compile(r"(?<![0-9A-Za-z+.])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z])")
SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]+"
                     r"(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]+)+")
WORD = re.compile(r"[^\W\d_]+|[:#=]")
AROUND = 60
SLICE_BYTES = 4_000_000


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind and start, code points, end exclusive."""
    spans = []
    free, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > free and text[first - 1] in LOCAL:
            first -= 1
        domain = DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            spans.append((0, first, domain.end()))
            free = domain.end()
        at = text.find("@", max(free, at + 1))
    for m in IP.finditer(text):
        if all(len(x) <= 3 and int(x or 0) <= 255
               for x in (p.lstrip("0") for p in m[0].split("."))):
            spans.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, list[int]]]:
    """(start, end, kinds whose shape fits) of identifier-like runs clear of base spans."""
    found = []
    for m in NUMERIC.finditer(text):
        n = len(_digits(m[0]))
        parts = m[0].split(".")
        fits = [2] * (13 <= n <= 19) + [3] * (7 <= n <= 15)
        if len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts):
            fits.append(1)
        if fits:
            found.append((m.start(), m.end(), fits))
    if "at)" in text or "at]" in text or "AT)" in text or "AT]" in text:
        found += [(m.start(), m.end(), [0]) for m in SPELLED.finditer(text)]
    return [c for c in found if not any(a < c[1] and c[0] < b for _, a, b in base)]


def patterns(text: str, start: int, end: int) -> list[str]:
    before = WORD.findall(text[max(0, start - AROUND):start].lower())[-2:]
    after = WORD.findall(text[end:end + AROUND].lower())[:2]
    own = []
    if len(before) == 2:
        own.append(" ".join(before) + " _")
    if before and after:
        own.append(f"{before[-1]} _ {after[0]}")
    if len(after) == 2:
        own.append("_ " + " ".join(after))
    return own


SPAN = pa.struct([("no", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
MENTION = pa.struct([("no", pa.int32()), ("fits", pa.list_(pa.int32())), ("start", pa.int32()),
                     ("end", pa.int32()), ("value", pa.string()),
                     ("patterns", pa.list_(pa.string()))])
SCHEMA = ("base array<struct<no:int,start:int,end:int>>, mentions array<struct<no:int,"
          "fits:array<int>,start:int,end:int,value:string,patterns:array<string>>>")


def mentions(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Base spans and all mentions (seeds with ``no``, candidates without) of every row."""
    chosen = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                         F.col(text).alias("text"))

    def mention(text_: str, no: int | None, fits: list[int], start: int, end: int) -> dict:
        # The dots of an address by number tell its parts apart.
        value = re.sub(r"\s" if no == 1 else r"[\s().-]", "", text_[start:end]).lower()
        return {"no": no, "fits": fits, "start": start, "end": end,
                "value": hashlib.sha256(value.encode()).hexdigest(),
                "patterns": patterns(text_, start, end)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            spans, own = [], []
            for text_ in part.column(len(keep)).to_pylist():
                text_ = text_ or ""
                base = base_spans(text_)
                spans.append([{"no": k, "start": a, "end": b} for k, a, b in base])
                own.append([mention(text_, k, [k], a, b) for k, a, b in base]
                           + [mention(text_, None, fits, a, b)
                              for a, b, fits in candidates(text_, base)])
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:len(keep)], pa.array(spans, pa.list_(SPAN)),
                 pa.array(own, pa.list_(MENTION))],
                [*part.schema.names[:len(keep)], "base", "mentions"])

    schema = "".join(f"k{i} {f.dataType.simpleString()}, "
                     for i, f in enumerate(chosen.schema.fields[:-1]))
    return chosen.mapInArrow(run, schema + SCHEMA).withColumnsRenamed(
        {f"k{i}": c for i, c in enumerate(keep)})


def bootstrap(occurrences: DataFrame, support: int = SUPPORT, trust: float = TRUST,
              accept: float = ACCEPT) -> DataFrame:
    """Accepted instances (value, no), from rows (no, fits, value, patterns).

    What is known only grows from turn to turn, and so does every confidence, so the turns end.
    """
    graph = cut_lineage(occurrences.select("value", F.explode("patterns").alias("pattern"))
                        .distinct())
    seeds = cut_lineage(occurrences.where("no is not null").groupBy("value", "no").agg(
        F.lit(1.0).alias("trusted")))
    fitting = cut_lineage(occurrences.where("no is null")
                          .select("value", F.explode("fits").alias("no")).distinct())
    # Other spellings of seeds need no context.
    sure = fitting.join(seeds.select("value", "no"), ["value", "no"], "left_semi")
    unseen = cut_lineage(fitting.join(seeds, ["value", "no"], "left_anti"))
    accepted = unseen.select("value", "no", F.lit(0.0).alias("trusted")).limit(0)
    if not unseen.limit(1).count():
        return sure
    degree = cut_lineage(graph.groupBy("pattern").agg(F.count("*").alias("values")))
    before = (0, 0)
    while True:
        known = seeds.unionByName(accepted)
        scored = (graph.join(known, "value").groupBy("pattern", "no")
                  .agg(F.sum("trusted").alias("weight"), F.count("*").alias("n"))
                  .join(degree, "pattern")
                  .where((F.col("n") >= support) & (F.col("weight") >= trust * F.col("values")))
                  .select("pattern", "no", (F.col("weight") / F.col("values")).alias("c")))
        # Noisy-or: 1 - product(1 - c), the product as a sum of logarithms.
        doubt = F.sum(F.log(F.greatest(1 - F.col("c"), F.lit(0.01))))
        accepted = cut_lineage(
            graph.join(scored, "pattern").join(unseen, ["value", "no"])
            .groupBy("value", "no").agg((1 - F.exp(doubt)).alias("trusted"))
            .where(F.col("trusted") >= accept))
        # Confidence that still rises may let in more in a later turn; millionths are enough.
        now = tuple(accepted.agg(F.count("*"), F.coalesce(F.sum(
            F.floor(F.col("trusted") * 1_000_000)), F.lit(0))).first())
        if now <= before:
            break
        before = now
    return accepted.select("value", "no").union(sure)


def find(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, ``base`` and ``added`` spans (no, start, end) of every row."""
    rows = cut_lineage(mentions(docs, keep, text)
                       .withColumn("__row", F.monotonically_increasing_id()))
    occurrences = rows.select("__row", F.explode("mentions").alias("m")).select("__row", "m.*")
    accepted = bootstrap(occurrences)
    added = (occurrences.where("no is null").drop("no").join(accepted, "value")
             .where(F.array_contains("fits", F.col("no")))
             .groupBy("__row").agg(F.array_sort(F.collect_list(
                 F.struct("no", "start", "end"))).alias("added")))
    none = F.array().cast("array<struct<no:int,start:int,end:int>>")
    return rows.join(added, "__row", "left").select(
        *keep, "base", F.coalesce("added", none).alias("added"))


def written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["no"] + 1), x["start"].cast("string"),
        x["end"].cast("string"))), ",")


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find(read(spark, folder, "documents", "doc_id", "text"), ["doc_id"])

    def number(no: int) -> Column:
        return F.size(F.filter("base", lambda x: x["no"] == no)).cast("long")

    return found.select(
        "doc_id", *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(written(F.array_sort("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "added"))).alias("spans"))
