"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` writes the training tokens as a positional index that is split by documents: a
row is a segment of a few megabytes of text and holds the segment's terms, where each term's
postings begin, and all postings (token positions, counted through the segment with a gap
after every document, so that no phrase can cross documents).  Building needs no shuffle, and
a document lies in one segment, so searching needs none either.

``search`` turns every benchmark item into phrases, looks their terms up in each segment, drops
phrases with an absent term, and intersects the offset-adjusted postings of the rest, from the
rarest term in that segment on.  Terms must stand at their exact offsets for a phrase match.
With ``slack`` it also returns proximity matches: a stretch of the phrase's length plus ``slack``
words, cut at the document's end, that holds all words of the phrase, repeats included, in any
order.  Phrases without such a stretch have no exact match either, so one walk from the rarest
term serves both.  Matches are merged in the task, in time linear in them but for a sort.

The benchmark is a stated query set.  It goes to the tasks in blocks of items with a checked size
(``BLOCK_BYTES`` of text), one at a time, one pass over the index for each block; an item too large
for a block is a block of its own.

Words are runs of digits, ASCII letters (lower-cased) and characters beyond ASCII.  Null and empty
texts have no words.  An item with fewer words than a window is one window; without words, none.
Repeated documents give a row each.  Items that share an id count once; items without an id mark
words as hit but are not listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import read, slices
from rosterloom.session import cut_lineage, scratch_path

WINDOW = 10
#: Words that a proximity match may have more than its phrase.
SLACK = 2
#: Postings whose stretches are counted at once.
CHUNK = 16_384
SEGMENT_BYTES = 4_000_000
#: Segments are large rows: the size of the buffers is looked at after each of them, not after a
#: hundred as usual, and few of them are written, and so read, at once.
INDEX_FILES = {"parquet.block.size": 1 << 24, "parquet.page.size.row.check.min": 1,
               "parquet.page.size.row.check.max": 1}
BLOCK_BYTES = 16_000_000
#: Every byte that is no letter, digit or part of a character beyond ASCII parts words.
SEPARATE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(SEPARATE).split()


# ------------------------------------------------------------------ index

def build_index(docs: DataFrame, keep: list[str], text: str = "text",
                path: str | None = None) -> str:
    """Writes the index and returns its folder; ``keep`` columns stay with each document."""
    path = path or scratch_path(docs.sparkSession, "postings")
    chosen = docs.select(F.struct(*[F.col(c) for c in keep]).alias("doc"),
                         F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SEGMENT_BYTES):
            words, begins, counts, at = [], [], [], 0
            for text_ in part.column(1).to_pylist():
                own = words_of(text_)
                words += own
                begins.append(at)
                counts.append(len(own))
                at += len(own) + 1
            counts_ = np.array(counts, dtype=np.int64)
            # The gap after every document: token i of document d stands at i + d.
            places = np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts_)
            coded = pa.array(words, pa.binary()).dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
            yield pa.RecordBatch.from_arrays(
                [_one(part.column(0)), _one(pa.array(begins, pa.int32())),
                 _one(pa.array(counts, pa.int32())), _one(coded.dictionary),
                 _one(pa.array(ends.astype(np.int32))),
                 _one(pa.array(places[order].astype(np.int32)))],
                ["doc", "begin", "n_words", "term", "posting_end", "posting"])

    kind = chosen.schema["doc"].dataType.simpleString()
    index = chosen.mapInArrow(run, f"doc array<{kind}>, begin array<int>, n_words array<int>, "
                                   "term array<binary>, posting_end array<int>, posting array<int>")
    # The segment's number is drawn once, as the index is written.
    (index.withColumn("segment", F.monotonically_increasing_id())
     .write.options(**INDEX_FILES).parquet(path))
    return path


def _one(values: pa.Array) -> pa.ListArray:
    """All values as the list of a single row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


# ------------------------------------------------------------------ search

class Phrases:
    """The distinct phrases of a block of items, as rows of term numbers padded with -1."""

    def __init__(self, items: list[tuple[object, str | None]], window: int) -> None:
        number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, text in items:
            own = [number.setdefault(w, len(number)) for w in words_of(text)]
            for i in range(max(1, len(own) - window + 1) if own else 0):
                owners.setdefault(tuple(own[i:i + window]), set()).add(item)
        self.terms = list(number)
        self.owners = list(owners.values())
        self.length = np.array([len(p) for p in owners], dtype=np.int64)
        self.term = np.full((len(owners), window), -1, dtype=np.int64)
        for row, phrase in enumerate(owners):
            self.term[row, :len(phrase)] = phrase


class _Segment:
    """A segment's postings, asked for a block's phrases."""

    def __init__(self, phrases: Phrases, begin: np.ndarray, n_words: np.ndarray, terms: pa.Array,
                 ends: np.ndarray, posting: np.ndarray) -> None:
        self.phrases, self.begin, self.n_words = phrases, begin, n_words
        self.ends, self.posting = ends, posting
        local = pa.compute.index_in(pa.array(phrases.terms, pa.binary()), terms)
        local = pa.compute.fill_null(local, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.at = np.append(local, -2)[phrases.term]  # -2 is for the padding
        self.size = np.append(np.diff(ends, prepend=0), [0, 0])[self.at]

    def own(self, term: int) -> np.ndarray:
        return self.posting[self.ends[term - 1] if term else 0:self.ends[term]]

    def doc(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, place, side="right") - 1

    def matches(self, slack: int) -> Iterator[tuple[int, list[int], np.ndarray]]:
        """Phrase numbers, their offsets from the rarest term on, and that term's postings which
        have every other term of the phrase less than a stretch away."""
        for row in np.nonzero((self.at != -1).all(axis=1))[0].tolist():
            n = int(self.phrases.length[row])
            order = np.argsort(self.size[row, :n], kind="stable").tolist()
            reach = n + slack - 1
            place = self.own(self.at[row, order[0]])
            for offset in order[1:]:
                own = self.own(self.at[row, offset])
                found = np.searchsorted(own, place - reach)
                there = found < len(own)
                there[there] = own[found[there]] <= place[there] + reach
                place = place[there]
                if not len(place):
                    break
            else:
                yield row, order, place

    def exact(self, row: int, order: list[int], place: np.ndarray) -> np.ndarray:
        """Where the phrase begins, its terms at their exact offsets."""
        place = place - order[0]
        for offset in order[1:]:
            own = self.own(self.at[row, offset]) - offset
            found = np.minimum(np.searchsorted(own, place), len(own) - 1)
            place = place[own[found] == place]
            if not len(place):
                break
        return place

    def nearby(self, row: int, place: np.ndarray, slack: int) -> tuple[np.ndarray, np.ndarray]:
        """Stretches (first, end) around these postings that hold all words of the phrase."""
        n = int(self.phrases.length[row])
        span = n + slack
        wanted, times = np.unique(self.at[row, :n], return_counts=True)
        firsts, ends = [], []
        for chunk in range(0, len(place), CHUNK):
            own = place[chunk:chunk + CHUNK]
            doc = self.doc(own)
            low, high = self.begin[doc], self.begin[doc] + self.n_words[doc]
            first = (own[:, None] - np.arange(span)[None, :])
            inside = first >= low[:, None]
            last = np.minimum(first + span, high[:, None])[inside]
            first = first[inside]
            for term, count in zip(wanted.tolist(), times.tolist()):
                postings = self.own(term)
                held = np.searchsorted(postings, last) - np.searchsorted(postings, first) >= count
                first, last = first[held], last[held]
                if not len(first):
                    break
            firsts.append(first)
            ends.append(last)
        return np.concatenate(firsts), np.concatenate(ends)


def merged(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that touch or overlap become one; the result ascends."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(end[order])
    new = np.append(True, first[1:] > reach[:-1])[:len(first)]
    starts = np.nonzero(new)[0]
    return first[starts], reach[np.append(starts[1:], len(first))[:len(starts)] - 1]


class _Found:
    """Spans and items of one kind of match in a segment."""

    def __init__(self) -> None:
        self.first: list[np.ndarray] = []
        self.end: list[np.ndarray] = []
        self.items: dict[int, set[str]] = {}

    def note(self, segment: _Segment, row: int, first: np.ndarray, end: np.ndarray) -> None:
        if not len(first):
            return
        self.first.append(first)
        self.end.append(end)
        names = {str(x) for x in segment.phrases.owners[row] if x is not None}
        for doc in np.unique(segment.doc(first)).tolist():
            self.items.setdefault(doc, set()).update(names)

    def by_document(self, segment: _Segment) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Merged spans of each document, by word positions in it.

        The gap between documents keeps spans of neighbours apart.
        """
        if not self.first:
            return {}
        first, end = merged(np.concatenate(self.first).astype(np.int64),
                            np.concatenate(self.end).astype(np.int64))
        docs, starts = np.unique(segment.doc(first), return_index=True)
        cuts = np.append(starts, len(first))
        return {d: (first[a:b] - segment.begin[d], end[a:b] - segment.begin[d])
                for d, a, b in zip(docs.tolist(), cuts[:-1].tolist(), cuts[1:].tolist())}


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[object, str | None]]]:
    """Items in blocks of a bounded size of text."""
    size, block = 0, []
    for row in benchmark.select(F.col(item), F.col(text)).toLocalIterator():
        own = len((row[1] or "").encode())
        if block and size + own > BLOCK_BYTES:
            yield block
            size, block = 0, []
        block.append((row[0], row[1]))
        size += own
    if block:
        yield block


_LISTS = pa.list_(pa.int64())
_FOUND = pa.schema([("segment", pa.int64()), ("ordinal", pa.int32()), ("first", _LISTS),
                    ("end", _LISTS), ("items", pa.list_(pa.string())), ("near_first", _LISTS),
                    ("near_end", _LISTS), ("near_items", pa.list_(pa.string()))])
_FOUND_SQL = ("segment bigint, ordinal int, first array<bigint>, end array<bigint>, "
              "items array<string>, near_first array<bigint>, near_end array<bigint>, "
              "near_items array<string>")


def _search_block(table: DataFrame, phrases: Phrases, slack: int | None) -> DataFrame:
    """One pass over the index for a block's phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, *lists = (batch.column(c)[i] for c in range(6))
                begin, n_words, ends, posting = (
                    lists[c].values.to_numpy(zero_copy_only=False) for c in (0, 1, 3, 4))
                if not len(posting):
                    continue
                segment = _Segment(phrases, begin, n_words, lists[2].values, ends, posting)
                exact, near = _Found(), _Found()
                for row, order, place in segment.matches(slack or 0):
                    at = segment.exact(row, order, place)
                    exact.note(segment, row, at, at + int(phrases.length[row]))
                    if slack is not None:
                        near.note(segment, row, *segment.nearby(row, place, slack))
                spans, wide = exact.by_document(segment), near.by_document(segment)
                docs, none = sorted({*spans, *wide}), (np.empty(0, np.int64),) * 2
                if docs:
                    yield pa.RecordBatch.from_pydict({
                        "segment": [number.as_py()] * len(docs), "ordinal": docs,
                        "first": [spans.get(d, none)[0] for d in docs],
                        "end": [spans.get(d, none)[1] for d in docs],
                        "items": [sorted(exact.items.get(d, ())) for d in docs],
                        "near_first": [wide.get(d, none)[0] for d in docs],
                        "near_end": [wide.get(d, none)[1] for d in docs],
                        "near_items": [sorted(near.items.get(d, ())) for d in docs]}, _FOUND)

    return table.select("segment", "begin", "n_words", "term", "posting_end", "posting").mapInArrow(
        run, _FOUND_SQL)


def _merge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges each row's spans, which come from several blocks."""
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        for first, end in (("first", "end"), ("near_first", "near_end")):
            both = [merged(f.values.to_numpy(zero_copy_only=False),
                           e.values.to_numpy(zero_copy_only=False))
                    for f, e in zip(columns[first], columns[end])]
            columns[first] = pa.array([f for f, _ in both], _LISTS)
            columns[end] = pa.array([e for _, e in both], _LISTS)
        yield pa.RecordBatch.from_arrays([columns[n] for n in _FOUND.names], schema=_FOUND)


def search(spark: SparkSession, index: str, benchmark: DataFrame, item: str = "item_id",
           text: str = "text", window: int = WINDOW, slack: int | None = None) -> DataFrame:
    """Matches of each document that has any: (segment, ordinal, spans, items, near_spans,
    near_items).

    Spans are (first, end) word positions in the document, merged; items are item ids, sorted
    as strings.  Proximity matches are looked for with ``slack`` only.
    """
    table = spark.read.parquet(index)
    # Each block is searched before the next comes to the driver.
    parts = [cut_lineage(_search_block(table, Phrases(block, window), slack))
             for block in _blocks(benchmark, item, text)]
    found = parts[0] if parts else spark.createDataFrame([], _FOUND_SQL)
    if len(parts) > 1:
        for part in parts[1:]:
            found = found.unionByName(part)
        # A document's rows come together; their number is at most that of the blocks.
        rows = found.groupBy("segment", "ordinal").agg(
            F.collect_list(F.struct(*_FOUND.names[2:])).alias("r"))
        found = rows.select("segment", "ordinal", *[
            (F.array_sort(F.array_distinct(F.flatten(F.col(f"r.{n}"))))
             if n.endswith("items") else F.flatten(F.col(f"r.{n}"))).alias(n)
            for n in _FOUND.names[2:]]).mapInArrow(_merge_rows, _FOUND_SQL)
    return found.select(
        "segment", "ordinal", F.arrays_zip("first", "end").alias("spans"), "items",
        F.arrays_zip(F.col("near_first").alias("first"), F.col("near_end").alias("end"))
        .alias("near_spans"), "near_items")


def documents(spark: SparkSession, index: str) -> DataFrame:
    """Every document of the index: segment, ordinal, its kept columns, n_words."""
    table = spark.read.parquet(index)
    return (table.select("segment", F.posexplode(F.arrays_zip("doc", "n_words"))
                         .alias("ordinal", "x"))
            .select("segment", "ordinal", "x.doc.*", F.col("x.n_words").cast("long")
                    .alias("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text",
                  window: int = WINDOW, slack: int | None = None) -> DataFrame:
    """For every document its kept columns, n_words, spans, items and n_hit; near_spans, near_items
    and n_near are the same for proximity matches, which are empty without ``slack``."""
    spark = docs.sparkSession
    index = build_index(docs, keep, text)
    found = search(spark, index, benchmark, window=window, slack=slack)

    def words(spans: str) -> Column:
        return F.coalesce(F.aggregate(spans, F.lit(0).cast("long"),
                                      lambda n, s: n + s["end"] - s["first"]), F.lit(0).cast("long"))

    return (documents(spark, index).join(found, ["segment", "ordinal"], "left")
            .withColumns({"n_hit": words("spans"), "n_near": words("near_spans")})
            .drop("segment", "ordinal"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs.

    Being hit depends on the text alone, so hit texts are taken out by their digests.
    """
    marked = docs.withColumn("__digest", F.sha2(text, 256))
    hit = (contamination(marked, benchmark, ["__digest"], text).where("n_hit > 0")
           .select("__digest").distinct())
    return marked.join(hit, "__digest", "left_anti").select(*docs.columns)


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(read(spark, folder, "documents", "doc_id", "text"),
                          read(spark, folder, "benchmark", "item_id", "text"), ["doc_id"], slack=SLACK)
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "n_near",
        F.coalesce(F.size("near_items"), F.lit(0)).cast("long").alias("n_near_items"))
