import random
import re
import time
from collections import Counter

import pyarrow.parquet as pq
import pytest
from helpers import documents, odd_texts, prose
from pyspark.sql import functions as F

from rosterloom.llm import decontaminate

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items, window=10):
    windows = {}
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            windows.setdefault(tuple(own[i:i + window]), set()).add(item)
    out = {}
    for n, text in enumerate(texts):
        own, hit, found = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                owner = windows.get(tuple(own[i:i + size]))
                if owner:
                    found |= {str(o) for o in owner if o is not None}
                    hit.update(range(i, i + size))
        out[n] = (len(own), len(hit), sorted(found))
    return out


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc string")


@pytest.fixture
def corpus():
    passage = prose(30, 77)
    texts = odd_texts() + [
        prose(50, 5) + "\n" + passage.upper() + ", " + prose(20, 6),
        passage[:40], " ".join(passage.split()[3:13]), " ".join(passage.split()[3:12]),
        "tiny item", "a tiny, ITEM again tiny item", "x" * 10 + " " + "repeat " * 40]
    bench = [(3, passage, "q"), (1, "Tiny item!", "q"), (20, passage, "q"), (4, None, "q"),
             (5, "", "q"), (None, "one", "q"), (6, "repeat " * 12, "q"), (3, passage, "q")]
    return texts, bench


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 100])
def test_hits_equal_brute_force(spark, corpus, monkeypatch, block):
    texts, bench = corpus
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SEGMENT_BYTES", 2000)
    got = decontaminate.contamination(documents(spark, texts), items(spark, bench), ["doc_id"])
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"] or []) for r in got.collect()}
    assert found == brute(texts, [(b[0], b[1]) for b in bench])


def test_decontaminated_keeps_clean_rows_whole(spark, corpus):
    texts, bench = corpus
    docs = documents(spark, texts)
    kept = decontaminate.decontaminated(docs, items(spark, bench))
    clean = {i for i, v in brute(texts, [(b[0], b[1]) for b in bench]).items() if not v[1]}
    assert {r["doc_id"] for r in kept.collect()} == clean
    assert kept.columns == docs.columns


def test_empty_tables(spark, corpus):
    texts, bench = corpus
    docs, none = documents(spark, texts), items(spark, [])
    assert decontaminate.decontaminated(docs, none).count() == len(texts)
    assert decontaminate.contamination(docs.limit(0), items(spark, bench), ["doc_id"]).count() == 0


def test_proximity_finds_scattered_words(spark):
    docs = documents(spark, ["alpha then beta and gamma", "gamma alpha beta",
                             "alpha " + "far " * 20 + "beta gamma", None])
    index = decontaminate.build_index(docs, ["doc_id"])
    near = decontaminate.search(spark, index, items(spark, [(1, "alpha beta gamma", "")]), slack=2)
    rows = decontaminate.documents(spark, index).join(near, ["segment", "ordinal"]).collect()
    assert {r["doc_id"] for r in rows} == {0, 1}


def brute_near(texts, bench, slack, window=10):
    """Every stretch of a phrase's length and ``slack`` words that holds all its words."""
    out = {}
    for n, text in enumerate(texts):
        own, hit, found = words(text), set(), set()
        for item, passage in bench:
            phrase = words(passage)
            for i in range(max(1, len(phrase) - window + 1) if phrase else 0):
                wanted = Counter(phrase[i:i + window])
                span = sum(wanted.values()) + slack
                for first in range(len(own)):
                    if not wanted - Counter(own[first:first + span]):
                        hit.update(range(first, min(first + span, len(own))))
                        found |= {str(item)} - {"None"}
        out[n] = (len(hit), sorted(found))
    return out


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_proximity_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SEGMENT_BYTES", 400)
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefg", k=rng.randrange(60))) for _ in range(60)] + [None, ""]
    bench = [(i, " ".join(rng.choices("abcdefgz", k=rng.randrange(1, 14)))) for i in range(12)] + [
        (None, "a b c"), (3, "g g g")]
    rows = [(i, t, "") for i, t in bench]
    got = decontaminate.contamination(documents(spark, texts), items(spark, rows), ["doc_id"],
                                      window=4, slack=2).collect()
    assert {r["doc_id"]: (r["n_near"], r["near_items"] or []) for r in got} == brute_near(
        texts, bench, 2, 4)
    exact = brute(texts, bench, 4)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"] or []) for r in got} == exact


def test_very_many_hits_in_one_document_merge_in_linear_time(spark):
    docs = documents(spark, ["the end " * 400_000, "the"])
    began = time.time()
    got = decontaminate.contamination(docs, items(spark, [(1, "the", "")]), ["doc_id"], slack=0)
    assert {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in got.select(
        "doc_id", "n_hit", "n_near").collect()} == {0: (400_000, 400_000), 1: (1, 1)}
    assert time.time() - began < 60


def test_index_is_written_a_few_segments_at_once(spark, tmp_path):
    docs = spark.range(0, 100, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(
        F.lit("abc de f "), 45_000).alias("text"))  # ten segments or more in one task
    path = decontaminate.build_index(docs, ["doc_id"], path=str(tmp_path / "index"))
    files = [pq.ParquetFile(f) for f in (tmp_path / "index").glob("*.parquet")]
    rows = [f.metadata.row_group(g).num_rows for f in files for g in range(f.num_row_groups)]
    assert sum(rows) >= 10 and max(rows) <= 5
    assert decontaminate.documents(spark, path).where("n_words = 135000").count() == 100
