import hashlib
import zlib

import pytest
from helpers import documents, odd_texts, prose
from pyspark.sql import functions as F

from rosterloom.llm import merkle

FIELDS = merkle.FIELDS


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, **changed):
    values = [changed.get(f, row[f]) for f in FIELDS]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests):
    """The root of a list of digests, and for each its siblings as (left, right) lists."""
    ways, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i:i + 3] for i in range(0, len(digests), 3)]
        for i, k in enumerate(at):
            run = runs[k // 3]
            ways[i].append((run[:k % 3], run[k % 3 + 1:]))
        digests, at = [digest(*r) for r in runs], [k // 3 for k in at]
    return digests[0] if digests else None, ways


def brute(rows):
    """A list of results, in the order of (source, id, leaf)."""
    rows = sorted(rows, key=lambda r: (r["source"] is not None, (r["source"] or "").encode(),
                                       r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    names = list(dict.fromkeys(r["source"] for r in rows))
    trees = {s: [leaf(r) for r in rows if r["source"] == s] for s in names}
    inside = {s: climb(x) for s, x in trees.items()}
    root, above = climb([inside[s][0] for s in names])
    out, seen = [], dict.fromkeys(names, 0)
    for r in rows:
        s = r["source"]
        way = inside[s][1][seen[s]] + above[names.index(s)]
        seen[s] += 1
        text = r["text"]
        if r["doc_id"] is not None and text and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        at = leaf(r, text=text)
        for left, right in way:
            at = digest(*left, at, *right)
        proof = digest(*(d for left, right in way for d in left + right))
        out.append((r["doc_id"], leaf(r), inside[s][0], root, proof, at, at == root))
    return out


def told(docs):
    proved = merkle.manifest(docs, FIELDS, presented={
        "text": merkle.tampered(F.col("text"), F.col("doc_id"))}).drop("way")
    return sorted(map(tuple, proved.collect()), key=repr)


@pytest.mark.parametrize("count,sources", [
    (1, 1), (2, 1), (3, 1), (4, 1), (28, 1), (10, 10), (90, 7), (83, 4)])
def test_equals_plain_trees(spark, count, sources):
    texts = [f"{prose(5, i)}\n{prose(3, i + 1)}" if i % 3 else prose(4, i) for i in range(count)]
    names = [f"s{(i * i) % sources}" if sources > 1 else "only" for i in range(count)]
    docs = documents(spark, texts, names)
    assert told(docs) == sorted(brute(docs.collect()), key=repr)


def test_odd_rows(spark):
    texts = [*odd_texts(), "a\nb", "a\nb", "\n", "\n\n", "é\n漢"]
    names = ["Ä", None, "", "b", None, "a", "hot", "hot", "hot", "", "漢", "hot", "hot", None,
             "hot", "hot", "hot", None]
    ids = [5, 5, 5, None, 7, -3, 5, 5, None, 1, 2, 3, None, 8, 9, 9, 10, 11]
    rows = [(i, t, None if k % 4 == 0 else "en", s, None if t is None else len(t), "x", "y", "z",
             "w") for k, (i, t, s) in enumerate(zip(ids, texts, names))]
    docs = spark.createDataFrame(rows + rows[5:8], documents(spark, ["a"]).schema)
    got = told(docs)
    assert got == sorted(brute(docs.collect()), key=repr)
    assert {r[-1] for r in got} == {True, False}


def test_a_hot_source_over_many_tasks(spark):
    names = ["hot" if i % 3 else f"src{i % 11}" for i in range(1500)]
    docs = documents(spark, [f"t{i}\n" for i in range(1500)], names).repartition(7)
    assert told(docs) == sorted(brute(docs.collect()), key=repr)


def test_untouched_rows_verify_and_ways_are_short(spark):
    docs = documents(spark, [prose(3, i) for i in range(100)])
    rows = merkle.manifest(docs, FIELDS).collect()
    assert all(r["verified"] for r in rows)
    assert max(len(r["way"]) for r in rows) == 5  # 34 leaves a source, 3 sources


def test_empty_table(spark):
    assert merkle.manifest(documents(spark, ["a"]).limit(0), FIELDS).collect() == []
