import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import components, documents, odd_texts, prose
from pyspark.sql import functions as F

from rosterloom.llm import simhash


def brute_fingerprint(text, words):
    tokens = [t for t in (text or "").translate(
        str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})).replace("\t", " ").replace(
        "\n", " ").split(" ") if t]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprint_follows_its_definition():
    for text in odd_texts():
        if len(text or "") < 5000:
            assert int.from_bytes(simhash.fingerprint(text, 3), "big") == brute_fingerprint(text, 3)


def test_spark_hash_is_the_shingle_hash(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert value % 2 ** 64 == xxhash.xxh64_intdigest(b"a b c", seed=42)


@pytest.mark.parametrize("width,radius", [(1, 0), (1, 3), (2, 11), (8, 96)])
def test_sliced_distances_equal_plain_ones(width, radius):
    draw = np.random.default_rng(width)
    base = draw.integers(0, 256, (30, 8 * width), dtype=np.uint8)
    fps = np.concatenate([base, base, base, base[:7]])
    for row in fps[30:]:
        for bit in draw.integers(0, 64 * width, draw.integers(0, 2 * radius + 3)):
            row[bit // 8] ^= 1 << (bit % 8)
    a, b = simhash.near(simhash.Tile(fps[:41]), simhash.Tile(fps), radius)
    plain = np.unpackbits(fps[:41, None] ^ fps[None], axis=2).sum(2) <= radius
    assert set(zip(a.tolist(), b.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(plain))))


def test_exact_tables_miss_no_pair_within_the_radius():
    draw = np.random.default_rng(5)
    tables = simhash.exact_tables(64, 3)
    for _ in range(500):
        flipped = set(draw.choice(64, 3, replace=False).tolist())
        assert any(not flipped & set(t) for t in tables)


@pytest.mark.parametrize("hot", [simhash.HOT_BUCKET, 4])
def test_components_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash.links, "__defaults__", (hot,))
    texts = odd_texts() + [prose(60, 9)] * 3
    for i in range(25):
        words = prose(120, 7).split()
        words[i] = "new"
        texts.append(" ".join(words))
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    fps = {i: int.from_bytes(simhash.fingerprint(t, 3), "big") for i, t in enumerate(texts)}
    roots = components(fps, [(a, b) for a in fps for b in fps
                             if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    assert {i: int.from_bytes(r["fp"], "big") for i, r in got.items()} == fps
    assert {i: r["component_id"] for i, r in got.items()} == roots


def test_null_ids_and_empty_table(spark):
    docs = documents(spark, ["same words here", "same words here", "others are these ones"],
                     ids=[None, 7, None])
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in rows) == [
        ("7", "7"), ("None", "7"), ("None", "None")]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.deduplicated(docs.limit(0)).count() == 0


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def test_dedup_keeps_one_of_each_group(spark):
    texts = odd_texts()
    for copies, changed in ((6, 1), (6, 9)):  # above and below the similarity
        for i in range(copies):
            words = prose(90, 40 + changed).split()
            for k in range(changed):
                words[(i * 13 + k * 9) % 90] = f"new{i}{k}"
            texts.append(" ".join(words))
    docs = documents(spark, texts)
    kept = simhash.deduplicated(docs.union(docs))  # repeated rows count as one
    sets = [shingles(t) for t in texts]
    roots = components(range(len(texts)), [
        (a, b) for a in range(len(texts)) for b in range(a)
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots.values()))
    assert kept.columns == docs.columns


def left(spark, texts):
    return sorted(r["doc_id"] for r in simhash.deduplicated(documents(spark, texts)).collect())


def test_dedup_compares_distinct_shingles(spark):
    words = prose(215, 3).split()
    line = " ".join(words[100:119])  # 15 shingles
    texts = [" ".join(words)]
    for times in (5, 10, 40):
        texts.append(" ".join([*words[:119], *(line.split() * times), *words[119:]]))
    sets = [shingles(t) for t in texts]
    assert all(len(sets[0] & x) >= 0.8 * len(sets[0] | x) for x in sets)
    assert left(spark, texts) == [0]


def test_dedup_misses_no_pair_at_the_similarity(spark):
    texts, shared = [], {4: 5, 8: 10, 12: 15, 40: 50, 160: 200}  # shingles: common, in all
    for n, total in shared.items():
        for i in range(30):
            words = [f"w{n}x{i}x{k}" for k in range(total + 4)]
            texts += [" ".join(words[:n + 4]), " ".join(words)]  # a Jaccard similarity of 0.8
            texts.append(" ".join(w + "y" for w in words[:n + 3]))
            texts.append(" ".join([w + "y" for w in words[:n + 3]] + [f"z{k}" for k in range(total)]))
    assert left(spark, texts) == [i for i in range(len(texts)) if i % 4 != 1]


def test_a_screen_turns_no_key_away(spark, monkeypatch):
    from pyspark.sql import functions as F

    from rosterloom.llm import common
    keys = spark.range(3000).select(F.xxhash64("id").alias("k"))
    others = spark.range(3000, 9000).select(F.xxhash64("id").alias("k"))
    for most in (common.SCREEN_BITS, 1 << 15):
        monkeypatch.setattr(common, "SCREEN_BITS", most)
        passes = common.screen(keys, "k")
        assert keys.where(passes("k")).count() == 3000
        assert others.where(passes("k")).count() < 900
    assert others.where(common.screen(keys.limit(0), "k")("k")).count() == 0


def test_dedup_of_a_large_group_of_near_copies(spark):
    base = prose(60, 9).split()
    draw = random.Random(5)
    texts = []
    for i in range(5000):
        words = list(base)
        words[draw.randrange(60)] = f"w{i}"
        texts.append(" ".join(words))
    texts += [prose(50, 1000 + i) for i in range(200)]
    kept = [r["doc_id"] for r in simhash.deduplicated(documents(spark, texts)).collect()]
    # One change touches at most 5 of 56 shingles, so any two copies share over two thirds of
    # them, and each is similar to the many that are changed nearby.
    assert sorted(kept) == [0, *range(5000, 5200)]


def test_dedup_goes_through_fingerprints(spark, monkeypatch):
    texts = [prose(90, 300 + i) for i in range(40)]
    texts += [t.replace(" ", "  ") + "\n" for t in texts[:10]]  # other texts, equal fingerprints
    grouped, confirmed, own, verified = [], [], simhash.fingerprint_groups, simhash.verified

    def noted(table):
        found = own(table)
        grouped.append(found.count())
        return found

    def checked(members, words, least, every):
        found = verified(members, words, least, every)
        confirmed.append(found.count())
        return found

    monkeypatch.setattr(simhash, "fingerprint_groups", noted)
    monkeypatch.setattr(simhash, "verified", checked)
    assert left(spark, texts) == list(range(40))
    # What fingerprints join is confirmed, and nothing is left for shared shingles to find.
    assert grouped == [20] and confirmed == [10, 0]


def test_dedup_of_texts_that_only_share_a_passage_with_the_next(spark, monkeypatch):
    def no_cells(*_):
        raise AssertionError("pairs that share a shingle need no cells of whole groups")

    monkeypatch.setattr(simhash, "_near", no_cells)
    passages = [prose(7, 500 + i) for i in range(301)]
    texts = [f"{passages[i]} {prose(30, 2000 + i)} {passages[i + 1]}" for i in range(300)]
    assert left(spark, texts) == list(range(300))


def test_dedup_where_shingles_are_shared_by_many(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_SHINGLE", 3)
    monkeypatch.setattr(simhash, "WIDE_PART", 8)
    draw = random.Random(6)
    texts = []
    for group in range(12):
        base = prose(60, 700 + group).split()
        for i in range(9):
            words = list(base)
            for _ in range(i % 3):
                words[draw.randrange(60)] = f"w{group}x{i}"
            texts.append(" ".join(words))
    sets = [shingles(t) for t in texts]
    roots = components(range(len(texts)), [
        (a, b) for a in range(len(texts)) for b in range(a)
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    for without in (False, True):  # also where fingerprints find nothing
        if without:
            own = simhash.fingerprint_groups
            monkeypatch.setattr(simhash, "fingerprint_groups", lambda t: own(t).limit(0))
        assert left(spark, texts) == sorted(set(roots.values()))


def test_bitmaps_never_part_similar_sets():
    draw = random.Random(8)
    sets = []
    for n in (1, 3, 20, 31, 33, 60, 64, 70, 300, 520, 700):
        base = np.array([draw.getrandbits(64) - 2 ** 63 for _ in range(n)], np.int64)
        for change in (0, 0.02, 0.1, 0.11, 0.3, 0.9):
            own = base.copy()
            own[:int(n * change)] = [draw.getrandbits(63) for _ in range(int(n * change))]
            sets += [own, own[:int(n * 0.85) or 1]]
    low = np.array([i % 2 == 0 for i in range(len(sets))])
    bits = [simhash.parity(s) for s in sets]
    for own in (True, False):
        near = set(map(frozenset, zip(*simhash._close(
            np.array([len(s) for s in sets]), bits, low, own, 0.8))))
        similar = {frozenset((a, b)) for a in range(len(sets)) for b in range(a)
                   if (own or low[a] != low[b])
                   and len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(
                       np.union1d(sets[a], sets[b])) - 1e-9}
        assert similar <= near and len(near) < 2 * len(similar)


def test_rows_of_a_shared_shingle_grow_with_its_texts():
    for n, copies in ((10, 1), (600, 1), (600, 3), (simhash.HOT_SHINGLE + 5, 1)):
        nodes = np.repeat(np.arange(n), copies)
        place = np.full(len(nodes), 50 << 32)
        for label in (nodes, nodes % 2):  # all apart, and two large groups
            batch = pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (np.full(len(nodes), 7), place, nodes, label)],
                ["shingle", "place", "node", "label"])
            rows = [r for b in simhash._meetings(0.8)(iter([batch])) for r in b.to_pylist()]
            if n == 10:
                assert {(r["a"], r["b"]) for r in rows} == {
                    (a, b) for b in range(n) for a in range(b) if label[a] != label[b]}
            else:
                assert n - 1 <= len(rows) <= n
                assert all(r["b"] is None or r["a"] != r["b"] for r in rows)


@pytest.mark.parametrize("labelled,several", [(False, False), (True, False), (False, True)])
def test_a_crowded_shingle_loses_no_pair(spark, monkeypatch, labelled, several):
    monkeypatch.setattr(simhash, "WIDE_PART", 32)
    draw = random.Random(12)
    sets, similar = {}, []
    for i in range(150):  # pairs at a similarity over 0.8, no others
        base = [draw.getrandbits(64) - 2 ** 63 for _ in range(100)]
        a, b = draw.getrandbits(62), draw.getrandbits(62)
        sets[a], sets[b] = base, base[:95] + [draw.getrandbits(62) for _ in range(5)]
        similar.append((a, b))
    # One shingle is in all texts, or a text shares one with those before and one with the next.
    table = spark.createDataFrame(
        [(n, 100, [i // 50, i // 50 + 1] if several else [7],
          bytearray(simhash.parity(np.array(x, np.int64)).tobytes()))
         for i, (n, x) in enumerate(sets.items())],
        "node long, size int, prefix array<long>, bits binary")
    # Where the first texts of all pairs have one label, second ones still meet each of them.
    labels = spark.createDataFrame([(a, 5) for a, _ in similar if labelled],
                                   "short long, label long")
    found = simhash.proposed_groups(simhash.cut_lineage(table), labels)
    groups = {}
    for r in found.collect():
        groups.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, similar))


def test_dedup_where_shingles_are_crowded(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWDED", 3)
    monkeypatch.setattr(simhash, "WIDE_PART", 8)
    own = simhash.fingerprint_groups  # half of what fingerprints find is left to shingles
    monkeypatch.setattr(simhash, "fingerprint_groups", lambda t: own(t).where("short % 2 = 0"))
    draw = random.Random(7)
    texts = []
    for group in range(6):
        base = prose(60, 800 + group).split()
        for i in range(18):
            words = list(base)
            for _ in range(i % 4):
                words[draw.randrange(60)] = f"w{group}x{i}"
            texts.append(" ".join(words))
    sets = [shingles(t) for t in texts]
    roots = components(range(len(texts)), [
        (a, b) for a in range(len(texts)) for b in range(a)
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    assert left(spark, texts) == sorted(set(roots.values()))
