import random
import zlib

import numpy as np
from helpers import documents, odd_texts, prose

from rosterloom.llm import packing


def test_both_libraries_give_the_same_ids():
    tokenizer = packing.Tokenizer()
    for text in [t for t in odd_texts() if t] + [
            "<|endoftext|> is text", "it's  3.14\n\n\tend ", "é" * 300, " " * 5000 + "x"]:
        assert tokenizer.ids(text) == tokenizer.full_ids(text)


def test_best_fit_takes_the_tightest_bin():
    bins = packing.fill({6: 1, 5: 1, 4: 2}, 10)
    assert bins == {(6, 4): 1, (5, 4): 1}


def test_evolution_keeps_every_item_and_no_bin_overflows():
    draw = random.Random(3)
    items = {draw.randint(1, 100): draw.randint(1, 9) for _ in range(60)}
    population = [packing.fill(items, 100), *(packing.fill(items, 100, draw=draw)
                                              for _ in range(4))]
    best = packing.evolve(population, items, 100, 6, draw)[0]
    assert packing.fitness(best, 100) <= packing.fitness(packing.fill(items, 100), 100)
    held = {}
    for lengths, n in best.items():
        assert sum(lengths) <= 100
        for length in lengths:
            held[length] = held.get(length, 0) + n
    assert held == items


def test_packing_is_exact(spark):
    texts = odd_texts() + [prose(n, n) for n in range(5, 300, 7)] + ["same words"] * 20
    docs = documents(spark, texts)
    rows = packing.pack(docs, ["doc_id", "rank"], with_ids=True).toPandas()
    tokenizer = packing.Tokenizer()
    for doc_id, own in rows.sort_values("piece").groupby("doc_id"):
        ids = [*tokenizer.full_ids(texts[doc_id] or ""), packing.END]
        assert [x for part in own.ids for x in part] == ids
        assert list(own.start) == [sum(own.length.iloc[:k]) for k in range(len(own))]
        assert (own.length.iloc[1:] == packing.CAPACITY).all()
        for part, check in zip(own.ids, own.ids_crc32):
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == check
    assert set(rows.doc_id) == set(range(len(texts))) and set(rows["rank"]) == {"x"}
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert list(own.offset) == [sum(own.length.iloc[:k]) for k in range(len(own))]
        assert own.length.sum() <= packing.CAPACITY
    plain = packing.fill(rows.groupby("length").size().to_dict(), packing.CAPACITY)
    assert rows.sequence_id.nunique() <= sum(plain.values())


def test_sequences_hold_the_pieces(spark):
    packed = packing.pack(documents(spark, ["a b", None, "c d e"]), ["doc_id"], with_ids=True)
    rows = packing.sequences(packed).collect()
    assert len(rows) == 1 and list(rows[0]["ids"]).count(packing.END) == 3


def test_empty_table(spark):
    assert packing.pack(documents(spark, ["a"]).limit(0), ["doc_id"]).count() == 0
