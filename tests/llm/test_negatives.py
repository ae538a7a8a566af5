import random
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, anchor string, id long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA)


def brute(rows, positives=5, count=5):
    rows = [(i, v, (label + 1) % 10 if i is not None and i % 7 == 0 else label)
            for i, v, label in rows if label is not None and v is not None
            and all(x is not None and isfinite(x) for x in v)]
    rows = [(i, [floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows]
    out = []
    for a, (i, v, label) in enumerate(rows):
        if i is None or i % 100:
            continue
        others = sorted((-sum(x * y for x, y in zip(v, w)), 1 << 62 if j is None else j, b)
                        for b, (j, w, _) in enumerate(rows) if b != a)
        same = [o for o in others if rows[o[2]][2] == label][:positives]
        for score, _, p in same:
            fits = [(s, n) for s, _, n in others if rows[n][2] != label
                    and 80 * -score <= 100 * -s <= 100 * -score][:count]
            out += [(i, rows[p][0], rank, rows[n][0], -score, -s)
                    for rank, (s, n) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    vectors = table(spark, rows)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label=moved, **options)
    return sorted(map(tuple, got.collect()), key=repr)


def drawn(count, dim, labels=3, seed=1, step=0.25):
    draw = random.Random(seed)
    return [(i, [draw.choice((-1, 1)) * step * draw.randint(0, 4) + (i % 5 == 0)
                 for _ in range(dim)], draw.randrange(labels)) for i in range(count)]


@pytest.mark.parametrize("shape", [(1, 1), (40, 300), (7, 16), (5, 600)])
def test_products_are_exact(shape):
    draw = np.random.default_rng(3)
    for most in (0, 1, 255, 40_000, 1_000_000):
        a, b = (draw.integers(-most, most + 1, (n, shape[1])) for n in (shape[0], 9))
        a[0], b[0] = most, -most
        moduli = negatives.primes(shape[1] * most * most)
        assert (negatives.products(a, b, moduli) == a @ b.T).all()


def test_scores_beyond_64_bits_are_an_error():
    with pytest.raises(ValueError):
        negatives.primes(1 << 62)


def test_equals_plain_search(spark):
    rows = drawn(700, 6)
    assert mined(spark, rows) == brute(rows) != []


def test_many_blocks_and_long_vectors(spark):
    rows = drawn(420, 300, labels=2, seed=4)
    assert mined(spark, rows, block_bytes=8 * 310) == brute(rows) != []


def test_odd_rows_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = drawn(260, 4, labels=2, seed=2, step=0.5)
    rows += [(300, None, 0), (400, [1.0, None, 0.0, 0.0], 0), (500, [nan] * 4, 0),
             (600, [inf] * 4, 1), (800, [1.0] * 4, None), (None, [2.0] * 4, 0), (None, [2.0] * 4, 1),
             (900, [], 0), (1000, [0.0] * 4, 1), (1100, [2.0, 2.0], 0), (1200, [-9.0] * 4, 0)]
    rows += [(100, [1.0] * 4, 0)] * 3 + [(207, [1.0] * 4, 1)] * 9  # repeated rows, equal scores
    got = mined(spark, rows)
    assert got == brute(rows) != []


def test_a_hot_vector_and_a_hot_label(spark):
    rows = [(i, [1.0, 0.5] if i % 3 else [0.9, i / 2000], i % 9 == 0) for i in range(2500)]
    rows = [(i, v, int(label)) for i, v, label in rows]
    assert mined(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(1, [1.0], 1)]) == []
