import zlib

import numpy as np
import pytest
from helpers import documents, odd_texts, prose

from rosterloom.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def test_rules_and_weights_find_a_conjunction():
    draw = np.random.default_rng(0)
    x = draw.random((3000, len(quality.STATISTICS)))
    y = ((x[:, 2] > 0.3) & (x[:, 5] <= 0.7)).astype(float)
    model = quality.fit(x, y)
    fresh = draw.random((2000, x.shape[1]))
    true = (fresh[:, 2] > 0.3) & (fresh[:, 5] <= 0.7)
    assert ((model.scores(fresh) >= 0.5) == true).mean() > 0.93
    assert all(len(r) <= quality.DEPTH for r in model.rules)


def test_lasso_drops_useless_columns():
    draw = np.random.default_rng(1)
    z = draw.integers(0, 2, (2000, 30)).astype(float)
    y = z[:, 4]
    weights, _ = quality._lasso(z, y, 0.02, np.zeros(30), 0.0)
    assert weights[4] > 1 and np.abs(np.delete(weights, 4)).max() < 0.1


@pytest.mark.parametrize("y", [[], [1.0] * 50, [0.0] * 50])
def test_labels_of_one_class(y):
    model = quality.fit(np.zeros((len(y), len(quality.STATISTICS))), np.array(y))
    score = model.scores(np.zeros((1, len(quality.STATISTICS))))[0]
    assert 0 < score < 1 and (score > 0.5 if y and y[0] else score <= 0.5)


def corpus():
    texts = [prose(40, i) + "." for i in range(300)]
    for i in range(0, 300, 3):
        texts[i] = " ".join(["AGAIN!!", "###"] * 20)
    return texts


def test_column_and_array_scores_agree(spark):
    texts = corpus() + odd_texts()
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)]
                                   + [(5, None, 0), (None, 1, 0), (7, 1, 0)], LABELS)
    model = quality.learn(docs, labels)
    table = quality.statistics(docs.select("doc_id", "text")).toPandas().sort_values("doc_id")
    expected = model.scores(table[[f"stat_{c}" for c in quality.STATISTICS]].to_numpy())
    got = quality.scored(docs.select("doc_id", "text"), model).toPandas().sort_values("doc_id")
    assert np.allclose(got.score, expected) and not got.score.isna().any()
    assert ((got.score[:300] >= 0.5) == (got.doc_id[:300] % 3 > 0)).mean() > 0.98
    good = quality.good_documents(docs.withColumnRenamed("rank", "score"), labels)
    assert "score" in good.columns and set(r["doc_id"] for r in good.collect()) == set(
        got.doc_id[got.score >= quality.GOOD])


def test_held_out_labels_are_never_learned_from(spark):
    docs = documents(spark, corpus())
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(300)]
    rows = docs.select("doc_id", quality.held_out().alias("h")).collect()
    assert {r["doc_id"]: r["h"] for r in rows} == dict(enumerate(held))
    plain = [(i, int(i % 3 > 0), 0) for i in range(300)]
    turned = [(i, 1 - q if held[i] else q, t) for i, q, t in plain]
    a, b = (quality.learn(docs, spark.createDataFrame(x, LABELS)) for x in (plain, turned))
    assert (a.rules, a.weights, a.bias) == (b.rules, b.weights, b.bias)


def test_the_spread_of_rows_does_not_matter(spark):
    docs = documents(spark, corpus())
    labels = spark.createDataFrame([(i, int(i % 3 > 0 or i % 7 == 0), 0) for i in range(300)],
                                   LABELS)
    a, b = (quality.learn(docs.repartition(n), labels.repartition(n)) for n in (1, 5))
    assert (a.rules, a.weights, a.bias) == (b.rules, b.weights, b.bias)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = quality.op10_quality(spark, folder).where("held_out").join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    assert len(rows) > 50 and (rows.predicted == rows.quality).mean() > 0.95


def test_empty_tables(spark):
    docs, none = documents(spark, ["a b c"]), spark.createDataFrame([], LABELS)
    assert quality.learn(docs, none).rules == []
    assert quality.good_documents(docs.limit(0), none).count() == 0
