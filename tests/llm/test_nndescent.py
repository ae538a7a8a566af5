import numpy as np
import pytest
from helpers import components

from rosterloom.llm import nndescent


def brute(rows):
    valid = {i: np.array(v, float) for i, (_, v, label) in enumerate(rows)
             if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    pairs = [(a, b) for a in valid for b in valid if a < b and rows[a][2] == rows[b][2]
             and len(valid[a]) == len(valid[b]) and valid[a] @ valid[b] >= 0.98
             * np.linalg.norm(valid[a]) * np.linalg.norm(valid[b])]
    roots = components(range(len(rows)), pairs)
    links = [sum(i in p for p in pairs) for i in range(len(rows))]
    return links, {i: rows[r][0] for i, r in roots.items()}


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "vec_id long, embedding array<float>, label int, id string, n int")


def test_links_and_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "TILE", 16)  # dense groups meet in several cells
    draw = np.random.default_rng(1)
    rows = []
    for group in range(12):
        centre = draw.standard_normal(24)
        for _ in range(1 + group % 3 + 70 * (group == 5)):
            spread = 0.02 if group % 2 else 0.06
            rows.append((centre + spread * draw.standard_normal(24)).astype(np.float32).tolist())
    rows += [rows[0]] * 40 + [draw.standard_normal(24).astype(np.float32).tolist()
                              for _ in range(150)]
    rows += [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23,
             [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    table = [(1000 + i, v, None if i % 31 == 0 else i % 31 % 2) for i, v in enumerate(rows)]
    links, least = brute(table)
    got = {r["vec_id"]: r for r in nndescent.near_duplicates(vectors(spark, table)).collect()}
    assert len(got) == len(table)
    for i, (vec_id, _, _) in enumerate(table):
        r = got[vec_id]
        assert (r["n_links"], r["component_id"], r["kept"]) == (
            links[i], least[i], least[i] == vec_id)


def test_audit_measures_recall(spark):
    same = np.random.default_rng(2).standard_normal(8).tolist()
    classes = spark.createDataFrame([(1, i, same[:-1] + [same[-1] + i / 1e4])
                                     for i in range(4)], "label int, id long, vector array<double>")
    halves = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 2)], "node long, root long")
    assert nndescent.audit(classes, halves) == pytest.approx(1 / 3)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, [1.0], 1)],
                                  [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)]])
def test_few_rows(spark, rows):
    got = nndescent.near_duplicates(vectors(spark, rows)).collect()
    assert [r["n_links"] for r in got] == [len(rows) - 1] * len(rows)


def test_groups_whose_lists_are_full_of_their_own_members(spark):
    """Two tight groups of one label that link only with each other, among others."""
    draw = np.random.default_rng(1)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    one = unit(draw.standard_normal(32))
    other = unit(draw.standard_normal(32))
    other = unit(other - (other @ one) * one)
    two = unit(one * np.cos(0.18) + other * np.sin(0.18))
    rows = [*unit(one + 0.003 * draw.standard_normal((150, 32))),
            *unit(two + 0.003 * draw.standard_normal((150, 32))),
            *unit(draw.standard_normal((1200, 32)))]
    sims = np.array(rows) @ np.array(rows).T
    linked = sims[:300, :300] >= 0.98
    # All pairs link, those inside a group by far more than those across.
    assert linked.all() and sims[:150, :150].min() > sims[:150, 150:300].max() + 0.005
    order = draw.permutation(len(rows))
    vectors = spark.createDataFrame([(int(i), rows[i].tolist(), 3) for i in order],
                                    "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in nndescent.near_duplicates(vectors).collect()}
    assert {(got[i]["n_links"], got[i]["component_id"]) for i in range(300)} == {(299, 0)}
    assert sum(got[i]["n_links"] for i in range(300)) // 2 == 44_850
    assert all(got[i]["n_links"] == 0 for i in range(300, 1500))
