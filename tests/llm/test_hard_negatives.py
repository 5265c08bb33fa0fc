import math
import random

import numpy as np
import pytest

from tests.llm.helpers import empty
from tidylake.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchors, n_pos=5, n_neg=10):
    """Lists in, sorted tuples out."""
    def good(r):
        return None not in (r[0], r[1], r[2]) and all(x is not None and math.isfinite(x) for x in r[1])

    def whole(r):
        return r[0], [math.floor(256 * x) for x in r[1]], r[2]
    rows = [whole(r) for r in rows if good(r)]
    asked = {}
    for r in sorted(map(whole, filter(good, anchors)), key=lambda r: (r[0], r[2], len(r[1]), r[1])):
        asked.setdefault(r[0], r)
    out = []
    for a, v, label in asked.values():
        scored = [(min(max(sum(x * y for x, y in zip(v, w)), -2**63), 2**63 - 1), i, k)
                  for i, w, k in rows if i != a and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in scored if s[2] == label][:n_pos]:
            found = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p][:n_neg]
            out += [(a, pid, i + 1, s[1], p, s[0]) for i, s in enumerate(found)]
    return sorted(out)


def mined(spark, rows, anchors, **more):
    got = H.mine(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(anchors, SCHEMA), **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(map(tuple, got.collect()))


def random_rows(n, dim, seed, labels=4, coarse=1):
    rnd = random.Random(seed)
    return [(i, [round(rnd.gauss(0, 1) * coarse) / coarse / 4 + 0.1 for _ in range(dim)], rnd.randrange(labels))
            for i in range(n)]


@pytest.mark.parametrize("n, dim, coarse, shard, block", [(300, 6, 50, 64, 7), (200, 3, 2, 40, 1000),
                                                          (260, 20, 1, 10**6, 10**6)])
def test_equals_brute_force(spark, monkeypatch, n, dim, coarse, shard, block):
    monkeypatch.setattr(H, "SHARD_ROWS", shard)
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    rows = random_rows(n, dim, n, coarse=coarse)
    anchors = [r for r in rows if r[0] % 20 == 0]
    want = brute(rows, anchors)
    assert want and mined(spark, rows, anchors) == want


def test_odd_rows(spark):
    good = random_rows(80, 4, 9, labels=2, coarse=3)
    odd = [(None, [1.0] * 4, 0), (1000, None, 0), (1001, [1.0] * 4, None), (1002, [1.0, None, 1.0, 1.0], 1),
           (1003, [1.0, float("nan"), 1.0, 1.0], 1), (1004, [float("inf")] * 4, 0), (1005, [], 0), (1006, [], 1),
           (1007, [1.0] * 5, 0), (1008, [2.0] * 5, 0), (1009, [1.5] * 5, 1), (-20, [0.5] * 4, 0)]
    rows = good + odd + good[:30] + [(5, [9.0] * 4, 1)]  # repeated rows, one id with two vectors
    anchors = [r for r in rows if r[0] is not None and r[0] % 5 == 0] + odd
    assert mined(spark, rows, anchors) == brute(rows, anchors)


def test_one_hot_vector_and_label(spark, monkeypatch):
    monkeypatch.setattr(H, "SHARD_ROWS", 50)
    rows = [(i, [1.0, 0.5], 0) for i in range(300)] + [(i, [0.5, 0.25], 1) for i in range(300, 360)]
    anchors = rows[::40]
    want = brute(rows, anchors)
    assert want and mined(spark, rows, anchors) == want


@pytest.mark.parametrize("size", [2.0**20, 2.0**22, 2.0**24, 2.0**40])
def test_large_scores_are_exact(spark, size):
    rnd = random.Random(4)
    rows = [(i, [size * rnd.choice([1, 2, 3]) + rnd.randrange(5) for _ in range(3)], i % 2) for i in range(40)]
    want = brute(rows, rows[:8])
    assert mined(spark, rows, rows[:8]) == want


def test_empty_tables(spark):
    rows = random_rows(20, 3, 1)
    none = empty(spark, SCHEMA)
    full = spark.createDataFrame(rows, SCHEMA)
    assert H.mine(none, none).collect() == [] and H.mine(full, none).collect() == []
    assert H.mine(none, full).collect() == []


def test_clashing_columns(spark):
    from pyspark.sql import functions as F
    rows = random_rows(60, 3, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "dim", "parts", "score", "rank", "a.b", "block"):
        df = df.withColumn(name, F.lit("clash"))
    anchors = df.where("vec_id % 10 = 0")
    assert sorted(map(tuple, H.mine(df, anchors).collect())) == brute(rows, rows[::10])


def test_tiles_and_boxes():
    rng = np.random.default_rng(1)
    rows = np.floor(rng.normal(size=(1000, 5)) * 100)
    tree = H.Tree(np.arange(1000), rows, leaf=16, fanout=4)
    assert sorted(tree.ids.tolist()) == list(range(1000)) and len(tree.levels[-1][0]) == 1
    low, high = tree.levels[0]
    for i in range(len(low)):
        part = tree.rows[i * 16:(i + 1) * 16]
        assert (part.min(0) == low[i]).all() and (part.max(0) == high[i]).all()
    # packed tiles are much smaller than runs of the rows as given
    runs = np.prod([np.ptp(rows[a:a + 16], axis=0) / 100 for a in range(0, 1000, 16)], axis=1).mean()
    assert np.prod((high - low) / 100, axis=1).mean() < runs / 3


def test_boxes_outside_are_never_opened():
    rng = np.random.default_rng(2)
    rows = np.floor(np.abs(rng.normal(size=(4000, 2))) * 100)
    tree = H.Tree(np.arange(4000), rows, leaf=16, fanout=4)
    opened = []
    best = H.Best(5)
    tree.search(np.array([3.0, 4.0]), [best], opened)
    scores = rows @ [3.0, 4.0]
    assert best.scores.tolist() == sorted(scores.tolist(), reverse=True)[:5]
    assert len(opened) < len(tree.levels[0][0]) / 5
    opened.clear()
    best = H.Best(10**6, 200, 210)
    tree.search(np.array([3.0, 4.0]), [best], opened)
    assert sorted(best.scores.tolist()) == sorted(scores[(scores >= 200) & (scores <= 210)].tolist())
    assert len(opened) < len(tree.levels[0][0]) / 3
