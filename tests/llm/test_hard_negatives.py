import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string, row int"


def brute(rows, positives=5, negatives=5, scale=256):
    """Rows (vec_id, vector, label) that take part, as they stand; anchors are ids divisible by 100."""
    width = max((len(r[1]) for r in rows), default=0)
    v = [[int(np.floor(scale * float(np.float32(x)))) for x in r[1]] + [0] * (width - len(r[1])) for r in rows]
    out = Counter()
    for i, (anchor, _, label) in enumerate(rows):
        if anchor % 100:
            continue
        score = [sum(a * b for a, b in zip(v[i], w)) for w in v]
        order = sorted(range(len(rows)), key=lambda j: (-score[j], rows[j][0], j))
        for p in [j for j in order if j != i and rows[j][2] == label][:positives]:
            fit = [j for j in order if rows[j][2] != label and 80 * score[p] <= 100 * score[j] <= 100 * score[p]]
            for rank, j in enumerate(fit[:negatives], 1):
                out[anchor, rows[p][0], rank, rows[j][0], score[p], score[j]] += 1
    return out


def mined(df, **more):
    got = hn.mine(df, F.col("vec_id") % 100 == 0, **more)
    return Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                   for r in got.collect())


def some(n, dims, seed, labels=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, 0.4) for c in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).coalesce(1)


@pytest.mark.parametrize("dims", [3, 64, 70])
def test_equals_brute_force(spark, dims):
    rows = some(700, dims, dims)
    assert mined(frame(spark, rows)) == brute(rows)


def test_many_groups_give_the_same(spark, monkeypatch):
    rows = some(900, 8, 4)
    monkeypatch.setattr(hn, "_groups", lambda *_: 7)
    assert mined(frame(spark, rows), positives=3, negatives=2) == brute(rows, 3, 2)


def test_odd_vectors(spark):
    rows = some(120, 6, 9)
    same = rows[0][1]
    rows += [(200 + i, same, 1 - i % 2) for i in range(60)]  # ties
    rows += [(100, rows[100][1], rows[100][2]), (7, [], 0), (300, [0.0] * 6, 0), (301, [1.0], 1)]
    bad = [(400, None, 1), (None, same, 1), (402, [None, 1.0], 1), (403, [float("nan")] * 6, 1),
           (404, [float("inf")] * 6, 1), (500, same, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + bad], SCHEMA).coalesce(1)
    assert mined(df) == brute(rows)
    assert not mined(df.limit(0))
    assert not mined(df.where("vec_id % 100 <> 0"))
    assert not mined(df.where("label = 1"))


def test_large_components_stay_exact(spark):
    rows = [(i, [float(x) * 2 ** 20 for x in r[1]], r[2]) for i, r in enumerate(some(150, 4, 5))]
    assert mined(frame(spark, rows)) == brute(rows)


def test_intervals_hold_and_filter():
    rng = np.random.default_rng(3)
    v = np.floor(256 * rng.standard_normal((500, 64)))
    turns = hn.rotations(64)
    a, b = hn.Anchors(v[:50], turns), hn.Coded(v, turns)
    low, high = hn.intervals(a, slice(0, 50), b, np.arange(500))
    exact = v[:50] @ v.T
    assert (low <= exact).all() and (exact <= high).all()
    # the intervals are narrow enough to leave most pairs out
    reach = high >= hn._kth_largest(low, 5)[:, None]
    assert reach.mean() < 0.3


def test_refuses_no_positives(spark):
    with pytest.raises(ValueError):
        hn.mine(frame(spark, some(3, 2, 1)), F.lit(True), positives=0)
