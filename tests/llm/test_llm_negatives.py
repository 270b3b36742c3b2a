"""Hard negatives against all pairs."""

import math

import numpy as np
from pyspark.sql import functions as F

from shoreline.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int, place string"


def expected(rows, positives=5, negatives=10):
    good = [(i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, label, v in {(i, label, tuple(v)) for i, label, v in good if i % 100 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in good if j != i and len(w) == len(v))
        for place, (score, j, _) in enumerate([s for s in scored if s[2] == label][:positives]):
            inside = [(n, m) for n, m, other in scored if other != label and 30 * -score <= 100 * -n <= 90 * -score]
            out += [(i, j, place + 1, rank + 1, m, -score, -n) for rank, (n, m) in enumerate(inside[:negatives])]
    return sorted(out)


def mined(spark, rows, **sizes):
    given = spark.createDataFrame([(i, v, label, 1.0, 2, "x") for i, v, label in rows], SCHEMA).repartition(3)
    found = N.mine_hard_negatives(given, F.col("vec_id") % 100 == 0, **sizes)
    return sorted(tuple(r) for r in found.collect())


def vectors(count, dims=20, seed=3, spread=0.7):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    return [(i, [float(x) for x in (centers[i % 6] + spread * rng.normal(size=dims)) / dims ** 0.5], int(i % 4)) for i in range(count)]


def test_equals_brute_force(spark):
    rows = vectors(420)
    assert expected(rows) and mined(spark, rows) == expected(rows)


def test_blocks_change_nothing(spark):
    rows = vectors(420)
    assert mined(spark, rows, block_rows=50, block_anchors=2) == expected(rows)


def test_messy_rows(spark):
    rows = vectors(300) + [(None, [1.0] * 20, 1), (500, None, 1), (501, [float("nan")] * 20, 1), (502, [1.0] * 19 + [None], 1),
                           (503, [float("inf")] * 20, 2), (504, [1.0] * 20, None), (600, [], 1), (601, [], 2), (700, [0.0] * 20, 0), (800, [0.3] * 7, 1),
                           (801, [0.4] * 7, 1), (802, [0.2] * 7, 2)]
    assert mined(spark, rows) == expected(rows)


def test_repeated_rows_and_ties(spark):
    same = [(i, [0.5, 0.5, -0.25, 0.25], 1) for i in range(100, 131)] + [(i, [0.5, 0.25, -0.25, 0.25], 2) for i in range(200, 230)]
    rows = same + [same[3]] * 4 + [same[40]] * 12 + [same[0]] * 2
    assert mined(spark, rows, block_rows=7) == expected(rows)


def test_one_id_with_different_rows(spark):
    rows = vectors(150) + [(100, [0.3] * 20, 1), (100, [0.1] * 20, 2)]
    assert mined(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_summaries_bound_scores_and_prune():
    rng = np.random.default_rng(0)
    v = rng.integers(-300, 300, (200, 64)) + rng.integers(-500, 500, (200, 1))
    s, at = N.segment_summary(v), 0
    exact = v @ v.T
    for level in N.LEVELS:
        mean, dev = s[:, at:at + level], s[:, at + level:at + 2 * level]
        assert (np.abs(exact - mean @ mean.T) <= dev @ dev.T + 1e-3).all()
        at += 2 * level
    calls = []

    class Watched(np.ndarray):
        def __getitem__(self, rows):
            calls.append(np.size(rows))
            return np.asarray(super().__getitem__(rows))
    N.bounded_search(v.view(Watched), s, np.ones(200, bool), v[0], s[0], [(-math.inf, math.inf)], 5, np.arange(200))
    assert calls[0] < 150
