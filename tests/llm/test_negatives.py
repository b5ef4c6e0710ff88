from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from perishables.llm import negatives as N

ROWS = "vec_id long, embedding array<float>, label int, row string, codes string"


def plain(rows, positives=5, negatives=10, window=(30, 90), every=100):
    """Every anchor with every row, in Python's integers."""
    dim = max([len(v) for _, v, _ in rows if v is not None], default=0)
    limit = N.component_limit(dim)
    used = []
    for i, v, label in rows:
        if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            whole = [max(-limit, min(limit, math.floor(256.0 * float(np.float32(x))))) for x in v]
            used.append((i, label, whole + [0] * (dim - len(v))))
    out = []
    for a, (i, label, v) in enumerate(used):
        if i is None or i % every:
            continue
        order = sorted(((-sum(x * y for x, y in zip(v, w)), j is None, j or 0, r) for r, (j, _, w) in enumerate(used) if r != a))
        for s, _, _, p in [o for o in order if used[o[3]][1] == label][:positives]:
            fits = [(t, n) for t, _, _, n in order if used[n][1] != label and window[0] * -s <= 100 * -t <= window[1] * -s]
            out += [(i, used[p][0], rank + 1, used[n][0], -s, -t) for rank, (t, n) in enumerate(fits[:negatives])]
    return sorted(out, key=repr)


def mined(spark, rows, every=100, **more):
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], ROWS)
    got = N.hard_negatives(table.coalesce(1), F.col("id") % every == 0, **more)
    return sorted(((r["anchor"], r["positive"], r["rank"], r["negative"], r["positive_score"], r["negative_score"]) for r in got.collect()), key=repr)


def vectors(seed, n=300, dim=20, labels=4, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, dim))
    label = rng.integers(0, labels, n)
    return [(i, [float(x) for x in (centres[c] + spread * rng.standard_normal(dim)) / 4], int(c)) for i, c in enumerate(label)]


@pytest.mark.parametrize("seed, dim, spread, block", [(1, 64, 1.0, 4096), (2, 7, 0.1, 4), (3, 70, 3.0, 9), (4, 1, 1.0, 4096)])
def test_against_every_pair(spark, seed, dim, spread, block):
    rows = vectors(seed, dim=dim, spread=spread)
    assert mined(spark, rows, every=20, block=block) == plain(rows, every=20) != []


def test_ties_repeated_rows_and_hot_labels(spark):
    rng = random.Random(7)
    rows = [(i % 40, [rng.choice([0.0, 0.25, 1.0]), 0.5], rng.choice([1, 1, 1, 2])) for i in range(150)]
    rows += [(0, [1.0, 0.5], 1)] * 3 + [(1, [0.5, 0.25], 2)] * 12
    assert mined(spark, rows, every=20) == plain(rows, every=20) != []


def test_odd_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (100, [1.0], 1), (None, [2.0, 1.0], 1), (None, [0.9, 0.1], 2), (3, None, 2), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2),
            (6, [None, 1.0], 2), (7, [1.0, 1.0], None), (8, [], 2), (9, [0.5, 0.9], 2), (10, [3e38, 1.0], 1), (200, [-3e38, 2.0], 2), (300, [0.0, 0.0], 1),
            (11, [0.5, 0.9], 2)]
    assert mined(spark, rows) == plain(rows) != []
    assert mined(spark, rows[:1]) == [] and mined(spark, []) == [] and mined(spark, rows[4:9]) == [] and mined(spark, [(1, [1.0], 1)]) == []


@pytest.mark.parametrize("levels, planes", [(1, 4), (2, 8), (3, 8)])
def test_intervals_hold_every_product(levels, planes):
    rng = np.random.default_rng(levels)
    rows = np.concatenate([rng.integers(-300, 300, (200, 33)), np.zeros((1, 33), int), np.full((2, 33), 1 << 27), np.eye(33, dtype=int)]).astype(np.int64)
    least, most = N.intervals(N.quantise(rows[:40], levels, planes), N.encode(rows, levels), 33)
    true = rows[:40].astype(float) @ rows.T.astype(float)
    assert (least <= true).all() and (true <= most).all()
    width = (most - least)[:, :200] / (np.linalg.norm(rows[:40], axis=1)[:, None] * np.linalg.norm(rows[:200], axis=1))
    assert np.median(width) / 2 < 0.65 ** levels + 0.15   # each level leaves about 0.6 of a vector


def test_intervals_spare_scores():
    """Of clustered rows, few intervals reach into an anchor's best."""
    rows = np.array([v for _, v, _ in vectors(5, n=2000, dim=64, labels=20, spread=0.2)]) * 256
    whole = np.floor(rows).astype(np.int64)
    _, most = N.intervals(N.quantise(whole[:50]), N.encode(whole), 64)
    fifth = np.sort((whole[:50] @ whole.T), axis=1)[:, -6]
    assert (most >= fifth[:, None]).mean() < 0.2
