import math
import random

import numpy as np
import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from subrev.llm import hard_negatives, vectors

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, divisor=50):
    ok = [(i, v, [math.floor(256 * x) for x in e], label) for i, (v, e, label) in enumerate(rows)
          if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, v, e, label in ok:
        if v is None or v % divisor:
            continue
        s = sorted(((-sum(map(int.__mul__, e, f)), w is None, w or 0, j, other) for j, w, f, other in ok if j != i))
        for p in [x for x in s if x[4] == label][:5]:
            inside = [x for x in s if x[4] != label and 50 * -p[0] <= 100 * -x[0] <= 95 * -p[0]][:3]
            out += [(v, None if p[1] else p[2], r + 1, None if x[1] else x[2], -p[0], -x[0]) for r, x in enumerate(inside)]
    return sorted(out, key=str)


def mined(spark, rows, **more):
    return sorted(map(tuple, hard_negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(5), **more).collect()), key=str)


def unit(rng, dim=24, around=None):
    x = [rng.gauss(0, 1) + (3 * around[i] if around else 0) for i in range(dim)]
    n = math.sqrt(sum(a * a for a in x))
    return [a / n for a in x]


def table(n=500, seed=1, labels=4):
    rng = random.Random(seed)
    centre = [unit(rng) for _ in range(labels)]
    return [(i, unit(rng, around=centre[i % labels] if i % 3 else None), i % labels) for i in range(n)]


def test_against_all_pairs(spark):
    rows = table()
    assert mined(spark, rows) == plain(rows) != []


@pytest.mark.parametrize("slack", [0.01, 100])
def test_first_thresholds_never_decide(spark, monkeypatch, slack):
    """Too high a start leads to more rounds, too low a one to more pairs."""
    rows = table(400, 2)
    monkeypatch.setattr(hard_negatives, "SLACK", slack)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 100)
    assert mined(spark, rows, divisor=20) == plain(rows, 20)


def test_small_blocks_and_chunks(spark, monkeypatch):
    rows = table(300, 3)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 32)
    monkeypatch.setattr(vectors, "CHUNK_BYTES", 1500)
    monkeypatch.setattr(hard_negatives, "GROUP", 3)
    assert mined(spark, rows, divisor=30) == plain(rows, 30)


def test_odd_rows_ties_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(4)
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (50, None, 1), (100, [nan, 1.0], 1), (150, [None, 1.0], 1), (200, [inf, 1.0], 2), (250, [1.0, 1.0], None),
            (None, [1.0, 0.0], 1), (None, [0.7, 0.0], 2), (300, [], 1), (350, [0.0, 0.0], 1), (400, [0.9], 1), (450, [-1.0, -1.0], 7), (500, [1e9, 2.0], 1)]
    rows += [(1000 + i, [1.0, 0.0], 1) for i in range(200)] + [(2000 + i, [rng.choice([0.6, 0.7, 0.8]), 0.0], 2) for i in range(60)]
    assert mined(spark, rows) == plain(rows)


def test_threshold_join_finds_every_pair():
    rng = np.random.default_rng(6)
    for scale in (1, 40, 3e4):
        a, y = (np.floor(scale * 256 * rng.normal(size=(n, 40)) * np.exp(-np.arange(40) / 9)[::-1]) for n in (70, 300))
        score = a.astype(np.int64) @ y.astype(np.int64).T
        for least in (np.full(70, -np.inf), np.zeros(70), np.quantile(score, 0.99, axis=1), np.full(70, score.max() * 2)):
            i, j, s = hard_negatives.threshold_join(a, least, y, hard_negatives.rest_norms(y))
            assert sorted(zip(i.tolist(), j.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(score >= least[:, None]))))
            assert (s == score[i, j]).all()


def test_scores_beyond_floats_are_whole():
    a = np.array([[float(1 << 40), 3.0]])
    assert hard_negatives.exact_scores(a, np.array([[float(1 << 20), 1.0]])).tolist() == [(1 << 60) + 3]
    assert hard_negatives.exact_scores(a, np.array([[float(1 << 40), 1.0]])).tolist() == [(1 << 63) - 1]


def test_rows_below_the_bound_are_not_listed():
    rng = np.random.default_rng(7)
    y = np.floor(256 * rng.normal(size=(500, 64)) / 8 * np.linspace(0.1, 2, 64))
    seen = []
    real = hard_negatives.exact_scores

    def counted(a, b):
        seen.append(len(a))
        return real(a, b)

    hard_negatives.exact_scores = counted
    try:
        least = np.sort(y[:20] @ y.T, axis=1)[:, -3]
        hard_negatives.threshold_join(y[:20], least, y, hard_negatives.rest_norms(y))
    finally:
        hard_negatives.exact_scores = real
    assert sum(seen) < 20 * 500 / 10


def test_empty_table_and_clashing_columns(spark):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = table(200, 8)
    clash = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("slot", F.lit(1)).withColumn("id", F.lit(None))
    assert rows_of(hard_negatives.mine(clash)) == rows_of(spark.createDataFrame(plain(rows), hard_negatives._MINED))
