import math
import random

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from subrev.llm import permutation_index, vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, k=10, divisor=100):
    """Exact nearest rows of every query, by row."""
    ok = [(i, r[0], np.array(r[1], np.float32).astype(float)) for i, r in enumerate(rows)
          if r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    dim = max((len(x) for _, _, x in ok), default=0)
    ok = [(i, v, np.pad(x, (0, dim - len(x)))) for i, v, x in ok]
    out = []
    for i, v, x in ok:
        if v is not None and v % divisor == 0:
            found = sorted((float(np.sqrt(((y - x) ** 2).sum())), w is None, w or 0, j) for j, w, y in ok if j != i)[:k]
            out.append((v, [(None if none else w, d) for d, none, w, _ in found]))
    return out


def answers(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_recall_and_exact_scores(spark):
    table = spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    want = dict(plain([(r["vec_id"], r["embedding"]) for r in table.collect()]))
    got = answers(permutation_index.nearest(table))
    assert set(got) == set(want) and all(len(x) == 10 for x in got.values())
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q in want:
        exact = dict(want[q])
        assert all(math.isclose(d, exact[v], rel_tol=1e-12) for v, d in got[q] if v in exact)
        assert got[q] == sorted(got[q], key=lambda x: (x[1], x[0]))


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(2)
    rows = [(0, [1.0, 0.0], 1), (100, [1.0, 0.0], 2), (100, [1.0, 0.0], 2), (200, [0.0, 0.0], 1), (300, None, 1), (400, [nan, 1.0], 1), (500, [inf, 1.0], 1),
            (600, [None, 1.0], 1), (700, [], 1), (None, [1.0, 0.0], 1), (800, [0.5], 1), (900, [1.0, 0.0, 0.0], None), (1, [1.0, 0.0], 3)]
    rows += [(10 + i, [rng.choice([0.0, 1.0]), 1.0], 1) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = answers(permutation_index.nearest(df.where("vec_id != 100 or vec_id is null"), k=60))
    want = dict(plain([r for r in rows if r[0] != 100], k=60))
    assert got == want
    twice = permutation_index.nearest(df, k=3).where("query_id = 100").select("rank", "score").collect()
    assert sorted(map(tuple, twice)) == [(1, 0.0), (1, 0.0), (2, 0.0), (2, 0.0), (3, 0.0), (3, 0.0)]


def test_chunks_of_queries_and_small_blocks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(permutation_index, "CANDIDATES", 600)
    whole = answers(permutation_index.nearest(df, divisor=10))
    monkeypatch.setattr(vectors, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 50)
    assert answers(permutation_index.nearest(df, divisor=10)) == whole == dict(plain(rows, divisor=10))


def test_closeness_is_the_footrule_distance():
    rng = np.random.default_rng(5)
    x, pivot, prefix = rng.normal(size=(40, 6)), rng.normal(size=(20, 6)), 7
    order = permutation_index.orders(x, pivot, prefix)
    posted, ends = permutation_index.inverted_files(order, 20)
    v = vectors.Vectors(np.arange(40), np.arange(40), np.ones(40, bool), np.zeros(40, np.int64), x)
    block = permutation_index.Block(vectors.packed(v, "<f8") | {"files": posted.tobytes(), "ends": ends.tobytes()}, "<f8", 20, prefix)
    place = np.full((40, 20), prefix)
    np.put_along_axis(place, order, np.arange(prefix)[None].repeat(40, 0), 1)
    footrule = np.abs(place[:, None, :] - place[None, :, :]).sum(2)
    for i in range(40):
        assert (footrule[i] == prefix * (prefix + 1) - 2 * block.closeness(order[i])).all()


def test_a_hot_vector_is_one_pivot_only(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(500)] + [(1000 + i, [float(i), 1.0], 0) for i in range(300)]
    usable, kind = vectors.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", zeros=False)
    pivot = permutation_index.pivots(usable, 800, kind, 2)
    assert len(pivot) == 256 == len({tuple(p) for p in pivot.tolist()})


@pytest.mark.parametrize("rows", [[], [(100, [1.0], 0)], [(100, None, 0)]])
def test_no_candidates(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("score", F.lit(1))
    assert permutation_index.nearest(df).collect() == []
