from collections import Counter, defaultdict

import pytest
from helpers import DOCS, docs, documents, nothing, rows_of, words
from pyspark.sql import functions as F

from subrev.llm import mixing


def plain_targets(sizes, weights, budget, cap):
    """Share the budget by weight; what is above a cap is shared again among the rest."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = budget * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("block", [16, 4096])
def test_targets_and_taken_words(docs, block):
    rows = mixing.mix(docs, block=block).collect()
    sizes = defaultdict(int)
    for d, t, _, s, _ in documents():
        sizes[s] += len(words(t))
    want = plain_targets(sizes, (5, 2, 1), 1.5, 2.0)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((d, len(words(t))) for d, t, *_ in documents())
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert (r["taken"] > 0) == (r["first_slot"] is not None)
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == round(want[s]) for s in sizes)


def test_a_source_of_small_weight_is_taken_in_part(spark):
    rows = [(i, " ".join(["w"] * 50), "en", "abc"[i % 3], 1) for i in range(300)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS), weights=(5, 2, 1), block=64).collect()
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        assert (r["taken"] > 0) == (r["first_slot"] is not None)
    # 22,500 words: a stops at 10,000, b and c share the rest 2 to 1
    assert taken == {"a": 10_000, "b": 8_333, "c": 4_167}


def test_reruns_and_other_partitions_agree(docs):
    assert rows_of(mixing.mix(docs, block=64)) == rows_of(mixing.mix(docs.repartition(2), block=64))


def test_schedule_has_low_discrepancy(spark):
    sizes = spark.createDataFrame([("a", 50_000), ("b", 30_000), ("c", 4_000)], "source string, source_size bigint")
    plan = mixing.targets(sizes, (5, 2, 1), 1.5, 2.0)
    total = plan.agg(F.sum("words")).first()[0]
    share = {r["source"]: r["words"] / total for r in plan.collect()}
    order = [r["source"] for r in mixing.slots(plan, -(-total // 64), 64).orderBy("slot").collect()]
    for s, p in share.items():
        seen = 0
        for i, x in enumerate(order[:1900]):
            seen += x == s
            assert abs(seen - p * (i + 1)) < 4


def test_documents_taken(docs):
    clash = docs.withColumn("h", F.lit("own")).withColumn("size", F.lit(-1)).withColumn("mix_copies", F.lit(0))
    got = mixing.take_documents(clash, block=32)
    assert got.columns == clash.columns
    by = Counter(r["doc_id"] for r in got.collect())
    for r in mixing.mix(docs, block=32).where("size > 0").groupBy("doc_id", "source").agg(F.sum("taken").alias("t"), F.sum("size").alias("s"), F.count("*").alias("n")).collect():
        assert abs(by[r["doc_id"]] - r["n"] * r["t"] / r["s"]) <= r["n"]


def test_empty_and_wordless_tables(spark, nothing):
    assert mixing.mix(nothing).count() == 0
    none = spark.createDataFrame([(1, None, None, None, None), (2, " ", None, "a", None)], DOCS)
    assert {(r["size"], r["target"], r["taken"]) for r in mixing.mix(none).collect()} == {(0, 0.0, 0)}
    assert mixing.take_documents(none).count() == 0


def test_golden_points_keep_their_precision(spark):
    from decimal import Decimal, getcontext
    getcontext().prec = 40
    ratio = (Decimal(5).sqrt() - 1) / 2
    for i in (1, 2, 1000, 10**9, 10**12):
        x = spark.range(1).select(mixing.golden(F.lit(i)).alias("x")).first()["x"]
        assert abs(Decimal(x) - (i * ratio) % 1) < Decimal("1e-7")


@pytest.mark.parametrize("n", [6, 60, 3000])
def test_targets_of_equal_sources_use_the_budget_up(spark, n):
    """Ties of cap per weight: the first in order that the level leaves open sets it."""
    rows = [(f"s{i:05d}", 100) for i in range(n)]
    plan = mixing.targets(spark.createDataFrame(rows, "source string, source_size bigint"), (5, 2, 1), 1.5, 2.0).collect()
    want = plain_targets(dict(rows), (5, 2, 1), 1.5, 2.0)
    assert all(r["target"] == pytest.approx(want[r["source"]]) for r in plan)
    assert sum(r["target"] for r in plan) == pytest.approx(150 * n)
