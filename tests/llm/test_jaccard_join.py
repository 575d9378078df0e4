from collections import Counter, defaultdict
from itertools import combinations

import pytest
from helpers import DOCS, LOWER, docs, documents, nothing, rows_of, words
from pyspark.sql import functions as F

from subrev.llm import jaccard_join
from subrev.llm.common import Scratch
from subrev.llm.components import components


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def expected(rows, size, percent):
    """Component (least id) and set size by comparing all pairs."""
    sets = [shingles(r[1], size) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)].append(r[0])
    return Counter((r[0], len(sets[i]), min(least[root(i)], default=None)) for i, r in enumerate(rows))


@pytest.mark.parametrize("size, percent, small", [(3, 90, 24), (3, 90, 2), (5, 80, 24), (5, 80, 3), (3, 100, 2), (2, 50, 4)])
def test_components_against_all_pairs(docs, monkeypatch, size, percent, small):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    assert rows_of(jaccard_join.near_classes(docs, size, percent)) == expected(documents(), size, percent)


def test_one_of_each_keeps_the_least_id(docs):
    clash = docs.withColumn("k", F.lit(1)).withColumn("set_key", F.lit("own"))
    got = jaccard_join.one_of_each(clash, 5, 80)
    assert got.columns == clash.columns
    want = {c for _, n, c in expected(documents(), 5, 80) if n}
    empty = sum(not shingles(t, 5) for _, t, *_ in documents())
    ids = [r["doc_id"] for r in got.where(F.size(F.split(F.trim(F.coalesce("text", F.lit(""))), r"\s+")) >= 0).collect()]
    assert len(ids) == len(want) + empty
    assert want <= set(ids)


def test_empty_table(nothing):
    assert jaccard_join.near_classes(nothing).count() == 0
    assert jaccard_join.one_of_each(nothing, 5, 80).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 3), (200, 201)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(links, "a int, b int"), Scratch(spark, "t"), "x").collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, **{100 + i: 100 for i in range(1, 40)}, 201: 200}


def test_rows_of_one_id(spark):
    rows = [(1, "a b c d e f", "en", "s", 1), (1, "u v w x y z", "en", "s", 1), (1, "a b c d e f", "en", "s", 1)]
    got = jaccard_join.one_of_each(spark.createDataFrame(rows, DOCS), 5, 80)
    assert sorted(r["text"] for r in got.collect()) == ["a b c d e f", "u v w x y z"]


def test_long_words_of_the_same_blocks_are_different_shingles(spark):
    a, b = "abcdefgh" * 8, "hgfedcba" * 8
    rows = [(1, f"x {a}{b}{b}{a} y"), (2, f"x {b}{a}{a}{b} y"), (3, f"x {a}{b}{b}{a} y")]
    got = jaccard_join.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string"), size=3, percent=90).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 2, 3: 1}
