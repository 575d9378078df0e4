import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from helpers import DOCS, LOWER, docs, documents, nothing, rows_of
from pyspark.sql import functions as F

from subrev.llm import merkle


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    doc_id, _, lang, source, n_chars = row
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def way(levels, i):
    for nodes in levels[:-1]:
        yield i % 8, nodes[i - i % 8:i - i % 8 + 8]
        i //= 8


def plain(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in order:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[k] = levels_of([leaf_of(r, r[1]) for r in groups[k]])
    top = levels_of([trees[k][-1][0] for k in order])
    out = Counter()
    for at, k in enumerate(order):
        for i, r in enumerate(groups[k]):
            path = [*way(trees[k], i), *way(top, at)]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            h = leaf_of(r, r[1].translate(LOWER) if tampered else r[1])
            for p, run in path:
                h = digest([*run[:p], h, *run[p + 1:]])
            siblings = digest(x for p, run in path for j, x in enumerate(run) if j != p)
            out[(r[0], trees[k][0][i], trees[k][-1][0], top[-1][0], siblings, h, h == top[-1][0])] += 1
    return out


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_against_plain_trees(docs, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    assert rows_of(merkle.tamper_check(docs)) == plain(documents())


def test_many_groups_and_groups_of_exactly_one_run(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    rows = [(i * 1000 + j, "Text A", f"l{i:02d}" if i else None, None, j) for i in range(70) for j in range([1, 7, 8, 9, 64, 65][i % 6])]
    random.Random(1).shuffle(rows)
    assert rows_of(merkle.tamper_check(spark.createDataFrame(rows, DOCS).repartition(6))) == plain(rows)


def test_one_language_and_repeated_rows(spark):
    rows = [(5, "Same", "en", "s", 4)] * 300 + [(None, None, "en", None, None)] * 3
    assert rows_of(merkle.tamper_check(spark.createDataFrame(rows, DOCS).repartition(7))) == plain(rows)


def test_one_row_is_its_own_root(spark):
    row = (1, "A", "en", "s", 1)
    (got,) = merkle.tamper_check(spark.createDataFrame([row], DOCS)).collect()
    assert got["leaf"] == got["subroot"] == got["root"] == leaf_of(row, "A") and got["proof_sha256"] == digest([])


def test_empty_table_and_clashing_columns(docs, nothing):
    assert merkle.tamper_check(nothing).count() == 0
    clash = docs.withColumn("grp", F.lit(1)).withColumn("idx", F.lit("x")).withColumn("size", F.lit(2.5)).withColumn("path", F.lit(None))
    assert rows_of(merkle.tamper_check(clash)) == plain(documents())


def test_whole_witnesses_fold_to_the_root(docs):
    got = merkle.witnesses(docs).collect()
    assert len(got) == len(documents())
    for r in got:
        h = r["leaf"].hex()
        for at, run in zip(r["positions"], r["siblings"]):
            run = [x.hex() for x in run]
            h = digest([*run[:at], h, *run[at:]])
        assert h == r["root"].hex()


def test_partial_witnesses_grow_with_later_siblings():
    tree = merkle.Subtrees(arity=2)
    nodes = [digest([str(i)]).encode() for i in range(5)]
    seen = []
    for n in nodes:
        tree.append(n)
        seen.append(len(tree.witness(0)))
    assert seen == [0, 1, 1, 2, 2]
    root = tree.finish()
    assert [merkle.fold(n, tree.witness(i)) for i, n in enumerate(nodes)] == [root] * 5


def test_blocks_are_bounded_and_leaves_are_not_collected(docs, monkeypatch, tmp_path):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    from subrev.llm.common import Scratch

    blocks = merkle.document_blocks(docs, Scratch(docs.sparkSession, "t"))
    assert max(r["n"] for r in blocks.select(F.size("payload").alias("n")).collect()) <= 8
