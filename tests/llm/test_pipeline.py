"""The pipeline stage by stage, each against a plain form on what the stage before it kept."""

from collections import Counter

import pytest
from helpers import docs, documents, words
from pyspark.sql import functions as F
from test_decontaminate import folded
from test_jaccard_join import expected

import __spark_entry__ as entry
import corpus_pipeline
from subrev.llm import queries


@pytest.fixture(scope="module")
def stages(spark, docs, tmp_path_factory):
    """Output of every stage on the small documents, with benchmark items taken from two of them."""
    home = str(tmp_path_factory.mktemp("pipeline"))
    rows = documents()
    items = [(1, " ".join(folded(rows[30][1])[:40])), (2, " ".join(folded(rows[-5][1])[:15]))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{home}/benchmark.parquet")
    docs.write.parquet(f"{home}/documents.parquet")
    out, now = {}, spark.read.parquet(f"{home}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, now, home)
        df.write.parquet(f"{home}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert df.columns == docs.columns
        now = out[name] = spark.read.parquet(f"{home}/{name}")
    return {"documents": docs} | out, items


def rows(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]


def test_texts_without_letters_go(stages):
    out, _ = stages
    assert Counter(rows(out["language_id"])) == Counter(r for r in rows(out["documents"]) if any(c.isalpha() for c in r[1] or ""))


def test_lettered_documents_stay_when_no_language_was_learnt(spark, docs):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.identify_language(spark, unlabelled, "")
    assert Counter(rows(got)) == Counter(r for r in rows(unlabelled) if any(c.isalpha() for c in r[1] or ""))


def test_one_document_of_each_group_stays(stages):
    out, _ = stages
    before = rows(out["language_id"])
    assert Counter(r[0] for r in rows(out["near_duplicates"])) == Counter({c: 1 for _, n, c in expected(before, 5, 80) if n})
    assert not Counter(rows(out["near_duplicates"])) - Counter(before)


def test_contaminated_documents_go(stages):
    out, items = stages
    windows = {tuple(w[i:i + min(13, len(w))]) for _, t in items for w in [folded(t)] for i in range(max(1, len(w) - 12))}

    def bad(text):
        w, hit = folded(text), set()
        for m in {len(x) for x in windows}:
            hit |= {i + k for i in range(len(w) - m + 1) if tuple(w[i:i + m]) in windows for k in range(m)}
        return bool(hit) and 20 * len(hit) >= len(w)

    before = rows(out["near_duplicates"])
    assert any(bad(r[1]) for r in before)
    assert Counter(rows(out["decontamination"])) == Counter(r for r in before if not bad(r[1]))


def test_the_mix_takes_whole_documents_up_to_twice(stages):
    out, _ = stages
    before, after = Counter(rows(out["decontamination"])), Counter(rows(out["mixing"]))
    assert set(after) <= set(before) and all(n <= 2 * before[r] for r, n in after.items())
    size = sum(len(words(r[1])) * n for r, n in before.items())
    assert 1.2 * size < sum(len(words(r[1])) * n for r, n in after.items()) < 1.8 * size


def test_shards_hold_all(stages):
    out, _ = stages
    assert Counter(rows(out["sharding"])) == Counter(rows(out["mixing"]))
    by = Counter(r["shard"] for r in out["sharding"].collect())
    assert max(by.values()) - min(by.values()) <= 1


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 11))
    assert entry.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
