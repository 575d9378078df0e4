import zlib
from collections import Counter

from helpers import DOCS, docs, documents, nothing, rows_of
from pyspark.sql import functions as F

from subrev.llm import sharding


def test_assignments(docs):
    rows = sharding.assignments(docs).collect()
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in documents())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    by = Counter(r["shard"] for r in rows)
    assert max(by.values()) - min(by.values()) <= 1 and set(by) <= set(range(40))
    assert Counter((r["shard"], r["slot"]) for r in rows) == Counter((s, i) for s, n in by.items() for i in range(n))
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}


def test_assignments_are_those_of_the_shards_written(spark, docs, monkeypatch):
    paths, sizes = [], []
    write, shuffle = sharding.write_shards, sharding.external_shuffle

    def written(sharded, path):
        paths.append(path)
        write(sharded, path)

    def shuffled(records, weight, *rest):
        sizes.append(records.agg(F.sum(weight)).first()[0])
        return shuffle(records, weight, *rest)

    monkeypatch.setattr(sharding, "write_shards", written)
    monkeypatch.setattr(sharding, "external_shuffle", shuffled)
    got = rows_of(sharding.assignments(docs).select("doc_id", "size", "shard", "slot"))
    files = spark.read.parquet(paths[0])
    assert rows_of(files.select(*docs.columns)) == rows_of(docs)
    assert rows_of(files.select("doc_id", sharding.size_bytes(F.col("text")), "shard", "slot")) == got
    assert sizes == [sum(len((t or "").encode()) + 16 for _, t, *_ in documents())]


def test_reruns_agree_and_seeds_differ(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 8)
    a = rows_of(sharding.assignments(docs))
    assert a == rows_of(sharding.assignments(docs.repartition(3)))
    other = sharding.shard(docs.select("doc_id"), F.lit(8), seed=1)
    assert rows_of(other.select("doc_id", "shard")) != Counter({(k[0], k[4]): 1 for k in a})


def test_order_is_mixed_within_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)
    ids = [r["id"] for r in sharding.external_shuffle(spark.range(1000), F.lit(8), "p").orderBy("p").collect()]
    assert sorted(ids) == list(range(1000))
    assert sum(abs(a - b) > 100 for a, b in zip(ids, ids[1:])) > 600


def test_a_hot_record_is_spread_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    monkeypatch.setattr(sharding, "COPIES", 64)
    rows = spark.createDataFrame([(1, "same")] * 500 + [(i, "other") for i in range(500)], "doc_id bigint, text string")
    placed = sharding.external_shuffle(rows, F.lit(8), "p").where("text = 'same'").select(F.floor(F.col("p") / 100).alias("b")).groupBy("b").count().collect()
    assert len(placed) == 10 and max(r["count"] for r in placed) < 80


def test_whole_documents_and_files(docs, spark, tmp_path):
    clash = docs.withColumn("shard", F.lit("x")).withColumn("position", F.lit("own")).withColumn("c0", F.lit(5))
    got = sharding.shard_documents(clash, 7)
    assert rows_of(got.select("doc_id", "text", "lang", "source", "n_chars")) == rows_of(docs)
    assert {r["position"] for r in got.collect()} == {"own"}
    sharding.write_shards(got, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


def test_records_that_differ_in_where_their_nulls_are(spark):
    rows = [(1, "t", "x", None, None), (1, "t", None, "x", None), (1, "t", "x", "x", None)]
    got = sharding.shard_documents(spark.createDataFrame(rows, DOCS), 2)
    assert sorted((r["lang"] or "", r["source"] or "") for r in got.collect()) == [("", "x"), ("x", ""), ("x", "x")]


def test_plan_has_no_python_and_empty_table(docs, nothing):
    plan = sharding.assignments(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("PythonRDD", "") and "InPandas" not in plan and "InArrow" not in plan
    assert sharding.assignments(nothing).count() == 0


def test_a_very_large_text_among_small_ones(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_BYTES", 1 << 16)
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 7, F.repeat(F.lit("x"), 20_000_000)).otherwise("small").alias("text"))
    got = sharding.assignments(rows, 4).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(300)) and max(r["size"] for r in got) == 20_000_016
    assert sorted((r["shard"], r["slot"]) for r in got) == [(s, i) for s in range(4) for i in range(75)]


def test_records_are_read_once_and_move_once_when_none_repeats(spark, tmp_path):
    spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 50).alias("text")).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plan = sharding.shard(docs, sharding.size_bytes(F.col("text")), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_path}/docs") == 1
    carried = [line for line in plan.splitlines() if "Exchange" in line and "REPARTITION_BY_NUM" in line]
    assert len(carried) == 1 and "collect_list" not in plan


def test_repeated_records_without_a_broadcast(docs, monkeypatch):
    whole = rows_of(sharding.assignments(docs))
    monkeypatch.setattr(sharding, "FEW_REPEATED", 0)
    assert rows_of(sharding.assignments(docs)) == whole
