"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass one scatters the records by a seeded hash into buckets that fit in memory; pass
two shuffles each bucket (``shuffle`` is a seeded Fisher-Yates shuffle of an array)
and puts the buckets one after the other.  The positions are cut into shards of equal
counts: the law ``rows``, shard sizes at most one apart.

What is drawn and shuffled in memory are keys: two 64-bit hashes of a record and its number among
equal records.  The records move once, into the partition of their bucket, together with the
shuffled keys of the bucket, and take their positions there; that task also writes them.  So a bucket has no
limit by the size of its texts, and a very large text is a row like any other.

Equal records share their hashes and are told apart by a number, so a hot record does not
fill a bucket.  Which of them gets which number makes no difference.  The number of partitions of the
second pass is fixed by the data and its keys are in bucket order there, so the seeded
shuffle, which draws by partition, gives the same order on every run and on every retry.

Defined results: a null text has no bytes; an empty table gives no row; every column
is carried, and only columns of map type cannot be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subrev.llm.common import Scratch, fresh
from subrev.llm.prefix import _join, bucket_starts

SEED = 40
SHARDS = 40
#: Records and bytes that one bucket holds about.
BUCKET_ROWS = 1024
BUCKET_BYTES = 16 << 20
MAX_PARTITIONS = 20_000
#: Copies of one record that one row stands for before it is split.
COPIES = 10_000
#: Hashes of repeated records that are broadcast, 24 bytes each; more are joined.
FEW_REPEATED = 1 << 20


def size_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 16


def text_crc(text: Column) -> Column:
    return F.coalesce(F.crc32(text), F.lit(0)).cast("bigint")


def external_shuffle(records: DataFrame, weight: Column, position: str, seed: int = SEED) -> DataFrame:
    """``records`` with a ``position`` from 0 on, in a random order that ``seed`` and the records decide.

    ``weight`` is a record's bytes; with it the buckets are sized.
    """
    scratch = Scratch(records.sparkSession, "shuffle")
    names = records.columns
    columns = [f"c{i}" for i in range(len(names))]
    rows = records.select("*", weight.cast("bigint").alias(fresh("weight", names))).toDF(*columns, "w")
    # a hash skips nulls, so it also gets which columns are null
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    rows = rows.withColumn("a", F.xxhash64(nulls, *columns)).withColumn("b", F.xxhash64(F.lit(seed), nulls, *columns))
    found = scratch.keep("records", rows.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("w").alias("w")))
    n, total, repeated = found.agg(F.sum("n"), F.sum(F.col("n") * F.col("w")), F.count_if(F.col("n") > 1)).first()
    buckets = max(1, -(-(n or 0) // BUCKET_ROWS), -(-(total or 0) // BUCKET_BYTES))
    partitions = min(buckets, MAX_PARTITIONS)

    def numbered(of: DataFrame) -> DataFrame:
        """A row for every copy, in steps, as one record may have very many."""
        some = of.withColumn("from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(COPIES).cast("bigint"))))
        return some.withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + COPIES, "n") - 1))).drop("from", "n")

    bucket = F.pmod(F.xxhash64(F.lit(seed), "a", "b", "copy"), F.lit(buckets))
    keys = numbered(found.select("a", "b", "n")).withColumn("bucket", bucket)
    drawn = keys.repartition(partitions, "bucket").groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("a", "b", "copy"))).alias("keys"))
    drawn = drawn.sortWithinPartitions("bucket").select("bucket", F.size("keys").cast("bigint").alias("n"), F.shuffle("keys", seed).alias("keys"))
    drawn = scratch.keep("drawn", drawn)
    starts = bucket_starts(drawn.select("bucket", "n"), [], "bucket", "n", "start")
    places = _join(drawn, starts, ["bucket"], take="start").select("bucket", "start", F.posexplode("keys").alias("at", "key"))
    places = places.select("bucket", "key.*", (F.col("start") + F.col("at")).alias("position"))

    carried = ["a", "b", "copy", *columns]
    if not repeated:
        copies = rows.withColumn("copy", F.lit(0).cast("bigint")).select(*carried)
    else:
        twice = found.where("n > 1").select(F.col("a").alias("_a"), F.col("b").alias("_b"), "n")
        twice = F.broadcast(twice) if repeated <= FEW_REPEATED else twice
        marked = rows.join(twice, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left")
        single = marked.where(F.col("n").isNull()).withColumn("copy", F.lit(0).cast("bigint")).select(*carried)
        folded = marked.where(F.col("n").isNotNull()).groupBy("a", "b", "n").agg(*[F.any_value(c).alias(c) for c in columns])
        copies = single.unionByName(numbered(folded).select(*carried))
    # records and keys of a bucket meet in one partition; the window needs no further exchange
    both = copies.withColumn("bucket", bucket).withColumn("position", F.lit(None).cast("bigint")).withColumn("is_row", F.lit(True))
    both = both.unionByName(places.withColumn("is_row", F.lit(False)), allowMissingColumns=True).repartition(partitions, "bucket")
    placed = both.withColumn("position", F.max("position").over(Window.partitionBy("bucket", "a", "b", "copy"))).where("is_row")
    return placed.select(*[F.col(c).alias(name) for c, name in zip(columns, names) if name != position], F.col("position").alias(position))


def shard(records: DataFrame, weight: Column, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``records`` with ``shard`` and ``slot``, gapless from 0 in each shard; columns of these names are replaced."""
    position = fresh("position", records.columns)
    n = records.count()
    placed = external_shuffle(records.drop("shard", "slot"), weight, position, seed)
    of = F.expr(f"`{position}` * {shards} div {max(n, 1)}")
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", of).withColumn("slot", F.col(position) - first).withColumn("shard", F.col("shard").cast("int")).drop(position)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; the task that placed a bucket writes it, in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def assignments(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document, read from the shards written.

    Whole documents are scattered, shuffled and written to the shared folder.
    """
    spark = docs.sparkSession
    sharded = shard(docs, size_bytes(F.col("text")), shards)
    path = Scratch(spark, "shards").path("rows")
    write_shards(sharded, path)
    return spark.read.schema(sharded.schema).parquet(path).select(
        "doc_id", size_bytes(F.col("text")).alias("size"), text_crc(F.col("text")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Whole documents with size, text_crc32, law, shard and slot; columns of these names are replaced."""
    sized = docs.withColumn("size", size_bytes(F.col("text"))).withColumn("text_crc32", text_crc(F.col("text"))).drop("law", "shard", "slot")
    placed = shard(sized, F.col("size"), shards)
    return placed.select(*sized.columns, F.lit("rows").alias("law"), "shard", "slot")
