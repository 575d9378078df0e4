"""Reading of the input tables, tables kept in the shared folder, and row ids that no repeated row shares."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subrev.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written once to the shared folder.  What is read back has no lineage, so a lost executor costs one step."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, name: str, df: DataFrame, **options: str) -> DataFrame:
        df.write.options(**options).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Remove a table that no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def by_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that treats one batch after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = work(b)
            if out is not None:
                yield out
    return run


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    while name in taken:
        name += "_"
    return name


def add_columns(docs: DataFrame, reads: list[str], work: Callable[..., list[pa.Array]], added: dict[str, str]) -> DataFrame:
    """``docs`` with columns that ``work`` computes from the columns it reads, batch by batch.

    Columns of ``docs`` pass through, whatever their names; one that is named as an added column is replaced.
    """
    names = docs.columns
    at = [names.index(c) for c in reads]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = work(*(batch.column(i) for i in at))
        return pa.RecordBatch.from_arrays([*batch.columns, *new], names=[f"c{i}" for i in range(len(names))] + [f"a{i}" for i in range(len(new))])

    kinds = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)] + [f"a{i} {t}" for i, t in enumerate(added.values())]
    out = docs.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(by_batch(run), ", ".join(kinds))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in added],
                      *[F.col(f"a{i}").alias(c) for i, c in enumerate(added)])
