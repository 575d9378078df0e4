"""A run of a stage: its tables are counted by the jobs that write them and become valid together.

Every run writes under a folder of its own.  The last thing it writes is one file with
a row per artifact, appended to the stage's manifest; a reader takes the folder of the
newest run in the manifest.  A run that fails therefore changes nothing that is read, and
what it left is never mixed with the tables of another run.

The counts are metrics observed in the plan that is written (``Observation``): they come
from the job that writes the table and cost no scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from subrev.functions.reasons import FLAG
from subrev.sources import files

MANIFEST = ("seq bigint, run_id string, at string, folder string, artifact string, rows_in bigint, rows_out bigint, rows_flagged bigint")
SUMMARY = ("run_id", "at", "artifact", "rows_in", "rows_out", "rows_flagged")
Sink = Callable[[DataFrame, str], None]


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> tuple[int, int | None]:
    """Write a table; (rows, flagged rows) as the write saw them. Flagged is None for a table without a flag."""
    seen = Observation(f"counts-{uuid.uuid4().hex}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if FLAG in df.columns:
        metrics.append(F.count_if(F.col(FLAG)).alias("flagged"))
    write(df.observe(seen, *metrics))
    return seen.get["rows"], seen.get.get("flagged")


class StageRun:
    """The artifacts of one run, valid when it is committed."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, at: str) -> None:
        self.spark, self.root, self.run_id, self.at = spark, root, run_id, at
        self.folder = f"{root}/runs/{run_id}-{uuid.uuid4().hex[:12]}"
        self.counts: dict[str, tuple[int | None, int, int | None]] = {}

    def path(self, artifact: str) -> str:
        return f"{self.folder}/{artifact}"

    def write(self, artifact: str, df: DataFrame, sink: Sink = files.write_table, rows_in: int | None = None) -> None:
        """``rows_in``: rows of what the artifact was made from, where that is known."""
        rows, flagged = counted(df, lambda observed: sink(observed, self.path(artifact)))
        self.counts[artifact] = (rows_in, rows, flagged)

    def keep(self, artifact: str, df: DataFrame, rows_in: int | None = None) -> DataFrame:
        """Write a table and return the written copy."""
        self.write(artifact, df, rows_in=rows_in)
        return self.spark.read.schema(df.schema).parquet(self.path(artifact))

    def aside(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table that several artifacts are made of and that is none itself; return the written copy."""
        files.write_table(df, self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def rows(self, artifact: str) -> int:
        return self.counts[artifact][1]

    def commit(self) -> DataFrame:
        """Make the run the one that readers see, and return its summary."""
        seq = (newest(self.spark, self.root) or {"seq": 0})["seq"] + 1
        rows = [(seq, self.run_id, self.at, self.folder, artifact, *counts) for artifact, counts in self.counts.items()]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return summary(self.spark, self.root)


def remove_older(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove the folders of all but the ``keep`` newest committed runs, and of runs that never committed; returns their names.

    Not to be called while a run of the stage is under way.
    """
    rows = manifest(spark, root)
    newest_first = [] if rows is None else rows.select("seq", "folder").distinct().orderBy(F.desc("seq"), F.desc("folder")).limit(keep).collect()
    kept = {r["folder"].rsplit("/", 1)[-1] for r in newest_first}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/runs")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [x.getPath() for x in fs.listStatus(path) if x.getPath().getName() not in kept] if fs.exists(path) else []
    for p in old:
        fs.delete(p, True)
    return sorted(p.getName() for p in old)


def manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """All committed runs of a stage."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def newest(spark: SparkSession, root: str) -> Mapping[str, object] | None:
    """(seq, folder) of the newest committed run; of two with one number the greater folder name counts for every reader."""
    rows = manifest(spark, root)
    last = None if rows is None else rows.agg(F.max(F.struct("seq", "folder")).alias("last")).first()["last"]
    return None if last is None else last.asDict()


def folder(spark: SparkSession, root: str) -> str:
    """Where the valid tables of a stage are: the newest committed run, or ``root`` itself when nothing was ever committed there."""
    last = newest(spark, root)
    return last["folder"] if last else root


def summary(spark: SparkSession, root: str) -> DataFrame:
    """Run summary of the newest committed run: id, time, and rows in, out and flagged of every artifact."""
    last = newest(spark, root)
    if last is None:
        return spark.createDataFrame([], MANIFEST).select(*SUMMARY)
    return manifest(spark, root).where((F.col("seq") == last["seq"]) & (F.col("folder") == last["folder"])).select(*SUMMARY)


def rows_of(spark: SparkSession, root: str) -> dict[str, int]:
    """Rows of every artifact of the newest committed run."""
    return {r["artifact"]: r["rows_out"] for r in summary(spark, root).collect()}
