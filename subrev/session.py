"""Session settings, and tables kept in the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are written for. A join whose lookup side
# turns out small is switched to a broadcast by AQE from measured sizes; a hot
# key on the row side is split by the skew-join rule even when that costs a
# later exchange.  Rows of text take ten to twenty times the room in a sort that
# they take in a file or a shuffle, and the dedupes sort on both sides of their
# exchange, so scans and shuffles are cut into parts of which a core's share of
# memory holds the sorted rows: nothing is spilled.  Small shuffles are coalesced.
# The JVM never compiles a method of more than 8,000 bytes: the wide projections of the
# rules and counts would run interpreted as one, so they are left to expressions that are
# compiled one by one.  Written tables are packed by zstd, and the shuffle files of a write
# go when it is done (a plan that is run again makes them anew).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "4m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
# Settings a session has to be built with: without the call site of every column
# function, which only helps while a plan is being written, plans build twice as fast.
BUILD_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster. Only a local session without one gets a temporary folder, removed at exit.

    A ``file:`` folder on a cluster has to be a mount that all machines share; it cannot be told from a local disk, so it is warned of.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            current = tempfile.mkdtemp(prefix="subrev-")
            atexit.register(shutil.rmtree, current, ignore_errors=True)
        sc.setCheckpointDir(current)
    if not sc.master.startswith("local") and (current.startswith("file:") or ":" not in current.split("/")[0]):
        warnings.warn(f"{current} has to be a folder that the driver and all executors share", stacklevel=2)
    return current


class StageStore:
    """Named tables written once to the shared checkpoint folder and read from there afterwards.

    A table in the store has no lineage: an executor lost later costs nothing
    that was computed before, and plans built on it stay small.
    """

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark = spark
        self.root = root or f"{ensure_checkpoint_dir(spark)}/subrev-{uuid.uuid4().hex}"
        self._tables: dict[str, DataFrame] = {}

    def get(self, name: str) -> DataFrame | None:
        return self._tables.get(name)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` (runs a job) and return the written table."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        self._tables[name] = self.spark.read.parquet(path)
        return self._tables[name]

    def close(self) -> None:
        """Remove the store's folder."""
        self._tables.clear()
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
