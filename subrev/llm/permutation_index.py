"""Approximate nearest neighbours by a permutation index.

Vectors are represented by the order of their nearest pivots: a row posts itself, with
the place of the pivot in its order, in the inverted files of its PREFIX nearest of
PIVOTS pivots.  Two rows whose orders differ by little are near.  Their footrule
distance (sum of the differences of the places, a pivot beyond the prefix standing at
place PREFIX) is a constant less twice the sum, over the pivots both posted, of
PREFIX - max(place, place), so a query reads the inverted files of its own pivots only and
adds up.  The rows of least footrule distance are reranked by exact Euclidean distance.

The index is partitioned by rows: each block of the table has inverted files of its
own, so that a pivot which many rows are near to has as many files as there are
blocks.  Queries come in chunks of bounded size, broadcast one after the other to
all blocks.  Within every block, CANDIDATES rows plus SHARE of the block, and all
that tie with the last, are reranked; blocks are random shares of the table, so a
query's candidates are a fixed share of the table at every size.

The pivots are PIVOTS different vectors with the least hashes.  They are the only
part that is fitted; every row is indexed.

Defined results: a vector that is null, empty, zero, or holds a null or a component
that is not finite takes no part, neither as query nor as candidate; a shorter vector
than the longest ends in zeros; a row with a null id is a candidate only, and comes
last among equal distances; repeated rows are rows of their own: each finds
the others at distance 0; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subrev.llm import vectors
from subrev.llm.common import Scratch
from subrev.llm.vectors import Vectors

PIVOTS = 256
PREFIX = 128
#: Rows of a block that are reranked: so many, and a share of the block.
CANDIDATES = 64
SHARE = 0.1
#: Rows, about, among which pivots are sought first.
SAMPLE = 4096
_NEAREST = "query_id bigint, rank int, vec_id bigint, score double"
_FOUND = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score double"


def pivots(rows: DataFrame, n: int, kind: str, dim: int, most: int = PIVOTS) -> np.ndarray:
    """``most`` different vectors, those of least hash, or all there are; sought in more and more of the rows."""
    h = F.xxhash64(F.lit(12), "vector")
    share = min(1.0, SAMPLE / max(n, 1))
    while True:
        some = rows if share >= 1 else rows.where(F.pmod(F.xxhash64(h), F.lit(1 << 40)) < int((1 << 40) * share))
        found = some.groupBy(h.alias("h")).agg(F.min("vector").alias("vector")).orderBy("h").limit(most).collect()
        if len(found) == most or share >= 1:
            return vectors.matrix([bytes(r["vector"]) for r in found], kind, dim)
        share = min(1.0, share * 16)


def orders(x: np.ndarray, pivot: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of every row, nearest first; equally near ones in their own order."""
    distance = (pivot * pivot).sum(1)[None, :] - 2 * (x @ pivot.T)
    return np.argsort(distance, axis=1, kind="stable")[:, :prefix]


def inverted_files(order: np.ndarray, n_pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, ends): the rows that posted a pivot, pivot by pivot and by place; ends of the rows of each pivot and place."""
    n, prefix = order.shape
    cell = order.astype(np.int64) * prefix + np.arange(prefix)
    rows = (np.argsort(cell.ravel(), kind="stable") // max(prefix, 1)).astype(np.uint16)
    return rows, np.cumsum(np.bincount(cell.ravel(), minlength=n_pivots * prefix)).astype(np.int32)


class Block:
    """The vectors of a block and its inverted files."""

    def __init__(self, data: dict[str, bytes], kind: str, n_pivots: int, prefix: int) -> None:
        self.v = vectors.unpacked(data, kind)
        self.rows = np.frombuffer(data["files"], np.uint16).astype(np.int64)
        self.prefix = prefix
        ends = np.frombuffer(data["ends"], np.int32).astype(np.int64)
        counts = np.diff(np.concatenate([[0], ends]))
        # what a row's place is worth: the prefix less the place
        self.worth = np.repeat(np.tile(np.arange(prefix, 0, -1), n_pivots), counts).astype(np.int32)
        self.file = np.concatenate([[0], ends[prefix - 1:: prefix]])

    def closeness(self, order: np.ndarray) -> np.ndarray:
        """For every row, half of what its footrule distance to ``order`` falls short of that of disjoint prefixes."""
        out = np.zeros(len(self.v), np.int32)
        for place, pivot in enumerate(order.tolist()):
            a, z = self.file[pivot], self.file[pivot + 1]
            out[self.rows[a:z]] += np.minimum(self.worth[a:z], self.prefix - place)
        return out

    def nearest(self, order: np.ndarray, x: np.ndarray, row: int, k: int, candidates: int) -> tuple[np.ndarray, np.ndarray]:
        """(places in the block, distances) of the ``k`` nearest candidates, nearest first; not the row itself."""
        close = self.closeness(order)
        close[self.v.row == row] = -1
        at = np.flatnonzero(close >= max(0, int(np.partition(close, -candidates)[-candidates]))) if candidates < len(close) else np.flatnonzero(close >= 0)
        apart = self.v.x[at] - x
        distance = np.sqrt((apart * apart).sum(1))
        if k < len(at):
            near = distance <= np.partition(distance, k - 1)[k - 1]
            at, distance = at[near], distance[near]
        best = np.lexsort((self.v.row[at], self.v.id[at], ~self.v.known[at], distance))[:k]
        return at[best], distance[best]


def build(table: DataFrame, scratch: Scratch, id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray, str, int]:
    """Write the index of all usable vectors: (blocks, pivots, type of the vectors, components)."""
    rows, kind = vectors.usable(table, id, vector, zeros=False)
    n, dim = vectors.shape(rows, kind)
    pivot = pivots(rows, n, kind, dim)
    prefix = min(PREFIX, max(1, len(pivot) // 2)) if len(pivot) else 0

    def block(v: Vectors) -> dict[str, bytes]:
        posted, ends = inverted_files(orders(v.x, pivot, prefix), len(pivot))
        return vectors.packed(v, kind) | {"files": posted.tobytes(), "ends": ends.tobytes()}

    index = vectors.blocks(rows, n, dim, kind, block, [*vectors.PACKED, "files", "ends"])
    return scratch.keep("index", index), pivot, kind, dim


def search(index: DataFrame, pivot: np.ndarray, queries: Vectors, kind: str, k: int) -> DataFrame:
    """(query_row, query_id, row, vec_id, score): the ``k`` nearest candidates of each query in every block."""
    prefix = min(PREFIX, max(1, len(pivot) // 2))
    shared = index.sparkSession.sparkContext.broadcast((queries.row, queries.id, queries.x, orders(queries.x, pivot, prefix)))
    n_pivots = len(pivot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, x, order = shared.value
        for b in batches:
            for data in b.to_pylist():
                block = Block(data, kind, n_pivots, prefix)
                candidates = CANDIDATES + int(np.ceil(SHARE * len(block.v)))
                found = [block.nearest(order[i], x[i], rows[i], k, candidates) for i in range(len(rows))]
                at = np.concatenate([a for a, _ in found])
                which = np.repeat(np.arange(len(rows)), [len(a) for a, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[which]), pa.array(ids[which]), pa.array(block.v.row[at]), pa.array(block.v.id[at], mask=~block.v.known[at]),
                     pa.array(np.concatenate([d for _, d in found]))], names=["query_row", "query_id", "row", "vec_id", "score"])

    return index.mapInArrow(run, _FOUND)


def first_of_each(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query's rows, with their rank."""
    w = Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, k: int = 10, divisor: int = 100, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row whose id ``divisor`` divides."""
    spark = table.sparkSession
    scratch = Scratch(spark, "permutations")
    index, pivot, kind, dim = build(table, scratch, id, vector)
    asked = scratch.keep("queries", vectors.chosen(index, kind, divisor))
    found: list[str] = []
    for i, queries in enumerate(vectors.chunks(asked, kind, dim)):
        found.append(scratch.path(f"found{i}"))
        first_of_each(search(index, pivot, queries, kind, k), k).write.parquet(found[-1])
    return spark.read.schema(_NEAREST).parquet(*found) if found else spark.createDataFrame([], _NEAREST)
