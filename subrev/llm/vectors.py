"""Vectors as numpy matrices: usable rows of a table, dealt into blocks that one task holds, and bounded chunks of them.

A block is one row of a table in the shared folder; its matrix and ids are binary
columns.  Rows are dealt by a hash of a row number, so that every block is a random
share of the table, however the table was ordered and whichever rows are alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of vectors that one block holds about, and rows at most.
BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 8192
#: Bytes of vectors that are broadcast at once.
CHUNK_BYTES = 16 << 20
_ROW = "row bigint, id bigint, label bigint, vector binary"


@dataclass
class Vectors:
    """Row numbers, ids (``known`` is false where null), labels and the matrix, a row each."""

    row: np.ndarray
    id: np.ndarray
    known: np.ndarray
    label: np.ndarray
    x: np.ndarray

    def __len__(self) -> int:
        return len(self.row)

    def take(self, at: np.ndarray) -> Vectors:
        return Vectors(self.row[at], self.id[at], self.known[at], self.label[at], self.x[at])


def _usable(batch: pa.RecordBatch, kind: str, zeros: bool) -> pa.RecordBatch:
    row, ids, label, vector = batch.columns
    data = vector.values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    at = vector.offsets.to_numpy()

    def holds(which: np.ndarray) -> np.ndarray:
        before = np.concatenate([[0], np.cumsum(which)])
        return before[at[1:]] > before[at[:-1]]

    ok = vector.is_valid().to_numpy(zero_copy_only=False) & ~holds(~np.isfinite(data))
    keep = np.flatnonzero(ok if zeros else ok & holds(data != 0))
    data = data.astype(kind)
    found = [data[at[i]: at[i + 1]].tobytes() for i in keep.tolist()]
    take = pa.array(keep)
    return pa.RecordBatch.from_arrays([row.take(take), ids.take(take), label.take(take), pa.array(found, pa.binary())], names=["row", "id", "label", "vector"])


def usable(table: DataFrame, id: str, vector: str, label: Column | None = None, zeros: bool = True) -> tuple[DataFrame, str]:
    """Rows (row, id, label, vector) whose vector is there with all components finite, and the numpy type of the bytes.

    A row number tells rows with one id apart.  Without ``zeros`` vectors that are empty or all 0 go too.
    """
    kind = "float" if table.schema[vector].dataType.elementType.simpleString() == "float" else "double"
    code = "<f4" if kind == "float" else "<f8"
    rows = table.select(F.monotonically_increasing_id().alias("row"), F.col(id).cast("bigint").alias("id"),
                        (F.lit(None) if label is None else label).cast("bigint").alias("label"),
                        F.col(vector).cast(f"array<{kind}>").alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _usable(b, code, zeros)

    return rows.mapInArrow(run, _ROW), code


def matrix(vectors: list[bytes], kind: str, dim: int) -> np.ndarray:
    """Rows of float64; a vector of fewer components than ``dim`` ends in zeros."""
    joined = np.frombuffer(b"".join(vectors), kind)
    if len(joined) == dim * len(vectors) and all(len(v) == len(vectors[0]) for v in vectors):
        return joined.reshape(len(vectors), dim).astype(np.float64)
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        x = np.frombuffer(v, kind)
        out[i, : len(x)] = x
    return out


def arrays(rows: pa.Table | pa.RecordBatch, kind: str, dim: int) -> Vectors:
    """Rows of ``usable`` as arrays."""
    def column(name: str) -> np.ndarray:
        return rows.column(name).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) \
            else rows.column(name).combine_chunks().cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)

    known = np.array([x is not None for x in rows.column("id").to_pylist()], bool)
    return Vectors(column("row"), column("id"), known, column("label"), matrix(rows.column("vector").to_pylist(), kind, dim))


def shape(rows: DataFrame, kind: str) -> tuple[int, int]:
    """Rows, and components of the longest vector."""
    n, most = rows.agg(F.count("*"), F.max(F.octet_length("vector"))).first()
    return n, (most or 0) // int(kind[-1])


def blocks(rows: DataFrame, n: int, dim: int, kind: str, build: Callable[[Vectors], dict[str, bytes]], columns: list[str]) -> DataFrame:
    """One row per block: what ``build`` makes of its vectors, as the binary ``columns``."""
    width = max(dim, 1) * int(kind[-1])
    size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // width))
    parts = max(1, -(-n * width // BLOCK_BYTES))

    def made(gathered: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = build(arrays(pa.Table.from_batches(gathered), kind, dim))
        return pa.RecordBatch.from_arrays([pa.array([found[c]], pa.binary()) for c in columns], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, size - held)
                waiting.append(part)
                held += part.num_rows
                b = b.slice(part.num_rows)
                if held == size:
                    yield made(waiting)
                    waiting, held = [], 0
        if held:
            yield made(waiting)

    return rows.repartition(parts, F.xxhash64("row")).mapInArrow(run, ", ".join(f"`{c}` binary" for c in columns))


def packed(v: Vectors, kind: str) -> dict[str, bytes]:
    return {"row": v.row.tobytes(), "id": v.id.tobytes(), "known": v.known.tobytes(), "label": v.label.tobytes(), "x": v.x.astype(kind).tobytes()}


#: The columns of ``packed``.
PACKED = ["row", "id", "known", "label", "x"]


def unpacked(block: dict[str, bytes], kind: str) -> Vectors:
    row = np.frombuffer(block["row"], np.int64)
    x = np.frombuffer(block["x"], kind).reshape(len(row), -1) if len(row) else np.zeros((0, 0))
    return Vectors(row, np.frombuffer(block["id"], np.int64), np.frombuffer(block["known"], bool), np.frombuffer(block["label"], np.int64), x.astype(np.float64))


def chosen(index: DataFrame, kind: str, divisor: int) -> DataFrame:
    """Rows (row, id, label, vector) of a table of blocks whose id ``divisor`` divides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in b.to_pylist():
                v = unpacked(block, kind)
                v = v.take(np.flatnonzero(v.known & (v.id % divisor == 0)))
                yield pa.RecordBatch.from_arrays([pa.array(v.row), pa.array(v.id), pa.array(v.label), pa.array([x.astype(kind).tobytes() for x in v.x], pa.binary())],
                                                 names=["row", "id", "label", "vector"])

    return index.select(*PACKED).mapInArrow(run, _ROW)


def chunks(rows: DataFrame, kind: str, dim: int) -> Iterator[Vectors]:
    """The rows (row, id, label, vector) in parts of about CHUNK_BYTES, ascending by row, to broadcast one after the other."""
    n = max(1, -(-rows.count() * max(dim, 1) * 8 // CHUNK_BYTES))
    for i in range(n):
        part = arrays(rows.where(F.pmod(F.xxhash64("row"), F.lit(n)) == i).toArrow(), kind, dim)
        if len(part):
            yield part.take(np.argsort(part.row, kind="stable"))


def few_rows(rows: DataFrame, n: int, most: int) -> DataFrame:
    """About ``most`` of the ``n`` rows, or all: those with the least hashes of their row numbers."""
    h = F.xxhash64(F.lit(7), "row")
    return rows if n <= most else rows.where(F.pmod(h, F.lit(1 << 40)) < int((1 << 40) * most / n))


def first_in_groups(groups: np.ndarray, most: int) -> np.ndarray:
    """Of a sorted array of groups: which entries are among the first ``most`` of theirs."""
    if not len(groups):
        return np.zeros(0, bool)
    edge = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    return np.arange(len(groups)) - np.repeat(edge, np.diff(np.concatenate([edge, [len(groups)]]))) < most
