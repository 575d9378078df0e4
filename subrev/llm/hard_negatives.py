"""Hard negatives by threshold joins over an inverted index with norm bounds (after L2AP).

An anchor's positives are its POSITIVES rows of greatest score (inner product of
components scaled to integers) with the same label.  The hard negatives of an anchor
and a positive are the NEGATIVES greatest scores of other labels inside a window of
the positive's score.

Both come from threshold joins, which return every pair of a score of at least the
anchor's threshold:

* Dimensions have one order, of least mean square first.  The index of a block of rows
  lists rows per panel of dimensions.  A row is not listed in its first panels as long
  as the norm of what they hold, times the anchor's norm, stays below the threshold: they
  cannot bring a pair to the threshold.
* Partial scores are added up over the lists, last panel first.  A pair goes when its partial
  score plus the product of the norms of what both have left is below the threshold.
* What is left is scored exactly, in whole numbers.

Thresholds start where a sample of the rows lets expect that the windows fill, and are
lowered for the anchors whose windows did not, down to one that every row reaches (or the
window's lower end), so that the result is that of all pairs at every size.  A round is one
pass over the blocks; anchors come in chunks of bounded size, broadcast one after the
other, and a block returns only its best rows of each window.

Defined results: a row takes no part without a label, without a vector, or with a
component that is null or not finite; a component is floor(SCALE * x), held within
+-LARGEST; a shorter vector than the longest ends in zeros; a row with a null id is never
an anchor and comes last among equal scores; repeated rows are rows of their own, and an
anchor's copy is another row; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subrev.llm import vectors
from subrev.llm.common import Scratch
from subrev.llm.vectors import Vectors

SCALE = 256
LARGEST = 1 << 53
POSITIVES = 5
NEGATIVES = 3
#: Rows from which the first thresholds are estimated.
SAMPLE = 4096
#: Pairs that a first threshold is to let through, as a multiple of what the window holds.
SLACK = 4
#: Rounds that lower a threshold by four times the last step each; the next one lets all through.
ROUNDS = 5
#: Dimensions whose partial scores are added at once, and anchors that are joined at once.
PANEL = 8
GROUP = 64
#: Pairs are scored one by one when fewer than this share of them is left.
FEW = 1 / 32
_MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
_HIT = "anchor int, slot int, row bigint, vec_id bigint, score bigint, last boolean"


def scaled(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * x), -LARGEST, LARGEST)


def rest_norms(x: np.ndarray) -> np.ndarray:
    """Norm of the dimensions before each panel, a column per panel and one for all; a little more than exact."""
    square = (x * x).reshape(len(x), -1, PANEL).sum(2)
    return np.sqrt(np.concatenate([np.zeros((len(x), 1)), np.cumsum(square, axis=1)], axis=1)) * (1 + 1e-9)


def ordered(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Integer components in the order of the index, with empty dimensions up to a whole panel."""
    out = np.zeros((len(x), -(-max(len(order), 1) // PANEL) * PANEL))
    out[:, : len(order)] = scaled(x)[:, order]
    return out


def exact_scores(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, in whole numbers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(a.shape[1], 1)
    if most < 1 << 52:
        return np.einsum("ij,ij->i", a, y).astype(np.int64)
    if most < 1 << 62:
        return np.einsum("ij,ij->i", a.astype(np.int64), y.astype(np.int64))
    wide = [sum(p * q for p, q in zip(map(int, i), map(int, j))) for i, j in zip(a, y)]
    return np.array([min(max(w, -(1 << 63)), (1 << 63) - 1) for w in wide], np.int64)


def threshold_join(a: np.ndarray, least: np.ndarray, y: np.ndarray, y_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs whose score is at least the anchor's threshold ``least``."""
    found = []
    if len(a) and len(y):
        a_rest = rest_norms(a)
        norm = np.maximum(a_rest[:, -1], 1e-9)
        by_bound = np.argsort(least / norm, kind="stable")
        for g in range(0, len(a), GROUP):
            at = by_bound[g: g + GROUP]
            i, j, score = _join_group(a[at], a_rest[at], least[at], float((least[at] / norm[at]).min()), y, y_rest)
            found.append((at[i], j, score))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _join_group(a: np.ndarray, a_rest: np.ndarray, least: np.ndarray, bound: float, y: np.ndarray, y_rest: np.ndarray) -> tuple[np.ndarray, ...]:
    panels = y.shape[1] // PANEL
    # panels that a row is not listed in, the first ones; rows in the order of that, so that a list is a run of rows
    left_out = np.clip((y_rest < bound).sum(1) - 1, 0, panels)
    rows = np.argsort(left_out, kind="stable")
    listed = np.searchsorted(left_out[rows], np.arange(panels), "right")
    values, rest = y[rows], y_rest[rows]
    n = listed[panels - 1]
    partial = np.zeros((len(a), n))
    slack = 1e-12 * a_rest[:, -1:] * rest[None, :n, -1]
    for panel in range(panels - 1, -1, -1):
        part, m = slice(panel * PANEL, (panel + 1) * PANEL), listed[panel]
        partial[:, :m] += a[:, part] @ values[:m, part].T
        if panel % 2 == 0:
            # what both have left: the panels before this one, or all that the row is not listed in
            left = np.maximum(left_out[rows[:n]], panel)
            alive = partial + a_rest[:, left] * rest[np.arange(n), left] + slack >= least[:, None]
            if np.count_nonzero(alive) <= FEW * alive.size:
                break
    i, j = np.nonzero(alive)
    out_i, out_j, out_s = [], [], []
    for k in range(0, len(i), 1 << 18):
        ii, jj = i[k: k + (1 << 18)], j[k: k + (1 << 18)]
        s = exact_scores(a[ii], values[jj])
        ok = s >= least[ii]
        out_i.append(ii[ok])
        out_j.append(rows[jj[ok]])
        out_s.append(s[ok])
    if not out_i:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(out_i), np.concatenate(out_j), np.concatenate(out_s)


class Anchors:
    """A chunk of anchors and, for every one, its windows: scores from ``least`` to ``most`` are sought, in some for the ``last`` time."""

    def __init__(self, v: Vectors, x: np.ndarray, least: np.ndarray, most: np.ndarray, last: np.ndarray) -> None:
        self.v, self.x, self.least, self.most, self.last = v, x, least, most, last


def join_blocks(index: DataFrame, kind: str, order: np.ndarray, anchors: Anchors, keep: int, same: bool) -> DataFrame:
    """The ``keep`` best rows of every block in each window, of the anchor's label or of others."""
    shared = index.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        windows = a.least <= a.most
        open_at = np.flatnonzero(windows.any(axis=1))
        least = np.where(windows, a.least, np.inf).min(axis=1)
        for b in batches:
            for data in b.to_pylist():
                v = vectors.unpacked(data, kind)
                y = ordered(v.x, order)
                y_rest = rest_norms(y)
                found = []
                for label in np.intersect1d(a.v.label[open_at], v.label).tolist() if same else [None]:
                    who = open_at[a.v.label[open_at] == label] if same else open_at
                    rows = np.flatnonzero(v.label == label) if same else np.arange(len(v))
                    i, j, s = threshold_join(a.x[who], least[who], y[rows], y_rest[rows])
                    found.append((who[i], rows[j], s))
                if found:
                    yield _best(a, v, *(np.concatenate(x) for x in zip(*found)), keep, same)

    return index.select(*vectors.PACKED).mapInArrow(run, _HIT)


def _best(a: Anchors, v: Vectors, i: np.ndarray, j: np.ndarray, s: np.ndarray, keep: int, same: bool) -> pa.RecordBatch:
    ok = a.v.row[i] != v.row[j] if same else a.v.label[i] != v.label[j]
    i, j, s = i[ok], j[ok], s[ok]
    best = np.lexsort((v.row[j], v.id[j], ~v.known[j], -s, i))
    i, j, s = i[best], j[best], s[best]
    out = []
    for slot in range(a.least.shape[1]):
        inside = np.flatnonzero((s >= a.least[i, slot]) & (s <= a.most[i, slot]))
        inside = inside[vectors.first_in_groups(i[inside], keep)]
        out.append((i[inside], np.full(len(inside), slot), j[inside], s[inside]))
    i, slot, j, s = (np.concatenate(x) for x in zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(slot, pa.int32()), pa.array(v.row[j]), pa.array(v.id[j], mask=~v.known[j]), pa.array(s),
                                       pa.array(a.last[i, slot], pa.bool_())], names=["anchor", "slot", "row", "vec_id", "score", "last"])


def best_of_windows(hits: DataFrame, keep: int) -> DataFrame:
    w = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def first_thresholds(x: np.ndarray, labels: np.ndarray, sample: np.ndarray, sample_labels: np.ndarray, n: int, row: np.ndarray, sample_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(thresholds that are to let SLACK * POSITIVES rows of an anchor's label through, first steps to lower them by)."""
    least, step = np.full(len(x), -np.inf), np.ones(len(x))
    want = SLACK * POSITIVES * len(sample) / max(n, 1)
    for label in np.unique(labels).tolist():
        who, rows = np.flatnonzero(labels == label), np.flatnonzero(sample_labels == label)
        k = max(8, int(np.ceil(want)))
        if len(rows) <= k + 1:
            continue
        for g in range(0, len(who), 256):
            at = who[g: g + 256]
            s = x[at] @ sample[rows].T
            s[row[at][:, None] == sample_row[rows][None, :]] = -np.inf
            top = -np.partition(-s, k, axis=1)[:, : k + 1]
            top.sort(axis=1)
            # scores beyond the k-th fall off about as fast as the k greatest do on average
            excess = np.maximum(top[:, 1:].mean(axis=1) - top[:, 0], 1)
            least[at] = np.floor(top[:, 0] + excess * np.log(max(k / want, 1)))
            step[at] = np.ceil(excess)
    return least, step


def window_steps(x: np.ndarray, labels: np.ndarray, most: np.ndarray, sample: np.ndarray, sample_labels: np.ndarray, n: int) -> np.ndarray:
    """How far below the upper end of each window SLACK * NEGATIVES scores of other labels are to be expected."""
    out = np.full(most.shape, np.inf)
    want, k = SLACK * NEGATIVES * len(sample) / max(n, 1), 8
    for g in range(0, len(x), 256):
        at = np.arange(g, min(g + 256, len(x)))
        s = x[at] @ sample.T
        s[labels[at][:, None] == sample_labels[None, :]] = -np.inf
        s.sort(axis=1)
        for r, i in enumerate(at.tolist()):
            below = np.searchsorted(s[r], most[i], "right")
            first = np.searchsorted(s[r], -np.inf, "right")
            for slot, z in enumerate(below.tolist()):
                if z - k >= first:
                    out[i, slot] = max(1.0, np.ceil((most[i, slot] - s[r, z - k]) / k * max(want, 0.01)))
    return out


def positives_of(index: DataFrame, kind: str, order: np.ndarray, anchors: Vectors, x: np.ndarray, sample: Vectors, sample_x: np.ndarray, n: int) -> pa.Table:
    """(anchor, slot, row, vec_id, score, rank): the POSITIVES best rows of each anchor's label."""
    least, step = first_thresholds(x, anchors.label, sample_x, sample.label, n, anchors.row, sample.row)
    open_ = np.ones(len(x), bool)
    found = []
    for turn in range(ROUNDS + 2):
        if not open_.any():
            break
        if turn:
            least = least - step * 4 ** (turn - 1) if turn <= ROUNDS else np.full(len(x), -np.inf)
        last = np.isneginf(least)
        window = np.where(open_, least, np.inf)[:, None]
        most = np.where(open_, np.inf, -np.inf)[:, None]
        hits = join_blocks(index, kind, order, Anchors(anchors, x, window, most, last[:, None]), POSITIVES, same=True)
        best = best_of_windows(hits, POSITIVES).toArrow()
        count = np.bincount(best.column("anchor").to_numpy(), minlength=len(x))
        done = open_ & ((count >= POSITIVES) | last)
        found.append(best.filter(pa.array(done[best.column("anchor").to_numpy()], pa.bool_())))
        open_ &= ~done
    return pa.concat_tables(found).combine_chunks()


def negatives_of(index: DataFrame, kind: str, order: np.ndarray, anchors: Vectors, x: np.ndarray, positive: np.ndarray, sample: Vectors,
                 sample_x: np.ndarray, n: int, scratch: Scratch, name: str) -> Iterator[DataFrame]:
    """Tables (anchor, slot, row, vec_id, score, rank) of the NEGATIVES best rows in the windows below the positives' scores."""
    low, most = -(-positive // 2), 95 * positive // 100
    open_ = (positive >= 0) & (low <= most)
    step = window_steps(x, anchors.label, np.where(open_, most, 0), sample_x, sample.label, n)
    for turn in range(ROUNDS + 2):
        if not open_.any():
            return
        least = np.maximum(low, most - step * 4 ** turn) if turn <= ROUNDS else low.astype(np.float64)
        last = least <= low
        window = Anchors(anchors, x, np.where(open_, least, np.inf), np.where(open_, most, -np.inf), last)
        best = scratch.keep(f"{name}-{turn}", best_of_windows(join_blocks(index, kind, order, window, NEGATIVES, same=False), NEGATIVES))
        counts = best.groupBy("anchor", "slot").count().toArrow()
        count = np.zeros(open_.shape, np.int64)
        count[counts.column("anchor").to_numpy(), counts.column("slot").to_numpy()] = counts.column("count").to_numpy()
        full = F.count("*").over(Window.partitionBy("anchor", "slot")) >= NEGATIVES
        yield best.withColumn("full", full).where(F.col("full") | F.col("last"))
        open_ &= ~last & (count < NEGATIVES)


def mine(table: DataFrame, divisor: int = 50, id: str = "vec_id", vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every row whose id ``divisor`` divides."""
    spark = table.sparkSession
    scratch = Scratch(spark, "negatives")
    label = F.col("label") if label is None else label
    rows, kind = vectors.usable(table.where(label.isNotNull()), id, vector, label)
    n, dim = vectors.shape(rows, kind)
    index = scratch.keep("index", vectors.blocks(rows, n, dim, kind, lambda v: vectors.packed(v, kind), vectors.PACKED))
    asked = scratch.keep("anchors", vectors.chosen(index, kind, divisor))
    sample = vectors.arrays(vectors.few_rows(vectors.chosen(index, kind, 1), n, SAMPLE).toArrow(), kind, dim)
    order = np.argsort((sample.x ** 2).mean(axis=0), kind="stable") if len(sample) else np.arange(dim)
    sample_x = ordered(sample.x, order)
    found: list[str] = []
    for c, anchors in enumerate(vectors.chunks(asked, kind, dim)):
        x = ordered(anchors.x, order)
        best = positives_of(index, kind, order, anchors, x, sample, sample_x, n)
        at, slot = best.column("anchor").to_numpy(), best.column("rank").to_numpy() - 1
        score = np.full((len(x), POSITIVES), -1, np.int64)
        score[at, slot] = best.column("score").to_numpy()
        known = pa.table({"anchor": pa.array(at, pa.int32()), "slot": pa.array(slot, pa.int32()), "anchor_id": pa.array(anchors.id[at]),
                          "positive_id": best.column("vec_id"), "positive_score": best.column("score")})
        pairs = scratch.keep(f"pairs{c}", spark.createDataFrame(known.combine_chunks()))
        for i, part in enumerate(negatives_of(index, kind, order, anchors, x, score, sample, sample_x, n, scratch, f"windows{c}")):
            found.append(scratch.path(f"found{c}-{i}"))
            part.join(pairs, ["anchor", "slot"]).select(
                "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.parquet(found[-1])
    return spark.read.schema(_MINED).parquet(*found) if found else spark.createDataFrame([], _MINED)
