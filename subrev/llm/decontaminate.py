"""Benchmark decontamination by a broadcast set of test windows.

The windows of the benchmark (13 consecutive words; a shorter item is one window)
become a sorted array of 64-bit hashes plus the window texts.  Each document is
scanned once per part of that set: window hashes are looked up, and a hit counts
only when the words themselves are equal.  Hit word spans are merged, so a
document, or only its spans, can be removed.

The set is broadcast, so its size is bounded: it is counted first and cut by hash
into parts of about ``PART_WINDOWS`` windows, each scanned on its own; the hits of
earlier parts travel in the row.  Documents are never shuffled.

Defined results: a null or empty text has no words and no hit; an item without
words has no window; benchmark rows without an item_id are left out, since
nothing could name them; rows of one item_id are one item; repeated documents
get one row each; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subrev.llm import flat
from subrev.llm.common import by_batch

WINDOW = 13
#: Windows in one broadcast part; at about 300 bytes each a part stays near 30 MB in a worker.
PART_WINDOWS = 100_000


def _text(t: flat.Texts, w: flat.Spans, at: int, size: int) -> bytes:
    """The words of a window, folded, joined by one space."""
    return b" ".join(flat.LOWER[t.data[w.start[k]: w.end[k]]].tobytes() for k in range(at, at + size))


def benchmark_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, window, n_words): the distinct windows of every item."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts, sizes = [], [], []
        for b in flat.slices(batch, "text"):
            t = flat.texts_of(b.column("text"))
            w = flat.words(t, flat.ALNUM, lower=True)
            n = np.diff(w.first)
            for i, item in enumerate(b.column("item_id").to_pylist()):
                m = min(size, int(n[i]))
                for at in range(w.first[i], w.first[i] + (n[i] - m + 1 if m else 0)):
                    ids.append(item)
                    texts.append(_text(t, w, at, m))
                    sizes.append(m)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.binary()), pa.array(sizes, pa.int32())],
                                          names=["item_id", "window", "n_words"])

    rows = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    return rows.mapInArrow(by_batch(work), "item_id string, window binary, n_words int").distinct()


class WindowSet:
    """One broadcast part: per window length the sorted hashes, and per hash the windows with their items."""

    def __init__(self, rows: list[tuple[bytes, int, list[str]]]) -> None:
        self.items = {bytes(text): names for text, _, names in rows}
        self.hashes: dict[int, np.ndarray] = {}
        for size in sorted({n for _, n, _ in rows}):
            joined = pa.array([bytes(text) for text, n, _ in rows if n == size], pa.binary()).cast(pa.string())
            t = flat.texts_of(joined)
            _, h = flat.windows(flat.words(t, flat.ALNUM, lower=True), size)
            self.hashes[size] = np.unique(h)

    def hits(self, t: flat.Texts, w: flat.Spans) -> list[tuple[int, int, int, list[str]]]:
        """(document, first word, words, items) of every occurrence."""
        out = []
        for size, known in self.hashes.items():
            at, h = flat.windows(w, size)
            near = np.minimum(np.searchsorted(known, h), len(known) - 1)
            for k in at[known[near] == h]:
                names = self.items.get(_text(t, w, k, size))
                if names is not None:
                    out.append((int(w.doc[k]), int(k - w.first[w.doc[k]]), size, names))
        return out


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint (from, to) spans in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPANS = pa.list_(pa.list_(pa.int64()))
_ADDED = "n_words bigint, spans array<array<bigint>>, items array<string>"


def _scan(docs: DataFrame, part: object, first: bool) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: WindowSet = part.value
        n_words, spans, items = [], [], []
        for b in flat.slices(batch, "text"):
            t = flat.texts_of(b.column("text"))
            w = flat.words(t, flat.ALNUM, lower=True)
            n_words.append(np.diff(w.first))
            near = [[] for _ in range(t.n)] if first else b.column("spans").to_pylist()
            names = [set() for _ in range(t.n)] if first else [set(x) for x in b.column("items").to_pylist()]
            touched = set()
            for doc, at, size, of in known.hits(t, w):
                near[doc].append((at, at + size))
                names[doc].update(of)
                touched.add(doc)
            for doc in touched:
                near[doc] = merge_spans([tuple(x) for x in near[doc]])
            spans += near
            items += [sorted(x) for x in names]
        columns = {f: batch.column(f) for f in batch.schema.names}
        columns |= {"n_words": pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
                    "spans": pa.array(spans, _SPANS), "items": pa.array(items, pa.list_(pa.string()))}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in ("n_words", "spans", "items")]
    return docs.mapInArrow(by_batch(work), ", ".join([*kept, _ADDED]))


def scan(docs: DataFrame, items: DataFrame, size: int = WINDOW, part_windows: int = PART_WINDOWS) -> DataFrame:
    """The columns of ``docs`` with n_words, the merged hit spans in words, and the items found, sorted as text.

    Runs one small job to count the windows and one per part to fetch it.
    """
    spark = docs.sparkSession
    named = benchmark_windows(items, size).groupBy("window", "n_words").agg(F.collect_set("item_id").alias("names"))
    parts = max(1, -(-named.count() // part_windows))
    out = docs.drop("n_words", "spans", "items")
    for p in range(parts):
        mine = named if parts == 1 else named.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == p)
        rows = [(r["window"], r["n_words"], r["names"]) for r in mine.toLocalIterator()]
        out = _scan(out, spark.sparkContext.broadcast(WindowSet(rows)), first=p == 0)
    return out


def _sum_of(spans: str) -> F.Column:
    return F.aggregate(F.col(spans), F.lit(0).cast("bigint"), lambda a, s: a + s[1] - s[0])


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document its words, hit words, items found (count and digest), and the verdict: at least one word in twenty hit."""
    found = scan(docs.select("doc_id", "text"), items)
    n_hit = _sum_of("spans")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def _aside(docs: DataFrame) -> DataFrame:
    """``docs`` with columns that are named as the scan's own out of the way."""
    return docs.withColumnsRenamed({c: f"own {c}" for c in ("n_words", "spans", "items")})


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.drop("n_words", "spans", "items").withColumnsRenamed({f"own {c}": c for c in ("n_words", "spans", "items")}).select(*docs.columns)


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    clean = scan(_aside(docs), items).where(~((_sum_of("spans") > 0) & (20 * _sum_of("spans") >= F.col("n_words"))))
    return _back(clean, docs)


def remove_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Every document without its hit words: the bytes from the first to the last hit word of each span go."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for b in flat.slices(batch, "text"):
            t = flat.texts_of(b.column("text"))
            w = flat.words(t, flat.ALNUM, lower=True)
            for i, (spans, null) in enumerate(zip(b.column("spans").to_pylist(), b.column("text").is_null().to_pylist())):
                at, end, kept = t.offsets[i], t.offsets[i + 1], []
                for a, z in spans:
                    kept.append(t.data[at: w.start[w.first[i] + a]].tobytes())
                    at = w.end[w.first[i] + z - 1]
                texts.append(None if null else b"".join([*kept, t.data[at:end].tobytes()]).decode())
        columns = {f: batch.column(f) for f in batch.schema.names} | {"text": pa.array(texts, pa.string())}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    found = scan(_aside(docs), items)
    return _back(found.mapInArrow(by_batch(work), found.schema), docs)


def digest(names: list[str]) -> str:
    """What ``items_sha256`` holds for these items."""
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
