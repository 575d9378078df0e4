"""N-gram Jaccard join in the metric space of shingle sets.

The Jaccard distance of finite sets is a metric, and pivots need not be documents.

1. *Classes.*  Documents with the same set are one point; copies go no further.
2. *Pivots of the first level* are the one-shingle sets {s}.  d(x, {s}) is
   1 - 1/|x| for s in x and 1 otherwise, so the nearest pivots of x are its own
   shingles; ties are broken by one global order, rare shingles first.  A set within
   the distance of x lacks at most k = |x| - ceil(J |x|) of its shingles, so x is in
   the region of its nearest pivot and in the windows of the next k: the first
   shingle two near sets share is among the first k + 1 of both, and they meet there.
3. *Regions.*  A region of up to ``SMALL`` points is compared within its size window.
   In a larger one a member becomes the pivot; the exact distances to it link its
   ball and cut the rest into rings as wide as the distance, and each ring takes in
   the ring below it (the triangle inequality allows no other partner).  Points
   already linked need no comparison.  After ``ROUNDS`` pivots the points of a
   region that are still in different components are compared across them.
4. *Candidates* have to pass two lower bounds of the symmetric difference: in the
   region of the first shingle two sets share, the shingles that either ranks before
   it are not shared; and the counts of shingles in 32 hash classes differ by no more.
   Then the texts themselves are compared.

The rarity order comes from a sketch of fixed size over all documents; any order
gives the same result.  Shingles are compared by 64-bit hashes.

Defined results: a null text or one without words has an empty set, is linked with
nothing and keeps its own component; fewer words than a shingle are one shingle;
repeated rows get one row each and share a component; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subrev.llm import flat
from subrev.llm.common import Scratch, add_columns, fresh
from subrev.llm.components import components

SKETCH_BITS = 20
SKETCH_SLICE = 1 << 14
CLASSES = 32
SMALL = 24
ROUNDS = 2
FILTER_BITS = 24
#: Sets remembered by a task so that a copy it has met is not handed on again.
REMEMBERED = 100_000


def shingle_sets(t: flat.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and where each text's begin (one more than texts)."""
    w = flat.words(t, lower=True)
    at, h = flat.windows(w, size)
    doc = w.doc[at]
    n = np.diff(w.first)
    for m in range(1, size):
        few = np.flatnonzero(n == m)
        if len(few):
            pos, hm = flat.windows(w, m)
            mine = np.isin(pos, w.first[few])
            h, doc = np.concatenate([h, hm[mine]]), np.concatenate([doc, w.doc[pos[mine]]])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(t.n + 1))


def _keys(h: np.ndarray, first: np.ndarray) -> list[bytes]:
    """128 bits for each set: the wrapped sums of two mixings of its shingles, and its size mixed in."""
    n = np.diff(first)
    out = np.zeros((len(n), 2), np.uint64)
    for j, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat.mix(h ^ np.uint64(salt)), dtype=np.uint64)])
        out[:, j] = flat.mix(sums[first[1:]] - sums[first[:-1]] + n.astype(np.uint64))
    return [r.tobytes() for r in out]


def missing(n: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles of a set of n a linked set can lack."""
    return n - (percent * n + 99) // 100


def class_counts(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.bincount(doc * CLASSES + (h >> np.uint64(59)).astype(np.int64), minlength=CLASSES * (len(first) - 1)) \
        .reshape(-1, CLASSES).astype("<u4")


_SETS = "doc_id bigint, k binary, n bigint, counts binary, slice int, sketch binary"


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for b in flat.slices(batch, "text"):
                h, first = shingle_sets(flat.texts_of(b.column("text")), size)
                sketch += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch)).astype(np.uint32)
                none = pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").cast(pa.int64()), pa.array(_keys(h, first), pa.binary()), pa.array(np.diff(first), pa.int64()),
                     pa.array([r.tobytes() for r in class_counts(h, first)], pa.binary()), *none],
                    names=["doc_id", "k", "n", "counts", "slice", "sketch"])
        if sketch.any():
            parts = sketch.reshape(-1, SKETCH_SLICE)
            none = [pa.nulls(len(parts), kind) for kind in (pa.int64(), pa.binary(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array(range(len(parts)), pa.int32()), pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary())],
                names=["doc_id", "k", "n", "counts", "slice", "sketch"])
    return run


def _merged(parts: DataFrame, how) -> list:
    """Fixed-size arrays of all tasks folded slice by slice; the driver gets one array per slice, whatever the input."""
    def fold(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in b.column("sketch").to_pylist():
                v = np.frombuffer(x, "<u4")
                total = v if total is None else how(total, v)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         names=["slice", "sketch"])

    return parts.select("slice", "sketch").groupBy("slice").applyInArrow(fold, "slice int, sketch binary").collect()


def _array(rows: list, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint32)
    for r in rows:
        v = np.frombuffer(r["sketch"], "<u4")
        out[r["slice"] * len(v): (r["slice"] + 1) * len(v)] = v
    return out


def _windows(size: int, percent: int, sketch):
    """(s, k, n, p): every region a set takes part in, and how many of its shingles rank before s."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, seen = sketch.value, set()
        for batch in batches:
            for b in flat.slices(batch, "text"):
                h, first = shingle_sets(flat.texts_of(b.column("text")), size)
                keys, n = _keys(h, first), np.diff(first)
                doc = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((h, df[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], doc))
                rank = np.arange(len(h)) - first[doc]
                fresh = np.zeros(len(n), bool)
                for i, k in enumerate(keys):
                    if n[i] and k not in seen:
                        fresh[i] = True
                        if len(seen) < REMEMBERED:
                            seen.add(k)
                near = (rank <= missing(n, percent)[doc]) & fresh[doc]
                take, of = order[near], doc[near]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[take].view(np.int64)), pa.array(keys, pa.binary()).take(pa.array(of)), pa.array(n[of], pa.int64()),
                     pa.array(rank[near], pa.int32())], names=["s", "k", "n", "p"])
    return run


def _bit(keys: list[bytes]) -> np.ndarray:
    return (np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)[:, 0] >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _key_filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that holds every key; it only saves moving texts that no pair needs."""
    words = 1 << (FILTER_BITS - 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for b in batches:
            if b.num_rows:
                bits[_bit(b.column("k").to_pylist())] = True
        parts = np.packbits(bits, bitorder="little").view("<u4").reshape(-1, SKETCH_SLICE)
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([parts[i].tobytes() for i in used], pa.binary())],
                                         names=["slice", "sketch"])

    found = _merged(keys.select("k").mapInArrow(run, "slice int, sketch binary"), np.bitwise_or)
    return np.unpackbits(_array(found, words).view(np.uint8), bitorder="little").astype(bool)


def _texts(size: int, wanted):
    """(k, text) of the sets that the filter lets through, each set once per task as far as remembered."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = wanted.value, set()
        for batch in batches:
            for b in flat.slices(batch, "text"):
                h, first = shingle_sets(flat.texts_of(b.column("text")), size)
                keys = _keys(h, first)
                take = []
                for i in np.flatnonzero(bits[_bit(keys)] & (np.diff(first) > 0)):
                    if keys[i] not in seen:
                        take.append(i)
                        if len(seen) < REMEMBERED:
                            seen.add(keys[i])
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()).take(pa.array(take, pa.int64())),
                                                  b.column("text").cast(pa.string()).take(pa.array(take, pa.int64()))], names=["k", "text"])
    return run


def _overlap(size: int):
    """(a, b, common) of pairs with both texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in flat.slices(batch, "ta"):
                for b in flat.slices(half, "tb"):
                    (ha, fa), (hb, fb) = (shingle_sets(flat.texts_of(b.column(c)), size) for c in ("ta", "tb"))
                    doc = np.concatenate([np.repeat(np.arange(b.num_rows), np.diff(f)) for f in (fa, fb)])
                    key = np.sort(flat.in_doc(np.concatenate([ha, hb]), doc))
                    # equal neighbours are one shingle in both sets; their pair is found again through its place in ``ha``
                    both = np.isin(flat.in_doc(ha, doc[: len(ha)]), key[1:][key[1:] == key[:-1]])
                    common = np.bincount(doc[: len(ha)][both], minlength=b.num_rows)
                    yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(common, pa.int64())], names=["a", "b", "common"])
    return run


def _may_link(percent: int):
    """Pairs whose class counts leave room for a link: |x ^ y| <= (1 - J) / (1 + J) * (|x| + |y|)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").reshape(-1, CLASSES).astype(np.int64) for c in ("ca", "cb"))
            apart, total = np.abs(x - y).sum(axis=1), x.sum(axis=1) + y.sum(axis=1)
            yield b.filter(pa.array((100 + percent) * apart <= (100 - percent) * total)).select(["a", "b", "na", "nb"])
    return run


class _Join:
    """One run: the tables that its steps hand on."""

    def __init__(self, docs: DataFrame, size: int, percent: int) -> None:
        self.docs, self.size, self.percent = docs.select("doc_id", "text"), size, percent
        self.spark: SparkSession = docs.sparkSession
        self.scratch = Scratch(self.spark, "jaccard")

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)

    def ranks_fit(self, pa_: Column, na: Column, pb: Column, nb: Column) -> Column:
        """What ranks leave of a pair: the shingles before the first shared one are not shared, on either side."""
        common = F.least(na - pa_, nb - pb)
        return ((100 + self.percent) * (pa_ + pb) <= (100 - self.percent) * (na + nb)) & ((100 + self.percent) * common >= self.percent * (na + nb))

    def prepare(self) -> None:
        both = self.scratch.keep("sets", self.docs.mapInArrow(_describe(self.size), _SETS))
        self.sets = both.where(F.col("k").isNotNull()).select("doc_id", "k", "n", "counts")
        sketch = _array(_merged(both.where(F.col("slice").isNotNull()), np.add), 1 << SKETCH_BITS)
        self.points = self.scratch.keep("points", self.sets.where("n > 0").groupBy("k", "n").agg(F.first("counts").alias("counts")))
        windows = self.docs.mapInArrow(_windows(self.size, self.percent, self.spark.sparkContext.broadcast(sketch)), "s bigint, k binary, n bigint, p int")
        near = windows.repartition("s").dropDuplicates(["s", "k", "n", "p"]) \
            .withColumn("m", F.count("*").over(_by("s"))).where("m > 1")
        self.regions = self.scratch.keep("regions", near)

    def small_pairs(self) -> DataFrame:
        """Pairs of the regions of up to SMALL points, in order of size: only those whose sizes allow a link."""
        one = self.regions.where(F.col("m") <= SMALL).groupBy("s").agg(F.sort_array(F.collect_list(F.struct("n", "k", "p"))).alias("m"))
        pairs = F.flatten(F.transform("m", lambda x, i: F.transform(
            F.filter(F.slice("m", i + 2, F.size("m")),
                     lambda y: self.sizes_fit(x["n"], y["n"]) & self.ranks_fit(x["p"], x["n"], y["p"], y["n"])),
            lambda y: F.struct(x["k"].alias("a"), y["k"].alias("b"), x["n"].alias("na"), y["n"].alias("nb")))))
        rows = one.select(F.explode(pairs).alias("q")).select("q.*")
        return _ordered(rows).distinct()

    def filtered(self, pairs: DataFrame) -> DataFrame:
        a = self.points.select(F.col("k").alias("a"), F.col("counts").alias("ca"))
        b = self.points.select(F.col("k").alias("b"), F.col("counts").alias("cb"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "ca", "cb") \
            .mapInArrow(_may_link(self.percent), "a binary, b binary, na bigint, nb bigint")

    def fetch(self, keys: DataFrame) -> None:
        """The texts behind these sets, moved once."""
        wanted = self.spark.sparkContext.broadcast(_key_filter(keys))
        self.texts = self.scratch.keep("texts", self.docs.mapInArrow(_texts(self.size, wanted), "k binary, text string")
                                       .dropDuplicates(["k"]))

    def measured(self, pairs: DataFrame) -> DataFrame:
        """(a, b, na, nb, common) of distinct pairs, from the texts."""
        a = self.texts.select(F.col("k").alias("a"), F.col("text").alias("ta"))
        b = self.texts.select(F.col("k").alias("b"), F.col("text").alias("tb"))
        got = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(_overlap(self.size), "a binary, b binary, common bigint")
        return got.join(pairs, ["a", "b"])

    def linked(self) -> Column:
        return 100 * F.col("common") >= self.percent * (F.col("na") + F.col("nb") - F.col("common"))

    def large_regions(self, links: list[DataFrame]) -> None:
        """Pivots and rings within the regions above SMALL; adds to ``links``."""
        width = (100 - self.percent) / 100 * (1 + 1e-9)
        live = self.regions.where(F.col("m") > SMALL).select(F.col("s").cast("string").alias("r"), "k", "n", "p", F.lit(None).cast("binary").alias("tag"))
        for step in range(ROUNDS):
            # a pivot that is not yet linked to an earlier one, if the region has such; of these the one with the fewest shingles of its own
            order = F.struct(F.col("tag").isNotNull().alias("t"), "p", F.xxhash64("k", F.lit(step)).alias("h"), "k", "n")
            pivots = live.groupBy("r").agg(F.min(order).alias("o")).select("r", F.col("o.k").alias("pk"), F.col("o.n").alias("pn"))
            rows = live.join(pivots, "r")
            far = rows.where(F.col("k") != F.col("pk")).select(
                F.col("k").alias("a"), F.col("pk").alias("b"), F.col("n").alias("na"), F.col("pn").alias("nb"))
            got = self.scratch.keep(f"to-pivots-{step}", self.measured(_ordered(far).distinct()))
            links.append(got.where(self.linked()).select("a", "b"))
            least, most = F.least("k", "pk"), F.greatest("k", "pk")
            at = rows.withColumns({"a": least, "b": most}).join(got.select("a", "b", "common", (F.col("na") + F.col("nb")).alias("both")), ["a", "b"], "left")
            ring = F.when(F.col("k") == F.col("pk"), 0).otherwise(
                F.floor((1 - F.col("common") / (F.col("both") - F.col("common"))) / width).cast("int"))
            near = F.when((F.col("k") == F.col("pk")) | (100 * F.col("common") >= self.percent * (F.col("both") - F.col("common"))), F.col("pk"))
            split = at.select("r", "k", "n", "p", F.coalesce(near, "tag").alias("tag"), F.explode(F.array(ring, ring + 1)).alias("ring"))
            split = split.select(F.concat_ws("/", "r", F.col("ring").cast("string")).alias("r"), "k", "n", "p", "tag")
            # a ring is open while it holds a point without a link, or points of two pivots
            still = split.groupBy("r").agg(F.count("*").alias("m"), F.count("tag").alias("t"), F.min("tag").alias("x"), F.max("tag").alias("y")) \
                .where("m > 1 AND (t < m OR x != y)").select("r")
            live = self.scratch.keep(f"rings-{step}", split.join(still, "r"))
        label = components(_union(links), self.scratch, "part")
        named = live.join(label, live["k"] == label["vertex"], "left").select("r", "k", "n", "p", F.coalesce("component", "k").alias("c"))
        most = named.groupBy("r", "c").agg(F.count("*").alias("size"), F.max("n").alias("n")).groupBy("r") \
            .agg(F.max(F.struct("size", "c")).alias("top"), F.count("*").alias("cs"), F.max("n").alias("top_n"))
        # steps of ranks: a set meets only those whose rank leaves room beside its own
        step = F.expr(f"greatest(1, ({100 - self.percent} * 2 * top_n) div ({8 * (100 + self.percent)}))")
        most = most.where("cs > 1").select("r", F.col("top.c").alias("main"), step.alias("step"))
        named = self.scratch.keep("named", named.join(most, "r"))
        room = F.expr(f"({100 - self.percent} * (n + n * 100 div {self.percent} + 1)) div {100 + self.percent} - p")
        x = named.where(F.col("c") != F.col("main")).where(room >= 0).select(
            "r", F.col("k").alias("a"), F.col("n").alias("na"), F.col("c").alias("xc"), F.col("p").alias("px"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(room / F.col("step")).cast("bigint"))).alias("g"))
        y = named.select("r", F.col("k").alias("b"), F.col("n").alias("nb"), F.col("c").alias("yc"), F.col("p").alias("py"),
                         F.floor(F.col("p") / F.col("step")).cast("bigint").alias("g"))
        across = x.join(y, ["r", "g"]).where((F.col("xc") != F.col("yc")) & self.sizes_fit(F.col("na"), F.col("nb"))
                                             & self.ranks_fit(F.col("px"), F.col("na"), F.col("py"), F.col("nb")))
        rest = self.filtered(_ordered(across).distinct())
        links.append(self.scratch.keep("across", self.measured(rest).where(self.linked()).select("a", "b")))

    def links(self) -> DataFrame:
        """(a, b): enough links between distinct sets that the components are those of all links."""
        self.prepare()
        pairs = self.scratch.keep("pairs", self.filtered(self.small_pairs()))
        large = self.regions.where(F.col("m") > SMALL).select("k")
        self.fetch(_union([pairs.select(F.col("a").alias("k")), pairs.select(F.col("b").alias("k")), large]))
        links = [self.scratch.keep("near", self.measured(pairs).where(self.linked()).select("a", "b"))]
        if large.limit(1).count():
            self.large_regions(links)
        return _union(links)


def _by(*columns: str):
    from pyspark.sql import Window
    return Window.partitionBy(*columns)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _ordered(pairs: DataFrame) -> DataFrame:
    """(a, b, na, nb) with a below b."""
    turn = F.col("a") > F.col("b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                        F.when(turn, F.col("nb")).otherwise(F.col("na")).alias("na"), F.when(turn, F.col("na")).otherwise(F.col("nb")).alias("nb"))


def near_classes(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id): the component of each document under links of at least ``percent`` Jaccard similarity."""
    run = _Join(docs, size, percent)
    label = components(run.links(), run.scratch, "all")
    named = run.sets.where("n > 0").join(label, run.sets["k"] == label["vertex"], "left") \
        .select("doc_id", "n", F.coalesce("component", "k").alias("c"))
    named = run.scratch.keep("classes", named)
    least = named.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    alone = run.sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.join(least, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def one_of_each(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The documents, unchanged, without all but one of each component: the row of the least doc_id stays.

    Documents with an empty set are linked with nothing and all stay.  Of rows that agree in
    doc_id and set any one stays.
    """
    run = _Join(docs, size, percent)
    label = components(run.links(), run.scratch, "all")
    named = run.sets.where("n > 0").join(label, run.sets["k"] == label["vertex"], "left") \
        .select("doc_id", "k", F.coalesce("component", "k").alias("c"))
    chosen = run.scratch.keep("chosen", named.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k")).alias("w"))
                              .select(F.col("w.doc_id").alias("chosen_id"), F.col("w.k").alias("chosen_k")))
    key, empty = fresh("set_key", docs.columns), fresh("set_empty", docs.columns)

    def describe(text: pa.Array) -> list[pa.Array]:
        keys, none = [], []
        for b in flat.slices(pa.RecordBatch.from_arrays([text], names=["text"]), "text"):
            h, first = shingle_sets(flat.texts_of(b.column(0)), size)
            keys += _keys(h, first)
            none += (np.diff(first) == 0).tolist()
        return [pa.array(keys, pa.binary()), pa.array(none, pa.bool_())]

    marked = add_columns(docs, ["text"], describe, {key: "binary", empty: "boolean"})
    stay = marked.where(~F.col(empty)).join(chosen, (marked[key] == chosen["chosen_k"]) & marked["doc_id"].eqNullSafe(chosen["chosen_id"]), "left_semi")
    return stay.dropDuplicates(["doc_id", key]).unionByName(marked.where(empty)).select(*docs.columns)
