"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A bounded, balanced sample of labelled documents gives the examples.  Examples and
documents are vectors of all their terms: words, and beginnings of words.  The
weight of a term is its inverse document frequency among the examples times the
logarithm of how many times as often toxic examples hold it, at least ``NEUTRAL``: with
the bare frequencies the ordinary words of a text outweigh the few that make it toxic.
A term is never left out for being rare or neutral; a term that no example holds
meets none.  The examples are kept as posting lists cut into blocks,
with the greatest weight of each block; the terms of more than one example in ``COMMON``, whose lists have nothing to skip,
are rows of a matrix, and their part of the cosine with every example is one product for a chunk of documents.
No weight is negative, so the k-th of these parts is a floor of the k-th cosine, and the
blocks whose bound (greatest part and sum of block maxima) is below it are not read.  A text whose floor is
below ``WORTH`` of the norm of its listed terms, as that of most neutral texts is, has next to no such block: its lists are read whole
and no bound is summed.  The k nearest are exact either way.  Their votes,
weighted by cosine and by how often their kind occurs among all labels, and a prior vote are mapped to probabilities by isotonic regression
on a part of the sample that is not in the index.

Labels come only from rows that are not held out.  Every document is scored, whole, in
one pass without a shuffle; the model is bounded by ``SAMPLE`` and the lengths of the texts sampled.

Defined results: null and empty texts, and texts without a term, get the score of no
neighbours; a document with several labels is toxic if half of them or more say so;
null labels and labels of unknown documents are ignored; without labels of both kinds
every score is the share of toxic documents among the labelled (0 without labels); repeated
rows get rows of their own; other columns are ignored; an empty table has no row.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subrev.llm.common import by_batch, held_out

#: Labelled documents of each kind that are sampled at most.
SAMPLE = 2400
#: One in so many sampled documents calibrates the votes and is not in the index.
CALIBRATE = 4
#: What the weight of a term keeps of its idf if toxic examples hold it no more often than others.
NEUTRAL = 0.02
BEGINNINGS = (4, 5, 6)
K = 15
BLOCK = 32
#: A term that more than one example in so many holds is common.
COMMON = 24
#: The part of the norm of a text's listed terms that its floor reaches where blocks are worth their bounds.
WORTH = 0.1
#: Texts whose vectors and products are computed at once, and their letters (a longer text alone).
CHUNK = 256
CHUNK_CHARS = 4 << 20
#: Weight of the prior vote, in cosines.
PRIOR = 0.5
THRESHOLD = 0.7
REMEMBERED = 300_000
_WORD = re.compile(r"[^\W_]+")
#: Bytes of lower-cased texts; those of no word and no character beyond ASCII are blanks.
_SPACED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms_of(word: str) -> list[str]:
    """The word and its beginnings; a beginning ends with ``*``."""
    return [word, *(word[:m] + "*" for m in BEGINNINGS if len(word) > m)]


def term_counts(text: str) -> Counter:
    out: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for t in terms_of(word):
            out[t] += n
    return out


def ranges(starts: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All of ``starts[i]`` to ``starts[i + 1]`` (exclusive), one i of ``of`` after the other, and how many each has."""
    n = starts[of + 1] - starts[of]
    return np.arange(n.sum()) + np.repeat(starts[of] - np.cumsum(n) + n, n), n


def pieces_of(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII: one word each, but several or none where there are such characters."""
    return text.lower().encode().translate(_SPACED).split()


def chunks(texts: list[str]) -> Iterator[list[str]]:
    lot: list[str] = []
    size = 0
    for text in texts:
        if lot and (len(lot) == CHUNK or size + len(text) > CHUNK_CHARS):
            yield lot
            lot, size = [], 0
        lot.append(text)
        size += len(text)
    if lot:
        yield lot


class Words(dict):
    """Pieces met so far by number; ``terms[first[i]:first[i + 1]]`` are those of piece i that examples hold."""

    def __init__(self, term: dict[str, int]) -> None:
        super().__init__()
        self.term, self.first, self.terms = term, array("q", [0]), array("q")

    def __missing__(self, piece: bytes) -> int:
        self[piece] = n = len(self.first) - 1
        text = piece.decode()
        for word in [text] if text.isascii() else _WORD.findall(text):
            self.terms.extend([self.term[t] for t in terms_of(word) if t in self.term])
        self.first.append(len(self.terms))
        return n

    def make_room(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()
            self.first, self.terms = array("q", [0]), array("q")

    def __reduce__(self) -> tuple:
        return Words, (self.term,)


class Model:
    """Terms, examples as block-max posting lists, and the calibration."""

    def __init__(self, idf: dict[str, float], examples: list[tuple[int, int, dict[str, int] | Counts]], prior: float, base: float) -> None:
        """``examples``: (doc_id, toxic, term counts) in a fixed order; ``base`` is the toxic share among all labels."""
        self.term = {t: i for i, t in enumerate(sorted(idf))}
        self.idf = np.array([idf[t] for t in sorted(idf)])
        self.prior, self.words = prior, Words(self.term)
        kinds = Counter(toxic for _, toxic, _ in examples)
        #: what a vote of each kind counts: the sample is balanced, the labels are not
        self.weight = {1: base / max(kinds[1], 1), 0: (1 - base) / max(kinds[0], 1)}
        top = max(self.weight.values()) or 1.0
        self.weight = {k: w / top for k, w in self.weight.items()}
        vectors = [(doc, toxic, *self._weights(counts)) for doc, toxic, counts in examples]
        held = vectors[::CALIBRATE]
        indexed = [v for i, v in enumerate(vectors) if i % CALIBRATE and len(v[2])]
        # neighbours in a block should share terms, so that its maxima are close to its weights
        indexed.sort(key=lambda v: (v[2][v[3] == v[3].max()].max(), v[0]))
        self.doc = np.array([v[0] for v in indexed], np.int64)
        self.toxic = np.array([v[1] for v in indexed], float)
        self.blocks = -(-len(indexed) // BLOCK)
        self.block_at = np.arange(self.blocks) * BLOCK
        # postings by term and example
        term = np.concatenate([np.zeros(0, np.int64), *(v[2] for v in indexed)])
        x = np.concatenate([np.zeros(0), *(v[3] for v in indexed)])
        example = np.repeat(np.arange(len(indexed)), [len(v[2]) for v in indexed])
        # the driver holds one copy of the vectors from here on
        del vectors, indexed
        common = np.flatnonzero(np.bincount(term, minlength=len(self.idf)) * COMMON > len(self.doc))
        #: row of a common term in the matrix, else -1
        self.row = np.full(len(self.idf), -1, np.int64)
        self.row[common] = np.arange(len(common))
        self.common = np.zeros((len(common), len(self.doc)))
        listed = self.row[term] < 0
        self.common[self.row[term[~listed]], example[~listed]] = x[~listed]
        term, x, example = term[listed], x[listed], example[listed]
        by = np.lexsort((example, term))
        self.example, self.x = example[by].astype(np.int32), x[by]
        self.list_at = np.searchsorted(term[by], np.arange(len(self.idf) + 1))
        del term, x, example, listed, by
        self._cut()
        self.steps: list[tuple[float, float]] = []
        votes = []
        for at in range(0, len(held), CHUNK):
            lot = held[at: at + CHUNK]
            first = np.cumsum([0, *(len(v[2]) for v in lot)])
            near = self._near(first, np.concatenate([v[2] for v in lot]), np.concatenate([v[3] for v in lot]))
            votes += [(self._vote((sims, self.toxic[found])), v[1]) for v, (found, sims) in zip(lot, near)]
        share = {k: sum(1 for _, y in votes if y == k) for k in (0, 1)}
        weight = {1: base / max(share[1], 1), 0: (1 - base) / max(share[0], 1)}
        self.steps = isotonic([(v, y, weight[y]) for v, y in votes])

    def _cut(self) -> None:
        """The lists cut into blocks: the postings of a term in a block are a group, which has the greatest of their weights."""
        blocks = max(self.blocks, 1)
        key = np.repeat(np.arange(len(self.idf)), np.diff(self.list_at)) * blocks + self.example // BLOCK
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.posting_at = np.append(first, len(key))
        self.block = (key[first] % blocks).astype(np.int32)
        self.most = np.maximum.reduceat(self.x, first) if len(first) else np.zeros(0)
        self.group_at = np.searchsorted(key[first] // blocks, np.arange(len(self.idf) + 1))

    def __getstate__(self) -> dict:
        """What is broadcast: the matrix by its weights above 0, and no groups, which follow from the lists."""
        row, example = np.nonzero(self.common)
        common = (self.common.shape, row.astype(np.int32), example.astype(np.int32), self.common[row, example])
        rest = {k: v for k, v in self.__dict__.items() if k not in ("posting_at", "block", "most", "group_at")}
        return rest | {"common": common}

    def __setstate__(self, state: dict) -> None:
        shape, row, example, x = state.pop("common")
        self.__dict__.update(state, common=np.zeros(shape))
        self.common[row, example] = x
        self._cut()

    def _weights(self, counts: dict[str, int] | Counts) -> tuple[np.ndarray, np.ndarray]:
        mine = [(self.term[t], n) for t, n in counts.items() if t in self.term]
        terms = np.array([t for t, _ in mine], np.int64)
        raw = (1 + np.log(np.array([n for _, n in mine], float))) * self.idf[terms]
        norm = math.sqrt((raw * raw).sum())
        return terms, raw / norm if norm else raw

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, terms, weights): those of text i are ``first[i]`` to ``first[i + 1]`` (exclusive)."""
        self.words.make_room()
        pieces = [pieces_of(t) for t in texts]
        each = np.array([len(p) for p in pieces], np.int64)
        piece = np.fromiter(map(self.words.__getitem__, chain.from_iterable(pieces)), np.int64, each.sum())
        # how often each text holds each piece, then the terms of these, added up by text and term
        key = np.sort(np.repeat(np.arange(len(texts)) << 32, each) | piece)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n, key = np.diff(first, append=len(key)), key[first]
        rows, each = ranges(np.frombuffer(self.words.first, np.int64), key & 0xFFFFFFFF)
        key, n = np.repeat(key >> 32 << 32, each) | np.frombuffer(self.words.terms, np.int64)[rows], np.repeat(n, each)
        by = np.argsort(key)
        key = key[by]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.add.reduceat(n[by], first) if len(first) else n
        doc, terms = key[first] >> 32, key[first] & 0xFFFFFFFF
        raw = (1 + np.log(n)) * self.idf[terms]
        norm = np.sqrt(np.bincount(doc, raw * raw, len(texts)))[doc]
        return np.searchsorted(doc, np.arange(len(texts) + 1)), terms, np.divide(raw, norm, out=np.zeros(len(raw)), where=norm > 0)

    def _near(self, first: np.ndarray, terms: np.ndarray, x: np.ndarray, k: int = K) -> list[tuple[np.ndarray, np.ndarray]]:
        """(examples, cosines) of the k nearest with a cosine above 0, for each vector; of equal cosines the first in the index."""
        texts, n = len(first) - 1, len(self.doc)
        if not n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * texts
        row = self.row[terms]
        held = row >= 0
        of = np.repeat(np.arange(texts), np.diff(first))
        query = np.zeros((texts, len(self.common)))
        query[of[held], row[held]] = x[held]
        parts, out = query @ self.common, []
        of, terms, x = of[~held], terms[~held], x[~held]
        worth = WORTH * np.sqrt(np.bincount(of, x * x, texts))
        first = np.searchsorted(of, np.arange(texts + 1)).tolist()
        for part, a, z, least in zip(parts, first, first[1:], worth.tolist()):
            floor = np.partition(part, n - k)[n - k] if z > a and n >= k and part.max() >= least else -1.0
            rows, weight = self._rows(terms[a:z], x[a:z], part, floor) if floor >= least else self._lists(terms[a:z], x[a:z])
            score = part + np.bincount(self.example[rows], weight * self.x[rows], n)
            least = np.partition(score, n - k)[n - k] - 2e-9 if n >= k else 0.0
            found = np.flatnonzero((score >= least) & (score > 0))
            found = found[np.lexsort((found, -np.round(score[found], 9)))[:k]]
            out.append((found, score[found]))
        return out

    def _lists(self, terms: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(posting, weight of its term in the text) of all postings of the listed ``terms``."""
        rows, each = ranges(self.list_at, terms)
        return rows, np.repeat(x, each)

    def _rows(self, terms: np.ndarray, x: np.ndarray, part: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Those of the postings in blocks whose bound reaches ``floor``."""
        groups, each = ranges(self.group_at, terms)
        weight, block = np.repeat(x, each), self.block[groups]
        bound = np.maximum.reduceat(part, self.block_at) + np.bincount(block, weight * self.most[groups], self.blocks)
        mine = (bound >= floor - 1e-8)[block]
        rows, each = ranges(self.posting_at, groups[mine])
        return rows, np.repeat(weight[mine], each)

    def vector(self, text: str) -> dict[int, float]:
        _, terms, x = self.vectors([text])
        return dict(zip(terms.tolist(), x.tolist()))

    def nearest(self, query: dict[int, float], k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(example, cosine, toxic) of the k nearest of one vector."""
        ((found, sims),) = self._near(np.array([0, len(query)]), np.array(list(query), np.int64), np.array(list(query.values()), float), k)
        return found, sims, self.toxic[found]

    def _vote(self, near: tuple[np.ndarray, np.ndarray]) -> float:
        sims, toxic = near
        yes, no = self.weight[1] * (sims * toxic).sum(), self.weight[0] * (sims * (1 - toxic)).sum()
        if not yes + no:
            return self.prior
        return float((yes + PRIOR * self.weight[1] * self.prior) / (yes + no + PRIOR * self.weight[1]))

    def scores(self, texts: list[str]) -> list[tuple[float, list[int]]]:
        """Probability and the ids of the nearest examples, of each text."""
        out = []
        for lot in chunks(texts):
            for found, sims in self._near(*self.vectors(lot)):
                out.append((apply_steps(self.steps, self._vote((sims, self.toxic[found]))), self.doc[found].tolist()))
        return out


def isotonic(points: list[tuple[float, int, float]]) -> list[tuple[float, float]]:
    """Non-decreasing steps (vote from which on, probability) by pooling adjacent violators of (vote, label, weight)."""
    pools: list[list[float]] = []  # weight, weighted labels, first vote
    for vote, y, w in sorted(points):
        if pools and pools[-1][2] == vote:
            pools[-1][0] += w
            pools[-1][1] += w * y
        else:
            pools.append([w, w * y, vote])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            w2, y2, _ = pools.pop()
            pools[-1][0] += w2
            pools[-1][1] += y2
    return [(first, y / w) for w, y, first in pools]


def apply_steps(steps: list[tuple[float, float]], vote: float) -> float:
    """Linear between the starts of steps, so that votes keep their order as far as the steps do."""
    if not steps:
        return vote
    at, value = zip(*steps)
    return float(np.interp(vote, at, value))


class Counts:
    """Term counts of one text as a string and an array, a tenth of what a dict takes on the driver."""

    __slots__ = ("terms", "n")

    def __init__(self, terms: str, n: bytes) -> None:
        self.terms, self.n = terms, n

    def keys(self) -> list[str]:
        return self.terms.split("\n") if self.terms else []

    def items(self) -> Iterator[tuple[str, int]]:
        return zip(self.keys(), np.frombuffer(self.n, np.int32).tolist())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, toxic, terms, n) with all terms of each text; no term holds a line end."""
    for b in batches:
        found = [term_counts(x or "") for x in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(["\n".join(f) for f in found], pa.string()),
                                          pa.array([np.fromiter(f.values(), np.int32, len(f)).tobytes() for f in found], pa.binary())],
                                         names=["doc_id", "toxic", "terms", "n"])


def term_weights(examples: list[tuple[int, int, dict[str, int] | Counts]]) -> dict[str, float]:
    """Weight of every term of the indexed examples: idf, times how far the term tells toxic examples from others.

    The latter is the logarithm of the ratio of the two shares of examples that hold the term, and ``NEUTRAL``
    at least, so that every term counts; the calibrating part has no say, its terms are weighed like those of any text.
    """
    kinds: Counter = Counter()
    held: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for i, (_, toxic, counts) in enumerate(examples):
        if i % CALIBRATE:
            kinds[toxic] += 1
            held[toxic].update(counts.keys())
    n = kinds[0] + kinds[1]
    out = {}
    for t in held[0].keys() | held[1].keys():
        yes, no = held[1][t], held[0][t]
        tells = math.log((yes + 0.5) / (kinds[1] + 1)) - math.log((no + 0.5) / (kinds[0] + 1))
        out[t] = (math.log((1 + n) / (1 + yes + no)) + 1) * max(tells + NEUTRAL, NEUTRAL)
    return out


def document_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): one row per document that exists, is not held out and has a label."""
    kinds = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    return kinds.join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")), "doc_id", "left_semi")


def labelled_sample(docs: DataFrame, kinds: DataFrame, found: dict[int, int], sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic): at most ``sample`` documents of each kind, those of the least hash of their id.

    ``found`` counts the documents of each kind.  Hashes beyond those that can be among the least are
    left out before the rows of a kind come together.
    """
    h = F.xxhash64("doc_id")
    least = F.lit(False)
    for kind, n in found.items():
        share = min(1.0, 2 * sample / max(n, 1) + 50 / max(n, 1))
        least = least | ((F.col("toxic") == kind) & (h <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else (1 << 63) - 1)))
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy(h, "doc_id"))
    chosen = kinds.where(least).withColumn("rank", rank).where(F.col("rank") <= sample).select("doc_id", "toxic")
    # at most twice ``sample`` rows of two numbers, so they are broadcast
    met = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    again = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), F.xxhash64("text")))
    return met.withColumn("again", again).where(F.col("again") <= sample).drop("again")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    kinds = document_labels(docs, labels)
    share = {r["toxic"]: r["count"] for r in kinds.groupBy("toxic").count().collect()}
    base = share.get(1, 0) / sum(share.values()) if share else 0.0
    rows = labelled_sample(docs, kinds, share).repartition(24, "doc_id").persist()
    try:
        found = rows.select("doc_id", "text", "toxic").mapInArrow(_counted, "doc_id bigint, toxic int, terms string, n binary")
        found = [(r["doc_id"], r["toxic"], Counts(r["terms"], bytes(r["n"]))) for r in found.toLocalIterator()]
    finally:
        rows.unpersist()
    if len({toxic for _, toxic, _ in found}) < 2:
        return Model({}, [], base, base)
    # an order by hash, so that the calibrating part is as mixed as the sample
    examples = sorted(found, key=lambda e: (e[0] * 2654435761 % (1 << 32), e[0], e[1]))
    return Model(term_weights(examples), examples, 0.0, base)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence): evidence holds the ids of the nearest examples, nearest first."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    ids = docs.select("doc_id").schema[0].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.scores([x or "" for x in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([f[0] for f in found], pa.float64()),
                                           pa.array([f[1] for f in found], pa.list_(pa.int64()))], names=["doc_id", "score", "evidence"])

    out = docs.select("doc_id", "text").mapInArrow(by_batch(work), f"doc_id {ids}, score double, evidence array<bigint>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "evidence")
