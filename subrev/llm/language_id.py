"""Language identification by cross-parsing entropy.

For each language a suffix automaton of its labelled text gives, from any point of
a document, the longest run of letters that also occurs in that text.  A document
is parsed greedily into such phrases; with c phrases against N labelled letters
it costs c * log2(N) bits, and the language with the fewest bits wins.  A letter that
the language lacks is a phrase that costs one bit more than one of the largest sample.

The automata are fitted on a bounded sample: at most ``SAMPLE_DOCS`` labelled rows
per language and ``SLICE`` characters of each, however many languages there are, and every
learnt letter has a symbol of its own.  Automata of few letters are unfolded to tables of at
most ``CELLS`` cells in all, the others are looked up by their edges; more than
``PART_EDGES`` edges are broadcast in parts, of which a worker holds one at a time.
Every text is parsed whole, in blocks of ``BLOCK`` letters whose ends also end a
phrase, so that a task walks thousands of blocks through the automata in one step.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or
when no language was learnt; equal bits go to the lesser language by code point;
repeated rows get one row each; other columns are never read.
"""

from __future__ import annotations

import copy
import itertools
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subrev.llm import flat
from subrev.llm.common import add_columns, held_out

SAMPLE_DOCS = 160
SLICE = 200
BLOCK = 256
UNLEARNT = 1  # the symbol of letters that no language has
CELLS = 32_000_000
PART_EDGES = 10_000_000
UNDEFINED = "und"


def automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return go


class Language:
    """One automaton as sorted edges over the symbols it has; unfolded to a table on first use if ``dense``."""

    def __init__(self, name: str, text: np.ndarray) -> None:
        self.name, self.bits, self.dense, self._steps = name, math.log2(max(len(text), 2)), False, None
        self.alphabet = np.unique(text)
        # own symbols: those of the alphabet, one for all others, one for the end of a block
        self.width = len(self.alphabet) + 2
        go = automaton(np.searchsorted(self.alphabet, text).tolist())
        self.states = len(go)
        edges = sorted((state * self.width + c, to * 4) for state, row in enumerate(go) for c, to in row.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.to = np.array([to for _, to in edges], np.int32)
        # next state * 4 + phrases that end, where a state has no edge: a symbol the language lacks is a phrase, too
        self.start = np.full(self.width, 2, np.int32)
        first = self.keys < self.width
        self.start[self.keys[first]] = self.to[first] + 1
        self.start[-1] = 1

    def own(self, n: int) -> np.ndarray:
        """Own symbol of each of ``n`` symbols, the last of which ends a block."""
        out = np.full(n, self.width - 2, np.int32)
        out[self.alphabet] = np.arange(len(self.alphabet))
        out[-1] = self.width - 1
        return out

    def steps(self) -> np.ndarray:
        """``steps[state * width + symbol]``: next state * 4 + phrases that end before or with the symbol."""
        if self._steps is None:
            steps = np.tile(self.start, self.states)
            steps[:self.width] -= 1  # at the root no phrase is open
            steps[self.keys] = self.to
            self._steps = steps
        return self._steps

    def phrases(self, grid: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each column of ``grid``, and how many of them are a symbol that the language lacks."""
        own, (state, out, lacks) = self.own(n), np.zeros((3, grid.shape[1]), np.int32)
        for row in grid:
            symbol = own[row]
            if self.dense:
                step = self.steps()[state * self.width + symbol]
            else:
                key = state.astype(np.int64) * self.width + symbol
                at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
                step = self.start[symbol] - (state == 0)
                if len(self.keys):
                    step = np.where(self.keys[at] == key, self.to[at], step)
            state = step >> 2
            out += step & 3
            lacks += symbol == self.width - 2
        return out, lacks

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_steps": None}


class Model:
    """The letters, and the languages in parts of bounded size."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.languages = sorted(samples)
        counts = Counter(c for parts in samples.values() for p in parts for c in p.lower() if c.isalpha())
        self.letters = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
        self._symbols = None
        symbols = self.symbols()
        self.pad = UNLEARNT + 1 + len(self.letters)
        self.parts: list[list[Language]] = [[]]
        for name in self.languages:
            text = np.concatenate([np.zeros(0, np.int32), *(_squeeze(symbols, [p])[0] for p in samples[name])])
            if sum(len(x.keys) for x in self.parts[-1]) > PART_EDGES:
                self.parts.append([])
            self.parts[-1].append(Language(name, text))
        #: what a symbol that a language lacks costs it, less one bit: no less than a phrase in any other, or a label of a few letters would explain all texts
        self.most_bits = max((x.bits for p in self.parts for x in p), default=0.0)
        left = CELLS if len(self.parts) == 1 else 0
        for x in self.parts[0]:
            x.dense = x.states * x.width <= left
            left -= x.states * x.width * x.dense

    def symbols(self) -> np.ndarray:
        """Symbol of every code point: 0 for what is no letter."""
        if self._symbols is None:
            of = {c: UNLEARNT + 1 + i for i, c in enumerate(self.letters)}
            out = np.zeros(0x110000, np.int32)
            for cp in range(0x110000):
                c = chr(cp)
                if c.isalpha():
                    out[cp] = of.get(c.lower()[0], UNLEARNT)
            self._symbols = out
        return self._symbols

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_symbols": None}

    def predict(self, texts: list[str], parts: Iterable[list[Language]] | None = None) -> tuple[list[str], list[float]]:
        """``parts`` in the place of the model's own, in the same order."""
        if not self.languages:
            return [UNDEFINED] * len(texts), [0.0] * len(texts)
        s, first, letters = _squeeze(self.symbols(), texts)
        n = np.diff(first)
        blocks = -(-n // BLOCK)
        at = np.concatenate([[0], np.cumsum(blocks)])
        grid = np.full((BLOCK + 1, at[-1]), self.pad, np.int32)
        place = np.arange(len(s)) - np.repeat(first[:-1], n)
        grid[place % BLOCK, np.repeat(at[:-1], n) + place // BLOCK] = s
        doc = np.repeat(np.arange(len(texts)), blocks)
        bits = []
        for x in itertools.chain.from_iterable(self.parts if parts is None else parts):
            phrases, lacks = x.phrases(grid, self.pad + 1)
            bits.append(np.bincount(doc, x.bits * (phrases - lacks) + (self.most_bits + 1) * lacks, minlength=len(texts)))
        bits = np.array(bits)
        best = bits.argmin(axis=0)
        score = 1 / np.exp2((bits.min(axis=0) - bits) / 4).sum(axis=0)
        lang = [self.languages[i] if k else UNDEFINED for i, k in zip(best, letters)]
        return lang, [float(x) if k else 0.0 for x, k in zip(score, letters)]


def _squeeze(symbols: np.ndarray, texts: list[str]):
    """Symbols of all texts with runs of other characters as one 0, where each text begins, and its letters."""
    length = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    s = symbols[points]
    starts = np.concatenate([[0], np.cumsum(length)])
    keep = s != 0
    gap = np.ones(len(s), bool)
    gap[1:] = keep[:-1]
    gap[starts[:-1][length > 0]] = False
    take = keep | gap
    upto = np.concatenate([[0], np.cumsum(take)])
    have = np.concatenate([[0], np.cumsum(keep)])
    return s[take], upto[starts], np.diff(have[starts])


def fit(docs: DataFrame) -> Model:
    """Automata from rows with a language whose id is not held out; the sample is chosen by a hash of the id."""
    known = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    h = F.xxhash64("doc_id", "text")
    start = F.pmod(h, F.greatest(F.length("text") - SLICE, F.lit(1))).cast("int") + 1
    parts = known.select("lang", h.alias("h"), F.substring("text", start, F.lit(SLICE)).alias("part"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "part"))
    rows = parts.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_DOCS).select("lang", "rank", "part")
    samples: dict[str, list[tuple[int, str]]] = {}
    for r in rows.toLocalIterator():
        samples.setdefault(r["lang"], []).append((r["rank"], r["part"]))
    return Model({lang: [p for _, p in sorted(parts)] for lang, parts in samples.items()})


def identify(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score (columns of these names are replaced)."""
    context = docs.sparkSession.sparkContext
    parts = [context.broadcast(p) for p in model.parts]
    head = copy.copy(model)
    head.parts = []
    shared = context.broadcast(head)

    def one_by_one() -> Iterator[list[Language]]:
        for p in parts:
            yield p.value
            if len(parts) > 1:
                del p._value  # read again from the worker's disk for the next batch

    def work(text: pa.Array) -> list[pa.Array]:
        of, scores = [], []
        for b in flat.slices(pa.RecordBatch.from_arrays([text], names=["text"]), "text"):
            a, z = shared.value.predict(pc.fill_null(b.column(0), "").to_pylist(), one_by_one())
            of += a
            scores += z
        return [pa.array(of, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(docs, ["text"], work, {lang: "string", score: "double"})


def predictions(docs: DataFrame) -> DataFrame:
    out = identify(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
