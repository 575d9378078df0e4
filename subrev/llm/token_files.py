"""Token ids in grammar-compressed shard files (Re-Pair).

Documents in ascending id are encoded whole, an end id after each, and the ids are
cut into shards of whole documents.  Within a shard frequent pairs of neighbouring
symbols are replaced by new symbols, round after round; a round replaces many pairs
at once whose occurrences cannot overlap (in a run of one symbol, every other pair).  A shard file holds the rules, the length
that each rule expands to, the remaining sequence and where each document starts, so
any range of ids is decoded from the symbols that cover it.

A shard file is the value of one row of a Parquet table in the shared folder, which
executors write and read through Spark wherever the folder is:

    magic "RPG1", then little-endian int64: first rule symbol, rules, symbols, documents, ids;
    uint32 left[rules], right[rules], expansion[rules], sequence[symbols]; int64 start[documents + 1]

Defined results: a null or empty text is the end id alone; rows of equal doc_id
follow each other, ordered by a hash of their texts; a null doc_id comes first;
other columns are ignored; an empty table writes no shard.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subrev.llm import flat
from subrev.llm.common import Scratch
from subrev.llm.prefix import _join, bucket_starts

END_ID = 2
#: Ids that a shard holds at least before it is closed.
SHARD_IDS = 1 << 18
ROUNDS = 8
PAIRS_PER_ROUND = 1024
MIN_COUNT = 8
TABLE_BITS = 16
#: A round that shortens the sequence by less than this share is the last.
LEAST_GAIN = 0.005
#: Runs whose ids a worker remembers before it forgets half of them, and runs that are encoded in one text.
REMEMBERED = 1_000_000
JOINED = 64
#: Bytes of text that are encoded at once.
SLICE_BYTES = 4 << 20
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b".,;:!?")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_HEAD = struct.Struct("<4s5q")
_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of whole texts from a tokenizer whose pieces never cross ASCII white space, drop it and fold ASCII case.

    The text is therefore the concatenation of its runs between white space, in lower case; closing
    punctuation after an ASCII letter or digit is a piece of its own, so it is cut off.  The
    different runs of a batch are an Arrow dictionary of their bytes, and
    each is encoded once; runs met before are remembered, the least used are forgotten.
    A run of small Latin letters (ASCII, and the accented ones up to U+00FF) is one piece that the tokenizer's
    normalizer and splitter leave as it is, so its model alone encodes it, over the bytes in the alphabet of the model.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        (self.comma,) = self.tokenizer.encode(",", add_special_tokens=False).ids
        self.place: dict[bytes, int] = {}
        self.uses = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)  # ids of remembered run i: pool[first[i]: first[i + 1]]
        self.pool = np.zeros(0, np.uint32)

    def _ids_of(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of runs, many in one text with a comma between; those that hold one go alone."""
        small, comma = _kinds(runs)
        plain, mixed, alone = (np.flatnonzero(x).tolist() for x in (small, ~small & ~comma, comma))
        joined, found = plain + mixed, []
        for tokenizer, some, text in ((self.letters, plain, _byte_level), (self.tokenizer, mixed, bytes.decode)):
            texts = [text(b" , ".join([runs[i] for i in some[k: k + JOINED]]) + b" ,") for k in range(0, len(some), JOINED)]
            found += [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.uint32), *found])
        end = np.flatnonzero(ids == self.comma)
        counts = np.zeros(len(runs), np.int64)
        counts[joined] = np.diff(np.concatenate([[-1], end])) - 1
        apart = self.tokenizer.encode_batch_fast([runs[i].decode() for i in alone], add_special_tokens=False)
        counts[alone] = [len(e.ids) for e in apart]
        # runs encoded alone come last in the pool, so the order of the runs is restored by their places
        pool = np.concatenate([np.delete(ids, end), *[np.array(e.ids, np.uint32) for e in apart]])
        order = np.array(joined + alone, np.int64)
        start = np.zeros(len(runs), np.int64)
        start[order] = np.cumsum(counts[order]) - counts[order]
        return pool[_runs(start, counts)], counts

    def _forget(self) -> None:
        """Keep the half of the remembered runs that is used most."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: REMEMBERED // 2])
        new = np.full(len(self.uses), -1, np.int64)
        new[keep] = np.arange(len(keep))
        counts = np.diff(self.first)[keep]
        self.pool = self.pool[_runs(self.first[keep], counts)]
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.uses = self.uses[keep] // 2
        self.place = {r: int(new[i]) for r, i in self.place.items() if new[i] >= 0}

    def encode(self, texts: flat.Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        w = flat.runs(texts, flat.NOT_SPACE, _closing(texts))
        if not len(w.start):
            return np.zeros(0, np.uint32), np.zeros(texts.n, np.int64)
        ends = np.concatenate([[0], np.cumsum(w.end - w.start)])
        data = flat.LOWER[texts.data[flat.NOT_SPACE[texts.data]]]
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(w.start), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        of, different = found.indices.to_numpy(), flat.texts_of(found.dictionary)

        if len(self.uses) > REMEMBERED:
            self._forget()
        data, at = different.data.tobytes(), different.offsets.tolist()
        runs = [data[a:z] for a, z in zip(at, at[1:])]
        known = self.place
        entry = np.array([known.get(r, -1) for r in runs], np.int64)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            new = [runs[i] for i in missing.tolist()]
            ids, counts = self._ids_of(new)
            entry[missing] = len(self.uses) + np.arange(len(new))
            known.update(zip(new, entry[missing].tolist()))
            self.pool = np.concatenate([self.pool, ids])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        self.uses[entry] += np.bincount(of, minlength=len(entry))
        counts = np.diff(self.first)[entry][of]
        return self.pool[_runs(self.first[entry][of], counts)], np.bincount(w.doc, counts, texts.n).astype(np.int64)


def _kinds(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Which runs are of small Latin letters alone, and which hold a comma."""
    data = np.frombuffer(b"".join(runs), np.uint8)
    size = np.fromiter(map(len, runs), np.int64, len(runs))
    lead = data == 0xC3
    after = np.concatenate([[False], lead[:-1]])
    other = ~((data >= 0x61) & (data <= 0x7A) | lead | after & (data >= 0x9F) & (data != 0xB7))
    other[:-1] |= lead[:-1] & ((data[1:] < 0x9F) | (data[1:] == 0xB7))
    begin = np.cumsum(size) - size
    return ~np.logical_or.reduceat(other, begin), np.logical_or.reduceat(data == 0x2C, begin)


def _byte_level(data: bytes) -> str:
    """The bytes of small Latin letters as the characters that stand for them in a byte-level vocabulary."""
    return data.decode("latin-1").replace("\x9f", "\u0141").replace("\xa0", "\u0142").replace("\xad", "\u0143")


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places of consecutive entries: start[i], start[i] + 1, ... count[i] of them, for every i."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _closing(t: flat.Texts) -> np.ndarray:
    """Where closing punctuation begins that follows an ASCII letter or digit and ends its run."""
    n = len(t.data)
    mark = np.zeros(n + 1, bool)
    mark[:n] = _CLOSING[t.data]
    ends = np.ones(n + 1, bool)
    ends[:n] = flat.WHITE[t.data]
    ends[t.offsets] = True
    start = np.flatnonzero(mark[1:n] & ~mark[: n - 1] & _PLAIN[t.data[: n - 1]]) + 1
    edge = np.zeros(n + 1, bool)
    edge[t.offsets] = True
    start = start[~edge[start]]
    stop = np.flatnonzero(~mark | edge)  # first place after a run of marks, or a text's beginning
    after = stop[np.searchsorted(stop, start, "right")]
    return start[ends[after]]


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _often(code: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs that occur often, in order, and how often. Symbols of 16 bits are sorted as pairs of 32."""
    short = top <= 1 << 16
    s = np.sort(((code >> 16) | (code & 0xFFFF)).astype(np.uint32) if short else code)
    edge = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
    counts = np.diff(edge)
    often = counts >= MIN_COUNT
    pairs = s[edge[:-1][often]].astype(np.int64)
    return (pairs >> 16 << 32) | (pairs & 0xFFFF) if short else pairs, counts[often]


def _choose(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Frequent pairs of which none ends with a symbol that another begins with; a pair of one symbol shares it with no other."""
    order = np.lexsort((pairs, -counts))[: 4 * PAIRS_PER_ROUND]
    left, right, out = set(), set(), []
    for p in pairs[order].tolist():
        a, b = p >> 32, p & 0xFFFFFFFF
        if a not in right and b not in left and (a != b or a not in left):
            left.add(a)
            right.add(b)
            out.append(p)
            if len(out) == PAIRS_PER_ROUND:
                break
    return np.array(out, np.int64)


def _place(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def compress(ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(first rule symbol, rules as pairs, sequence)."""
    seq = ids.astype(np.int64)
    base = int(seq.max()) + 1 if len(seq) else 0
    rules: list[np.ndarray] = []
    top = base
    for _ in range(ROUNDS):
        if len(seq) < 2:
            break
        code = (seq[:-1] << 32) | seq[1:]
        pairs, counts = _often(code, top)
        chosen = _choose(pairs, counts) if len(pairs) else np.zeros(0, np.int64)
        if not len(chosen):
            break
        # a pair's place in a small table by a hash of it; of two pairs in one place the later waits for another round
        table = np.zeros(1 << TABLE_BITS, np.int64)
        table[_place(chosen)] = np.arange(len(chosen))
        at = table[_place(code)]
        hit = np.flatnonzero(chosen[at] == code)
        # in a run of one symbol the pairs overlap: every other one from the left is replaced
        follows = np.concatenate([[False], (hit[1:] == hit[:-1] + 1) & (code[hit[1:]] == code[hit[:-1]])])
        begin = np.flatnonzero(~follows)
        hit = hit[(np.arange(len(hit)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(hit)]])))) % 2 == 0]
        seq[hit] = top + at[hit]
        keep = np.ones(len(seq), bool)
        keep[hit + 1] = False
        before, seq = len(seq), seq[keep]
        rules.append(np.stack([chosen >> 32, chosen & 0xFFFFFFFF], axis=1))
        top += len(chosen)
        if before - len(seq) < LEAST_GAIN * before:
            break
    return base, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64), seq


def expansions(base: int, rules: np.ndarray) -> np.ndarray:
    length = np.ones(len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        length[i] = (length[a - base] if a >= base else 1) + (length[b - base] if b >= base else 1)
    return length


def pack(docs: list[np.ndarray]) -> bytes:
    start = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype("<i8")
    base, rules, seq = compress(np.concatenate(docs))
    head = _HEAD.pack(b"RPG1", base, len(rules), len(seq), len(docs), int(start[-1]))
    return b"".join([head, *(x.astype("<u4").tobytes() for x in (rules[:, 0], rules[:, 1], expansions(base, rules), seq)), start.tobytes()])


def symbols_in(data: bytes) -> int:
    return _HEAD.unpack_from(data)[3]


class Shard:
    """A shard file, read."""

    def __init__(self, data: bytes) -> None:
        magic, self.base, rules, symbols, docs, self.n_ids = _HEAD.unpack_from(data)
        if magic != b"RPG1":
            raise ValueError("not a shard file")
        at, parts = _HEAD.size, []
        for n in (rules, rules, rules, symbols):
            parts.append(np.frombuffer(data, "<u4", n, at).astype(np.int64))
            at += 4 * n
        self.left, self.right, self.expansion, self.seq = parts
        self.start = np.frombuffer(data, "<i8", docs + 1, at)
        self.at = np.concatenate([[0], np.cumsum(self._length(self.seq))])
        self._flat, self._span = self._flatten()

    def _length(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        new = symbols >= self.base
        out[new] = self.expansion[symbols[new] - self.base]
        return out

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` (exclusive), from the symbols that cover them alone."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first = int(np.searchsorted(self.at, start, "right")) - 1
        last = int(np.searchsorted(self.at, end, "left"))
        seq, skip = self.seq[first:last], start - self.at[first]
        return self._flat[_runs(*(x[seq] for x in self._span))][skip: skip + end - start]

    def _flatten(self) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """All ids below the first rule, then the ids of every rule one after the other; where each symbol's begin, and how many."""
        seq = np.arange(self.base, self.base + len(self.left))
        while (new := seq >= self.base).any():
            wide = np.repeat(seq, np.where(new, 2, 1))
            at = np.cumsum(np.where(new, 2, 1)) - np.where(new, 2, 1)
            wide[at[new]] = self.left[seq[new] - self.base]
            wide[at[new] + 1] = self.right[seq[new] - self.base]
            seq = wide
        plain = np.arange(self.base)
        count = np.concatenate([np.ones(self.base, np.int64), self.expansion])
        begin = np.concatenate([plain, self.base + np.cumsum(self.expansion) - self.expansion])
        return np.concatenate([plain, seq]).astype(np.uint32), (begin, count)

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.start[i]), int(self.start[i + 1]))


_FILES = "part int, file int, doc_ids array<bigint>, n_ids bigint, n_symbols bigint, data binary"


def write_files(docs: DataFrame, tokenizer: str, path: str, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` and write their shard files in ascending doc_id; ``part`` and ``file`` number them in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ids, kept, n, file = encoder(tokenizer), [], [], 0, 0
        end = np.array([END_ID], np.uint32)

        def full() -> pa.RecordBatch:
            data = pack(kept)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([file], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([n], pa.int64()),
                 pa.array([symbols_in(data)], pa.int64()), pa.array([data], pa.binary())], names=["part", "file", "doc_ids", "n_ids", "n_symbols", "data"])

        for batch in batches:
            for b in flat.slices(batch, "text", SLICE_BYTES):
                part = b.column("part")[0].as_py()
                encoded, counts = encode.encode(flat.texts_of(b.column("text")))
                for doc, found in zip(b.column("doc_id").to_pylist(), np.split(encoded, np.cumsum(counts)[:-1])):
                    ids.append(doc)
                    kept.append(np.concatenate([found, end]))
                    n += len(found) + 1
                    if n >= shard_ids:
                        yield full()
                        ids, kept, n, file = [], [], 0, file + 1
        if kept:
            yield full()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text", F.spark_partition_id().alias("part"))
    ordered.mapInArrow(run, _FILES).write.option("compression", "zstd").parquet(path)


def read_index(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                shard = Shard(r["data"])
                whole = shard.ids(0, shard.n_ids).astype("<u4")
                cut = [whole[a:z] for a, z in zip(shard.start[:-1], shard.start[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["before"] + shard.start[:-1], pa.int64()),
                     pa.array(np.diff(shard.start), pa.int64()), pa.array([zlib.crc32(c.tobytes()) for c in cut], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    starts = bucket_starts(files.groupBy("part").agg(F.sum("n_ids").alias("n")), [], "part", "n", "base")
    within = bucket_starts(files.select("part", "file", "n_ids"), ["part"], "file", "n_ids", "inside")
    at = _join(within, starts, ["part"], take="base").select("part", "file", (F.col("base") + F.col("inside")).alias("before"))
    rows = _join(files, at, ["part", "file"], take="before").select("doc_ids", "before", "data")
    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_index(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the shard files of ``docs`` to the shared folder and read every document back from them."""
    scratch = Scratch(docs.sparkSession, "tokens")
    write_files(docs, tokenizer, scratch.path("files"))
    return read_index(docs.sparkSession.read.schema(_FILES).parquet(scratch.path("files")))
