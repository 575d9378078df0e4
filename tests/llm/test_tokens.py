import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import ODD, docs, documents, nothing, prose
from pyspark.sql import functions as F

from subrev.llm import flat, token_counts, token_files

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
MORE = ["", "Σίσυφος ΟΔΟΣ ς", "é ́x", "a b c\u0085d\x1ce", "don't 's 't\n're", "<|startoftext|>x<|endoftext|> y", "ǅİ İ", "x" * 3000]


@pytest.mark.parametrize("remembered", [600_000, 40])
def test_run_by_run_encoding_equals_whole_texts(monkeypatch, remembered):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "REMEMBERED", remembered)
    whole, fast = Tokenizer.from_file(WORDS), token_files.WordEncoder(WORDS)
    rng = random.Random(3)
    alphabet = "aAbZ9 '.\n\té́ß Σ<|>漢\U0001f600"
    closing = ["x.. y,z, ,a, b.,c .d e.\u0338 f!\u0301 E\u0301. \u03a3. ok.) (ok). 5. 5.5, ; end.", ",", ", ,,", "a." * 500, "A,B. c!?"]
    texts = [t or "" for t in [*ODD, *MORE, *closing]] + ["".join(rng.choice(alphabet + ",!") for _ in range(60)) for _ in range(300)]
    for k in range(0, len(texts), 50):
        part = texts[k: k + 50]
        ids, counts = fast.encode(flat.texts_of(pa.array(part)))
        for t, found in zip(part, np.split(ids, np.cumsum(counts)[:-1])):
            assert found.tolist() == whole.encode(t, add_special_tokens=False).ids, t
    assert len(fast.place) == len(fast.uses) == len(fast.first) - 1


def test_runs_behind_equal_hashes_are_compared(monkeypatch):
    real = flat.runs

    def blind(*args):
        w = real(*args)
        w.hash[:] = 7
        return w

    texts = pa.array(["one two three one", "TWO two. 3", None])
    fast = token_files.WordEncoder(WORDS)
    want = fast.encode(flat.texts_of(texts))
    monkeypatch.setattr(token_files.flat, "runs", blind)
    got = token_files.WordEncoder(WORDS).encode(flat.texts_of(texts))
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_a_run_of_one_id_is_compressed():
    ids = np.full(100_000, 9, np.uint32)
    base, rules, seq = token_files.compress(ids)
    assert len(rules) >= 8 and len(seq) < 500
    assert token_files.Shard(token_files.pack([ids, ids[:77]])).document(1).tolist() == [9] * 77


@pytest.mark.parametrize("n, symbols", [(0, 5), (1, 5), (5000, 3), (20_000, 50), (3000, 100_000)])
def test_shard_files_decode_any_range(n, symbols):
    rng = np.random.default_rng(n)
    docs = [np.append(rng.integers(0, symbols, k), 2).astype(np.uint32) for k in rng.multinomial(n, [0.2] * 5)]
    shard = token_files.Shard(token_files.pack(docs))
    ids = np.concatenate(docs)
    assert shard.ids(0, len(ids)).tolist() == ids.tolist()
    for i, d in enumerate(docs):
        assert shard.document(i).tolist() == d.tolist()
    for a, z in rng.integers(0, len(ids) + 1, (50, 2)):
        assert shard.ids(a, z).tolist() == ids[a:z].tolist()


def test_repeats_become_rules():
    ids = np.tile(np.array([5, 6, 7, 8, 9], np.uint32), 4000)
    base, rules, seq = token_files.compress(ids)
    assert len(seq) < len(ids) / 4 and len(rules) >= 3
    assert token_files.expansions(base, rules).max() >= 5


def test_index_read_back(spark, docs, monkeypatch, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    clash = docs.withColumn("part", F.lit("own")).withColumn("start", F.lit(1))
    token_files.write_files(clash, WORDS, str(tmp_path / "f"), shard_ids=500)
    files = spark.read.parquet(str(tmp_path / "f"))
    assert files.count() > 10
    rows = token_files.read_index(files).collect()
    at, want = 0, Counter()
    by = {}
    for d, t, *_ in documents():
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        by.setdefault(d, []).append((len(ids), zlib.crc32(ids.tobytes())))
    starts = sorted(rows, key=lambda r: r["start"])
    order = [r["doc_id"] for r in starts]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    for r in starts:
        assert r["start"] == at
        at += r["n_tokens"]
        want[r["doc_id"], r["n_tokens"], r["ids_crc32"]] += 1
    assert want == Counter((d, *x) for d, xs in by.items() for x in xs)


def test_empty_tables(nothing):
    assert token_files.token_index(nothing, WORDS).count() == 0
    assert token_counts.section_tokens(nothing, RANKS, PATTERN).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_section_counts(docs, rule):
    encode, _ = token_counts.encoder(RANKS, PATTERN)
    rows = token_counts.section_tokens(docs.withColumn("section", F.lit("own")), RANKS, PATTERN, rule).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    seen = Counter(d for d, *_ in documents())
    for d, t, *_ in documents():
        lines = (t or "").split("\n")
        sections = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] or len(lines) == 1 else [])
        mine = sorted(by[d], key=lambda r: r["section"])
        assert len(mine) == len(sections) * seen[d]
        assert [r["n_chars"] for r in mine[::seen[d]]] == [len(s) for s in sections]
        assert sum(r["n_tokens"] for r in mine) == seen[d] * len(encode.encode_ordinary(t or ""))


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_section_counts_against_bytes(docs, rule):
    """Every token's bytes one by one: the section of the first, of the last, or of most of them."""
    encode, _ = token_counts.encoder(RANKS, PATTERN)
    want = Counter()
    for d, t, *_ in documents():
        data, line, of = (t or "").encode(), 0, []
        for c in data:
            of.append(line)
            line += c == 0x0A
        n = max(of, default=0) + 1
        counts, crossing, at = [0] * n, [0] * n, 0
        for token in encode.encode_ordinary(t or ""):
            size = len(encode.decode_single_token_bytes(token))
            mine, at = of[at: at + size], at + size
            hits = Counter(mine)
            s = {"first": mine[0], "last": mine[-1], "most": min(hits, key=lambda x: (-hits[x], x))}[rule]
            counts[s] += 1
            crossing[s] += len(hits) > 1
        want.update((d, s, counts[s], crossing[s]) for s in range(n))
    got = token_counts.section_tokens(docs, RANKS, PATTERN, rule).select("doc_id", "section", "n_tokens", "n_crossing").collect()
    assert Counter(map(tuple, got)) == want


def test_tokens_that_cross_a_boundary():
    start, end, bounds = np.array([0, 2, 6]), np.array([2, 6, 9]), np.array([0, 3, 5])
    assert token_counts.section_of(start, end, bounds, "first")[0].tolist() == [0, 0, 2]
    assert token_counts.section_of(start, end, bounds, "last")[0].tolist() == [0, 2, 2]
    assert token_counts.section_of(start, end, bounds, "most")[0].tolist() == [0, 1, 2]
    assert token_counts.section_of(start, end, bounds, "most")[1].tolist() == [False, True, False]
    assert token_counts.section_of(np.array([0]), np.array([4]), np.array([0, 2]), "most")[0].tolist() == [0]


def test_long_texts(spark):
    rng = random.Random(1)
    texts = ["x" * 200_000, " " * 200_000, "\n" * 50_000, prose(rng, 40_000), "é" * 100_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = token_counts.section_tokens(rows, RANKS, PATTERN).groupBy("doc_id").agg(F.sum("n_chars").alias("c")).collect()
    assert {r["doc_id"]: r["c"] for r in got} == {i: len(t) for i, t in enumerate(texts)}
    assert token_files.token_index(rows, WORDS).count() == len(texts)


def test_letters_are_encoded_by_the_model_alone_and_as_the_whole_tokenizer_does():
    from tokenizers import Tokenizer

    encode = token_files.WordEncoder(WORDS)
    whole = Tokenizer.from_file(WORDS)
    texts = ["the the theaea s t re", "é éa naïve straße ÿ ß öäü", "a÷b ÷ Éa ÉÉ it's don't l'été", "é café K ſs ﬁ 1a a1 ,a a, a,b", "x" * 300 + " ä" * 50, "", None]
    asked = []

    class Seen:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return whole.encode_batch_fast(texts, **options)

    encode.tokenizer = Seen()
    ids, counts = encode.encode(flat.texts_of(pa.array(texts)))
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert asked and not any(f" {w} " in f" {t} " for t in asked for w in ("theaea", "éa", "straße", "öäü"))


def test_runs_are_told_apart_without_hashes(monkeypatch):
    from tokenizers import Tokenizer

    whole, texts = Tokenizer.from_file(WORDS), ["one two ONE, straße", None, "two! öäü one"]
    monkeypatch.setattr(flat, "mix", lambda h: pytest.fail("a hash"))
    ids, counts = token_files.WordEncoder(WORDS).encode(flat.texts_of(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_small_latin_letters_and_their_byte_level_characters():
    from tokenizers import pre_tokenizers

    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    runs = [chr(c) for c in range(0x21, 0x250) if chr(c).strip() and not 0x7F <= c < 0xA1] + ["aß", "÷a", "a÷", "ÿÿ", "éÉ", "ñ漢", "a,b"]
    small, comma = token_files._kinds([r.encode() for r in runs])
    for r, s, c in zip(runs, small, comma):
        assert s == all("a" <= x <= "z" or "ß" <= x <= "ÿ" and x != "÷" for x in r) and c == ("," in r), r
        if s:
            assert token_files._byte_level(r.encode()) == level.pre_tokenize_str(r)[0][0]


@pytest.mark.parametrize("symbols", [1 << 10, 1 << 20])
def test_pairs_are_counted_whatever_the_width_of_symbols(symbols):
    seq = np.random.default_rng(symbols).integers(symbols - 30, symbols, 20_000)
    want = {p: n for p, n in Counter(((seq[:-1] << 32) | seq[1:]).tolist()).items() if n >= token_files.MIN_COUNT}
    pairs, counts = token_files._often((seq[:-1] << 32) | seq[1:], symbols)
    assert dict(zip(pairs.tolist(), counts.tolist())) == want and pairs.tolist() == sorted(want)
