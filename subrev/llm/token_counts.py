"""Token counts of sections by offset mapping.

A document is encoded once and whole; the bytes of its tokens, one after the other,
are the bytes of its text, so running sums of token lengths are the token spans.
The spans are joined to the sections (lines, with their line feed) by a sorted
interval merge.  A token that crosses a boundary goes to one section by a rule:
``most`` (the section with most of its bytes, the earlier of equals), ``first`` or
``last`` (the section of its first or last byte).  Section counts therefore add up
to the count of the whole document.

Defined results: a null or empty text is one empty section; a text that ends with a
line feed has no section after it; repeated rows get rows of their own; other columns
are ignored; an empty table has no row.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from subrev.llm import flat

RULES = ("most", "first", "last")
_ENCODERS: dict[tuple[str, str], tuple[object, np.ndarray]] = {}


def encoder(ranks_path: str, pattern: str) -> tuple[object, np.ndarray]:
    """The byte-level encoder of a rank file and the bytes of each of its tokens; one per worker."""
    import tiktoken

    key = (ranks_path, pattern)
    if key not in _ENCODERS:
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            length[rank] = len(token)
        _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), length
    return _ENCODERS[key]


def section_of(start: np.ndarray, end: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section, crosses) of each token span; sections are the gaps of ``bounds``, from 0 to the text's length."""
    first = np.searchsorted(bounds, start, "right") - 1
    last = np.searchsorted(bounds, end - 1, "right") - 1
    if rule == "first":
        return first, first != last
    if rule == "last":
        return last, first != last
    out = first.copy()
    for i in np.flatnonzero(first != last):
        cuts = np.concatenate([[start[i]], bounds[first[i] + 1: last[i] + 1], [end[i]]])
        out[i] = first[i] + int(np.diff(cuts).argmax())
    return out, first != last


def section_tokens(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "most") -> DataFrame:
    """(doc_id, section, start_char, n_chars, n_tokens, n_crossing): a row for each section of each document.

    ``n_crossing`` counts the section's tokens that also have bytes of another section.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def sections(b: pa.RecordBatch) -> pa.RecordBatch:
        encode, length = encoder(ranks_path, pattern)
        t = flat.texts_of(b.column("text"))
        rows: list[list[np.ndarray]] = [[] for _ in range(6)]
        for i, text in enumerate(b.column("text").to_pylist()):
            data = t.data[t.offsets[i]: t.offsets[i + 1]]
            cuts = np.flatnonzero(data == 0x0A) + 1
            bounds = np.concatenate([[0], cuts[cuts < len(data)], [len(data)]])
            n = len(bounds) - 1
            ids = encode.encode_to_numpy(text or "", allowed_special=set(), disallowed_special=()).astype(np.int64)
            end = np.cumsum(length[ids])
            section, crosses = section_of(end - length[ids], end, bounds[:-1], rule)
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
            for out, values in zip(rows, (np.full(n, i), np.arange(n), chars[:-1], np.diff(chars), np.bincount(section, minlength=n),
                                          np.bincount(section[crosses], minlength=n))):
                out.append(values)
        doc, *counts = (pa.array(np.concatenate(c), pa.int64()) for c in rows)
        return pa.RecordBatch.from_arrays([b.column("doc_id").take(doc), *counts],
                                          names=["doc_id", "section", "start_char", "n_chars", "n_tokens", "n_crossing"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in flat.slices(batch, "text"):
                yield sections(b)

    ids = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {ids}, section bigint, start_char bigint, n_chars bigint, n_tokens bigint, n_crossing bigint")
