"""Rule bitmask ledger.

Every text is measured once and every rule is evaluated once; a row of the ledger
holds the measurements and one failure bit per rule.  A policy is a version name
and a set of bits, so another policy, or a policy without one rule, is a bitwise
test of stored masks and never reads a text again.

Defined results: null and empty texts have all measurements 0 and fail
``few_words``; repeated rows get one ledger row each; other columns are ignored;
an empty table gives an empty ledger.  Nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subrev.llm import flat
from subrev.llm.common import by_batch

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_stutters")
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_UPPER = np.isin(np.arange(256), range(0x41, 0x5B))
_LETTER = _UPPER | np.isin(np.arange(256), range(0x61, 0x7B))


def measure(t: flat.Texts) -> dict[str, np.ndarray]:
    """The measurements of every text.

    ``n_repeat_words`` counts the words inside any window of five words that occurs
    twice or more in the text.  ``n_letters`` and ``n_upper`` count ASCII letters.
    """
    w = flat.words(t)
    byte_doc = np.repeat(np.arange(t.n), np.diff(t.offsets))
    begins_char = ~flat.WHITE[t.data] & ((t.data & 0xC0) != 0x80)

    at, h = flat.windows(w, WINDOW)
    hit = at[flat.repeated(flat.in_doc(h, w.doc[at]))]
    edge = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0

    rows = flat.lines(t)
    marks = np.zeros(len(t.data) + 1, np.int64)
    marks[1:] = np.cumsum(~flat.WHITE[t.data])
    full = marks[rows.end] > marks[rows.start]
    line_doc, key = rows.doc[full], flat.in_doc(rows.hash[full], rows.doc[full])
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    _verify_lines(t, rows.start[full], rows.end[full], key, order, again)
    stutter = np.flatnonzero((w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])) + 1
    return {
        "n_words": np.diff(w.first), "word_chars": flat.per_doc(t, byte_doc[begins_char]),
        "n_symbols": flat.per_doc(t, byte_doc[_SYMBOL[t.data]]), "n_dup_lines": flat.per_doc(t, line_doc[again]),
        "n_repeat_words": flat.per_doc(t, w.doc[covered]), "n_lines": flat.per_doc(t, line_doc),
        "n_letters": flat.per_doc(t, byte_doc[_LETTER[t.data]]), "n_upper": flat.per_doc(t, byte_doc[_UPPER[t.data]]),
        "n_stutters": flat.per_doc(t, w.doc[stutter])}


def _verify_lines(t: flat.Texts, start: np.ndarray, end: np.ndarray, key: np.ndarray, order: np.ndarray, again: np.ndarray) -> None:
    """Compare each repeated line with the one of its hash before it; lines that differ are told apart by their bytes."""
    at = np.flatnonzero(again[order[1:]]) + 1
    a, b = order[at - 1], order[at]
    size = end[b] - start[b]
    same = end[a] - start[a] == size
    place = np.arange(size[same].sum()) - np.repeat(np.cumsum(size[same]) - size[same], size[same])
    differs = t.data[np.repeat(start[a[same]], size[same]) + place] != t.data[np.repeat(start[b[same]], size[same]) + place]
    bad = np.unique(np.concatenate([key[b[~same]], key[b[same][np.unique(np.repeat(np.arange(same.sum()), size[same])[differs])]]]))
    for k in bad.tolist():
        seen: set[bytes] = set()
        for i in np.flatnonzero(key == np.uint64(k)).tolist():
            line = t.data[start[i]: end[i]].tobytes()
            again[i] = line in seen
            seen.add(line)


RULE_NAMES = ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length", "upper_case", "stutter")


def rules() -> dict[str, Column]:
    """Name and failure condition of each rule; the position is the bit.  A ledger keeps its bits, so rules are only added at the end."""
    c = {m: F.col(m) for m in MEASURES}
    return dict(zip(RULE_NAMES, (
        c["n_words"] < 10,
        100 * c["n_repeat_words"] > 20 * c["n_words"],
        10 * c["n_symbols"] > c["n_words"],
        10 * c["n_dup_lines"] > 4 * c["n_lines"],
        (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 12 * c["n_words"]),
        (2 * c["n_upper"] > c["n_letters"]) & (c["n_letters"] > 0),
        10 * c["n_stutters"] > 3 * c["n_words"],
    ), strict=True))


#: Policy versions: the rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length", "upper_case", "stutter"),
}




def policy_mask(version: str) -> int:
    return sum(1 << RULE_NAMES.index(r) for r in POLICIES[version])


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements, failures): one row per document, bit i of ``failures`` is rule i."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [measure(flat.texts_of(b.column("text"))) for b in flat.slices(batch, "text")]
        columns = [np.concatenate([p[m] for p in parts]) if parts else np.zeros(0, np.int64) for m in MEASURES]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                                          names=["doc_id", *MEASURES])

    ids = docs.select("doc_id").schema[0].dataType.simpleString()
    measured = docs.select("doc_id", "text").mapInArrow(
        by_batch(work), f"doc_id {ids}, " + ", ".join(f"{m} bigint" for m in MEASURES))
    bits = [F.when(failed, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, failed in enumerate(rules().values())]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return measured.withColumn("failures", mask)


def passes(failures: Column, version: str) -> Column:
    return failures.bitwiseAND(F.lit(policy_mask(version)).cast("bigint")) == 0


def ablations(of: DataFrame) -> DataFrame:
    """(policy, rule, n_docs, n_rejected, n_failed, n_only): what each rule rejects, and what it alone rejects.

    The ledger is folded to one row per mask, at most two to the number of rules, before policies are applied.
    """
    masks = of.groupBy("failures").agg(F.count("*").alias("n"))
    cases = [F.struct(F.lit(v).alias("policy"), F.lit(policy_mask(v)).cast("bigint").alias("mask"), F.lit(r).alias("rule"),
                      F.lit(1 << RULE_NAMES.index(r)).cast("bigint").alias("bit")) for v, rs in POLICIES.items() for r in rs]
    each = masks.select("failures", "n", F.explode(F.array(*cases)).alias("c")).select("failures", "n", "c.*")
    failed = F.col("failures").bitwiseAND(F.col("mask"))
    count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    return each.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"), count(failed != 0).alias("n_rejected"),
        count(failed.bitwiseAND(F.col("bit")) != 0).alias("n_failed"), count(failed == F.col("bit")).alias("n_only"))


def rule_verdicts(docs: DataFrame, version: str = "v1") -> DataFrame:
    rows = ledger(docs)
    base_failed = ~passes(F.col("failures"), "base")
    return rows.select("doc_id", *MEASURES[:5], base_failed.alias("base_failed"),
                       (~base_failed & passes(F.col("failures"), version)).alias("kept"), "failures",
                       F.lit(version).alias("policy"))
