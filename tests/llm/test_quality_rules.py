from collections import Counter

import pyarrow as pa
from helpers import docs, documents, nothing, rows_of, words
from pyspark.sql import functions as F

from subrev.llm import flat, quality_rules


def measured(text):
    w, t = words(text), text or ""
    runs = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if runs[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_measures_against_plain_python(docs):
    got = rows_of(docs.transform(quality_rules.ledger).select("doc_id", *quality_rules.MEASURES[:5]))
    assert got == Counter((d, *measured(t)) for d, t, *_ in documents())


def test_base_and_kept(docs):
    for r in quality_rules.rule_verdicts(docs).collect():
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
        assert r["kept"] == (r["failures"] == 0)


def test_policies_are_bitwise_tests_and_ablations_follow(docs):
    rows = [r["failures"] for r in quality_rules.ledger(docs).collect()]
    names = quality_rules.RULE_NAMES
    for r in quality_rules.ablations(quality_rules.ledger(docs)).collect():
        mask, bit = quality_rules.policy_mask(r["policy"]), 1 << names.index(r["rule"])
        assert r["n_docs"] == len(rows)
        assert r["n_rejected"] == sum(x & mask != 0 for x in rows)
        assert r["n_failed"] == sum(x & bit != 0 for x in rows)
        assert r["n_only"] == sum(x & mask == bit for x in rows)


def test_empty_table_and_clashing_columns(docs, nothing):
    assert quality_rules.rule_verdicts(nothing).count() == 0
    clash = docs.withColumn("n_words", F.lit("x")).withColumn("failures", F.lit(1)).withColumn("kept", F.lit(None))
    assert rows_of(quality_rules.rule_verdicts(clash)) == rows_of(quality_rules.rule_verdicts(docs))


A, B = ("abcdefgh" * 8, "hgfedcba" * 8)


def test_long_lines_and_words_of_the_same_blocks(spark):
    """64-byte blocks in another order are another line."""
    text = f"{A}{B}{B}{A}\n{B}{A}{A}{B}\n{A}{A}{B}{B}\n{A}{B}{B}{A}"
    row = quality_rules.rule_verdicts(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row["n_dup_lines"] == 1


def test_lines_behind_equal_hashes_are_compared(spark, monkeypatch):
    real = flat.lines

    def blind(t):
        rows = real(t)
        rows.hash[:] = 5
        return rows

    monkeypatch.setattr(quality_rules.flat, "lines", blind)
    t = flat.texts_of(pa.array(["one x\ntwo y\none x\none x\nthree", "one x\n \nfour", None]))
    assert quality_rules.measure(t)["n_dup_lines"].tolist() == [2, 0, 0]
