import hashlib
from collections import Counter

from helpers import ALNUM, DOCS, LOWER, docs, documents, nothing, rows_of
from pyspark.sql import functions as F

from subrev.llm import decontaminate


def folded(text):
    return ALNUM.findall((text or "").translate(LOWER))


def items_table(spark):
    base = folded(documents()[100][1])
    rows = [(1, " ".join(base[20:60])), (2, "A"), (3, None), (4, "..."), (None, "a1"), (5, " ".join(base[50:58])), (5, "x y-z"), (6, " ".join(base[:13])), (6, " ".join(base[:13]))]
    return rows, spark.createDataFrame(rows, "item_id bigint, text string")


def expected(items):
    windows = {}
    for item, text in items:
        w = folded(text)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if m and item is not None else 0):
            windows.setdefault(tuple(w[i:i + m]), set()).add(str(item))
    out = Counter()
    for doc, text, *_ in documents():
        w, hit, found = folded(text), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in windows:
                    hit |= set(range(i, i + m))
                    found |= windows[tuple(w[i:i + m])]
        out[doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
            bool(hit) and 20 * len(hit) >= len(w)] += 1
    return out


def test_contamination_against_plain_python(spark, docs):
    rows, items = items_table(spark)
    want = expected(rows)
    assert sum(k[-1] * v for k, v in want.items()) > 30
    assert rows_of(decontaminate.contamination(docs, items)) == want


def test_parts_of_the_window_set_give_the_same(spark, docs):
    _, items = items_table(spark)
    whole = decontaminate.scan(docs.select("doc_id", "text"), items)
    parts = decontaminate.scan(docs.select("doc_id", "text"), items, part_windows=6)
    pick = lambda df: rows_of(df.select("doc_id", "n_words", F.col("spans").cast("string"), F.concat_ws(",", "items")))
    assert pick(whole) == pick(parts)


def test_removal_of_documents_and_spans(spark, docs):
    rows, items = items_table(spark)
    clash = docs.withColumn("items", F.lit("own")).withColumn("spans", F.lit(1))
    kept = decontaminate.remove_contaminated(clash, items)
    assert kept.columns == clash.columns and {r["items"] for r in kept.collect()} == {"own"}
    assert kept.count() == sum(v for k, v in expected(rows).items() if not k[-1])
    clean = decontaminate.remove_spans(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert {r["text"] is None for r in clean.where("doc_id = 0").collect()} == {True}
    one = spark.createDataFrame([(1, "Say: A1 b2, c3! End", "en", "s", 1)], DOCS)
    short = spark.createDataFrame([(1, "a1 B2 c3")], "item_id bigint, text string")
    assert decontaminate.remove_spans(one, short).first()["text"] == "Say: ! End"


def test_empty_tables(docs, nothing, spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination(nothing, none).count() == 0
    assert {r["n_hit"] for r in decontaminate.contamination(docs, none).collect()} == {0}
