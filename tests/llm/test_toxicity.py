import math
import pickle
import random
import zlib

import numpy as np
import pytest
from helpers import DOCS, docs, documents, nothing
from pyspark.sql import functions as F

from subrev.llm import toxicity
from subrev.llm.common import held_out

LABELS = "doc_id bigint, quality int, toxic int"
INSULTS = ["fool", "clod", "lout", "oaf", "boor", "prat"]


def corpus(n=600, seed=4):
    """One document in five holds a few insults, or words that begin alike."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.choice([8, 40, 150]))]
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randint(2, 4) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice([*INSULTS, f"zarg{rng.randrange(1000)}"]))
        docs.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_nearest_examples_are_exact():
    rng = random.Random(9)
    terms = [f"t{i}" for i in range(40)]
    idf = {t: rng.uniform(1, 4) for t in terms}
    examples = [(i, rng.randrange(2), {t: rng.randint(1, 3) for t in rng.sample(terms, rng.randint(0, 6))}) for i in range(500)]
    model = toxicity.Model(idf, examples, 0.0, 0.3)

    def weights(counts):
        raw = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {t: x / norm for t, x in raw.items()}

    indexed = {i: weights(c) for k, (i, _, c) in enumerate(examples) if k % toxicity.CALIBRATE and c}
    for _ in range(100):
        text = " ".join(rng.choice(terms) for _ in range(rng.randint(1, 8)))
        q = weights({t: text.split().count(t) for t in set(text.split())})
        want = sorted((round(sum(x * w.get(t, 0) for t, x in q.items()), 9) for w in indexed.values()), reverse=True)
        found, sims, toxic = model.nearest(model.vector(text))
        np.testing.assert_allclose(sims, [x for x in want[:toxicity.K] if x > 0], atol=1e-8)
        assert len(set(found.tolist())) == len(found)


def test_rare_toxic_words_meet_their_example(spark):
    docs, labels = corpus()
    free = [i for i in range(10_000, 10_100)]
    known, asked = [i for i in free if zlib.crc32(str(i).encode()) % 3 != 1], [i for i in free if zlib.crc32(str(i).encode()) % 3 == 1]
    rare = [f"{x}bq" for x in "vxyz"]
    # each of these words is in two toxic examples only
    docs += [(i, f"w1 w2 {rare[j % 4]} w3", "en", "s", 1) for j, i in enumerate(known[:8])] + [(asked[0], f"w9 {rare[0]} w8", "en", "s", 1)]
    labels += [(i, 0, 1) for i in known[:8]]
    docs += [(i, "w4 w5 w6", "en", "s", 1) for i in known[8:10]] + [(asked[1], "w4 w5 w6", "en", "s", 1)]
    labels += [(i, 1, 0) for i in known[8:10]]
    rows = {r["doc_id"]: r for r in toxicity.scores(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert set(rows[asked[0]]["evidence"][:2]) & {known[0], known[4]}
    assert rows[asked[0]]["score"] > rows[asked[1]]["score"]
    assert len(rows[asked[1]]["evidence"]) == toxicity.K


def test_isotonic_steps():
    steps = toxicity.isotonic([(0.1, 0, 1), (0.2, 1, 1), (0.3, 0, 1), (0.4, 1, 1), (0.4, 1, 1)])
    assert steps == [(0.1, 0.0), (0.2, 0.5), (0.4, 1.0)]
    assert toxicity.apply_steps(steps, 0.3) == pytest.approx(0.75) and toxicity.apply_steps(steps, 9) == 1.0
    assert toxicity.apply_steps([], 0.4) == 0.4


def test_held_out_accuracy(tables):
    docs, labels = tables
    rows = toxicity.scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert len(rows) > 150 and right >= 0.95 * len(rows)
    toxic = [r for r in rows if r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert any(r["evidence"] for r in toxic)


def test_held_out_labels_are_never_used(tables):
    docs, labels = tables
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    pick = lambda df: sorted((r["doc_id"], r["score"]) for r in df.collect())
    assert pick(toxicity.scores(docs, labels)) == pick(toxicity.scores(docs, turned))


def test_odd_texts_labels_and_columns(spark, docs, nothing):
    one = spark.createDataFrame([(101, 1, 1), (101, 1, 0), (102, None, None), (None, 1, 1), (10**9, 0, 0)], LABELS)
    none = spark.createDataFrame([], LABELS)
    clash = docs.withColumn("score", F.lit("x")).withColumn("toxic", F.lit(1))
    for labels in (one, none):
        rows = toxicity.scores(clash, labels).collect()
        assert len(rows) == len(documents()) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.scores(nothing, one).count() == 0


def test_labels_of_unknown_documents_change_nothing(spark, tables):
    docs, labels = tables
    more = spark.range(10**9, 10**9 + 3000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(1).alias("toxic")).select(*labels.columns)
    twice = labels.unionByName(labels.where("toxic = 1")).unionByName(more)
    few = docs.orderBy("doc_id").limit(60)
    want = {r["doc_id"]: r["score"] for r in toxicity.scores(docs, labels).join(few.select("doc_id"), "doc_id", "left_semi").collect()}
    got = {r["doc_id"]: r["score"] for r in toxicity.scores(docs, twice).join(few.select("doc_id"), "doc_id", "left_semi").collect()}
    assert got == want


def test_sample_takes_the_least_hashes(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    kinds = toxicity.document_labels(docs, labels)
    share = {r["toxic"]: r["count"] for r in kinds.groupBy("toxic").count().collect()}
    got = {(r["doc_id"], r["toxic"]) for r in toxicity.labelled_sample(docs, kinds, share, 40).collect()}
    rows = sorted((r["h"], r["doc_id"], r["toxic"]) for r in kinds.withColumn("h", F.xxhash64("doc_id")).collect())
    assert got == {(d, k) for k in (0, 1) for _, d, x in [r for r in rows if r[2] == k][:40] if x == k} and len(got) == 80


def test_a_chunk_reads_each_list_part_once_for_many_texts():
    """Vectors and products are made for chunks of texts; common terms, rare ones and empty texts give what brute force does."""
    rng = random.Random(3)
    terms = [f"t{i}" for i in range(400)]
    often = [rng.choice([0.6, 0.02]) for _ in terms]
    idf = {t: rng.uniform(1, 4) for t in terms}
    examples = [(i, rng.randrange(2), {t: rng.randint(1, 3) for t, p in zip(terms, often) if rng.random() < p / 4}) for i in range(900)]
    model = toxicity.Model(idf, examples, 0.0, 0.3)
    assert 0 < len(model.common) < len(terms) and len(model.example)
    texts = [" ".join(rng.choice(terms) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    weight = np.zeros((len(model.doc), len(terms)))
    place = {t: i for i, t in enumerate(sorted(terms))}
    at = {d: i for i, d in enumerate(model.doc.tolist())}
    for i, _, counts in examples:
        if i in at:
            raw = {place[t]: (1 + math.log(n)) * idf[t] for t, n in counts.items()}
            norm = math.sqrt(sum(x * x for x in raw.values()))
            weight[at[i], list(raw)] = [x / norm for x in raw.values()]
    for text, (score, ids) in zip(texts, model.scores(texts)):
        query = np.zeros(len(terms))
        for t in set(text.split()):
            query[place[t]] = (1 + math.log(text.split().count(t))) * idf[t]
        cosine = weight @ query / (np.sqrt((query * query).sum()) or 1)
        want = np.sort(cosine[cosine > 0])[::-1][:toxicity.K]
        np.testing.assert_allclose(cosine[[at[d] for d in ids]], want, atol=1e-8)
        assert 0 <= score <= 1


def model_of(seed=3, n=900, marks=("t0",)):
    rng = random.Random(seed)
    terms = [f"t{i}" for i in range(400)]
    often = [rng.choice([0.6, 0.02]) for _ in terms]
    idf = {t: 500.0 if t in marks else rng.uniform(1, 4) for t in terms}
    examples = [(i, rng.randrange(2), {t: rng.randint(1, 3) for t, p in zip(terms, often) if t not in marks and rng.random() < p / 4}) for i in range(n)]
    for i, (_, toxic, counts) in enumerate(examples):
        if i % 9 == 0:
            counts.update(dict.fromkeys(marks, 1))
    return toxicity.Model(idf, examples, 0.0, 0.3), idf, examples


def test_bounds_are_summed_only_where_they_skip_postings(monkeypatch):
    model, idf, examples = model_of()
    bounded, summed = toxicity.Model._rows, []

    def rows(self, terms, x, part, floor):
        out = bounded(self, terms, x, part, floor)
        summed.append((len(out[0]), len(self._lists(terms, x)[0])))
        return out

    monkeypatch.setattr(toxicity.Model, "_rows", rows)
    listed = [t for t, i in model.term.items() if model.row[i] < 0]
    neutral = " ".join(listed[:60])
    model.scores([neutral, "", "none of these"])
    assert not summed
    marked = neutral + " t0"
    found, sims, _ = model.nearest(model.vector(marked))
    assert summed and summed[0][0] < summed[0][1]
    # the same neighbours as from all postings
    monkeypatch.setattr(toxicity, "WORTH", math.inf)
    every, same, _ = model.nearest(model.vector(marked))
    assert len(summed) == 1 and every.tolist() == found.tolist() and same.tolist() == sims.tolist()


def test_vectors_hold_the_terms_of_term_counts():
    texts = ["Fool_fool, FOOL-born x2\x00y2 1990's", "ΟΔΟΣ ΟΔΟΣ. “naïve”–Straße… İstanbul ½ x y ét 漢字。かな", "", "---", "fool…fool fool foolish " * 3, "_a_ ß² 𝔘nicode\U0001f600wörter"]
    held = {t for x in texts for t in toxicity.term_counts(x)} - {"fool"}
    idf = {t: 1.0 + i % 3 for i, t in enumerate(sorted(held))}
    model = toxicity.Model(idf, [(i, i % 2, {t: 1}) for i, t in enumerate(sorted(held))], 0.0, 0.3)
    first, terms, x = model.vectors(texts)
    names = sorted(idf)
    for i, text in enumerate(texts):
        raw = {t: (1 + math.log(n)) * idf[t] for t, n in toxicity.term_counts(text).items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        got = dict(zip((names[j] for j in terms[first[i]:first[i + 1]]), x[first[i]:first[i + 1]].tolist()))
        assert got == pytest.approx({t: v / norm for t, v in raw.items()}, abs=1e-12)


def test_chunks_keep_all_texts_and_bound_their_letters(monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 4)
    monkeypatch.setattr(toxicity, "CHUNK_CHARS", 10)
    texts = ["a" * n for n in (3, 3, 3, 3, 0, 0, 0, 0, 25, 1, 1)]
    lots = list(toxicity.chunks(texts))
    assert [x for lot in lots for x in lot] == texts and list(toxicity.chunks([])) == []
    assert all(len(lot) <= 4 and (len(lot) == 1 or sum(map(len, lot)) <= 10) for lot in lots)


def test_broadcast_leaves_out_what_follows_from_the_lists():
    model, _, _ = model_of(marks=())
    sent = pickle.dumps(model, 5)
    assert len(sent) < model.common.nbytes
    again = pickle.loads(sent)
    texts = [" ".join(random.Random(i).choices(list(model.term), k=i % 50)) for i in range(120)]
    assert again.scores(texts) == model.scores(texts)
    for name in ("common", "example", "x", "list_at", "posting_at", "block", "most", "group_at"):
        np.testing.assert_array_equal(getattr(again, name), getattr(model, name))
