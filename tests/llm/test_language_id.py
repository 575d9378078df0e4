import math
import random

from helpers import DOCS, docs, documents, nothing
from pyspark.sql import functions as F

from subrev.llm import language_id
from subrev.llm.language_id import BLOCK, Model, automaton

SYLLABLES = {"aa": "ka to mi ra su no".split(), "bb": "sch ung ein ver keit au".split(), "cc": "tion eau que ment oi le".split()}


def text(lang, rng, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n=240):
    rng = random.Random(5)
    return [(i, text(lang := sorted(SYLLABLES)[i % 3], rng, rng.choice([3, 20, 200])), lang, f"s{i % 2}", 1) for i in range(n)]


def test_automaton_accepts_exactly_the_substrings():
    rng = random.Random(1)
    s = [rng.randrange(3) for _ in range(60)]
    go = automaton(s)
    subs = {tuple(s[i:j]) for i in range(61) for j in range(i, 61)}
    for _ in range(2000):
        w = tuple(rng.randrange(3) for _ in range(rng.randint(1, 8)))
        state = 0
        for c in w:
            state = go[state].get(c) if state is not None else None
        assert (state is not None) == (w in subs)


def phrases(known, letters):
    """Greedy longest matches, block by block; a symbol that the text lacks is a phrase of its own."""
    n = 0
    for at in range(0, len(letters), BLOCK):
        part, i = letters[at:at + BLOCK], 0
        while i < len(part):
            j = i + 1
            while j <= len(part) and part[i:j] in known:
                j += 1
            i = max(j - 1, i + 1)
            n += 1
    return n


def test_predictions_against_plain_parsing():
    rng = random.Random(2)
    samples = {lang: [text(lang, rng, 30) for _ in range(3)] for lang in SYLLABLES}
    model = Model(samples)
    texts = [text(lang, rng, n) for lang in SYLLABLES for n in (1, 7, 150)] + ["zzz !! ka", "12 ka", "K\n\nA", "schüng"]
    symbols = model.symbols()
    join = lambda parts: "".join(chr(65 + s) for p in parts for s in language_id._squeeze(symbols, [p])[0])
    for t, lang in zip(texts, model.predict(texts)[0]):
        bits = {}
        for name in SYLLABLES:
            known = join(samples[name])
            bits[name] = phrases(known, join([t])) * math.log2(len(known))
        assert lang == min(sorted(bits), key=lambda k: bits[k])


def test_held_out_accuracy_and_defined_results(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    rows = language_id.predictions(docs).collect()
    held = [r for r in rows if r["held_out"]]
    truth = {i: lang for i, _, lang, *_ in corpus()}
    assert len(held) > 50 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_many_labels_do_not_weaken_the_large_languages(spark, monkeypatch):
    rare = [(10_000 + i, "qux", f"x{i}", "s", 1) for i in range(300)]
    docs = spark.createDataFrame([*corpus(), *rare], DOCS)
    few, many = language_id.fit(spark.createDataFrame(corpus(), DOCS)), language_id.fit(docs)
    bits = {x.name: x.bits for x in few.parts[0]}
    assert len(many.languages) > 150 and bits == {x.name: x.bits for p in many.parts for x in p if x.name in bits}
    truth = {i: lang for i, _, lang, *_ in corpus()}
    rows = [r for r in language_id.predictions(docs).collect() if r["held_out"] and r["doc_id"] in truth]
    assert len(rows) > 50 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.97 * len(rows)
    whole = sorted(language_id.predictions(docs).collect())
    # the same by edges, and in parts
    monkeypatch.setattr(language_id, "CELLS", 0)
    assert sorted(language_id.predictions(docs).collect()) == whole
    monkeypatch.setattr(language_id, "PART_EDGES", 2000)
    assert len(language_id.fit(docs).parts) > 2 and sorted(language_id.predictions(docs).collect()) == whole


def test_scripts_of_many_letters():
    rng = random.Random(8)
    han = [chr(0x4E00 + i) for i in range(2000)]
    kinds = {"h1": han[:1000], "h2": han[1000:], "ko": [chr(0xAC00 + i) for i in range(1500)]}
    model = Model({k: ["".join(rng.choice(v) for _ in range(200)) for _ in range(60)] for k, v in kinds.items()})
    symbols = model.symbols()
    letters = {c for v in kinds.values() for c in v if symbols[ord(c)] != language_id.UNLEARNT}
    assert len(letters) > 3000 and len({int(symbols[ord(c)]) for c in letters}) == len(letters)
    for k, v in kinds.items():
        assert set(model.predict(["".join(rng.choice(v) for _ in range(12)) for _ in range(50)])[0]) == {k}


def test_labels_of_held_out_rows_are_never_used(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    from subrev.llm.common import held_out
    other = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    assert sorted(language_id.predictions(other).collect()) == sorted(language_id.predictions(docs).collect())


def test_odd_texts_clashing_columns_and_empty_tables(spark, docs, nothing):
    for r in language_id.identify(docs, language_id.fit(docs)).collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
    assert language_id.predictions(nothing).count() == 0
    assert {r["lang_pred"] for r in language_id.predictions(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    clash = docs.withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit("y"))
    assert language_id.predictions(clash).count() == len(documents())
