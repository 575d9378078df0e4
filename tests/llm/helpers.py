"""Small tables and plain Python forms of what the operators compute."""

import random
import re
from collections import Counter

import pytest

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Texts with which every operator has to get along.
ODD = [None, "", " \t\n\r\x0b\x0c", "\n\n", "a", "É", "x\x00y\x1cz", "ABC abc Abc", "  ", "1 2 3", "\U0001f600 ́x", "<|endoftext|> <b>&amp;", "#*$%&|<>",
       "a\nb\na\n", "w" * 5000, "end\r\nline\r\nend\r\n", "it's we'll 12ab", "tie tie tie tie tie tie tie tie tie tie tie"]


def words(text):
    return SPACE.findall(text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(vocabulary)}{rng.choice(['', '', '.', ','])}" for _ in range(n))


def documents(seed=3, n=60):
    """Odd texts, prose, exact and near copies, a long text, repeated rows and null columns."""
    rng = random.Random(seed)
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s1", None) for i, t in enumerate(ODD)]
    for i in range(n):
        rows.append((100 + i, prose(rng, rng.choice([5, 40, 120, 300])), rng.choice(["en", "fr", None]), f"s{i % 4}", 7))
    base = prose(rng, 400).split()
    for i in range(40):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 8, 30])):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        rows.append((300 + i, " ".join(copy), "en", "s0", 1))
    rows.append((400, prose(rng, 30_000), "en", "s0", None))
    rows += [rows[20], rows[20], (None, "a row without an id", "en", "s0", 3)]
    return rows


def rows_of(df):
    return Counter(tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.collect())


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
