"""Decontamination against brute force, on planted passages and odd rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from logweir.llm import winnowing
from logweir.llm.queries import QUERIES, SQL
from logweir.llm.winnowing import WINDOW, decontaminate, digest, fingerprints, scan
from tests.compare import connect, spark_bag, sql_bag

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, spans string, item_id string, row int"
ITEMS = "item_id long, text string, doc_id long, kind string"


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    sets = []
    for item, text, *_ in items:
        words = words_of(text)
        k = min(len(words), WINDOW)
        if k:
            sets.append((item, k, {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}))
    for doc, text, *_ in docs:
        words = words_of(text)
        hit, found = set(), set()
        for item, k, windows in sets:
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    if item is not None:
                        found.add(str(item))
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), ids, bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sample(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Straße", "über", "слово", "ДОМ", "字", "x9", "aB", "a"]

    def prose(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "\0", "-", "  "]) for _ in range(n))

    items = [(i, prose(rng.choice([1, 2, 4, 5, 9, 10, 11, 30])), 7, "k") for i in range(30)]
    items += [(100, None, 1, "k"), (101, "", 1, "k"), (102, "!!", 1, "k"), (None, "w1 w2 Straße w3 w4 w5 w6 w7 w8 w9 x9", 1, "k")]
    items += [(103, items[3][1].upper(), 1, "k"), (0, items[5][1], 1, "k"), (104, "one two three four five six seven eight nine ten eleven", 1, "k")]
    docs = []
    for i in range(60):
        parts = [prose(rng.randrange(40)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            parts.insert(1, " ".join(words_of(rng.choice(items)[1])[rng.randrange(3) :]))
        docs.append((i, " ".join(parts), "s", "i", i))
    docs += [(900, None, "s", "i", 1), (901, "", "s", "i", 1), (902, " ,.", "s", "i", 1), (None, items[4][1], "s", "i", 1)]
    docs += [(903, docs[1][1], "s", "i", 1), (1, docs[1][1], "s", "i", 1), (None, None, None, None, None)]
    docs += [(904, "Eleven " + "ten nine " * 30_000 + "one two three FOUR five six seven-eight nine ten.", "s", "i", 1)]
    return docs, items


@pytest.mark.parametrize("bits, limit", [(winnowing.BITS, 10**8), (8, 0)])
def test_equals_brute_force(spark, bits, limit):
    docs, items = sample()
    found = decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), bits=bits, limit=limit)
    assert rows(digest(found)) == brute(docs, items)
    by_id = {r["doc_id"]: r for r in found.collect()}
    # The last ten words of the very long text.
    assert [tuple(h) for h in by_id[904]["hits"]][-1] == (60_001, 60_011)


def test_texts_in_parts_lose_nothing(spark, monkeypatch):
    docs, items = sample(5)
    monkeypatch.setattr(winnowing, "_STEP_BYTES", 300)
    texts = [(d[1] or "").encode() for d in docs[:-1]]
    counts = np.zeros(len(texts), int)
    windows = [set() for _ in texts]
    for at, before, words in winnowing._steps(texts, WINDOW):
        assert len(words.low) < 2_000
        for i, b, first, stop in zip(at, before, words.firsts, words.firsts[1:]):
            counts[i] = b + stop - first
            windows[i] |= {(b + j - first, words.text(j, j + WINDOW)) for j in range(first, stop - WINDOW + 1)}
    for text, n, got in zip(docs, counts, windows):
        words = words_of(text[1])
        assert n == len(words)
        assert got == {(i, " ".join(words[i : i + WINDOW]).encode()) for i in range(len(words) - WINDOW + 1)}


def test_equal_windows_have_equal_fingerprints():
    rng = random.Random(1)
    passage = [f"p{rng.randrange(4)}" for _ in range(60)]
    for _ in range(50):
        a, b = ([f"x{rng.randrange(9)}" for _ in range(rng.randrange(30))] for _ in range(2))
        i = rng.randrange(50)
        left, right = (scan([" ".join([*head, *passage[i : i + 10], "z"]).encode()]).hashes for head in (a, b))
        (lf, lp), (rf, rp) = fingerprints(left, 10, 5), fingerprints(right, 10, 5)
        assert lf[len(a)] == rf[len(b)] and lp[len(a)] - len(a) == rp[len(b)] - len(b)


def test_empty_tables(spark):
    docs, items = sample()
    none, nothing = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert decontaminate(none, spark.createDataFrame(items, ITEMS)).count() == 0
    assert rows(digest(decontaminate(spark.createDataFrame(docs[:5], DOCS), nothing))) == brute(docs[:5], [])
    assert decontaminate(none, nothing).count() == 0
    # Fewer words in all than a window has.
    few = [(1, "one two", "s", "i", 1)]
    assert rows(digest(decontaminate(spark.createDataFrame(few, DOCS), spark.createDataFrame(items, ITEMS)))) == brute(few, items)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert spark_bag(QUERIES["op12_decontamination"](spark, folder)) == sql_bag(connect(folder), SQL["op12_decontamination"])
