"""Vector codes against a plain Lloyd iteration."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from logweir.llm import part_codes
from logweir.llm.part_codes import digest, nearest
from logweir.llm.queries import QUERIES, SQL
from tests.compare import connect, spark_bag, sql_bag

ROWS = "vec_id long, embedding array<float>, label int, id string, row int, code string"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """One vector, one entry, one component at a time."""
    kept = []
    for vec_id, x, label, *_ in rows:
        if x is not None and all(c is not None and math.isfinite(c) for c in x):
            kept.append((vec_id, [math.floor(scale * float(np.float32(c))) for c in x], label))
    named = sorted(((i, v) for i, v, _ in kept if i is not None and v and len(v) % parts == 0))
    if not named:
        return [], ""
    dims = len(named[0][1])
    kept = [r for r in kept if len(r[1]) == dims]
    first = {}
    for i, v in named:
        if len(v) == dims:
            first.setdefault(i, v)
    w = dims // parts
    books = [[first[i][p * w : (p + 1) * w] for i in sorted(first)[:entries]] for p in range(parts)]

    def assign(v):
        out = []
        for p, book in enumerate(books):
            x = v[p * w : (p + 1) * w]
            out.append(min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book)))
        return out

    for _ in range(rounds):
        members = {}
        for _, v, _ in kept:
            for p, (_, e) in enumerate(assign(v)):
                members.setdefault((p, e), []).append(v[p * w : (p + 1) * w])
        for (p, e), some in members.items():
            books[p][e] = [sum(c) // len(some) for c in zip(*some)]
    out = []
    for i, v, label in kept:
        best = assign(v)
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
    totals = {}
    for _, _, error, label in out:
        totals[label] = totals.get(label, 0) + error
    text = ",".join(str(c) for book in books for e in book for c in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, code, error, totals[label], sha) for i, code, error, label in out), key=str), text


def sample(n, seed=1, dims=32):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(9)]
    same = [0.25] * dims
    rows = []
    for i in range(n):
        # A third of all vectors are equal.
        x = same if i % 3 == 0 else [c + rng.gauss(0, 0.4) for c in rng.choice(centres)]
        rows.append((i * 7 % 1009, x, rng.choice([None, 1, 2]), "x", 5, "y"))
    odd = [
        (2000, None, 1, "x", 5, "y"), (2001, [0.5] * (dims - 1) + [None], 1, "x", 5, "y"), (2002, [math.nan] * dims, 1, "x", 5, "y"),
        (2003, [math.inf] * dims, 1, "x", 5, "y"), (2004, [], 1, "x", 5, "y"), (2005, [1.0] * (dims + 16), 1, "x", 5, "y"),
        (2006, [1.0] * 5, 1, "x", 5, "y"), (None, [0.1] * dims, None, None, None, None), (-5, [1.0] * 5, 1, "x", 5, "y"),
        (-4, [-0.001] * dims, 2, "x", 5, "y"), (-4, [-0.5] * dims, 2, "x", 5, "y"), (-4, [-0.5] * dims, 2, "x", 5, "y"),
    ]
    rows += odd
    rng.shuffle(rows)
    return rows


def result(spark, rows, **options):
    found, books = part_codes.part_codes(spark.createDataFrame(rows, ROWS).repartition(3), **options)
    return sorted((tuple(r) for r in digest(found, books).collect()), key=str)


def test_equals_plain_lloyd(spark):
    rows = sample(400)
    expected, _ = brute(rows)
    assert result(spark, rows) == expected


@pytest.mark.parametrize("rounds, entries", [(0, 5), (1, 256), (5, 7)])
def test_rounds_and_small_blocks(spark, monkeypatch, rounds, entries):
    for name, value in (("BLOCK", 3), ("_STEP_VALUES", 500), ("SALT_ROWS", 20), ("GROUP", 16)):
        monkeypatch.setattr(part_codes, name, value)
    rows = sample(150, seed=rounds)
    expected, _ = brute(rows, rounds=rounds, entries=entries)
    assert result(spark, rows, rounds=rounds, entries=entries) == expected


def test_only_what_changes_entry_moves(spark, monkeypatch):
    kept = []
    write = part_codes.written

    def watched(df, label, *options):
        out = write(df, label, *options)
        if label == "residents":
            kept.append(out)
        return out

    monkeypatch.setattr(part_codes, "written", watched)
    rows = sample(300, seed=9)
    part_codes.part_codes(spark.createDataFrame(rows, ROWS), rounds=2, entries=9)
    first, second = (t.where("born is not null").groupBy().sum("n").first()[0] for t in kept)
    stayed = kept[1].where("born is null").groupBy().sum("n").first()[0]
    assert first == second + stayed and 0 < second < first / 2


def test_nearest_is_exact_for_large_numbers():
    rng = np.random.default_rng(1)
    points, book = rng.integers(-(1 << 24), 1 << 24, (50, 8)), rng.integers(-(1 << 24), 1 << 24, (9, 8))
    book[3] = book[1]
    entry, distance = nearest(points, book)
    plain = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)) for c in book] for x in points]
    assert entry.tolist() == [d.index(min(d)) for d in plain] and distance.tolist() == [min(d) for d in plain]


def test_nothing_to_code(spark):
    for rows in ([], [(None, [1.0] * 16, 1, "x", 1, "y")], [(1, None, None, "x", 1, "y"), (2, [1.0], 1, "x", 1, "y")]):
        assert result(spark, rows) == []
    with pytest.raises(ValueError, match="exactly"):
        result(spark, [(1, [1e30] * 16, 1, "x", 1, "y")])


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert spark_bag(QUERIES["op11_part_codes"](spark, folder)) == sql_bag(connect(folder), SQL["op11_part_codes"])
