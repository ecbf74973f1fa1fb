"""Periodic runs in texts, by a grammar.

A run is a stretch of words with smallest period q (words q apart are equal)
that is at least ``min_length`` words and ``power`` periods long and that no
neighbouring word extends. From the collapsed text a word is gone if any run
holds it after that run's first q words.

For each step of texts a task

1. finds the stretches in which some words come again. In a run at least
   ``min_length - min_length // power`` words in a row equal those a period
   later, so a run lies whole in stretches covered by word groups of that size
   that their text has twice;
2. compresses the word ids of these stretches by Re-Pair: the most frequent pair
   of symbols, the oldest of equal ones, becomes a new symbol, until no pair
   comes twice. What is left of a stretch is halved again and again, so every
   part of it has a node: a symbol of the grammar or one of the halves;
3. computes for each node once, not for each place it occurs at, the runs across
   its boundary, that is between its two parts. A run that has q words on one
   side has an equal pair of words at the boundary; common extensions to both
   sides of that pair, from ranks of all groups of 2^k words, give its ends;
4. puts these runs at all places where the derivation has the node, joins those
   of one period that overlap in a period or more, and keeps the smallest period
   of each interval. A run is whole in the smallest node that holds it, so what
   is joined is exactly the runs of the text.

Everything is exact: hashes only choose the stretches, and equal groups have
equal hashes. A text is the work of one task, texts are shared out by Spark;
nothing is shuffled.

Rows are taken as they are: repeated rows and rows without an id each give a
row. A null text has no words, no runs and an empty collapsed text. Other
columns are not looked at.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.llm.common import mix
from logweir.llm.winnowing import run_hashes

MIN_LENGTH, POWER = 24, 3
# Bytes of text that one step handles; a longer text is a step of its own.
_STEP_BYTES = 3_000_000
# Pairs of node and period that are looked at together.
_PAIRS = 2_000_000

Run = tuple[int, int, int]  # start, length, period
Change = Callable[[int | None, list[bytes]], list[bytes]]


def stretches(ids: np.ndarray, firsts: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """From and to of what is covered by groups of ``gram`` words that a text has twice."""
    sizes = np.diff(firsts)
    text = np.repeat(np.arange(len(sizes)), sizes)
    whole = np.flatnonzero(np.repeat(firsts[1:], sizes) - np.arange(len(ids)) >= gram)
    hashes = run_hashes(mix(ids.astype(np.uint64)), gram)[whole] ^ mix(text[whole].astype(np.uint64) + np.uint64(1))
    order = np.argsort(hashes)
    again = hashes[order][1:] == hashes[order][:-1]
    twice = np.concatenate((again, [False])) | np.concatenate(([False], again))
    at = whole[order[twice[: len(order)]]]
    change = np.bincount(at, minlength=len(ids) + 1) - np.bincount(at + gram, minlength=len(ids) + 1)
    covered = np.cumsum(change)[:-1] > 0
    new = np.zeros(len(ids) + 1, bool)
    new[firsts] = True
    begins = covered & (new[:-1] | ~np.concatenate(([False], covered[:-1])))
    ends = covered & (new[1:] | ~np.concatenate((covered[1:], [False])))
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class Grammar:
    """Re-Pair of a row of numbers. Symbol ``-1 - i`` is the pair ``rules[i]``."""

    def __init__(self, row: list[int]):
        self.symbols: list[int | None] = list(row)
        self.rules: list[tuple[int, int]] = []
        self.sizes: list[int] = []
        self.places: list[int] = []  # where each rule's words can be read
        n = len(row)
        self.after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        symbols, after = self.symbols, self.after
        found: dict[tuple[int, int], list[int]] = defaultdict(list)
        for i, pair in enumerate(zip(row, row[1:])):
            at = found[pair]
            # Of three equal symbols only two make a pair.
            if not at or at[-1] != i - 1 or pair[0] != pair[1]:
                at.append(i)
        serial = count()
        heap = [(-len(at), next(serial), pair) for pair, at in found.items() if len(at) > 1]
        heapq.heapify(heap)
        while heap:
            times, number, pair = heapq.heappop(heap)
            left, right = pair
            at = [i for i in found[pair] if symbols[i] == left and after[i] < n and symbols[after[i]] == right]
            found[pair] = at
            if len(at) < 2:
                continue
            if len(at) < -times and heap and -len(at) > heap[0][0]:
                heapq.heappush(heap, (-len(at), number, pair))
                continue
            del found[pair]
            new = -1 - len(self.rules)
            self.rules.append(pair)
            self.sizes.append(self.size(left) + self.size(right))
            self.places.append(at[0])
            fresh: dict[tuple[int, int], list[int]] = defaultdict(list)
            for i in at:
                j = after[i]
                # An equal pair just replaced may have taken a part of this one.
                if symbols[i] != left or j >= n or symbols[j] != right:
                    continue
                k = after[j]
                symbols[i], symbols[j], after[i] = new, None, k
                if k < n:
                    before[k] = i
                    fresh[new, symbols[k]].append(i)
                h = before[i]
                if h >= 0:
                    if symbols[h] == new:
                        # The pair to the right of h was written down before i became the new symbol.
                        pairs = fresh[new, new]
                        if not pairs or after[pairs[-1]] != h:
                            pairs.append(h)
                    else:
                        fresh[symbols[h], new].append(h)
            for new_pair, places in fresh.items():
                if len(places) > 1:
                    found[new_pair] = places
                    heapq.heappush(heap, (-len(places), next(serial), new_pair))

    def size(self, symbol: int) -> int:
        return self.sizes[-1 - symbol] if symbol < 0 else 1

    def top(self, start: int, stop: int) -> list[int]:
        """Places of the symbols that are left between two places."""
        out = []
        while start < stop:
            out.append(start)
            start = self.after[start]
        return out


def nodes(grammar: Grammar, parts: list[tuple[int, int]], least: int) -> tuple[np.ndarray, list[list[int]]]:
    """Nodes of ``least`` words or more: rows of (from, boundary, to), and the places of each."""
    out: list[tuple[int, int, int]] = []
    places: list[list[int]] = []
    number: dict[int, int] = {}
    stack: list[tuple[int, int]] = []
    for start, stop in parts:
        bounds = [*grammar.top(start, stop), stop]
        halves = [(0, len(bounds) - 1)]
        while halves:
            a, b = halves.pop()
            lo, hi = bounds[a], bounds[b]
            if hi - lo < least:
                continue
            if b - a == 1:
                stack.append((grammar.symbols[lo], lo))
                continue
            half = min(max(bisect_left(bounds, (lo + hi) // 2, a, b), a + 1), b - 1)
            out.append((lo, bounds[half], hi))
            places.append([lo])
            halves += [(a, half), (half, b)]
    while stack:
        symbol, at = stack.pop()
        if symbol >= 0 or grammar.size(symbol) < least:
            continue
        left, right = grammar.rules[-1 - symbol]
        if symbol not in number:
            number[symbol] = len(out)
            lo = grammar.places[-1 - symbol]
            out.append((lo, lo + grammar.size(left), lo + grammar.size(symbol)))
            places.append([])
        places[number[symbol]].append(at)
        stack += [(left, at), (right, at + grammar.size(left))]
    return np.array(out, np.int64).reshape(-1, 3), places


class Ranks:
    """Numbers for all groups of 2^k words: equal groups, equal numbers."""

    def __init__(self, row: np.ndarray, longest: int):
        self.levels = [np.unique(row, return_inverse=True)[1].astype(np.int64)]
        size = 1
        while 2 * size <= min(longest, len(row)):
            last = self.levels[-1]
            if last.max() == len(last) - 1:
                break  # all groups differ, and so do longer ones
            pairs = last[: len(last) - size] * (len(row) + 1) + last[size:]
            self.levels.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
            size *= 2

    def _common(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            size, level = 1 << k, self.levels[k]
            can = np.flatnonzero(out + size <= most)
            shift = 1 - size - out[can] if back else out[can]
            same = level[i[can] + shift] == level[j[can] + shift]
            out[can[same]] += size
        return out

    def ahead(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on, up to ``most``."""
        return self._common(i, j, most, False)

    def behind(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same for the words that end with i and j."""
        return self._common(i, j, most, True)


def crossing(
    row: np.ndarray, ranks: Ranks, table: np.ndarray, min_length: int, power: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs across the boundary of each node: (node, from, to, period)."""
    parts = []
    periods = (table[:, 2] - table[:, 0]) // power
    ends = np.cumsum(periods)
    start = 0
    while start < len(table):
        base = ends[start] - periods[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + _PAIRS, side="right")))
        some = periods[start:stop]
        node = np.repeat(np.arange(start, stop), some)
        q = np.arange(len(node)) - np.repeat(np.cumsum(some) - some, some) + 1
        lo, mid, hi = table[node].T
        for first in (mid - 1, mid - q):  # the earlier word of the equal pair
            fits = (first >= lo) & (first + q < hi)
            at = np.flatnonzero(fits)
            at = at[row[first[at]] == row[first[at] + q[at]]]
            i, period = first[at], q[at]
            back = ranks.behind(i, i + period, i - lo[at] + 1)
            on = ranks.ahead(i, i + period, hi[at] - i - period)
            a, b = i - back + 1, i + on + period
            good = (b - a >= np.maximum(min_length, power * period)) & (a < mid[at]) & (b > mid[at])
            parts.append(np.stack([node[at], a, b, period])[:, good])
        start = stop
    found = np.concatenate(parts, axis=1) if parts else np.zeros((4, 0), np.int64)
    found = found[:, np.lexsort((found[3], found[2], found[1], found[0]))]
    first = np.ones(found.shape[1], bool)
    first[1:] = (found[:3, 1:] != found[:3, :-1]).any(axis=0)
    node, a, b, period = found[:, first]
    return node, a, b, period


def merged(pieces: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Maximal intervals (from, to, period) of pieces, with the smallest period of each."""
    by_period: dict[int, list[list[int]]] = defaultdict(list)
    for a, b, q in sorted(set(pieces)):
        last = by_period[q]
        if last and a + q <= last[-1][1]:
            last[-1][1] = max(last[-1][1], b)
        else:
            last.append([a, b])
    best: dict[tuple[int, int], int] = {}
    for q in sorted(by_period):
        for a, b in by_period[q]:
            best.setdefault((a, b), q)
    return [(a, b, q) for (a, b), q in best.items()]


def runs_of(ids: np.ndarray, firsts: np.ndarray, min_length: int = MIN_LENGTH, power: int = POWER) -> dict[int, list[Run]]:
    """Runs of each text that has any; text ``t`` is ``ids[firsts[t]:firsts[t + 1]]``."""
    begins, ends = stretches(ids, firsts, min_length - min_length // power)
    long = ends - begins >= min_length
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return {}
    # All stretches in a row, a number that occurs nowhere else after each.
    sizes = ends - begins + 1
    offsets = np.cumsum(sizes) - sizes
    source = np.arange(sizes.sum()) - np.repeat(offsets - begins, sizes)
    row = ids[np.minimum(source, len(ids) - 1)].astype(np.int64)
    row[offsets + sizes - 1] = ids.max() + 1 + np.arange(len(sizes))
    grammar = Grammar(row.tolist())
    table, places = nodes(grammar, list(zip(offsets.tolist(), (offsets + sizes - 1).tolist())), min_length)
    if not len(table):
        return {}
    ranks = Ranks(row, int((table[:, 2] - table[:, 0]).max()))
    pieces: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for node, a, b, q in zip(*(x.tolist() for x in crossing(row, ranks, table, min_length, power)), strict=True):
        for at in places[node]:
            move = at - int(table[node, 0])
            part = int(np.searchsorted(offsets, at, side="right")) - 1
            pieces[part].append((a + move, b + move, q))
    out: dict[int, list[Run]] = defaultdict(list)
    for part, some in pieces.items():
        text = int(np.searchsorted(firsts, begins[part], side="right")) - 1
        move = int(begins[part] - offsets[part] - firsts[text])
        out[text] += [(a + move, b - a, q) for a, b, q in merged(some)]
    return {text: sorted(runs, key=lambda r: (r[0], r[2])) for text, runs in out.items()}


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]


_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_ARROW_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def _steps(texts: list[bytes]) -> Iterator[range]:
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > _STEP_BYTES:
            yield range(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield range(start, len(texts))


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, power: int = POWER, change: Change | None = None
) -> DataFrame:
    """(`doc_id`, `n_words`, `runs`, `collapsed`): runs by start and period, and the text without their repeats.

    ``change`` gets the id and the words of a text and gives other words in their place.
    """
    out = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(_RUN)),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def step(doc_ids: list, texts: list[bytes]) -> tuple[list[int], list[list[Run]], list[bytes]]:
        # bytes.split takes exactly the six white-space characters of ASCII.
        words = [text.split() for text in texts]
        if change:
            words = [change(i, w) for i, w in zip(doc_ids, words, strict=True)]
        firsts = np.cumsum([0] + [len(w) for w in words])
        numbers: dict[bytes, int] = defaultdict(count().__next__)
        ids = np.fromiter((numbers[w] for some in words for w in some), np.int64, firsts[-1])
        found = runs_of(ids, firsts, min_length, power)
        runs = [found.get(i, []) for i in range(len(words))]
        return np.diff(firsts), runs, [b" ".join(collapse(w, r) if r else w) for w, r in zip(words, runs, strict=True)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for some in _steps(texts):
                part = slice(some.start, some.stop)
                n_words, runs, collapsed = step(ids[part], texts[part])
                rows = [[dict(zip(("start", "length", "period"), r)) for r in of] for of in runs]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(some.start, len(some)),
                        pa.array(n_words, pa.int64()),
                        pa.array(rows, _ARROW_RUNS),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, out)


def repeat_end(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the query: in a tenth of the texts, by their id, the end repeats itself."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query: number of runs, the run with most periods, hashes of runs and text."""
    # Runs come by start and period: the first of equally many periods stays.
    best = F.expr(
        "aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (b, x) -> "
        "if(b is null or x.length * b.period > b.length * x.period, x, b))"
    )
    lines = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')), '')")
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
