"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words. Of the hashes of the ``GRAM``-word runs
in a window the least one is its fingerprint, the rightmost of equal ones. Two
equal windows have equal fingerprints at equal places, so whatever span of a
window's length or more a document shares with a test item, the two share a
fingerprint in it. An item of fewer words is one window whose fingerprint is
the hash of all its words.

1. Windows of all items are written with their fingerprints; two bit tables of
   a fixed size (2^BITS bits each) mark the fingerprints and the whole windows.
2. One pass over the documents picks their fingerprints, looks them up, and
   extends each hit to the windows around it that are marked as well. What is
   next to each other is one span. A bit that is set by chance lets a span
   through that is none; nothing is lost.
3. Spans that are the same words are compared once: their windows are joined
   to the windows of the items, word for word. What the join confirms goes
   back to the documents.

Only documents with a span take part in any shuffle, with the places of their
spans and not with their texts. Joins measure the smaller side: it is broadcast
up to BROADCAST_BYTES and shuffled beyond, where adaptive execution splits the
partitions of a passage that many documents hold.

Words are runs of ``[0-9a-z]`` and all characters beyond ASCII, after A to Z
became a to z. Documents: a null or empty text has no words; rows are taken as
they are, so repeated rows and rows without an id each give a row. Items: a null
text or one without words has no window; repeated ids are one item; an item
without an id marks words but is not counted. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.llm.common import mix, written
from logweir.operators.lookup import BROADCAST_BYTES

WINDOW, GRAM = 10, 5
BITS = 25
# Bytes of text that one numpy step handles.
_STEP_BYTES = 4_000_000

_FACTOR = np.uint64(0x9E3779B97F4A7C15)

# Byte -> the byte in lower case, 0 between words. Bytes from 0x80 on belong to characters beyond ASCII.
_LOWER = np.zeros(256, np.uint8)
_LOWER[0x80:] = np.arange(0x80, 0x100)
for _bytes in (b"0123456789", b"abcdefghijklmnopqrstuvwxyz"):
    _LOWER[list(_bytes)] = list(_bytes)
    _LOWER[list(_bytes.upper())] = list(_bytes)


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _FACTOR, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """The words of some texts in a row, by numbers."""

    low: np.ndarray  # bytes of the texts in lower case, 0 between words
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray
    firsts: np.ndarray  # first word of each text, and the number of words
    hashes: np.ndarray

    def text(self, start: int, stop: int) -> bytes:
        return b" ".join(
            self.low[a:b].tobytes() for a, b in zip(self.starts[start:stop], self.ends[start:stop], strict=True)
        )

    def left(self) -> np.ndarray:
        """For each word the number of words from there to the end of its text."""
        sizes = np.diff(self.firsts)
        return np.repeat(self.firsts[1:], sizes) - np.arange(len(self.starts))


def scan(texts: list[bytes]) -> Words:
    low = _LOWER[np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)]
    inside = low != 0
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    firsts = np.searchsorted(starts, at)
    sizes = ends - starts
    begin = np.cumsum(sizes) - sizes
    body = low[inside]
    place = np.arange(len(body)) - np.repeat(begin, sizes)
    values = body.astype(np.uint64) * _powers(int(sizes.max(initial=1)))[place]
    hashes = mix(np.add.reduceat(values, begin)) if len(begin) else np.zeros(0, np.uint64)
    return Words(low, starts, ends, firsts, hashes)


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; too near to the end it means nothing."""
    out = np.zeros(len(hashes), np.uint64)
    for j, factor in enumerate(_powers(size)):
        out[: max(len(hashes) - j, 0)] += hashes[j:] * factor
    return mix(out + np.uint64(size))


def fingerprints(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the least hash of its runs of ``gram`` words, and the word it starts at."""
    runs = run_hashes(hashes, gram)
    n = max(len(hashes) - window + 1, 0)
    last = window - gram
    least, place = runs[last : last + n].copy(), np.full(n, last)
    for j in range(last - 1, -1, -1):
        smaller = runs[j : j + n] < least
        least[smaller] = runs[j : j + n][smaller]
        place[smaller] = j
    return least, place + np.arange(n)


# -- test items ------------------------------------------------------------------

_ITEM_WINDOWS = "kind int, text string, whole long, finger long"


def item_windows(items: DataFrame, window: int, gram: int) -> DataFrame:
    """(`item`, `kind`, `text`, `whole`, `finger`): windows of each item, `kind` words long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("item"), batch.column("text").cast(pa.binary()).to_pylist()
            rows, kinds, windows, whole, finger = [], [], [], [], []
            for i, text in enumerate(texts):
                words = scan([text or b""])
                n = len(words.hashes)
                if not n:
                    continue
                size = min(n, window)
                count = n - size + 1
                hashes = run_hashes(words.hashes, size)[:count]
                rows += [i] * count
                kinds += [size] * count
                windows += [words.text(j, j + size).decode() for j in range(count)]
                whole.append(hashes)
                finger.append(hashes if size < window else fingerprints(words.hashes, window, gram)[0])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows)),
                        pa.array(kinds, pa.int32()),
                        pa.array(windows, pa.string()),
                        pa.array(np.concatenate(whole).view(np.int64)),
                        pa.array(np.concatenate(finger).view(np.int64)),
                    ],
                    names=["item", "kind", "text", "whole", "finger"],
                )

    named = items.select(F.col("item_id").cast("string").alias("item"), "text")
    return named.mapInArrow(run, f"item string, {_ITEM_WINDOWS}")


@dataclass
class Marks:
    """Two bit tables as numbers that are not 0, and the lengths of the short items."""

    tables: list[tuple[np.ndarray, np.ndarray]]
    short: list[int]
    bits: int = BITS

    def unpacked(self) -> list[np.ndarray]:
        out = []
        for at, values in self.tables:
            table = np.zeros(max(1 << self.bits >> 6, 1), np.uint64)
            table[at] = values
            out.append(table)
        return out

    def has(self, table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        bit = hashes >> np.uint64(64 - self.bits)
        return (table[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def marks(windows: DataFrame, window: int, bits: int = BITS) -> Marks:
    """Bit tables of all windows. At most 2^bits / 64 numbers of each reach the driver."""
    long = F.col("kind") == window
    hashes = windows.select(
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("table"), F.col("whole").alias("hash")),
                F.struct(F.lit(0).alias("table"), F.when(long, F.col("finger")).alias("hash")),
            )
        ).alias("x")
    ).select("x.*")
    bit = F.shiftrightunsigned("hash", 64 - bits)
    words = (
        hashes.where("hash is not null")
        .groupBy("table", F.shiftrightunsigned(bit, 6).alias("at"))
        .agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63 as int)))").alias("bits"))
        .toPandas()
    )
    tables = []
    for number in (0, 1):
        part = words[words["table"] == number]
        tables.append((part["at"].to_numpy(np.int64), part["bits"].to_numpy(np.int64).view(np.uint64)))
    short = windows.where(~long).select("kind").distinct().collect()
    return Marks(tables, sorted(r["kind"] for r in short), bits)


# -- documents -------------------------------------------------------------------

_SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("words", T.LongType()),
            T.StructField("key", T.BinaryType()),
            T.StructField("text", T.StringType()),
        ]
    )
)
_SPAN = pa.struct(
    [("kind", pa.int32()), ("start", pa.int64()), ("words", pa.int64()), ("key", pa.binary()), ("text", pa.string())]
)


def marked_spans(
    words: Words, found: Marks, tables: list[np.ndarray], window: int, gram: int
) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, first window, last window) of each row of marked windows; none reaches into another text."""
    left = words.left()
    out = []
    if len(found.tables[0][0]):
        least, place = fingerprints(words.hashes, window, gram)
        # Windows that reach into the next text have no fingerprint.
        least, place = least[left[: len(least)] >= window], place[left[: len(place)] >= window]
        new = np.diff(place, prepend=-1) != 0
        hits = place[new][found.has(tables[0], least[new])]
        near = np.unique((hits[:, None] - np.arange(window - gram + 1)).ravel())
        near = near[near >= 0]
        near = near[left[near] >= window]
        if len(near):
            whole = run_hashes(words.hashes, window)
            out.append((window, near[found.has(tables[1], whole[near])]))
    for size in found.short:
        at = np.flatnonzero(left >= size)
        out.append((size, at[found.has(tables[1], run_hashes(words.hashes, size)[at])]))
    text_of = np.repeat(np.arange(len(words.firsts) - 1), np.diff(words.firsts))
    spans = []
    for size, at in out:
        if len(at):
            cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(text_of[at]) > 0)) + 1
            spans.append((size, at[np.concatenate(([0], cut))], at[np.concatenate((cut - 1, [len(at) - 1]))]))
    return spans


def _steps(texts: list[bytes], window: int) -> Iterator[tuple[list[int], list[int], Words]]:
    """Texts in steps: row of each text, number of its words before, words.

    A text beyond the limit comes in parts that share ``window - 1`` words, so
    every window is whole in one of them.
    """
    rows: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if len(text) > _STEP_BYTES:
            before = at = 0
            while True:
                stop = at + _STEP_BYTES
                while stop < len(text) and _LOWER[text[stop]]:
                    stop += 1
                words = scan([text[at:stop]])
                yield [i], [before], words
                if stop >= len(text):
                    break
                kept = min(window - 1, len(words.starts))
                before += len(words.starts) - kept
                at = at + int(words.starts[-kept]) if kept else stop
            continue
        if rows and size + len(text) > _STEP_BYTES:
            yield rows, [0] * len(rows), scan([texts[r] for r in rows])
            rows, size = [], 0
        rows.append(i)
        size += len(text)
    if rows:
        yield rows, [0] * len(rows), scan([texts[r] for r in rows])


def document_spans(docs: DataFrame, found: Marks, window: int, gram: int) -> DataFrame:
    """(`row`, `doc_id`, `n_words`, `spans`) of each document."""
    sent = docs.sparkSession.sparkContext.broadcast(found)
    out = T.StructType(
        [
            T.StructField("row", T.LongType()),
            docs.schema["doc_id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", _SPANS),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value.unpacked()
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            n_words = np.zeros(len(texts), np.int64)
            spans: list[list[dict]] = [[] for _ in texts]
            for rows, before, words in _steps(texts, window):
                n_words[rows] = np.diff(words.firsts) + np.array(before)
                for kind, first, last in marked_spans(words, sent.value, tables, window, gram):
                    which = np.searchsorted(words.firsts, first, side="right") - 1
                    for w, a, b in zip(which.tolist(), first.tolist(), (last + kind).tolist(), strict=True):
                        text = words.text(a, b)
                        key = hashlib.sha256(b"%d %s" % (kind, text)).digest()
                        start = a - int(words.firsts[w]) + before[w]
                        spans[rows[w]].append({"kind": kind, "start": start, "words": b - a, "key": key, "text": text.decode()})
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(n_words), pa.array(spans, pa.list_(_SPAN))],
                names=["row", "doc_id", "n_words", "spans"],
            )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return numbered.mapInArrow(run, out)


# -- exact comparison --------------------------------------------------------------


def _joined(left: DataFrame, right: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """Left join to a table that is broadcast if its rows, of ``size`` bytes each, fit."""
    total = right.agg(F.sum(size.cast("long")).alias("n")).first()["n"] or 0
    return left.join(F.broadcast(right) if total <= limit else right, key, "left")


def confirmed(spans: DataFrame, windows: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(`key`, `hits`, `items`): intervals of each span that windows of items cover, and those items."""
    known = written(
        windows.groupBy("text").agg(F.collect_set("item").alias("items")).withColumnRenamed("text", "window"),
        "item-windows",
    )
    once = spans.groupBy("key").agg(*(F.first(c).alias(c) for c in ("kind", "words", "text")))
    single = F.split("text", " ")
    slices = once.select("key", "kind", "words", single.alias("w")).select(
        "key", "kind", "words", "w", F.explode(F.expr("sequence(0L, words - kind)")).alias("at")
    )
    slices = slices.select(
        "key", "kind", "words", "at", F.array_join(F.slice("w", (F.col("at") + 1).cast("int"), F.col("kind")), " ").alias("window")
    )
    bytes_ = F.octet_length("window") + 64 + 48 * F.size("items")
    found = _joined(slices, known, "window", bytes_, limit).where("items is not null")
    grouped = found.groupBy("key").agg(
        F.first("kind").alias("kind"),
        F.first("words").alias("words"),
        F.array_sort(F.collect_list("at")).alias("at"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    all_of = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("words").alias("b")))
    single = F.expr("transform(at, x -> struct(x as a, x + kind as b))")
    whole = F.size("at") == F.col("words") - F.col("kind") + 1
    return grouped.select("key", F.when(whole, all_of).otherwise(single).alias("hits"), "items")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    bits: int = BITS,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """For each document how many of its words, and which items, are shared.

    Columns `doc_id`, `n_words`, `n_hit`, `n_items`, `item_ids` (as texts, in
    their order) and `hits` (word intervals, from and to, in their order; they
    may overlap).
    """
    windows = written(item_windows(items, window, gram), "windows")
    seen = written(document_spans(docs, marks(windows, window, bits), window, gram), "spans")
    spans = seen.where(F.size("spans") > 0).select("row", "doc_id", "n_words", F.explode("spans").alias("s"))
    spans = spans.select("row", "doc_id", "n_words", "s.*")
    exact = written(confirmed(spans, windows, limit), "confirmed")
    size = F.lit(64) + 32 * F.size("hits") + 48 * F.size("items")
    placed = _joined(spans.drop("text", "words", "kind"), exact, "key", size, limit).select(
        "row",
        "doc_id",
        "n_words",
        F.expr("transform(hits, x -> struct(start + x.a as a, start + x.b as b))").alias("hits"),
        "items",
    )
    nothing = F.array().cast("array<struct<a:long,b:long>>")
    hit = (
        placed.groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
        )
        .drop("row")
    )
    clean = seen.where(F.size("spans") == 0).select(
        "doc_id", "n_words", nothing.alias("hits"), F.array().cast("array<string>").alias("item_ids")
    )
    # Words of an interval count from the farthest end before it.
    covered = """
        aggregate(hits, struct(0L as n, 0L as b),
            (done, x) -> struct(done.n + greatest(0L, x.b - greatest(x.a, done.b)) as n, greatest(done.b, x.b) as b),
            done -> done.n)
    """
    return hit.unionByName(clean).select(
        "doc_id",
        "n_words",
        F.expr(covered).alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        "item_ids",
        "hits",
    )


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query: the items as one hash, and the verdict."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
with letters as (
    select row_number() over () as r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
    from documents
), docs as (
    select r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from letters
), items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
), sized as (
    select item_id, w, least(len(w), 10) as k from items where len(w) > 0
), placed as (
    select item_id, w, k, unnest(range(0, len(w) - k + 1)) as i from sized
), windows as (
    select distinct item_id, k, array_to_string(w[i + 1 : i + k], ' ') as g from placed
), kinds as (
    select distinct k from windows
), starts as (
    select r, k, w, unnest(range(0, len(w) - k + 1)) as i from docs, kinds where len(w) >= k
), hits as (
    select s.r, s.i, s.k, x.item_id from starts s join windows x on x.k = s.k and x.g = array_to_string(s.w[s.i + 1 : s.i + s.k], ' ')
), words as (
    select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + k)) as p from (select distinct r, i, k from hits)) group by r
), found as (
    select r, count(distinct item_id) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
    from (select distinct r, item_id from hits) group by r
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs d left join words using (r) left join found using (r)
"""
