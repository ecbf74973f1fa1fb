"""Vector codes by parts: Lloyd's method with resident members.

A vector is cut into ``parts`` equal parts; each part position has a codebook of
``entries`` entries, and a vector's code names the nearest entry of each part.
All components are whole numbers, floor(scale * x), so sums and distances are
exact and the order of rows changes nothing.

The members of an entry live with an owner: rows are dealt by (position, entry,
salt), and there they stay. A row is a block, up to BLOCK parts of one position
and entry with their row numbers, packed. The salt of a block is a hash of its
first row number over as many values as there are SALT_ROWS vectors, so an entry
that holds a third of all parts has owners in proportion.

In each round the owners hold the sums of their resident members; sums of all
owners (one row for each entry) give the new codebook. With it owners look at
their members: those that stay are summed where they are, those that change
entry leave as blocks of the new entry. Only these, and the sums, go through the
shuffle to the next owners, and only these are written: a table of a round holds
its arrivals. Which of them are still resident later follows from the codebooks
since, so nothing is ever rewritten. The last assignment moves nobody; codes come
together by runs of GROUP row numbers.

Codebooks (parts x entries x part length numbers) are all that passes the
driver and all that tasks are sent. A first pass writes the whole numbers of the
vectors with a row number; everything else reads that table, so a task that
runs again sees the same numbers.

Rows whose vector is null, or holds a null, infinite or not-a-number component,
are dropped. So are vectors whose length is not that of the kept vector with the
smallest id whose length is a positive multiple of ``parts``. Codebooks start
from the vectors with the smallest ids; of rows that repeat an id the one with
the least vector counts there. With fewer ids there are fewer entries, and rows
without an id take part but start nothing; if no row has an id there is
nothing to start from and the result is empty. Components beyond LIMIT raise an
error, as sums would no longer be exact. An empty table gives an empty result.
Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import mix, written
from logweir.operators.lookup import lookup_join

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Most parts of a block; numbers of parts that are packed together in a task.
BLOCK = 2_048
_STEP_VALUES = 4_000_000
# Vectors for each value of the salt.
SALT_ROWS = 1 << 17
# Vectors whose codes are put together at a time.
GROUP = 1 << 16
# Largest size of a component.
LIMIT = 1 << 24

_BLOCKS = "position int, entry int, salt long, born int, n long, rows binary, vals binary, sums array<long>"


@dataclass
class Shape:
    dims: int
    parts: int
    salts: int

    @property
    def width(self) -> int:
        return self.dims // self.parts


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each point, the lower one of equals, and the squared distance."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)))
    # Doubles hold these sums exactly up to 2^53 and multiply faster.
    kind = np.float64 if 4 * top * top * points.shape[1] < 1 << 53 else np.int64
    x, c = points.astype(kind), book.astype(kind)
    entry, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for at in range(0, len(x), 1 << 15):
        some = x[at : at + (1 << 15)]
        d = (some * some).sum(axis=1)[:, None] - 2 * (some @ c.T) + (c * c).sum(axis=1)
        best = d.argmin(axis=1)
        entry[at : at + len(some)] = best
        distance[at : at + len(some)] = d[np.arange(len(some)), best]
    return entry, distance


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers in the smallest of three sizes; the first byte says which."""
    top = int(np.abs(numbers).max(initial=0))
    size = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
    return bytes([size]) + numbers.astype(f"<i{size}").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)


def _runs(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    """From and to of equal numbers next to each other."""
    starts = np.flatnonzero(np.diff(sorted_keys, prepend=sorted_keys[:1] - 1))
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(sorted_keys)]))


class _Blocks:
    """Blocks on their way out of a task."""

    def __init__(self, shape: Shape):
        self.shape = shape
        self.rows: list[tuple] = []

    def _salt(self, row: int) -> int:
        # Rows that were read together stay together, as far as entry and salt allow.
        return int(mix(np.array([row // GROUP], np.uint64))[0] % np.uint64(self.shape.salts))

    def members(self, position: int, born: int, entry: np.ndarray, rows: np.ndarray, points: np.ndarray) -> None:
        order = np.lexsort((rows, entry))
        entry, rows, points = entry[order], rows[order], points[order]
        for a, b in _runs(entry):
            for i in range(a, b, BLOCK):
                part = slice(i, min(i + BLOCK, b))
                packed = rows[part].astype("<i8").tobytes(), _pack(points[part].ravel())
                self.rows.append((position, int(entry[i]), self._salt(int(rows[i])), born, part.stop - i, *packed, None))

    def sums(self, position: int, entry: np.ndarray, rows: np.ndarray, points: np.ndarray) -> None:
        """Sums of members that stay, a row for each entry, on the way to one of its owners."""
        order = np.argsort(entry, kind="stable")
        entry, rows, points = entry[order], rows[order], points[order]
        for a, b in _runs(entry):
            total = points[a:b].sum(axis=0).tolist()
            self.rows.append((position, int(entry[a]), self._salt(int(rows[a])), None, b - a, None, None, total))

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        names = ["position", "entry", "salt", "born", "n", "rows", "vals", "sums"]
        columns = list(zip(*self.rows)) or [[]] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def whole_numbers(df: DataFrame, id_col: str, vector: str, label: str, scale: int) -> DataFrame:
    """(`row`, `id`, `label`, `v`) of vectors without null, infinite or not-a-number components."""

    def fine(x: Column) -> Column:
        x = x.cast("double")
        return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))

    def number(x: Column) -> Column:
        # What lies far beyond the limit becomes a number beyond it, which is found later.
        most = F.lit(float(4 * LIMIT))
        return F.floor(F.greatest(F.least(x.cast("double") * scale, most), -most)).cast("int")

    named = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(label).alias("label"),
        F.col(vector).alias("x"),
    )
    kept = named.where(F.col("x").isNotNull() & F.forall("x", fine))
    return kept.select("row", "id", "label", F.transform("x", number).alias("v"))


def first_books(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """Codebooks (position, entry, component) of the vectors with the smallest ids."""
    ids = vectors.where("id is not null").select("id")
    lead = {r["id"] for r in ids.orderBy("id").limit(entries).collect()}
    if not lead:
        return None
    if len(lead) < entries:  # few vectors, or ids that repeat
        lead = {r["id"] for r in ids.distinct().orderBy("id").limit(entries).collect()}
    rows = vectors.where(F.col("id").isin(list(lead))).groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()
    first = np.array([r["v"] for r in rows], np.int64)
    return np.ascontiguousarray(first.reshape(len(first), parts, -1).transpose(1, 0, 2))


def placed(vectors: DataFrame, shape: Shape, books: np.ndarray) -> DataFrame:
    """All parts as blocks, with their owners."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Blocks(shape)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def dealt() -> pa.RecordBatch:
            rows, values = (np.concatenate(x) for x in zip(*held))
            for p in range(shape.parts):
                points = values[:, p * shape.width : (p + 1) * shape.width]
                out.members(p, 0, nearest(points, books[p])[0], rows, points)
            held.clear()
            return out.batch()

        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            held.append((batch.column("row").to_numpy(), values.reshape(-1, shape.dims)))
            if sum(v.size for _, v in held) >= _STEP_VALUES:
                yield dealt()
        if held:
            yield dealt()

    return _dealt(vectors.select("row", "v").mapInArrow(run, _BLOCKS))


def _dealt(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("position", "entry", "salt")


def _members(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, born, entry, rows, points), blocks of one position and age together."""
    by_kind: dict[tuple[int, int], list[int]] = {}
    positions, borns, counts = (batch.column(c).to_pylist() for c in ("position", "born", "n"))
    for i, kind in enumerate(zip(positions, borns)):
        by_kind.setdefault(kind, []).append(i)
    for (position, born), some in sorted(by_kind.items()):
        while some:
            held = stop = 0
            while stop < len(some) and held * width < _STEP_VALUES:
                held += counts[some[stop]]
                stop += 1
            part = batch.take(pa.array(some[:stop]))
            some = some[stop:]
            rows = np.frombuffer(b"".join(part.column("rows").to_pylist()), "<i8")
            points = np.concatenate([_unpack(v) for v in part.column("vals").to_pylist()]).reshape(-1, width)
            yield position, born, np.repeat(part.column("entry").to_numpy(), part.column("n").to_numpy()), rows, points


def _resident(
    batch: pa.RecordBatch, width: int, books: list[np.ndarray]
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Members that never left: later codebooks, but for the last, left them their entry."""
    for position, born, entry, rows, points in _members(batch, width):
        for book in books[born + 1 : -1]:
            stay = nearest(points, book[position])[0] == entry
            entry, rows, points = entry[stay], rows[stay], points[stay]
        yield position, entry, rows, points


def moved(tables: DataFrame, shape: Shape, books: list[np.ndarray]) -> DataFrame:
    """Blocks of members that the last codebooks give another entry, and sums of those that stay."""
    born = len(books) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = _Blocks(shape)
            for position, entry, rows, points in _resident(batch, shape.width, books):
                new = nearest(points, books[-1][position])[0]
                stay = new == entry
                out.sums(position, entry[stay], rows[stay], points[stay])
                out.members(position, born, new[~stay], rows[~stay], points[~stay])
            yield out.batch()

    return _dealt(tables.where("born is not null").mapInArrow(run, _BLOCKS))


def updated(table: DataFrame, shape: Shape, book: np.ndarray) -> np.ndarray:
    """The next codebooks, from sums of the arrivals and of the members that stayed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = _Blocks(shape)
            for position, _, entry, rows, points in _members(batch, shape.width):
                out.sums(position, entry, rows, points)
            yield out.batch()

    arrived = table.where("born is not null").mapInArrow(run, _BLOCKS)
    sums = [F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(shape.width)]
    both = arrived.unionByName(table.where("born is null"))
    out = book.copy()
    for r in both.groupBy("position", "entry").agg(F.sum("n").alias("n"), *sums).collect():
        out[r["position"], r["entry"]] = [r[f"s{j}"] // r["n"] for j in range(shape.width)]
    return out


def assigned(tables: DataFrame, shape: Shape, books: list[np.ndarray]) -> DataFrame:
    """(`row`, `code`, `error`) with the last codebooks."""

    def name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for position, _, rows, points in _resident(batch, shape.width, books):
                order = np.argsort(rows)
                rows = rows[order]
                entry, error = nearest(points[order], books[-1][position])
                for a, b in _runs(rows // GROUP):
                    places = (rows[a:b] % GROUP).astype("<u2").tobytes()
                    out.append((int(rows[a] // GROUP), position, places, entry[a:b].astype(np.uint8).tobytes(), _pack(error[a:b])))
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            columns = list(zip(*out)) or [[]] * len(kinds)
            names = ["range", "position", "places", "entries", "errors"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def together(table: pa.Table) -> pa.Table:
        """At most GROUP vectors, a byte and a sum for each of their parts."""
        codes = np.zeros((GROUP, shape.parts), np.uint8)
        errors, seen = np.zeros(GROUP, np.int64), np.zeros(GROUP, bool)
        for r in table.to_pylist():
            at = np.frombuffer(r["places"], "<u2")
            codes[at, r["position"]] = np.frombuffer(r["entries"], np.uint8)
            errors[at] += _unpack(r["errors"])
            seen[at] = True
        rows = np.flatnonzero(seen)
        text, size = codes[rows].tobytes().hex(), 2 * shape.parts
        texts = [text[i : i + size] for i in range(0, len(text), size)]
        first = table.column("range")[0].as_py() * GROUP
        return pa.table({"row": rows + first, "code": pa.array(texts, pa.string()), "error": errors[rows]})

    named = tables.where("born is not null").mapInArrow(
        name, "range long, position int, places binary, entries binary, errors binary"
    )
    return named.groupBy("range").applyInArrow(together, "row long, code string, error long")


def _text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel().tolist()))


def part_codes(
    df: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(``id_col``, `label`, `code`, `error`) of each kept vector, and the codebooks (position, entry, component)."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry has two hex digits")
    spark = df.sparkSession
    numbers = written(whole_numbers(df, id_col, vector, label, scale), "vectors", "zstd")
    lengths = numbers.where((F.size("v") > 0) & (F.size("v") % parts == 0) & F.col("id").isNotNull())
    first = lengths.orderBy("id", "v").select(F.size("v").alias("n")).first()
    if first is None:
        schema = "row long, code string, error long"
        none = spark.createDataFrame([], schema)
        empty = none.join(numbers.drop("v"), "row").select(F.col("id").alias(id_col), "label", "code", "error")
        return empty, np.zeros((parts, 0, 0), np.int64)
    vectors = numbers.where(F.size("v") == first["n"])
    size = vectors.agg(F.count("*").alias("n"), F.max(F.array_max("v")).alias("most"), F.min(F.array_min("v")).alias("least")).first()
    if max(size["most"], -size["least"]) > LIMIT:
        raise ValueError(f"components beyond {LIMIT // scale} cannot be summed exactly")
    shape = Shape(first["n"], parts, -(-size["n"] // SALT_ROWS))
    books = [first_books(vectors, parts, entries)]
    tables = [written(placed(vectors, shape, books[0]), "residents", "zstd")]
    for r in range(1, rounds + 1):
        books.append(updated(tables[-1], shape, books[-1]))
        if r < rounds:
            at = reduce(DataFrame.unionByName, tables)
            tables.append(written(moved(at, shape, books), "residents", "zstd"))
    codes = assigned(reduce(DataFrame.unionByName, tables), shape, books)
    out = codes.join(vectors.select("row", "id", "label"), "row")
    return out.select(F.col("id").alias(id_col), "label", "code", "error"), books[-1]


def digest(found: DataFrame, books: np.ndarray) -> DataFrame:
    """The columns of the query: errors summed over equal labels, codebooks as one hash."""
    found = written(found, "codes", "zstd")
    key = F.when(F.col("label").isNull(), "null").otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    found = found.withColumn("key", key)
    sums = written(found.groupBy("key").agg(F.sum("error").alias("label_error")), "label-errors")
    return lookup_join(found, sums, "key", "key").select(
        "vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(_text(books).encode()).hexdigest()).alias("codebooks_sha256")
    )


def _round_sql(number: int) -> str:
    """Assignment of all parts to the codebooks of a round, and the codebooks after it."""
    return f"""
, a{number} as materialized (
    select r, p, any_value(x) as x, min(d * 1024 + e) % 1024 as e, min(d * 1024 + e) // 1024 as d
    from (select x.r, x.p, x.x, c.e, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x.x, c.x)])::bigint as d
          from parts x join c{number} c using (p))
    group by r, p
), m{number} as (
    select p, e, j, sum(x[j])::bigint as s, count(*) as n from a{number}, range(1, 5) t(j) group by p, e, j
), n{number} as (
    select p, e, list((s - ((s % n) + n) % n) // n order by j) as x from m{number} group by p, e
), c{number + 1} as materialized (
    select p, e, coalesce(n.x, c.x) as x from c{number} c left join n{number} n using (p, e)
)"""


# Vectors of 64 components, as in the tables: 16 parts of 4.
SQL = f"""
with kept as materialized (
    select row_number() over () as r, vec_id, label, [floor(256 * x::double)::bigint for x in embedding] as v
    from embeddings
    where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), parts as materialized (
    select r, p, v[4 * p + 1 : 4 * p + 4] as x from kept, range(16) t(p)
), least as (
    select row_number() over (order by vec_id) - 1 as e, v from (select vec_id, min(v) as v from kept group by vec_id order by vec_id limit 64)
), c0 as (
    select p, e, v[4 * p + 1 : 4 * p + 4] as x from least, range(16) t(p)
){_round_sql(0)}{_round_sql(1)}{_round_sql(2)}
, codes as (
    select r, string_agg(printf('%02x', e::int), '' order by p) as code, sum(d)::bigint as error from a2 group by r
), book as (
    select sha256(string_agg(x[j]::varchar, ',' order by p, e, j)) as codebooks_sha256 from c2, range(1, 5) t(j)
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from codes join kept using (r), book
"""
