"""Nearest neighbours by inner product, with a forest of sorted hash strings.

Vectors get one more coordinate that makes all norms equal, so that the order
by angle is the order by inner product. Each tree hashes a vector to a long
string of bits: sides of hyperplanes, which are fitted on a bounded sample
(SAMPLE rows with the smallest hashes of their ids; differences of two sample
vectors, made orthogonal, through the median). In every tree the strings are
sorted, so the vectors that share a prefix with a query are one range, found by
two binary searches. A query starts at the longest prefixes and goes up in all
trees at the same time until the ranges hold enough candidates, which is a share
of the table and CANDIDATES at least, so that recall does not fall as the table
grows; how many
vectors share a prefix is known from a table of counts whose depth follows the
number of vectors up to LEVELS (2^LEVELS numbers for each tree at most). All
candidates are compared exactly.

Spark deals entries and queries by tree and by a short common prefix. A group
with too many entries or too many queries (equal vectors, say) is dealt to a
grid of parts, so no task holds an unbounded group. Every part returns the best
of its candidates, and these meet for each query.

Vectors that are null, zero, or hold null or non-finite components take no
part, as do rows without an id. Vectors of another length than most of the
sample take no part. Rows that repeat an id count as one candidate with its
best score. If there are fewer candidates than asked for, all are returned.
Other columns of the table are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweir.llm.common import written

TREES, DEPTH = 32, 24
LEVELS = 15
SAMPLE = 2_000
# Candidates of all trees together that a query looks at, at least: a number, and a share of the table.
CANDIDATES, SHARE = 40_000, 0.8
# Entries and queries of a group that one task compares.
PART_ENTRIES, PART_QUERIES = 8_192, 2_048
_SLACK = 1e-9


@dataclass
class Planes:
    """For each tree and bit a direction in the lengthened space, and an offset."""

    direction: np.ndarray  # trees x bits x (dimensions + 1)
    offset: np.ndarray
    norm: float

    def lengthened(self, x: np.ndarray, query: bool) -> np.ndarray:
        squares = (x * x).sum(axis=1)
        if query:
            return np.column_stack([x * (self.norm / np.sqrt(squares))[:, None], np.zeros(len(x))])
        return np.column_stack([x, np.sqrt(np.maximum(self.norm**2 - squares, 0.0))])

    def codes(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Hash strings as numbers, first bit highest: rows x trees."""
        long = self.lengthened(x, query)
        out = np.zeros((len(x), len(self.direction)), np.int64)
        for t, (direction, offset) in enumerate(zip(self.direction, self.offset, strict=True)):
            out[:, t] = ((long @ direction.T) > offset) @ (1 << np.arange(direction.shape[0] - 1, -1, -1))
        return out


def fit_planes(sample: np.ndarray, norm: float, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> Planes:
    rng = np.random.default_rng(seed)
    planes = Planes(np.zeros((0, 0, 0)), np.zeros((0, 0)), norm)
    long = planes.lengthened(sample, False)
    dims = long.shape[1]
    directions, offsets = [], []
    for _ in range(trees):
        rows: list[np.ndarray] = []
        while len(rows) < depth:
            a, b = long[rng.integers(len(long), size=2)]
            d = a - b if np.linalg.norm(a - b) > 1e-9 * norm else rng.normal(size=dims)
            # Orthogonal to those before, while there is room for that.
            recent = rows[len(rows) - len(rows) % max(1, dims - 1) :]
            for r in recent:
                d = d - (d @ r) * r
            if np.linalg.norm(d) < 1e-6 * norm:
                d = rng.normal(size=dims)
            rows.append(d / np.linalg.norm(d))
        direction = np.array(rows)
        directions.append(direction)
        offsets.append(np.median(long @ direction.T, axis=0))
    planes.direction, planes.offset = np.array(directions), np.array(offsets)
    return planes


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, v, norm of the rows that take part."""
    v = F.col(vector_column).cast("array<double>")
    limit = F.lit(float("inf"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == limit))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))
    return rows.withColumn("norm", norm).where(F.col("norm") > 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(float) if len(column) else np.zeros((0, 0))


def _coded(rows: DataFrame, planes: Planes, query: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            codes = planes.codes(_matrix(batch["v"]), query)
            yield pd.DataFrame({"id": batch["id"], "v": batch["v"], "codes": list(codes)})

    return rows.select("id", "v").mapInPandas(run, "id long, v array<double>, codes array<long>")


def enough(total: int) -> int:
    """Candidates of all trees together that a query needs in a table of ``total`` vectors."""
    return max(CANDIDATES, int(np.ceil(SHARE * total)))


def _levels(queries: DataFrame, starts: np.ndarray, wanted: int, depth: int, levels: int) -> DataFrame:
    """Queries with the level at which all trees together have enough candidates.

    ``starts``: trees x (2^levels + 1), entries whose string begins with a smaller number.
    """
    counted = queries.sparkSession.sparkContext.broadcast(starts)

    def run(batches):
        starts = counted.value
        trees = np.arange(len(starts))
        for batch in batches:
            codes = np.stack(batch["codes"].to_list()) >> (depth - levels)
            level = np.zeros(len(batch), np.int64)
            for x in range(levels + 1):
                low = (codes >> (levels - x)) << (levels - x)
                found = (starts[trees, low + (1 << (levels - x))] - starts[trees, low]).sum(axis=1)
                level = np.where(found >= wanted, x, level)
            yield batch.assign(level=level)

    return queries.mapInPandas(run, "id long, v array<double>, codes array<long>, level long")


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the best k and of all that tie with the last of them up to rounding."""
    other = np.flatnonzero(ids != own)
    if len(other) > k:
        s = scores[other]
        last = np.partition(s, len(s) - k)[len(s) - k]
        other = other[s >= last - _SLACK * max(1.0, abs(last))]
    return other


def _compare(depth: int, k: int):
    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype=float)})
        if not len(queries) or not len(entries):
            return empty
        codes = entries["code"].to_numpy()
        order = np.argsort(codes, kind="stable")
        codes, ids, x = codes[order], entries["id"].to_numpy()[order], _matrix(entries["v"])[order]
        q, qcodes, qids = _matrix(queries["v"]), queries["code"].to_numpy(), queries["id"].to_numpy()
        shift = depth - queries["level"].to_numpy()
        low = (qcodes >> shift) << shift
        at = pd.MultiIndex.from_arrays([low, shift])
        group, kinds = at.factorize()
        out_q, out_v, out_s = [], [], []
        for g, (first, s) in enumerate(kinds):
            begin, end = np.searchsorted(codes, first), np.searchsorted(codes, first + (1 << s))
            if begin == end:
                continue
            mine = np.flatnonzero(group == g)
            scores = q[mine] @ x[begin:end].T
            for row, i in enumerate(mine):
                best = _best(scores[row], ids[begin:end], qids[i], k) + begin
                # The measure itself, component by component, the same wherever the pair meets.
                exact = (x[best] * q[i]).sum(axis=1)
                top = np.lexsort((ids[best], -exact))[:k]
                out_q.append(np.full(len(top), qids[i]))
                out_v.append(ids[best][top])
                out_s.append(exact[top])
        if not out_q:
            return empty
        return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})

    return run


def nearest(
    vectors: DataFrame,
    queries: F.Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    trees: int = TREES,
    depth: int = DEPTH,
    wanted: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best found for rows with ``queries`` (a condition on ``id``).

    ``wanted`` candidates of all trees together end the ascent; without it ``enough`` for the table do.
    """
    empty = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    rows = usable(vectors, id_column, vector_column)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
    if not len(sample):
        return spark.createDataFrame([], empty)
    size = int(sample["v"].map(len).mode().iloc[0])
    rows = rows.where(F.size("v") == size)
    largest = rows.agg(F.max("norm").alias("m")).first()["m"]
    planes = fit_planes(_matrix(sample.loc[sample["v"].map(len) == size, "v"]), float(largest), trees, depth)
    index = written(_coded(rows, planes, False), "index")
    asked = written(_coded(rows.where(queries), planes, True), "queries")
    each = F.posexplode("codes").alias("tree", "code")
    total = index.count()
    wanted = enough(total) if wanted is None else wanted
    levels = int(np.clip(np.ceil(np.log2(max(2.0, trees * total / wanted))) + 2, 2, min(LEVELS, depth)))
    # At most trees x 2^levels rows of three numbers.
    filled = index.select(each).groupBy("tree", F.shiftright("code", depth - levels).alias("code")).count().toPandas()
    starts = np.zeros((trees, (1 << levels) + 1), np.int64)
    np.add.at(starts, (filled["tree"].to_numpy(), filled["code"].to_numpy() + 1), filled["count"].to_numpy())
    leveled = written(_levels(asked, starts.cumsum(axis=1), wanted, depth, levels), "levels")
    lowest = leveled.agg(F.min("level").alias("m")).first()["m"]
    if lowest is None:
        return spark.createDataFrame([], empty)
    # Groups share a prefix that no query's range crosses, and hold about one part.
    short = min(int(lowest), max(0, int(np.floor(np.log2(max(1.0, total / PART_ENTRIES))))))
    cell = F.shiftright("code", depth - short).alias("cell")
    entries = index.select("id", "v", each).select("id", "v", "tree", "code", cell)
    lookups = leveled.select("id", "v", "level", each).select("id", "v", "level", "tree", "code", cell)
    # At most trees x 2^short rows each.
    parts = entries.groupBy("tree", "cell").agg(F.count(F.lit(1)).alias("n")).join(
        lookups.groupBy("tree", "cell").agg(F.count(F.lit(1)).alias("m")), ["tree", "cell"]
    )
    parts = written(
        parts.select("tree", "cell", F.ceil(F.col("n") / PART_ENTRIES).cast("int").alias("n_parts"), F.ceil(F.col("m") / PART_QUERIES).cast("int").alias("q_parts")),
        "parts",
    )
    key = ["tree", "cell", "n_part", "q_part"]
    part_of = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    entries = entries.join(F.broadcast(parts), ["tree", "cell"]).select(
        "id", "v", "code", "tree", "cell", part_of("n_parts", 1).alias("n_part"), every("q_parts").alias("q_part")
    )
    lookups = lookups.join(F.broadcast(parts), ["tree", "cell"]).select(
        "id", "v", "code", "level", "tree", "cell", every("n_parts").alias("n_part"), part_of("q_parts", 2).alias("q_part")
    )
    found = lookups.groupBy(*key).cogroup(entries.groupBy(*key)).applyInPandas(
        _compare(depth, k), "query_id long, vec_id long, score double"
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
