"""Mixing overlapping sources to target weights by a min-cost flow.

A document may belong to several sources. Documents are aggregated by their
membership pattern (the set of their sources); a network routes tokens from
patterns to source quotas. A pattern offers its size once for each repetition,
and each further repetition of a token costs more than the last (k squared for
the k-th), so that the flow spreads repetitions before it deepens them. The
network has one node for each pattern and each source: its size depends on how
many sources there are, not on how many documents.

The tokens that leave a pattern are then turned into documents: whole rounds
over all of them, and for the rest a seeded choice. Rows of a pattern are dealt
to buckets by a keyed hash; buckets are taken in order while they fit, and only
in the bucket where the budget ends (one of BUCKETS of a pattern) groups of rows
of equal id and size are ranked, without their texts. Of the group where it ends
as many rows are taken as fit, and one more row, the one whose size comes
nearest, fills what is missing then. Reruns agree.

A null text has no words: size 0, taken 0. Null sources form a source of their
own, last in order. Repeated rows count as often as they are there. An empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
from itertools import cycle, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweir.llm.common import WORD_PATTERN, written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 2
BUCKETS = 1024


def source_targets(
    sizes: dict[str | None, int], share: float = 1.5, weights: tuple[float, ...] = WEIGHTS, repeats: int = MAX_REPEATS
) -> dict[str | None, float]:
    """Words that each source should give; none above ``repeats`` times its size."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = dict(zip(names, islice(cycle(weights), len(names)), strict=True))
    left = share * sum(sizes.values())
    open_, targets = list(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > repeats * sizes[s]]
        if not full:
            targets |= {s: left * weight[s] / total for s in open_}
            break
        targets |= {s: float(repeats * sizes[s]) for s in full}
        left = max(0.0, left - sum(repeats * sizes[s] for s in full))
        open_ = [s for s in open_ if s not in targets]
    return targets


class Network:
    """Min-cost flow by successive shortest paths with potentials; integer capacities."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        for start, end, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[start].append(len(self.to))
            self.to.append(end)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def flow(self, i: int) -> int:
        return self.room[i ^ 1]

    def solve(self, source: int, sink: int) -> None:
        potential = [0] * len(self.out)
        while True:
            dist: list[float] = [float("inf")] * len(self.out)
            via = [-1] * len(self.out)
            dist[source] = 0
            heap = [(0, source)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > dist[a]:
                    continue
                for i in self.out[a]:
                    step = d + self.cost[i] + potential[a] - potential[self.to[i]]
                    if self.room[i] and step < dist[self.to[i]]:
                        dist[self.to[i]], via[self.to[i]] = step, i
                        heapq.heappush(heap, (step, self.to[i]))
            if via[sink] < 0:
                return
            for a, d in enumerate(dist):
                potential[a] += d if d < float("inf") else dist[sink]
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = self.to[via[at] ^ 1]
            push = min(self.room[i] for i in path)
            for i in path:
                self.room[i] -= push
                self.room[i ^ 1] += push


def route(
    patterns: list[tuple[tuple, int]], targets: dict[str | None, float], repeats: int = MAX_REPEATS
) -> list[dict[str | None, int]]:
    """Tokens from each pattern (its sources, its size) to each of its sources."""
    sources = list(targets)
    number = {s: 2 + len(patterns) + j for j, s in enumerate(sources)}
    net = Network(2 + len(patterns) + len(sources))
    arcs: list[dict[str | None, int]] = []
    for p, (members, size) in enumerate(patterns):
        for k in range(1, repeats + 1):
            net.arc(0, 2 + p, size, k * k)
        arcs.append({s: net.arc(2 + p, number[s], repeats * size, 0) for s in members if s in number})
    for s in sources:
        net.arc(number[s], 1, round(targets[s]), 0)
    net.solve(0, 1)
    return [{s: net.flow(i) for s, i in at.items()} for at in arcs]


def mix(
    docs: DataFrame,
    share: float = 1.5,
    weights: tuple[float, ...] = WEIGHTS,
    repeats: int = MAX_REPEATS,
    seed: int = 42,
    buckets: int = BUCKETS,
) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``copies`` and ``taken`` (copies times size), and the targets.

    Needs columns doc_id, size and sources (array); others pass through. The
    second table has source, target, source_size, one row for each source.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in ("copies", "taken")]
    keyed = docs.select(
        *columns,
        F.to_json(F.array_sort(F.array_distinct("sources"))).alias("_pattern"),
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("size")).alias("_hash"),
    ).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)).cast("int"))
    # At most `buckets` rows for each pattern.
    filled = written(keyed.groupBy("_pattern", "_bucket").agg(F.sum("size").alias("words")), "buckets")
    rows = sorted((r["_pattern"], int(r["words"])) for r in filled.groupBy("_pattern").agg(F.sum("words").alias("words")).collect())
    patterns = [(tuple(json.loads(p)), words) for p, words in rows]
    sizes: dict[str | None, int] = {}
    for members, words in patterns:
        for s in members:
            sizes[s] = sizes.get(s, 0) + words
    # Targets share what there is once, however many sources claim it.
    total = sum(words for _, words in patterns)
    targets = source_targets(sizes, share * total / max(1, sum(sizes.values())), weights, repeats)
    flows = route(patterns, targets, repeats)
    plan = [
        (p, *(divmod(sum(flow.values()), words) if words else (0, 0)))
        for (p, words), flow in zip(rows, flows, strict=True)
    ]
    plan_df = _few_rows(spark, plan, {"_pattern": pa.string(), "rounds": pa.int64(), "rest": pa.int64()})
    # Room left for each bucket once those before it are taken; the rows are few (see above).
    before = F.sum("words").over(Window.partitionBy("_pattern").orderBy("_bucket")) - F.col("words")
    edges = written(
        filled.join(F.broadcast(plan_df), "_pattern").select(
            "_pattern", "_bucket", "rounds", (F.col("rest") - before).alias("room"), "words"
        ),
        "edges",
    )
    inside = (F.col("room") > 0) & (F.col("room") < F.col("words"))
    same = F.struct("_hash", "doc_id", "size")
    # Where the budget ends equal rows count as one group; whole groups are taken in order, of the next one some rows.
    groups = keyed.select("_pattern", "_bucket", same.alias("_same")).join(F.broadcast(edges.where(inside)), ["_pattern", "_bucket"])
    groups = groups.groupBy("_pattern", "room", "_same").agg(F.count(F.lit(1)).alias("n"))
    words = F.col("_same.size") * F.col("n")
    before = F.sum(words).over(Window.partitionBy("_pattern").orderBy("_same")) - words
    next_ = groups.select("_pattern", "_same", "n", (F.col("room") - before).alias("left")).where((F.col("left") >= 0) & (words > F.col("left")))
    ends = next_.groupBy("_pattern").agg(F.min(F.struct("_same", "n", "left")).alias("m")).select(
        "_pattern", F.col("m._same").alias("_end"), F.expr("m.left div m._same.size").alias("_some"), F.expr("m.left % m._same.size").alias("gap")
    )
    ends = written(ends, "ends")  # a row for each pattern at most
    joined = keyed.join(F.broadcast(edges.select("_pattern", "_bucket", "rounds", "room", "words")), ["_pattern", "_bucket"])
    joined = joined.join(F.broadcast(ends), "_pattern", "left").withColumn("_same", same)
    whole = (F.col("room") >= F.col("words")) | (inside & F.coalesce(F.col("_same") < F.col("_end"), F.lit(False)))
    is_end = inside & F.col("_same").eqNullSafe(F.col("_end"))
    # What is missing then is filled by one row more, the one left out whose size comes nearest.
    spare = joined.where(~whole & (F.col("size") > 0)).withColumn("off", F.abs(F.col("gap") - F.col("size"))).where("off < gap")
    spare = spare.groupBy("_pattern", "_same", "off").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(is_end, F.col("_some")).otherwise(0)).alias("used"))
    fills = spare.where("n > used").groupBy("_pattern").agg(F.min(F.struct("off", "_same")).alias("m"))
    fills = written(fills.select("_pattern", F.col("m._same").alias("_fill")), "fills")
    joined = joined.join(F.broadcast(fills), "_pattern", "left")
    is_fill = F.col("_fill").isNotNull() & F.col("_same").eqNullSafe(F.col("_fill"))
    wanted = F.when(is_end, F.col("_some")).otherwise(0) + is_fill.cast("long")
    settled = joined.where(~(is_end | (is_fill & ~whole))).withColumn("_extra", whole.cast("int")).select(*columns, "rounds", "_extra")
    parts = joined.where(is_end | (is_fill & ~whole)).withColumn("_wanted", wanted)
    chosen = settled.unionByName(_some_of(parts.select(*columns, "rounds", "_pattern", "_same", "_wanted")).select(*columns, "rounds", "_extra"))
    copies = (F.col("rounds") + F.col("_extra")).alias("copies")
    mixed = chosen.select(*columns, copies).withColumn("taken", F.col("copies") * F.col("size"))
    goal = [(s, float(t), int(sizes[s])) for s, t in targets.items()]
    return mixed, _few_rows(spark, goal, {"source": pa.string(), "target": pa.float64(), "source_size": pa.int64()})


def _few_rows(spark: SparkSession, rows: list[tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """A table of the driver's rows that is part of the plan: from a list, Spark would start Python workers to read it."""
    values = zip(*rows, strict=True) if rows else ([] for _ in columns)
    return spark.createDataFrame(pa.table({c: pa.array(v, t) for (c, t), v in zip(columns.items(), values, strict=True)}))


def _some_of(parts: DataFrame) -> DataFrame:
    """``parts`` with ``_extra``: 1 for exactly ``_wanted`` rows of each group of equal rows (_pattern, _same)."""
    # Numbered as they are written: the rows of a file are in one task, and only the file where a group's number ends is ranked.
    rows = written(parts.withColumn("_row", F.monotonically_increasing_id()), "parts")
    rows = rows.withColumn("_file", F.shiftright("_row", 33))
    of_file = rows.groupBy("_pattern", "_same", "_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_pattern", "_same").orderBy("_file")) - F.col("_n")
    of_file = written(of_file.select("_pattern", F.col("_same").alias("_of"), "_file", "_n", before.alias("_before")), "part-files")
    # Two groups of a pattern at most, with a row for each task that wrote some.
    here = F.broadcast(of_file.withColumnRenamed("_pattern", "_p").withColumnRenamed("_file", "_f"))
    rows = rows.join(here, (F.col("_pattern") == F.col("_p")) & (F.col("_file") == F.col("_f")) & F.col("_same").eqNullSafe(F.col("_of")))
    left = F.col("_wanted") - F.col("_before")
    cut = (left > 0) & (left < F.col("_n"))
    clear = rows.where(~cut).withColumn("_extra", (left > 0).cast("int"))
    number = F.row_number().over(Window.partitionBy("_pattern", "_same", "_file").orderBy("_row"))
    return clear.unionByName(rows.where(cut).withColumn("_extra", (number <= left).cast("int")))


def word_count(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))
