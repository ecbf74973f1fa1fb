"""Wildcard block lists of any size, as an equi join.

:func:`logweir.functions.is_blocked` puts every pattern into the plan, which is
right for some dozens. Here patterns are a table. A URL that fits a pattern holds
all of its literal parts, so it holds each n-gram of them: every pattern is filed
under one n-gram, the one that fewest URLs hold, and only URLs that hold it are
compared with the pattern, by LIKE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.lookup import BROADCAST_BYTES, lookup_join
from logweir.sources.workspace import measured, written

# Characters of an n-gram; shorter literal parts are filed as they are.
GRAM = 5


def like_pattern(pattern: Column, match: str = "part") -> Column:
    """LIKE pattern of a wildcard pattern: `*` stands for any text, the rest for itself."""
    if match not in ("whole", "part"):
        raise ValueError(f"match must be whole or part, not {match!r}")
    escaped = F.replace(F.regexp_replace(pattern, r"([\\%_])", r"\\$1"), F.lit("*"), F.lit("%"))
    return F.concat(F.lit("%"), escaped, F.lit("%")) if match == "part" else escaped


def _grams(text: Column, size: int) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), 1))


def _filed(patterns: DataFrame, urls: DataFrame, gram: int) -> DataFrame:
    """(`gram`, `pattern`): each pattern under its rarest n-gram, the least of equally rare ones.

    A pattern whose literal parts are all shorter is filed under the longest of
    them, one without any under the empty text, which every URL holds.
    """
    parts = F.filter(F.split("pattern", r"\*"), lambda x: F.length(x) > 0)
    long = F.flatten(F.transform(parts, lambda x: _grams(x, gram)))
    longest = F.element_at(F.array_sort(F.transform(parts, lambda x: F.struct(F.length(x).alias("n"), x.alias("part")))), -1)["part"]
    short = F.array(F.when(F.size(parts) > 0, longest).otherwise(F.lit("")))
    keyed = patterns.select("pattern", F.explode(F.when(F.size(long) > 0, long).otherwise(short)).alias("gram"))
    keyed = written(keyed, "pattern-grams")
    # Grams of the URLs are counted for the grams of the patterns only, combined before the shuffle.
    counted = urls.select(F.explode(_grams(F.col("url"), gram)).alias("gram")).groupBy("gram").count()
    rare = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "gram")).alias("best")
    best = keyed.join(counted, "gram", "left").groupBy("pattern").agg(rare)
    return best.select(F.col("best.gram").alias("gram"), "pattern")


def mark_blocked(
    df: DataFrame,
    patterns: DataFrame,
    url: str = "url",
    match: str = "part",
    gram: int = GRAM,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add `blocked`: does any row of ``patterns`` (`pattern`) fit the URL? False for a null URL.

    Equal URLs are compared once. The filed patterns and then the blocked URLs
    are measured; each is broadcast within ``limit`` bytes and shuffled beyond.
    Null patterns fit nothing.
    """
    once = patterns.select("pattern").where("pattern is not null").distinct()
    urls = written(df.select(F.col(url).alias("url")).where("url is not null").distinct(), "urls")
    filed = measured(_filed(once, urls, gram), "filed-patterns")
    sizes = [row["n"] for row in filed.table.select(F.length("gram").alias("n")).distinct().collect()]
    if not sizes:
        return df.withColumn("blocked", F.lit(False))
    # At most `gram` + 1 lengths.
    held = F.concat(*(F.array(F.lit("")) if n == 0 else _grams(F.col("url"), n) for n in sorted(sizes)))
    index = filed.table.withColumnRenamed("gram", "_gram")
    index = F.broadcast(index) if filed.bytes <= limit else index
    pairs = urls.select("url", F.explode(held).alias("gram")).join(index, F.col("gram") == F.col("_gram"))
    fits = pairs.where(F.like(F.col("url"), like_pattern(F.col("pattern"), match)))
    hits = measured(fits.select("url").distinct().withColumn("_hit", F.lit(True)), "blocked")
    table = hits.table.withColumnRenamed("url", "_url")
    joined = lookup_join(df, table, url, "_url", limit, size=hits.bytes)
    return joined.withColumn("blocked", F.coalesce("_hit", F.lit(False))).drop("_hit")
