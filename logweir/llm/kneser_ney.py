"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is one of characters: n-grams of five, for each language. White space
is one space, letters are lower case, digits are zeros. One pass over all texts
gives the different n-grams of the corpus, with their counts in trusted text
(counted in each task before the shuffle). All tables of the model are joins and
groups of these counts, sharded by n-gram: counts of the highest order,
continuation counts below, totals and discounts of each context, and then, from
single characters up, the probability of every n-gram that any text has.

A second pass adds up log probabilities. The table of n-grams is read in shards
of bounded size (SHARD_ROWS), one pass over the texts for each; sums of the
shards are added for each text. A fifth of the trusted texts stays out of the
counts and sets the thresholds: a quantile of their perplexities for each
language.

A null text, or one of white space only, has no perplexity and is not kept.
Texts without a language have a model of their own (`und`). A language without
held-out trusted texts takes the quantile over all; if there are none, or no
trusted text in the language at all, nothing speaks against its texts and they
are kept. Repeated rows give repeated rows. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import chunks, fresh_path, hash_words, mix, spans, written
from logweir.operators.lookup import lookup_join

ORDER = 5
QUANTILE = 0.99
# Kinds of n-gram that a task holds while it scores (12 bytes each), and while it counts.
SHARD_ROWS = 4_000_000
_HELD = 1_500_000
# Characters of text that are counted together, and n-grams that are sent together.
_COUNTED_CHARS = 1_000_000
_SENT = 100_000
_FOLDS = 5


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Normalised characters of all texts in a row, ORDER - 1 spaces before each, and the text of each."""
    lead = " " * (ORDER - 1)
    parts = [(lead + t.lower() if t else lead) for t in texts]
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    doc, starts = spans(np.fromiter(map(len, parts), np.int64, len(parts)))
    lead_at = np.arange(len(points)) - starts[doc] < ORDER - 1
    blank = (points <= 32) | (points == 0x85) | (points == 0xA0) | ((points >= 0x2000) & (points <= 0x200A))
    blank |= np.isin(points, np.array([0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32))
    points[blank] = 32
    points[(points >= 48) & (points <= 57)] = 48
    points[(points >= 0xD800) & (points <= 0xDFFF)] = 0xFFFD
    keep = ~blank | lead_at
    keep[1:] |= blank[1:] & ~blank[:-1]
    return points[keep], doc[keep]


def windows(texts: list[str | None], langs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised characters; for each n-gram the text it is from and where it ends."""
    points, doc = _points(texts)
    _, starts = spans(np.bincount(doc, minlength=len(texts)))
    ends = np.flatnonzero(np.arange(len(points)) - starts[doc] >= ORDER - 1)
    return points, doc[ends], ends


def _keys(points: np.ndarray, ends: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Hashes of language and n-gram."""
    key = lang.astype(np.uint64)
    for k in range(ORDER - 1, -1, -1):
        key = key * np.uint64(0x9E3779B97F4A7C15) + points[ends - k]
    return mix(key)


def _strings(wide: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(wide).view(f"<U{ORDER}").ravel().astype(object)


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, g, c: the n-grams of all texts with their counts in texts marked ``train``."""

    def run(batches):
        # A task holds n-grams as numbers: key, language, characters, count. Strings are made on the way out.
        langs: dict[str, int] = {}
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def total() -> tuple[np.ndarray, ...]:
            key, lang, wide, c = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            kinds, first, which = np.unique(key, return_index=True, return_inverse=True)
            return kinds, lang[first], wide[first], np.bincount(which, c, len(kinds)).astype(np.int64)

        def out(counted: tuple[np.ndarray, ...]):
            names = np.array(list(langs), object)
            _, lang, wide, c = counted
            for at in range(0, len(c), _SENT):
                part = slice(at, at + _SENT)
                yield pd.DataFrame({"lang": names[lang[part]], "g": _strings(wide[part]), "c": c[part]})

        for part in chunks(batches, limit=_COUNTED_CHARS):
            own = part["lang"].to_numpy(object)
            points, doc, ends = windows(part["text"].tolist(), own)
            if not len(ends):
                continue
            number = np.array([langs.setdefault(x, len(langs)) for x in own], np.int32)
            kinds, first, which = np.unique(_keys(points, ends, hash_words(own)[doc]), return_index=True, return_inverse=True)
            counts = np.bincount(which, part["train"].to_numpy(bool)[doc], len(kinds)).astype(np.int64)
            wide = points[ends[first][:, None] - np.arange(ORDER - 1, -1, -1)]
            held.append((kinds, number[doc[first]], wide, counts))
            size += len(kinds)
            if size > _HELD:
                held.append(total())
                size = len(held[0][0])
                if size > _HELD // 2:
                    yield from out(held.pop())
                    size = 0
        if held:
            yield from out(total())

    counted = docs.select("text", "lang", "train").mapInPandas(run, "lang string, g string, c long")
    return counted.groupBy("lang", "g").agg(F.sum("c").alias("c"))


def _discount(c: str, d: str) -> F.Column:
    """The discount of a count of one, of two, of more."""
    return F.when(F.col(c) == 1, F.col(f"{d}1")).when(F.col(c) == 2, F.col(f"{d}2")).otherwise(F.col(f"{d}3"))


def discounts(counts: DataFrame) -> DataFrame:
    """lang, d1, d2, d3+ from the numbers of n-grams seen once to four times; plain halves where they say nothing."""
    seen = [F.sum(F.when(F.col("c") == i, 1).otherwise(0)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    out = counts.groupBy("lang").agg(*seen)
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    ready = (F.col("n1") > 0) & (F.col("n2") > 0)
    columns = []
    for i, known in ((1, ready), (2, ready & (F.col("n3") > 0)), (3, ready & (F.col("n3") > 0) & (F.col("n4") > 0))):
        value = i - (i + 1) * y * F.col(f"n{i + 1}") / F.when(F.col(f"n{i}") > 0, F.col(f"n{i}"))
        columns.append(F.when(known, F.greatest(F.lit(0.0), F.least(F.lit(float(i)), value))).otherwise(F.lit(i / 2)).alias(f"d{i}"))
    return out.select("lang", *columns)


def probabilities(grams: DataFrame) -> DataFrame:
    """lang, g, p for every n-gram of ``grams`` (lang, g, c; c is 0 for those trusted text lacks)."""
    asked = {ORDER: grams.select("lang", "g")}
    counts = {ORDER: grams.where("c > 0")}
    for k in range(ORDER - 1, 0, -1):
        shorter = F.substring("g", 2, k).alias("g")
        asked[k] = asked[k + 1].select("lang", shorter).distinct()
        # How many different characters come before it.
        counts[k] = counts[k + 1].groupBy("lang", shorter).agg(F.count(F.lit(1)).alias("c"))
    kinds = counts[1].groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("kinds"))
    below: DataFrame | None = None
    for k in range(1, ORDER + 1):
        seen = counts[k].join(F.broadcast(discounts(counts[k])), "lang")  # a row for each language
        seen = written(
            seen.select("lang", "g", F.substring("g", 1, k - 1).alias("h"), "c", _discount("c", "d").alias("d")), f"order{k}"
        )
        contexts = seen.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.sum("d").alias("mass"))
        p = asked[k].withColumn("h", F.substring("g", 1, k - 1))
        p = p.join(contexts, ["lang", "h"], "left").join(seen.select("lang", "g", "c", "d"), ["lang", "g"], "left")
        if below is None:
            p = p.join(F.broadcast(kinds), "lang", "left")
            shorter = 1.0 / F.coalesce("kinds", F.lit(2))
        else:
            p = p.withColumn("s", F.substring("g", 2, k - 1)).join(below.toDF("lang", "s", "shorter"), ["lang", "s"])
            shorter = F.col("shorter")
        own = F.coalesce((F.col("c") - F.col("d")) / F.col("total"), F.lit(0.0))
        back = F.coalesce(F.col("mass") / F.col("total"), F.lit(1.0))
        below = written(p.select("lang", "g", (own + back * shorter).alias("p")), f"p{k}")
    return below


def _as_keys(table: DataFrame) -> DataFrame:
    """key, logp: numbers in place of language and n-gram."""

    def run(batches):
        for batch in batches:
            wide = np.array(batch["g"].to_numpy(object), dtype=f"<U{ORDER}").view(np.uint32)
            ends = np.arange(len(batch)) * ORDER + ORDER - 1
            keys = _keys(wide, ends, hash_words(batch["lang"].to_numpy(object)))
            yield pd.DataFrame({"key": keys.view(np.int64), "logp": np.log(batch["p"].to_numpy(float)).astype(np.float32)})

    return table.mapInPandas(run, "key long, logp float")


def _load(path: str) -> tuple[np.ndarray, np.ndarray]:
    """A shard of the table, sorted by key; read by the task itself from the shared folder."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")
    files = [f.path for f in system.get_file_info(fs.FileSelector(place)) if f.path.endswith(".parquet")]
    parts = [pq.ParquetFile(system.open_input_file(f)).read() for f in files]
    keys = np.concatenate([t["key"].to_numpy() for t in parts] or [np.zeros(0, np.int64)]).view(np.uint64)
    logs = np.concatenate([t["logp"].to_numpy() for t in parts] or [np.zeros(0, np.float32)])
    order = np.argsort(keys)
    return keys[order], logs[order]


def _sums(docs: DataFrame, path: str, shard: int) -> DataFrame:
    """doc_id, h, lang, train, calibrate, shard, n, logp: sums over the n-grams of one shard."""

    def run(batches):
        keys, logs = _load(path)
        for part in chunks(batches):
            langs = part["lang"].to_numpy(object)
            points, doc, ends = windows(part["text"].tolist(), langs)
            n, logp = np.zeros(len(part), np.int64), np.zeros(len(part))
            if len(ends) and len(keys):
                which, kinds = pd.factorize(_keys(points, ends, hash_words(langs)[doc]))
                at = np.minimum(np.searchsorted(keys, kinds), len(keys) - 1)
                mine = keys[at] == kinds
                value = np.where(mine, logs[at], 0.0)
                n = np.bincount(doc, mine[which], len(part)).astype(np.int64)
                logp = np.bincount(doc, value[which], len(part))
            out = part[["doc_id", "h", "lang", "train", "calibrate"]].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            out["shard"], out["n"], out["logp"] = shard, n, logp
            yield out

    schema = "doc_id long, h long, lang string, train boolean, calibrate boolean, shard int, n long, logp double"
    return docs.mapInPandas(run, schema)


def perplexities(docs: DataFrame, table: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, lang, train, calibrate, n, perplexity of every row."""
    shards = max(1, -(-table.count() // shard_rows))
    parts = []
    for s in range(shards):
        path = fresh_path(docs.sparkSession, "shard")
        _as_keys(table.where(F.pmod(F.xxhash64("lang", "g"), F.lit(shards)) == s)).write.parquet(path)
        parts.append(written(_sums(docs, path, s), "sums"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    key = ["doc_id", "h", "lang", "train", "calibrate"]
    # Rows that repeat a document have equal sums in every shard.
    once = whole.groupBy(*key, "shard").agg(F.max("n").alias("n"), F.max("logp").alias("logp"), F.count(F.lit(1)).alias("times"))
    out = once.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("logp").alias("logp"), F.max("times").alias("times"))
    out = out.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    perplexity = F.when(F.col("n") > 0, F.exp(-F.col("logp") / F.col("n"))).alias("perplexity")
    return out.select("doc_id", "lang", "train", "calibrate", "n", perplexity)


def classify(
    docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """doc_id, lang, n, perplexity, threshold, kept. ``trusted`` has the doc_id of trusted texts."""
    marks = written(trusted.select(F.col("doc_id").cast("long")).dropna().distinct().withColumn("mark", F.lit(True)), "trusted")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(_FOLDS)) == 0
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
    )
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = lookup_join(rows, marks, "doc_id", "doc_id")
    mark = F.coalesce("mark", F.lit(False))
    held = F.coalesce(held, F.lit(False))
    rows = rows.select("doc_id", "text", "lang", "h", (mark & ~held).alias("train"), (mark & held).alias("calibrate"))
    grams = written(gram_counts(rows), "grams")
    scored = written(perplexities(rows, probabilities(grams), shard_rows), "perplexity")
    sample = scored.where("calibrate and perplexity is not null")
    cut = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
    by_lang = sample.groupBy("lang").agg(cut.alias("own"))
    known = grams.where("c > 0").select("lang").distinct().withColumn("known", F.lit(True))
    overall = sample.agg(cut.alias("p")).first()["p"]
    out = scored.join(F.broadcast(by_lang), "lang", "left").join(F.broadcast(known), "lang", "left")
    threshold = F.when(F.col("known"), F.coalesce("own", F.lit(overall).cast("double"))).alias("threshold")
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select("doc_id", "lang", "n", "perplexity", threshold).withColumn("kept", kept)
