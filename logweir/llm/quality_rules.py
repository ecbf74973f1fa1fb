"""Gradient-boosted trees over document statistics.

Statistics of all texts are computed once and written; the trees are fitted on
a bounded sample of labelled rows (at most ``max_rows``, the smallest hashes of
their ids) and travel to the tasks as flat numpy arrays of nodes. Splits on
features with a constraint keep the score monotonic: more symbols, repeated
lines or repeated words never raise it.

Null and empty texts have no words and fail the base rules. Rows are taken as
they are: repeated ids give repeated rows. Without labels of both kinds there
is nothing to learn, and the base rules alone decide. Other columns of the
tables are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import WORD, chunks, spans, written

SYMBOLS = "#*$%&|<>"
_BLANK = " \t\n\x0b\x0c\r"
_KINDS = (
    SYMBOLS.encode(),
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b".!?",
    b"\n",
    b"|",
)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Feature, and the direction in which the score may move when it grows (0: any).
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols_per_word": -1,
    "dup_lines": -1,
    "repeat_words": -1,
    "distinct_words": 0,
    "upper": 0,
    "digits": 0,
    "sentences_per_word": 0,
    "words_per_line": 0,
    "bars_per_word": -1,
}


def statistics(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (as in COUNTS) and features of each text."""
    texts = ["" if t is None else t for t in texts]
    n = len(texts)
    found = [WORD.findall(t) for t in texts]
    n_words = np.fromiter(map(len, found), np.int64, n)
    flat = np.array([w for words in found for w in words], dtype=object)
    doc, _ = spans(n_words)
    codes, kinds = pd.factorize(flat)
    lengths = np.fromiter(map(len, kinds), np.int64, len(kinds))
    word_chars = np.bincount(doc, lengths[codes], n).astype(np.int64) if len(doc) else np.zeros(n, np.int64)
    distinct = np.zeros(n, np.int64)
    repeat = np.zeros(n, np.int64)
    if len(doc):
        distinct = np.bincount(np.unique(doc * len(kinds) + codes) // len(kinds), minlength=n)
    if len(doc) > 2:
        # Codes are dense, so a pair, then a triple, then a triple of a text fits 64 bits.
        size = len(kinds)
        pair, pairs = pd.factorize(codes[:-2] * np.int64(size) + codes[1:-1])
        triple, triples = pd.factorize(pair * np.int64(size) + codes[2:])
        whole = doc[:-2] == doc[2:]
        at = np.flatnonzero(whole)
        key, _ = pd.factorize(doc[at] * np.int64(len(triples)) + triple[at])
        again = at[np.bincount(key)[key] > 1] if len(at) else at
        covered = np.zeros(len(doc), bool)
        for k in range(3):
            covered[again + k] = True
        repeat = np.bincount(doc[covered], minlength=n)
    dup_lines = np.zeros(n, np.int64)
    for i, text in enumerate(texts):
        if "\n" in text:
            lines = [x for x in text.split("\n") if x.strip(_BLANK)]
            dup_lines[i] = len(lines) - len(set(lines))
    # Bytes of all texts in a row, one more byte after each, so that none is empty.
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
    _, starts = spans(np.fromiter((len(r) + 1 for r in raw), np.int64, n))
    of_kind = []
    for kind in _KINDS:
        member = np.zeros(256, np.int64)
        member[list(kind)] = 1
        of_kind.append(np.add.reduceat(member[data], starts))
    symbols, upper, digits, sentences, breaks, bars = of_kind
    counts = np.column_stack([n_words, word_chars, symbols, dup_lines, repeat]).astype(np.int64)
    w = np.maximum(n_words, 1).astype(float)
    chars = np.maximum(word_chars, 1).astype(float)
    features = np.column_stack(
        [
            np.log1p(n_words), word_chars / w, symbols / w, dup_lines / (breaks + 1.0), repeat / w,
            distinct / w, upper / chars, digits / chars, sentences / w, n_words / (breaks + 1.0), bars / w,
        ]
    )
    return counts, features


@dataclass
class Trees:
    """All trees in flat arrays; a leaf is its own child, so a fixed number of steps ends there."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability that a row is good, all rows and trees at once, level by level."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-total))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    signs: np.ndarray,
    n_trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    n_bins: int = 64,
    least: float = 5.0,
    penalty: float = 1.0,
) -> Trees:
    """Second-order boosting of the log loss on binned features."""
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

    def add() -> int:
        i = len(nodes["value"])
        for name, start in (("feature", 0), ("threshold", 0.0), ("left", i), ("right", i), ("value", 0.0)):
            nodes[name].append(start)
        return i

    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(mean / (1 - mean)))
    roots: list[int] = []
    if len(np.unique(y)) > 1:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
        total = np.full(len(y), base)

        def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
            node = add()
            gs, hs = g[rows].sum(), h[rows].sum()
            best = float(np.clip(gs / (hs + penalty), low, high))
            nodes["value"][node] = rate * best
            if level == 0 or len(rows) < 2 * least:
                return node
            found = None
            for j, cut in enumerate(cuts):
                if not len(cut):
                    continue
                b = binned[rows, j]
                size = len(cut) + 1
                gl = np.cumsum(np.bincount(b, g[rows], size))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], size))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=size))[:-1]
                vl = np.clip(gl / (hl + penalty), low, high)
                vr = np.clip((gs - gl) / (hs - hl + penalty), low, high)
                gain = gl * vl - 0.5 * (hl + penalty) * vl**2 + (gs - gl) * vr - 0.5 * (hs - hl + penalty) * vr**2
                ok = (nl >= least) & (len(rows) - nl >= least)
                if signs[j]:
                    ok &= (vr - vl) * signs[j] >= 0
                gain = np.where(ok, gain, -np.inf)
                k = int(gain.argmax())
                if np.isfinite(gain[k]) and (found is None or gain[k] > found[0]):
                    found = (gain[k], j, k, vl[k], vr[k])
            if found is None or found[0] <= gs * best - 0.5 * (hs + penalty) * best**2 + 1e-9:
                return node
            _, j, k, vl, vr = found
            goes_left = binned[rows, j] <= k
            # Below a split on a constrained feature the sides may not cross its middle.
            middle = (vl + vr) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            for_left, for_right = bounds.get(int(signs[j]), ((low, high), (low, high)))
            nodes["feature"][node], nodes["threshold"][node] = j, float(cuts[j][k])
            nodes["left"][node] = grow(rows[goes_left], g, h, level - 1, *for_left)
            nodes["right"][node] = grow(rows[~goes_left], g, h, level - 1, *for_right)
            return node

        for _ in range(n_trees):
            p = 1.0 / (1.0 + np.exp(-total))
            roots.append(grow(np.arange(len(y)), y - p, p * (1 - p), depth, -np.inf, np.inf))
            one = _flat(nodes, roots[-1:], depth, 0.0)
            p = one.score(x)
            total += np.log(p / (1 - p))
    return _flat(nodes, roots, depth, base)


def _flat(nodes: dict[str, list], roots: list[int], depth: int, base: float) -> Trees:
    whole = {k: np.array(v, dtype=float if k in ("threshold", "value") else np.int64) for k, v in nodes.items()}
    return Trees(**whole, roots=np.array(roots, dtype=np.int64), depth=depth, base=base)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS and FEATURES of every whole text."""

    def run(batches):
        for part in chunks(batches):
            counts, features = statistics(part["text"].tolist())
            out = pd.DataFrame(counts, columns=COUNTS)
            out.insert(0, "doc_id", part["doc_id"].astype("Int64"))
            out[list(FEATURES)] = features
            yield out

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{f} double" for f in FEATURES)])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(run, schema)


def fit_on_labels(stats: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Trees:
    """Fit on at most ``max_rows`` labelled documents, those with the smallest hashes of their ids."""
    sample = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # At most ``max_rows`` pairs of numbers.
    rows = stats.join(F.broadcast(sample), "doc_id").select("quality", *FEATURES).limit(2 * max_rows).toPandas()
    y = (rows["quality"].to_numpy() > 0).astype(float)
    return fit_trees(rows[list(FEATURES)].to_numpy(float), y, np.array(list(FEATURES.values())))


def apply_rules(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = 20_000
) -> DataFrame:
    """Statistics, base rules and verdict of the trees for every row of ``docs``.

    ``base_failed``: under 50 words, or over half of the words in windows of
    three that the text repeats. ``kept``: base rules passed and a score of at
    least ``threshold``.
    """
    stats = written(document_statistics(docs), "statistics")
    trees = fit_on_labels(stats, labels, max_rows)
    names = list(FEATURES)

    def run(batches):
        for batch in batches:
            yield pd.DataFrame(
                {
                    **{c: batch[c] for c in ["doc_id", *COUNTS]},
                    "score": trees.score(batch[names].to_numpy(float)),
                }
            )

    scored = stats.mapInPandas(run, ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "score double"]))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )
