"""Language of each word by a linear-chain conditional random field, and of each text.

A word is a run of letters, in lower case. Its features are the character
n-grams of length 2 to 4 of the word between two marks (those that touch a mark
are its affixes) and membership in a lexicon of words frequent in the learning
sample. Feature weights and transitions are learned together by maximum
likelihood on sequences cut from the sample, half of them joined from pieces in
different languages, so that the model knows code-switched text. Labels are
posteriors of the forward-backward algorithm over the whole text; a text's
language is the one with the largest sum, its score the share of that sum.

A text that is null or has no letter gets `und` and score 0. Ties go to the
first language by code point. Rows are taken as they are. Without any row to
learn from every text is `und`.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweir.llm.common import chunks, mix, spans


# Letters, digits and underscores; the two below cut the few matches that are not all letters.
_RUNS = re.compile(r"\w+")
_LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
_BUCKETS = 1 << 17
_SPAN = 40
# Words of a text that are handled in one run of steps.
_SEGMENT = 512
# Emissions of this many word kinds are remembered in a task.
_REMEMBERED = 400_000


def words_of(text: str | None) -> list[str]:
    runs = _RUNS.findall(text.lower()) if text else []
    if not runs or "".join(runs).isalpha():
        return runs
    return [w for run in runs for w in ([run] if run.isalpha() else _letters_in(run))]


def _letters_in(run: str) -> list[str]:
    return [w for w in _LETTERS.findall(run) if w.isalpha()]


@dataclass
class Crf:
    langs: list[str]
    weights: np.ndarray  # features x languages
    trans: np.ndarray  # from x to
    first: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)

    def emissions(self, words: list[str]) -> np.ndarray:
        return summed(self.weights, *feature_index(words, self.lexicon), len(words))


def summed(weights: np.ndarray, index: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of the weights of each word's features."""
    return np.column_stack([np.bincount(owner, weights[index, j], n) for j in range(weights.shape[1])])


def feature_index(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Features, and the word that each belongs to."""
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    word, starts = spans(sizes)
    room = (starts + sizes)[word] - np.arange(len(points))  # characters left in the word
    code = points.astype(np.uint64)
    grams, owners = [], []
    key = code
    for n in (2, 3, 4):
        key = key[:-1] * np.uint64(0x1F123BB5) + code[n - 1 :]
        at = np.flatnonzero(room[: len(key)] >= n)
        grams.append(mix(key[at] + np.uint64(n << 56)) % np.uint64(_BUCKETS))
        owners.append(word[at])
    known = np.fromiter((lexicon.get(w, -1) for w in words), np.int64, len(words))
    listed = np.flatnonzero(known >= 0)
    grams.append(_BUCKETS + known[listed])
    owners.append(listed)
    return np.concatenate([g.astype(np.int64) for g in grams]), np.concatenate(owners)


def posteriors(emit: np.ndarray, counts: np.ndarray, model: Crf) -> np.ndarray:
    """Posteriors of each word, for texts of these lengths (1 at least) in a row.

    Texts are cut into segments that run side by side: step t handles word t of
    every segment that has one. A first pass multiplies the transfer matrices of
    each segment; with them the messages at segment edges follow, and a forward
    and a backward pass start from those. The result is that of one pass over
    each whole text.
    """
    k = emit.shape[1]
    scaled = np.exp(np.maximum(emit - emit.max(axis=1, keepdims=True), -30.0))
    move = np.exp(model.trans - model.trans.max())
    per_text = -(-counts // _SEGMENT)
    text, firsts = spans(per_text)
    rank = np.arange(len(text)) - firsts[text]
    lengths = np.minimum(_SEGMENT, counts[text] - rank * _SEGMENT)
    begins = spans(counts)[1][text] + rank * _SEGMENT
    order = np.argsort(-lengths, kind="stable")
    begin, length = begins[order], lengths[order]
    active = np.searchsorted(-length, -np.arange(int(length[0])), side="left")  # segments longer than t

    # Transfer matrices, for texts of several segments.
    joined = np.flatnonzero(per_text[text] > 1)
    joined = joined[np.argsort(-lengths[joined], kind="stable")]
    product = np.broadcast_to(np.eye(k), (len(joined), k, k)).copy()
    for t in range(int(lengths[joined[0]]) if len(joined) else 0):
        n = int(np.searchsorted(-lengths[joined], -t, side="left"))
        now = product[:n].reshape(-1, k) @ move
        now = now.reshape(n, k, k) * scaled[begins[joined[:n]] + t][:, None, :]
        if t % 8 == 7:
            now /= now.max(axis=(1, 2), keepdims=True)
        product[:n] = now
    place = np.zeros(len(text), np.int64)
    place[joined] = np.arange(len(joined))

    # Messages at the edges: into each segment from the left, and from the right.
    left, right = np.empty((len(text), k)), np.ones((len(text), k))
    # The first word has start weights and no transition; a state that the transition turns into them.
    start = np.linalg.lstsq(move.T, np.exp(model.first - model.first.max()), rcond=None)[0]
    most = int(per_text.max())
    left[firsts] = start
    for r in range(1, most):
        at = firsts[per_text > r] + r
        step = np.einsum("ij,ijk->ik", left[at - 1], product[place[at - 1]])
        left[at] = step / np.abs(step).max(axis=1, keepdims=True)
    for r in range(most - 2, -1, -1):
        at = firsts[per_text > r + 1] + r
        step = np.einsum("ijk,ik->ij", product[place[at + 1]], right[at + 1])
        right[at] = step / step.max(axis=1, keepdims=True)

    forward = np.empty_like(scaled)
    state = left[order]
    for t, n in enumerate(active):
        at = begin[:n] + t
        state = (state[:n] @ move) * scaled[at]
        if t % 8 == 7:
            state /= state.max(axis=1, keepdims=True)
        forward[at] = state
    back = right[order]
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        now = back[:n]
        forward[at] *= now
        now = (now * scaled[at]) @ move.T
        if t % 8 == 0:
            now /= now.max(axis=1, keepdims=True)
        back[:n] = now
    np.maximum(forward, 0.0, out=forward)
    return forward / forward.sum(axis=1, keepdims=True)


def _sequences(texts: list[tuple[str, str]], langs: list[str], per_lang: int, rng) -> list[tuple[list, list]]:
    """Word and label sequences of length _SPAN: from one text, and joined from several."""
    pools = {g: [words_of(t) for t, h in texts if h == g] for g in langs}
    pools = {g: [w for w in pool if w] for g, pool in pools.items()}
    langs = [g for g in langs if pools[g]]

    def cut(g: str, n: int) -> list[str]:
        words = pools[g][rng.integers(len(pools[g]))]
        at = int(rng.integers(max(1, len(words) - n + 1)))
        return words[at : at + n]

    out = []
    for g in langs:
        for k in range(per_lang):
            words: list[str] = []
            labels: list[str] = []
            while len(words) < _SPAN:
                use = g if k % 2 == 0 or not words else langs[rng.integers(len(langs))]
                piece = cut(use, _SPAN - len(words) if k % 2 == 0 else min(int(rng.integers(4, 16)), _SPAN - len(words)))
                words += piece
                labels += [use] * len(piece)
            out.append((words, labels))
    return [out[i] for i in rng.permutation(len(out))]


def fit_crf(
    texts: list[tuple[str, str]], per_lang: int = 600, epochs: int = 4, rate: float = 0.3, seed: int = 7
) -> Crf:
    """Learn from (text, language) pairs by stochastic gradient with a step size per weight."""
    rng = np.random.default_rng(seed)
    langs = sorted({g for t, g in texts if words_of(t)})
    k = len(langs)
    counted: dict[str, int] = {}
    for text, _ in texts:
        for w in words_of(text):
            counted[w] = counted.get(w, 0) + 1
    frequent = sorted((w for w, c in counted.items() if c >= 20), key=lambda w: (-counted[w], w))[:20_000]
    model = Crf(langs, np.zeros((_BUCKETS + len(frequent), k)), np.zeros((k, k)), np.zeros(k), {w: i for i, w in enumerate(frequent)})
    if k < 2:
        return model
    data = _sequences(texts, langs, per_lang, rng)
    code = {g: i for i, g in enumerate(langs)}
    seen = [np.full_like(a, 1e-3) for a in (model.weights, model.trans, model.first)]
    for _ in range(epochs):
        for lo in range(0, len(data), 128):
            batch = data[lo : lo + 128]
            words, kinds = pd.factorize(np.array([w for s, _ in batch for w in s], dtype=object))
            index, owner = feature_index(list(kinds), model.lexicon)
            emit = summed(model.weights, index, owner, len(kinds))
            b = len(batch)
            x = emit[words].reshape(b, _SPAN, k)
            y = np.array([[code[g] for g in labels] for _, labels in batch])
            forward, back = np.zeros((b, _SPAN, k)), np.zeros((b, _SPAN, k))
            forward[:, 0] = x[:, 0] + model.first
            for t in range(1, _SPAN):
                forward[:, t] = _logsum(forward[:, t - 1, :, None] + model.trans, 1) + x[:, t]
                back[:, -1 - t] = _logsum(model.trans + (x[:, _SPAN - t] + back[:, _SPAN - t])[:, None, :], 2)
            whole = _logsum(forward[:, -1], 1)[:, None, None]
            expected = np.exp(forward + back - whole)
            pairs = np.exp(
                forward[:, :-1, :, None] + model.trans + (x[:, 1:] + back[:, 1:])[:, :, None, :] - whole[..., None]
            ).sum((0, 1))
            gold = np.eye(k)[y]
            gold_pairs = np.zeros((k, k))
            np.add.at(gold_pairs, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            of_kind = np.zeros((len(kinds), k))
            np.add.at(of_kind, words, (gold - expected).reshape(-1, k))
            used, at = np.unique(index, return_inverse=True)
            of_feature = summed(of_kind, owner, at, len(used))
            grads = (of_feature / b - 1e-4 * model.weights[used], (gold_pairs - pairs) / b, (gold[:, 0] - expected[:, 0]).mean(0))
            for a, s, g, rows in zip((model.weights, model.trans, model.first), seen, grads, (used, slice(None), slice(None)), strict=True):
                s[rows] += g**2
                a[rows] += rate * g / np.sqrt(s[rows])
    return model


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def learning_sample(docs: DataFrame, per_lang: int = 200, max_chars: int = 20_000) -> list[tuple[str, str]]:
    """At most ``per_lang`` rows of a language, those with the smallest hashes of their ids, then of their texts.

    Of a text above ``max_chars`` a window of that many characters is taken, at
    a place that its id decides. Only hashes are ranked; texts come for the rows chosen.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    room = F.greatest(F.length("text") - F.lit(max_chars), F.lit(0)) + 1
    usable = usable.select("lang", "text", F.xxhash64(F.col("doc_id").cast("string")).alias("h"), F.xxhash64("text").alias("t"), room.alias("room"))
    ranked = usable.select("lang", "h", "t").withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "t")))
    chosen = ranked.where(F.col("n") <= per_lang).groupBy("lang", "h", "t").agg(F.count(F.lit(1)).alias("times"))
    # Rows of equal id and text are one row here, so no more come to the driver than were chosen.
    piece = F.substr("text", F.pmod("h", "room").cast("int") + 1, F.lit(max_chars))
    rows = (
        usable.join(F.broadcast(chosen), ["lang", "h", "t"])  # per_lang rows for each language
        .select("lang", "h", "t", "times", piece.alias("text"))
        .groupBy("lang", "h", "t", "times")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    rows = sorted(rows, key=lambda r: (r["lang"], r["h"], r["t"]))
    return [(r["text"], r["lang"]) for r in rows for _ in range(r["times"])]


def label_texts(texts: list[str | None], model: Crf, memory: dict) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and shares of each text. ``memory`` keeps emissions of words seen before."""
    n, k = len(texts), len(model.langs)
    found = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, found), np.int64, n)
    if not counts.sum() or not k:
        return [UNKNOWN] * n, np.zeros(n), np.zeros((n, k))
    flat = list(chain.from_iterable(found))
    if len(memory.get("known", ())) > _REMEMBERED:
        memory.clear()
    known: dict[str, int] = memory.setdefault("known", {})
    table = memory.setdefault("table", np.zeros((0, k)))
    new = sorted(set(flat).difference(known))
    if new:
        parts = [table, *(model.emissions(new[i : i + 50_000]) for i in range(0, len(new), 50_000))]
        known.update(zip(new, range(len(table), len(table) + len(new)), strict=True))
        memory["table"] = table = np.concatenate(parts)
    at = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
    some = np.flatnonzero(counts)
    post = posteriors(table[at], counts[some], model)
    sums = np.add.reduceat(post, spans(counts[some])[1], axis=0)
    shares = np.zeros((n, k))
    shares[some] = sums / counts[some][:, None]
    best = shares.argmax(axis=1)
    score = np.clip(shares[np.arange(n), best], 0.0, 1.0)
    langs = [model.langs[b] if c else UNKNOWN for b, c in zip(best, counts, strict=True)]
    return langs, score, shares


def identify(docs: DataFrame, model: Crf) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone."""
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    kept = docs.select(*columns)

    def run(batches):
        memory: dict = {}
        for part in chunks(batches):
            langs, score, _ = label_texts(part["text"].tolist(), model, memory)
            part["lang_pred"], part["score"] = langs, score
            yield part

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInPandas(run, f"{schema}, lang_pred string, score double")


def held_out() -> F.Column:
    """Documents that the model never sees: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def learn_language_model(docs: DataFrame, per_lang: int = 200) -> Crf:
    return fit_crf(learning_sample(docs.where(~held_out()), per_lang))
