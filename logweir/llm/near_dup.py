"""Near-duplicate texts by ProbMinHash, banding and verification.

Words are lower-cased runs of non-blanks; a text is the set of its windows of
five words (a shorter text is one window). All windows weigh the same, however
often they occur, so that bands follow the measure that decides in the end.
Every window is a Poisson process of arrivals at random slots, at a rate equal
to its weight; a slot keeps its first arrival, so two texts agree in a slot
with probability equal to their probability Jaccard, with equal weights the
Jaccard similarity of the sets. A window stops as soon as
its next arrival comes after the latest first arrival of the text.

Equal word sequences are one text from the start. Slots are grouped in bands;
texts with an equal band share a bucket. A bucket in which few texts are outside
its largest class gives all pairs of these with texts of other classes. In
another one every text is compared with a hub only, later with some hubs more;
a hub is the text that has most company in its buckets, mostly the one in the
middle. Texts that reach a hub are one class with it. All but the hub go on: a
bucket in which few are outside the largest class by then gives their pairs, the
texts of another one go to buckets of finer bands, more and longer ones, in which texts that
merely share a common passage rarely meet, then with other hubs, none of them of
the bucket's largest class, until one class is left in each. No larger bucket is
ever expanded into all pairs. Windows that a text of a large bucket shares with no
other of them bound its similarity to all of these. After the first hub each text
gets a bitmap, in which each of its windows flips a bit: bits that differ between
two texts are windows that one of them lacks, at the least. Pairs, and texts of a
bucket, that these bounds rule out are never compared, and no link is lost by it. Texts that earlier rounds put in one class are not
compared again, nor those whose numbers of windows alone rule out the
similarity. Buckets with the same texts in them count once. A link at the
threshold is missed by bands with a probability of 3 in a million, in a large
bucket by finer bands of 11 in a million; links of closer texts far less often.
Pairs count if the Jaccard similarity of their sets of windows is at least the
threshold. Classes are the connected components of these links.

Every different word sequence has a number of its own, and one row stands for it
in signatures, windows and verification, whatever ids it has and however often.
Ids come back at the end.

Texts that are null or have no word are alone, as is a row without an id that
has no equal text with one. Rows that share an id share a class.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import WORD, chunks, hash_words, mix, spans, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
# Bands and rows for the texts of large buckets: of pairs at the threshold one in 90,000 has no such band in common,
# of pairs with similarity 0.4 one in 370 has one.
FINER = 160, 12
# Texts outside a bucket's largest class whose pairs are all compared.
_ALL_PAIRS = 12
# The same once texts have bitmaps: to compare a text with so many costs no more than its rows of finer bands would.
_ALL_PAIRS_BY_BITS = FINER[0]
# Hubs of a larger bucket: in the first round, in all later ones.
_HUBS = (1, 16)
# Texts whose finer signatures are made in one run of steps.
_AT_ONCE = 256
# Characters of texts in one run: words, windows and signatures of a run are in memory at once.
_RUN_CHARS = 750_000
# Bits of a text's bitmap: windows that fall together hide differences, so that longer texts are bounded less.
_BITS = 2048


def shingles(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Distinct windows of each text: text number, hash, count; and the words of each text."""
    found = [WORD.findall(t.lower()) if t else [] for t in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.array([w for words in found for w in words], dtype=object)
    if not len(flat):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, found
    codes, kinds = pd.factorize(flat)
    words = hash_words(kinds.astype(object))[codes]
    doc, _ = spans(counts)
    windows = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    owner, first = spans(windows)
    begin = spans(counts)[1][owner] + np.arange(len(owner)) - first[owner]
    width = np.minimum(size, counts)[owner]
    key = np.zeros(len(owner), np.uint64)
    for k in range(size):
        at = np.minimum(begin + k, len(words) - 1)
        key = np.where(k < width, mix(key * np.uint64(0x9E3779B97F4A7C15) + words[at] + np.uint64(k + 1)), key)
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))))
    return owner[new], key[new], np.diff(np.append(new, len(key))), found


def prob_minhash(owner: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, slots: int) -> np.ndarray:
    """Signatures of ``n`` weighted sets: for each slot the element that arrives first."""
    first = np.full(n * slots, np.inf)
    sig = np.zeros(n * slots, np.uint64)
    owner_left, key_left, rate = owner, key, weight.astype(float)
    time = np.zeros(len(key))
    step = 0
    while len(key_left):
        step += 1
        bits = mix(key_left + np.uint64(step * 0xD1342543DE82EF95 % 2**64))
        # 53 bits make the waiting time, others the slot.
        time = time - np.log((bits >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54) / rate
        slot = owner_left * slots + (mix(bits ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(slots)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = time == first[slot]
        sig[slot[won]] = key_left[won]
        latest = first.reshape(n, slots).max(axis=1)
        live = time < latest[owner_left]
        owner_left, key_left, rate, time = owner_left[live], key_left[live], rate[live], time[live]
    return sig.reshape(n, slots)


def bands_of(owner: np.ndarray, key: np.ndarray, n: int, n_bands: int, rows: int) -> np.ndarray:
    """Hashes of the bands of ``n`` sets of windows."""
    # Verification is by sets: with weights that grow with the count, repeated lines would part near copies here.
    parts = prob_minhash(owner, key, np.ones(len(key)), n, n_bands * rows).reshape(n, n_bands, rows)
    bands = np.zeros((n, n_bands), np.uint64)
    for r in range(rows):
        bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return bands.view(np.int64)


def bitmaps(owner: np.ndarray, key: np.ndarray, n: int, bits: int = _BITS) -> np.ndarray:
    """Bitmaps of ``n`` sets of windows, in numbers of 64 bits: a bit is set where an odd number of windows falls on it."""
    at = owner * bits + (key % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(at, minlength=n * bits).reshape(n, bits) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def band_hashes(texts: list[str | None], n_bands: int = BANDS, rows: int = ROWS) -> tuple[list[bytes | None], np.ndarray, list[np.ndarray | None]]:
    """Digest of the word sequence, number of different windows and hashes of the bands of each text; None without words."""
    owner, key, _, words = shingles(texts)
    bands = bands_of(owner, key, len(texts), n_bands, rows)
    digests = [hashlib.md5(" ".join(w).encode("utf-8", "surrogatepass")).digest() if w else None for w in words]
    sizes = np.bincount(owner, minlength=len(texts))
    return digests, sizes, [b if w else None for b, w in zip(bands, words, strict=True)]


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, digest, size, bands, text of every row."""

    def run(batches):
        for part in chunks(batches, limit=_RUN_CHARS):
            digests, sizes, bands = band_hashes(part["text"].tolist())
            yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "digest": digests, "size": sizes, "bands": bands, "text": part["text"]})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInPandas(run, "doc_id long, digest binary, size int, bands array<long>, text string")


def _sets(docs: DataFrame) -> DataFrame:
    def run(batches):
        for part in chunks(batches, limit=_RUN_CHARS):
            owner, key, _, _ = shingles(part["text"].tolist())
            ends = np.searchsorted(owner, np.arange(1, len(part)))
            yield pd.DataFrame({"doc_id": part["doc_id"], "windows": np.split(key.view(np.int64), ends)})

    return docs.mapInPandas(run, "doc_id long, windows array<long>")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, sim: Jaccard similarity of the window sets of each pair. ``texts`` has one row for an id."""
    # A written table has a known size, so texts are shuffled only where the ids are too many to broadcast.
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    sets = written(_sets(texts.join(ids, "doc_id", "left_semi")), "windows")
    both = pairs.join(sets.toDF("a", "in_a"), "a").join(sets.toDF("b", "in_b"), "b")
    common = F.size(F.array_intersect("in_a", "in_b"))
    return both.select("a", "b", (common / (F.size("in_a") + F.size("in_b") - common)).alias("sim"))


_MEMBER = ("doc_id", "key", "size", "own", "root")


def _pair(x: str, y: str) -> list[F.Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def own_windows(members: DataFrame, texts: DataFrame) -> DataFrame:
    """doc_id, own: windows that no other of the ``members`` (doc_id) has. Texts without one are left out."""

    def run(batches):
        for part in chunks(batches, limit=_RUN_CHARS):
            owner, key, _, _ = shingles(part["text"].tolist())
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy()[owner], "window": key.view(np.int64)})

    rows = texts.join(members, "doc_id", "left_semi").mapInPandas(run, "doc_id long, window long")
    # Windows of many texts are combined before they meet.
    holders = rows.groupBy("window").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"))
    return holders.where("doc_id = last").groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("own"))


def can_link(x: tuple[str, ...], y: tuple[str, ...], threshold: float) -> F.Column:
    """Whether numbers of windows (all, own) of two texts, and their bitmaps if these are named and known, allow the similarity.

    No own window is in the other text, and no fewer windows are in one text only than bits differ.
    """
    common = F.least(F.col(x[0]) - F.col(x[1]), F.col(y[0]) - F.col(y[1]))
    both = F.col(x[0]) + F.col(y[0])
    # The cheap bound first: bitmaps meet only where it leaves the pair.
    able = common * (1 + threshold) >= threshold * both - 1e-9
    if len(x) > 2:
        differ = F.aggregate(F.zip_with(x[2], y[2], lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, k: n + k)
        able &= (both - F.coalesce(differ, F.lit(0))) / 2 * (1 + threshold) >= threshold * both - 1e-9
    return able


def sketches(members: DataFrame, texts: DataFrame) -> DataFrame:
    """doc_id, bands (the finer ones of texts that are ``hard``, else none), bits (the bitmap) of the ``members`` (doc_id, hard)."""

    def run(batches):
        for part in chunks(batches, limit=_RUN_CHARS):
            for lo in range(0, len(part), _AT_ONCE):
                some = part.iloc[lo : lo + _AT_ONCE]
                owner, key, _, _ = shingles(some["text"].tolist())
                hard = some["hard"].to_numpy(bool)
                of_hard = hard[owner]
                number = np.cumsum(hard) - 1
                finer = iter(bands_of(number[owner[of_hard]], key[of_hard], int(hard.sum()), *FINER) if hard.any() else ())
                bands = [next(finer) if h else np.zeros(0, np.int64) for h in hard]
                yield pd.DataFrame({"doc_id": some["doc_id"], "bands": bands, "bits": list(bitmaps(owner, key, len(some)))})

    rows = texts.join(members.select("doc_id", "hard"), "doc_id")
    return rows.mapInPandas(run, "doc_id long, bands array<long>, bits array<long>")


def similar_pairs(reps: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b, sim for links that connect the same texts as all pairs of at least ``threshold`` do.

    ``reps`` has doc_id, size and bands, one row for each different text.
    """
    members = reps.select("doc_id", "size", F.posexplode("bands").alias("path", "h")).select(
        "doc_id", F.xxhash64("path", "h").alias("key"), "size", F.lit(0).alias("own"), F.col("doc_id").alias("root")
    )
    done: DataFrame | None = None
    roots: DataFrame | None = None
    bits: DataFrame | None = None
    level = 0
    while True:
        many = _HUBS[min(level, len(_HUBS) - 1)]
        sums = (F.sum(F.xxhash64("doc_id", F.lit(k)).cast("decimal(38,0)")).alias(f"who{k}") for k in (1, 2))
        classes = members.groupBy("key", "root").agg(
            F.count(F.lit(1)).alias("of_root"), F.min("size").alias("low"), *sums
        )
        found = classes.groupBy("key").agg(
            F.sum("of_root").alias("n"),
            F.count(F.lit(1)).alias("classes"),
            F.max(F.struct("of_root", "root")).alias("most"),
            F.min("low").alias("low"),
            *(F.sum(who).alias(who) for who in ("who1", "who2")),
        )
        found = found.where("classes > 1").groupBy("n", "who1", "who2")
        found = found.agg(F.min("key").alias("key"), F.first("most").alias("most"), F.first("low").alias("low"))
        buckets = members.join(found.select("key", "n", "most", "low"), "key")
        if bits is None:
            buckets = buckets.withColumn("bits", F.lit(None).cast("array<bigint>"))
        else:
            buckets = buckets.join(bits, "doc_id")
        buckets = written(buckets, "buckets")
        is_small = F.col("n") - F.col("most.of_root") <= (_ALL_PAIRS if bits is None else _ALL_PAIRS_BY_BITS)
        small = buckets.where(is_small).withColumn("other", F.col("root") != F.col("most.root"))
        large = buckets.where(~is_small)
        if level == 0:
            own = own_windows(written(large.select("doc_id").distinct(), "ids"), texts)
            large = large.drop("own").join(written(own, "own"), "doc_id", "left").na.fill(0, ["own"])
        # Texts that may link to one of the size of the bucket's smallest, or of the smallest that can be near them.
        least = F.greatest("low", threshold * F.col("size"))
        large = large.where((F.col("size") - F.col("own")) * (1 + threshold) >= threshold * (F.col("size") + least) - 1e-9)
        large = written(large, "large")
        company = large.groupBy("doc_id").agg(F.sum("n").alias("company"))
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(many))
        central = F.max(F.struct("company", (-F.col("doc_id")).alias("back")))
        # The largest class needs no hub: it is through when all others are.
        hub = ("hub", "hub_root", "hub_size", "hub_own", "hub_bits")
        able = large if level == 0 else large.where(F.col("root") != F.col("most.root"))
        hubs = able.join(company, "doc_id").groupBy("key", slot.alias("slot")).agg((-central["back"]).alias("hub"))
        of_hubs = large.select("key", *(F.col(c).alias(h) for c, h in zip(("doc_id", "root", "size", "own", "bits"), hub, strict=True)))
        hubs = written(hubs.join(of_hubs, ["key", "hub"]).select("key", *hub), "hubs")
        one, two = (
            small.select("key", *(F.col(c).alias(f"{x}_{c}") for c in ("doc_id", "root", "size", "own", "bits", "other"))) for x in "xy"
        )
        pairs = one.where("x_other").join(two, "key").where("x_root <> y_root and (not y_other or x_doc_id < y_doc_id)")
        pairs = pairs.where(can_link(("x_size", "x_own", "x_bits"), ("y_size", "y_own", "y_bits"), threshold)).select(*_pair("x_doc_id", "y_doc_id"))
        met = large.join(hubs, "key").where("root <> hub_root").where(can_link(("size", "own", "bits"), ("hub_size", "hub_own", "hub_bits"), threshold))
        pairs = pairs.union(met.select(*_pair("doc_id", "hub"))).distinct()
        if done is not None:
            pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
        fresh = written(verified(written(pairs, "pairs"), texts), "verified")
        done = fresh if done is None else written(done.union(fresh), "links")
        links = done.where(F.col("sim") >= threshold)
        if hubs.isEmpty():
            return links
        # Texts that are in one class already need no further link between them.
        if roots is None or not fresh.where(F.col("sim") >= threshold).isEmpty():
            roots = components(links).toDF("doc_id", "root")
        # Hubs are through, as they met all of other classes.
        rest = large.select("doc_id", "key", "size", "own")
        rest = rest.join(hubs.select(F.col("hub").alias("doc_id"), "key"), ["doc_id", "key"], "left_anti")
        rest = rest.join(roots, "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
        of_root = rest.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
        mixed = of_root.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), (F.sum("n") - F.max("n")).alias("outside"))
        rest = written(rest.join(mixed.where("classes > 1").select("key", "outside"), "key"), "rest")
        if level == 0:
            hard = F.col("outside") > _ALL_PAIRS_BY_BITS
            once = rest.groupBy("doc_id").agg(*(F.max(c).alias(c) for c in ("size", "own", "root")), F.max(hard).alias("hard"))
            once = written(once, "once")
            fine = written(sketches(once, texts), "finer")
            bits = fine.select("doc_id", "bits")
            # Numbers come to the text, not to each of its bands.
            finer = fine.select("doc_id", "bands").join(once.where("hard"), "doc_id")
            finer = finer.select("doc_id", "size", "own", "root", F.posexplode("bands").alias("path", "h"))
            rest = rest.where(~hard).select(*_MEMBER).union(finer.withColumn("key", F.xxhash64("path", "h")).select(*_MEMBER))
        members = written(rest.select(*_MEMBER), "members")
        level += 1


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node of each connected component, by alternating star contractions.

    Every step costs in proportion to the links; their number does not grow,
    and the number of steps goes with the logarithm of the longest path.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(edges)
    while True:
        # Larger neighbours of each node to its smallest neighbour.
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "edges")
        # Smaller neighbours of each node, and the node, to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m"))
        edges = written(moved.where("u <> v").distinct(), "edges")
        after = state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


def of_equal_ids(sigs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: numbers of different texts that share an id."""
    rows = sigs.where("doc_id is not null and digest is not null").select("doc_id", "digest")
    several = rows.groupBy("doc_id").agg(F.min(F.xxhash64("digest")).alias("low"), F.max(F.xxhash64("digest")).alias("high"))
    rows = rows.join(several.where("low < high").select("doc_id"), "doc_id", "left_semi").distinct()
    own = written(rows.join(texts.select("digest", "number"), "digest").select("doc_id", "number"), "equal-ids")
    first = own.groupBy("doc_id").agg(F.min("number").alias("a"))
    return own.join(first, "doc_id").where("a <> number").select("a", F.col("number").alias("b"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (smallest id of the class), text_id (smallest id with equal words), copies, kept.

    One row for each row of ``docs``. ``copies`` counts rows with equal words;
    ``kept`` marks the rows whose id is that of their class.
    """
    # Rows get their numbers as they are written, so these do not change.
    sigs = written(signatures(docs).withColumn("row", F.monotonically_increasing_id()), "signatures")
    texts = sigs.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("copies"), F.min("row").alias("number")
    )
    texts = written(texts, "texts")
    numbers = texts.where("text_id is not null").select(F.col("number").alias("row"))
    reps = sigs.select("row", "size", "bands").join(numbers, "row", "left_semi").withColumnRenamed("row", "doc_id")
    whole = sigs.select(F.col("row").alias("doc_id"), "text")
    links = similar_pairs(written(reps, "reps"), whole, threshold)
    roots = components(links.select("a", "b").union(of_equal_ids(sigs, texts)))
    named = texts.join(roots.withColumnRenamed("node", "number"), "number", "left")
    named = named.withColumn("root", F.coalesce("root", "number"))
    # Few texts are in a class with others: only those meet for its smallest id.
    nodes = roots.union(roots.select("root", "root").distinct())  # a root is no node of its own there
    least = nodes.join(texts.select(F.col("number").alias("node"), "text_id"), "node").groupBy("root")
    classes = named.join(least.agg(F.min("text_id").alias("least")), "root", "left").select(
        "digest", "text_id", "copies", F.coalesce("least", "text_id").alias("class_id")
    )
    out = sigs.select("doc_id", "digest").join(classes, "digest", "left")
    own = {"class_id": F.col("doc_id"), "text_id": F.col("doc_id"), "copies": F.lit(1).cast("long")}
    out = out.select("doc_id", *(F.coalesce(c, own[c]).alias(c) for c in own))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
