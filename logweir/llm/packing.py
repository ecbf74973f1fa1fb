"""Concatenate and cut: documents as token ids in one long row, cut into fixed windows.

Pass one encodes every document once and writes its ids (two bytes each) with
the running count inside its partition. The totals of the partitions (one row
for each task) give the ids before each partition by a prefix sum, so every
document knows its place in the whole row without any global sort. Pass two
reads the ids back, cuts at multiples of the window and writes a record for
each piece; a document that crosses a boundary has a piece on either side.

Only the last window can be short; it ends where the ids end. Null and empty
texts are the closing id alone. Rows are taken as they are: repeated rows are
packed again. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from itertools import accumulate, chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import chunks, process_cache, spans, written

WINDOW = 1024
CLOSE = 0
# Texts with characters from here on are encoded whole by the library.
_TABLE_END = 0x0590
# Words and pieces, and characters of them, that a worker remembers; twice as many with those met before.
_REMEMBERED = 600_000
_REMEMBERED_CHARS = 12_000_000
# Signs that end a word; after letters each is a piece.
_SIGNS = frozenset(".,;:!?")
# Put before each place where a text is cut; no text that is cut has it.
_MARK = "\x1f"
# White space that a cut before its space or line feed would change.
_RUN = re.compile(r"[ \n](?<=\s.)(?:\s|\Z)", re.S)


def _class(kinds: str) -> str:
    return "".join(
        re.escape(chr(i)) for i in range(_TABLE_END) if unicodedata.category(chr(i))[0] in kinds
    )


def _pieces_pattern() -> re.Pattern:
    """The published split of byte-level BPE, with classes of characters below _TABLE_END written out.

    Fixed value: the shape of the split is that of the vocabulary.
    """
    letter, number = _class("L"), _class("N")
    space = "".join(re.escape(chr(i)) for i in range(_TABLE_END) if chr(i).isspace() and not 0x1C <= i <= 0x1F)
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


class _Words(dict):
    """Ids of words and of pieces, as bytes. A word without any gets an empty row, which ``new`` has until it is filled."""

    def __init__(self, earlier: dict[str, bytes]):
        super().__init__()
        self.earlier = earlier
        self.new: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytes | bytearray:
        self[word] = ids = self.earlier.get(word)
        if ids is None:
            self[word] = self.new[word] = ids = bytearray()
        return ids


class Encoder:
    """Ids of texts, with the ids of words and pieces remembered.

    The vocabulary splits a text into pieces before any merge, and a piece alone
    gives the ids it gives inside a text. No piece goes on from anything else into
    white space, so a text is cut before its spaces and line feeds, into words of
    some pieces each, unless one stands within a run of white space. Texts with
    special tokens, unassigned or further characters go to the library as a whole,
    and so do all texts if the vocabulary is not one of byte-level BPE.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.kind = "<u4" if size > 1 << 16 else "<u2"
        self.raw = [i.tobytes() for i in np.arange(size, dtype=self.kind)]
        self.pieces = _pieces_pattern()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        simple = "".join(
            chr(i) for i in range(_TABLE_END) if unicodedata.category(chr(i)) not in ("Cn", "Cs") and not 0x1C <= i <= 0x1F
        )
        self.odd = re.compile(f"[^{re.escape(simple)}]")
        # How the vocabulary writes the bytes of each character.
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # Other vocabularies split or change texts in ways of their own.
        own = self.tokenizer.pre_tokenizer
        self.published = (
            self.tokenizer.normalizer is None
            and isinstance(own, pre_tokenizers.ByteLevel) and own.use_regex and not own.add_prefix_space
        )
        self.letters = {ord(c): level.pre_tokenize_str(c)[0][0] for c in simple}
        self.known = _Words({})
        self.chars = 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, text: str) -> list[str]:
        if _RUN.search(text):
            return self.pieces.findall(text)
        return text.replace(" ", f"{_MARK} ").replace("\n", f"{_MARK}\n").split(_MARK)

    def _learn(self) -> None:
        """New words get their ids by their pieces, and these by the vocabulary's merges."""
        known, new = self.known, self.known.new
        if not new:
            return
        pieces, words = [], {}
        for w in new:
            # Letters after a space or a letter are one piece, a sign after them another.
            plain = w[:1] == " " or w[:1].isalpha()
            if plain and w[1:].isalpha():
                pieces.append(w)
            elif plain and w[-1] in _SIGNS and w[1:-1].isalpha():
                words[w] = (w[:-1], w[-1])
            elif len(parts := self.pieces.findall(w)) == 1:
                pieces.append(w)
            else:
                words[w] = parts
        pieces += [p for p in set(chain.from_iterable(words.values())) if p not in known and p not in known.earlier]
        merge, raw = self.tokenizer.model.tokenize, self.raw
        spelt = _MARK.join(pieces).translate(self.letters).split(_MARK) if pieces else []
        known.update(zip(pieces, [b"".join([raw[t.id] for t in merge(x)]) for x in spelt], strict=True))
        known.update((w, b"".join([known[p] for p in parts])) for w, parts in words.items())
        for w, row in new.items():
            row += known[w]
        self.chars += sum(map(len, pieces)) + sum(map(len, words))
        new.clear()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > _REMEMBERED or self.chars > _REMEMBERED_CHARS:
            self.known.earlier = {}
            self.known, self.chars = _Words(self.known), 0
        plain = [self.published and not self.odd.search(t) and not any(s in t for s in self.special) for t in texts]
        found = [list(map(self.known.__getitem__, self._cut(t))) for t, p in zip(texts, plain, strict=True) if p]
        self._learn()
        ids = (np.frombuffer(b"".join(rows), self.kind) for rows in found)
        rest = iter(self._whole([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [next(ids if p else rest) for p in plain]


def kept_encoder(path: str) -> Encoder:
    """The encoder of a worker process, with the pieces that its earlier tasks have met."""
    kept = process_cache()
    if ("encoder", path) not in kept:
        kept["encoder", path] = Encoder(path)
    return kept["encoder", path]


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """part, before (ids of the partition before this row), doc_id, n_tokens, ids (two bytes each)."""

    def run(batches):
        from pyspark import TaskContext

        encoder = kept_encoder(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        close = np.array(CLOSE, encoder.kind).tobytes()
        for rows in chunks(batches):
            ids = [x.tobytes() + close for x in encoder.encode([t or "" for t in rows["text"]])]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // len(close)
            yield pd.DataFrame(
                {
                    "part": part,
                    "before": before + spans(sizes)[1],
                    "doc_id": rows["doc_id"].astype("Int64"),
                    "n_tokens": sizes,
                    "ids": ids,
                }
            )
            before += int(sizes.sum())

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInPandas(run, "part int, before long, doc_id long, n_tokens long, ids binary")


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """A record for each piece: where it lies in its document and in its sequence, and its checksum."""
    ids = written(encoded(docs, tokenizer), "ids", compression="zstd")
    # One row for each partition that has documents.
    totals = sorted((r["part"], r["n"]) for r in ids.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    bases = dict(zip((p for p, _ in totals), accumulate((n for _, n in totals), initial=0), strict=False))

    def cut(batches):
        for rows in batches:
            columns: dict[str, list] = {c: [] for c in _PIECE}
            for part, before, doc, n, raw in rows.itertuples(index=False):
                whole = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                place = bases[part] + before
                start = 0
                while start < n:
                    at = place + start
                    length = min(n - start, window - at % window)
                    piece = (
                        None if doc is pd.NA or doc != doc else int(doc), start, length,
                        zlib.crc32(whole[start : start + length].tobytes()), int(n), at // window, at % window,
                    )
                    for c, v in zip(_PIECE, piece, strict=True):
                        columns[c].append(v)
                    start += length
            out = pd.DataFrame(columns)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return ids.mapInPandas(cut, ", ".join(f"{c} long" for c in _PIECE))


_PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def tokens_of(pieces: DataFrame) -> DataFrame:
    """Ids in each sequence."""
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
