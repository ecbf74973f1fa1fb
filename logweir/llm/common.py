"""What several operators share: words, chunks of texts, tables in the shared folder."""

from __future__ import annotations

import ctypes
import re
import sys
import types
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from logweir.sources.workspace import shared_folder

# A word is a run of anything but ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Characters of text that one numpy step handles at a time; a longer text is a step of its own.
CHUNK_CHARS = 3_000_000


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder's path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write the table to the shared folder and read it back: cuts the lineage. Starts a job."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def process_cache() -> dict:
    """What a worker process keeps from one task to the next.

    Functions travel to tasks by value, so their own globals do not last.
    """
    return sys.modules.setdefault("_logweir_kept", types.ModuleType("_logweir_kept")).__dict__


def give_back() -> None:
    """Return this process's free memory to the system: a worker stays between tasks, and others need the room."""
    pa.default_memory_pool().release_unused()
    # Only glibc keeps what is free, and has the call.
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def chunks(
    batches: Iterable[pd.DataFrame], column: str = "text", limit: int = CHUNK_CHARS
) -> Iterator[pd.DataFrame]:
    """Cut batches into runs of rows with at most ``limit`` characters, or one row. Memory goes back at the end."""
    for batch in batches:
        if not len(batch):
            continue
        sizes = np.fromiter((len(t) if t else 0 for t in batch[column]), np.int64, len(batch))
        ends = np.cumsum(sizes)
        start = 0
        while start < len(batch):
            base = ends[start] - sizes[start]
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.iloc[start:stop].reset_index(drop=True)
            start = stop
    batch = None
    give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads their bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def hash_words(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each string, the same in every process."""
    return pd.util.hash_array(words, categorize=False)


def spans(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes in a row: group of each element, start of each group."""
    starts = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
    return np.repeat(np.arange(len(counts)), counts), starts
