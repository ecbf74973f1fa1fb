"""Journal of lookups: answers that tasks have got, written while they work.

Every task appends small files of answers to a folder of its own, named by its
number, so a task that runs again reads what its last attempt had got. A file is
one batch, a JSON line for each address; a line cut short, by the end of a
worker, does not count.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

import pyarrow.fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.sources.folders import names_in, remove
from logweir.sources.logs import located

_LINE = "cleaned_ip_int bigint, payload string"

Answer = tuple[int, str | None]


def _folder(journal: str, task: int) -> str:
    return f"{journal.rstrip('/')}/task={task}"


def recorded(journal: str, task: int) -> dict[int, str | None]:
    """Answers that earlier attempts of a task have got. Runs in the task."""
    system, folder = located(_folder(journal, task))
    out: dict[int, str | None] = {}
    for file in system.get_file_info(arrow_fs.FileSelector(folder, allow_not_found=True)):
        with system.open_input_stream(file.path) as stream:
            for line in stream.read().splitlines():
                try:
                    entry = json.loads(line)
                    out[entry["cleaned_ip_int"]] = entry["payload"]
                except (ValueError, KeyError, TypeError):
                    continue
    return out


def record(journal: str, task: int, answers: Iterable[Answer]) -> None:
    """Add a batch of answers. Runs in the task."""
    system, folder = located(_folder(journal, task))
    system.create_dir(folder, recursive=True)
    lines = (json.dumps({"cleaned_ip_int": ip, "payload": payload}) + "\n" for ip, payload in answers)
    with system.open_output_stream(f"{folder}/{uuid.uuid4().hex}.json") as stream:
        stream.write("".join(lines).encode())


def read_journal(spark: SparkSession, journal: str) -> DataFrame | None:
    """All answers in the journal, one for each address; None if it is empty."""
    if not any(name.startswith("task=") for name in names_in(spark, journal)):
        return None
    rows = spark.read.schema(_LINE).option("recursiveFileLookup", "true").json(journal)
    # A null answer is an answer; of an address asked twice the one that found something holds.
    return rows.where("cleaned_ip_int is not null").groupBy("cleaned_ip_int").agg(F.max("payload").alias("payload"))


def clear(spark: SparkSession, journal: str) -> None:
    """Forget all answers, once they are stored elsewhere."""
    remove(spark, journal)
