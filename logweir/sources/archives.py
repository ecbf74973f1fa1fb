"""Log files of a table: one file for each day, CSV, gzip or ZIP, written by tasks.

Rows are dealt by day and sorted by it within a task, so a task writes one file
after another, in blocks, and holds one block of rows. A file is written aside
and then moved, so there is no half of one, and a task that runs again replaces
what it wrote before.
"""

from __future__ import annotations

import gzip
import posixpath
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import ExitStack
from typing import IO

import pyarrow as pa
import pyarrow.csv as arrow_csv
import pyarrow.fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions.links import file_name
from logweir.sources.logs import located

KINDS = ("csv", "csv.gz", "zip")
_FILES = "log_date date, path string, rows bigint, bytes bigint"


class _File:
    """A log file that is being written."""

    def __init__(self, folder: str, name: str, kind: str, schema: pa.Schema):
        self.system, self.folder = located(folder)
        self.system.create_dir(self.folder, recursive=True)
        self.path = posixpath.join(folder, name)
        self.final = posixpath.join(self.folder, name)
        self.aside = posixpath.join(self.folder, f"_{uuid.uuid4().hex}")
        self.rows = 0
        with ExitStack() as stack:
            raw = stack.enter_context(self.system.open_output_stream(self.aside))
            plain = stack.enter_context(_packed(stack, raw, name, kind))
            # Nulls are missing values, texts are in quotes, so that an empty one is not null.
            options = arrow_csv.WriteOptions(quoting_style="needed", quoting_header="none")
            self.writer = stack.enter_context(arrow_csv.CSVWriter(plain, schema, write_options=options))
            self.open = stack.pop_all()

    def write(self, batch: pa.RecordBatch) -> None:
        self.writer.write_batch(batch)
        self.rows += batch.num_rows

    def close(self) -> int:
        """Put the file in its place; returns its size."""
        self.open.close()
        if not isinstance(self.system, arrow_fs.LocalFileSystem):
            if self.system.get_file_info(self.final).type == arrow_fs.FileType.File:
                self.system.delete_file(self.final)
        self.system.move(self.aside, self.final)
        return self.system.get_file_info(self.final).size


def _packed(stack: ExitStack, raw: IO[bytes], name: str, kind: str) -> IO[bytes]:
    if kind == "csv":
        return raw
    if kind == "csv.gz":
        return gzip.GzipFile(fileobj=raw, mode="wb", mtime=0)
    archive = stack.enter_context(zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED))
    member = zipfile.ZipInfo(f"{name.partition('.')[0]}.csv")
    member.compress_type = zipfile.ZIP_DEFLATED
    return archive.open(member, "w", force_zip64=True)


def write_logs(df: DataFrame, folder: str, kind: str = "csv") -> DataFrame:
    """Write each `log_date` as `logYYYYMMDD` of the kind; returns the files, already written.

    A ZIP archive has one member. Columns keep their order, `log_date` is not
    among them. Rows without a day are an error: no file could take them.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}, not {kind!r}")
    names = [name for name in df.columns if name != "log_date"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        day, file = None, None

        def done() -> pa.RecordBatch:
            columns = [[day], [file.path], [file.rows], [file.close()]]
            kinds = [pa.date32(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["log_date", "path", "rows", "bytes"]
            )

        for batch in batches:
            days = batch.column("log_date")
            start = 0
            while start < batch.num_rows:
                if days[start].as_py() is None:
                    raise ValueError("a row has no log_date")
                stop = start + 1
                while stop < batch.num_rows and days[stop] == days[start]:
                    stop += 1
                if file is None or days[start].as_py() != day:
                    if file is not None:
                        yield done()
                    day = days[start].as_py()
                    fields = [batch.schema.field(n) for n in names]
                    file = _File(folder, batch.column("_name")[start].as_py(), kind, pa.schema(fields))
                file.write(batch.select(names).slice(start, stop - start))
                start = stop
        if file is not None:
            yield done()

    named = df.withColumn("_name", file_name(F.col("log_date"), f".{kind}"))
    dealt = named.repartition("log_date").sortWithinPartitions("log_date")
    written = dealt.mapInArrow(run, _FILES)
    rows = written.collect()  # one for each day
    return df.sparkSession.createDataFrame(rows, _FILES)
