"""Raw log files: CSV, and CSV in ZIP archives. One file holds one day.

Files of one load may have headers of their own. Tasks read the headers, files
with equal ones are read together, and the table has the columns of all of
them, null where a file lacks one.
"""

from __future__ import annotations

import csv
import gzip
import io
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import IO
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
import pyarrow.csv as arrow_csv
import pyarrow.fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from logweir.functions.links import date_from_link
from logweir.operators.columns import merged_schema, union_of
from logweir.schemas import IP_RANGES, log_schema

Opener = Callable[[str], IO[bytes]]

_PATH = "_log_path"
# Bytes that are decoded at a time: a task holds some ten times as much. A row has to fit into
# a block; only where one does not, larger ones are taken.
_BLOCK_BYTES = (1024 * 1024, 8 * 1024 * 1024)


def raw_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder as (`link`, `pos`), newest last. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(F.col("path").alias("link"), F.unix_micros("modificationTime").alias("pos"))
    )


def _listed(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files that paths stand for, in the order of the paths."""
    if not isinstance(paths, str):
        return list(paths)
    files = spark.read.format("binaryFile").load(paths).select("path").collect()
    return sorted(row["path"] for row in files)


def _sizes(spark: SparkSession, files: list[str]) -> dict[str, tuple[int, str]]:
    """What files are sorted by: the larger first, then by path."""
    listed = spark.read.format("binaryFile").load(files).select("path", "length").collect()
    lengths = {unquote(urlsplit(row["path"]).path): row["length"] for row in listed}
    return {path: (-lengths.get(unquote(urlsplit(path).path), 0), path) for path in files}


def headers(
    spark: SparkSession, paths: list[str], header_of: Callable[[str], list[str]]
) -> dict[tuple[str, ...], list[str]]:
    """Files by header, in their order. Headers are read side by side, in tasks."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [header_of(path) for path in batch.column("path").to_pylist()]
            names = pa.array(found, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("at"), names], names=["at", "names"])

    listed = spark.createDataFrame(list(enumerate(paths)), "at int, path string")
    tasks = min(len(paths), 4 * spark.sparkContext.defaultParallelism)
    rows = listed.repartition(tasks, "at").mapInArrow(read, "at int, names array<string>").collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(rows, key=lambda r: r["at"]):
        groups.setdefault(tuple(row["names"]), []).append(paths[row["at"]])
    return groups


def csv_header(path: str, opener: Opener) -> list[str]:
    """Names in the first line of a CSV file, which may be packed with gzip."""
    with opener(path) as file:
        packed = path.endswith(".gz")
        with gzip.open(file) if packed else io.BufferedReader(file) as plain:
            text = io.TextIOWrapper(plain, encoding="utf-8", newline="")
            return next(csv.reader(text), [])


def read_csv_logs(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | None = None,
    types: Mapping[str, T.DataType] | None = None,
    opener: Opener | None = None,
) -> DataFrame:
    """CSV logs with a header line, plus `log_date` from the file name.

    Without ``schema`` each file has the columns of its own header (``types``
    as in :func:`logweir.schemas.log_schema`); with it, another header fails
    the load, as a value of the wrong type always does. Large files are read by
    many tasks, so quoted values must not hold line breaks.
    """
    if schema is not None:
        return _read_csv(spark, paths, schema)
    open_ = opener or open_path
    groups = headers(spark, _listed(spark, paths), lambda path: csv_header(path, open_))
    return union_of([_read_csv(spark, some, log_schema(names, types)) for names, some in groups.items()])


def _read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        # Only a missing value is null, `""` is an empty text. Any other mark
        # than the default, which stands for both, makes Spark tell them apart.
        .option("nullValue", "\0")
        # A quote within quotes is doubled, a backslash stands for itself.
        .option("escape", '"')
        .csv(paths)
    )
    return rows.withColumn("log_date", date_from_link(F.col("_metadata.file_path")))


def located(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path within it, of a Hadoop path to a local, HDFS, S3 or GCS file."""
    parts = urlsplit(re.sub(r"^(\w+):/(?!/)", r"\1:///", path))
    if parts.scheme in ("", "file"):
        return arrow_fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    scheme = "s3" if parts.scheme in ("s3a", "s3n") else parts.scheme
    return arrow_fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{quote(unquote(parts.path))}")


def open_path(path: str) -> IO[bytes]:
    """Open a file from within a task, by its Hadoop path."""
    system, name = located(path)
    if isinstance(system, arrow_fs.LocalFileSystem):
        return open(name, "rb")
    return system.open_input_file(name)


def _csv_member(archive: zipfile.ZipFile, path: str) -> str:
    for name in archive.namelist():
        if name.endswith(".csv"):
            return name
    raise ValueError(f"no CSV file in {path}")


def _batches_of(
    path: str, schema: pa.Schema, opener: Opener, partly: bool
) -> Iterator[pa.RecordBatch]:
    """Decode the first CSV member block by block; it is never held whole.

    ``partly``: columns of the schema that the member lacks are null.
    """
    done = 0
    for block in _BLOCK_BYTES:
        at = 0
        try:
            for batch in _decoded(path, schema, opener, partly, block):
                # Rows that smaller blocks have given are not given again.
                fresh = batch.slice(min(max(done - at, 0), batch.num_rows))
                at += batch.num_rows
                if fresh.num_rows:
                    done = at
                    yield fresh
            return
        except pa.ArrowInvalid as error:
            if block == _BLOCK_BYTES[-1] or "straddl" not in str(error):
                raise


def _decoded(
    path: str, schema: pa.Schema, opener: Opener, partly: bool, block: int
) -> Iterator[pa.RecordBatch]:
    with opener(path) as file, zipfile.ZipFile(file) as archive:
        with archive.open(_csv_member(archive, path)) as member:
            reader = arrow_csv.open_csv(
                member,
                # One core per task, and no blocks read ahead.
                read_options=arrow_csv.ReadOptions(block_size=block, use_threads=False),
                parse_options=arrow_csv.ParseOptions(newlines_in_values=True),
                convert_options=arrow_csv.ConvertOptions(
                    column_types=schema,
                    null_values=[""],
                    strings_can_be_null=True,
                    quoted_strings_can_be_null=False,
                ),
            )
            names = reader.schema.names
            fits = set(names) <= set(schema.names) and len(set(names)) == len(names)
            if not fits or (len(names) < len(schema.names) and not partly):
                raise ValueError(f"another header than expected in {path}: {names}")
            for batch in reader:
                columns = [
                    batch.column(f.name) if f.name in names else pa.nulls(batch.num_rows, f.type)
                    for f in schema
                ]
                paths = pa.array([path] * batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, paths], names=[*schema.names, _PATH])


def zip_header(path: str, opener: Opener = open_path) -> list[str]:
    """Header of the first CSV member of an archive."""
    with opener(path) as file, zipfile.ZipFile(file) as archive:
        with archive.open(_csv_member(archive, path)) as member:
            return arrow_csv.open_csv(member).schema.names


def read_zip_logs(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | None = None,
    types: Mapping[str, T.DataType] | None = None,
    opener: Opener = open_path,
) -> DataFrame:
    """Logs in ZIP archives: the first member that ends in `.csv` of each.

    Without ``schema`` the columns are those of all archives, and an archive
    that lacks one has nulls; with it, another header fails the load.

    An archive can only be unpacked from front to back, so each is the work of
    one task, which streams it in blocks; archives are unpacked side by side.
    Tasks open the files, with ``opener``, so no archive has to fit into memory. Write the result before working on it
    further.
    """
    files = _listed(spark, paths)
    partly = schema is None
    if schema is None:
        groups = headers(spark, files, lambda path: zip_header(path, opener))
        schema = merged_schema([log_schema(names, types) for names in groups])
    arrow_schema = to_arrow_schema(schema)

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield from _batches_of(path, arrow_schema, opener, partly)

    output = T.StructType([*schema.fields, T.StructField(_PATH, T.StringType())])
    # Small files would share a task: only the paths move, to one task each. The
    # largest come first, so that none of them is left alone at the end.
    sizes = _sizes(spark, files)
    listed = spark.createDataFrame(list(enumerate(sorted(files, key=sizes.__getitem__))), "at int, path string")
    spread = listed.repartitionByRange(max(len(files), 1), "at")
    rows = spread.mapInArrow(unpack, output)
    return rows.withColumn("log_date", date_from_link(F.col(_PATH))).drop(_PATH)


def read_ip_ranges(spark: SparkSession, path: str) -> DataFrame:
    """IP ranges from a CSV file without header, columns by position."""
    return spark.read.schema(IP_RANGES).option("mode", "FAILFAST").csv(path)
