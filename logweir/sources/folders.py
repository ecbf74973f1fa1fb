"""Folder listings on whatever file system Spark reads from."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _file_system(spark, path)
    return files.exists(location)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is absent."""
    files, location = _file_system(spark, path)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def make_empty(spark: SparkSession, path: str) -> None:
    """Make the folder, without anything that was in it."""
    files, location = _file_system(spark, path)
    files.delete(location, True)
    files.mkdirs(location)


def sizes_in(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and bytes of the files in a folder; none if it is absent."""
    files, location = _file_system(spark, path)
    if not files.exists(location):
        return {}
    return {s.getPath().getName(): s.getLen() for s in files.listStatus(location) if s.isFile()}


def remove(spark: SparkSession, path: str) -> None:
    files, location = _file_system(spark, path)
    files.delete(location, True)


def write_text(spark: SparkSession, path: str, text: str, aside: str) -> None:
    """Write a small file ``aside`` and rename it; an error if it is there already."""
    files, location = _file_system(spark, path)
    first = spark._jvm.org.apache.hadoop.fs.Path(aside)
    files.mkdirs(location.getParent())
    out = files.create(first, True)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(location) or not files.rename(first, location):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole."""
    files, location = _file_system(spark, path)
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
