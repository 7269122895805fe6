"""Byte ranges and listings of files, wherever they lie."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F


def place(path: str):
    """The file system and the path in it; paths without a scheme are local ones (a folder that all executors share)."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


@contextmanager
def opened(path: str):
    """A file for reading by ranges: seek and read move no more than what is asked for."""
    system, inner = place(path)
    with system.open_input_file(inner) as file:
        yield file


@contextmanager
def written_whole(path: str):
    """A stream to a file that appears under its name only when it is complete."""
    system, inner = place(path)
    folder = inner.rpartition("/")[0]
    if folder:
        system.create_dir(folder, recursive=True)
    part = f"{inner}.part"
    try:
        with system.open_output_stream(part) as file:
            yield file
    except BaseException:
        system.delete_file(part)
        raise
    system.move(part, inner)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, folder, file, bytes, modified of the files below path whose name fits the pattern.

    Contents aren't read. Files without a byte, as a broken write leaves them, aren't listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    folder, name = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1), F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select("path", folder.alias("folder"), name.alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def folders(files: DataFrame) -> DataFrame:
    """folder of a listing's files, each once, in order."""
    return files.select("folder").distinct().orderBy("folder")


def usable(files: DataFrame, least_bytes: int = 1) -> DataFrame:
    """Files of a listing that aren't empty or cut short."""
    return files.filter(F.col("bytes") >= least_bytes)


def older_than(files: DataFrame, seconds: int, now=None) -> DataFrame:
    """Files of a listing last changed more than some seconds ago."""
    now = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return files.filter(F.unix_timestamp(now) - F.unix_timestamp("modified") > seconds)
