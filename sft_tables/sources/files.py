"""Opening files inside tasks, on any file system Spark paths name (local, HDFS, object stores)."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length) of every file below; the content column is not read. Spark leaves out files without a byte."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def open_bytes(uri: str):
    """A seekable binary stream."""
    from pyarrow import fs

    if uri.startswith("file:"):
        local = unquote(re.sub(r"^file:/+", "/", uri))
        return fs.LocalFileSystem().open_input_file(local)
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def write_bytes(uri: str, data: bytes) -> None:
    """A whole file in place, folders included; written anew if it is there."""
    from pyarrow import fs

    if uri.startswith("file:"):
        system, path = fs.LocalFileSystem(), unquote(re.sub(r"^file:/+", "/", uri))
    else:
        system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as stream:
        stream.write(data)


def open_text(uri: str, newline: str | None = None) -> io.TextIOWrapper:
    """UTF-8 text without a byte order mark, read in pieces."""
    return io.TextIOWrapper(io.BufferedReader(open_bytes(uri)), encoding="utf-8-sig", newline=newline)


def chunks(stream, size: int = 1 << 20) -> Iterator[bytes]:
    while piece := stream.read(size):
        yield piece
