"""Checksums of files of any size, read as streams of blocks inside tasks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from parceltide.session import shuffle_width

BLOCK_BYTES = 8 << 20
# Schemes whose files a task opens by itself; the credentials are those of its machine.
STREAMED = ("file", "s3", "s3a", "gs", "hdfs", "abfs", "abfss")
_SCHEMES = {"s3a": "s3"}


def open_stream(path: str) -> pa.NativeFile:
    """The file of a Hadoop path as a byte stream."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        scheme, rest = "file", path
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream(re.sub("^/+", "/", rest))
    system, name = fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    return system.open_input_stream(name)


def digest_of(stream: pa.NativeFile, block_bytes: int) -> tuple[str, int]:
    """(SHA-256 as hex digits, bytes read); never holds more than one block."""
    state, size = hashlib.sha256(), 0
    while block := stream.read(block_bytes):
        state.update(block)
        size += len(block)
    return state.hexdigest(), size


def _digests(block_bytes: int, opened: Callable[[str], pa.NativeFile]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(path) as stream:
                    digest, size = digest_of(stream, block_bytes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([size]), pa.array([digest])], ["filename", "size_bytes", "sha256_hex"]
                )

    return run


def file_digests(
    files: DataFrame, block_bytes: int = BLOCK_BYTES, opened: Callable[[str], pa.NativeFile] = open_stream
) -> DataFrame:
    """(filename, size_bytes, sha256_hex) of a listing with ``filename`` and ``path``.

    The listing is dealt out over the tasks; a file is one stream, because a digest is sequential, and its size has no
    bound. ``size_bytes`` counts the bytes that were read.
    """
    dealt = files.select("filename", "path").repartition(shuffle_width(files.sparkSession), "path")
    return dealt.mapInArrow(_digests(block_bytes, opened), "filename string, size_bytes long, sha256_hex string")


def _heads(limit: int, opened: Callable[[str], pa.NativeFile]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for path in batch.column(1).to_pylist():
                with opened(path) as stream:
                    head = b""
                    while b"\n" not in head and len(head) < limit and (block := stream.read(min(4096, limit))):
                        head += block
                lines.append(head.split(b"\n")[0][:limit].decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lines, pa.string())], ["source", "path", "line"])

    return run


def first_lines(files: DataFrame, limit: int = 1 << 20, opened: Callable[[str], pa.NativeFile] = open_stream) -> DataFrame:
    """(source, path, line): the first line of every listed file, of which no more than its head is read."""
    dealt = files.select("source", "path").repartition(shuffle_width(files.sparkSession), "path")
    return dealt.mapInArrow(_heads(limit, opened), "source string, path string, line string")


def whole_file_digests(contents: DataFrame) -> DataFrame:
    """The same from loaded contents, for schemes that only Spark's readers know; a file must stay below 2 GB."""
    return contents.select(
        "filename", F.octet_length("content").cast("long").alias("size_bytes"), F.sha2("content", 256).alias("sha256_hex")
    )
