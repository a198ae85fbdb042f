"""Byte ranges of files, read in tasks: chunk digests of large files and the headers of Avro parts.

Ranges are read with Arrow's file systems (local, HDFS, S3, GCS by the path's scheme), so a task holds a few
megabytes of a file of any size.  The names and sizes come from Spark's own listing.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# executors get this module's functions with the task, whether or not they have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: bytes read at a time
STEP = 8 << 20
_HEAD = 64 << 10


def open_range(path: str):
    """The file at a Spark path, open for reading at any place."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or path.startswith("/"):
        return fs.LocalFileSystem().open_input_file("/" + (path if path.startswith("/") else rest).lstrip("/"))
    system, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system.open_input_file(name)


def listed(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, size, file_name)`` of the data files below ``path``; no content is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
             .load(path).select("path", F.col("length").alias("size"))
             .withColumn("file_name", F.element_at(F.split("path", "/"), -1)))
    return files.where(~F.col("file_name").startswith("_") & ~F.col("file_name").startswith("."))


# -- digests ---------------------------------------------------------------

def chunk_digests(files: DataFrame, chunk: int) -> DataFrame:
    """``(path, size, nth, md5)`` of every chunk of the files ``(path, size)``; each chunk is one unit of work."""
    starts = F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(chunk))
    rows = files.select("path", "size", F.posexplode(starts).alias("nth", "start"))
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, size, start in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                held, end = hashlib.md5(usedforsecurity=False), min(start + chunk, size)
                with open_range(path) as f:
                    f.seek(start)
                    while start < end:
                        part = f.read(min(STEP, end - start))
                        if not part:
                            raise OSError(f"{path} ends before {end}")
                        held.update(part)
                        start += len(part)
                out.append(held.digest())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], names=["path", "size", "nth", "md5"])

    # round robin over tasks: the chunks of one file are hashed side by side
    return rows.repartition(n).mapInArrow(digest, "path string, size long, nth int, md5 binary")


def tree_digests(files: DataFrame, chunk: int) -> DataFrame:
    """``(path, tree_md5)``: the MD5 of the ordered chunk digests, a dash, and the number of chunks."""
    ordered = F.sort_array(F.collect_list(F.struct("nth", "md5")))
    joined = F.unhex(F.array_join(F.transform(ordered, lambda x: F.hex(x["md5"])), ""))
    return chunk_digests(files, chunk).groupBy("path").agg(
        F.concat_ws("-", F.md5(joined), F.count(F.lit(1)).cast("string")).alias("tree_md5"))


# -- Avro headers ----------------------------------------------------------

class _Short(Exception):
    pass


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(data):
            raise _Short
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return (value >> 1) ^ -(value & 1), at


def _bytes(data: bytes, at: int) -> tuple[bytes, int]:
    n, at = _varint(data, at)
    if at + n > len(data):
        raise _Short
    return data[at : at + n], at + n


def header_schema(data: bytes) -> str:
    """The writer schema in the first bytes of an Avro file; _Short when more bytes are needed."""
    if len(data) < 4:
        raise _Short
    if data[:4] != b"Obj\x01":
        raise ValueError("not an Avro file")
    at, found = 4, {}
    while True:
        n, at = _varint(data, at)
        if n == 0:
            return found[b"avro.schema"].decode()
        if n < 0:
            _, at = _varint(data, at)
        for _ in range(abs(n)):
            key, at = _bytes(data, at)
            found[key], at = _bytes(data, at)


def header_schemas(files: DataFrame) -> DataFrame:
    """``(path, schema)`` from the header of every Avro file in ``(path, size)``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_range(path) as f:
                    n = _HEAD
                    while True:
                        f.seek(0)
                        try:
                            out.append(header_schema(f.read(n)))
                            break
                        except _Short:
                            if n >= size:
                                raise ValueError(f"{path} has no whole Avro header") from None
                            n *= 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["path", "schema"])

    return files.select("path", "size").mapInArrow(read, "path string, schema string")
