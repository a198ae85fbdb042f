"""Helpers shared by the operators: tables, shared-folder cuts, chunked Arrow input, bounded filters, components."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.session import scratch_dir

#: White space of the word and normalisation rules: space and \x09-\x0D.
SPACE = r"[ \t-\r]+"
CHUNK_BYTES = 4_000_000
BATCH_BYTES = 8 << 20
FILTER_BITS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, unless the environment that they share names its place already."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or any("kinfold-package" in f for f in context.listFiles):
        return
    archive = Path(tempfile.mkdtemp(prefix="kinfold-package-")) / "kinfold-package.zip"  # read by the driver's file server
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((root / "kinfold").rglob("*.py")):
            z.write(f, f.relative_to(root))
    context.addPyFile(str(archive))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the session's shared folder."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of the whole text column; one light scan, one row."""
    row = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)).alias("n")).first()
    return int(row["n"])


def bounded_batches(docs: DataFrame) -> DataFrame:
    """docs; from here on the session sends Python at most BATCH_BYTES in an Arrow batch.

    Spark's own bound is 64 MB, which a batch of long texts reaches in every running task, outside the heap and again in Python.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


class WordHash(dict):
    """word (bytes) -> 64-bit hash, computed once per distinct word; cleared when large."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: One per Python worker; entries are a pure function of the word.
WORDS = WordHash()
#: What operators keep in a Python worker from task to task, by name.
_KEPT: dict[str, dict] = {"words": WORDS}


def kept(name: str, cache: dict) -> dict:
    """cache, known by its name to keep_only."""
    _KEPT[name] = cache
    return cache


def keep_only(name: str = "") -> None:
    """Forget what the operators before this one kept in the Python worker, which Spark uses again for the next stages."""
    for other, cache in _KEPT.items():
        if other != name:
            cache.clear()


def give_back() -> None:
    """At the end of a task: hand freed memory to the system, for the next stages' sake."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads the entropy of every input bit over all output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every `width` consecutive entries of h (empty when there are fewer)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[j : j + n]
        out ^= out >> np.uint64(32)
    return mix(out)


def hash_order(h: np.ndarray) -> np.ndarray:
    """Places of 64-bit hashes in rising order: their high bits are sorted together with the place, then rare ties are put right."""
    mask = np.uint64((1 << len(h).bit_length()) - 1)
    packed = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    packed.sort()
    at = (packed & mask).astype(np.int64)
    s = h[at]
    return at[np.argsort(s, kind="stable")] if (s[1:] < s[:-1]).any() else at


def distinct_hashes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes in order, a place of each, the number of each entry's hash)."""
    at = hash_order(h)
    s = h[at]
    new = np.ones(len(h), bool)
    new[1:] = s[1:] != s[:-1]
    number = np.empty(len(h), np.int32)
    number[at] = np.cumsum(new, dtype=np.int32) - 1
    return s[new], at[new], number


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)


def chunks(batches: Iterable[pa.RecordBatch], size: int = CHUNK_BYTES, keep: str = "") -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with about `size` bytes in the last column, and that column's values (no nulls).

    keep: the cache that the task uses; the others go.
    """
    keep_only(keep)
    for batch in batches:
        text = batch.column(batch.num_columns - 1)
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            held = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, held + size, "right")))
            part = batch.slice(start, stop - start)
            yield part, part.column(batch.num_columns - 1).to_pylist()
            start = stop
    batch = text = part = None
    give_back()


def possible_members(rows: DataFrame, key: Column, members: DataFrame, member_key: Column, flag: str = "_possible", bits: int = FILTER_BITS) -> DataFrame:
    """rows with a boolean column: false only where the 64-bit key is surely not a key of `members`.

    The members' keys set bits of a bitmap of 2^bits bits, kept as at most 2^(bits-15) rows of 4 KB.
    Its size is fixed (4 MB at 25 bits), so it can be broadcast whatever the input; a full bitmap
    only means that more rows reach the exact join that follows.
    """
    size = 1 << bits
    place = F.pmod(member_key, F.lit(size))
    bitmap = (
        members.select(place.alias("_place"))
        .groupBy(F.shiftright("_place", 15).cast("int").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.col("_place").bitwiseAND(F.lit(32767))).alias("_bitmap"))
    )
    own = F.pmod(key, F.lit(size))
    bit = own.bitwiseAND(F.lit(32767)).cast("int")
    byte = F.conv(F.hex(F.expr("substring(_bitmap, shiftright(_bit, 3) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("shiftleft(1, _bit & 7)").bitwiseAND(byte) != 0
    return (
        rows.withColumn("_bit", bit)
        .withColumn("_bucket", F.shiftright(own, 15).cast("int"))
        .join(F.broadcast(bitmap), "_bucket", "left")
        .withColumn(flag, F.coalesce(hit, F.lit(False)))
        .drop("_bit", "_bucket", "_bitmap")
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node on an edge; component is the smallest node it can reach.

    Alternating large-star and small-star steps: each hooks a node's larger neighbours, then its
    smaller ones, onto its smallest neighbour.  Edges stay at most as many as they were, only sums
    of a node's edges meet, and the number of rounds is logarithmic.  Each round is written to the
    shared folder, so no lineage grows.
    """
    current = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour v of u moves onto m(u)
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours move onto the smallest of them
        large = written(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct()
        )
        current = written(small, "edges")
        seen = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            break
        mark = seen
    # every component is a star by now: each node but the root has one edge, to the root
    roots = current.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
