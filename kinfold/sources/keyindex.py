"""Persisted index of the keys in published files, for re-imports without duplicates.

For every file, and for every table of an import as a whole, the index holds the least and greatest key and a
blocked Bloom filter: a key picks one block of 32,768 bits by one hash and ``PROBES`` bits in it by another, at
``BITS`` bits a key.  Blocks are rows of 4 KB, so neither a filter nor a lookup is ever one large value.

A lookup tests new keys against the imports first, and only those that may be in one against its files.  Nearly
all keys that are really new end there, so the number of files meets only keys that are likely repeated.
What remains are the files that may hold one of the keys; the exact comparison reads no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 15
BITS, PROBES = 12, 4
#: file value of a whole table's filter
WHOLE = ""
GROUP = ["kind", "table", "file"]


def keyed(rows: DataFrame) -> DataFrame:
    """rows with the key of a node (its id) or an edge (both ids) as ``k1`` and ``k2``, and its two hashes."""
    k1, k2 = F.coalesce("node_id", "src_id"), F.coalesce("dst_id", F.lit(""))
    return rows.withColumns({"k1": k1, "k2": k2, "h1": F.xxhash64(k1, k2), "h2": F.xxhash64(F.lit(7), k2, k1)})


def _block() -> Column:
    return F.pmod(F.col("h1"), F.col("blocks")).alias("block")


def _probe(i: int) -> Column:
    return F.shiftrightunsigned("h2", 15 * i).bitwiseAND(F.lit(BLOCK - 1))


def key_index(rows: DataFrame) -> DataFrame:
    """``(kind, table, file, n, least, most, blocks, block, bits)`` over rows ``(kind, table, file, node_id, src_id, dst_id)``."""
    keys = keyed(rows).select(*GROUP, "k1", "h1", "h2")
    sizes = keys.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.min("k1").alias("least"), F.max("k1").alias("most"))
    whole = sizes.groupBy("kind", "table").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    sizes = sizes.unionByName(whole.withColumn("file", F.lit(WHOLE))).withColumn(
        "blocks", F.ceil(F.col("n") * BITS / BLOCK).cast("long"))
    # keys are dealt out by block, so a large table's keys are spread however few groups there are; a hash stands for the
    # group's names (two groups with one hash would only set more bits)
    sizes = F.broadcast(sizes.withColumn("group", F.xxhash64(*GROUP)))
    both = keys.withColumn("file", F.explode(F.array("file", F.lit(WHOLE))))
    placed = both.join(sizes, GROUP).select("group", _block(), "h2").repartition("group", "block")
    probes = [F.bitmap_construct_agg(_probe(i)).alias(f"bits{i}") for i in range(PROBES)]
    bits = placed.groupBy("group", "block").agg(*probes).select(
        "group", "block", F.explode(F.array(*(f"bits{i}" for i in range(PROBES)))).alias("bits"))
    blocks = bits.groupBy("group", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return blocks.join(sizes, "group").select(*GROUP, "n", "least", "most", "blocks", "block", "bits")


def _may_hold(keys: DataFrame, index: DataFrame, on: list[str]) -> DataFrame:
    """Keys beside every entry (a file or a whole table) of the index that may hold them."""
    entries = index.select("import", *GROUP, "least", "most", "blocks").distinct()
    near = keys.join(entries, on).where(F.col("k1").between(F.col("least"), F.col("most"))).withColumn("block", _block())
    met = near.join(index.select("import", *GROUP, "block", "bits"), ["import", *GROUP, "block"])

    def is_set(i: int) -> Column:
        byte = F.conv(F.hex(F.substring("bits", F.shiftrightunsigned(_probe(i), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
        return byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << b) for b in range(8))), (_probe(i).bitwiseAND(F.lit(7)) + 1).cast("int"))) != 0

    found = is_set(0)
    for i in range(1, PROBES):
        found = found & is_set(i)
    return met.where(found)


def files_that_may_hold(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct ``(import, kind, table, file)`` of the index's files that may hold one of the keys.

    keys: rows ``(kind, table, node_id, src_id, dst_id)``.
    """
    own = keyed(keys).select("kind", "table", "k1", "h1", "h2")
    imports = _may_hold(own, index.where(F.col("file") == WHOLE), ["kind", "table"])
    likely = imports.select("import", "kind", "table", "k1", "h1", "h2")
    return _may_hold(likely, index.where(F.col("file") != WHOLE), ["import", "kind", "table"]).select("import", *GROUP).distinct()
