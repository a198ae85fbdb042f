"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Only built-in expressions.  Texts are equal when identical after every run of white space
(space, \\x09-\\x0D) became one space; a null text counts as empty.  Of equal texts the row with the
smallest id stays; null ids come last.  Rows that repeat both id and text are one document: they
share one verdict, and `deduplicated` keeps one of them.

1. Every row gives its length and the hash of its first PREFIX characters; groups of one leave.
2. Rows whose (length, prefix hash) is shared give their full hash.  The test for "is shared" is a
   fixed-size bitmap, so texts are neither shuffled nor hashed in full for rows that cannot survive.
3. Groups of equal (length, prefix hash, full hash) are counted with a map-side partial aggregate,
   so a group of a third of all rows costs one row per task.

An empty table gives an empty result; other columns are ignored by `duplicate_groups` and kept by
`deduplicated`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, possible_members, written

PREFIX = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _keyed(rows: DataFrame, prefix: int) -> DataFrame:
    """rows (id, text, ...) with the normalised text and the two cheap keys."""
    norm = rows.withColumn("norm", normalised(F.col("text"))).drop("text")
    return norm.withColumn("text_len", F.length("norm")).withColumn(
        "prefix_hash", F.xxhash64("text_len", F.substring("norm", 1, prefix)))


def _groups(rows: DataFrame, prefix: int) -> DataFrame:
    keyed = _keyed(rows, prefix)
    first = written(keyed.groupBy("text_len", "prefix_hash").agg(F.count(F.lit(1)).alias("n")), "exact-prefix")
    lengths = first.groupBy("text_len").agg(F.sum("n").alias("in_length")).where("in_length > 1")
    shared = first.join(lengths, "text_len", "left_semi").where("n > 1").select("prefix_hash")
    maybe = possible_members(keyed, F.col("prefix_hash"), shared, F.col("prefix_hash")).where("_possible")
    full = maybe.select("text_len", "prefix_hash", F.sha2("norm", 256).alias("full_hash"), "id")
    return (
        full.groupBy("text_len", "prefix_hash", "full_hash")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """(text_len, prefix_hash, full_hash, keep_id, group_size) of every text that more than one row has."""
    return _groups(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), prefix)


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, and the hash of the normalised text."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    groups = written(_groups(rows, prefix), "exact-groups").select(F.col("full_hash").alias("text_sha256"), "keep_id", "group_size")
    out = rows.select(F.col("id").alias("doc_id"), F.sha2(normalised(F.col("text")), 256).alias("text_sha256")).join(groups, "text_sha256", "left")
    single = F.col("group_size").isNull()
    return out.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """The rows that stay, with all their columns; one row of each group, by the smallest id."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.struct(*docs.columns).alias("row"))
    groups = written(_groups(rows, prefix), "exact-groups")
    keyed = possible_members(_keyed(rows, prefix), F.col("prefix_hash"), groups, F.col("prefix_hash"))
    alone = keyed.where("NOT _possible").select("row")
    maybe = keyed.where("_possible").select("id", "row", F.sha2("norm", 256).alias("full_hash"))
    found = maybe.join(groups.select("full_hash", "keep_id", F.lit(True).alias("in_group")), "full_hash", "left")
    single = found.where("in_group IS NULL").select("row")
    # of a group only rows with its smallest id are left; when there are several, they are one document
    first = found.where(F.col("in_group") & F.col("id").eqNullSafe(F.col("keep_id"))).dropDuplicates(["full_hash"]).select("row")
    return alone.unionAll(single).unionAll(first).select("row.*")
