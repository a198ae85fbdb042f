"""Registration manifest of written artefacts.

One row per written part file: identifier, name, size, MD5, URL, ``form = 'object'``
and an expiry instant (now + N days, epoch seconds).  Files of up to ``chunk`` bytes are read with
the ``binaryFile`` source, one file per row, hashed by the built-in ``md5``.  Larger files are hashed in
chunks by several tasks; their ``hashes`` hold ``md5_tree``, the MD5 of the ordered chunk digests with their
number, and ``md5`` is null.  The cohort's authorization paths are a
separate distinct frame (``cohort_authz``); a bounded list of them can be given as ``authz``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.sources.ranges import listed, tree_digests

# fixed value: default record expiry
EXPIRY_DAYS = 14


#: files above this are hashed in chunks of this size
CHUNK_BYTES = 256 << 20


def artifact_manifest(spark: SparkSession, path: str, glob: str = "*",
                      expires_days: int = EXPIRY_DAYS, authz: list[str] | None = None, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Manifest rows for every data file below ``path`` that is not empty.

    ``did`` is a name-based identifier: the same URL and digest always give the same one.
    """
    files = listed(spark, path, glob)
    content = (spark.read.format("binaryFile")
               .option("recursiveFileLookup", "true")
               .option("pathGlobFilter", glob)
               .load(path))
    name = F.element_at(F.split("path", "/"), -1)
    whole = content.where(~name.startswith("_") & ~name.startswith(".") & (F.col("length") <= chunk))
    rows = whole.select(name.alias("file_name"), F.col("length").alias("size"), F.md5("content").alias("md5"), "path").select(
        "file_name", "size", "md5", "path", F.create_map(F.lit("md5"), F.col("md5")).alias("hashes"))
    large = files.where(F.col("size") > chunk)
    if not large.isEmpty():
        tree = tree_digests(large, chunk)
        rows = rows.unionByName(large.join(tree, "path").select(
            "file_name", "size", F.lit(None).cast("string").alias("md5"), "path",
            F.create_map(F.lit("md5_tree"), F.col("tree_md5")).alias("hashes")))
    expires = F.unix_timestamp(
        F.current_timestamp() + F.make_dt_interval(F.lit(int(expires_days))))
    named = F.md5(F.concat_ws("\n", "path", F.map_values("hashes")[0]).cast("binary"))
    did = F.regexp_replace(named, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return rows.select(
        did.alias("did"), "file_name", "size", "md5",
        F.array("path").alias("urls"), "hashes",
        F.lit("object").alias("form"),
        F.array(*map(F.lit, authz or [])).cast("array<string>").alias("authz"),
        expires.cast("double").alias("expires_at"))
