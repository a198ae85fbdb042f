"""Writers for restored tables and exported records.

A single ``partitionBy`` write fans the restored rows out by target table.  Sinks with
one write per table read that table's folder back, so nothing is computed twice or cached.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from kinfold.model import Dictionary, GraphError
from kinfold.operators.records import ordered_for_write
from kinfold.operators.restore import PROBLEMS, Restored, import_rows, validate_records
from kinfold.session import scratch_dir
from kinfold.sources.commits import ImportLog
from kinfold.sources.jdbc import append_table
from kinfold.sources.keyindex import GROUP, files_that_may_hold, key_index, keyed

NODE_COLUMNS = ["node_id", "_props", "acl", "_sysan", "created"]
EDGE_COLUMNS = ["src_id", "dst_id", "_props", "acl", "_sysan", "created"]


def write_records(records: DataFrame, path: str, max_records_per_file: int = 1_000_000,
                  mode: str = "errorifexists") -> None:
    """Export sink: Parquet in ``topo_rank=/name=`` folders, parents first (K4, O1)."""
    (ordered_for_write(records).write.mode(mode)
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("topo_rank", "name").parquet(path))


def write_restored_files(restored: Restored, path: str, mode: str = "append") -> None:
    """One write per kind; directories ``node_table=…`` / ``edge_table=…``."""
    restored.nodes.write.mode(mode).partitionBy("node_table").parquet(f"{path}/nodes")
    restored.edges.write.mode(mode).partitionBy("edge_table").parquet(f"{path}/edges")


def _staged(restored: Restored) -> tuple[DataFrame, DataFrame]:
    """The restored rows, written once to the shared folder by target table; a filter on the table then prunes."""
    spark = restored.nodes.sparkSession
    path = scratch_dir(spark, "restored-staging")
    write_restored_files(restored, path, mode="errorifexists")
    return (spark.read.schema(restored.nodes.schema).parquet(f"{path}/nodes"),
            spark.read.schema(restored.edges.schema).parquet(f"{path}/edges"))


def stage_import(records: DataFrame, d: Dictionary, path: str, encoded: bool = False) -> dict[str, int]:
    """Write the import's rows below ``path`` by kind and table, in one scan; the counts seen on the way.

    Raises, and leaves nothing, when a record must not be imported.
    """
    seen = Observation("import")
    rows = import_rows(records, d, encoded, seen)
    rows.write.mode("errorifexists").partitionBy("kind", "table").parquet(path)
    counts = {k: int(v) for k, v in seen.get.items()}
    if any(counts[p] for p in PROBLEMS):
        jvm_path = records.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(records.sparkSession._jsc.hadoopConfiguration()).delete(jvm_path, True)
        validate_records(records, d)  # scans again, for the names
        raise GraphError(f"records cannot be imported: {counts}")
    return counts


def staged_rows(spark: SparkSession, path: str) -> DataFrame:
    """The staged rows with their file's name."""
    schema = "node_id string, src_id string, dst_id string, _props string, acl string, _sysan string, created timestamp, kind string, table string"
    return spark.read.schema(schema).parquet(path).withColumn("file", F.col("_metadata.file_name"))


def index_staged(log: ImportLog, staged: str) -> None:
    """Write the key index of a staged import beside it; it is published with the import."""
    key_index(staged_rows(log.spark, f"{log.target}/{staged}").select(*GROUP, "node_id", "src_id", "dst_id")).write.parquet(f"{log.target}/{staged}.keys")


def published_files(log: ImportLog, files: list[Row]) -> list[str]:
    """Paths of ``(import, kind, table, file)`` rows."""
    column = {"nodes": "node_table", "edges": "edge_table"}
    return [f"{log.target}/{f['kind']}/import={f['import']}/{column[f['kind']]}={f['table']}/{f['file']}" for f in files]


def without_published(log: ImportLog, staged: str, new_attempt: str) -> tuple[str, int]:
    """The staged import without rows whose key a committed import already holds: (its folder, files read for it).

    The key index names the files that may hold one of the keys; only their key columns are read, by file.
    """
    spark = log.spark
    done = [c.import_id for c in log.recover()]
    rows = staged_rows(spark, f"{log.target}/{staged}")
    if not done:
        return staged, 0
    index_schema = "kind string, table string, file string, n long, least string, most string, blocks long, block long, bits binary, import string"
    index = spark.read.schema(index_schema).parquet(f"{log.target}/_keys").where(F.col("import").isin(done))
    files = files_that_may_hold(rows.select("kind", "table", "node_id", "src_id", "dst_id"), index).collect()  # file names
    if not files:
        return staged, 0
    frames = []
    for kind, columns in (("nodes", ["node_id"]), ("edges", ["src_id", "dst_id"])):
        paths = published_files(log, [f for f in files if f["kind"] == kind])
        if paths:
            held = spark.read.schema(", ".join(f"{c} string" for c in columns) + f", import string, {kind[:-1]}_table string").option(
                "basePath", f"{log.target}/{kind}").parquet(*paths)
            ids = [F.col(c) if c in columns else F.lit(None).cast("string").alias(c) for c in ("node_id", "src_id", "dst_id")]
            frames.append(held.select(F.lit(kind).alias("kind"), F.col(f"{kind[:-1]}_table").alias("table"), *ids))
    old = keyed(reduce(DataFrame.unionByName, frames)).select("kind", "table", "k1", "k2")
    fresh = keyed(rows).join(old, ["kind", "table", "k1", "k2"], "left_anti").drop("k1", "k2", "h1", "h2", "file")
    fresh.write.partitionBy("kind", "table").parquet(f"{log.target}/{new_attempt}")
    log.discard(staged)
    return new_attempt, len(files)


def write_restored_jdbc(restored: Restored, d: Dictionary, url: str, properties: dict[str, str],
                        partitions: int | None = None, batch_size: int | None = None, staged: bool = False) -> None:
    """Append every node and edge table of the dictionary over JDBC.

    ``partitions`` bounds the connections that are open at once, ``batch_size`` the rows of a statement;
    ``staged``: the rows are read from files by target table already.
    """
    nodes, edges = (restored.nodes, restored.edges) if staged else _staged(restored)
    for frame, column, names, keep in (
            (nodes, "node_table", sorted(d.node_tables.values()), NODE_COLUMNS),
            (edges, "edge_table", [e.edge_table for e in d.edge_types], EDGE_COLUMNS)):
        for t in names:
            append_table(frame.where(F.col(column) == t).select(*keep), url, t, properties, partitions, batch_size)


def write_restored_tables(restored: Restored, node_tables: list[str], edge_tables: list[str],
                          database: str, location: str, buckets: int,
                          mode: str = "append") -> None:
    """Restore into catalog tables bucketed on their unique keys (K1/K2 at scale).

    Node tables are bucketed and sorted by ``node_id``, edge tables by ``src_id``: a child has a few
    parents, while a parent may hold a third of all edges and would fill one bucket.  Up visits and
    node joins then shuffle only the frontier side; down visits shuffle the edges, where AQE can split a
    hot parent.  Rows are dealt out by the bucket key first, so there is one file per bucket.  Data
    files live under ``location`` (shared storage), one folder per table.
    """
    nodes, edges = _staged(restored)
    for frame, column, names, keep, key in ((nodes, "node_table", node_tables, NODE_COLUMNS, "node_id"),
                                            (edges, "edge_table", edge_tables, EDGE_COLUMNS, "src_id")):
        for t in names:
            (frame.where(F.col(column) == t).select(*keep).repartition(buckets, key).write.mode(mode)
             .bucketBy(buckets, key).sortBy(key)
             .option("path", f"{location}/{t}").saveAsTable(f"{database}.{t}"))
