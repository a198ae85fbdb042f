"""The two end-to-end jobs: export a cohort's subgraph, restore an export (B1, B2).

Arguments replace the reference's environment wiring (P13, E8, K8): the
request document holds the filter and an optional root type; extras come as a
comma list (empty string = only the root's own, items kept as given); site-specific
defaults are a caller-supplied ``{root: [extra, ...]}`` mapping.  Output
locations are folders under a base path named by the run time, without
``:`` (not allowed in Hadoop paths).
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.model import Dictionary, Graph
from kinfold.operators.cohort import cohort_authz, select_cohort
from kinfold.operators.records import walk_records
from kinfold.operators.restore import Restored, decoded_props
from kinfold.operators.traverse import Walk, walk_graph
from kinfold.sources.container import (container_schema, props_from_schema, read_container,
                                       write_container)
from kinfold.session import scratch_dir
from kinfold.sources.commits import ImportLog
from kinfold.sources.manifest import EXPIRY_DAYS, artifact_manifest
from kinfold.sources.sinks import index_staged, stage_import, without_published, write_records, write_restored_jdbc

NODE_SCHEMA = "node_table string, node_id string, _props string, acl string, _sysan string, created timestamp"
EDGE_SCHEMA = "edge_table string, src_id string, dst_id string, _props string, acl string, _sysan string, created timestamp"

log = logging.getLogger("kinfold")


@dataclass
class ExportRequest:
    root: str
    filter: dict
    extra: list[str] = field(default_factory=list)


def parse_extra(value: str | None, root: str,
                root_extras: dict[str, list[str]] | None = None) -> list[str]:
    """Comma list -> extras (``None`` and ``''``: none), then the root's own extras."""
    extras = value.split(",") if value and value.strip() else []  # items are not trimmed
    for e in (root_extras or {}).get(root, []):
        if e not in extras:
            extras.append(e)
    return extras


def parse_request(doc: dict | str, default_root: str, extra: str | None = None,
                  root_extras: dict[str, list[str]] | None = None) -> ExportRequest:
    """``{"filter": {...}, "root_node": "..."}``; both keys optional."""
    if isinstance(doc, str):
        doc = json.loads(doc)
    root = doc.get("root_node") or default_root
    return ExportRequest(root=root, filter=doc.get("filter", {}) or {},
                         extra=parse_extra(extra, root, root_extras))


def run_name(prefix: str = "export", now: datetime | None = None) -> str:
    now = now or datetime.now(timezone.utc)
    return f"{prefix}_{now.strftime('%Y-%m-%dT%H-%M-%S')}"


@dataclass
class ExportResult:
    path: str
    manifest: DataFrame
    authz: DataFrame


def plain_records(walk: Walk) -> DataFrame:
    """Records whose objects hold plain text, whatever the graph's own form is.

    Containers hold enum symbols, Parquet records plain text; the import decodes only the former.
    """
    records = walk_records(walk)
    if not walk.graph.object_encoded:
        return records
    return records.withColumn("object", decoded_props(walk.graph.dictionary, F.col("name"), F.col("object")))


def export_job(graph: Graph, index: DataFrame, request: ExportRequest, base_path: str,
               grants: DataFrame | None = None, fmt: str = "avro",
               include_upward: bool = True, expires_days: int = EXPIRY_DAYS) -> ExportResult:
    """Cohort -> walk -> container (or Parquet records) -> manifest.

    Returns the output folder, the manifest frame (one row per part file)
    and the cohort's authorization paths.
    """
    t0 = time.time()
    if fmt not in ("avro", "parquet"):
        raise ValueError(f"unknown export format {fmt!r}")
    cohort = select_cohort(index, request.root, request.filter, grants)
    walk = walk_graph(graph, cohort, request.root, request.extra, include_upward)
    path = f"{base_path.rstrip('/')}/{run_name()}"
    try:
        if fmt == "avro":
            write_container(walk, path)
            glob = "*.avro"
        else:
            write_records(plain_records(walk), path)
            glob = "*.parquet"
    finally:
        walk.cleanup()
    log.info("export written to %s in %.1fs", path, time.time() - t0)
    return ExportResult(path, artifact_manifest(graph.spark, path, glob, expires_days),
                        cohort_authz(index, request.filter, grants))


def with_container_props(d: Dictionary, schema: dict) -> Dictionary:
    """Fill in field types and enum flags from a container header.

    Types the dictionary already describes keep their own fields; the
    container's writer schema covers the rest, so its enum fields are decoded.
    """
    described = {p.label for p in d.props}
    extra = [p for p in props_from_schema(schema)
             if p.label not in described and p.label in d.node_tables]
    if not extra:
        return d
    return Dictionary(dict(d.node_tables), list(d.edge_types), list(d.props) + extra)


def read_export(spark: SparkSession, path: str, fmt: str = "avro", schema: dict | None = None) -> DataFrame:
    if fmt == "avro":
        return read_container(spark, path, schema)
    return spark.read.parquet(path)


def import_job(spark: SparkSession, path: str, d: Dictionary, target: str | None = None,
               jdbc_url: str | None = None, jdbc_properties: dict[str, str] | None = None,
               fmt: str = "avro", skip_existing: bool = False, import_id: str | None = None) -> Restored:
    """Read an export once, check it while staging it, and commit all its tables together.

    ``target`` is a folder with a commit log (``sources.commits``): node and edge rows become valid in one step, as
    Parquet tables by import and table name.  Appending is the default; ``skip_existing`` drops rows
    whose keys a committed import already holds.  An ``import_id`` makes the job safe to repeat: an
    id that is committed is not imported again.  ``jdbc_url`` appends the committed rows over JDBC.
    """
    t0 = time.time()
    import_log = ImportLog(spark, target or scratch_dir(spark, "import"))
    import_id = import_id or uuid.uuid4().hex
    done = import_log.find(import_id)
    if done is not None:
        import_log.publish(done)
        log.info("import %s of %s is committed already", import_id, path)
        return imported(import_log, import_id)
    schema = container_schema(spark, path) if fmt == "avro" else None
    records = read_export(spark, path, fmt, schema)
    if schema:
        d = with_container_props(d, schema)
    staged = import_log.new_attempt(import_id)
    try:
        counts = stage_import(records, d, f"{import_log.target}/{staged}", encoded=fmt == "avro")
        if skip_existing:
            staged, counts["files_compared"] = without_published(import_log, staged, import_log.new_attempt(import_id))
        index_staged(import_log, staged)
    except Exception:
        import_log.discard(staged)
        raise
    import_log.commit(import_id, staged, counts)
    restored = imported(import_log, import_id)
    if jdbc_url:
        write_restored_jdbc(restored, d, jdbc_url, jdbc_properties or {}, staged=True)
    log.info("import of %s finished in %.1fs", path, time.time() - t0)
    return restored


def imported(import_log: ImportLog, import_id: str) -> Restored:
    """The committed rows of one import."""
    spark = import_log.spark
    tables = []
    for kind, schema in (("nodes", NODE_SCHEMA), ("edges", EDGE_SCHEMA)):
        rows = import_log.table(kind)
        tables.append(spark.createDataFrame([], schema) if rows is None else rows.where(F.col("import") == import_id).select(
            *(c.split()[0] for c in schema.split(", "))))
    return Restored(*tables)
