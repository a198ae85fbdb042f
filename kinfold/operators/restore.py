"""Restore entity records into per-type node and edge tables.

Input: a records DataFrame ``(name, id, object JSON, relations)`` as written by
the export (``Metadata`` rows allowed, they are skipped).  The dictionary is
metadata of bounded size (one entry per type / edge type), so the type and
edge-table lookups are literal map expressions evaluated in codegen: no join,
no broadcast of data.  ``import_problems`` finds everything that must not be
written in one scan.  Objects keep every field as it is; only enum symbols of
encoded exports (containers) are turned back into text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kinfold.functions.enums import ESCAPE_RE, decode_enum
from kinfold.functions.props import malformed
from kinfold.model import Dictionary, GraphError

METADATA = "Metadata"
_SEP = "\u0001"


def _map_lit(pairs: dict[str, str]) -> Column:
    if not pairs:
        return F.create_map().cast("map<string,string>")
    args: list[Column] = []
    for k, v in sorted(pairs.items()):
        args += [F.lit(k), F.lit(v)]
    return F.create_map(*args)


def node_table_of(d: Dictionary, name: Column) -> Column:
    """Entity type -> node table, null when unknown."""
    return _map_lit(d.node_tables)[name]


def edge_table_of(d: Dictionary, name: Column, dst_name: Column) -> Column:
    """(child type, parent type) -> edge table, null when unknown.

    A pair served by two edge tables is ambiguous and raises at plan time.
    """
    pairs = {f"{c}{_SEP}{p}": t for (c, p), t in d.edge_table_by_labels().items()}
    return _map_lit(pairs)[F.concat(name, F.lit(_SEP), dst_name)]


def data_records(records: DataFrame) -> DataFrame:
    """Records without the metadata record (P6); a null name is a data record (and rejected)."""
    return records.where(~F.col("name").eqNullSafe(METADATA))


def distinct_types(records: DataFrame) -> DataFrame:
    """Entity types present in the records (A2)."""
    return data_records(records).select("name").distinct()


def relation_rows(records: DataFrame) -> DataFrame:
    """One row per relation: ``(name, src_id, dst_name, dst_id)``."""
    return (data_records(records)
            .select("name", F.col("id").alias("src_id"), F.explode("relations").alias("r"))
            .select("name", "src_id", F.col("r.dst_name").alias("dst_name"),
                    F.col("r.dst_id").alias("dst_id")))


def distinct_edge_tables(records: DataFrame, d: Dictionary) -> DataFrame:
    """Edge tables the records write to (A3)."""
    rel = relation_rows(records)
    return (rel.select(edge_table_of(d, F.col("name"), F.col("dst_name")).alias("edge_table"))
            .where(F.col("edge_table").isNotNull()).distinct())


def unknown_types(records: DataFrame, d: Dictionary) -> DataFrame:
    """Entity types of the records that the dictionary lacks, with counts."""
    recs = data_records(records)
    return (recs.where(node_table_of(d, F.col("name")).isNull())
            .groupBy("name").agg(F.count(F.lit(1)).alias("n_records")))


def unknown_edges(records: DataFrame, d: Dictionary) -> DataFrame:
    """Relations whose (child type, parent type) has no edge table, with counts."""
    rel = relation_rows(records)
    return (rel.where(edge_table_of(d, F.col("name"), F.col("dst_name")).isNull())
            .groupBy("name", "dst_name").agg(F.count(F.lit(1)).alias("n_relations")))


def _enum_fields_lit(d: Dictionary) -> Column | None:
    """Literal map type -> its enum fields; None when no type has one."""
    args: list[Column] = []
    for label in sorted(d.node_tables):
        names = sorted(p.field for p in d.fields(label) if p.is_enum)
        if names:
            args += [F.lit(label), F.array(*map(F.lit, names))]
    return F.create_map(*args) if args else None


def decoded_props(d: Dictionary, name: Column, obj: Column) -> Column:
    """Object JSON with the enum symbols of its type's enum fields decoded.

    Only objects that hold an escape are rebuilt, as a map of VARIANTs in which
    the enum fields' strings (or arrays of strings) are replaced: undeclared
    fields and values of other types stay as they are.  One expression serves
    all types.
    """
    fields = _enum_fields_lit(d)
    if fields is None:
        return obj
    own = fields[name]

    def decoded(key: Column, value: Column) -> Column:
        kind = F.schema_of_variant(value)
        text = decode_enum(F.try_variant_get(value, "$", "string")).cast("variant")
        items = F.transform(F.try_variant_get(value, "$", "array<string>"), decode_enum).cast("variant")
        return F.when(~F.array_contains(own, key), value).when(kind == "STRING", text).when(
            kind == "ARRAY<STRING>", items).otherwise(value)

    parsed = F.from_json(obj, "map<string,variant>")
    return F.when(own.isNotNull() & obj.rlike(ESCAPE_RE), F.to_json(F.transform_values(parsed, decoded))).otherwise(obj)


@dataclass
class Restored:
    nodes: DataFrame  # node_table, node_id, _props, acl, _sysan, created
    edges: DataFrame  # edge_table, src_id, dst_id, _props, acl, _sysan, created


def restore_records(records: DataFrame, d: Dictionary, check: bool = True,
                    encoded: bool = False) -> Restored:
    """Records -> node rows and edge rows tagged with their target table.

    ``encoded``: the objects hold enum symbols (container exports), to be decoded;
    plain objects are passed on unchanged.  With ``check`` the ambiguity of the
    dictionary is verified at plan time, and unknown types, unknown edges and null
    ids make a write fail (``raise_error``) instead of being dropped.  That happens
    while writing: run ``validate_records`` first to fail before any write.
    """
    d.edge_table_by_labels()  # ambiguous pairs raise here
    recs = data_records(records)
    now = F.current_timestamp()
    table = node_table_of(d, F.col("name"))
    if check:
        table = F.when(table.isNull(), F.raise_error(F.concat(
            F.lit("unknown entity type "), F.coalesce("name", F.lit("null"))))).when(
            F.col("id").isNull(), F.raise_error(F.concat(F.lit("null id of type "), F.col("name")))
        ).otherwise(table)
    nodes = recs.select(
        table.alias("node_table"),
        F.col("id").alias("node_id"),
        (decoded_props(d, F.col("name"), F.col("object")) if encoded else F.col("object")).alias("_props"),
        # fixed values of the stored layout: empty acl, system annotations and edge properties
        F.lit("{}").alias("acl"), F.lit("{}").alias("_sysan"), now.alias("created"))
    rel = relation_rows(records)
    etable = edge_table_of(d, F.col("name"), F.col("dst_name"))
    if check:
        etable = F.when(etable.isNull(), F.raise_error(
            F.concat(F.lit("no edge table for "), F.coalesce("name", F.lit("null")), F.lit(" -> "),
                     F.coalesce("dst_name", F.lit("null"))))).otherwise(etable)
    edges = rel.select(
        etable.alias("edge_table"), "src_id", "dst_id",
        F.lit("{}").alias("_props"), F.lit("{}").alias("acl"), F.lit("{}").alias("_sysan"),
        now.alias("created"))
    return Restored(nodes, edges)


def malformed_objects(records: DataFrame) -> DataFrame:
    """Reject frame: records whose object text is not valid JSON."""
    return data_records(records).where(malformed(F.col("object"))).select("name", "id", "object")


#: what an import must not write
PROBLEMS = ("unknown type", "null id", "malformed object", "unknown edge", "null relation id")
_PROBLEM_ROWS = "array<struct<problem:string,dst_name:string>>"


def record_problems(d: Dictionary) -> Column:
    """The problems of one data record, as an array of ``(problem, dst_name)``; null names are unknown types."""
    def found(condition: Column, problem: str) -> Column:
        row = F.struct(F.lit(problem).alias("problem"), F.lit(None).cast("string").alias("dst_name"))
        return F.when(condition, F.array(row)).otherwise(F.array().cast(_PROBLEM_ROWS))

    def relation(r: Column) -> Column:
        known = edge_table_of(d, F.col("name"), r["dst_name"])
        return F.when(known.isNull(), F.lit("unknown edge")).when(r["dst_id"].isNull(), F.lit("null relation id"))

    bad_relations = F.filter(
        F.transform(_relations(), lambda r: F.struct(relation(r).alias("problem"), r["dst_name"].alias("dst_name"))),
        lambda x: x["problem"].isNotNull())
    return F.concat(
        found(node_table_of(d, F.col("name")).isNull(), "unknown type"),
        found(F.col("id").isNull(), "null id"),
        found(malformed(F.col("object")), "malformed object"),
        bad_relations)


def _relations() -> Column:
    return F.coalesce("relations", F.array().cast("array<struct<dst_id:string,dst_name:string>>"))


def import_problems(records: DataFrame, d: Dictionary) -> DataFrame:
    """Everything an import must not write, in one scan: ``(problem, name, dst_name, n)``.

    Problems: ``unknown type`` (null names too), ``null id``, ``malformed object``,
    ``unknown edge``, ``null relation id``; at most one row per problem and pair of types.
    """
    rows = data_records(records).select("name", F.explode(record_problems(d)).alias("p"))
    return (rows.select(F.col("p.problem").alias("problem"), "name", F.col("p.dst_name").alias("dst_name"))
            .groupBy("problem", "name", "dst_name").agg(F.count(F.lit(1)).alias("n")))


def _times(problems: Column, problem: str) -> Column:
    return F.size(F.filter(problems, lambda x: x["problem"] == problem))


def import_rows(records: DataFrame, d: Dictionary, encoded: bool = False, observation: Observation | None = None) -> DataFrame:
    """Node rows and edge rows in one frame, so that one write of one scan stages both:
    ``(kind, table, node_id, src_id, dst_id, _props, acl, _sysan, created)``.

    ``observation`` counts records, nodes, edges and every problem while the rows are written; rows with a
    problem are staged too (under a null table when it is unknown), so publish only when all counts are 0.
    """
    d.edge_table_by_labels()  # ambiguous pairs raise here
    recs = data_records(records).withColumn("_bad", record_problems(d))
    if observation is not None:
        recs = recs.observe(
            observation, F.count(F.lit(1)).alias("nodes"), F.coalesce(F.sum(F.size(_relations())), F.lit(0)).alias("edges"),
            *(F.coalesce(F.sum(_times(F.col("_bad"), p)), F.lit(0)).alias(p) for p in PROBLEMS))
    none = F.lit(None).cast("string")

    def row(kind: str, table: Column, node_id: Column, src_id: Column, dst_id: Column, props: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), table.alias("table"), node_id.alias("node_id"),
                        src_id.alias("src_id"), dst_id.alias("dst_id"), props.alias("_props"))

    props = decoded_props(d, F.col("name"), F.col("object")) if encoded else F.col("object")
    node = row("nodes", node_table_of(d, F.col("name")), F.col("id"), none, none, F.col("_out"))
    edges = F.transform(_relations(), lambda r: row(
        "edges", edge_table_of(d, F.col("name"), r["dst_name"]), none, F.col("id"), r["dst_id"], F.lit("{}")))
    out = recs.withColumn("_out", props).select(F.explode(F.concat(F.array(node), edges)).alias("r")).select("r.*")
    # fixed values of the stored layout: empty acl, system annotations and edge properties
    return out.withColumns({"acl": F.lit("{}"), "_sysan": F.lit("{}"), "created": F.current_timestamp()})


def validate_records(records: DataFrame, d: Dictionary) -> None:
    """Raise before any write when :func:`import_problems` finds something."""
    bad = import_problems(records, d).orderBy("problem", "name", "dst_name").limit(20).collect()
    if bad:
        raise GraphError("records cannot be imported: " + "; ".join(
            f"{r['problem']} {r['name']}" + (f" -> {r['dst_name']}" if r["problem"].endswith(("edge", "relation id")) else "") + f" ({r['n']})" for r in bad))


def without_existing(restored: Restored, existing_nodes: DataFrame | None = None,
                     existing_edges: DataFrame | None = None) -> Restored:
    """Drop rows already present in the target (re-import without duplicates).

    Left-anti joins on ``(node_table, node_id)`` and ``(edge_table, src_id,
    dst_id)``; Spark picks broadcast or shuffle from the sizes.
    """
    nodes, edges = restored.nodes, restored.edges
    if existing_nodes is not None:
        nodes = nodes.join(existing_nodes.select("node_table", "node_id"),
                           ["node_table", "node_id"], "left_anti")
    if existing_edges is not None:
        edges = edges.join(existing_edges.select("edge_table", "src_id", "dst_id"),
                           ["edge_table", "src_id", "dst_id"], "left_anti")
    return Restored(nodes, edges)
