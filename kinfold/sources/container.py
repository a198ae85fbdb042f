"""Self-describing entity containers in Avro.

A container holds one Avro record per entity::

    Entity { id: [null, string], name: string,
             object: [Metadata, <type 1>, <type 2>, ...],
             relations: array<Relation { dst_id: string, dst_name: string }> }

The writer schema is derived from the dictionary (K5); enum fields become
Avro enums whose symbols are the encoded values.  The first record is the
``Metadata`` record describing the types and links.

Reading and writing go through Spark's Avro file format, named by class so
it works without the short-name registration: part files are written by
every task in parallel (no single-file writer on the driver) and read back
split by split.  Inside Spark the union ``object`` is a struct with one field
per branch (``member0`` = Metadata, ``member1`` ... = types in schema order).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.functions.enums import encode_symbol
from kinfold.model import Dictionary, GraphError, PropField
from kinfold.operators.traverse import Walk, sorted_relations
from kinfold.sources.ranges import header_schemas, listed

AVRO_FORMAT = "org.apache.spark.sql.avro.AvroFileFormat"
METADATA = "Metadata"

_PRIMITIVES = {
    "string": "string", "bigint": "long", "int": "int", "smallint": "int", "tinyint": "int",
    "double": "double", "float": "float", "boolean": "boolean", "binary": "bytes",
}


def _avro_field_type(label: str, p: PropField):
    if p.is_enum:
        enum = {"type": "enum", "name": f"{label}_{p.field}",
                "symbols": [encode_symbol(s) for s in p.symbols]}
        return ["null", {"type": "array", "items": enum}] if p.is_array else ["null", enum]
    t = p.type.lower()
    if t in _PRIMITIVES:
        return ["null", _PRIMITIVES[t]]
    if t == "timestamp":
        return ["null", {"type": "long", "logicalType": "timestamp-micros"}]
    if t == "timestamp_ntz":
        return ["null", {"type": "long", "logicalType": "local-timestamp-micros"}]
    if t == "date":
        return ["null", {"type": "int", "logicalType": "date"}]
    if t.startswith("array<"):
        inner = t[len("array<"):-1]
        return ["null", {"type": "array", "items": _PRIMITIVES.get(inner, "string")}]
    raise ValueError(f"no container type for {label}.{p.field}: {p.type}")


def container_labels(d: Dictionary) -> list[str]:
    """Union branch order after Metadata: labels in name order."""
    return sorted(d.node_tables)


def metadata_avro_schema() -> dict:
    prop = {"type": "record", "name": "Property", "fields": [
        {"name": "name", "type": "string"},
        {"name": "type", "type": "string"},
        {"name": "is_enum", "type": "boolean"}]}
    link = {"type": "record", "name": "Link", "fields": [
        {"name": "name", "type": "string"},
        {"name": "dst", "type": "string"}]}
    node = {"type": "record", "name": "Node", "fields": [
        {"name": "name", "type": "string"},
        {"name": "links", "type": {"type": "array", "items": link}},
        {"name": "properties", "type": {"type": "array", "items": prop}}]}
    return {"type": "record", "name": METADATA, "fields": [
        {"name": "misc", "type": {"type": "map", "values": "string"}},
        {"name": "nodes", "type": {"type": "array", "items": node}}]}


def entity_schema(d: Dictionary) -> dict:
    """Writer schema of a container for dictionary ``d`` (K5)."""
    branches = [metadata_avro_schema()]
    for label in container_labels(d):
        branches.append({"type": "record", "name": label, "fields": [
            {"name": p.field, "type": _avro_field_type(label, p), "default": None}
            for p in d.fields(label)]})
    relation = {"type": "record", "name": "Relation", "fields": [
        {"name": "dst_id", "type": "string"}, {"name": "dst_name", "type": "string"}]}
    return {"type": "record", "name": "Entity", "fields": [
        {"name": "id", "type": ["null", "string"]},
        {"name": "name", "type": "string"},
        {"name": "object", "type": branches},
        {"name": "relations", "type": {"type": "array", "items": relation}}]}


def _metadata_struct_type() -> T.StructType:
    return T.StructType([
        T.StructField("misc", T.MapType(T.StringType(), T.StringType())),
        T.StructField("nodes", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("links", T.ArrayType(T.StructType([
                T.StructField("name", T.StringType()), T.StructField("dst", T.StringType())]))),
            T.StructField("properties", T.ArrayType(T.StructType([
                T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
                T.StructField("is_enum", T.BooleanType())])))])))])


def _object_struct(d: Dictionary, label: str | None, value: Column) -> Column:
    """Union struct with ``value`` in the branch of ``label`` (None = Metadata)."""
    members = [(value if label is None else F.lit(None).cast(_metadata_struct_type()))
               .alias("member0")]
    for i, lbl in enumerate(container_labels(d), start=1):
        if lbl == label:
            members.append(value.alias(f"member{i}"))
        else:
            members.append(F.lit(None).cast(d.spark_schema(lbl)).alias(f"member{i}"))
    return F.struct(*members)


def _metadata_frame(spark: SparkSession, d: Dictionary) -> DataFrame:
    nodes = []
    for label in container_labels(d):
        links = [(e.edge_table, e.dst_label) for e in d.edges_by_child(label)]
        props = [(p.field, p.type, p.is_enum) for p in d.fields(label)]
        nodes.append((label, links, props))
    row = [({"format": "entity-container"}, nodes)]
    meta = spark.createDataFrame(row, _metadata_struct_type())
    return meta.select(
        F.lit(-1).alias("topo_rank"), F.lit(None).cast("string").alias("id"),
        F.lit(METADATA).alias("name"),
        _object_struct(d, None, F.struct("misc", "nodes")).alias("object"),
        F.array().cast("array<struct<dst_id:string,dst_name:string>>").alias("relations"))


def container_frame(walk: Walk) -> DataFrame:
    """Metadata row plus one typed entity row per selected node, with rank."""
    g, d = walk.graph, walk.graph.dictionary
    frames = [_metadata_frame(g.spark, d)]
    for label in sorted(walk.states, key=lambda lbl: (walk.ranks[lbl], lbl)):
        state = walk.states[label].select(F.col("id").alias("node_id"), "relations")
        joined = g.lookup_nodes(label, state)
        frames.append(joined.select(
            F.lit(walk.ranks[label]).alias("topo_rank"), F.col("node_id").alias("id"),
            F.lit(label).alias("name"),
            _object_struct(d, label, g.typed_object(label)).alias("object"),
            sorted_relations(F.col("relations")).alias("relations")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def rank_dir(topo_rank: Column) -> Column:
    """Zero-padded directory value: ``rank=0000`` holds Metadata, then 0001, ..."""
    return F.lpad((topo_rank + 1).cast("string"), 4, "0")


def write_container(walk: Walk, path: str, mode: str = "errorifexists",
                    max_records_per_file: int = 1_000_000) -> dict:
    """Write the walk's entities as an Avro container directory (K4).

    Files go to ``rank=NNNN/`` sub-folders: listing them in name order gives
    the Metadata record first and parents before children.  The frame is a
    union of per-type joins, so every task holds one type and writes one
    file per rank; no shuffle or sampling pass is added and a large type
    stays spread over all its tasks.  Returns the writer schema.
    """
    schema = entity_schema(walk.graph.dictionary)
    frame = container_frame(walk)
    ordered = (frame.withColumn("rank", rank_dir(F.col("topo_rank"))).drop("topo_rank")
               .sortWithinPartitions("rank", "id"))
    (ordered.write.mode(mode).format(AVRO_FORMAT)
     .option("avroSchema", json.dumps(schema))
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("rank")
     .save(path))
    return schema


def read_container_raw(spark: SparkSession, path: str, schema: dict | None = None) -> DataFrame:
    """Container rows as Spark reads them (union ``object`` as member struct) (S3).

    Part files are read split by split; the ``rank`` folder value comes back
    as a column when the container was written by :func:`write_container`.
    ``schema``: the merged schema to read all parts with (:func:`container_schema`).
    """
    reader = spark.read.format(AVRO_FORMAT).option("pathGlobFilter", "*.avro")
    if schema is not None:
        reader = reader.option("avroSchema", json.dumps(schema))
    return reader.load(path)


def read_container(spark: SparkSession, path: str, schema: dict | None = None) -> DataFrame:
    """Container -> records ``(name, id, object JSON, relations)``.

    The branch that is set is the entity's own type; its struct is turned
    back into JSON text so the import path is shared with Parquet records.
    """
    return container_records(read_container_raw(spark, path, schema))


def container_schema(spark: SparkSession, path: str) -> dict:
    """Writer schema of all part files (S4; headers only, read in tasks).

    Parts written with different schemas are merged: new types, new fields, more enum symbols and wider numbers; anything
    else fails with the part, the type and the field.  What comes to the driver is one row per different schema.
    """
    found = (header_schemas(listed(spark, path, "*.avro")).groupBy("schema").agg(F.min("path").alias("path"))
             .orderBy("path").collect())
    if not found:
        raise GraphError(f"no container parts below {path}")
    merged = json.loads(found[0]["schema"])
    for r in found[1:]:
        merged = merge_schemas(merged, json.loads(r["schema"]), r["path"])
    return merged


#: wider last
_NUMBERS = ["int", "long", "float", "double"]


def merge_schemas(a: dict, b: dict, part: str) -> dict:
    """Schema ``a`` widened so that it reads what was written with ``b``; ``part`` names b's file in errors."""
    if a == b:
        return a
    return _merged(a, b, part, a.get("name", ""))


def _merged(a, b, part: str, where: str):
    if a == b:
        return a

    def conflict():
        return GraphError(f"{part}: {where} is {json.dumps(b)[:200]}, elsewhere {json.dumps(a)[:200]}")

    if isinstance(a, list) and isinstance(b, list):
        return _merged_union(a, b, part, where)
    if isinstance(a, dict) and isinstance(b, dict) and a.get("type") == b.get("type") and a.get("logicalType") == b.get("logicalType"):
        kind = a["type"]
        if kind == "record" and a["name"] == b["name"]:
            own = {f["name"]: f for f in a["fields"]}
            other = {f["name"]: f for f in b["fields"]}
            late = [f for f in b["fields"] if f["name"] not in own]
            for f in [*late, *(f for f in a["fields"] if f["name"] not in other)]:
                if "default" not in f:  # some parts lack it
                    raise GraphError(f"{part}: {where}.{f['name']} is not in all parts and has no default")
            fields = [f | {"type": _merged(f["type"], other[f["name"]]["type"], part, f"{where}.{f['name']}")} if f["name"] in other else f
                      for f in a["fields"]]
            return a | {"fields": fields + late}
        if kind == "enum" and a["name"] == b["name"]:
            return a | {"symbols": a["symbols"] + [s for s in b["symbols"] if s not in a["symbols"]]}
        if kind in ("array", "map"):
            inner = "items" if kind == "array" else "values"
            return a | {inner: _merged(a[inner], b[inner], part, where)}
        raise conflict()
    if a in _NUMBERS and b in _NUMBERS:
        return max(a, b, key=_NUMBERS.index)
    raise conflict()


def _merged_union(a: list, b: list, part: str, where: str) -> list:
    """Records are matched by name, new ones are added; any other branch must have its match."""
    def is_record(t) -> bool:
        return isinstance(t, dict) and t.get("type") == "record"

    own, other = ({t["name"]: t for t in x if is_record(t)} for x in (a, b))
    rest_a, rest_b = ([t for t in x if not is_record(t) and t != "null"] for x in (a, b))
    if len(rest_a) != len(rest_b) or ("null" in a) != ("null" in b):
        raise GraphError(f"{part}: {where} is {json.dumps(b)[:200]}, elsewhere {json.dumps(a)[:200]}")
    matched = {id(x): _merged(x, y, part, where) for x, y in zip(rest_a, rest_b, strict=True)}
    out = [matched.get(id(t), _merged(t, other[t["name"]], part, t["name"]) if is_record(t) and t["name"] in other else t) for t in a]
    return out + [t for name, t in other.items() if name not in own]


def _is_enum(t) -> bool:
    if isinstance(t, dict):
        if t.get("type") == "array":
            return _is_enum(t.get("items"))
        return t.get("type") == "enum"
    if isinstance(t, list):
        return any(_is_enum(x) for x in t)
    return False


def _type_name(t) -> str:
    if isinstance(t, list):
        names = [_type_name(x) for x in t if x != "null"]
        return names[0] if len(names) == 1 else "union"
    if isinstance(t, dict):
        return t.get("type", "record")
    return str(t)


def _entity_fields(schema: dict):
    """(type name, Avro field) of every entity branch of ``object``."""
    objects = next(f for f in schema["fields"] if f["name"] == "object")
    return [(branch["name"], fld) for branch in objects["type"]
            if branch.get("name") != METADATA for fld in branch["fields"]]


def schema_fields(schema: dict) -> list[tuple[str, str, str, bool]]:
    """(type name, field, Avro type, is_enum) for every entity branch."""
    return [(name, fld["name"], _type_name(fld["type"]), _is_enum(fld["type"]))
            for name, fld in _entity_fields(schema)]


def container_schema_fields(spark: SparkSession, path: str) -> DataFrame:
    rows = schema_fields(container_schema(spark, path))
    return spark.createDataFrame(rows, "name string, field string, type string, is_enum boolean")


_SPARK_OF_AVRO = {"string": "string", "long": "bigint", "int": "int", "double": "double",
                  "float": "float", "boolean": "boolean", "bytes": "binary"}
_SPARK_OF_LOGICAL = {"timestamp-micros": "timestamp", "timestamp-millis": "timestamp",
                     "local-timestamp-micros": "timestamp_ntz",
                     "local-timestamp-millis": "timestamp_ntz", "date": "date"}


def _spark_type(t) -> tuple[str, bool, tuple[str, ...]]:
    """(Spark type, is_enum, symbols) of an Avro field type."""
    if isinstance(t, list):
        inner = [x for x in t if x != "null"]
        return _spark_type(inner[0]) if len(inner) == 1 else ("string", False, ())
    if isinstance(t, dict):
        if t.get("type") == "enum":
            return "string", True, tuple(t.get("symbols", ()))
        if t.get("logicalType") in _SPARK_OF_LOGICAL:
            return _SPARK_OF_LOGICAL[t["logicalType"]], False, ()
        if t.get("type") == "array":
            item, is_enum, symbols = _spark_type(t.get("items", "string"))
            return f"array<{item}>", is_enum, symbols
        return _spark_type(t.get("type", "string"))
    return _SPARK_OF_AVRO.get(str(t), "string"), False, ()


def props_from_schema(schema: dict) -> list[PropField]:
    """Typed fields and enum flags of every entity branch.

    Enum symbols are kept as written (encoded); decoding needs the flag only.
    """
    return [PropField(name, fld["name"], *_spark_type(fld["type"]))
            for name, fld in _entity_fields(schema)]


def container_records(raw: DataFrame) -> DataFrame:
    """Raw container rows -> records ``(name, id, object JSON, relations)``."""
    members = [f.name for f in raw.schema["object"].dataType.fields if f.name != "member0"]
    obj = F.coalesce(*[F.to_json(F.col(f"object.{m}"), {"ignoreNullFields": "false"})
                       for m in members]) if members else F.lit(None).cast("string")
    return raw.select("name", "id", obj.alias("object"), "relations")
