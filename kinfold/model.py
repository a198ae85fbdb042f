"""Property graph kept in relational tables.

A graph is a *dictionary* (entity types, parent links, typed fields) plus two
loaders that return Spark DataFrames:

* ``nodes(label)``      -> ``(node_id STRING, <property columns>)``
* ``node_object(label)`` -> ``Column`` building the JSON object from those columns
* ``edges(edge_table)`` -> ``(src_id STRING, dst_id STRING)``  -- src = child, dst = parent

The object is built from the property columns only after the node rows are
joined to the selected ids, so unselected rows are never serialized.

The dictionary is metadata (tens of rows) and lives on the driver as plain
Python; every row of data stays in DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class GraphError(ValueError):
    """Invalid dictionary, unknown label or other model-level failure."""


@dataclass(frozen=True)
class EdgeType:
    edge_table: str
    src_label: str  # child
    dst_label: str  # parent


@dataclass(frozen=True)
class PropField:
    label: str
    field: str
    type: str  # Spark SQL type name, e.g. "string", "bigint", "double"
    is_enum: bool = False
    symbols: tuple[str, ...] = ()  # enum values (plain text), for container schemas

    @property
    def is_array(self) -> bool:
        return self.type.lower().startswith("array<")

    def enum_type(self) -> T.DataType:
        """Type of the field when it holds enum text: string or array<string>."""
        return T.ArrayType(T.StringType()) if self.is_array else T.StringType()


NODE_TYPES_SCHEMA = T.StructType([
    T.StructField("label", T.StringType(), False),
    T.StructField("node_table", T.StringType(), False),
])
EDGE_TYPES_SCHEMA = T.StructType([
    T.StructField("edge_table", T.StringType(), False),
    T.StructField("src_label", T.StringType(), False),
    T.StructField("dst_label", T.StringType(), False),
])
PROPS_SCHEMA = T.StructType([
    T.StructField("label", T.StringType(), False),
    T.StructField("field", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("is_enum", T.BooleanType(), False),
])


@dataclass
class Dictionary:
    """Entity types, parent links and typed fields of a graph."""

    node_tables: dict[str, str]  # label -> node table
    edge_types: list[EdgeType]
    props: list[PropField] = field(default_factory=list)

    # -- lookups (G1-G5) -------------------------------------------------
    @property
    def labels(self) -> list[str]:
        return sorted(self.node_tables)

    def node_table(self, label: str) -> str:
        try:
            return self.node_tables[label]
        except KeyError:
            raise GraphError(f"unknown entity type {label!r}") from None

    def label_of_table(self) -> dict[str, str]:
        return {t: lbl for lbl, t in self.node_tables.items()}

    def edge(self, edge_table: str) -> EdgeType:
        for e in self.edge_types:
            if e.edge_table == edge_table:
                return e
        raise GraphError(f"unknown edge table {edge_table!r}")

    def edges_by_child(self, label: str) -> list[EdgeType]:
        """Edge types where ``label`` is the child, ordered by table name."""
        return sorted((e for e in self.edge_types if e.src_label == label),
                      key=lambda e: e.edge_table)

    def edges_by_parent(self, label: str) -> list[EdgeType]:
        return sorted((e for e in self.edge_types if e.dst_label == label),
                      key=lambda e: e.edge_table)

    def edge_table_by_labels(self) -> dict[tuple[str, str], str]:
        """(child, parent) -> edge table; raises on an ambiguous pair."""
        out: dict[tuple[str, str], str] = {}
        for e in self.edge_types:
            key = (e.src_label, e.dst_label)
            if key in out:
                raise GraphError(
                    f"labels {key} have two edge tables: {out[key]!r} and {e.edge_table!r}")
            out[key] = e.edge_table
        return out

    def enum_fields(self, label: str) -> list[str]:
        return [p.field for p in self.props if p.label == label and p.is_enum]

    def fields(self, label: str) -> list[PropField]:
        return [p for p in self.props if p.label == label]

    def spark_schema(self, label: str) -> T.StructType:
        """Typed schema of a label's object; enum fields are strings."""
        return T.StructType([
            T.StructField(p.field, p.enum_type() if p.is_enum
                          else T._parse_datatype_string(p.type), True)
            for p in self.fields(label)])

    # -- validation (M7) -------------------------------------------------
    def validate(self) -> None:
        """Raise before any work on unknown labels, self links or cycles."""
        known = set(self.node_tables)
        tables = set()
        for e in self.edge_types:
            if e.edge_table in tables:
                raise GraphError(f"edge table {e.edge_table!r} defined twice")
            tables.add(e.edge_table)
            for lbl in (e.src_label, e.dst_label):
                if lbl not in known:
                    raise GraphError(f"edge {e.edge_table!r} names unknown type {lbl!r}")
            if e.src_label == e.dst_label:
                raise GraphError(f"edge {e.edge_table!r} links {e.src_label!r} to itself")
        # Kahn's algorithm over child -> parent links
        indeg = {lbl: 0 for lbl in known}
        for e in self.edge_types:
            indeg[e.dst_label] += 1
        ready = [lbl for lbl, d in indeg.items() if d == 0]
        seen = 0
        while ready:
            lbl = ready.pop()
            seen += 1
            for e in self.edges_by_child(lbl):
                indeg[e.dst_label] -= 1
                if indeg[e.dst_label] == 0:
                    ready.append(e.dst_label)
        if seen != len(known):
            cyclic = sorted(lbl for lbl, d in indeg.items() if d > 0)
            raise GraphError(f"type graph has a cycle through {cyclic}")

    # -- DataFrame views (G1) --------------------------------------------
    def node_types_df(self, spark: SparkSession) -> DataFrame:
        rows = sorted(self.node_tables.items())
        return spark.createDataFrame(rows, NODE_TYPES_SCHEMA)

    def edge_types_df(self, spark: SparkSession) -> DataFrame:
        rows = [(e.edge_table, e.src_label, e.dst_label) for e in self.edge_types]
        return spark.createDataFrame(rows, EDGE_TYPES_SCHEMA)

    def props_df(self, spark: SparkSession) -> DataFrame:
        rows = [(p.label, p.field, p.type, p.is_enum) for p in self.props]
        return spark.createDataFrame(rows, PROPS_SCHEMA)


@dataclass
class Graph:
    """Dictionary plus loaders of node and edge DataFrames."""

    spark: SparkSession
    dictionary: Dictionary
    node_loader: Callable[[str], DataFrame]
    edge_loader: Callable[[str], DataFrame]
    object_builder: Callable[[str], Column] | None = None
    typed_builder: Callable[[str], Column] | None = None
    lookup: Callable[[str, DataFrame], DataFrame] | None = None
    edge_filter: Callable[[str, str, DataFrame], DataFrame] | None = None
    object_encoded: bool = False  # node_object() holds enum symbols instead of plain text
    edge_counts: Callable[[str], DataFrame] | None = None  # child label -> (edge_table, n_edges), one scan

    def nodes(self, label: str) -> DataFrame:
        self.dictionary.node_table(label)
        return self.node_loader(label)

    def lookup_nodes(self, label: str, selected: DataFrame) -> DataFrame:
        """Node rows of ``label`` joined to ``selected`` (which has ``node_id``).

        Defaults to an equi-join on ``node_id``; a graph whose ids are built
        from several key columns can join on those columns instead, so the
        id is not rebuilt for every node row.
        """
        if self.lookup is not None:
            return self.lookup(label, selected)
        return self.nodes(label).join(selected, "node_id", "inner")

    def node_object(self, label: str) -> Column:
        """JSON object of a node row of ``label`` (defaults to column ``object``)."""
        if self.object_builder is None:
            return F.col("object")
        return self.object_builder(label)

    def typed_object(self, label: str) -> Column:
        """Object as a typed struct (enum values as encoded symbols).

        Defaults to parsing the JSON object with the dictionary schema.  A field that
        the dictionary lacks, a value of another type or malformed text fails the job
        with the type and id: a container cannot hold it.
        """
        if self.typed_builder is not None:
            return self.typed_builder(label)
        from kinfold.functions.enums import encode_value

        text = self.node_object(label)
        parsed = F.from_json(text, self.dictionary.spark_schema(label))
        given = F.from_json(text, "map<string,variant>")
        declared = self.dictionary.fields(label)
        lost = [F.size(F.array_except(F.map_keys(given), F.array(*(F.lit(p.field) for p in declared)).cast("array<string>"))) > 0,
                text.isNotNull() & F.try_parse_json(text).isNull()]
        for p in declared:
            value = given[p.field]
            kind = F.schema_of_variant(value)
            wrong = parsed[p.field].isNull()
            if p.type.lower() == "string":
                wrong = kind != "STRING"
            lost.append(value.isNotNull() & (kind != "VOID") & wrong)
        failed = F.raise_error(F.concat(F.lit(f"object does not fit type {label}: id "), F.coalesce("node_id", F.lit("null"))))
        # a null struct in the one branch of a failing row is never reached
        return F.when(F.coalesce(reduce(Column.__or__, lost), F.lit(False)), failed).otherwise(
            F.struct(*[(encode_value(parsed[p.field], p.is_array) if p.is_enum
                        else parsed[p.field]).alias(p.field) for p in declared]))

    def edges(self, edge_table: str) -> DataFrame:
        self.dictionary.edge(edge_table)
        return self.edge_loader(edge_table)

    def semi_edges(self, edge_table: str, side: str, ids: DataFrame, ranges: Sequence[tuple] | None = None) -> DataFrame:
        """Edges ``(src_id, dst_id)`` whose ``side`` ("src"/"dst") id is in ``ids.id``.

        Defaults to a left-semi join on the id column; a graph whose edges are
        projections of a wider table can semi-join on the raw key first so
        that ids are only built for matching rows.  ``ranges``: key ranges that hold
        all ids (``operators.frontier``), pushed into the scan of the edges.
        """
        if side not in ("src", "dst"):
            raise ValueError("side must be 'src' or 'dst'")
        if self.edge_filter is not None:
            return self.edge_filter(edge_table, side, ids)
        key = f"{side}_id"
        edges = self.edges(edge_table)
        if ranges is not None:
            from kinfold.operators.frontier import pruned

            edges = pruned(edges, key, ranges)
        return edges.join(ids.select(F.col("id").alias(key)), key, "left_semi")

    def count_edges(self, label: str) -> DataFrame:
        """``(edge_table, n_edges)`` of a child label's edge tables.

        A graph whose edge tables are columns of one table can count them in one scan.
        """
        if self.edge_counts is not None:
            return self.edge_counts(label)
        return reduce(DataFrame.unionByName, (
            self.edges(e.edge_table).agg(F.count(F.lit(1)).alias("n_edges"))
            .select(F.lit(e.edge_table).alias("edge_table"), "n_edges")
            for e in self.dictionary.edges_by_child(label)))

    def check_labels(self, labels: Iterable[str]) -> None:
        for lbl in labels:
            self.dictionary.node_table(lbl)


def tables_graph(spark: SparkSession, dictionary: Dictionary,
                 read_table: Callable[[str], DataFrame]) -> Graph:
    """Graph over tables in the stored layout.

    Node tables hold ``node_id`` and ``_props`` (JSON text); edge tables hold
    ``src_id`` and ``dst_id``.  ``read_table(name)`` returns any DataFrame
    (``spark.table``, a Parquet path, a JDBC reader); only the needed columns
    are selected so that pruning reaches the source.
    """

    def nodes(label: str) -> DataFrame:
        df = read_table(dictionary.node_table(label))
        return df.select(F.col("node_id").cast("string").alias("node_id"), F.col("_props"))

    def edges(edge_table: str) -> DataFrame:
        df = read_table(edge_table)
        return df.select(F.col("src_id").cast("string").alias("src_id"),
                         F.col("dst_id").cast("string").alias("dst_id"))

    return Graph(spark, dictionary, nodes, edges, lambda label: F.col("_props"))


def dictionary_from_rows(node_types: Sequence[tuple[str, str]],
                         edge_types: Sequence[tuple[str, str, str]],
                         props: Sequence[tuple[str, str, str, bool]] = ()) -> Dictionary:
    return Dictionary(
        node_tables=dict(node_types),
        edge_types=[EdgeType(*e) for e in edge_types],
        props=[PropField(*p) for p in props],
    )


def save_dictionary(spark: SparkSession, d: Dictionary, path: str, mode: str = "overwrite") -> None:
    """Write the dictionary as three JSON tables: node_types, edge_types, props."""
    d.node_types_df(spark).coalesce(1).write.mode(mode).json(f"{path}/node_types")
    d.edge_types_df(spark).coalesce(1).write.mode(mode).json(f"{path}/edge_types")
    props = spark.createDataFrame(
        [(i, p.label, p.field, p.type, p.is_enum, list(p.symbols)) for i, p in enumerate(d.props)],
        "pos int, label string, field string, type string, is_enum boolean, symbols array<string>")
    props.coalesce(1).write.mode(mode).json(f"{path}/props")


def load_dictionary(spark: SparkSession, path: str) -> Dictionary:
    """Read a dictionary saved by :func:`save_dictionary`.

    The three tables are read with Spark and brought to the driver: they are
    metadata with one row per type, edge type and field, which the planner
    needs as plain values.  The dictionary is validated before it is returned.
    """
    nt = spark.read.schema(NODE_TYPES_SCHEMA).json(f"{path}/node_types").collect()
    et = spark.read.schema(EDGE_TYPES_SCHEMA).json(f"{path}/edge_types").collect()
    pr = (spark.read.schema("pos int, label string, field string, type string, "
                            "is_enum boolean, symbols array<string>").json(f"{path}/props")
          .orderBy("pos")
          .select("label", "field", "type", F.coalesce("is_enum", F.lit(False)).alias("is_enum"),
                  F.coalesce("symbols", F.array().cast("array<string>")).alias("symbols"))
          .collect())
    d = Dictionary(
        node_tables={r["label"]: r["node_table"] for r in nt},
        edge_types=sorted((EdgeType(r["edge_table"], r["src_label"], r["dst_label"]) for r in et),
                          key=lambda e: e.edge_table),
        props=[PropField(r["label"], r["field"], r["type"], bool(r["is_enum"]),
                         tuple(r["symbols"])) for r in pr])
    d.validate()
    return d


def catalog_graph(spark: SparkSession, dictionary: Dictionary, database: str) -> Graph:
    """Graph over catalog tables in the stored layout (e.g. bucketed restores)."""
    return tables_graph(spark, dictionary, lambda name: spark.table(f"{database}.{name}"))
