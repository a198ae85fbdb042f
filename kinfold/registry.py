"""Registered queries over the star-schema fixture and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  Column names match the oracle SQL one for one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold import jobs
from kinfold.functions.enums import decode_enum, encode_enum, encode_symbol_sql
from kinfold.functions.props import json_int
from kinfold.model import Dictionary, load_dictionary, save_dictionary, tables_graph
from kinfold.operators import cohort as co
from kinfold.operators import restore as rs
from kinfold.operators.frontier import RANGES
from kinfold.operators.records import relations_text, walk_records
from kinfold.operators.traverse import Materializer, walk_graph
from kinfold.plans import typegraph as tg
from kinfold.sources import star
from kinfold.sources import container as ct
from kinfold.sources.jdbc import keyed_scan
from kinfold.sources.commits import ImportLog
from kinfold.sources.manifest import artifact_manifest
from kinfold.sources.sinks import write_records, write_restored_files
from kinfold.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

# fixed values of the registered requests
ROOT = "customer"
FLAGSHIP_FILTER = {"AND": [{"=": {"c_nationkey": 7}}, {"=": {"c_mktsegment": "BUILDING"}}]}
FLAGSHIP_EXTRA = ["supplier"]
EQ_FILTER = {"=": {"c_mktsegment": "BUILDING"}}
IN_FILTER = {"in": {"c_mktsegment": ["BUILDING", "MACHINERY"]}}
RANGE_FILTER = {">=": {"c_acctbal": 5000}}
REGION_ROOT_FILTER = {"=": {"n_regionkey": 2}}
N_LABELS = len(star.LABELS)


# --------------------------------------------------------------------------
# shared building blocks

def flagship_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = star.cohort_index(spark, sf_dir)
    return co.select_cohort(index, ROOT, FLAGSHIP_FILTER, star.grants(spark, sf_dir))


def flagship_walk(spark: SparkSession, sf_dir: str, extra=FLAGSHIP_EXTRA,
                  include_upward: bool = True):
    graph = star.star_graph(spark, sf_dir)
    return walk_graph(graph, flagship_cohort(spark, sf_dir), ROOT, extra, include_upward)


def flagship_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walk_records(flagship_walk(spark, sf_dir))


def with_object_values(df: DataFrame, d: Dictionary, encoded: bool, obj: str = "object") -> DataFrame:
    """df (with ``name``) plus ``values``: all of the object's values as sorted ``field=value`` pairs joined by ``|``.

    Enum symbols are decoded first; doubles are shown with four decimals, timestamps
    to the second, nulls as ``null``.  Fields beyond the dictionary would show as ``+field``.
    """
    labels = sorted(d.node_tables)
    fields = {lbl: sorted(d.fields(lbl), key=lambda p: p.field) for lbl in labels}
    plain = rs.decoded_props(d, F.col("name"), F.col(obj)) if encoded else F.col(obj)
    # one parse of each row, in a projection of its own
    parsed = df.withColumn("_plain", plain).select("*", *(
        F.when(F.col("name") == lbl, F.from_json("_plain", ", ".join(f"`{p.field}` {p.type}" for p in fields[lbl]))).alias(f"_parsed{i}")
        for i, lbl in enumerate(labels)))

    def shown(i: int, p) -> Column:
        v = F.col(f"_parsed{i}")[p.field]
        if p.type == "double":
            v = v.cast("decimal(20,4)")
        elif p.type.startswith("timestamp"):
            v = F.date_format(v, "yyyy-MM-dd HH:mm:ss")
        return F.concat(F.lit(f"{p.field}="), F.coalesce(v.cast("string"), F.lit("null")))

    keys = F.coalesce(F.json_object_keys("_plain"), F.array().cast("array<string>"))
    out: Column | None = None
    for i, lbl in enumerate(labels):
        extra = F.transform(F.array_sort(F.array_except(keys, F.array(*(F.lit(p.field) for p in fields[lbl])))), lambda k: F.concat(F.lit("+"), k))
        value = F.array_join(F.concat(F.array(*(shown(i, p) for p in fields[lbl])), extra), "|")
        out = F.when(F.col("name") == lbl, value) if out is None else out.when(F.col("name") == lbl, value)
    return parsed.withColumn("values", out)


def _shape(recs: DataFrame, spark, sf_dir, encoded: bool = True, rank: bool = True) -> DataFrame:
    """Records as ids, relations and all object values; objects of the star graph hold enum symbols."""
    valued = with_object_values(recs, star.star_dictionary(spark, sf_dir), encoded)
    return valued.select(*(["topo_rank"] if rank else []), "name", "id", F.col("values").alias("object"),
                         relations_text("relations").alias("relations"))


def _state_rows(walk, labels) -> DataFrame:
    frames = [walk.state(lbl).select(F.lit(lbl).alias("name"), "id",
                                     relations_text(F.sort_array("relations")).alias("relations"))
              for lbl in labels]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --------------------------------------------------------------------------
# walk and records

def q_export_records(spark, sf_dir):
    """B1: the flagship export (customer cohort, extra supplier, upward)."""
    return _shape(flagship_records(spark, sf_dir), spark, sf_dir)


def q_traverse_up(spark, sf_dir):
    """Ids and relations of the upward path (root, nation, region)."""
    w = flagship_walk(spark, sf_dir, extra=None)
    return _state_rows(w, ["customer", "nation", "region"])


def q_traverse_down(spark, sf_dir):
    """J1, semantics 9: downward only; root records carry no relations."""
    w = flagship_walk(spark, sf_dir, extra=None, include_upward=False)
    return _state_rows(w, ["customer", "orders", "lineitem"])


def q_traverse_multi_parent(spark, sf_dir):
    """Line items reached through orders OR suppliers of five nations."""
    graph = star.star_graph(spark, sf_dir)
    index = star.read(spark, sf_dir, "nation").withColumn(
        "_nation_id", F.col("n_nationkey").cast("string"))
    cohort = co.select_cohort(index, "nation", REGION_ROOT_FILTER)
    w = walk_graph(graph, cohort, "nation", None, include_upward=False)
    return _state_rows(w, ["lineitem"])


def q_traverse_extra_siblings(spark, sf_dir):
    """Semantics 7: an extra on the upward path pulls in its siblings once."""
    w = flagship_walk(spark, sf_dir, extra=["nation"])
    return _state_rows(w, ["nation", "region"])


def q_traverse_extra_orphan(spark, sf_dir):
    """Semantics 6: an extra type without parents selects nothing; counts per type."""
    w = flagship_walk(spark, sf_dir, extra=["part"])
    recs = walk_records(w)
    return recs.groupBy("name").agg(F.count(F.lit(1)).alias("n_records"))


def q_export_downward_records(spark, sf_dir):
    """Records of a downward-only export: root records without relations."""
    return _shape(walk_records(flagship_walk(spark, sf_dir, extra=None, include_upward=False)), spark, sf_dir)


LINEITEM_FILTER = {"=": {"l_returnflag": "R"}}


def q_export_up_from_lineitem(spark, sf_dir):
    """Up walk from line items: three parent types, ids parsed on the child side."""
    graph = star.star_graph(spark, sf_dir)
    li = star.read(spark, sf_dir, "lineitem")
    index = li.select(star.node_id("lineitem").alias("_lineitem_id"), *li.columns)
    cohort = co.select_cohort(index, "lineitem", LINEITEM_FILTER)
    return _shape(walk_records(walk_graph(graph, cohort, "lineitem", None, True)), spark, sf_dir)


def q_selected_nodes(spark, sf_dir):
    """Per type, ids selected by the walk and node rows emitted."""
    w = flagship_walk(spark, sf_dir)
    recs = walk_records(w)
    ids = None
    for lbl in sorted(w.states):
        f = w.frontier(lbl).select(F.lit(lbl).alias("name"), "id")
        ids = f if ids is None else ids.unionByName(f)
    sel = ids.groupBy("name").agg(F.count(F.lit(1)).alias("n_selected"))
    emitted = recs.groupBy("name").agg(F.count(F.lit(1)).alias("n_nodes"))
    return sel.join(emitted, "name", "left").select(
        "name", "n_selected", F.coalesce("n_nodes", F.lit(0)).alias("n_nodes"))


def q_relations_by_node(spark, sf_dir):
    """A1: flat relations of every selected node."""
    w = flagship_walk(spark, sf_dir)
    frames = [w.relation_rows(lbl) for lbl in sorted(w.states)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_edge_projection(spark, sf_dir):
    """Every edge of every edge table as (edge_table, src_id, dst_id)."""
    graph = star.star_graph(spark, sf_dir)
    out = None
    for e in graph.dictionary.edge_types:
        f = graph.edges(e.edge_table).select(F.lit(e.edge_table).alias("edge_table"),
                                             "src_id", "dst_id")
        out = f if out is None else out.unionByName(f)
    return out


def q_keyed_scan(spark, sf_dir):
    """Orders rows whose customer is in the flagship cohort."""
    orders = star.read(spark, sf_dir, "orders")
    rows = keyed_scan(orders, flagship_cohort(spark, sf_dir), "o_custkey")
    return rows.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       "o_orderpriority")


def q_ranged_scan(spark, sf_dir):
    """Line items of the flagship cohort's orders, scanned within the orders' key ranges."""
    rows = keyed_scan(star.read(spark, sf_dir, "lineitem"), q_keyed_scan(spark, sf_dir), "l_orderkey", "o_orderkey", RANGES)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def q_record_objects(spark, sf_dir):
    """Order objects of the export parsed back with enum fields decoded."""
    d = star.star_dictionary(spark, sf_dir)
    recs = flagship_records(spark, sf_dir).where(F.col("name") == "orders")
    p = F.from_json(rs.decoded_props(d, F.col("name"), F.col("object")), d.spark_schema("orders"))
    return recs.select("id", *(p[c].alias(c) for c in (
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")))


# --------------------------------------------------------------------------
# cohort

def q_cohort_ids(spark, sf_dir):
    """Ids of the flagship cohort."""
    return flagship_cohort(spark, sf_dir)


def q_cohort_filter_eq(spark, sf_dir):
    """Index rows matching an equality filter, no access restriction."""
    index = star.cohort_index(spark, sf_dir)
    return co.cohort_rows(index, EQ_FILTER).select("_customer_id", "auth_resource_path")


def q_cohort_accessible(spark, sf_dir):
    """Every index row the caller may read."""
    index = star.cohort_index(spark, sf_dir)
    return co.cohort_rows(index, {}, star.grants(spark, sf_dir)).select(
        "_customer_id", "auth_resource_path")


def q_cohort_count(spark, sf_dir):
    """A5: size of an accessible cohort."""
    index = star.cohort_index(spark, sf_dir)
    return co.cohort_count(index, IN_FILTER, star.grants(spark, sf_dir))


def q_cohort_authz(spark, sf_dir):
    """Distinct authorization paths of an accessible cohort."""
    index = star.cohort_index(spark, sf_dir)
    return co.cohort_authz(index, RANGE_FILTER, star.grants(spark, sf_dir))


# --------------------------------------------------------------------------
# type graph over the populated edge types

N_EDGE_TYPES = len(star.LINKS)


def _populated(spark, sf_dir, written: bool = False) -> DataFrame:
    """Populated edge types; ``written`` stores the small aggregate once so the
    type-graph queries do not rescan the edge tables per step."""
    df = tg.populated_edge_types(star.star_graph(spark, sf_dir))
    return Materializer(spark, concurrent_writes=1)(df, "edge-types") if written else df


def q_dictionary_edges(spark, sf_dir):
    """Edge types of a dictionary saved to and loaded from files, with their edge counts in the data."""
    path = scratch_dir(spark, "dictionary")
    save_dictionary(spark, star.star_dictionary(spark, sf_dir), path)
    known = load_dictionary(spark, path).edge_types_df(spark)
    return _populated(spark, sf_dir).join(known, ["edge_table", "src_label", "dst_label"])


def q_type_tables(spark, sf_dir):
    """Node table of every type that has rows, by the loaded dictionary, with its row count."""
    d = star.star_dictionary(spark, sf_dir)
    counted = [star.read(spark, sf_dir, lbl).agg(F.count(F.lit(1)).alias("n_nodes"))
               .select(F.lit(lbl).alias("label"), "n_nodes") for lbl in sorted(d.node_tables)]
    rows = counted[0]
    for f in counted[1:]:
        rows = rows.unionByName(f)
    return rows.where("n_nodes > 0").join(d.node_types_df(spark), "label")


def q_edge_labels(spark, sf_dir):
    """Child and parent type of the edge tables that an export's relations go to, with counts."""
    d = star.star_dictionary(spark, sf_dir)
    rel = rs.relation_rows(flagship_records(spark, sf_dir))
    table = rs.edge_table_of(d, F.col("name"), F.col("dst_name"))
    used = rel.groupBy(table.alias("edge_table")).agg(F.count(F.lit(1)).alias("n_relations"))
    return used.join(d.edge_types_df(spark), "edge_table")


def q_edges_by_type(spark, sf_dir):
    """Per child type, its edge tables."""
    return tg.edges_by_type(_populated(spark, sf_dir))


def q_ambiguous_edges(spark, sf_dir):
    """Type pairs with more than one edge table; orders and line items are one type here."""
    merged = F.when(F.col("src_label") == "lineitem", "orders").otherwise(F.col("src_label"))
    parent = F.when(F.col("dst_label") == "supplier", "part").otherwise(F.col("dst_label"))
    return tg.ambiguous_edges(_populated(spark, sf_dir).withColumns({"src_label": merged, "dst_label": parent}))


def q_type_topology(spark, sf_dir):
    """Upward and downward orders from the root type."""
    return tg.type_topology(_populated(spark, sf_dir, True), ROOT, N_LABELS)


def q_type_bfs(spark, sf_dir):
    """Breadth-first levels below the top type."""
    return tg.type_bfs(_populated(spark, sf_dir, True), "region", N_LABELS)


def q_traversal_plan(spark, sf_dir):
    """The flagship's visit plan."""
    return tg.traversal_plan_df(_populated(spark, sf_dir, True), ROOT, FLAGSHIP_EXTRA, True,
                                N_LABELS)


# --------------------------------------------------------------------------
# import

def _restored(spark, sf_dir, d: Dictionary | None = None):
    d = d or star.star_dictionary(spark, sf_dir)
    return rs.restore_records(flagship_records(spark, sf_dir), d, encoded=True)


def _node_values(r, d: Dictionary) -> DataFrame:
    """Restored node rows with all property values."""
    label = F.create_map(*(F.lit(x) for lbl, t in sorted(d.node_tables.items()) for x in (t, lbl)))[F.col("node_table")]
    rows = with_object_values(r.nodes.withColumn("name", label), d, False, obj="_props")
    return rows.select("node_table", "node_id", F.size(F.json_object_keys("_props")).alias("n_props"),
                       F.col("values").alias("props"))


def q_import_nodes(spark, sf_dir):
    """Node rows by target table with every property value."""
    return _node_values(_restored(spark, sf_dir), star.star_dictionary(spark, sf_dir))


def q_import_edges(spark, sf_dir):
    """Edge rows by target table."""
    r = _restored(spark, sf_dir)
    return r.edges.select("edge_table", "src_id", "dst_id")


def q_distinct_types(spark, sf_dir):
    """A2: entity types in the export."""
    return rs.distinct_types(flagship_records(spark, sf_dir))


def q_distinct_edge_tables(spark, sf_dir):
    """A3: edge tables the export writes to."""
    return rs.distinct_edge_tables(flagship_records(spark, sf_dir),
                                   star.star_dictionary(spark, sf_dir))


def _without_supplier(d: Dictionary) -> Dictionary:
    return Dictionary(
        node_tables={k: v for k, v in d.node_tables.items() if k != "supplier"},
        edge_types=[e for e in d.edge_types if "supplier" not in (e.src_label, e.dst_label)],
        props=[p for p in d.props if p.label != "supplier"])


def q_unknown_types(spark, sf_dir):
    """J6 check: export restored into a dictionary without ``supplier``."""
    d = _without_supplier(star.star_dictionary(spark, sf_dir))
    return rs.unknown_types(flagship_records(spark, sf_dir), d)


def q_unknown_edges(spark, sf_dir):
    """J5 check: relations without an edge table in that dictionary."""
    d = _without_supplier(star.star_dictionary(spark, sf_dir))
    return rs.unknown_edges(flagship_records(spark, sf_dir), d)


def q_import_problems(spark, sf_dir):
    """B2: all reasons to refuse the export, in one scan, for a dictionary without ``supplier``."""
    d = _without_supplier(star.star_dictionary(spark, sf_dir))
    return rs.import_problems(flagship_records(spark, sf_dir), d)


def q_roundtrip_edges(spark, sf_dir):
    """Export -> restore into tables -> export from the restored tables.

    The restored node and edge tables are written partitioned by target
    table into the shared folder, then read back with partition pruning per
    type, as a restore into a clean store would be.
    """
    d = star.star_dictionary(spark, sf_dir)
    path = scratch_dir(spark, "restored")
    export = flagship_records(spark, sf_dir)
    write_records(export, f"{path}/export")  # once; the node and the edge write each prune it
    records = spark.read.schema(export.schema).parquet(f"{path}/export")
    write_restored_files(rs.restore_records(records, d, encoded=True), path)
    by_label = {t: lbl for lbl, t in d.node_tables.items()}
    nodes = spark.read.parquet(f"{path}/nodes")
    edges = spark.read.parquet(f"{path}/edges")

    def read_table(name: str) -> DataFrame:
        if name in by_label:
            return nodes.where(F.col("node_table") == name)
        return edges.where(F.col("edge_table") == name)

    g2 = tables_graph(spark, d, read_table)
    w2 = walk_graph(g2, flagship_cohort(spark, sf_dir), ROOT, FLAGSHIP_EXTRA, True)
    return _shape(walk_records(w2), spark, sf_dir, encoded=False)


# --------------------------------------------------------------------------
# container

def _written_container(spark, sf_dir) -> str:
    path = scratch_dir(spark, "container")
    ct.write_container(flagship_walk(spark, sf_dir), path)
    return path


def q_import_commit(spark, sf_dir):
    """The export imported with one id twice, then again without the keys that are there.

    Rows and imports per table: the second and the third job must add none.
    """
    d = star.star_dictionary(spark, sf_dir)
    path, target = _written_container(spark, sf_dir), scratch_dir(spark, "imports")
    for import_id in ("first", "first"):
        jobs.import_job(spark, path, d, target=target, import_id=import_id)
    jobs.import_job(spark, path, d, target=target, import_id="second", skip_existing=True)
    log = ImportLog(spark, target)
    tables = [log.table(kind).select(F.lit(kind).alias("kind"), F.col(f"{kind[:-1]}_table").alias("table"), "import") for kind in ("nodes", "edges")]
    return tables[0].unionByName(tables[1]).groupBy("kind", "table").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("import").alias("import"))


def q_container_scan(spark, sf_dir):
    """K4/K5 + S3/X1: export written as an Avro container and read back."""
    recs = rs.data_records(ct.read_container(spark, _written_container(spark, sf_dir)))
    return _shape(recs, spark, sf_dir, rank=False)


def q_container_import_nodes(spark, sf_dir):
    """S3 -> B2: restore from the written container; node rows by target table."""
    d = star.star_dictionary(spark, sf_dir)
    recs = ct.read_container(spark, _written_container(spark, sf_dir))
    return _node_values(rs.restore_records(recs, d, encoded=True), d)


def q_artifact_manifest(spark, sf_dir):
    """What must hold of the manifest of the written parts, per type.

    Names, hashes and sizes vary from run to run; their form, the records of the listed files and
    the cohort's authorization paths do not.
    """
    path = scratch_dir(spark, "export")
    write_records(flagship_records(spark, sf_dir), path)
    name = F.regexp_extract(F.col("urls")[0], "name=([^/]+)/", 1)
    days = F.round((F.col("expires_at") - F.unix_timestamp()) / 86400).cast("int")
    ok = ((F.length("md5") == 32) & (F.col("hashes")["md5"] == F.col("md5")) & (F.col("size") > 0)
          & F.col("urls")[0].endswith(F.col("file_name")))
    parts = artifact_manifest(spark, path, glob="*.parquet").groupBy(name.alias("name")).agg(
        F.max("form").alias("form"), F.min(ok).alias("all_valid"), F.max(days).alias("expires_in_days"))
    held = spark.read.parquet(path).groupBy("name").agg(F.count(F.lit(1)).alias("n_records"))
    authz = co.cohort_authz(star.cohort_index(spark, sf_dir), FLAGSHIP_FILTER, star.grants(spark, sf_dir))
    return parts.join(held, "name").withColumn("authz", F.lit(",".join(sorted(r[0] for r in authz.collect()))))


def q_container_schema_fields(spark, sf_dir):
    """Entity types, fields and enum flags from the container header."""
    return ct.container_schema_fields(spark, _written_container(spark, sf_dir))


# --------------------------------------------------------------------------
# scalar functions

def q_props_extract(spark, sf_dir):
    """Integer field of the JSON props of every event."""
    ev = star.read(spark, sf_dir, "events")
    return ev.select("event_id", json_int("props", "k").alias("k"))


def q_encode_enum(spark, sf_dir):
    """Enum symbols of part names, brands and types."""
    part = star.read(spark, sf_dir, "part")
    return part.select("p_partkey", encode_enum("p_name").alias("name_symbol"),
                       encode_enum("p_brand").alias("brand_symbol"),
                       encode_enum("p_type").alias("type_symbol"))


def q_decode_enum(spark, sf_dir):
    """decode(encode(x)) == x over part names and brands and order priorities."""
    part = star.read(spark, sf_dir, "part")
    return part.select("p_partkey", decode_enum(encode_enum("p_name")).alias("p_name"),
                       decode_enum(encode_enum("p_brand")).alias("p_brand"))


def q_encode_enum_text(spark, sf_dir):
    """E3 on real text: the symbol of every document's whole text, as its length and hash."""
    docs = star.read(spark, sf_dir, "documents").select("doc_id", encode_enum("text").alias("symbol"))
    return docs.select("doc_id", F.length("symbol").alias("n_chars"), F.md5("symbol").alias("md5"))


def q_decode_enum_text(spark, sf_dir):
    """E2 on real text: decode(encode(x)) of every document's whole text, as its hash."""
    docs = star.read(spark, sf_dir, "documents").select("doc_id", encode_enum("text").alias("symbol"))
    return docs.select("doc_id", F.md5(decode_enum("symbol")).alias("md5"))


# --------------------------------------------------------------------------
# DuckDB oracles

_GRANTED = ", ".join(f"'{p}'" for p in star.GRANTED_PROGRAMS)
_INDEX_SQL = """
select c.c_custkey::varchar _customer_id, c.*,
       '/programs/' || r.r_name || '/projects/' || n.n_name auth_resource_path
from customer c left join nation n on c.c_nationkey = n.n_nationkey
  left join region r on n.n_regionkey = r.r_regionkey"""
_ACCESSIBLE_SQL = f"""
select * from ({_INDEX_SQL}) where auth_resource_path in (
  select '/programs/' || r.r_name || '/projects/' || n.n_name from nation n
  join region r on n.n_regionkey = r.r_regionkey where r.r_name in ({_GRANTED}))"""
_COHORT_SQL = f"""
select * from ({_ACCESSIBLE_SQL}) where c_nationkey = 7 and c_mktsegment = 'BUILDING'"""

_LI_ID = star.node_id_sql("lineitem")


def _values_sql(label: str, alias: str = "t") -> str:
    """DuckDB expression of :func:`object_values` over a row of the label's table."""
    shown = []
    for column, kind in sorted(star.COLUMNS[label].items()):
        c = f"{alias}.{column}"
        if kind == "double":
            c = f"{c}::decimal(20,4)"
        elif kind == "timestamp":
            c = f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
        shown.append(f"'{column}=' || coalesce({c}::varchar, 'null')")
    return "concat_ws('|', " + ", ".join(shown) + ")"


#: (name, id, object) of every row of every table
_OBJECTS_SQL = " union all ".join(
    f"select '{lbl}' name, {star.node_id_sql(lbl)} id, {_values_sql(lbl)} as object from {lbl} t" for lbl in star.LABELS)

_FLAGSHIP_CTES = f"""
cu as ({_COHORT_SQL}),
na as (select * from nation where n_nationkey in (select c_nationkey from cu)),
re as (select * from region where r_regionkey in (select n_regionkey from na)),
su as (select * from supplier where s_nationkey in (select n_nationkey from na)),
o as (select * from orders where o_custkey in (select c_custkey from cu)),
li as (select *, {_LI_ID} id from lineitem
       where l_orderkey in (select o_orderkey from o) or l_suppkey in (select s_suppkey from su)),
rel as (select distinct * from (
 select 'nation' name, n_nationkey::varchar id, 'region' dst_name, n_regionkey::varchar dst_id from na
 union all select 'customer', c_custkey::varchar, 'nation', c_nationkey::varchar from cu
 union all select 'supplier', s_suppkey::varchar, 'nation', s_nationkey::varchar from su
 union all select 'orders', o_orderkey::varchar, 'customer', o_custkey::varchar from o
 union all select 'lineitem', id, 'orders', l_orderkey::varchar from li
   where l_orderkey in (select o_orderkey from o)
 union all select 'lineitem', id, 'supplier', l_suppkey::varchar from li
   where l_suppkey in (select s_suppkey from su))),
n as (select 0 topo_rank, 'region' name, r_regionkey::varchar id from re
 union all select 1, 'nation', n_nationkey::varchar from na
 union all select 2, 'customer', c_custkey::varchar from cu
 union all select 3, 'supplier', s_suppkey::varchar from su
 union all select 4, 'orders', o_orderkey::varchar from o
 union all select 5, 'lineitem', id from li)"""

_REL_TEXT = "coalesce(string_agg(r.dst_name || ':' || r.dst_id, ',' order by r.dst_name, r.dst_id), '')"

ORACLE_EXPORT_RECORDS = f"""
with {_FLAGSHIP_CTES}
select n.topo_rank, n.name, n.id, ob.object, {_REL_TEXT} as relations
from n join ({_OBJECTS_SQL}) ob on ob.name = n.name and ob.id = n.id
  left join rel r on r.name = n.name and r.id = n.id
group by all
"""

ORACLE_TRAVERSE_UP = f"""
with cu as ({_COHORT_SQL}),
na as (select * from nation where n_nationkey in (select c_nationkey from cu)),
re as (select * from region where r_regionkey in (select n_regionkey from na)),
n as (select 'customer' name, c_custkey::varchar id, 'nation' dst_name, c_nationkey::varchar dst_id from cu
 union all select 'nation', n_nationkey::varchar, 'region', n_regionkey::varchar from na
 union all select 'region', r_regionkey::varchar, null, null from re)
select name, id, coalesce(string_agg(dst_name || ':' || dst_id, ',' order by dst_name, dst_id), '')
  as relations
from (select distinct * from n) group by all
"""

ORACLE_TRAVERSE_DOWN = f"""
with cu as ({_COHORT_SQL}),
o as (select * from orders where o_custkey in (select c_custkey from cu)),
li as (select *, {_LI_ID} id from lineitem where l_orderkey in (select o_orderkey from o))
select 'customer' name, c_custkey::varchar id, '' relations from cu
union all select 'orders', o_orderkey::varchar, 'customer:' || o_custkey from o
union all select 'lineitem', id, 'orders:' || l_orderkey from li
"""

ORACLE_TRAVERSE_MULTI_PARENT = f"""
with na as (select * from nation where n_regionkey = 2),
cu as (select * from customer where c_nationkey in (select n_nationkey from na)),
su as (select * from supplier where s_nationkey in (select n_nationkey from na)),
o as (select * from orders where o_custkey in (select c_custkey from cu)),
r as (select distinct * from (
  select {_LI_ID} id, 'orders' dst_name, l_orderkey::varchar dst_id from lineitem
    where l_orderkey in (select o_orderkey from o)
  union all
  select {_LI_ID} id, 'supplier', l_suppkey::varchar from lineitem
    where l_suppkey in (select s_suppkey from su)))
select 'lineitem' name, id,
       string_agg(dst_name || ':' || dst_id, ',' order by dst_name, dst_id) relations
from r group by id
"""

ORACLE_TRAVERSE_EXTRA_SIBLINGS = f"""
with cu as ({_COHORT_SQL}),
na0 as (select * from nation where n_nationkey in (select c_nationkey from cu)),
re as (select * from region where r_regionkey in (select n_regionkey from na0)),
na as (select * from nation where n_nationkey in (select n_nationkey from na0)
                              or n_regionkey in (select r_regionkey from re))
select 'nation' name, n_nationkey::varchar id, 'region:' || n_regionkey relations from na
union all select 'region', r_regionkey::varchar, '' from re
"""

ORACLE_TRAVERSE_EXTRA_ORPHAN = f"""
with cu as ({_COHORT_SQL}),
na as (select * from nation where n_nationkey in (select c_nationkey from cu)),
re as (select * from region where r_regionkey in (select n_regionkey from na)),
o as (select * from orders where o_custkey in (select c_custkey from cu)),
li as (select * from lineitem where l_orderkey in (select o_orderkey from o))
select 'region' name, count(*) n_records from re having count(*) > 0
union all select 'nation', count(*) from na having count(*) > 0
union all select 'customer', count(*) from cu having count(*) > 0
union all select 'orders', count(*) from o having count(*) > 0
union all select 'lineitem', count(*) from li having count(*) > 0
"""

ORACLE_EXPORT_DOWNWARD_RECORDS = f"""
select x.topo_rank, x.name, x.id, ob.object, x.relations from (
with cu as ({_COHORT_SQL}),
o as (select * from orders where o_custkey in (select c_custkey from cu)),
li as (select *, {_LI_ID} id from lineitem where l_orderkey in (select o_orderkey from o))
select 0 topo_rank, 'customer' name, c_custkey::varchar id, '' relations from cu
union all select 1, 'orders', o_orderkey::varchar, 'customer:' || o_custkey from o
union all select 2, 'lineitem', id, 'orders:' || l_orderkey from li
) x join ({_OBJECTS_SQL}) ob on ob.name = x.name and ob.id = x.id
"""

ORACLE_EXPORT_UP_FROM_LINEITEM = f"""
select x.topo_rank, x.name, x.id, ob.object, x.relations from (
with li as (select *, {_LI_ID} id from lineitem where l_returnflag = 'R'),
o as (select * from orders where o_orderkey in (select l_orderkey from li)),
pa as (select * from part where p_partkey in (select l_partkey from li)),
su as (select * from supplier where s_suppkey in (select l_suppkey from li)),
cu as (select * from customer where c_custkey in (select o_custkey from o)),
na as (select * from nation where n_nationkey in (select c_nationkey from cu)
                              or n_nationkey in (select s_nationkey from su)),
re as (select * from region where r_regionkey in (select n_regionkey from na))
select 0 topo_rank, 'region' name, r_regionkey::varchar id, '' relations from re
union all select 1, 'nation', n_nationkey::varchar, 'region:' || n_regionkey from na
union all select 2, 'customer', c_custkey::varchar, 'nation:' || c_nationkey from cu
union all select 3, 'supplier', s_suppkey::varchar, 'nation:' || s_nationkey from su
union all select 4, 'part', p_partkey::varchar, '' from pa
union all select 5, 'orders', o_orderkey::varchar, 'customer:' || o_custkey from o
union all select 6, 'lineitem', id,
  'orders:' || l_orderkey || ',part:' || l_partkey || ',supplier:' || l_suppkey from li
) x join ({_OBJECTS_SQL}) ob on ob.name = x.name and ob.id = x.id
"""

ORACLE_SELECTED_NODES = f"""
with {_FLAGSHIP_CTES}
select name, count(*) n_selected, count(*) n_nodes from n group by name
"""

ORACLE_RELATIONS_BY_NODE = f"""
with {_FLAGSHIP_CTES}
select name, id, dst_name, dst_id from rel
"""

ORACLE_EDGE_PROJECTION = f"""
select 'nation_region' edge_table, n_nationkey::varchar src_id, n_regionkey::varchar dst_id
  from nation where n_regionkey is not null
union all select 'customer_nation', c_custkey::varchar, c_nationkey::varchar from customer
  where c_nationkey is not null
union all select 'supplier_nation', s_suppkey::varchar, s_nationkey::varchar from supplier
  where s_nationkey is not null
union all select 'orders_customer', o_orderkey::varchar, o_custkey::varchar from orders
  where o_custkey is not null
union all select 'lineitem_orders', {_LI_ID}, l_orderkey::varchar from lineitem
  where l_orderkey is not null
union all select 'lineitem_part', {_LI_ID}, l_partkey::varchar from lineitem
  where l_partkey is not null
union all select 'lineitem_supplier', {_LI_ID}, l_suppkey::varchar from lineitem
  where l_suppkey is not null
"""

ORACLE_KEYED_SCAN = f"""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders
where o_custkey in (select c_custkey from ({_COHORT_SQL}))
"""

ORACLE_RANGED_SCAN = f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from lineitem
where l_orderkey in (select o_orderkey from ({ORACLE_KEYED_SCAN}))
"""

ORACLE_RECORD_OBJECTS = f"""
select o_orderkey::varchar id, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority
from orders where o_custkey in (select c_custkey from ({_COHORT_SQL}))
"""

ORACLE_COHORT_IDS = f"select c_custkey::varchar id from ({_COHORT_SQL})"
ORACLE_COHORT_FILTER_EQ = f"""
select _customer_id, auth_resource_path from ({_INDEX_SQL}) where c_mktsegment = 'BUILDING'"""
ORACLE_COHORT_ACCESSIBLE = f"select _customer_id, auth_resource_path from ({_ACCESSIBLE_SQL})"
ORACLE_COHORT_COUNT = f"""
select count(*) total_count from ({_ACCESSIBLE_SQL})
where c_mktsegment in ('BUILDING', 'MACHINERY')"""
ORACLE_COHORT_AUTHZ = f"""
select distinct auth_resource_path from ({_ACCESSIBLE_SQL})
where c_acctbal >= 5000 and auth_resource_path is not null"""

_POPULATED_SQL = """
select * from (
 select 'customer_nation' edge_table, 'customer' src_label, 'nation' dst_label, count(*) n_edges
   from customer where c_nationkey is not null
 union all select 'lineitem_orders', 'lineitem', 'orders', count(*) from lineitem
   where l_orderkey is not null
 union all select 'lineitem_part', 'lineitem', 'part', count(*) from lineitem
   where l_partkey is not null
 union all select 'lineitem_supplier', 'lineitem', 'supplier', count(*) from lineitem
   where l_suppkey is not null
 union all select 'nation_region', 'nation', 'region', count(*) from nation
   where n_regionkey is not null
 union all select 'orders_customer', 'orders', 'customer', count(*) from orders
   where o_custkey is not null
 union all select 'supplier_nation', 'supplier', 'nation', count(*) from supplier
   where s_nationkey is not null
) where n_edges > 0"""

ORACLE_DICTIONARY_EDGES = _POPULATED_SQL
ORACLE_EDGES_BY_TYPE = f"""
select src_label label, string_agg(edge_table, ',' order by edge_table) edge_tables
from ({_POPULATED_SQL}) group by src_label"""
ORACLE_AMBIGUOUS_EDGES = f"""
select src_label, dst_label, count(*) n_tables,
       string_agg(edge_table, ',' order by edge_table) edge_tables
from (select edge_table, case src_label when 'lineitem' then 'orders' else src_label end src_label,
        case dst_label when 'supplier' then 'part' else dst_label end dst_label from ({_POPULATED_SQL}))
group by src_label, dst_label having count(*) > 1"""

_DEPTHS_SQL = f"""
recursive et as ({_POPULATED_SQL}),
up_links as (select distinct src_label frm, dst_label dst from et),
down_links as (select distinct dst_label frm, src_label dst from et),
up_walk(label, depth) as (select '{ROOT}', 0 union all
  select l.dst, w.depth + 1 from up_walk w join up_links l on w.label = l.frm),
down_walk(label, depth) as (select '{ROOT}', 0 union all
  select l.dst, w.depth + 1 from down_walk w join down_links l on w.label = l.frm),
topo as (
  select 'up' direction, label, max(depth)::int depth from up_walk group by label
  union all select 'down', label, max(depth)::int from down_walk group by label),
ranked as (select direction, label, depth,
  (row_number() over (partition by direction order by depth, label) - 1)::int pos from topo)"""

ORACLE_TYPE_TOPOLOGY = f"with {_DEPTHS_SQL} select * from ranked"
ORACLE_TYPE_BFS = f"""
with recursive et as ({_POPULATED_SQL}),
links as (select distinct dst_label frm, src_label dst from et),
walk(label, level) as (select 'region', 0 union all
  select l.dst, w.level + 1 from walk w join links l on w.label = l.frm)
select label, min(level)::int level from walk group by label"""
ORACLE_TRAVERSAL_PLAN = f"""
with {_DEPTHS_SQL},
steps as (
  select 0 block, pos, 'up' way, label from ranked where direction = 'up'
  union all select 1, 0, 'down', 'supplier'
  union all select 2, pos, 'down', label from ranked where direction = 'down' and pos > 0)
select (row_number() over (order by block, pos) - 1)::int pos, way, label from steps"""

ORACLE_IMPORT_NODES = f"""
with {_FLAGSHIP_CTES},
ncols as (select table_name, count(*)::int n_props from information_schema.columns
          group by table_name)
select 'node_' || n.name node_table, n.id node_id, c.n_props, ob.object props
from n join ncols c on c.table_name = n.name
  join ({_OBJECTS_SQL}) ob on ob.name = n.name and ob.id = n.id
"""
ORACLE_IMPORT_PROBLEMS = f"""
with {_FLAGSHIP_CTES}
select 'unknown type' problem, name, null::varchar dst_name, count(*) n from n where name = 'supplier' group by name
union all
select 'unknown edge', name, dst_name, count(*) from rel
where name = 'supplier' or dst_name = 'supplier' group by name, dst_name
"""
ORACLE_ARTIFACT_MANIFEST = f"""
with {_FLAGSHIP_CTES}
select name, 'object' form, true all_valid, 14 expires_in_days, count(*) n_records,
  (select string_agg(distinct auth_resource_path, ',' order by auth_resource_path) from ({_COHORT_SQL})) authz
from n group by name
"""
ORACLE_EDGE_LABELS = f"""
with {_FLAGSHIP_CTES}
select name || '_' || dst_name edge_table, name src_label, dst_name dst_label, count(*) n_relations
from rel group by name, dst_name
"""
ORACLE_TYPE_TABLES = " union all ".join(
    f"select '{lbl}' as label, 'node_{lbl}' node_table, count(*) n_nodes from {lbl} having count(*) > 0" for lbl in star.LABELS)
ORACLE_IMPORT_COMMIT = f"""
with {_FLAGSHIP_CTES}
select 'nodes' kind, 'node_' || name "table", count(*) n_rows, 'first' import from n group by name
union all select 'edges', name || '_' || dst_name, count(*), 'first' from rel group by name, dst_name
"""
ORACLE_IMPORT_EDGES = f"""
with {_FLAGSHIP_CTES}
select name || '_' || dst_name edge_table, id src_id, dst_id from rel
"""
ORACLE_DISTINCT_TYPES = f"with {_FLAGSHIP_CTES} select distinct name from n"
ORACLE_DISTINCT_EDGE_TABLES = f"""
with {_FLAGSHIP_CTES} select distinct name || '_' || dst_name edge_table from rel"""
ORACLE_UNKNOWN_TYPES = f"""
with {_FLAGSHIP_CTES} select name, count(*) n_records from n where name = 'supplier'
group by name"""
ORACLE_UNKNOWN_EDGES = f"""
with {_FLAGSHIP_CTES} select name, dst_name, count(*) n_relations from rel
where name = 'supplier' or dst_name = 'supplier' group by name, dst_name"""

ORACLE_CONTAINER_SCAN = f"select name, id, object, relations from ({ORACLE_EXPORT_RECORDS})"
_ENUMS = ", ".join(f"'{c}'" for c in star.ENUM_COLUMNS)
_TABLES = ", ".join(f"'{t}'" for t in star.LABELS)
ORACLE_CONTAINER_SCHEMA_FIELDS = f"""
select table_name name, column_name field,
  case when column_name in ({_ENUMS}) then 'enum'
       when data_type = 'BIGINT' then 'long' when data_type = 'INTEGER' then 'int'
       when data_type = 'DOUBLE' then 'double' when data_type like 'TIMESTAMP%' then 'long'
       else 'string' end type,
  column_name in ({_ENUMS}) is_enum
from information_schema.columns where table_name in ({_TABLES})
"""

ORACLE_PROPS_EXTRACT = "select event_id, json_extract(props, '$.k')::integer k from events"
ORACLE_ENCODE_ENUM = f"""
select p_partkey, {encode_symbol_sql('p_name')} name_symbol,
       {encode_symbol_sql('p_brand')} brand_symbol, {encode_symbol_sql('p_type')} type_symbol
from part"""
ORACLE_DECODE_ENUM = "select p_partkey, p_name, p_brand from part"
ORACLE_ENCODE_ENUM_TEXT = f"""
select doc_id, length(symbol)::int n_chars, md5(symbol) md5
from (select doc_id, {encode_symbol_sql('text')} symbol from documents)"""
ORACLE_DECODE_ENUM_TEXT = "select doc_id, md5(text) md5 from documents"


_QUERIES: dict[str, tuple[Query, str | None]] = {
    "export_records": (q_export_records, ORACLE_EXPORT_RECORDS),
    "traverse_up": (q_traverse_up, ORACLE_TRAVERSE_UP),
    "traverse_down": (q_traverse_down, ORACLE_TRAVERSE_DOWN),
    "traverse_multi_parent": (q_traverse_multi_parent, ORACLE_TRAVERSE_MULTI_PARENT),
    "traverse_extra_siblings": (q_traverse_extra_siblings, ORACLE_TRAVERSE_EXTRA_SIBLINGS),
    "traverse_extra_orphan": (q_traverse_extra_orphan, ORACLE_TRAVERSE_EXTRA_ORPHAN),
    "export_downward_records": (q_export_downward_records, ORACLE_EXPORT_DOWNWARD_RECORDS),
    "export_up_from_lineitem": (q_export_up_from_lineitem, ORACLE_EXPORT_UP_FROM_LINEITEM),
    "selected_nodes": (q_selected_nodes, ORACLE_SELECTED_NODES),
    "relations_by_node": (q_relations_by_node, ORACLE_RELATIONS_BY_NODE),
    "edge_projection": (q_edge_projection, ORACLE_EDGE_PROJECTION),
    "keyed_scan": (q_keyed_scan, ORACLE_KEYED_SCAN),
    "ranged_scan": (q_ranged_scan, ORACLE_RANGED_SCAN),
    "record_objects": (q_record_objects, ORACLE_RECORD_OBJECTS),
    "cohort_ids": (q_cohort_ids, ORACLE_COHORT_IDS),
    "cohort_filter_eq": (q_cohort_filter_eq, ORACLE_COHORT_FILTER_EQ),
    "cohort_accessible": (q_cohort_accessible, ORACLE_COHORT_ACCESSIBLE),
    "cohort_count": (q_cohort_count, ORACLE_COHORT_COUNT),
    "cohort_authz": (q_cohort_authz, ORACLE_COHORT_AUTHZ),
    "dictionary_edges": (q_dictionary_edges, ORACLE_DICTIONARY_EDGES),
    "edges_by_type": (q_edges_by_type, ORACLE_EDGES_BY_TYPE),
    "ambiguous_edges": (q_ambiguous_edges, ORACLE_AMBIGUOUS_EDGES),
    "type_topology": (q_type_topology, ORACLE_TYPE_TOPOLOGY),
    "type_bfs": (q_type_bfs, ORACLE_TYPE_BFS),
    "traversal_plan": (q_traversal_plan, ORACLE_TRAVERSAL_PLAN),
    "import_nodes": (q_import_nodes, ORACLE_IMPORT_NODES),
    "import_edges": (q_import_edges, ORACLE_IMPORT_EDGES),
    "distinct_types": (q_distinct_types, ORACLE_DISTINCT_TYPES),
    "distinct_edge_tables": (q_distinct_edge_tables, ORACLE_DISTINCT_EDGE_TABLES),
    "unknown_types": (q_unknown_types, ORACLE_UNKNOWN_TYPES),
    "unknown_edges": (q_unknown_edges, ORACLE_UNKNOWN_EDGES),
    "roundtrip_edges": (q_roundtrip_edges, ORACLE_EXPORT_RECORDS),
    "container_scan": (q_container_scan, ORACLE_CONTAINER_SCAN),
    "container_schema_fields": (q_container_schema_fields, ORACLE_CONTAINER_SCHEMA_FIELDS),
    "container_import_nodes": (q_container_import_nodes, ORACLE_IMPORT_NODES),
    "artifact_manifest": (q_artifact_manifest, ORACLE_ARTIFACT_MANIFEST),
    "import_commit": (q_import_commit, ORACLE_IMPORT_COMMIT),
    "import_problems": (q_import_problems, ORACLE_IMPORT_PROBLEMS),
    "type_tables": (q_type_tables, ORACLE_TYPE_TABLES),
    "edge_labels": (q_edge_labels, ORACLE_EDGE_LABELS),
    "encode_enum_text": (q_encode_enum_text, ORACLE_ENCODE_ENUM_TEXT),
    "decode_enum_text": (q_decode_enum_text, ORACLE_DECODE_ENUM_TEXT),
    "props_extract": (q_props_extract, ORACLE_PROPS_EXTRACT),
    "encode_enum": (q_encode_enum, ORACLE_ENCODE_ENUM),
    "decode_enum": (q_decode_enum, ORACLE_DECODE_ENUM),
}


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _QUERIES.items() if v[1] is not None}
