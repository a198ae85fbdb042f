"""The TPC-H-like star schema under ``/root/testdata/sf*`` seen as a graph.

Each table is an entity type, each foreign key a child -> parent edge type.
Node and edge DataFrames are projections of the Parquet files, so a walk
reads only the key columns of the edge tables (pruned at the scan) and the
object columns only for selected nodes.  Ids collide across labels on purpose
(small integers): every frontier in the walk is keyed by label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.enums import encode_enum
from kinfold.model import Dictionary, EdgeType, Graph, PropField

# fixed values: entity types, parent links, enum-typed columns of the fixture
LABELS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
LINKS = (
    # (edge table, child, parent, child column holding the parent key)
    ("nation_region", "nation", "region", "n_regionkey"),
    ("customer_nation", "customer", "nation", "c_nationkey"),
    ("supplier_nation", "supplier", "nation", "s_nationkey"),
    ("orders_customer", "orders", "customer", "o_custkey"),
    ("lineitem_orders", "lineitem", "orders", "l_orderkey"),
    ("lineitem_part", "lineitem", "part", "l_partkey"),
    ("lineitem_supplier", "lineitem", "supplier", "l_suppkey"),
)
# fixed values: columns of the given tables, for the oracles
COLUMNS = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
                 "c_acctbal": "double", "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
             "p_size": "int", "p_retailprice": "double"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
               "o_totalprice": "double", "o_orderdate": "timestamp", "o_orderpriority": "string"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
                 "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
                 "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
                 "l_linestatus": "string", "l_shipdate": "timestamp"},
}
ENUM_SYMBOLS = {
    "c_mktsegment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "o_orderstatus": ("F", "O", "P"),
    "o_orderpriority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    "l_returnflag": ("A", "N", "R"),
    "l_linestatus": ("F", "O"),
}
ENUM_COLUMNS = tuple(ENUM_SYMBOLS)
KEY_COLUMNS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
    "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_SCANS: dict[tuple[str, str], DataFrame] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one table, resolved once per session and path.

    Resolving runs schema inference (a footer-reading job) and a listing;
    the walk reads the same tables many times, so the scan is reused.
    """
    path = table_path(sf_dir, name)
    key = (spark.sparkContext.applicationId, path)
    df = _SCANS.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _SCANS[key] = df
    return df


def day_number(c: Column) -> Column:
    """``yyyyMMdd`` as an integer, without a session-time-zone round trip."""
    d = F.to_date(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def day_key(c: Column) -> Column:
    """``yyyyMMdd`` digits of a timestamp (id part)."""
    return F.lpad(day_number(c).cast("string"), 8, "0")


def node_id(label: str) -> Column:
    """String id of a row; a line item needs five parts to be unique."""
    if label == "lineitem":
        return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                           day_key(F.col("l_shipdate")))
    return F.col(KEY_COLUMNS[label]).cast("string")


def node_id_sql(label: str) -> str:
    """DuckDB expression of :func:`node_id` for oracles."""
    if label == "lineitem":
        return ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                "strftime(l_shipdate, '%Y%m%d'))")
    return f"{KEY_COLUMNS[label]}::varchar"


_DICTS: dict[tuple[str, str], Dictionary] = {}
_GRAPHS: dict[tuple[str, str, bool], Graph] = {}


def star_dictionary(spark: SparkSession, sf_dir: str) -> Dictionary:
    """Dictionary of the star schema; field types read from the Parquet footers."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DICTS:
        _DICTS[key] = _build_dictionary(spark, sf_dir)
    return _DICTS[key]


def _build_dictionary(spark: SparkSession, sf_dir: str) -> Dictionary:
    props: list[PropField] = []
    for label in LABELS:
        for f in read(spark, sf_dir, label).schema.fields:
            props.append(PropField(label, f.name, f.dataType.simpleString(),
                                   f.name in ENUM_COLUMNS, ENUM_SYMBOLS.get(f.name, ())))
    return Dictionary(
        node_tables={lbl: f"node_{lbl}" for lbl in LABELS},
        edge_types=[EdgeType(t, c, p) for t, c, p, _ in LINKS],
        props=props,
    )


def star_graph(spark: SparkSession, sf_dir: str, encode_enums: bool = True) -> Graph:
    """The fixture as a graph; one instance per session and folder.

    Object expressions are built once per type and reused: building the
    enum-codec lambdas costs hundreds of py4j calls per type.
    """
    key = (spark.sparkContext.applicationId, sf_dir, encode_enums)
    if key not in _GRAPHS:
        _GRAPHS[key] = _build_graph(spark, sf_dir, encode_enums)
    return _GRAPHS[key]


def _build_graph(spark: SparkSession, sf_dir: str, encode_enums: bool) -> Graph:
    d = star_dictionary(spark, sf_dir)
    typed_cache: dict[str, Column] = {}
    json_cache: dict[str, Column] = {}
    links = {t: (c, col) for t, c, _, col in LINKS}

    def nodes(label: str) -> DataFrame:
        df = read(spark, sf_dir, label)
        return df.select(node_id(label).alias("node_id"), *df.columns)

    def typed_object(label: str) -> Column:
        if label not in typed_cache:
            fields = []
            for f in d.fields(label):
                c = F.col(f.field)
                if encode_enums and f.is_enum:
                    c = encode_enum(c)
                fields.append(c.alias(f.field))
            typed_cache[label] = F.struct(*fields)
        return typed_cache[label]

    def node_object(label: str) -> Column:
        if label not in json_cache:
            # every field, nulls included, like a record read from a container
            json_cache[label] = F.to_json(typed_object(label), {"ignoreNullFields": "false"})
        return json_cache[label]

    def match_ids(label: str, df: DataFrame, selected: DataFrame, id_col: str,
                  how: str) -> DataFrame:
        """Join rows of ``label``'s table to ids on the typed key columns.

        Ids are parsed on the (small) selected side instead of being built
        for every table row; a line item's date part is checked after the
        join, on matching rows only.
        """
        if label != "lineitem":
            key = KEY_COLUMNS[label]
            keyed = selected.withColumn("__k", F.col(id_col).cast(df.schema[key].dataType))
            cond = df[key] == keyed["__k"]
            if how == "left_semi":
                return df.join(keyed.select("__k"), cond, "left_semi")
            return df.join(keyed, cond, how).drop("__k")
        parts = F.split(F.col(id_col), "-")
        keyed = selected.select(
            "*", parts[0].cast("bigint").alias("__ok"), parts[1].cast("int").alias("__ln"),
            parts[2].cast("bigint").alias("__pk"), parts[3].cast("bigint").alias("__sk"),
            parts[4].cast("int").alias("__day"))
        cond = ((df.l_orderkey == keyed.__ok) & (df.l_linenumber == keyed.__ln)
                & (df.l_partkey == keyed.__pk) & (df.l_suppkey == keyed.__sk)
                & (day_number(df.l_shipdate) == keyed.__day))
        if how == "left_semi":
            return df.join(keyed.select("__ok", "__ln", "__pk", "__sk", "__day"), cond,
                           "left_semi")
        return df.join(keyed, cond, how).drop("__ok", "__ln", "__pk", "__sk", "__day")

    def lookup(label: str, selected: DataFrame) -> DataFrame:
        df = read(spark, sf_dir, label)
        return match_ids(label, df, selected, "node_id", "inner")

    def edge_filter(edge_table: str, side: str, ids: DataFrame) -> DataFrame:
        child, col = links[edge_table]
        df = read(spark, sf_dir, child)
        if side == "dst":
            df = df.where(F.col(col).isNotNull())
            parent_type = df.schema[col].dataType
            keys = ids.select(F.col("id").cast(parent_type).alias("__p"))
            df = df.join(keys, df[col] == keys["__p"], "left_semi")
        elif child == "lineitem":
            # every parent key is part of the id, so the key join already drops
            # nulls; without a per-edge filter the child side of all three
            # edges is the same plan and its shuffle is reused
            df = match_ids(child, df, ids, "id", "left_semi")
        else:
            df = match_ids(child, df.where(F.col(col).isNotNull()), ids, "id", "left_semi")
        return df.select(node_id(child).alias("src_id"),
                         F.col(col).cast("string").alias("dst_id"))

    def edges(edge_table: str) -> DataFrame:
        child, col = links[edge_table]
        df = read(spark, sf_dir, child)
        return (df.where(F.col(col).isNotNull())
                  .select(node_id(child).alias("src_id"),
                          F.col(col).cast("string").alias("dst_id")))

    def edge_counts(label: str) -> DataFrame:
        own = [(t, col) for t, c, _, col in LINKS if c == label]
        counted = read(spark, sf_dir, label).agg(*(F.count(col).alias(t) for t, col in own))
        return counted.select(F.inline(F.array(*(
            F.struct(F.lit(t).alias("edge_table"), F.col(t).alias("n_edges")) for t, _ in own))))

    return Graph(spark, d, nodes, edges, node_object, typed_object, lookup, edge_filter,
                 object_encoded=encode_enums, edge_counts=edge_counts)


def cohort_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows of ``customer`` with ``_customer_id`` and ``auth_resource_path``.

    customer ⟕ nation ⟕ region; the dimension joins are planned by Spark
    (broadcast only when the scan size is under the threshold).
    """
    cu = read(spark, sf_dir, "customer")
    na = read(spark, sf_dir, "nation")
    re_ = read(spark, sf_dir, "region")
    return (cu.join(na, cu.c_nationkey == na.n_nationkey, "left")
              .join(re_, na.n_regionkey == re_.r_regionkey, "left")
              .select(F.col("c_custkey").cast("string").alias("_customer_id"),
                      *[F.col(c) for c in cu.columns],
                      F.concat(F.lit("/programs/"), F.col("r_name"), F.lit("/projects/"),
                               F.col("n_name")).alias("auth_resource_path")))


# fixed value: programs the test caller is granted
GRANTED_PROGRAMS = ("ASIA", "EUROPE")


def grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resource paths the test caller may read: every project of two programs."""
    na = read(spark, sf_dir, "nation")
    re_ = read(spark, sf_dir, "region").where(F.col("r_name").isin(*GRANTED_PROGRAMS))
    return (na.join(re_, na.n_regionkey == re_.r_regionkey, "inner")
              .select(F.concat(F.lit("/programs/"), F.col("r_name"), F.lit("/projects/"),
                               F.col("n_name")).alias("auth_resource_path")))
