"""Physical-plan checks and the DuckDB oracle on the smallest scale."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_mod
from kinfold import registry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


def executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["export_records", "import_nodes", "import_edges",
                                  "encode_enum", "props_extract", "type_topology"])
def test_no_python_in_hot_path(spark, name):
    plan = executed_plan(registry.queries()[name](spark, SF))
    for node in PY_NODES:
        assert node not in plan, f"{name} evaluates Python: {node}"


def test_cohort_predicate_reaches_the_scan(spark):
    df = registry.q_cohort_ids(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_nationkey,7)" in plan
    assert "EqualTo(c_mktsegment,BU" in plan  # plan text truncates long lists
    assert "EqualTo(n_nationkey,7)" in plan  # inferred through the join


def test_edge_scans_read_key_columns_only(spark):
    df = registry.q_traverse_down(spark, SF)
    plan = executed_plan(df)
    for line in plan.splitlines():
        if "lineitem.parquet" in line and "ReadSchema" in line:
            assert "l_quantity" not in line and "l_extendedprice" not in line


def test_exports_read_every_node_column(spark):
    plan = executed_plan(registry.q_export_records(spark, SF))
    for column in ("l_extendedprice", "o_totalprice", "c_mktsegment", "s_acctbal", "n_name", "r_name"):
        assert column in plan


def test_edge_tables_are_read_once_per_visit(spark):
    """A second visit of a type builds on the written state of the first."""
    from kinfold.sources import star

    graph = star.star_graph(spark, SF)
    reads = []
    counted = graph.edge_filter

    def edge_filter(table, side, ids):
        reads.append((table, side))
        return counted(table, side, ids)

    from dataclasses import replace

    from kinfold.operators.traverse import walk_graph

    walk = walk_graph(replace(graph, edge_filter=edge_filter), registry.flagship_cohort(spark, SF), "customer", ["nation"], True)
    assert len(reads) == len(set(reads))
    plan = walk.states["nation"]._jdf.queryExecution().executedPlan().toString()
    assert "customer.parquet" not in plan and "nation.parquet" not in plan
    walk.cleanup()


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["topo_rank", "name", "id", "object", "relations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


BAD_PLAN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin") + PY_NODES


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    cols = df.columns
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in BAD_PLAN_NODES:
        assert node not in plan, f"{name}: {node} in plan"
    res = duck.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want


def test_keyed_scan_literal_ids_push_in_filter(spark):
    from kinfold.sources.jdbc import keyed_scan

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    df = keyed_scan(orders, ["1", "2", "3"], "o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_orderkey, [1,2,3])" in plan or "In(o_orderkey" in plan
    assert sorted(r["o_orderkey"] for r in df.collect()) == [
        k for k in (1, 2, 3) if orders.where(f"o_orderkey = {k}").count()]
    assert keyed_scan(orders, [], "o_orderkey").count() == 0
    ids = spark.createDataFrame([("1",), ("2",)], "id string")
    assert keyed_scan(orders, ids, "o_orderkey").count() == df.where("o_orderkey <= 2").count()


def test_flagship_independent_of_session_time_zone(spark, duck):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = registry.q_export_records(spark, SF)
        got = sorted(tuple(r) for r in df.select("topo_rank", "name", "id", "relations").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = sorted(duck.execute(
        f"select topo_rank, name, id, relations from ({registry.ORACLE_EXPORT_RECORDS})").fetchall())
    assert got == want
