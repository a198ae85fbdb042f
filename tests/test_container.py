"""Avro container write/read/restore round trip and the artefact manifest."""

from __future__ import annotations

import json
import uuid

from kinfold.model import PropField
from kinfold.operators import restore as rs
from kinfold.operators.records import walk_records
from kinfold.operators.traverse import walk_graph
from kinfold.sources import container as ct
from kinfold.sources.manifest import artifact_manifest
from kinfold.sources.sinks import write_records
from kinfold.session import scratch_dir
from micro import make_graph

NODES = {
    "study": [("T1", {"title": "t one", "phase": "phase 1"})],
    "case": [("C1", {"age": 30, "vital": "alive > 1y"}), ("C2", {"age": None, "vital": None})],
}
LINKS = [("case_study", "case", "study", [("C1", "T1"), ("C2", "T1")])]
PROPS = [
    PropField("study", "title", "string"),
    PropField("study", "phase", "string", True, ("phase 1", "phase 2")),
    PropField("case", "age", "bigint"),
    PropField("case", "vital", "string", True, ("alive > 1y", "dead")),
]


def _walk(spark):
    g = make_graph(spark, NODES, LINKS, PROPS)
    c = spark.createDataFrame([("C1",), ("C2",)], "id string")
    return walk_graph(g, c, "case", include_upward=True)


def test_container_round_trip(spark):
    w = _walk(spark)
    path = scratch_dir(spark, f"test-container-{uuid.uuid4().hex[:6]}")
    schema = ct.write_container(w, path)
    assert schema["fields"][2]["type"][0]["name"] == "Metadata"
    raw = ct.read_container_raw(spark, path)
    assert raw.where("name = 'Metadata'").count() == 1
    recs = ct.read_container(spark, path)
    data = {(r["name"], r["id"]): (json.loads(r["object"]),
                                   [(x["dst_id"], x["dst_name"]) for x in r["relations"]])
            for r in rs.data_records(recs).collect()}
    assert data[("case", "C1")] == ({"age": 30, "vital": "alive_20__3e__20_1y"},
                                    [("T1", "study")])
    assert data[("case", "C2")][0] == {"age": None, "vital": None}
    assert data[("study", "T1")] == ({"title": "t one", "phase": "phase_20_1"}, [])
    fields = {(r["name"], r["field"]): (r["type"], r["is_enum"])
              for r in ct.container_schema_fields(spark, path).collect()}
    assert fields[("case", "vital")] == ("enum", True)
    assert fields[("case", "age")] == ("long", False)
    # restore decodes the enum symbols back to text
    d = w.graph.dictionary
    nodes = {r["node_id"]: json.loads(r["_props"])
             for r in rs.restore_records(recs, d, encoded=True).nodes.collect()}
    assert nodes["C1"] == {"age": 30, "vital": "alive > 1y"}
    assert nodes["T1"] == {"title": "t one", "phase": "phase 1"}


def test_records_sink_and_manifest(spark):
    w = _walk(spark)
    path = scratch_dir(spark, f"test-records-{uuid.uuid4().hex[:6]}")
    write_records(walk_records(w), path)
    back = spark.read.parquet(path)
    assert sorted((r["topo_rank"], r["name"], r["id"]) for r in back.collect()) == [
        (0, "study", "T1"), (1, "case", "C1"), (1, "case", "C2")]
    m = artifact_manifest(spark, path, expires_days=14).collect()
    assert m and all(r["size"] > 0 and len(r["md5"]) == 32 for r in m)
    assert all(r["form"] == "object" and r["urls"][0].endswith(r["file_name"]) for r in m)
    assert all(r["expires_at"] > 0 for r in m)


def test_import_decodes_with_container_schema(spark):
    from kinfold import jobs
    from kinfold.model import Dictionary

    w = _walk(spark)
    path = scratch_dir(spark, f"test-container-s5-{uuid.uuid4().hex[:6]}")
    schema = ct.write_container(w, path)
    props = {(p.label, p.field): p for p in ct.props_from_schema(schema)}
    assert props[("case", "vital")].is_enum and props[("case", "age")].type == "bigint"
    # a target dictionary without field descriptions: enum flags come from the header
    bare = Dictionary(dict(w.graph.dictionary.node_tables), list(w.graph.dictionary.edge_types))
    target = scratch_dir(spark, f"test-container-s5-out-{uuid.uuid4().hex[:6]}")
    jobs.import_job(spark, path, bare, target=target)
    got = {r["node_id"]: json.loads(r["_props"])
           for r in spark.read.parquet(f"{target}/nodes").collect()}
    assert got["C1"] == {"age": 30, "vital": "alive > 1y"}
    assert got["T1"]["phase"] == "phase 1"


def test_reimport_skips_existing_rows(spark):
    from kinfold import jobs

    w = _walk(spark)
    path = scratch_dir(spark, f"test-reimport-{uuid.uuid4().hex[:6]}")
    ct.write_container(w, path)
    target = scratch_dir(spark, f"test-reimport-out-{uuid.uuid4().hex[:6]}")
    d = w.graph.dictionary
    jobs.import_job(spark, path, d, target=target)
    jobs.import_job(spark, path, d, target=target, skip_existing=True)
    assert spark.read.parquet(f"{target}/nodes").count() == 3
    assert spark.read.parquet(f"{target}/edges").count() == 2
    jobs.import_job(spark, path, d, target=target)  # plain append duplicates, as before
    assert spark.read.parquet(f"{target}/nodes").count() == 6


def test_bucketed_restore_and_walk_back(spark):
    from kinfold.model import catalog_graph
    from kinfold.sources.sinks import write_restored_tables

    w = _walk(spark)
    d = w.graph.dictionary
    db = f"kf_{uuid.uuid4().hex[:8]}"
    loc = scratch_dir(spark, db)
    spark.sql(f"create database {db} location '{loc}/db'")
    r = rs.restore_records(walk_records(w), d)
    write_restored_tables(r, sorted(d.node_tables.values()),
                          [e.edge_table for e in d.edge_types], db, loc, buckets=4)
    g2 = catalog_graph(spark, d, db)
    c = spark.createDataFrame([("C1",), ("C2",)], "id string")
    again = walk_records(walk_graph(g2, c, "case", include_upward=True))
    key = lambda df: sorted((x["topo_rank"], x["name"], x["id"],
                             tuple((y["dst_id"], y["dst_name"]) for y in x["relations"]))
                            for x in df.collect())
    assert key(again) == key(walk_records(w))
    # with a frontier too large to broadcast, the bucketed side is read without an exchange
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sel = c.select(c.id.alias("node_id")).distinct()
        plan = g2.nodes("case").join(sel, "node_id")._jdf.queryExecution().executedPlan()
        text = plan.toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in text


def test_enum_arrays_round_trip(spark):
    nodes = {"study": [("T1", {"tags": ["a b", "c"], "one": "x-y"}), ("T2", {"tags": None, "one": None})]}
    props = [PropField("study", "tags", "array<string>", True, ("a b", "c")),
             PropField("study", "one", "string", True, ("x-y",))]
    g = make_graph(spark, nodes, [], props)
    c = spark.createDataFrame([("T1",), ("T2",)], "id string")
    w = walk_graph(g, c, "study", include_upward=True)
    path = scratch_dir(spark, f"test-enum-arrays-{uuid.uuid4().hex[:6]}")
    ct.write_container(w, path)
    recs = ct.read_container(spark, path)
    raw = {r["id"]: json.loads(r["object"]) for r in rs.data_records(recs).collect()}
    assert raw["T1"] == {"tags": ["a_20_b", "c"], "one": "x_2d_y"}
    back = {r["node_id"]: json.loads(r["_props"])
            for r in rs.restore_records(recs, g.dictionary, encoded=True).nodes.collect()}
    assert back["T1"] == {"tags": ["a b", "c"], "one": "x-y"}
    assert back["T2"] == {"tags": None, "one": None}
    fields = {(r["name"], r["field"]): r["is_enum"]
              for r in ct.container_schema_fields(spark, path).collect()}
    assert fields[("study", "tags")] is True


def test_bucketed_edges_spread_a_hot_parent(spark):
    from kinfold.model import Dictionary, EdgeType, catalog_graph
    from kinfold.sources.sinks import write_restored_tables

    d = Dictionary({"p": "node_p", "c": "node_c"}, [EdgeType("c_p", "c", "p")])
    rel = "array<struct<dst_id:string,dst_name:string>>"
    rows = [("p", f"P{i}", "{}", []) for i in range(40)] + [
        ("c", f"C{i}", "{}", [("P0" if i % 3 == 0 else f"P{i % 40}", "p")]) for i in range(600)]
    recs = spark.createDataFrame(rows, f"name string, id string, object string, relations {rel}")
    db = f"kf_{uuid.uuid4().hex[:8]}"
    loc = scratch_dir(spark, db)
    spark.sql(f"create database {db} location '{loc}/db'")
    write_restored_tables(rs.restore_records(recs, d), ["node_p", "node_c"], ["c_p"], db, loc, buckets=8)
    edges = spark.table(f"{db}.c_p")
    per_file = [r["count"] for r in edges.groupBy("_metadata.file_path").count().collect()]
    assert len(per_file) == 8 and max(per_file) < 2 * 600 / 8  # a third of the edges has one parent
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.createDataFrame([("P0",)], "id string")
        plan = catalog_graph(spark, d, db).semi_edges("c_p", "dst", ids)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" not in plan and "hashpartitioning(dst_id" in plan


def test_stored_objects_that_a_container_cannot_hold_fail(spark):
    import pytest

    from kinfold.model import Dictionary, PropField, tables_graph

    d = Dictionary({"s": "node_s"}, [], [PropField("s", "n", "bigint"), PropField("s", "t", "string")])
    good = '{"n": 12, "t": "x"}'
    c = spark.createDataFrame([("1",), ("2",)], "id string")
    for bad in ('{"n":"12"}', '{"n":1.5}', '{"n":1,"x":1}', "not json", '{"t":5}'):
        table = spark.createDataFrame([("1", good), ("2", bad)], "node_id string, _props string")
        w = walk_graph(tables_graph(spark, d, lambda name, table=table: table), c, "s")
        with pytest.raises(Exception, match="does not fit type s: id 2"):
            ct.write_container(w, scratch_dir(spark, f"test-misfit-{uuid.uuid4().hex[:6]}"))
    table = spark.createDataFrame([("1", good), ("2", '{"n":null}')], "node_id string, _props string")
    path = scratch_dir(spark, f"test-fit-{uuid.uuid4().hex[:6]}")
    ct.write_container(walk_graph(tables_graph(spark, d, lambda name: table), c, "s"), path)
    back = {r["id"]: json.loads(r["object"]) for r in rs.data_records(ct.read_container(spark, path)).collect()}
    assert back == {"1": {"n": 12, "t": "x"}, "2": {"n": None, "t": None}}
