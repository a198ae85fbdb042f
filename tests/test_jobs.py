"""End-to-end export and import jobs over the star-schema fixture."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kinfold import jobs
from kinfold.session import scratch_dir
from kinfold.sources import star

SF = "/root/testdata/sf0.001"


def walk_folders(spark):
    from kinfold.session import ensure_checkpoint_dir

    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/") + "/walk-*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return {f.getPath().toString() for f in found}


def test_request_parsing():
    r = jobs.parse_request('{"filter": {"=": {"c_nationkey": 7}}}', "customer")
    assert r.root == "customer" and r.filter == {"=": {"c_nationkey": 7}} and r.extra == []
    r = jobs.parse_request({"root_node": "orders"}, "customer", "part, supplier")
    assert r.root == "orders" and r.extra == ["part", " supplier"]  # items not trimmed
    assert jobs.parse_extra("", "x", {"x": ["y"]}) == ["y"]  # the root's own extras always apply
    assert jobs.parse_extra("", "x") == []
    assert jobs.parse_extra(None, "x", {"x": ["y"]}) == ["y"]
    assert jobs.parse_extra("a", "x", {"x": ["y"]}) == ["a", "y"]
    assert ":" not in jobs.run_name()


def test_export_then_import(spark):
    graph = star.star_graph(spark, SF)
    index = star.cohort_index(spark, SF)
    req = jobs.parse_request({"filter": {"=": {"c_nationkey": 7}}}, "customer", "supplier")
    base = scratch_dir(spark, f"test-jobs-{uuid.uuid4().hex[:6]}")
    before = walk_folders(spark)
    res = jobs.export_job(graph, index, req, base, star.grants(spark, SF))
    files = res.manifest.collect()
    assert files and all(f["file_name"].endswith(".avro") for f in files)
    assert not [p for p in walk_folders(spark) if p not in before]  # the walk's states are deleted
    assert [r[0] for r in res.authz.collect()] == ["/programs/ASIA/projects/NATION_7"]
    target = f"{base}/restored"
    restored = jobs.import_job(spark, res.path, star.star_dictionary(spark, SF), target=target)
    nodes = spark.read.parquet(f"{target}/nodes")
    cust = nodes.where(F.col("node_table") == "node_customer").count()
    want = (spark.read.parquet(f"{SF}/customer.parquet")
            .where("c_nationkey = 7").count())
    assert cust == want
    assert restored.edges.where(F.col("edge_table") == "customer_nation").count() == want
    # decoded enum text is back in the stored props
    seg = nodes.where(F.col("node_table") == "node_customer").select(
        F.get_json_object("_props", "$.c_mktsegment").alias("s")).distinct().collect()
    assert {r["s"] for r in seg} <= set(star.ENUM_SYMBOLS["c_mktsegment"])


def test_star_export_properties(spark):
    """Relations point at exported records of a lower rank (no dangling edges here)."""
    from kinfold import registry

    recs = registry.flagship_records(spark, "/root/testdata/sf0.01")
    rows = recs.select("topo_rank", "name", "id", "relations").collect()
    rank = {(r["name"], r["id"]): r["topo_rank"] for r in rows}
    n_rel = 0
    for r in rows:
        for rel in r["relations"]:
            n_rel += 1
            assert (rel["dst_name"], rel["dst_id"]) in rank
            assert rank[(rel["dst_name"], rel["dst_id"])] < r["topo_rank"]
    assert n_rel > 0


def test_cohort_column_name_is_free(spark):
    from kinfold.operators.records import walk_records
    from kinfold.operators.traverse import walk_graph

    g = star.star_graph(spark, SF)
    c = spark.read.parquet(f"{SF}/customer.parquet").where("c_nationkey = 7").select("c_custkey")
    recs = walk_records(walk_graph(g, c, "customer", include_upward=True))
    assert recs.where("name = 'customer'").count() == c.count()


def test_parquet_export_then_import(spark):
    graph = star.star_graph(spark, SF)
    index = star.cohort_index(spark, SF)
    req = jobs.parse_request({"filter": {"=": {"c_nationkey": 7}}}, "customer")
    base = scratch_dir(spark, f"test-jobs-pq-{uuid.uuid4().hex[:6]}")
    res = jobs.export_job(graph, index, req, base, fmt="parquet")
    assert all(f["file_name"].endswith(".parquet") for f in res.manifest.collect())
    recs = spark.read.parquet(res.path)
    ranks = {r["name"]: r["topo_rank"] for r in recs.select("name", "topo_rank").distinct().collect()}
    assert ranks["region"] < ranks["nation"] < ranks["customer"] < ranks["orders"] < ranks["lineitem"]
    target = f"{base}/restored"
    jobs.import_job(spark, res.path, star.star_dictionary(spark, SF), target=target, fmt="parquet")
    nodes = spark.read.parquet(f"{target}/nodes")
    assert nodes.count() == recs.count()
    # Parquet records hold plain text, and the import leaves it as it is
    plain = recs.where("name = 'orders'").select("id", "object").collect()
    assert any('"5-LOW"' in r["object"] or '"1-URGENT"' in r["object"] for r in plain)
    back = {r["node_id"]: r["_props"] for r in nodes.where("node_table = 'node_orders'").collect()}
    assert back == {r["id"]: r["object"] for r in plain}
