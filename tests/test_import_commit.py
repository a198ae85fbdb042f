"""All-or-nothing imports, one scan, key index, part headers, chunk digests."""

from __future__ import annotations

import hashlib
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from kinfold import jobs
from kinfold.model import Dictionary, EdgeType, GraphError, PropField
from kinfold.operators import restore as rs
from kinfold.session import scratch_dir
from kinfold.sources import container as ct
from kinfold.sources import keyindex, ranges, sinks
from kinfold.sources.commits import ImportLog
from kinfold.sources.manifest import artifact_manifest

D = Dictionary({"case": "node_case", "sample": "node_sample"}, [EdgeType("sample_case", "sample", "case")],
               [PropField("case", "age", "int"), PropField("sample", "kind", "string", True, ("a b", "c"))])
SCHEMA = "name string, id string, object string, relations array<struct<dst_id:string,dst_name:string>>"


def records(first, n):
    rows = [("Metadata", None, "{}", [])]
    for i in range(first, first + n):
        rows += [("case", f"C{i:05d}", json.dumps({"age": i}), []), ("sample", f"S{i:05d}", "{}", [(f"C{i:05d}", "case"), (f"C{i + 1:05d}", "case")])]
    return rows


def export(spark, rows, files=3):
    path = scratch_dir(spark, f"test-export-{uuid.uuid4().hex[:6]}")
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.parquet(path)
    return path


def target_of(spark):
    return scratch_dir(spark, f"test-target-{uuid.uuid4().hex[:6]}")


def held(spark, target):
    log = ImportLog(spark, target)
    nodes, edges = log.table("nodes"), log.table("edges")
    return (sorted(tuple(r) for r in nodes.select("node_table", "node_id", "_props").collect()) if nodes is not None else [],
            sorted(tuple(r) for r in edges.select("edge_table", "src_id", "dst_id").collect()) if edges is not None else [])


def want(rows):
    nodes = sorted((f"node_{n}", i, o) for n, i, o, _ in rows if n != "Metadata")
    return nodes, sorted(("sample_case", i, p) for _, i, _, rel in rows for p, _ in rel)


class Killed(Exception):
    pass


@pytest.mark.parametrize("where", ["stage", "index", "commit", "first move", "second move"])
def test_killed_import_is_finished_by_the_next_run(spark, monkeypatch, where):
    rows = records(0, 40)
    path, target = export(spark, rows), target_of(spark)

    def die(*_, **__):
        raise Killed

    with monkeypatch.context() as m:
        if where in ("stage", "index"):
            m.setattr(jobs, {"stage": "stage_import", "index": "index_staged"}[where], die)
        elif where == "commit":
            m.setattr(ImportLog, "_put_once", die)
        else:  # after the commit, between the tables' moves
            plan = ImportLog._moves
            m.setattr(ImportLog, "_moves", lambda self, e: plan(self, e)[: 1 if where == "first move" else 2])
            m.setattr(ImportLog, "discard", die)
        with pytest.raises(Killed):
            jobs.import_job(spark, path, D, target=target, fmt="parquet", import_id="one")
    if where in ("stage", "index", "commit"):
        assert held(spark, target) == ([], [])  # nothing is valid yet
    else:
        assert held(spark, target) == want(rows)  # committed: whoever reads finishes it
    jobs.import_job(spark, path, D, target=target, fmt="parquet", import_id="one")
    assert held(spark, target) == want(rows)
    log = ImportLog(spark, target)
    assert [c.import_id for c in log.commits()] == ["one"] and log.commits()[0].counts["nodes"] == 80
    left = log.vacuum()
    assert len(left) == 2 * (where == "commit") and held(spark, target) == want(rows)  # what the killed job had staged
    assert spark.read.parquet(f"{target}/nodes").count() == 80


def test_a_number_is_committed_once(spark):
    """Two writers with the same next number: the second takes the one after it."""
    target = target_of(spark)
    log = ImportLog(spark, target)
    jobs.import_job(spark, export(spark, records(0, 3)), D, target=target, fmt="parquet", import_id="a")
    assert not log._put_once("_commits/000000000001.json", "{}")
    jobs.import_job(spark, export(spark, records(3, 3)), D, target=target, fmt="parquet", import_id="b")
    assert [(c.number, c.import_id) for c in log.commits()] == [(1, "a"), (2, "b")]
    assert held(spark, target) == want(records(0, 6))
    for bad in ("../x", "", "_a"):
        with pytest.raises(GraphError, match="import id"):
            log.new_attempt(bad)


def test_refused_import_leaves_nothing(spark):
    bad = [("case", None, "{}", []), ("ghost", "g", "{}", []), ("case", "C9", "{", []), ("sample", "S9", "{}", [(None, "case"), ("x", "ghost")])]
    target = target_of(spark)
    with pytest.raises(GraphError, match="null id case .*unknown type ghost"):
        jobs.import_job(spark, export(spark, records(0, 5) + bad), D, target=target, fmt="parquet")
    assert held(spark, target) == ([], []) and ImportLog(spark, target).vacuum() == []


def test_import_reads_the_export_once(spark, monkeypatch):
    path = export(spark, records(0, 5))
    rows = rs.import_rows(spark.read.parquet(path), D)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    reads = []
    read = jobs.read_export
    monkeypatch.setattr(jobs, "read_export", lambda *a: reads.append(1) or read(*a))
    monkeypatch.setattr(sinks, "validate_records", lambda *a: pytest.fail("a clean import is not scanned again"))
    jobs.import_job(spark, path, D, target=target_of(spark), fmt="parquet")
    assert reads == [1]


def test_rows_without_commit_log_are_not_mixed_in(spark):
    target = target_of(spark)
    sinks.write_restored_files(rs.restore_records(spark.createDataFrame(records(0, 2), SCHEMA), D), target)
    with pytest.raises(GraphError, match="without a commit log"):
        jobs.import_job(spark, export(spark, records(0, 2)), D, target=target, fmt="parquet")


def test_reimport_reads_only_files_that_may_hold_a_key(spark):
    target = target_of(spark)
    for k in range(4):  # four imports of their own key ranges
        jobs.import_job(spark, export(spark, records(k * 1000, 300), 2), D, target=target, fmt="parquet")
    log = ImportLog(spark, target)
    again = records(1000, 50) + [r for r in records(9000, 20) if r[0] != "Metadata"]  # the start of the second, and new ones
    jobs.import_job(spark, export(spark, again), D, target=target, fmt="parquet", skip_existing=True, import_id="again")
    every = [r for k in range(4) for r in records(k * 1000, 300)]
    keys = {(n, i) for n, i, _, _ in every}
    edges = {(i, p) for _, i, _, rel in every for p, _ in rel}
    new = [(n, i, o, [r for r in rel if (i, r[0]) not in edges]) for n, i, o, rel in again if n == "Metadata" or (n, i) not in keys]
    assert held(spark, target) == want(every + new)
    compared = log.find("again").counts["files_compared"]
    files = spark.read.parquet(f"{target}/_keys").where("file <> ''").select("import", "kind", "table", "file").distinct().count()
    assert 0 < compared <= 6 < files  # the second import's files of three tables


def test_key_index_never_misses(spark):
    rows = [("nodes", "t", f"f{i % 3}", f"k{i * 7919 % 100_003}", None, None) for i in range(6000)]
    rows += [("edges", "e", "g", None, f"a{i}", f"b{i % 7}") for i in range(500)]
    frame = spark.createDataFrame(rows, "kind string, table string, file string, node_id string, src_id string, dst_id string")
    index = keyindex.key_index(frame).withColumn("import", F.lit("i")).cache()
    found = {tuple(r)[1:] for r in keyindex.files_that_may_hold(frame.drop("file"), index).collect()}
    assert found == {("nodes", "t", f"f{i}") for i in range(3)} | {("edges", "e", "g")}
    other = spark.createDataFrame([("nodes", "t", f"k{i}x", None, None) for i in range(3000)], "kind string, table string, node_id string, src_id string, dst_id string")
    held_by = keyindex._may_hold(keyindex.keyed(other).select("kind", "table", "k1", "h1", "h2"), index.where("file = ''"), ["kind", "table"])
    assert held_by.count() < 0.05 * 3000  # false positives
    assert index.select(F.max(F.octet_length("bits"))).first()[0] == keyindex.BLOCK // 8


def test_key_index_deals_keys_out_by_block(spark):
    """The keys of one large table are not one task's work: no raw key is dealt out by its table or file."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that no join broadcasts by itself
        ids = F.concat(F.lit("k"), F.col("id").cast("string"))
        rows = spark.range(60_000, numPartitions=4).select(F.lit("nodes").alias("kind"), F.lit("t").alias("table"), F.lit("f").alias("file"), ids.alias("node_id"),
                                                           F.lit(None).cast("string").alias("src_id"), F.lit(None).cast("string").alias("dst_id"))
        index = keyindex.key_index(rows)
        assert "SortMergeJoin" not in index._jdf.queryExecution().executedPlan().toString()
        blocks = index.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(blocks) == 2 * 22 and {(r["n"], r["blocks"], r["file"]) for r in blocks} == {(60_000, 22, "f"), (60_000, 22, "")}
    tasks = [sum(r["task"] == t for r in blocks) for t in {r["task"] for r in blocks}]
    assert len(tasks) > 1 and max(tasks) < 0.6 * len(blocks)
    keys = {i: {r["block"]: bytes(r["bits"]) for r in blocks if r["file"] == i} for i in ("f", "")}
    assert keys["f"] == keys[""]
    assert keyindex.files_that_may_hold(rows.drop("file"), spark.createDataFrame(blocks).withColumn("import", F.lit("i"))).collect() == [("i", "nodes", "t", "f")]


# -- headers of all parts ----------------------------------------------------

def container_of(spark, symbols, extra=(), kind="int"):
    """A container with one case (age of type ``kind``) and one sample whose kind is the last symbol."""
    from kinfold.functions.enums import encode_symbol

    d = Dictionary(D.node_tables, D.edge_types, [PropField("case", "age", kind), PropField("sample", "kind", "string", True, symbols), *extra])
    path = scratch_dir(spark, f"test-parts-{uuid.uuid4().hex[:6]}")
    objects = {lbl: F.struct(*(F.lit(None).cast(p.type).alias(p.field) if p.field not in ("age", "kind") else
                               F.lit(7).cast(kind).alias("age") if p.field == "age" else F.lit(encode_symbol(symbols[-1])).alias("kind") for p in d.fields(lbl)))
               for lbl in ("case", "sample")}
    frames = [spark.range(1).select(F.lit(f"{lbl}-{symbols[-1]}-{kind}").alias("id"), F.lit(lbl).alias("name"),
                                    ct._object_struct(d, lbl, objects[lbl]).alias("object"),
                                    F.array().cast("array<struct<dst_id:string,dst_name:string>>").alias("relations")) for lbl in objects]
    frames[0].unionByName(frames[1]).coalesce(1).write.format(ct.AVRO_FORMAT).option("avroSchema", json.dumps(ct.entity_schema(d))).save(path)
    return path


def joined(spark, *containers):
    """One container folder with the parts of several."""
    path = scratch_dir(spark, f"test-joined-{uuid.uuid4().hex[:6]}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    to = hadoop.Path(path)
    fs = to.getFileSystem(conf)
    fs.mkdirs(to)
    for source in containers:
        for s in fs.globStatus(hadoop.Path(f"{source}/*.avro")):
            hadoop.FileUtil.copy(fs, s.getPath(), fs, to, False, conf)
    return path


def test_parts_with_different_schemas_import_right(spark):
    path = joined(spark, container_of(spark, ("a b", "c")), container_of(spark, ("c", "d > e"), [PropField("case", "height", "double")]),
                  container_of(spark, ("zz",), kind="bigint"))
    fields = {(n, f): (t, e) for n, f, t, e in ct.schema_fields(ct.container_schema(spark, path))}
    assert fields[("case", "height")][0] == "double" and fields[("case", "age")][0] == "long" and fields[("sample", "kind")][1]
    target = target_of(spark)
    jobs.import_job(spark, path, Dictionary(D.node_tables, D.edge_types), target=target)
    nodes = {i: json.loads(p) for _, i, p in held(spark, target)[0]}
    assert {i: p["kind"] for i, p in nodes.items() if "kind" in p} == {"sample-c-int": "c", "sample-d > e-int": "d > e", "sample-zz-bigint": "zz"}
    assert all(p == {"age": 7, "height": None} for p in nodes.values() if "age" in p) and len(nodes) == 6


def test_conflicting_parts_fail_by_name(spark):
    path = joined(spark, container_of(spark, ("a b",)), container_of(spark, ("a b",), kind="string"))
    with pytest.raises(GraphError, match=r"part-.*case\.age"):
        ct.container_schema(spark, path)
    with pytest.raises(GraphError, match="no container parts"):
        ct.container_schema(spark, export(spark, records(0, 1)))


def test_header_longer_than_the_first_read(spark, monkeypatch):
    path = container_of(spark, ("a b", "c"))
    whole = ct.container_schema(spark, path)
    monkeypatch.setattr(ranges, "_HEAD", 7)
    assert ct.container_schema(spark, path) == whole
    with pytest.raises(ValueError, match="not an Avro"):
        ranges.header_schema(b"PAR1....")


# -- digests of large files --------------------------------------------------

def test_large_files_are_hashed_in_chunks(spark):
    path = scratch_dir(spark, f"test-digest-{uuid.uuid4().hex[:6]}")
    local = path.removeprefix("file:")
    os.makedirs(local)
    sizes = {"one": 1, "small": 999, "exact": 1000, "large": 10_500, "even": 4000}
    content = {n: os.urandom(s) for n, s in sizes.items()}
    for n, data in content.items():
        with open(f"{local}/{n}.bin", "wb") as f:
            f.write(data)
    rows = {r["file_name"][:-4]: r for r in artifact_manifest(spark, path, chunk=1000, authz=["/a"]).collect()}
    for n, data in content.items():
        r = rows[n]
        assert r["size"] == len(data) and list(r["authz"]) == ["/a"] and uuid.UUID(r["did"])
        if len(data) <= 1000:
            assert r["md5"] == hashlib.md5(data).hexdigest() == r["hashes"]["md5"]
        else:
            parts = [hashlib.md5(data[i : i + 1000]).digest() for i in range(0, len(data), 1000)]
            assert r["md5"] is None and r["hashes"] == {"md5_tree": f"{hashlib.md5(b''.join(parts)).hexdigest()}-{len(parts)}"}
    chunks = ranges.chunk_digests(ranges.listed(spark, path).where("file_name = 'large.bin'"), 1000)
    tasks = chunks.withColumn("task", F.spark_partition_id()).collect()
    assert len(tasks) == 11 and len({r["task"] for r in tasks}) > 1  # one file, several tasks
    assert {r["did"] for r in artifact_manifest(spark, path, chunk=1000).collect()} == {r["did"] for r in rows.values()}
