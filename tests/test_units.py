"""Type planning, cohort filters, enum codec, props and restore checks."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from kinfold.functions.enums import decode_enum, encode_enum, encode_symbol
from kinfold.functions.props import json_int, malformed
from kinfold.model import Dictionary, EdgeType, GraphError, PropField
from kinfold.operators import cohort as co
from kinfold.operators import restore as rs
from kinfold.operators.records import export_records
from kinfold.plans import topology as tp
from kinfold.plans import typegraph as tg
from micro import M1_LINKS, M1_NODES, make_graph

M1_DICT = Dictionary(
    node_tables={lbl: f"node_{lbl}" for lbl in M1_NODES},
    edge_types=[EdgeType(t, c, p) for t, c, p, _ in M1_LINKS])


# -- type planning -------------------------------------------------------------

def test_paths_and_plan():
    assert tp.upward_path(M1_DICT, "sample") == ["sample", "subject", "project", "program"]
    assert tp.downward_path(M1_DICT, "program") == ["program", "project", "subject", "sample"]
    plan = tp.traversal_plan(M1_DICT, "subject", ["program"], include_upward=True)
    assert [(s.way, s.label) for s in plan] == [
        ("up", "subject"), ("up", "project"), ("up", "program"),
        ("down", "program"), ("down", "sample")]
    assert tp.record_ranks(plan) == {"program": 0, "project": 1, "subject": 2, "sample": 3}
    down_only = tp.traversal_plan(M1_DICT, "project", ["program"], include_upward=False)
    assert [s.label for s in down_only] == ["project", "subject", "sample"]


def test_longest_path_order_with_shortcut():
    d = Dictionary({x: x for x in "abcd"},
                   [EdgeType("b_a", "b", "a"), EdgeType("c_b", "c", "b"),
                    EdgeType("c_a", "c", "a"), EdgeType("d_c", "d", "c")])
    # c is reachable from a in one step and in two: it must follow b
    assert tp.downward_path(d, "a") == ["a", "b", "c", "d"]
    assert tp.bfs_levels(d, "a") == {"a": 0, "b": 1, "c": 1, "d": 2}


def test_unknown_root_and_cycle():
    with pytest.raises(GraphError):
        tp.upward_path(M1_DICT, "nope")
    cyc = Dictionary({"a": "a", "b": "b"}, [EdgeType("a_b", "a", "b"), EdgeType("b_a", "b", "a")])
    with pytest.raises(GraphError, match="cycle"):
        tp.upward_path(cyc, "a")
    with pytest.raises(GraphError, match="cycle"):
        cyc.validate()


def test_ambiguous_pair_raises():
    d = Dictionary({"a": "a", "b": "b"}, [EdgeType("x", "a", "b"), EdgeType("y", "a", "b")])
    with pytest.raises(GraphError, match="two edge tables"):
        d.edge_table_by_labels()


def test_typegraph_frames(spark):
    et = M1_DICT.edge_types_df(spark)
    depths = {r["label"]: r["depth"] for r in tg.type_depths(et, "sample", "up", 4).collect()}
    assert depths == {"sample": 0, "subject": 1, "project": 2, "program": 3}
    bfs = {r["label"]: r["level"] for r in tg.type_bfs(et, "program", 4).collect()}
    assert bfs == {"program": 0, "project": 1, "subject": 2, "sample": 3}
    plan = [(r["pos"], r["way"], r["label"]) for r in
            tg.traversal_plan_df(et, "subject", ["program"], True, 4).orderBy("pos").collect()]
    assert plan == [(i, s.way, s.label) for i, s in enumerate(
        tp.traversal_plan(M1_DICT, "subject", ["program"], True))]
    by = {r["label"]: r["edge_tables"] for r in tg.edges_by_type(et).collect()}
    assert by == {"project": "project_program", "subject": "subject_project",
                  "sample": "sample_subject"}
    cyc = Dictionary({"a": "a", "b": "b"}, [EdgeType("a_b", "a", "b"), EdgeType("b_a", "b", "a")])
    with pytest.raises(Exception, match="cycle"):
        tg.type_depths(cyc.edge_types_df(spark), "a", "up", 2).collect()


# -- cohort ----------------------------------------------------------------------

def test_filter_documents(spark):
    df = spark.createDataFrame(
        [("1", "a", 5, "/p/x"), ("2", "b", 7, "/p/y"), ("3", "a", 9, "/p/z")],
        "_case_id string, kind string, n int, auth_resource_path string")
    ids = lambda doc, grants=None: sorted(
        r["id"] for r in co.select_cohort(df, "case", doc, grants).collect())
    assert ids({}) == ["1", "2", "3"]
    assert ids(json.dumps({"filter": {"=": {"kind": "a"}}})) == ["1", "3"]
    assert ids({"AND": [{"=": {"kind": "a"}}, {">": {"n": 6}}]}) == ["3"]
    assert ids({"or": [{"in": {"kind": ["b"]}}, {"<=": {"n": 5}}]}) == ["1", "2"]
    grants = spark.createDataFrame([("/p/x",), ("/p/z",)], "auth_resource_path string")
    assert ids({}, grants) == ["1", "3"]
    assert co.cohort_count(df, {"=": {"kind": "a"}}, grants).first()["total_count"] == 2
    assert sorted(r[0] for r in co.cohort_authz(df, {}, grants).collect()) == ["/p/x", "/p/z"]
    with pytest.raises(ValueError):
        co.filter_column({"regex": {"kind": "a"}})
    with pytest.raises(ValueError):
        co.select_cohort(df, "other", {})


# -- enum codec and props ------------------------------------------------------------

def test_enum_codec(spark):
    vals = ["bpm > 60", "äü", "a\U0001F600b", "", None, "x\ny", "Brand#17", "plain_1",
            "1-URGENT"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select("v", encode_enum("v").alias("e")).select(
        "v", "e", decode_enum("e").alias("d")).collect()
    enc = {r["v"]: r["e"] for r in rows}
    assert enc["bpm > 60"] == "bpm_20__3e__20_60"
    assert enc["äü"] == "_e4__fc_"
    assert enc["a\U0001F600b"] == "a_1f600_b"
    assert enc[""] == "" and enc[None] is None
    assert enc["x\ny"] == "x_0a_y"
    assert enc["plain_1"] == "plain_1"
    assert enc["Brand#17"] == "Brand_23_17"
    assert encode_symbol("1-URGENT") == "_31__2d_URGENT"
    assert encode_symbol("bpm > 60") == enc["bpm > 60"]
    for r in rows:
        assert r["d"] == r["v"]


def test_props_functions(spark):
    df = spark.createDataFrame([('{"k": 3}',), ('{"k": "x"}',), ("not json",), (None,)],
                               "p string")
    got = [(r["k"], r["bad"]) for r in
           df.select(json_int("p", "k").alias("k"), malformed("p").alias("bad")).collect()]
    assert got == [(3, False), (None, False), (None, True), (None, False)]


# -- restore -----------------------------------------------------------------------------

def _records(spark):
    g = make_graph(spark, M1_NODES, M1_LINKS)
    c = spark.createDataFrame([("S1",)], "id string")
    return export_records(g, c, "subject", include_upward=True, materialize="persist")


def test_restore_nodes_and_edges(spark):
    d = M1_DICT
    r = rs.restore_records(_records(spark), d)
    nodes = sorted((x["node_table"], x["node_id"]) for x in r.nodes.collect())
    assert nodes == [("node_program", "P1"), ("node_project", "J1"),
                     ("node_sample", "X1"), ("node_sample", "X2"), ("node_subject", "S1")]
    edges = sorted((x["edge_table"], x["src_id"], x["dst_id"]) for x in r.edges.collect())
    assert edges == [("project_program", "J1", "P1"), ("sample_subject", "X1", "S1"),
                     ("sample_subject", "X2", "S1"), ("subject_project", "S1", "J1")]
    row = r.edges.first()
    assert row["acl"] == "{}" and row["_sysan"] == "{}" and row["_props"] == "{}"
    assert sorted(x["name"] for x in rs.distinct_types(_records(spark)).collect()) == [
        "program", "project", "sample", "subject"]
    assert sorted(x[0] for x in rs.distinct_edge_tables(_records(spark), d).collect()) == [
        "project_program", "sample_subject", "subject_project"]


def test_restore_rejects_unknown_types_and_edges(spark):
    recs = _records(spark)
    small = Dictionary({k: v for k, v in M1_DICT.node_tables.items() if k != "sample"},
                       [e for e in M1_DICT.edge_types if e.src_label != "sample"])
    assert [(r["name"], r["n_records"]) for r in rs.unknown_types(recs, small).collect()] == [
        ("sample", 2)]
    assert [(r["name"], r["dst_name"], r["n_relations"])
            for r in rs.unknown_edges(recs, small).collect()] == [("sample", "subject", 2)]
    with pytest.raises(GraphError):
        rs.validate_records(recs, small)
    with pytest.raises(Exception, match="unknown entity type"):
        rs.restore_records(recs, small).nodes.collect()
    rs.validate_records(recs, M1_DICT)


def test_restore_decodes_enums_and_keeps_nulls(spark):
    d = Dictionary({"s": "node_s"}, [],
                   [PropField("s", "kind", "string", True), PropField("s", "n", "int")])
    recs = spark.createDataFrame(
        [("s", "1", '{"kind": "bpm_20__3e__20_60", "n": 1}', []),
         ("s", "2", '{"kind": null, "n": null}', []),
         ("Metadata", "m", "{}", [])],
        "name string, id string, object string, "
        "relations array<struct<dst_id:string,dst_name:string>>")
    r = rs.restore_records(recs, d, encoded=True)
    got = {x["node_id"]: json.loads(x["_props"]) for x in r.nodes.collect()}
    assert got == {"1": {"kind": "bpm > 60", "n": 1}, "2": {"kind": None, "n": None}}


def _rows(spark, rows):
    return spark.createDataFrame(rows, "name string, id string, object string, relations array<struct<dst_id:string,dst_name:string>>")


KIND = Dictionary({"s": "node_s"}, [], [PropField("s", "kind", "string", True), PropField("s", "n", "int"),
                                        PropField("s", "tags", "array<string>", True)])


def test_restore_keeps_every_field_and_value(spark):
    objects = ['{"kind":"a_20_b","n":"12","extra_field":{"deep":[1,2.50,null]}}', '{"kind":"plain","n":1.5}',
               '{"kind":5,"tags":["x_20_y","z"],"other":"x_20_y"}', '{"tags":"x_20_y"}', "{}", None]
    recs = _rows(spark, [("s", str(i), o, []) for i, o in enumerate(objects)])
    plain = {r["node_id"]: r["_props"] for r in rs.restore_records(recs, KIND).nodes.collect()}
    assert [plain[str(i)] for i in range(6)] == objects  # never encoded: nothing is decoded
    got = {r["node_id"]: r["_props"] for r in rs.restore_records(recs, KIND, encoded=True).nodes.collect()}
    assert [got[str(i)] and json.loads(got[str(i)]) for i in range(6)] == [
        {"kind": "a b", "n": "12", "extra_field": {"deep": [1, 2.5, None]}}, {"kind": "plain", "n": 1.5},
        {"kind": 5, "tags": ["x y", "z"], "other": "x_20_y"}, {"tags": "x y"}, {}, None]


def test_import_problems_in_one_scan(spark):
    recs = _rows(spark, [("s", "1", "{}", []), (None, "2", "{}", []), ("s", None, "{}", []), ("x", "3", "{}", [("1", "s")]),
                         ("s", "4", "{bad", [("1", "s"), (None, "s")]), ("Metadata", None, "{}", []), ("s", "5", None, None)])
    d = Dictionary({"s": "node_s", "t": "node_t"}, [EdgeType("s_t", "s", "t")])
    frame = rs.import_problems(recs, d)
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == sorted([
        ("unknown type", None, None, 1), ("null id", "s", None, 1), ("unknown type", "x", None, 1),
        ("unknown edge", "x", "s", 1), ("malformed object", "s", None, 1), ("unknown edge", "s", "s", 2)], key=repr)
    with pytest.raises(GraphError, match="unknown type None"):
        rs.validate_records(recs, d)
    for bad in ("name IS NULL", "id IS NULL AND name = 's'"):
        with pytest.raises(Exception, match="unknown entity type null|null id of type s"):
            rs.restore_records(recs.where(bad), d).nodes.collect()


def test_import_problems_scan_the_input_once(spark, tmp_path):
    recs = _rows(spark, [("s", "1", "{}", [])])
    recs.write.parquet(str(tmp_path / "r"))
    plan = rs.import_problems(spark.read.parquet(str(tmp_path / "r")), KIND)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_literal_null_ids_fail(spark):
    from kinfold.sources.jdbc import keyed_scan

    with pytest.raises(GraphError, match="null id"):
        keyed_scan(spark.range(3), ["1", None], "id")


@pytest.mark.parametrize("text", ["x_20_y", "_ab c", "__20__", "a_5f_b", "_1f600_", "1_20 _30_", "_20", "é_e9_é", "_abc1234_", "a _ b", "_ab_20_cd_ "])
def test_enum_codec_is_exact_for_text_that_looks_escaped(spark, text):
    row = spark.createDataFrame([(text,)], "v string").select(encode_enum("v").alias("e")).select("e", decode_enum("e").alias("d")).first()
    assert row["d"] == text and row["e"] == encode_symbol(text)


def test_enum_codec_of_texts_with_few_and_many_different_characters(spark):
    letters = [chr(c) for c in [*range(1, 127), *range(0xC0, 0x180), *range(0x4E00, 0x4E40), 0xFFFF, 0x1F600, 0x10FFFF]]
    texts = ["".join(letters[(i * i + k) % n] for i in range(3 * n)) for n in (1, 7, 40, 126, len(letters)) for k in range(8)]
    texts += ["9", "0 a", "9_ab ", "\n1", "_", "\U0001F600\U0001F600"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").select("v", encode_enum("v").alias("e"))
    for r in df.select("v", "e", decode_enum("e").alias("d")).collect():
        assert r["e"] == encode_symbol(r["v"]) and r["d"] == r["v"]


def test_enum_symbol_of_a_long_text_takes_less_than_a_look_at_each_character(spark):
    texts = spark.range(40, numPartitions=4).select(F.repeat(F.lit("a word, and 1 more\n"), 10_000).alias("v"))

    def seconds(c):
        t0 = time.perf_counter()
        texts.select(F.md5(c).alias("x")).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    each = F.array_join(F.filter(F.split("v", ""), lambda ch: ch.rlike("^[A-Za-z0-9_]$")), "")
    assert min(seconds(encode_enum("v")) for _ in range(2)) < min(seconds(each) for _ in range(2))


def test_type_graph_of_many_layers(spark):
    # every layer's two types link to both types above: 2 ** 30 paths, 30 levels
    edges = [(f"e{i}{a}{b}", f"t{i + 1}{a}", f"t{i}{b}") for i in range(30) for a in "xy" for b in "xy"]
    et = spark.createDataFrame(edges, "edge_table string, src_label string, dst_label string")
    up = {r["label"]: r["depth"] for r in tg.type_depths(et, "t30x", "up", 62).collect()}
    assert up["t0x"] == up["t0y"] == 30 and len(up) == 61
    assert {r["label"]: r["level"] for r in tg.type_bfs(et, "t0x", 62).collect()}["t30y"] == 30
    loop = spark.createDataFrame([("a", "x", "y"), ("b", "y", "x")], "edge_table string, src_label string, dst_label string")
    with pytest.raises(GraphError, match="cycle"):
        tg.type_depths(loop, "x", "up", 2)


def test_type_graph_levels_are_one_job(spark, monkeypatch):
    """14 layers of 3 types, 3 ** 14 paths: one fetch of one row, whatever the number of levels."""
    edges = [(f"e{i}{a}{b}", f"t{i + 1}{a}", f"t{i}{b}") for i in range(14) for a in "xyz" for b in "xyz"] + [("skip", "t14x", "t0x")]
    et = spark.createDataFrame(edges, "edge_table string, src_label string, dst_label string")
    fetched = []
    frame = type(et)  # the session's own class, which overrides the public one's methods
    first = frame.first
    monkeypatch.setattr(frame, "first", lambda self: fetched.append(1) or first(self))
    rows = tg.type_topology(et, "t14x", 45).collect()
    up = {r["label"]: r["depth"] for r in rows if r["direction"] == "up"}
    assert len(fetched) == 1 and len(up) == 43 and up["t0x"] == up["t0z"] == 14
    assert [(r["label"], r["depth"]) for r in rows if r["direction"] == "down"] == [("t14x", 0)]
    assert {r["label"]: r["level"] for r in tg.type_bfs(et, "t0x", 45).collect()}["t14x"] == 1


def test_dictionary_save_and_load(spark):
    import uuid

    from kinfold.model import load_dictionary, save_dictionary
    from kinfold.session import scratch_dir
    from kinfold.sources import star

    d = star.star_dictionary(spark, "/root/testdata/sf0.001")
    path = scratch_dir(spark, f"test-dict-{uuid.uuid4().hex[:6]}")
    save_dictionary(spark, d, path)
    back = load_dictionary(spark, path)
    assert back.node_tables == d.node_tables
    assert sorted(back.edge_types, key=lambda e: e.edge_table) == sorted(
        d.edge_types, key=lambda e: e.edge_table)
    assert back.props == d.props


def test_jdbc_predicates_cover_all_buckets():
    from kinfold.sources.jdbc import hash_predicates, postgres_properties

    preds = hash_predicates("node_id", 4, hash_expr="hashtext(node_id)")
    assert preds == [f"ABS(MOD(hashtext(node_id), 4)) = {i}" for i in range(4)]
    assert hash_predicates("id", 2) == ["ABS(MOD(id, 2)) = 0", "ABS(MOD(id, 2)) = 1"]
    props = postgres_properties("u", "p")
    assert props["stringtype"] == "unspecified" and props["driver"] == "org.postgresql.Driver"


def test_malformed_objects_are_rejected(spark):
    d = Dictionary({"s": "node_s"}, [], [PropField("s", "n", "int")])
    recs = spark.createDataFrame(
        [("s", "1", '{"n": 1}', []), ("s", "2", "{broken", [])],
        "name string, id string, object string, "
        "relations array<struct<dst_id:string,dst_name:string>>")
    assert [r["id"] for r in rs.malformed_objects(recs).collect()] == ["2"]
    with pytest.raises(GraphError, match="malformed"):
        rs.validate_records(recs, d)


def test_typegraph_plan_downward_only(spark):
    et = M1_DICT.edge_types_df(spark)
    plan = [(r["pos"], r["way"], r["label"]) for r in
            tg.traversal_plan_df(et, "project", ["program"], False, 4).orderBy("pos").collect()]
    assert plan == [(i, s.way, s.label) for i, s in enumerate(
        tp.traversal_plan(M1_DICT, "project", ["program"], False))]
    assert [x[2] for x in plan] == ["project", "subject", "sample"]
