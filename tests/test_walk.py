"""Walk and record semantics on micro graphs (FIXTURES M1-M8) and random DAGs."""

from __future__ import annotations

import copy

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kinfold.model import GraphError
from kinfold.operators.records import export_records, walk_records
from kinfold.operators.traverse import walk_graph
from micro import M1_LINKS, M1_NODES, brute_walk, make_graph, records_of


def cohort(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def rel(*pairs):
    return tuple(pairs)


@pytest.mark.parametrize("mode", ["parquet", "persist", "checkpoint"])
def test_m1_up_and_down(spark, mode):
    g = make_graph(spark, M1_NODES, M1_LINKS)
    recs = records_of(export_records(g, cohort(spark, ["S1"]), "subject",
                                     include_upward=True, materialize=mode))
    assert recs == [
        (0, "program", "P1", ()),
        (1, "project", "J1", rel(("P1", "program"))),
        (2, "subject", "S1", rel(("J1", "project"))),
        (3, "sample", "X1", rel(("S1", "subject"))),
        (3, "sample", "X2", rel(("S1", "subject"))),
    ]


def test_m1_downward_only_root_has_no_relations(spark):
    g = make_graph(spark, M1_NODES, M1_LINKS)
    recs = records_of(export_records(g, cohort(spark, ["J1"]), "project",
                                     extra=["program"], include_upward=False))
    # extras are ignored without the upward walk; the root carries no relations
    assert recs == [
        (0, "project", "J1", ()),
        (1, "subject", "S1", rel(("J1", "project"))),
        (1, "subject", "S2", rel(("J1", "project"))),
        (2, "sample", "X1", rel(("S1", "subject"))),
        (2, "sample", "X2", rel(("S1", "subject"))),
        (2, "sample", "X3", rel(("S2", "subject"))),
    ]


def test_m2_or_rule_samples_tied_to_project(spark):
    nodes = copy.deepcopy(M1_NODES)
    nodes["sample"] += [("X5", {}), ("X6", {})]
    links = M1_LINKS + [("sample_project", "sample", "project",
                         [("X5", "J1"), ("X6", "J2"), ("X1", "J1")])]
    g = make_graph(spark, nodes, links)
    recs = records_of(export_records(g, cohort(spark, ["S1"]), "subject", include_upward=True))
    samples = [r for r in recs if r[1] == "sample"]
    assert samples == [
        (3, "sample", "X1", rel(("J1", "project"), ("S1", "subject"))),
        (3, "sample", "X2", rel(("S1", "subject"))),
        (3, "sample", "X5", rel(("J1", "project"))),
    ]


def test_m3_relations_hold_selected_parents_only(spark):
    nodes = copy.deepcopy(M1_NODES)
    nodes["batch"] = [("B1", {})]
    nodes["file"] = [("F1", {}), ("F2", {})]
    links = M1_LINKS + [
        ("file_sample", "file", "sample", [("F1", "X1")]),
        ("file_batch", "file", "batch", [("F1", "B1"), ("F2", "B1")]),
    ]
    g = make_graph(spark, nodes, links)
    recs = records_of(export_records(g, cohort(spark, ["S1"]), "subject", include_upward=True))
    files = [r for r in recs if r[1] == "file"]
    assert files == [(4, "file", "F1", rel(("X1", "sample")))]
    assert not [r for r in recs if r[1] == "batch"]


def test_m4_extra_with_downward_parent_adds_nothing(spark):
    # sample's parent (subject) lies below the root: not selected when extras run
    g = make_graph(spark, M1_NODES, M1_LINKS)
    base = records_of(export_records(g, cohort(spark, ["J1"]), "project", include_upward=True))
    with_extra = records_of(export_records(g, cohort(spark, ["J1"]), "project",
                                           extra=["sample"], include_upward=True))
    assert with_extra == base
    assert [r[2] for r in base if r[1] == "sample"] == ["X1", "X2", "X3"]


def test_extra_without_parents_selects_nothing(spark):
    nodes = copy.deepcopy(M1_NODES)
    nodes["lone"] = [("L1", {})]
    g = make_graph(spark, nodes, M1_LINKS)
    recs = records_of(export_records(g, cohort(spark, ["S1"]), "subject",
                                     extra=["lone"], include_upward=True))
    assert not [r for r in recs if r[1] == "lone"]


def test_m5_extra_on_up_path_pulls_siblings_once(spark):
    g = make_graph(spark, M1_NODES, M1_LINKS)
    recs = records_of(export_records(g, cohort(spark, ["S1"]), "subject",
                                     extra=["project"], include_upward=True))
    projects = [r for r in recs if r[1] == "project"]
    assert projects == [
        (1, "project", "J1", rel(("P1", "program"))),
        (1, "project", "J2", rel(("P1", "program"))),
    ]
    # siblings' children are not walked: the root is not revisited
    assert [r[2] for r in recs if r[1] == "subject"] == ["S1"]
    assert len(recs) == len(set((r[1], r[2]) for r in recs))


def test_m6_colliding_ids_do_not_leak_between_labels(spark):
    nodes = {
        "project": [("1", {}), ("2", {})],
        "site": [("1", {}), ("2", {})],
        "subject": [("1", {}), ("2", {})],
    }
    links = [
        ("subject_project", "subject", "project", [("1", "1"), ("2", "2")]),
        ("subject_site", "subject", "site", [("2", "1")]),
    ]
    g = make_graph(spark, nodes, links)
    recs = records_of(export_records(g, cohort(spark, ["1"]), "subject", include_upward=True))
    # up path: subject, then project and site (rank: site 0, project 1, subject 2)
    assert recs == [
        (1, "project", "1", ()),
        (2, "subject", "1", rel(("1", "project"))),
    ]


def test_m7_validation_errors(spark):
    g = make_graph(spark, {"a": [("1", {})], "b": [("1", {})]},
                   [("a_b", "a", "b", []), ("b_a", "b", "a", [])])
    with pytest.raises(GraphError, match="cycle"):
        walk_graph(g, cohort(spark, ["1"]), "a", include_upward=True)
    g = make_graph(spark, {"a": [("1", {})]}, [("a_a", "a", "a", [])])
    with pytest.raises(GraphError, match="itself"):
        walk_graph(g, cohort(spark, ["1"]), "a")
    g = make_graph(spark, M1_NODES, M1_LINKS)
    with pytest.raises(GraphError, match="unknown"):
        walk_graph(g, cohort(spark, ["S1"]), "nope")
    with pytest.raises(GraphError, match="unknown"):
        walk_graph(g, cohort(spark, ["S1"]), "subject", extra=["nope"], include_upward=True)
    g = make_graph(spark, {"a": [], "b": []}, [("a_c", "a", "c", [])])
    with pytest.raises(GraphError, match="unknown type"):
        walk_graph(g, cohort(spark, ["1"]), "a")


def test_m8_dangling_duplicate_and_empty_cohorts(spark):
    nodes = copy.deepcopy(M1_NODES)
    links = copy.deepcopy(M1_LINKS)
    # S9 has no node row but has a sample and a parent
    links[2][3].append(("X9", "S9"))
    links[1][3].append(("S9", "J3"))
    nodes["sample"].append(("X9", {}))
    g = make_graph(spark, nodes, links)
    recs = records_of(export_records(g, cohort(spark, ["S9", "S1", "S1"]), "subject",
                                     include_upward=True))
    names = [(r[1], r[2]) for r in recs]
    assert ("subject", "S9") not in names  # dangling: drives the walk, emits nothing
    assert ("sample", "X9") in names and ("project", "J3") in names
    assert len(names) == len(set(names))
    empty = export_records(g, cohort(spark, []), "subject", include_upward=True)
    assert empty.count() == 0


def test_null_cohort_id_fails(spark):
    g = make_graph(spark, M1_NODES, M1_LINKS)
    c = spark.createDataFrame([("S1",), (None,)], "id string")
    with pytest.raises(Exception, match="null id"):
        export_records(g, c, "subject", include_upward=True, materialize="persist").collect()


def test_parent_rank_before_child(spark):
    nodes = copy.deepcopy(M1_NODES)
    nodes["sample"] += [("X5", {})]
    links = M1_LINKS + [("sample_project", "sample", "project", [("X5", "J1")])]
    g = make_graph(spark, nodes, links)
    recs = records_of(export_records(g, cohort(spark, ["S1"]), "subject",
                                     extra=["project"], include_upward=True))
    rank = {(r[1], r[2]): r[0] for r in recs}
    for r in recs:
        for dst_id, dst_name in r[3]:
            assert rank[(dst_name, dst_id)] < r[0]


# -- property: the walk equals a brute-force closure on random small DAGs -----

@st.composite
def small_graphs(draw):
    n = draw(st.integers(3, 5))
    labels = [f"t{i}" for i in range(n)]
    # child index > parent index keeps the type graph acyclic
    pairs = [(c, p) for c in range(n) for p in range(c) if draw(st.booleans())]
    if not pairs:
        pairs = [(1, 0)]
    ids = {lbl: [str(k) for k in range(draw(st.integers(1, 4)))] for lbl in labels}
    links = []
    for c, p in pairs:
        rows = sorted({(s, t) for s in ids[labels[c]] for t in ids[labels[p]]
                       if draw(st.integers(0, 2)) == 0})
        links.append((f"{labels[c]}_{labels[p]}", labels[c], labels[p], rows))
    root = labels[draw(st.integers(0, n - 1))]
    coh = draw(st.lists(st.sampled_from(ids[root] + ["99"]), max_size=3))
    extra = draw(st.lists(st.sampled_from(labels), max_size=2))
    up = draw(st.booleans())
    # node rows: drop one id per label sometimes (dangling ids)
    nodes = {lbl: [(i, {}) for i in ids[lbl][draw(st.integers(0, 1)):]] for lbl in labels}
    return nodes, links, root, coh, extra, up


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(case=small_graphs())
def test_walk_matches_brute_force(spark, case):
    nodes, links, root, coh, extra, up = case
    g = make_graph(spark, nodes, links)
    got = records_of(walk_records(walk_graph(g, cohort(spark, coh), root, extra, up,
                                             materialize="persist")))
    node_ids = {lbl: {i for i, _ in rows} for lbl, rows in nodes.items()}
    edges = {t: rows for t, _, _, rows in links}
    want = brute_walk(g.dictionary, node_ids, edges, root, coh, extra, up)
    assert got == want


def test_hot_parent_walks_whole_group(spark):
    # one project holds most subjects; every one of its samples must be exported
    n = 3000
    nodes = {
        "program": [("P1", {})],
        "project": [("J1", {}), ("J2", {})],
        "subject": [(f"S{i}", {}) for i in range(n)],
        "sample": [(f"X{i}", {}) for i in range(n)],
    }
    links = [
        ("project_program", "project", "program", [("J1", "P1"), ("J2", "P1")]),
        ("subject_project", "subject", "project",
         [(f"S{i}", "J1" if i % 10 else "J2") for i in range(n)]),
        ("sample_subject", "sample", "subject", [(f"X{i}", f"S{i}") for i in range(n)]),
    ]
    g = make_graph(spark, nodes, links)
    # cohort: all subjects of the hot project; walk up and back down through extras
    hot = [f"S{i}" for i in range(n) if i % 10]
    recs = export_records(g, cohort(spark, hot), "subject", extra=["project"],
                          include_upward=True)
    counts = {r["name"]: r["n"] for r in recs.groupBy("name").count()
              .withColumnRenamed("count", "n").collect()}
    assert counts == {"program": 1, "project": 2, "subject": len(hot), "sample": len(hot)}
    plan = walk_graph(g, cohort(spark, hot), "subject", include_upward=True,
                      materialize="persist").states["project"]
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in text  # parent seeds deduplicated before the semi join


def test_cleanup_removes_written_states(spark):
    import os

    g = make_graph(spark, M1_NODES, M1_LINKS)
    w = walk_graph(g, cohort(spark, ["S1"]), "subject", include_upward=True)
    assert records_of(walk_records(w))
    folder = w.folder
    local = folder.replace("file:", "")
    assert os.path.isdir(local)
    w.cleanup()
    assert not os.path.exists(local)


def test_write_errors_surface_from_the_walk(spark):
    # the null id fails the root state's write, which runs on a writer thread
    g = make_graph(spark, M1_NODES, M1_LINKS)
    c = spark.createDataFrame([("S1",), (None,)], "id string")
    with pytest.raises(Exception, match="null id"):
        walk_graph(g, c, "subject", include_upward=True)
