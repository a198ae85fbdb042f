"""Hand-written micro graphs (FIXTURES M1-M8) and a brute-force walk."""

from __future__ import annotations

import json
from collections import defaultdict

from kinfold.model import Dictionary, EdgeType, Graph, PropField
from kinfold.plans.topology import UP, record_ranks, traversal_plan


def make_graph(spark, nodes: dict[str, list], links: list[tuple[str, str, str, list]],
               props: list[PropField] | None = None) -> Graph:
    """nodes: label -> [(id, props dict)]; links: (edge_table, child, parent, [(src, dst)])."""
    d = Dictionary(node_tables={lbl: f"node_{lbl}" for lbl in nodes},
                   edge_types=[EdgeType(t, c, p) for t, c, p, _ in links],
                   props=props or [])
    node_rows = {lbl: [(str(i), json.dumps(p)) for i, p in rows] for lbl, rows in nodes.items()}
    edge_rows = {t: [(str(s), str(x)) for s, x in rows] for t, _, _, rows in links}

    def load_nodes(label):
        return spark.createDataFrame(node_rows[label], "node_id string, object string")

    def load_edges(table):
        return spark.createDataFrame(edge_rows[table], "src_id string, dst_id string")

    return Graph(spark, d, load_nodes, load_edges)


def records_of(df) -> list[tuple]:
    """(topo_rank, name, id, ((dst_id, dst_name), ...)) sorted, for comparisons."""
    out = []
    for r in df.collect():
        rel = tuple((x["dst_id"], x["dst_name"]) for x in r["relations"])
        out.append((r["topo_rank"], r["name"], r["id"], rel))
    return sorted(out)


def brute_walk(d: Dictionary, node_ids: dict[str, set], edges: dict[str, list],
               root: str, cohort: list[str], extra=None, include_upward=False):
    """Python closure of the walk semantics, frontiers keyed by label."""
    plan = traversal_plan(d, root, extra, include_upward)
    ranks = record_ranks(plan)
    ids: dict[str, set] = defaultdict(set)
    ids[root] |= set(cohort)
    rels: dict[tuple, set] = defaultdict(set)
    for step in plan:
        lbl = step.label
        if step.way == UP:
            cur = set(ids[lbl])
            for e in d.edges_by_child(lbl):
                for s, t in edges[e.edge_table]:
                    if s in cur:
                        rels[(lbl, s)].add((t, e.dst_label))
                        ids[e.dst_label].add(t)
        else:
            for e in d.edges_by_child(lbl):
                parents = set(ids[e.dst_label])
                if not parents:
                    continue
                for s, t in edges[e.edge_table]:
                    if t in parents:
                        ids[lbl].add(s)
                        rels[(lbl, s)].add((t, e.dst_label))
    out = []
    for lbl, sel in ids.items():
        for i in sel:
            if i in node_ids.get(lbl, set()):
                out.append((ranks[lbl], lbl, i, tuple(sorted(rels[(lbl, i)],
                                                             key=lambda x: (x[1], x[0])))))
    return sorted(out)


# -- M1: program <- project <- subject <- sample --------------------------------
M1_NODES = {
    "program": [("P1", {"name": "p1"}), ("P2", {"name": "p2"})],
    "project": [("J1", {"code": "j1"}), ("J2", {"code": "j2"}), ("J3", {"code": "j3"})],
    "subject": [("S1", {"age": 1}), ("S2", {"age": 2}), ("S3", {"age": 3})],
    "sample": [("X1", {}), ("X2", {}), ("X3", {}), ("X4", {})],
}
M1_LINKS = [
    ("project_program", "project", "program", [("J1", "P1"), ("J2", "P1"), ("J3", "P2")]),
    ("subject_project", "subject", "project", [("S1", "J1"), ("S2", "J1"), ("S3", "J2")]),
    ("sample_subject", "sample", "subject",
     [("X1", "S1"), ("X2", "S1"), ("X3", "S2"), ("X4", "S3")]),
]
