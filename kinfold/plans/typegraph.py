"""Type-graph operators as DataFrames.

The driver-side planner in :mod:`kinfold.plans.topology` works on the
dictionary.  The functions here compute the same answers with Spark over an
``edge_types`` DataFrame ``(edge_table, src_label, dst_label)``, for instance
the edge types that are actually *populated* in the data, so users can query
the type graph like any table.  All levels come from one job over the distinct links; their
number is bounded by the number of labels, and a cycle fails.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.model import Graph, GraphError
from kinfold.plans.topology import DOWN, UP


def populated_edge_types(graph: Graph) -> DataFrame:
    """Edge types with at least one edge row, and their edge counts (G1 over data).

    One scan per child table over its key columns only; the partial counts are
    combined map-side, so the shuffle is one row per task.
    """
    d = graph.dictionary
    counts = reduce(DataFrame.unionByName, (graph.count_edges(c) for c in sorted({e.src_label for e in d.edge_types})))
    known = reduce(Column.__or__, (F.col("edge_table") == e.edge_table for e in d.edge_types))
    labels = {k: F.create_map(*(F.lit(x) for e in d.edge_types for x in (e.edge_table, getattr(e, k)))) for k in ("src_label", "dst_label")}
    return counts.where(known & (F.col("n_edges") > 0)).select(
        "edge_table", *(m[F.col("edge_table")].alias(k) for k, m in labels.items()), "n_edges")


def edges_by_type(edge_types: DataFrame) -> DataFrame:
    """Per child label, its edge tables in name order."""
    return (edge_types.groupBy(F.col("src_label").alias("label"))
            .agg(F.array_join(F.sort_array(F.collect_list("edge_table")), ",")
                 .alias("edge_tables")))


def ambiguous_edges(edge_types: DataFrame) -> DataFrame:
    """Label pairs served by more than one edge table (G3 check)."""
    return (edge_types.groupBy("src_label", "dst_label")
            .agg(F.count(F.lit(1)).alias("n_tables"),
                 F.array_join(F.sort_array(F.collect_list("edge_table")), ",")
                 .alias("edge_tables"))
            .where(F.col("n_tables") > 1))


def _levels(edge_types: DataFrame, root: str, ways: list[str], n_labels: int, longest: bool) -> dict[str, dict[str, int]]:
    """Per direction, the depth of every label that the root reaches, in one job.

    The distinct links are one bounded array (the type graph is metadata).  A fold over the possible levels
    takes each level's labels to their neighbours as a set: a label that is reached again moves down (longest) or is
    left out (breadth-first).  No path is enumerated and nothing returns to the driver between the levels.
    """
    names = "array<string>"

    def step(state: Column, label: Column, to: Column, links: Column) -> Column:
        here = F.element_at(state, -1)
        reached = F.array_distinct(F.transform(F.filter(links, lambda e: F.array_contains(here, label(e))), to))
        new = reached if longest else F.array_except(reached, F.flatten(state))
        return F.when(F.size(here) > 0, F.concat(state, F.array(F.array_sort(new)))).otherwise(state)

    def fold(way: str) -> Column:
        frm, to = ("src_label", "dst_label") if way == UP else ("dst_label", "src_label")
        start = F.array(F.array(F.lit(root))).cast(f"array<{names}>")
        return F.aggregate(F.sequence(F.lit(1), F.lit(n_labels + 1)), start, lambda state, _: step(
            state, lambda e: e[frm], lambda e: e[to], F.col("links")))

    links = edge_types.agg(F.collect_set(F.struct("src_label", "dst_label")).alias("links"))
    row = links.select(*(fold(way).alias(way) for way in ways)).first()
    out = {}
    for way in ways:
        if row[way][-1]:
            raise GraphError(f"type graph has a cycle through {row[way][-1]}")
        out[way] = {label: depth for depth, level in enumerate(row[way]) for label in level}
    return out


def _frame(edge_types: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return edge_types.sparkSession.createDataFrame(rows, schema)


def type_depths(edge_types: DataFrame, root: str, direction: str,
                n_labels: int) -> DataFrame:
    """Longest-path depth ``(label, depth)`` of labels reachable from ``root``.

    A level still alive after ``n_labels`` steps can only come from a cycle and fails.
    """
    depths = _levels(edge_types, root, [direction], n_labels, True)[direction]
    return _frame(edge_types, sorted(depths.items()), "label string, depth int")


def type_bfs(edge_types: DataFrame, root: str, n_labels: int) -> DataFrame:
    """Breadth-first level ``(label, level)`` of descendant types."""
    return _frame(edge_types, sorted(_levels(edge_types, root, [DOWN], n_labels, False)[DOWN].items()), "label string, level int")


def type_topology(edge_types: DataFrame, root: str, n_labels: int) -> DataFrame:
    """``(direction, label, depth, pos)``: both orders from ``root``, ties by label."""
    depths = _levels(edge_types, root, [UP, DOWN], n_labels, True)
    rows = [(way, label, depth, pos) for way in (UP, DOWN)
            for pos, (depth, label) in enumerate(sorted((v, k) for k, v in depths[way].items()))]
    return _frame(edge_types, rows, "direction string, label string, depth int, pos int")


def traversal_plan_df(edge_types: DataFrame, root: str, extra: list[str] | None,
                      include_upward: bool, n_labels: int) -> DataFrame:
    """``(pos, way, label)`` of the walk (G9) computed from ``edge_types``.

    Positions are offsets, not a global window: up labels keep their upward
    position, extras follow the up block, the downward path (root dropped
    when walking up first) follows the extras.
    """
    spark = edge_types.sparkSession
    topo = type_topology(edge_types, root, n_labels)
    extra = list(extra or []) if include_upward else []
    ex = spark.createDataFrame([(i, lbl) for i, lbl in enumerate(extra)],
                               "pos int, label string")
    if include_upward:
        sql = """
        with up as (select pos, label from {topo} where direction = 'up'),
        n_up as (select count(*) n from up)
        select pos, 'up' way, label from up
        union all
        select (select n from n_up) + pos, 'down', label from {ex}
        union all
        select (select n from n_up) + {n_extra} + pos - 1, 'down', label from {topo}
        where direction = 'down' and pos > 0"""
    else:
        sql = "select pos, 'down' way, label from {topo} where direction = 'down'"
    out = spark.sql(sql, topo=topo, ex=ex, n_extra=len(extra))
    return out.select(F.col("pos").cast("int").alias("pos"), "way", "label")
