"""Entity records: each selected node nested with its relations.

``export_records`` returns one DataFrame

    topo_rank INT, name STRING, id STRING, object STRING(JSON),
    relations ARRAY<STRUCT<dst_id STRING, dst_name STRING>>

one row per (name, id) with a node row; ids that only drive the walk
(dangling cohort ids, parents without a node row) emit nothing.
``topo_rank`` orders parents before children.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.model import Graph
from kinfold.operators.traverse import Walk, sorted_relations, walk_graph

RECORD_COLUMNS = ("topo_rank", "name", "id", "object", "relations")


def label_records(walk: Walk, label: str) -> DataFrame:
    """Records of one label: node rows joined to the label's state (J3 + J4)."""
    state = walk.states[label].select(F.col("id").alias("node_id"), "relations")
    # join first, then serialize: only selected rows build their object
    joined = walk.graph.lookup_nodes(label, state)
    return joined.select(
        F.lit(walk.ranks[label]).cast("int").alias("topo_rank"),
        F.lit(label).alias("name"),
        F.col("node_id").alias("id"),
        walk.graph.node_object(label).alias("object"),
        sorted_relations(F.col("relations")).alias("relations"),
    )


def walk_records(walk: Walk) -> DataFrame:
    """Union of all labels' records in rank order."""
    labels = sorted(walk.states, key=lambda lbl: (walk.ranks[lbl], lbl))
    frames = [label_records(walk, lbl) for lbl in labels]
    if not frames:
        return walk.graph.spark.createDataFrame(
            [], "topo_rank int, name string, id string, object string, "
                "relations array<struct<dst_id:string,dst_name:string>>")
    return reduce(lambda a, b: a.unionByName(b), frames)


def export_records(graph: Graph, cohort: DataFrame, root: str,
                   extra: list[str] | None = None, include_upward: bool = True,
                   materialize: str = "parquet") -> DataFrame:
    """Flagship export: cohort -> walk -> nested records.

    The default includes the upward walk, as the export job does.
    """
    walk = walk_graph(graph, cohort, root, extra, include_upward, materialize)
    return walk_records(walk)


def relations_text(col: Column | str = "relations") -> Column:
    """``dst_name:dst_id`` pairs joined by commas, in (dst_name, dst_id) order."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat_ws(",", F.transform(
        c, lambda r: F.concat(r["dst_name"], F.lit(":"), r["dst_id"])))


def ordered_for_write(records: DataFrame) -> DataFrame:
    """Sort inside partitions only (O1).

    Order across types comes from the ``topo_rank`` folders of the sink; the
    records frame is a union of per-type joins, so each task holds one type
    and no shuffle or range-sampling pass is needed.
    """
    return records.sortWithinPartitions("topo_rank", "name", "id")
