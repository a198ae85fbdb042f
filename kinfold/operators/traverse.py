"""Graph walk: up to ancestors, through extra types, down to descendants.

Every visit is a set of left-semi joins between an edge table and the
frontier of the label on the other side (J1/J2); the frontier of a label is
the key set of its *state* DataFrame ``(id, relations)``, built by a single
``groupBy(id)`` over the cohort/parent seeds and the relation rows found so
far.

States are reused by several children and by the record assembly, and a
walk over tens of types would otherwise grow one huge plan (each state
embeds the lineage of all states above it).  So each sealed state is
*materialized*: by default written as Parquet into a fresh folder under the
session's shared ``spark.checkpoint.dir`` and read back.  That cuts the
lineage, survives executor loss, and hands the optimizer real file sizes, so
a frontier is broadcast only when its measured size is under the broadcast
threshold; otherwise both sides are shuffled on the id and AQE splits skewed
parents.  ``materialize="checkpoint"`` uses ``Dataset.checkpoint`` in the same
folder; ``"persist"`` keeps everything lazy and cached (small graphs, tests).
No frontier, id list or relation map is ever collected on the driver.

Semantics:

* up visit of L: for every edge type with child L, the edges whose child is
  selected give L its relations and add their parents to the parents' seeds;
* down visit of L: for every edge type with child L whose parent label
  already has a frontier, the edges whose parent is selected add their
  children to L and give them relations to those selected parents only
  (OR over edge types, parents reached upward or as extras included);
* a label visited twice keeps the union of ids and relations.
"""

from __future__ import annotations

from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.model import Graph, GraphError
from kinfold.operators.frontier import PRUNE_BYTES, KeyRanges, key_ranges, worth_pruning
from kinfold.plans.topology import UP, Step, record_ranks, traversal_plan
from kinfold.session import scratch_dir

REL_TYPE = "struct<dst_name:string,dst_id:string>"
MATERIALIZE_MODES = ("parquet", "checkpoint", "persist")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def relation_struct(dst_name: Column, dst_id: Column) -> Column:
    # sort key first: struct order is (dst_name, dst_id) until the record is shaped
    return F.struct(dst_name.alias("dst_name"), dst_id.alias("dst_id"))


def sorted_relations(col: Column) -> Column:
    """array<struct<dst_name,dst_id>> -> sorted array<struct<dst_id,dst_name>>."""
    return F.transform(F.sort_array(col),
                       lambda r: F.struct(r["dst_id"].alias("dst_id"),
                                          r["dst_name"].alias("dst_name")))


def checked_ids(ids: DataFrame, column: str = "id") -> DataFrame:
    """Cast ids to string and fail the job on a null id (fix of silent loss).

    A one-column frame may name its column freely.
    """
    if column not in ids.columns:
        if len(ids.columns) != 1:
            raise GraphError(f"cohort needs an {column!r} column, got {ids.columns}")
        column = ids.columns[0]
    c = F.col(column).cast("string")
    return ids.select(
        F.when(c.isNull(), F.raise_error(F.lit("null id in cohort"))).otherwise(c).alias("id"))


class Materializer:
    """Cuts lineage of intermediate frames (see module doc).

    In parquet mode writes may run on a small thread pool: a write is a
    Spark job, so independent states (siblings in the plan) are written at
    the same time and a visit waits only for the states it reads.
    """

    def __init__(self, spark, mode: str = "parquet",
                 storage: StorageLevel = StorageLevel.MEMORY_AND_DISK,
                 concurrent_writes: int = 4):
        if mode not in MATERIALIZE_MODES:
            raise ValueError(f"materialize must be one of {MATERIALIZE_MODES}")
        self.spark = spark
        self.mode = mode
        self.storage = storage
        self.folder = scratch_dir(spark, "walk") if mode == "parquet" else None
        self.held: list[DataFrame] = []
        self.n = 0
        self.pool = (ThreadPoolExecutor(max_workers=concurrent_writes)
                     if mode == "parquet" and concurrent_writes > 1 else None)
        self.futures: list[Future] = []

    def _write_read(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("errorifexists").parquet(path)
        # known schema: no inference job on read-back
        return self.spark.read.schema(df.schema).parquet(path)

    def submit(self, df: DataFrame, name: str) -> DataFrame | Future:
        """Materialize; in parquet mode with a pool, return a future of the frame."""
        self.n += 1
        if self.mode == "parquet":
            path = f"{self.folder}/{self.n:03d}-{name}"
            if self.pool is not None:
                # carry the caller's job group / pool into the writing thread
                target = inheritable_thread_target(self.spark)(self._write_read)
                fut = self.pool.submit(target, df, path)
                self.futures.append(fut)
                return fut
            return self._write_read(df, path)
        if self.mode == "checkpoint":
            return df.checkpoint(eager=True)
        df = df.persist(self.storage)
        self.held.append(df)
        return df

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        out = self.submit(df, name)
        return out.result() if isinstance(out, Future) else out

    def release(self) -> None:
        for df in self.held:
            df.unpersist()
        self.held.clear()

    def close(self) -> None:
        """Wait for every write, including superseded ones, and surface errors."""
        if self.pool is not None:
            self.pool.shutdown(wait=True)
            self.pool = None
        for fut in self.futures:
            fut.result()
        self.futures.clear()


@dataclass
class Walk:
    """Result of a walk: one materialized state per reached label."""

    graph: Graph
    plan: list[Step]
    ranks: dict[str, int]
    materializer: Materializer
    states: dict[str, DataFrame] = field(default_factory=dict)

    def frontier(self, label: str) -> DataFrame:
        """Distinct selected ids of ``label`` (dangling ids included)."""
        if label not in self.states:
            return self.graph.spark.createDataFrame([], "id string")
        return self.states[label].select("id")

    def state(self, label: str) -> DataFrame:
        if label not in self.states:
            return self.graph.spark.createDataFrame(
                [], f"id string, relations array<{REL_TYPE}>")
        return self.states[label]

    def relation_rows(self, label: str) -> DataFrame:
        """Flat ``(name, id, dst_name, dst_id)`` relations of ``label``."""
        st = self.state(label)
        return (st.select("id", F.explode("relations").alias("r"))
                  .select(F.lit(label).alias("name"), "id",
                          F.col("r.dst_name").alias("dst_name"),
                          F.col("r.dst_id").alias("dst_id")))

    @property
    def folder(self) -> str | None:
        """Scratch folder of the written states (parquet mode)."""
        return self.materializer.folder

    def release(self) -> None:
        """Drop cached frames (persist mode); written states stay readable."""
        self.materializer.release()

    def cleanup(self) -> None:
        """Delete the written states (parquet mode) once results are consumed."""
        self.materializer.release()
        folder = self.materializer.folder
        if folder:
            jvm = self.graph.spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.graph.spark._jsc.hadoopConfiguration()).delete(path, True)


class _Walker:
    def __init__(self, graph: Graph, plan: list[Step], cohort: DataFrame,
                 root: str, materializer: Materializer, prune_bytes: int | None = None):
        self.g = graph
        self.d = graph.dictionary
        self.m = materializer
        self.seeds: dict[str, list[DataFrame]] = {root: [cohort]}
        self.rels: dict[str, list[DataFrame]] = {}
        self.prune_bytes = prune_bytes
        self.ranges: dict[int, tuple[DataFrame, KeyRanges | None]] = {}  # by frame, which is held so that its id stays its own
        self.walk = Walk(graph, plan, record_ranks(plan), materializer)

    def _seal(self, label: str) -> None:
        parts = [s.select("id", F.lit(None).cast(REL_TYPE).alias("rel"))
                 for s in self.seeds.get(label, [])]
        parts += self.rels.get(label, [])
        if not parts:
            return
        before = self._state(label)
        if before is not None:  # a second visit adds to what the first one wrote
            parts.append(before.select("id", F.explode_outer("relations").alias("rel")))
        # map-side partial aggregation: one row per id and task reaches the shuffle
        state = (_union(parts).groupBy("id")
                 .agg(F.collect_set("rel").alias("relations")))
        # every state is written: later joins see its measured size
        self.walk.states[label] = self.m.submit(state, f"state-{label}")
        self.seeds.pop(label, None)
        self.rels[label] = []

    def _state(self, label: str) -> DataFrame | None:
        """A label's state, waiting for its write if one is running."""
        st = self.walk.states.get(label)
        if isinstance(st, Future):
            st = st.result()
            self.walk.states[label] = st
        return st

    def _hits(self, edge_table: str, side: str, ids: DataFrame) -> DataFrame:
        """Edges of the frontier ``ids``; a large edge table is read only where the frontier's key ranges lie."""
        if self.g.edge_filter is not None or not worth_pruning(self.g.edges(edge_table), self.prune_bytes):
            return self.g.semi_edges(edge_table, side, ids)
        if id(ids) not in self.ranges:
            self.ranges[id(ids)] = (ids, key_ranges(ids))
        return self.g.semi_edges(edge_table, side, ids, self.ranges[id(ids)][1])

    def _visit_up(self, label: str) -> None:
        seeds = self.seeds.get(label)
        if not seeds:
            return
        # seeds repeat a parent once per selected child (a hot parent may hold
        # a third of all rows): dedupe with a map-side partial aggregate before
        # they become the build side of a semi join
        ids = _union(seeds).select("id").distinct()
        parents = []
        for e in self.d.edges_by_child(label):
            hits = self._hits(e.edge_table, "src", ids)
            self.rels.setdefault(label, []).append(hits.select(
                F.col("src_id").alias("id"),
                relation_struct(F.lit(e.dst_label), F.col("dst_id")).alias("rel")))
            parents.append(e.dst_label)
        self._seal(label)
        # parents' seeds come back from the written state: edges are read once
        state = self._state(label)
        for p in sorted(set(parents)):
            self.seeds.setdefault(p, []).append(
                state.select(F.explode("relations").alias("r"))
                     .where(F.col("r.dst_name") == p)
                     .select(F.col("r.dst_id").alias("id")))

    def _visit_down(self, label: str) -> None:
        found = False
        for e in self.d.edges_by_child(label):
            parent_state = self._state(e.dst_label)
            if parent_state is None:  # parent not selected (yet): nothing to follow
                continue
            hits = self._hits(e.edge_table, "dst", parent_state)
            self.rels.setdefault(label, []).append(hits.select(
                F.col("src_id").alias("id"),
                relation_struct(F.lit(e.dst_label), F.col("dst_id")).alias("rel")))
            found = True
        if found or self.seeds.get(label) or label in self.walk.states:
            self._seal(label)

    def run(self) -> Walk:
        try:
            for step in self.walk.plan:
                if step.way == UP:
                    self._visit_up(step.label)
                else:
                    self._visit_down(step.label)
            for label in list(self.walk.states):
                self._state(label)
        finally:
            self.m.close()
        return self.walk


def walk_graph(graph: Graph, cohort: DataFrame, root: str,
               extra: list[str] | None = None, include_upward: bool = False,
               materialize: str = "parquet",
               storage: StorageLevel = StorageLevel.MEMORY_AND_DISK,
               concurrent_writes: int = 4, prune_bytes: int | None = PRUNE_BYTES) -> Walk:
    """Walk the graph from a cohort of ``root`` ids.

    ``cohort`` is a DataFrame with an ``id`` column (any type; cast to string,
    a null id fails the job).  Each visit runs when its label is sealed
    (``materialize`` "parquet"/"checkpoint"); with "persist" nothing runs
    until the caller's action.  ``concurrent_writes`` independent state
    writes may run at once (parquet mode).  Edge tables that the optimizer
    knows to hold ``prune_bytes`` or more are read within the frontier's key
    ranges only (None: never).
    """
    graph.dictionary.validate()
    graph.check_labels([root] + list(extra or []))
    plan = traversal_plan(graph.dictionary, root, extra, include_upward)
    if not plan or plan[0].label != root:
        raise GraphError("plan does not start at the root")
    m = Materializer(graph.spark, materialize, storage, concurrent_writes)
    ids = checked_ids(cohort)
    if materialize == "parquet":
        ids = m(ids, "cohort")  # evaluated once: a changing index cannot split the walk
    return _Walker(graph, plan, ids, root, m, prune_bytes if materialize != "persist" else None).run()
