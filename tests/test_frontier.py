"""Key ranges of an id set: brute-force bounds, rows read by the scan, unchanged results."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kinfold.model import Dictionary, EdgeType, Graph
from kinfold.operators.frontier import in_ranges, key_ranges, known_bytes, pruned, worth_pruning
from kinfold.operators.records import walk_records
from kinfold.operators.traverse import walk_graph
from kinfold.sources.jdbc import keyed_scan
from micro import M1_LINKS, M1_NODES, make_graph, records_of

N = 60_000


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """Parents D0, D1, ... and edges (child, parent) stored in the order of the parents, in many small row groups."""
    path = str(tmp_path_factory.mktemp("edges"))
    edges = spark.range(N).select(F.format_string("C%06d", F.col("id") * 7919 % N).alias("src_id"),
                                  F.format_string("D%05d", F.floor(F.col("id") / 4)).alias("dst_id"))
    edges.coalesce(1).sortWithinPartitions("dst_id").write.option("parquet.block.size", 1 << 16).option("parquet.page.size", 1 << 12).parquet(f"{path}/of")
    spark.createDataFrame([(f"D{i:05d}", "{}") for i in range(0, N // 4, 50)], "node_id string, object string").write.parquet(f"{path}/dad")
    edges.select(F.col("src_id").alias("node_id"), F.lit("{}").alias("object")).write.parquet(f"{path}/kid")
    return path


def scanned_rows(spark, df, wanted):
    """(result rows, rows that the scans whose description holds ``wanted`` gave)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    found = [leaves.apply(i) for i in range(leaves.size())]
    return rows, sum(p.metrics().apply("numOutputRows").value() for p in found if wanted in p.toString())


def test_ranges_are_disjoint_ordered_and_hold_every_id(spark):
    values = [f"D{i * i % 9973:05d}" for i in range(2000)]
    ids = spark.createDataFrame([(v,) for v in [*values, *values[:500], None]], "id string")
    ranges = key_ranges(ids, count=8)
    assert 1 < len(ranges) <= 8
    assert all(a <= b for a, b in ranges) and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:], strict=False))
    assert all(any(a <= v <= b for a, b in ranges) for v in values)
    assert {x for r in ranges for x in r} <= set(values)  # the bounds are ids themselves


@pytest.mark.parametrize(("kind", "values"), [
    ("string", ["", "a", "é", "日本", "a b"]), ("long", [-5, 0, 2**60]), ("date", [dt.date(1990, 1, 2), dt.date(2020, 5, 1)]),
    ("decimal(20,2)", [Decimal("1.10"), Decimal("-7.00")])])
def test_every_ordered_type_keeps_its_ids(spark, kind, values):
    ids = spark.createDataFrame([(v,) for v in values], f"id {kind}")
    assert sorted(r[0] for r in pruned(ids, "id", key_ranges(ids, count=3)).collect()) == sorted(values)


def test_the_widest_gaps_lie_between_the_ranges(spark):
    places = [100, 700, 701, 90_000, 90_001, 500_000]
    wanted = [(100, 100), (700, 701), (90_000, 90_001), (500_000, 500_000)]
    numbers = spark.createDataFrame([(p + i,) for p in places for i in range(50)], "id long")
    assert key_ranges(numbers, count=4) == [(a, b + 49) for a, b in wanted]
    texts = numbers.select(F.format_string("id-%06d", "id").alias("id"))
    assert key_ranges(texts, count=4) == [("id-%06d" % a, "id-%06d" % (b + 49)) for a, b in wanted]


def test_empty_null_and_unordered_ids(spark):
    assert key_ranges(spark.createDataFrame([], "id string")) == []
    nulls = spark.createDataFrame([(None,), (None,)], "id string")
    assert key_ranges(nulls) == []
    assert pruned(spark.createDataFrame([("a",)], "id string"), "id", []).count() == 0
    floats = spark.createDataFrame([(float("nan"),), (1.0,)], "id double")
    assert key_ranges(floats) is None
    assert pruned(floats, "id", None) is floats


def test_edge_scan_reads_only_the_row_groups_of_the_frontier(spark, clustered):
    edges = spark.read.parquet(f"{clustered}/of")
    chosen = [f"D{i:05d}" for i in [*range(100, 140), *range(9000, 9030)]]  # two places far apart
    ids = spark.createDataFrame([(c,) for c in [*chosen, *chosen, None]], "id string")
    plain, all_rows = scanned_rows(spark, keyed_scan(edges, ids, "dst_id"), "dst_id")
    near, few_rows = scanned_rows(spark, keyed_scan(edges, ids, "dst_id", ranges=8), "dst_id")
    assert sorted(plain) == sorted(near) and len(near) == 4 * len(chosen)
    assert all_rows == N
    assert few_rows < N / 5


def test_ranges_reach_the_scan(spark, clustered):
    edges = spark.read.parquet(f"{clustered}/of")
    df = edges.where(in_ranges("dst_id", edges.schema["dst_id"].dataType, [("D00001", "D00009"), ("D00100", "D00110")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(dst_id,D00001)" in plan


def test_walk_within_ranges_equals_the_plain_walk(spark, clustered):
    d = Dictionary(node_tables={"dad": "dad", "kid": "kid"}, edge_types=[EdgeType("of", "kid", "dad")])
    g = Graph(spark, d, lambda label: spark.read.parquet(f"{clustered}/{label}"), lambda table: spark.read.parquet(f"{clustered}/{table}"))
    for root, start, up in (("dad", ["D00100", "D00150", "D09000", "gone"], False), ("kid", ["C000007", "C000100"], True)):
        ids = spark.createDataFrame([(i,) for i in start], "id string")
        near = walk_graph(g, ids, root, include_upward=up, prune_bytes=0)
        plain = walk_graph(g, ids, root, include_upward=up, prune_bytes=None)
        got, want = (sorted((r["id"], str(sorted(r["relations"]))) for label in ("dad", "kid") for r in w.state(label).collect()) for w in (near, plain))
        assert got == want and len(got) > len(start) - 1
        near.cleanup()
        plain.cleanup()


def test_walk_of_micro_graph_within_ranges(spark):
    g = make_graph(spark, M1_NODES, M1_LINKS)
    for start in (["S1"], ["S1", "S2"], ["none"], []):
        ids = spark.createDataFrame([(i,) for i in start], "id string")
        near, plain = (records_of(walk_records(walk_graph(g, ids, "subject", include_upward=True, prune_bytes=b))) for b in (0, None))
        assert near == plain


def test_only_tables_of_known_large_size_are_worth_a_job(spark, clustered):
    edges = spark.read.parquet(f"{clustered}/of")
    assert 0 < known_bytes(edges) < 1 << 30
    assert worth_pruning(edges, 1) and not worth_pruning(edges) and not worth_pruning(edges, None)
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([("a", "b")]), "src_id string, dst_id string")
    assert known_bytes(unknown) is None and not worth_pruning(unknown, 0)
