"""Hard negatives against brute force; bounds that never cut off a score."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, slot string, score string, rank string, block string"


def brute(rows):
    """The contract, row by row, with Python's integers."""
    clean = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab in rows
             if None not in (i, v, lab) and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    out = []
    for a, la, va in sorted({(i, lab, tuple(v)) for i, lab, v in clean if i % 50 == 0}):
        own = [(-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(va, v)))), i, lab) for i, lab, v in clean if i != a and len(v) == len(va)]
        for s, p, _ in sorted(x for x in own if x[2] == la)[:5]:
            fit = sorted(x for x in own if x[2] != la and -50 * s <= -100 * x[0] <= -95 * s)
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fit[:3])]
    return sorted(out)


def table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, *"xxxxx") for r in rows], SCHEMA).repartition(parts)


def mined(spark, rows, parts=4, **kw):
    return sorted(tuple(r) for r in hn.mined(table(spark, rows, parts), F.col("vec_id") % 50 == 0, F.col("label"), **kw).collect())


def rows_of(seed, n=400, dim=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0.3, 1, (labels, dim))
    label = rng.integers(0, labels, n)
    vectors = 0.5 * centres[label] + rng.normal(0.1, 0.4, (n, dim)) + 0.5 * centres[rng.integers(0, labels, n)]
    return [(int(i), [float(np.float32(x)) for x in v], int(lab)) for i, (v, lab) in enumerate(zip(vectors, label))]


def test_against_brute_force(spark):
    rows = rows_of(1)
    want = brute(rows)
    assert len(want) > 50 and mined(spark, rows) == want
    assert mined(spark, rows, parts=1, block=3) == want  # several blocks of anchors


def test_odd_rows(spark):
    rows = rows_of(2, 250)
    nan, inf = float("nan"), float("inf")
    odd = [(None, [1.0] * 12, 1), (1000, None, 1), (1050, [1.0] * 12, None), (1100, [nan] * 12, 1), (1101, [None] * 12, 1), (1102, [inf] * 12, 0),
           (1150, [], 1), (1151, [], 1), (1152, [], 2), (1200, [1.0, 2.0], 1), (1201, [2.0, 2.0], 1), (1202, [1.0, 1.0], 3), (1250, [0.0] * 12, 1)]
    copies = [rows[0], rows[0], rows[7], rows[7], (rows[50][0], rows[60][1], 2)] + [(2000 + i, rows[3][1], 1 + i % 2) for i in range(80)]
    everything = rows + odd + copies
    assert mined(spark, everything) == brute(everything)
    assert mined(spark, odd) == brute(odd)
    assert mined(spark, []) == []


def test_wide_components_are_exact(spark):
    pick = random.Random(3)
    rows = [(i, [pick.uniform(-1, 1) * 10.0 ** pick.choice([0, 6, 7, 8, 20]) for _ in range(5)], i % 3) for i in range(160)]
    assert mined(spark, rows) == brute(rows)


@given(st.integers(0, 10**6), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_bounds_hold_and_get_tighter(seed, dim):
    rng = np.random.default_rng(seed)
    a, b = (hn.Vectors(np.arange(9), np.zeros(9, int), np.floor(rng.normal(50, 200, (9, dim)))) for _ in range(2))
    exact, before = a.scaled @ b.scaled.T, None
    for level in range(len(a.levels)):
        low, high = hn.bounds(a, b, level)
        assert (low <= exact).all() and (exact <= high).all()
        width = (high - low).sum()
        assert before is None or dim & (dim - 1) or width <= before * (1 + 1e-9)
        before = width


def test_segments_rule_pairs_out():
    rng = np.random.default_rng(5)
    level = rng.normal(0, 300, (400, 8)).repeat(8, axis=1)
    rows = hn.Vectors(np.arange(400), np.zeros(400, int), np.floor(level + rng.normal(0, 10, (400, 64))))
    anchors = rows.take(np.arange(0, 400, 50))
    least = np.sort(rows.scaled @ anchors.scaled.T, axis=0)[-5]
    at, to, pairs = hn.survivors(rows, anchors, np.ones((400, 8), bool), least, np.full(8, np.inf))
    assert 5 * 8 <= pairs.sum() < 0.05 * 400 * 8 and len(at) < 100


@pytest.mark.parametrize("parts", [1, 6])
def test_no_anchor_or_no_positive(spark, parts):
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 1)], parts) == []
    assert mined(spark, [(50, [1.0], 1), (2, [1.0], 2)], parts) == []
