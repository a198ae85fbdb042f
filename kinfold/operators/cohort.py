"""Cohort selection over an index table.

The index holds one row per entity of the root type with ``_{node}_id`` and
``auth_resource_path``.  A filter document becomes a Spark ``Column``; the
"accessible" restriction is a left-semi join with the caller's grants.  The
whole cohort stays a DataFrame: no count-based switch, no row cap.

Filter documents (the index service's JSON form):

    {}                                   all rows
    {"=": {"field": value}}              equality
    {"!=": {...}}, {">": {...}}, {">=": {...}}, {"<": {...}}, {"<=": {...}}
    {"in": {"field": [v1, v2]}}
    {"AND": [doc, ...]}, {"OR": [doc, ...]}

Anything else raises ``ValueError``.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COMPARE = {
    "=": lambda c, v: c == F.lit(v),
    "!=": lambda c, v: c != F.lit(v),
    ">": lambda c, v: c > F.lit(v),
    ">=": lambda c, v: c >= F.lit(v),
    "<": lambda c, v: c < F.lit(v),
    "<=": lambda c, v: c <= F.lit(v),
}


def filter_column(doc: dict[str, Any] | str | None) -> Column:
    """Filter document -> boolean Column."""
    if isinstance(doc, str):
        doc = json.loads(doc)
    if not doc:
        return F.lit(True)
    if "filter" in doc and len(doc) == 1:
        return filter_column(doc["filter"])
    if len(doc) != 1:
        raise ValueError(f"a filter node holds exactly one operator: {doc!r}")
    (op, arg), = doc.items()
    key = op.upper() if op.upper() in ("AND", "OR") else op.lower()
    if key in ("AND", "OR"):
        if not isinstance(arg, list) or not arg:
            raise ValueError(f"{op} needs a non-empty list")
        parts = [filter_column(a) for a in arg]
        return reduce((lambda a, b: a & b) if key == "AND" else (lambda a, b: a | b), parts)
    if not isinstance(arg, dict) or len(arg) != 1:
        raise ValueError(f"{op} needs one {{field: value}} pair: {arg!r}")
    (fld, value), = arg.items()
    if key == "in":
        if not isinstance(value, list):
            raise ValueError("in needs a list of values")
        return F.col(fld).isin(*value)
    if key in _COMPARE:
        return _COMPARE[key](F.col(fld), value)
    raise ValueError(f"unsupported filter operator {op!r}")


def accessible(index: DataFrame, grants: DataFrame | None) -> DataFrame:
    """Rows whose ``auth_resource_path`` is granted (P9); ``None`` = no restriction."""
    if grants is None:
        return index
    g = grants.select("auth_resource_path")
    return index.join(g, "auth_resource_path", "left_semi")


def cohort_rows(index: DataFrame, doc: dict | str | None = None,
                grants: DataFrame | None = None) -> DataFrame:
    return accessible(index.where(filter_column(doc)), grants)


def select_cohort(index: DataFrame, node: str, doc: dict | str | None = None,
                  grants: DataFrame | None = None) -> DataFrame:
    """Cohort ids ``(id STRING)`` of type ``node``."""
    col = f"_{node}_id"
    if col not in index.columns:
        raise ValueError(f"index has no column {col!r}")
    return (cohort_rows(index, doc, grants)
            .select(F.col(col).cast("string").alias("id")))


def cohort_count(index: DataFrame, doc: dict | str | None = None,
                 grants: DataFrame | None = None) -> DataFrame:
    """One row ``total_count`` (A5)."""
    return cohort_rows(index, doc, grants).agg(F.count(F.lit(1)).alias("total_count"))


def cohort_authz(index: DataFrame, doc: dict | str | None = None,
                 grants: DataFrame | None = None) -> DataFrame:
    """Distinct authorization paths of the cohort, no cap."""
    return (cohort_rows(index, doc, grants)
            .select("auth_resource_path").where(F.col("auth_resource_path").isNotNull())
            .distinct())
