"""Runtime pruning of key scans (S1): the key ranges of an id set reach the source.

A semi join filters rows after they are read.  When the table is stored in key order, or nearly (one
project's rows loaded together), most of its files and row groups hold no selected key.  Here the id
set is described by at most RANGES ranges, and the table gets them as a literal predicate.  Parquet skips
row groups and pages by it, a JDBC source gets it as its WHERE clause.  The semi join that follows
stays, so results do not depend on it.

The ranges are found from cells: equal shares of a numeric span, or text prefixes as long as there are at most
CELLS of them.  Each cell gives its smallest and largest id.  The driver gets these (about CELLS rows
at most, whatever the ids) and keeps the widest gaps between cells as the gaps between ranges.  All steps are aggregates
combined before the shuffle; the ids themselves are not moved.  As they scan the ids, the walk asks for ranges only where the
optimizer knows the table's size and it is at least PRUNE_BYTES.

Null ids are in no range; repeated ids count once; an empty id set has no range and selects no row; keys of types
without a pushed order (floating point, collated strings, ...) have no ranges (None) and are not pruned.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType

RANGES = 32
CELLS = 4096
PRUNE_BYTES = 1 << 30
#: From here on an estimate means "unknown": Spark's default size is the largest long, projections take a share of it.
_UNKNOWN_BYTES = 1 << 55

KeyRanges = Sequence[tuple]


def _ordered(kind: DataType) -> bool:
    return kind == StringType() or isinstance(kind, ByteType | ShortType | IntegerType | LongType | DateType | DecimalType)


def _cells(keys: DataFrame, low, high) -> Column:
    """An expression of ``key`` that rises with it and has at most about CELLS values between low and high."""
    key = F.col("key")
    if not isinstance(low, str):
        days = isinstance(low, date)
        place = F.date_diff(key, F.lit(low)).cast("double") if days else key.cast("double") - float(low)
        return F.floor(place * (CELLS / float((high - low).days if days else high - low)))
    same = len(os.path.commonprefix([low.encode(), high.encode()]))
    prefixes = [F.substring(key.cast("binary"), 1, same + n) for n in range(1, 13)]
    sizes = keys.agg(*(F.approx_count_distinct(x) for x in prefixes)).first()
    return prefixes[max(i for i, n in enumerate(sizes) if n <= CELLS or not i)]


def _places(values: list) -> list[int]:
    """Numbers in the order of the values, as far apart as these are; a text's bytes count as digits among the bytes in use."""
    if not isinstance(values[0], str):
        return [v.toordinal() if isinstance(v, date) else v for v in values]
    raw = [v.encode() for v in values]
    same = len(os.path.commonprefix([min(raw), max(raw)]))
    tails = [r[same : same + 16] for r in raw]
    digit = {b: n + 1 for n, b in enumerate(sorted(set(b"".join(tails))))}
    return [sum(digit[b] * (len(digit) + 1) ** (15 - i) for i, b in enumerate(t)) for t in tails]


def key_ranges(ids: DataFrame, column: str = "id", count: int = RANGES) -> KeyRanges | None:
    """At most ``count`` disjoint ranges (low, high) that hold every id, in order; None for a type without ranges."""
    keys = ids.select(F.col(column).alias("key")).where("key IS NOT NULL")
    if not _ordered(keys.schema["key"].dataType):
        return None
    bounds = [F.min("key").alias("low"), F.max("key").alias("high")]
    low, high = keys.agg(*bounds).first()
    if low is None or low == high:
        return [] if low is None else [(low, high)]
    found = sorted((r["low"], r["high"]) for r in keys.groupBy(_cells(keys, low, high).alias("cell")).agg(*bounds).collect())
    lows, highs = zip(*found, strict=True)
    places = _places([*lows, *highs])
    gaps = {i: places[i + 1] - places[len(lows) + i] for i in range(len(lows) - 1)}
    cuts = sorted(heapq.nlargest(count - 1, gaps, gaps.__getitem__))
    return [(lows[a], highs[b]) for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(lows) - 1], strict=True)]


def in_ranges(key: str, kind: DataType, ranges: KeyRanges) -> Column:
    """Whether a key lies in one of the ranges; comparisons with literals, which sources take."""
    column = F.col(key)
    return reduce(Column.__or__, ((column >= F.lit(low).cast(kind)) & (column <= F.lit(high).cast(kind)) for low, high in ranges), F.lit(False))


def pruned(table: DataFrame, key: str, ranges: KeyRanges | None) -> DataFrame:
    """The rows of ``table`` in the ranges; the table itself where there are none to go by."""
    return table if ranges is None else table.where(in_ranges(key, table.schema[key].dataType, ranges))


def known_bytes(table: DataFrame) -> int | None:
    """The optimizer's estimate of what is read of a table, None where it has none."""
    estimate = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate if estimate < _UNKNOWN_BYTES else None


def worth_pruning(table: DataFrame, least: int | None = PRUNE_BYTES) -> bool:
    """Whether a table is large enough for a job over the ids; ``least`` None: never."""
    if least is None:
        return False
    size = known_bytes(table)
    return size is not None and size >= least
