"""Hard-negative mining by segment summaries.

For every anchor: its best rows of the same label are the positives, and for every positive the best rows of another
label whose score lies between 50 % and 95 % of the positive's.  A component x counts as floor(256 x); a score is the
integer inner product.

A vector is cut into segments.  With a segment's mean m and deviation d (the norm of what is left after the mean), the
segment's part of the inner product of a and b is  n m_a m_b +- d_a d_b  by Cauchy and Schwarz.  Summed over segments this
bounds the score from both sides.  Bounds are refined level by level (1, 2, 4, 8, ... segments): at each level, rows and
anchors without a pair that can still enter a result leave, and only what is left is scored exactly.  What a pair has to
reach is the anchor's worst kept score so far, so bounds get sharper as a task goes on.

Anchors are the stated query set.  They are dealt into blocks of at most BLOCK anchors and BLOCK_BYTES bytes by a hash; one
block at a time is sent to all tasks, each of which reads its share of the rows once, in slices, and gives at most a few
rows for each anchor.  Those are ranked by a window whose limit also works before the shuffle.  So a task holds one block
and one slice; the driver holds one block, and what is found is written block by block to the shared folder.

Rows with a null label, a null vector, or a null or non-finite component take no part, nor do rows without an id.  Vectors of different
lengths are never compared; empty vectors score 0.  A row with the anchor's own id is the anchor.  Anchors that repeat in full
count once; other repeated rows are rows of their own, and ties go to the smaller id.  Scores beyond 64 bits count as the nearest 64-bit
number.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.session import scratch_dir

from .common import bounded_batches, give_back, keep_only, written

POSITIVES, NEGATIVES = 5, 3
#: The window of a negative's score, in percent of the positive's.
LOW, HIGH = 50, 95
BLOCK, BLOCK_BYTES = 4096, 16 << 20
#: Pairs of one dense step of a task.
CELLS = 1 << 20
#: Pairs whose norms' product reaches this one's square are scored with Python's integers: below it, every partial sum is exact in a double.
WIDE = 2.0**26
FOUND = "anchor int, slot int, score long, vec_id long"
_INT64 = np.iinfo(np.int64)
_NONE = float("-inf")


class Vectors:
    """Rows of one length: ids and labels, scaled components, and summaries at every level of segments."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, scaled: np.ndarray):
        self.ids, self.labels, self.scaled = ids, labels, scaled
        self.norm = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        parts, length = 1, scaled.shape[1]
        while parts <= max(1, length // 4):
            starts = np.arange(parts) * length // parts
            n = np.diff([*starts, length])
            mean = np.add.reduceat(scaled, starts, axis=1) / n if length else np.zeros((len(ids), 1))
            rest = scaled - np.repeat(mean, n, axis=1)
            deviation = np.sqrt(np.add.reduceat(rest * rest, starts, axis=1)) if length else np.zeros((len(ids), 1))
            self.levels.append((mean * np.sqrt(n), deviation))
            parts *= 2

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, at: np.ndarray) -> Vectors:
        out = object.__new__(Vectors)
        out.ids, out.labels, out.scaled, out.norm = self.ids[at], self.labels[at], self.scaled[at], self.norm[at]
        out.levels = [(m[at], d[at]) for m, d in self.levels]
        return out


def bounds(rows: Vectors, anchors: Vectors, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) that a row's score with an anchor can be, from the summaries of 2**level segments."""
    (m, d), (am, ad) = rows.levels[level], anchors.levels[level]
    middle, spread = m @ am.T, d @ ad.T
    spread += 1e-9 * np.outer(rows.norm, anchors.norm) + 1e-6  # for what rounding may have lost
    return middle - spread, middle + spread


def scores(rows: Vectors, anchors: Vectors, pairs: np.ndarray) -> np.ndarray:
    """Exact scores of the pairs: doubles where the norms allow, else Python integers within 64 bits."""
    out = rows.scaled @ anchors.scaled.T
    wide = pairs & (np.outer(rows.norm, anchors.norm) >= WIDE * WIDE)
    if wide.any():
        out = out.astype(object)
        for i, j in zip(*np.nonzero(wide)):
            exact = sum(int(x) * int(y) for x, y in zip(rows.scaled[i].tolist(), anchors.scaled[j].tolist()))
            out[i, j] = max(int(_INT64.min), min(int(_INT64.max), exact))
    return out


def survivors(rows: Vectors, anchors: Vectors, wanted: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, anchors, pairs of these) that may score between least[anchor] and most[anchor]; wanted: pairs to look at."""
    at, to, pairs = np.arange(len(rows)), np.arange(len(anchors)), wanted
    for level in range(len(rows.levels)):
        if not pairs.any():
            break
        low, high = bounds(rows.take(at), anchors.take(to), level)
        pairs = pairs & (high >= least[to]) & (low <= most[to])
        keep, hold = pairs.any(axis=1), pairs.any(axis=0)
        at, to, pairs = at[keep], to[hold], pairs[np.ix_(keep, hold)]
    if not pairs.any():
        return at[:0], to[:0], pairs[:0, :0]
    return at, to, pairs


class Best:
    """The best `k` (score, id) of each of n lists, kept sorted: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k, self.rows = k, [[] for _ in range(n)]
        self.worst = np.full(n, _NONE)  # of full lists: what a score must reach

    def offer(self, to: np.ndarray, ids: np.ndarray, score: np.ndarray, allowed: np.ndarray) -> None:
        """score[row, i] is for list to[i]; only where allowed."""
        open_ = allowed & (score >= self.worst[to])
        for i in np.flatnonzero(open_.any(axis=0)):
            at = np.flatnonzero(open_[:, i])
            own = score[at, i]
            if len(at) > 4 * self.k and own.dtype != object:  # the k-th best and its ties
                edge = np.partition(own, len(at) - self.k)[len(at) - self.k]
                at = at[own >= edge]
                own = score[at, i]
            held = self.rows[to[i]]
            held += [(-int(s), int(r)) for s, r in zip(own, ids[at])]
            held.sort()
            del held[self.k :]
            if len(held) == self.k:
                edge = float(-held[-1][0])
                self.worst[to[i]] = edge if abs(edge) < 2.0**53 else np.nextafter(edge, _NONE)


def _slices(rows: Vectors, width: int) -> Iterator[Vectors]:
    step = max(1, CELLS // max(1, width))
    for start in range(0, len(rows), step):
        yield rows.take(np.arange(start, min(start + step, len(rows))))


def positives(rows: Vectors, anchors: Vectors, best: Best) -> None:
    """Offer every row to the anchors of its label."""
    most = np.full(len(anchors), np.inf)
    for part in _slices(rows, len(anchors)):
        wanted = (part.labels[:, None] == anchors.labels) & (part.ids[:, None] != anchors.ids)
        at, to, pairs = survivors(part, anchors, wanted, best.worst, most)
        if len(at):
            chosen = part.take(at)
            best.offer(to, chosen.ids, scores(chosen, anchors.take(to), pairs), pairs)


def negatives(rows: Vectors, anchors: Vectors, lows: list[list[int]], highs: list[list[int]], best: list[Best]) -> None:
    """Offer every row to the anchors of other labels; lows, highs: for each slot the score window of every anchor (low > high: none)."""
    low, high = np.array(lows, float), np.array(highs, float)
    empty = low > high
    for part in _slices(rows, len(anchors)):
        need = np.maximum(low, [b.worst for b in best])
        need[empty] = np.inf
        least, most = need.min(axis=0), np.where(empty, _NONE, high).max(axis=0)
        wanted = (part.labels[:, None] != anchors.labels) & (part.ids[:, None] != anchors.ids) & (least <= most)
        at, to, pairs = survivors(part, anchors, wanted, least, most)
        if not len(at):
            continue
        chosen = part.take(at)
        exact = scores(chosen, anchors.take(to), pairs)
        for slot, held in enumerate(best):
            lo, hi = (np.array([x[slot][i] for i in to], exact.dtype) for x in (lows, highs))
            held.offer(to, chosen.ids, exact, pairs & (exact >= lo) & (exact <= hi))


# ---------------------------------------------------------------- tables

def _usable(batch: pa.RecordBatch, length: int) -> Vectors:
    """The rows of the batch (vec_id, label, vector) that take part and have this length."""
    ids, labels, vectors = batch.columns
    flat = vectors.flatten()
    sizes = np.array(vectors.value_lengths().fill_null(-1))
    keep = (sizes == length) & np.array(ids.is_valid()) & np.array(labels.is_valid())
    keep = np.flatnonzero(keep)
    ends = np.cumsum(np.maximum(sizes, 0))
    starts = (ends - np.maximum(sizes, 0))[keep]
    values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = values[(starts[:, None] + np.arange(length))] if length else np.zeros((len(keep), 0))
    finite = np.isfinite(matrix).all(axis=1)
    matrix, keep = np.floor(256.0 * matrix[finite]), keep[finite]
    own_ids, own_labels = np.array(ids.fill_null(0))[keep], np.array(labels.fill_null(0))[keep]
    order = np.argsort(own_ids, kind="stable")
    return Vectors(own_ids[order], own_labels[order], matrix[order])


def _found(lists: list[Best]) -> pa.RecordBatch:
    rows = [(i, slot, -s, v) for slot, best in enumerate(lists) for i, held in enumerate(best.rows) for s, v in held]
    columns = zip(*rows, strict=True) if rows else [()] * 4
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in FOUND.split(", ")])


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best k of every (anchor, slot), from the tasks' best."""
    w = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _scan(rows: DataFrame, anchors: Vectors, offer, lists: int, k: int) -> DataFrame:
    """(anchor, slot, score, vec_id, rank): offer(vectors, best) for all rows, by task, then over tasks."""
    length = anchors.scaled.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        best = [Best(len(anchors), k) for _ in range(lists)]
        for batch in batches:
            vectors = _usable(batch, length)
            if len(vectors):
                offer(vectors, best)
        yield _found(best)
        give_back()

    return _top(rows.mapInArrow(scan, FOUND), k)


def mined(rows: DataFrame, anchor: Column, label: Column, vec_id: str = "vec_id", vector: str = "embedding",
          n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    anchor: whether a row is an anchor; label: its label, as a whole number.
    """
    spark = rows.sparkSession
    own = bounded_batches(rows).select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                                       F.col(vector).cast("array<double>").alias("vector"), anchor.alias("anchor"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    asked = own.where(F.col("anchor") & usable).select("vec_id", "label", "vector").distinct()
    asked = written(asked.withColumn("length", F.size("vector")), "negatives-anchors")
    data = own.select("vec_id", "label", "vector")
    out = scratch_dir(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(f"{out}/block=none")
    for size in asked.groupBy("length").count().orderBy("length").collect():
        length, most = size["length"], max(1, min(block, BLOCK_BYTES // (8 * max(1, size["length"]))))
        parts = -(-size["count"] // max(1, most * 3 // 4))  # a hash does not deal evenly
        dealt = asked.where(F.col("length") == length).withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(parts)))
        for part in range(parts):
            table = dealt.where(F.col("block") == part).select("vec_id", "label", "vector").toArrow().combine_chunks()
            for batch in table.to_batches():
                anchors = _usable(batch, length)
                found = _mined_block(data, anchors, n_positives, n_negatives, low, high)
                if found is not None:
                    found.write.mode("append").parquet(f"{out}/block={length}-{part}")
    return spark.read.schema(schema).parquet(out).select(*[c.split()[0] for c in schema.split(", ")])


def _mined_block(data: DataFrame, anchors: Vectors, n_positives: int, n_negatives: int, low: int, high: int) -> DataFrame | None:
    top = _scan(data, anchors, lambda v, best: positives(v, anchors, best[0]), 1, n_positives).collect()  # at most n_positives an anchor
    if not top:
        return None
    slots = [[None] * len(anchors) for _ in range(n_positives)]
    for r in top:
        slots[r["rank"] - 1][r["anchor"]] = (r["vec_id"], r["score"])
    lows = [[-(-low * p[1] // 100) if p else 1 for p in slot] for slot in slots]
    highs = [[high * p[1] // 100 if p else 0 for p in slot] for slot in slots]
    found = _scan(data, anchors, lambda v, best: negatives(v, anchors, lows, highs, best), n_positives, n_negatives)
    chosen = [(i, s, int(anchors.ids[i]), *p) for s, slot in enumerate(slots) for i, p in enumerate(slot) if p]
    pairs = data.sparkSession.createDataFrame(chosen, "anchor int, slot int, anchor_id long, positive_id long, positive_score long")
    return found.join(F.broadcast(pairs), ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
