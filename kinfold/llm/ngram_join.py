"""N-gram Jaccard join by PartEnum signatures.

A document's set holds the hashes of its distinct word shingles (words: `[^\\x20\\x09-\\x0D]+` after
lower-casing A-Z).  Equal sets are one class, the `sid`.  Two sets of sizes a and b are linked when
100 * intersection >= THRESHOLD * union, which bounds their difference by
k = (100 - t) * (a + b) / (100 + t).

Signatures.  Sizes fall into bands; a set signs in its own band and in the next one when a linked larger set
may lie there.  A band divides the feature domain into k_max + 1 + spare partitions; a set signs its first
k + 1 + spare partitions, each with the hash of what it has there.  k differences leave at least
spare + 1 of them equal.  A set may therefore leave out its `spare` most common signatures (by one global order,
empty partitions first) and still shares one with every linked set: each signature left stands for
all subsets of spare + 1 partitions that contain it as the rarest.  Sets with too few shared signatures have no link.

Verification.  Sets joined by kept signatures form clusters.  Within a cluster, first parity sketches are
compared: a sketch has 2 to 4 bits a shingle, each the parity of how many shingles fall on it, so two sketches never
differ in more bits than the sets differ in shingles.  Pairs with more than k differing bits are no links; the
pairs left form finer clusters, and only their members' sets are made again and compared exactly.  Both times a
large cluster is compared as pairs of blocks of bounded size, and tasks return spanning links and degrees,
never pairs.  Nothing is capped.

Documents without words have an empty set, are linked with nothing and are their own component.  Null
texts count as empty; rows with a null id are returned, but a component is named by its smallest
non-null id; empty tables give no rows; repeated rows are repeated; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS, bounded_batches, chunks, components, give_back, keep_only, mix, possible_members, rolling, signed, text_bytes, written

WIDTH = 4
THRESHOLD = 85
BLOCK = 512
BLOCK_SHINGLES = 500_000
BUCKET_BYTES = 2_000_000
_COLUMNS = 2048
_LEVELS = 64
_SKETCH_BITS = 1 << 16


def levels(threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(upper size, partitions, spare) of every size band; a band spans a factor of 1.5."""
    upper, low = [], 1
    while len(upper) < _LEVELS - 1:
        upper.append(low + low // 2)
        low = upper[-1] + 1
    upper = np.array(upper, np.int64)
    most = (100 - threshold) * 2 * upper // (100 + threshold)
    spare = 1 + np.ceil(np.sqrt(upper) / 2).astype(np.int64)
    return upper, np.where(most > 0, most + 1 + spare, 0), spare


def shingles(text: bytes, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; all its words as one shingle when there are fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = WORDS.of(words)
    return np.unique(rolling(h, min(width, len(words))) + np.uint64(0 if len(words) >= width else len(words)))


def set_id(s: np.ndarray) -> int:
    """One 64-bit id for equal sets; 0 for the empty set."""
    return int(mix(np.array([np.bitwise_xor.reduce(s) ^ mix(s).sum(dtype=np.uint64) ^ np.uint64(len(s))]))[0] | np.uint64(1)) if len(s) else 0


def signatures(s: np.ndarray, threshold: int, tables: tuple) -> Iterator[tuple[np.ndarray, int]]:
    """(signatures, how many of them a linked set shares at least) for each band the set signs in."""
    upper, partitions, spare = tables
    size = len(s)
    own = int(np.searchsorted(upper, size))
    largest = size * 100 // threshold
    for level in (own, own + 1):
        if level > own and upper[own] >= largest or not partitions[level]:
            continue
        k = (100 - threshold) * (size + min(largest, int(upper[level]))) // (100 + threshold)
        if not k:
            continue
        count, free = int(partitions[level]), int(spare[level])
        emit = k + 1 + free
        spread = mix(s ^ np.uint64(0x5851F42D4C957F2D + level))
        place = (spread % np.uint64(count)).astype(np.int64)
        inside = place < emit
        sums = np.zeros(emit, np.uint64)
        np.add.at(sums, place[inside], mix(spread[inside]))
        filled = np.zeros(emit, bool)
        filled[place[inside]] = True
        empty = np.flatnonzero(~filled)
        chosen = np.sort(np.concatenate((np.flatnonzero(filled), empty[: max(0, len(empty) - free)])))
        h = mix(sums[chosen] + chosen.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        yield (h & ~np.uint64(_LEVELS - 1)) | np.uint64(level), max(1, free + 1 - len(empty))


def sketch(s: np.ndarray) -> bytes:
    """The parity of the number of shingles on each bit; 2 to 4 bits a shingle, 64 at least and _SKETCH_BITS at most."""
    bits = min(_SKETCH_BITS, max(64, 1 << (2 * len(s) - 1).bit_length())) if len(s) else 0
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes() if bits else b""


def _sign(width: int, threshold: int, buckets: int):
    tables = levels(threshold)
    shift = np.uint64(64 - buckets.bit_length() + 1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (part, texts) in enumerate(chunks(batches, keep="words")):
            ids, sizes, sids, parts, sketches = part.column(0), [], [], {}, []
            for text in texts:
                s = shingles(text, width)
                sid = set_id(s)
                sizes.append(len(s))
                sids.append(sid)
                sketches.append(None if sid in parts or not sid else sketch(s))
                if sid not in parts:  # equal sets of a chunk sign once
                    parts[sid] = list(signatures(s, threshold, tables)) if sid else []
            found = [(h, need, sid) for sid, own in parts.items() for h, need in own]
            rows: list[tuple] = [(buckets + (TaskContext.get().partitionId() * 8191 + number) % buckets, ids.cast(pa.int64()).fill_null(0).to_numpy().tobytes(), np.array(sids, np.uint64).tobytes(),
                                  np.array(sizes, np.int64).tobytes(), np.array(ids.is_null()).astype(np.uint8).tobytes(), sketches)]
            if found:
                h = np.concatenate([x for x, _, _ in found])
                lengths = [len(x) for x, _, _ in found]
                need = np.repeat(np.array([min(255, n) for _, n, _ in found], np.uint8), lengths)
                sid = np.repeat(np.array([x for *_, x in found], np.uint64), lengths)
                order = np.argsort(h)
                h, need, sid = h[order], need[order], sid[order]
                bucket = (h >> shift).astype(np.int64) if buckets > 1 else np.zeros(len(h), np.int64)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                for b, x, y, z in zip(bucket[np.concatenate(([0], cuts))], np.split(h, cuts), np.split(sid, cuts), np.split(need, cuts), strict=True):
                    rows.append((int(b), x.tobytes(), y.tobytes(), z.tobytes(), None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] + [pa.binary()] * 4 + [pa.list_(pa.binary())], strict=True)], ["bucket", "a", "b", "c", "d", "e"])

    return sign


def _joined(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype)


def _meet(buckets: int):
    names = ["doc_id", "sid", "size", "sketch", "sig", "met", "need"]

    def meet(group: pa.Table) -> pa.Table:
        """Document rows as they are; of the signatures those that more than one set has."""
        keep_only()
        if group["bucket"][0].as_py() >= buckets:
            ids = pa.array(_joined(group["a"], np.int64), mask=_joined(group["d"], np.uint8).astype(bool))
            n = len(ids)
            return pa.table([ids, signed(_joined(group["b"], np.uint64)), _joined(group["c"], np.int64), pa.array([x for e in group["e"].to_pylist() for x in e], pa.binary())] + [pa.nulls(n, pa.int64())] * 3, names)
        h, sid, need = _joined(group["a"], np.uint64), _joined(group["b"], np.uint64), _joined(group["c"], np.uint8)
        order = np.lexsort((sid, h))
        h, sid, need = h[order], sid[order], need[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (sid[1:] != sid[:-1])))  # equal sets of several chunks
        h, sid, need = h[new], sid[new], need[new]
        starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        met = np.repeat(np.diff(np.append(starts, len(h))), np.diff(np.append(starts, len(h))))
        many = met > 1
        n = int(many.sum())
        return pa.table([pa.nulls(n, pa.int64()), signed(sid[many]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), signed(h[many]), met[many].astype(np.int64), need[many].astype(np.int64)], names)

    return meet


def _sets(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, keep="words"):
            found = [shingles(t, width) for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(signed(np.array([set_id(s) for s in found], np.uint64))), pa.array([s.tobytes() for s in found], pa.binary())], ["sid", "places", "own", "features"])

    return make


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairwise intersections of the sets of one task, a slice of the shared features at a time."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((n, n), np.float32)
    for low in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        dense = np.zeros((n, min(_COLUMNS, int(shared.sum()) - low)), np.float32)
        dense[row[a:b], column[a:b] - low] = 1
        total += dense @ dense.T
    return total


def links(sets: list[np.ndarray], threshold: int) -> np.ndarray:
    """Which pairs of the sets of one task are linked (a set with itself too), some rows at a time."""
    shared, size = intersections(sets), np.array([len(s) for s in sets])
    linked = np.empty(shared.shape, bool)
    for low in range(0, len(sets), 256):
        at = slice(low, low + 256)
        linked[at] = (100 + threshold) * shared[at].astype(np.int64) >= threshold * (size[at, None] + size[None, :])
    return linked


def _spanning(sid: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The smallest sid that each set reaches by the links of a task."""
    label = sid.copy()
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (low == label).all():
            return label
        label = low


def _across(linked: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Only links between the two blocks (sides 1 and 2) of a pair of blocks, or within a task's only block (0)."""
    linked &= (side[:, None] == 0) | (side[:, None] != side[None, :])
    np.fill_diagonal(linked, False)
    return linked


def possible_links(size: np.ndarray, sketches: list[bytes], threshold: int) -> np.ndarray:
    """Which pairs of sets may be linked by their sizes and sketches; the longer sketch of a pair is folded onto the shorter."""
    order = np.argsort(size, kind="stable")
    size, rows = size[order], [np.frombuffer(sketches[i], np.uint64) for i in order]
    words = np.array([len(r) for r in rows])
    reach = np.searchsorted(size, size * 100 // threshold, "right")
    near = np.zeros((len(size), len(size)), bool)
    for w in np.unique(words):
        low, high = np.searchsorted(words, w), np.searchsorted(words, w, "right")
        folded = np.stack([np.bitwise_xor.reduce(r.reshape(-1, w), axis=0) for r in rows[low : reach[high - 1]]])
        for i in range(low, high):
            differ = np.bitwise_count(folded[i - low] ^ folded[i - low + 1 : reach[i] - low]).sum(axis=1, dtype=np.int64)
            near[i, i + 1 : reach[i]] = (100 + threshold) * differ <= (100 - threshold) * (size[i] + size[i + 1 : reach[i]])
    out = np.zeros_like(near)
    out[np.ix_(order, order)] = near | near.T
    return out


def _candidates(threshold: int):
    def candidates(group: pa.Table) -> pa.Table:
        """Spanning links of the sets of a task whose sketches do not rule a link out."""
        keep_only()
        cluster, sid, side, size = (group[c].to_numpy() for c in ("cluster", "sid", "side", "size"))
        sketches = group["sketch"].to_pylist()
        order = np.argsort(cluster, kind="stable")
        out: list[np.ndarray] = []
        for at in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            linked = _across(possible_links(size[at], [sketches[i] for i in at], threshold), side[at])
            some = linked.any(axis=1)
            out.append(np.stack((sid[at], _spanning(sid[at], linked)))[:, some])
        a, b = np.concatenate(out, axis=1)
        give_back()
        return pa.table([a, b], ["a", "b"])

    return candidates


def _verify(threshold: int):
    def verify(group: pa.Table) -> pa.Table:
        """Spanning links of the linked sets of a task, and each set's number of linked documents."""
        keep_only()
        cluster, sid, side, copies = (group[c].to_numpy() for c in ("cluster", "sid", "side", "copies"))
        features = group["features"].to_pylist()
        out: list[np.ndarray] = []
        for c in np.unique(cluster):
            at = np.flatnonzero(cluster == c)
            _, first = np.unique(sid[at] * 4 + side[at], return_index=True)
            at = at[first]
            sets = [np.frombuffer(features[i], np.uint64) for i in at]
            linked = _across(links(sets, threshold), side[at])
            some = linked.any(axis=1)
            out.append(np.stack((sid[at], _spanning(sid[at], linked), linked @ copies[at]))[:, some])
        a, b, degree = np.concatenate(out, axis=1) if out else np.empty((3, 0), np.int64)
        give_back()
        return pa.table([a, b, degree], ["a", "b", "degree"])

    return verify


def _tasks(members: DataFrame, threshold: int, block: int) -> DataFrame:
    """members (cluster, sid, size, ...) with a task and a side: small clusters share tasks, large ones become pairs of blocks.

    The blocks of a large cluster hold sets of one size band, as only sets of the same or the next band can be linked.
    A block has about `block` sets, fewer when they are long: BLOCK_SHINGLES shingles in all, so a task's memory is bounded.
    """
    weight = F.greatest(F.col("size"), F.lit(max(1, BLOCK_SHINGLES // block)))
    totals = members.groupBy("cluster").agg(F.sum(weight).alias("total"))
    whole = 4 * BLOCK_SHINGLES  # of a cluster that one task compares as it is
    band = F.when(F.col("total") > whole, F.floor(F.log(F.col("size").cast("double")) / F.lit(float(np.log(100 / threshold))))).otherwise(0).cast("int")
    banded = members.join(totals, "cluster").withColumn("band", band)
    blocks = banded.groupBy("cluster", "band").agg(
        F.when(F.max("total") > whole, F.ceil(F.sum(weight) / F.lit(BLOCK_SHINGLES))).otherwise(1).cast("int").alias("blocks"))
    plan = blocks.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("plan"))
    few = max(1, (members.agg(F.sum(weight)).first()[0] or 0) // BLOCK_SHINGLES)
    own = F.pmod(F.xxhash64("sid"), F.element_at("plan", F.col("band"))).cast("int")
    other = F.explode(F.expr("flatten(transform(filter(map_keys(plan), x -> abs(x - band) <= 1), x -> transform(sequence(0, plan[x] - 1), y -> struct(x AS band, y AS block))))"))
    placed = banded.join(plan, "cluster").withColumn("own", F.struct(F.col("band").alias("band"), own.alias("block"))).withColumn("other", other)
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).cast("long")
    pair = F.xxhash64("cluster", F.least("own", "other"), F.greatest("own", "other"))
    task = F.when(F.col("total") <= whole, F.pmod(F.xxhash64("cluster"), F.lit(few))).otherwise(F.least(F.lit(-1), -F.abs(pair / 2).cast("long")))
    return placed.select(task.alias("task"), side.alias("side"), *members.columns)


def joined(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: int = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links (other documents it is linked to)."""
    return _join_sets(docs, doc_id, text, width, threshold, block).drop("sid")


def _join_sets(docs: DataFrame, doc_id: str, text: str, width: int, threshold: int, block: int) -> DataFrame:
    """joined, with the id of each document's set."""
    rows = bounded_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    buckets = 1 << max(4, (text_bytes(rows, "text") // BUCKET_BYTES).bit_length())
    signed_rows = rows.mapInArrow(_sign(width, threshold, buckets), "bucket long, a binary, b binary, c binary, d binary, e array<binary>")
    met = written(signed_rows.groupBy("bucket").applyInArrow(_meet(buckets), "doc_id long, sid long, size long, sketch binary, sig long, met long, need long"), "partenum")
    documents = met.where("sig IS NULL").select("doc_id", "sid", "size")
    sketches = met.where("sketch IS NOT NULL").groupBy("sid").agg(F.first("sketch").alias("sketch"))
    classes = written(documents.where("size > 0").groupBy("sid").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size")), "classes")

    # signatures that more than one set has; clusters by those without each set's `need - 1` most common ones
    level = (F.col("sig").bitwiseAND(F.lit(_LEVELS - 1))).alias("level")
    per_set = met.where("sig IS NOT NULL").groupBy("sid", level).agg(F.max("need").alias("need"), F.sort_array(F.collect_list(F.struct("met", "sig"))).alias("own"))
    kept = written(per_set.where("size(own) >= need").select("sid", F.explode(F.expr("transform(slice(own, 1, size(own) - need + 1), x -> x.sig)")).alias("sig")), "kept")
    low = kept.groupBy("sig").agg(F.min("sid").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rough = components(kept.join(low, "sig").select(F.col("sid").alias("a"), F.col("low").alias("b")).distinct())

    # finer clusters: the pairs that the sketches do not rule out
    rough = rough.withColumnRenamed("node", "sid").withColumnRenamed("component", "cluster").join(classes.select("sid", "size"), "sid")
    rough = written(rough.join(sketches, "sid"), "rough")
    pairs = _tasks(rough, threshold, block).groupBy("task").applyInArrow(_candidates(threshold), "a long, b long")
    fine = components(written(pairs.where("a <> b"), "pairs"))
    members = written(fine.withColumnRenamed("node", "sid").withColumnRenamed("component", "cluster").join(classes, "sid"), "members")

    # the sets of the clusters' members, made again from one document of each
    # (a set goes straight to its tasks: only texts of members and the placed sets are shuffled)
    place = "struct<task:long,cluster:long,side:long,copies:long>"
    places = _tasks(members, threshold, block).groupBy("sid").agg(F.collect_list(F.struct("task", "cluster", "side", "copies")).alias("places"))
    reps = members.where("first IS NOT NULL").select(F.col("first").alias("doc_id"), "sid").join(places, "sid")
    reps = written(reps, "places")
    possible = possible_members(rows, F.col("doc_id"), reps, F.col("doc_id")).where("_possible").drop("_possible")
    sets = possible.join(reps, "doc_id").select("sid", "places", "text").mapInArrow(_sets(width), f"sid long, places array<{place}>, own long, features binary")
    placed = sets.where("sid = own").select("sid", "features", F.inline("places"))
    found = written(placed.groupBy("task").applyInArrow(_verify(threshold), "a long, b long, degree long"), "links")

    merged = components(found.select("a", "b").where("a <> b"))
    merged = merged.withColumnRenamed("node", "sid").join(classes.select("sid", "first"), "sid")
    names = merged.groupBy("component").agg(F.min("first").alias("component_id"))
    degrees = found.groupBy(F.col("a").alias("sid")).agg(F.sum("degree").alias("degree"))
    linked = merged.join(names, "component").select("sid", "component_id").join(degrees, "sid", "left")
    named = classes.join(linked, "sid", "left").select("sid", F.coalesce("component_id", "first").alias("component_id"), (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return documents.join(named, "sid", "left").select(
        "sid", "doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _own_set(width: int):
    @F.pandas_udf("long")
    def own(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: int(signed(np.array([set_id(shingles(t.encode(), width))], np.uint64))[0]))

    return own


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, threshold: int = 80) -> DataFrame:
    """The rows without those whose component has a smaller id; rows with a null id stay.

    Rows of one id with different texts are decided one by one, by the set of each.
    """
    result = _join_sets(docs, doc_id, text, width, threshold, BLOCK)
    goes = F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(False))
    verdicts = written(result.where("doc_id IS NOT NULL").select("doc_id", "sid", goes.alias("goes")), "verdicts")
    by_id = verdicts.groupBy(F.col("doc_id").alias("dropped")).agg(F.max("goes").alias("goes"), F.min("goes").alias("all")).where("goes")
    dropped = written(by_id.select("dropped", "all"), "dropped")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("own"), F.struct(*docs.columns).alias("row"))
    flagged = possible_members(rows, F.coalesce("id", F.lit(0)), dropped, F.col("dropped"))
    rest = flagged.where("_possible").join(dropped.where("all"), F.col("id") == F.col("dropped"), "left_anti")
    mixed = dropped.where("NOT all")
    if not mixed.isEmpty():
        gone = verdicts.where("goes").join(mixed, F.col("doc_id") == F.col("dropped")).select("doc_id", "sid").distinct()
        several = rest.join(mixed, F.col("id") == F.col("dropped"), "left_semi").withColumn("sid", _own_set(width)(F.coalesce("own", F.lit(""))))
        several = several.join(gone, (F.col("id") == F.col("doc_id")) & (several["sid"] == gone["sid"]), "left_anti")
        rest = rest.join(mixed, F.col("id") == F.col("dropped"), "left_anti").select("row").unionAll(several.select("row"))
    return flagged.where("NOT _possible").select("row").unionAll(rest.select("row")).select("row.*")
