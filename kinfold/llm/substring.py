"""Substring dedup with fixed-block anchors.

Words are `[^\\x20\\x09-\\x0D]+`, unchanged.  A word is removed when a run of at least WINDOW words around it
also starts in a document with a smaller id.  Any such run holds one of the other document's
reference blocks, the non-overlapping blocks of BLOCK words (2 * BLOCK - 1 <= WINDOW).

1. Every rolling window of BLOCK words probes the reference blocks.  Windows and blocks meet in hash
   buckets; a chunk of documents sends each distinct hash once (4 bytes beyond its bucket's bits,
   2 bytes for its place), so a passage of a third of all documents costs one entry per chunk.
2. Documents with a hit are read again.  The runs of WINDOW words around their hits are compared by
   64-bit hash: the smallest id that has a run keeps it, and in the others it is removed.  Adjacent removed
   runs are one maximal repeat.
3. All documents are written out; only those with removals meet their list of removed runs.

A document whose words equal those of a document with a smaller id takes no part in 2: all its words
go (if it has a run at all).  An id with several texts takes this way out only if it holds for all of them.  Null and empty texts have no words; rows with a null id neither remove
nor lose words; rows of one id do not remove each other's words; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORDS, chunks, possible_members, rolling, signed, text_bytes, written

WINDOW = 13
BLOCK = 7
BUCKET_BYTES = 1_000_000
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _windows(lengths: np.ndarray, width: int) -> np.ndarray:
    """Whether a window of `width` words starts at each word of the concatenated documents and stays inside its own."""
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(int(ends[-1]) if len(ends) else 0)
    return left >= width


def _hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the windows that start at each word (0 where none does), whether one does, and words per document."""
    words = [t.split() for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    h = np.concatenate([WORDS.of(w) for w in words]) if words else np.empty(0, np.uint64)
    grams = np.zeros(len(h), np.uint64)
    rolled = rolling(h, width)
    grams[: len(rolled)] = rolled
    return grams, _windows(lengths, width), lengths


def _probe(window: int, block: int, buckets: int):
    shift = np.uint64(64 - buckets.bit_length() + 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (part, texts) in enumerate(chunks(batches, keep="words")):
            grams, valid, lengths = _hashes(texts, block)
            valid &= np.repeat(lengths >= window, lengths)
            starts = np.cumsum(lengths) - lengths
            at = np.flatnonzero(valid)
            chunk = task << 24 | number
            ids = part.column(0).to_numpy()
            rows = [(buckets + chunk % buckets, chunk, ids.tobytes(), starts.tobytes(), None)]
            if len(at):
                order = at[np.argsort(grams[at], kind="stable")]
                h = grams[order]
                doc = np.repeat(np.arange(len(lengths)), lengths)[order]
                first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                group = np.cumsum(np.concatenate(([True], h[1:] != h[:-1]))) - 1
                aligned = np.maximum.reduceat((order - starts[doc]) % block == 0, first)
                several = (np.maximum.reduceat(doc, first) != doc[first])[group]
                if several.any():  # documents of this chunk share it: surely a hit
                    rows.append((buckets + chunk % buckets, chunk, None, None, order[several].astype(np.uint32).tobytes()))
                # one entry for each distinct hash, in text order within its bucket
                place, h = order[first], h[first]
                by = np.argsort(place)
                place, h, aligned = place[by], h[by], aligned[by]
                bucket = (h >> shift).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                place, h, aligned, bucket = place[by], h[by], aligned[by], bucket[by]
                short = ((h << np.uint64(64 - int(shift))) >> np.uint64(32)).astype(np.uint32)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                for b, p, x, y in zip(bucket[np.concatenate(([0], cuts))], np.split(place, cuts), np.split(short, cuts), np.split(aligned, cuts), strict=True):
                    steps = np.diff(p, prepend=0)
                    steps = steps.astype(np.uint16) if steps.max() < 1 << 16 else steps.astype(np.uint32)
                    rows.append((int(b), chunk, x.tobytes(), steps.tobytes(), np.packbits(y).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 2 + [pa.binary()] * 3, strict=True)], ["bucket", "chunk", "a", "b", "c"])

    return probe


def _meet(buckets: int):
    def meet(group: pa.Table) -> pa.Table:
        """Places, by chunk, of the hashes that several chunks have and one of them as a block; other rows as they are."""
        if group["bucket"][0].as_py() >= buckets:
            return group.select(["chunk", "a", "b", "c"])
        chunk, a, b, c = (group[x].to_pylist() for x in ("chunk", "a", "b", "c"))
        h = np.frombuffer(b"".join(a), np.uint32)
        sizes = np.array([len(x) // 4 for x in a])
        source = np.repeat(np.arange(len(a)), sizes)
        aligned = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(c, sizes, strict=True)]).astype(bool)
        order = np.argsort(h, kind="stable")
        s, source, y = h[order], source[order], aligned[order]
        new = np.concatenate(([True], s[1:] != s[:-1]))
        first = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        hit = (np.diff(np.append(first, len(s))) > 1) & np.logical_or.reduceat(y, first)
        hits = np.zeros(len(h), bool)
        hits[order] = hit[number]
        out, start = [], 0
        for i, n in enumerate(sizes):
            own = hits[start : start + n]
            start += n
            if own.any():
                place = np.cumsum(np.frombuffer(b[i], np.uint16 if len(b[i]) == 2 * n else np.uint32), dtype=np.int64)
                out.append((chunk[i], None, None, place[own].astype(np.uint32).tobytes()))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table([pa.array(x, t) for x, t in zip(columns, [pa.int64()] + [pa.binary()] * 3, strict=True)], ["chunk", "a", "b", "c"])

    return meet


def _by_document(group: pa.Table) -> pa.Table:
    """(doc_id, places of hits in it) from a chunk's table of documents and its hits."""
    a, b, c = (group[x].to_pylist() for x in "abc")
    table = next(i for i, x in enumerate(a) if x is not None)
    ids, starts = np.frombuffer(a[table], np.int64), np.frombuffer(b[table], np.int64)
    places = np.unique(np.frombuffer(b"".join(x for x in c if x), np.uint32)).astype(np.int64)
    doc = np.searchsorted(starts, places, "right") - 1
    own = (places - starts[doc]).astype(np.int32)
    cuts = np.flatnonzero(np.diff(doc)) + 1
    parts = [x.tobytes() for x in np.split(own, cuts)] if len(own) else []
    return pa.table([pa.array(ids[doc[np.concatenate(([0], cuts))]] if len(own) else [], pa.int64()), pa.array(parts, pa.binary())], ["doc_id", "hits"])


def _near(places: np.ndarray, before: int, size: int) -> np.ndarray:
    """Whether each position is at most `before` before one of the places."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, np.maximum(places - before, 0), 1)
    np.add.at(change, places + 1, -1)
    return np.cumsum(change[:-1]) > 0


def _runs(window: int, block: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(run, doc_id, removed): the runs around hits; the chunk's smallest id of each asks, the others lose it."""
        for part, texts in chunks(batches, keep="words"):
            out: list[tuple[np.ndarray, np.ndarray]] = []
            for doc, text, hits in zip(part.column(0).to_pylist(), texts, part.column(1).to_pylist(), strict=True):
                h = WORDS.of(text.split())
                run, gram = rolling(h, window), rolling(h, block)
                places = np.frombuffer(hits, np.int32).astype(np.int64)
                hit = np.isin(gram, gram[places[places < len(gram)]])  # also where the document repeats itself
                near = _near(np.flatnonzero(hit), window - block, max(len(run), len(gram)))[: len(run)]
                found = np.unique(run[near])
                out.append((found, np.full(len(found), doc, np.int64)))
            run, doc = (np.concatenate(x) for x in zip(*out, strict=True))
            order = np.lexsort((doc, run))
            run, doc = run[order], doc[order]
            new = np.concatenate(([True], run[1:] != run[:-1]))[: len(run)]
            least = doc[new][np.cumsum(new) - 1] if len(run) else doc
            ask_or_lose = new | (doc > least)  # rows of the smallest id again say nothing new
            yield pa.RecordBatch.from_arrays([pa.array(signed(run[ask_or_lose])), pa.array(doc[ask_or_lose]), pa.array(~new[ask_or_lose])], ["run", "doc_id", "removed"])

    return runs


def _finish(window: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, keep="words"):
            out = []
            for doc, whole, lost, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), texts, strict=True):
                words = text.split()
                total = len(words)
                if whole and total >= window:
                    words = []
                elif lost.is_valid and total >= window:
                    gone = np.isin(signed(rolling(WORDS.of(words), window)), lost.values.to_numpy())
                    covered = np.zeros(total + 1, np.int64)
                    covered[np.flatnonzero(gone)] += 1
                    covered[np.flatnonzero(gone) + window] -= 1
                    words = [w for w, c in zip(words, np.cumsum(covered[:-1]).tolist(), strict=True) if not c]
                out.append((doc, total, total - len(words), b" ".join(words)))
            doc, total, removed, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array([x.decode() for x in kept])], ["doc_id", "n_words", "n_removed", "text"])

    return finish


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and the text of the kept words, joined by one space."""
    if 2 * block - 1 > window:
        raise ValueError("a window must hold a whole aligned block: 2 * block - 1 <= window")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = rows.where("doc_id IS NOT NULL").select("doc_id", F.col("text").cast("binary").alias("text"))

    # documents with the words of a smaller id
    same = rows.select("doc_id", F.sha2(F.trim(F.regexp_replace("text", SPACE, " ")), 256).alias("words")).where("doc_id IS NOT NULL")
    least = same.groupBy("words").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    is_copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    copies = written(same.join(least, "words", "left").groupBy("doc_id").agg(F.min(is_copy).alias("copy")).where("copy").select("doc_id"), "copies")

    buckets = 1 << max(4, (text_bytes(rows, "text") // BUCKET_BYTES).bit_length())
    sent = named.mapInArrow(_probe(window, block, buckets), "bucket long, chunk long, a binary, b binary, c binary")
    back = sent.groupBy("bucket").applyInArrow(_meet(buckets), "chunk long, a binary, b binary, c binary")
    hits = written(back.groupBy("chunk").applyInArrow(_by_document, "doc_id long, hits binary"), "hits")
    hits = hits.join(copies, "doc_id", "left_anti").groupBy("doc_id").agg(F.array_join(F.collect_list(F.hex("hits")), "").alias("hits"))
    hits = hits.select("doc_id", F.unhex("hits").alias("hits"))

    asked = possible_members(named, F.col("doc_id"), hits, F.col("doc_id")).where("_possible")
    runs = asked.join(hits, "doc_id").select("doc_id", "hits", "text").mapInArrow(_runs(window, block), "run long, doc_id long, removed boolean")
    runs = written(runs, "runs")
    over = F.min("doc_id").over(Window.partitionBy("run"))
    lost = runs.where("removed").select("run", "doc_id").union(
        runs.where("NOT removed").withColumn("least", over).where("doc_id > least").select("run", "doc_id"))
    lost = lost.groupBy("doc_id").agg(F.collect_list("run").alias("lost")).withColumn("whole", F.lit(False))
    lost = written(lost.unionByName(copies.select("doc_id", F.lit(None).cast("array<long>").alias("lost"), F.lit(True).alias("whole"))), "lost")

    flagged = possible_members(rows.withColumn("text", F.col("text").cast("binary")), F.coalesce(F.col("doc_id"), F.lit(0)), lost, F.col("doc_id"))
    columns = ["doc_id", "whole", "lost", "text"]
    whole = flagged.where("NOT _possible").withColumns({"whole": F.lit(False), "lost": F.lit(None).cast("array<long>")}).select(columns)
    some = flagged.where("_possible").join(lost, "doc_id", "left").select(columns)
    return whole.unionByName(some).mapInArrow(_finish(window), "doc_id long, n_words long, n_removed long, text string")


def digests(kept: DataFrame) -> DataFrame:
    """The kept text as its digest; see SCHEMA."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
