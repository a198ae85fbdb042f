"""LM scoring with a weighted backoff automaton.

Tokens are the words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z and one end per text.  Counts cover all learning
rows.  Unigrams are smoothed by adding one; every pair and triple that occurs in a learning row is kept, whatever the
corpus' size, so the model grows with it.  N-grams are discounted by DISCOUNT, and what they leave goes to the shorter history.

Each learned history is a state; its arcs are the learned n-grams that go on from it, and its failure arc leads to
the next shorter history with the backoff weight.  A text is read from left to right; the state before a token is the longest
learned history that ends there, which the two tokens before it decide.  So a block's tokens are read side by side: each
starts in its state and follows failure arcs, adding their weights, until its state has an arc for it.

No part of the model is gathered: documents form blocks, and hash buckets hold the n-grams.  A block asks the
buckets for the counts of its distinct words and pairs, and then of the triples whose pairs other blocks hold too.  For
the backoff weights, one block of those that hold an n-gram reports it to its history's bucket, which adds up
whole numbers (so no order of sums shows) and answers all blocks that hold the history.  Keys travel sorted, as differences, in compressed byte planes.

A null or empty text is one end.  A null id counts as an empty string in the split into learning and held-out rows;
an empty table gives no rows; repeated rows count and are scored again; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import distinct_hashes, mix, rolling, shuffle_partitions, text_bytes, written

ORDER = 3
DISCOUNT = 0.75
BLOCK_BYTES = 8_000_000
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
ASKED = "bucket long, block long, keys binary, a binary, b binary, c binary"
ANSWERS = "bucket long, block long, a binary, b binary, c binary, distinct long, learned long"
KINDS = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


#: A word's hash: its bytes as numbers (A-Z as a-z; 0 for white space) in a polynomial modulo 2^64, with odd base, then mixed.
_BASE = 0x9E3779B97F4A7C15
_CODE = mix(np.arange(1, 257, dtype=np.uint64))
_CODE[65:91] = _CODE[97:123]
_CODE[[9, 10, 11, 12, 13, 32]] = 0
_END = mix(np.array([0], np.uint64) - np.uint64(1))
_WHITE = re.compile(rb"[ \t-\r]")
SLICE = 1 << 20


@lru_cache(maxsize=2)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words in order, where each starts)."""
    code = _CODE[np.frombuffer(data, np.uint8)]
    n = 1 << max(1, len(code)).bit_length()
    inside = np.zeros(len(code) + 2, bool)
    inside[1:-1] = code != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(code * _powers(n, _BASE)[: len(code)], out=total[1:])
    h = (total[ends] - total[starts]) * _powers(n, pow(_BASE, -1, 1 << 64))[starts]
    return mix(h + (ends - starts).astype(np.uint64)), starts


def _slices(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """(number, part) of texts, long ones cut at white space, in groups of about SLICE bytes."""
    numbers, parts, held = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            cut = _WHITE.search(text, at + SLICE) if len(text) - at > 2 * SLICE else None
            end = cut.start() if cut else len(text)
            numbers.append(i)
            parts.append(text[at:end])
            held, at = held + end - at, end
            if held >= SLICE:
                yield numbers, parts
                numbers, parts, held = [], [], 0
    if parts:
        yield numbers, parts


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, text by text; tokens of each text): its words, then the end."""
    words, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for numbers, parts in _slices(texts):
        h, starts = _word_hashes(b" ".join(parts))
        firsts = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
        words.append(h)
        owners.append(np.array(numbers)[np.searchsorted(firsts, starts, "right") - 1])
    owner = np.concatenate(owners)
    out = np.full(len(owner) + len(texts), _END[0], np.uint64)
    out[np.arange(len(owner)) + owner] = np.concatenate(words)  # a text's words come after the ends of those before
    return out, np.bincount(owner, minlength=len(texts)) + 1


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [c.split() for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.table([pa.array(c, KINDS[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _pack(values: np.ndarray) -> bytes:
    """64-bit values in compressed byte planes, after their number."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    size = 8 * int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(packed[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


class Grams:
    """A block's distinct n-grams of each order in hash order, and which of them starts at each token."""

    def __init__(self, texts: list[bytes], order: int):
        h, self.lengths = tokens(texts)
        self.starts = np.cumsum(self.lengths) - self.lengths
        goes_on = np.ones(len(h), bool)
        goes_on[self.starts + self.lengths - 1] = False
        inside = [np.ones(len(h), bool), goes_on[:-1], goes_on[:-2] & goes_on[1:-1]]
        self.keys: list[np.ndarray] = []
        self.at: list[np.ndarray] = []  # -1 where the text ends before
        for k in range(3):
            hashes = (h if not k else rolling(h, k + 1))[inside[k]] if k < order else h[:0]
            keys, _, found = distinct_hashes(hashes)
            at = np.full(len(inside[k]), -1, np.int32)
            if k < order:
                at[inside[k]] = found
            self.keys.append(keys)
            self.at.append(at)

    def learned(self, k: int, learn: list[bool]) -> np.ndarray:
        """Counts in the learning rows."""
        at = self.at[k]
        here = np.repeat(np.array(learn, bool), self.lengths)[: len(at)]
        return np.bincount(at[(at >= 0) & here], minlength=len(self.keys[k]))

    def parts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last n-gram of order k within each of order k + 1."""
        head, tail = np.zeros((2, len(self.keys[k])), np.int32)
        place = np.flatnonzero(self.at[k] >= 0)
        head[self.at[k][place]] = self.at[k - 1][place]
        tail[self.at[k][place]] = self.at[k - 1][place + 1]
        return head, tail


class Counted:
    """A block's n-grams with their counts, and who holds them: 0 and 1 several blocks (1: this one reports it), 2 this one only."""

    def __init__(self, block: pa.Table, answers: list[dict], buckets: int, order: int, triples: bool = True):
        self.grams = grams = Grams(block["text"].to_pylist(), order)
        self.n = [answered(answers, "a", k, buckets) for k in (0, 1)]
        self.held = [answered(answers, "b", k, buckets) for k in (0, 1)]
        self.head, self.tail = zip((None, None), grams.parts(1), grams.parts(2), strict=True)
        # a triple with a pair that no other block holds is in no other block: its own count is the whole
        self.shared = (self.held[1][self.head[2]] < 2) & (self.held[1][self.tail[2]] < 2)
        self.n.append(grams.learned(2, block["learn"].to_pylist()))
        self.held.append(np.full(len(self.shared), 2))
        if triples:
            for own, column in ((self.n[2], "a"), (self.held[2], "b")):
                own[self.shared] = answered(answers, column, 2, buckets)

    def histories(self) -> None:
        """Which n-grams are learned; by history of order k: its reported arcs, their counts, their last parts' counts; whether to ask."""
        self.kept, self.sums, self.asked = [self.n[0] > 0], [], []
        for k in (1, 2):
            head, tail = self.head[k], self.tail[k]
            self.kept.append(self.n[k] > 0)
            mine = self.kept[k] & (self.held[k] > 0)
            size = len(self.n[k - 1])
            self.sums.append([np.bincount(head[mine], weights=w, minlength=size) for w in (None, self.n[k][mine], self.n[k - 1][tail[mine]])])
            used = np.zeros(size, bool)
            used[head] = True
            self.asked.append(used & self.kept[k - 1] & (self.held[k - 1] < 2))


def answered(answers: list[dict], column: str, k: int, buckets: int) -> np.ndarray:
    """A block's n-grams in hash order are its buckets' n-grams in bucket order."""
    own = sorted((r["bucket"], r[column]) for r in answers if r["bucket"] // buckets == k)
    return np.concatenate([np.empty(0, np.int64), *(_unpack(x).astype(np.int64) for _, x in own)])


def _asked(block: int, k: int, bits: int, keys: np.ndarray, *values: np.ndarray) -> list[tuple]:
    """Rows for the buckets of order k: sorted keys as differences, and their values."""
    if not len(keys):
        return []
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    out = []
    for start, stop in zip([0, *cuts], [*cuts, len(keys)], strict=True):
        packed = [_pack(v[start:stop]) for v in values]
        out.append(((k << bits) + int(bucket[start]), block, _pack(np.diff(keys[start:stop], prepend=np.uint64(0))), *packed, *[None] * (3 - len(packed))))
    return out


def _count(bits: int, order: int):
    def count(group: pa.Table) -> pa.Table:
        """A block's distinct words and pairs by hash bucket, in hash order, with their counts in its learning rows."""
        grams, learn, rows = Grams(group["text"].to_pylist(), min(order, 2)), group["learn"].to_pylist(), []
        for k in (0, 1):
            rows += _asked(group["block"][0].as_py(), k, bits, grams.keys[k], grams.learned(k, learn))
        return _table(rows, ASKED)

    return count


def _count_triples(bits: int):
    def count(block: pa.Table, answer: pa.Table) -> pa.Table:
        """The same of the triples that other blocks may hold too."""
        if not block.num_rows:
            return _table([], ASKED)
        own = Counted(block, answer.to_pylist(), 1 << bits, 3, triples=False)
        return _table(_asked(block["block"][0].as_py(), 2, bits, own.grams.keys[2][own.shared], own.n[2][own.shared]), ASKED)

    return count


def _total(columns: str, report: bool):
    def total(group: pa.Table) -> pa.Table:
        """The answers: for each block the totals of its keys (report: and who holds them, see Counted); the bucket's distinct learned keys."""
        keys = [np.cumsum(_unpack(x), dtype=np.uint64) for x in group["keys"].to_pylist()]
        h, first, at = distinct_hashes(np.concatenate(keys))
        cuts = np.cumsum([len(x) for x in keys])[:-1]
        totals = []
        for c in columns:
            n = np.bincount(at, weights=np.concatenate([_unpack(x) for x in group[c].to_pylist()]), minlength=len(h)).astype(np.int64)
            totals.append(n[at])
        distinct, learned = int((n > 0).sum()), int(n.sum())
        if report:
            held = np.zeros(len(at), np.int64)
            held[first] = np.where(np.bincount(at) == 1, 2, 1)
            totals.append(held)
        packed = [[_pack(x) for x in np.split(t, cuts)] for t in totals] + [[None] * len(keys)] * (3 - len(totals))
        once = [[x] + [0] * (len(keys) - 1) for x in (distinct, learned)]
        return _table(list(zip(group["bucket"].to_pylist(), group["block"].to_pylist(), *packed, *once, strict=True)), ANSWERS)

    return total


def _cut(df: DataFrame, name: str) -> DataFrame:
    """written; the shuffled files behind it go at once, as the n-grams are several times the text."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return written(df, name)
    finally:
        conf.set(key, before)


def ngram_counts(blocked: DataFrame, bits: int, order: int = ORDER) -> DataFrame:
    """The answers to the blocks of (block, learn, text) from 2^bits buckets of each order; triples only where several blocks may hold them."""
    blocked = blocked.select("block", "learn", "text")
    counts = _cut(blocked.groupBy("block").applyInArrow(_count(bits, order), ASKED).groupBy("bucket").applyInArrow(_total("a", True), ANSWERS), "counts")
    if order < 3:
        return counts
    triples = blocked.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_count_triples(bits), ASKED)
    return counts.union(_cut(triples.groupBy("bucket").applyInArrow(_total("a", True), ANSWERS), "counts"))


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", learn: Column | None = None, order: int = ORDER,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document; see SCHEMA.  learn: rows to learn from (default: those not held out)."""
    out = held_out(F.col(doc_id))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), out.alias("held_out"), (~out if learn is None else learn).alias("learn"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    spark = docs.sparkSession
    size = text_bytes(rows, "text")
    blocks = max(shuffle_partitions(spark), size // block_bytes)
    bits = max(4, (size // block_bytes).bit_length())
    buckets = 1 << bits
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)))

    counts = ngram_counts(blocked, bits, order)
    # words and ends: all learned ones are in the buckets of the first order
    distinct, learned = (int(x or 0) for x in counts.where(F.col("bucket") < buckets).agg(F.sum("distinct"), F.sum("learned")).first())

    def histories(block: pa.Table, answer: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _table([], ASKED)
        own = Counted(block, answer.to_pylist(), buckets, order)
        own.histories()
        out = []
        for k, (ask, sums) in enumerate(zip(own.asked, own.sums, strict=True)):
            out += _asked(block["block"][0].as_py(), k, bits, own.grams.keys[k][ask], *(x[ask] for x in sums))
        return _table(out, ASKED)

    def score(block: pa.Table, answer: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _table([], SCHEMA)
        answers = answer.to_pylist()
        counted, summed = ([r for r in answers if r["summed"] == x] for x in (False, True))
        own = Counted(block, counted, buckets, order)
        own.histories()
        n, at = own.n, own.grams.at
        alone = (n[0] + 1) / (learned + distinct + 1)
        base = np.log10(alone)[at[0]]
        arcs_of, failures = [np.log10(alone)], []  # weights of the arcs of each order, and of the failure arcs of its states
        for k in (1, 2):
            head = own.head[k]
            arcs, going, lower = own.sums[k - 1]
            for sums, c in ((arcs, "a"), (going, "b"), (lower, "c")):
                sums[own.asked[k - 1]] = answered(summed, c, k - 1, buckets)
            left = 1 - (going - DISCOUNT * arcs) / np.maximum(n[k - 1], 1)
            # what the shorter history gives to the words that have arcs
            taken = (lower + arcs) / (learned + distinct + 1) if k == 1 else (lower - DISCOUNT * arcs) / np.maximum(n[0][own.tail[1]], 1)
            failures.append(np.where(arcs > 0, np.log10(np.maximum(left / (1 - taken), 1e-300)), 0))
            arcs_of.append(np.log10(np.where(own.kept[k], n[k] - DISCOUNT, 1) / np.maximum(n[k - 1][head], 1)))
        weight, pending = np.zeros(len(base)), np.ones(len(base), bool)
        for k in (2, 1):  # tokens in a state of order k - that is, after k tokens of their text - and without an arc so far
            gram = np.full(len(base), -1, np.int32)
            gram[k:] = at[k][: max(0, len(base) - k)]
            inside = np.flatnonzero(pending & (gram >= 0))
            taken = own.kept[k][gram[inside]]
            weight[inside] += np.where(taken, arcs_of[k][gram[inside]], failures[k - 1][own.head[k][gram[inside]]])
            pending[inside[taken]] = False
        weight += np.where(pending, base, 0)
        known = np.add.reduceat((n[0] > 0)[at[0]].astype(np.int64), own.grams.starts)
        sums = [np.add.reduceat(x, own.grams.starts).tolist() for x in (base, weight)]
        return _table(list(zip(block["doc_id"].to_pylist(), block["held_out"].to_pylist(), own.grams.lengths.tolist(), known.tolist(),
                               [learned] * len(known), *sums, strict=True)), SCHEMA)

    counts, texts = counts.drop("distinct", "learned"), blocked.select("block", "doc_id", "held_out", "learn", "text").groupBy("block")
    sums = texts.cogroup(counts.groupBy("block")).applyInArrow(histories, ASKED)
    sums = _cut(sums.groupBy("bucket").applyInArrow(_total("abc", False), ANSWERS), "sums").drop("distinct", "learned")
    answers = counts.withColumn("summed", F.lit(False)).unionByName(sums.withColumn("summed", F.lit(True)))
    return texts.cogroup(answers.groupBy("block")).applyInArrow(score, SCHEMA)
