"""Best-fit packing by bin completion, a branch-and-bound over the counts of each length.

1. Every document is tokenised whole and gets an end id.  Only one longer than `capacity` is cut: pieces of
   `capacity` ids, of which the first takes the remainder.  The pieces are written to the shared folder with their
   place among the pieces of equal length of their input partition.
2. Pieces of equal length are alike to a packer, so what is searched is one count for every length: `capacity`
   numbers, however many documents there are.  `plan` starts from best-fit decreasing as the incumbent, and then
   completes bins: around the largest length left it enumerates the fillings that no other filling dominates (Martello
   and Toth), those that waste least first, and takes the chosen one as often as the counts allow.  A branch ends when
   its waste exceeds what one sequence fewer than the incumbent could waste, or when the L2 bound of the rest reaches
   the incumbent.  It stops at a proven optimum or after NODES nodes, with the best plan found by then.
3. A plan says which ranks of a length go to which sequences.  A piece's rank is its place in its partition plus the
   pieces of that length in earlier partitions, so the same pieces always go to the same places.

Only the counts (at most `capacity` rows) and the plan (a few thousand fillings of at most 44 different lengths) are on
the driver; both are bounded by the capacity, not by the input.  A length that a third of all pieces have is one count.

A null text is an empty document (just the end id); an empty table gives no pieces; rows that repeat an id are separate
documents; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, kept, written
from .pack import _byte_alphabet

CAPACITY = 1024
END_ID = 2
#: Search nodes, and fillings tried at a node.  They bound the search, not the documents: all are packed in any case.
NODES = 4000
FILLINGS = 12
#: With at most so many pieces left a filling is taken once at a time, so that the search is exact.
SINGLE_STEPS = 40
SLICE = 1 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

#: (length, times) pairs by falling length, and how many sequences are filled so
Filling = tuple[tuple[int, int], ...]


# ---------------------------------------------------------------- tokens

_CHUNKS = re.compile(rb" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
#: a word of Latin-1 letters and the marks after it are one piece of the splitter each
_WORD = re.compile(rb"( ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")
_CUT = re.compile(rb"[^ \t-\r] [^ \t-\r]")
#: white space that is not ASCII's six
_ODD = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


class Unusual(Exception):
    """A chunk that may depend on what stands beside it."""


class ByteIds(dict):
    """Word (what stands between two single spaces) -> the ids of a space and the word, as little-endian 32-bit bytes.

    The byte-level splitter begins a piece at a space after a character that is not white space, so texts can be cut
    there, and within a word at _CHUNKS.  Other white space and special tokens break this rule: texts with them go
    to the tokenizer whole.  A piece's merges follow the vocabulary's ranks.
    """

    LIMIT = 600_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.bare = Tokenizer.from_file(path), {}  # bare: chunks without a space before them
        own = json.loads(self.tokenizer.to_str())
        self.special = [x["content"].encode() for x in own["added_tokens"]]
        self.ranked = None if any(re.search(rb"\s", x) for x in self.special) else _ranked(own)

    def __missing__(self, word: bytes) -> bytes:
        found = self.chunk(b" " + word)
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = found
        return found

    def chunk(self, chunk: bytes) -> bytes:
        word = _WORD.fullmatch(chunk)
        if word is None:
            if _ODD.search(chunk) or any(x in chunk for x in self.special):
                raise Unusual
            parts = _CHUNKS.findall(chunk)
            if len(parts) > 1:
                return b"".join(map(self._part, parts))
            return array("I", self.ranked.encode_ordinary(chunk.decode())).tobytes()
        if word[2]:
            return self._part(word[1]) + self._part(word[2])
        return array("I", self.ranked._encode_single_piece(chunk)).tobytes()

    def _part(self, chunk: bytes) -> bytes:
        if chunk[:1] == b" " and chunk[1:]:
            return self[chunk[1:]]
        found = self.bare.get(chunk)
        if found is None:
            if len(self.bare) >= self.LIMIT // 8:
                self.bare.clear()
            found = self.bare[chunk] = self.chunk(chunk)
        return found

    def of(self, text: bytes) -> bytes:
        out, at = [], 0
        try:
            while self.ranked is not None and at < len(text):  # a long text in slices that end before a space between words
                cut = _CUT.search(text, at + SLICE) if len(text) - at > 2 * SLICE else None
                end = cut.start() + 1 if cut else len(text)
                part = text[at:end]
                if b"  " in part:
                    out += map(self._part, _CHUNKS.findall(part))
                else:
                    first, *words = part.split(b" ")
                    out.append(self._part(first) if first else b"")
                    out += map(self.__getitem__, words)
                at = end
        except Unusual:
            at = 0
        if at < len(text):
            ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(out)


def _ranked(own: dict):
    """The vocabulary as ranks (a tiktoken Encoding), if it is a plain byte-level BPE whose ids rise with its merges."""
    import public_tokenizers
    import tiktoken

    model, split = own["model"], own["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and own["normalizer"] is None and split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
    if not plain or model.get("ignore_merges") or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    byte_of, special = {c: b for b, c in _byte_alphabet().items()}, {x["content"] for x in own["added_tokens"]}
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(b <= a for a, b in zip(made, made[1:])) or len(made) + 256 != sum(t not in special for t in model["vocab"]):
        return None
    ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


#: One table per Python worker and vocabulary; entries are a pure function of the chunk.
_TABLES: dict[str, ByteIds] = kept("byte ids", {})


def byte_ids(path: str) -> ByteIds:
    if path not in _TABLES:
        _TABLES[path] = ByteIds(path)
    return _TABLES[path]


def _table(path: str | None) -> Callable[[], ByteIds]:
    def load() -> ByteIds:
        import public_tokenizers

        return byte_ids(path or public_tokenizers.path("byte_bpe_50k.json"))

    return load


# ---------------------------------------------------------------- the search

def least_bins(counts: np.ndarray, capacity: int) -> int:
    """Martello and Toth's L2: no packing of counts[length] pieces has fewer bins."""
    sizes = np.arange(capacity + 1)
    n, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * sizes)])  # of lengths below i
    half = capacity // 2
    a = np.arange(half + 1)  # lengths of a..half are small; those over capacity - a stand alone
    big, big_sum = n[capacity - a + 1] - n[half + 1], total[capacity - a + 1] - total[half + 1]
    small = total[half + 1] - total[a]
    more = np.maximum(0, -(-(small - (big * capacity - big_sum)) // capacity))
    return int((n[capacity + 1] - n[capacity - a + 1] + big + more).max())


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing, equal bins at a time: (filling, how many bins)."""
    rooms: list[int] = []  # the different rooms of open bins, ascending
    open_bins: dict[int, list[tuple[Filling, int]]] = {}

    def put(filling: Filling, n: int, room: int) -> None:
        if n:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append((filling, n))

    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                put((), left, capacity)
                continue
            room = rooms[at]
            filling, n = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
            times = room // size  # the bin stays the tightest until the size no longer fits
            full = min(n, left // times)
            put((*filling, (size, times)), full, room - times * size)
            left -= full * times
            rest = n - full
            if rest and left and full == left // times == 0 or rest and 0 < left < times:
                put((*filling, (size, left)), 1, room - left * size)
                rest, left = rest - 1, 0
            put(filling, rest, room)
    return [(f, n) for group in open_bins.values() for f, n in group if f]


def dominates(a: Filling, b: Filling) -> bool:
    """True if b's pieces can be split into groups that fit into a's pieces: a can stand wherever b does."""
    rooms = [s for s, t in a for _ in range(t)]
    pieces = [s for s, t in b for _ in range(t)]
    if sum(rooms) < sum(pieces) or len(rooms) > len(pieces) or len(pieces) > 12:
        return False

    def place(i: int) -> bool:
        if i == len(pieces):
            return True
        for j, room in enumerate(rooms):
            if room >= pieces[i] and room not in rooms[:j]:
                rooms[j] -= pieces[i]
                if place(i + 1):
                    return True
                rooms[j] += pieces[i]
        return False

    return place(0)


def fillings(counts: np.ndarray, largest: int, capacity: int, allowed: int, limit: int = FILLINGS) -> list[tuple[Filling, int]]:
    """(what goes beside one piece of the largest length, waste): undominated, by rising waste, larger lengths first."""
    room = capacity - largest
    sizes = [s for s in (np.flatnonzero(counts[: room + 1])[::-1]).tolist() if counts[s] - (s == largest) > 0]
    have = [min(int(counts[s]) - (s == largest), room // s) for s in sizes]
    if not sizes:
        return [((), room)] if room <= allowed else []
    mask = (1 << (room + 1)) - 1
    reach = [1] * (len(sizes) + 1)  # reach[i]: sums of lengths i and on, as bits
    for i in range(len(sizes) - 1, -1, -1):
        bits, left, step = reach[i + 1], have[i], 1
        while left:
            take = min(step, left)
            bits |= (bits << (take * sizes[i])) & mask
            left, step = left - take, 2 * step
        reach[i] = bits
    out: list[tuple[Filling, int]] = []
    for total in range(room, max(0, room - allowed) - 1, -1):
        if not reach[0] >> total & 1:
            continue
        stack: list[tuple[int, int, Filling]] = [(0, total, ())]
        while stack and len(out) < limit:
            i, rest, filling = stack.pop()
            while rest and i < len(sizes) and (sizes[i] > rest):
                i += 1
            if not rest:
                used = dict(filling)
                if not any(h > used.get(s, 0) for s, h in zip(sizes, have) if s <= room - total):  # else a superset is better
                    out.append((filling, room - total))
                continue
            for times in range(0, min(have[i], rest // sizes[i]) + 1):  # the last pushed, most of the largest, comes first
                if reach[i + 1] >> (rest - times * sizes[i]) & 1:
                    stack.append((i + 1, rest - times * sizes[i], (*filling, (sizes[i], times)) if times else filling))
        if len(out) >= limit:
            break
    chosen: list[tuple[Filling, int]] = []
    for filling, waste in out:
        if not any(dominates(f, filling) for f, _ in chosen):
            chosen = [(f, w) for f, w in chosen if not dominates(filling, f)] + [(filling, waste)]
    return chosen


def plan(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES, limit: int = FILLINGS) -> list[tuple[Filling, int]]:
    """(filling, how many sequences), using up counts[length] pieces of each length; see the module."""
    counts = np.asarray(counts, np.int64).copy()
    total = int((counts * np.arange(capacity + 1)).sum())
    best = best_fit(counts, capacity)
    bins, least = sum(n for _, n in best), least_bins(counts, capacity)
    # a branch: counts left, sequences so far, waste so far, the choices that led here
    stack: list[tuple[np.ndarray, int, int, tuple | None]] = [(counts, 0, 0, None)]
    while stack and bins > least and nodes > 0:
        left, made, waste, path = stack.pop()
        nodes -= 1
        if not left.any():
            if made < bins:
                bins, best = made, []
                while path:
                    path, filling, times = path
                    best.append((filling, times))
            continue
        allowed = (bins - 1) * capacity - total - waste
        if allowed < 0 or made + least_bins(left, capacity) >= bins:
            continue
        largest = int(np.flatnonzero(left)[-1])
        alone = left.sum() <= SINGLE_STEPS
        branches = []
        for filling, lost in fillings(left, largest, capacity, allowed, limit):
            use = dict(filling)
            use[largest] = use.get(largest, 0) + 1
            times = min(int(left[s]) // t for s, t in use.items())
            times = 1 if alone else max(1, min(times, allowed // lost) if lost else times)
            rest = left.copy()
            for s, t in use.items():
                rest[s] -= t * times
            branches.append((rest, made + times, waste + lost * times, (path, tuple(sorted(use.items(), reverse=True)), times)))
        stack += branches[::-1]
    return best


# ---------------------------------------------------------------- the job

def _cutter(tokens: Callable[[], ByteIds], capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part = tokens(), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end = struct.pack("<I", END_ID)
        for rows, texts in chunks(batches, keep="byte ids"):
            out = []
            for doc, text in zip(rows.column(0).to_pylist(), texts, strict=True):
                ids = memoryview(table.of(text) + end)
                total, start, piece = len(ids) // 4, 0, 0
                while start < total:
                    length = (total - start) % capacity or capacity  # only the first can be shorter
                    out.append((doc, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, seen[length]))
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            yield _batch(out, PIECES)

    return cut


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = [(c.split()[0], pa.int32() if c.endswith(" int") else pa.int64()) for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], schema=pa.schema(kinds))


def _ranges(fillings_of: list[tuple[Filling, int]]) -> list[np.ndarray]:
    """The plan by length and first rank: key (length and rank in one), length, first sequence, times, first offset."""
    rows, taken, sequence = [], {}, 0
    for filling, n in fillings_of:
        offset = 0
        for size, times in filling:
            first = taken.get(size, 0)
            rows.append(((size << 48) + first, size, sequence, times, offset))
            taken[size] = first + n * times
            offset += size * times
        sequence += n
    return list(np.array(sorted(rows), np.int64).reshape(-1, 5).T)


def _placer(ranges: list[np.ndarray]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, size, sequence, times, offset = ranges
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            own = (length << 48) + rank
            at = np.searchsorted(key, own, "right") - 1
            nth = own - key[at]
            arrays = [*batch.columns[:5], pa.array(sequence[at] + nth // times[at]), pa.array(offset[at] + nth % times[at] * size[at])]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return place


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """One row per piece; see SCHEMA.  vocabulary: a tokenizer file that every executor has."""
    rows = bounded_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    pieces = written(rows.mapInArrow(_cutter(_table(vocabulary), capacity), PIECES), "completion-pieces")
    cells = written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "completion-cells")
    counts = np.zeros(capacity + 1, np.int64)
    for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(_placer(_ranges(plan(counts, capacity, nodes))), SCHEMA)
