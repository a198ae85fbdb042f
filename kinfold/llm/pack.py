"""Packing by Karmarkar-Karp multiway differencing.

Every document is tokenised whole, gets an end id and is cut into pieces; the pieces are spread over
windows of `capacity` ids.  Within a group of about GROUP_WINDOWS windows, every piece starts as a
partial partition (its size, 0, 0, ...).  The two partitions with the largest imbalance are merged
with opposing order, the heaviest window of one with the lightest of the other, until one is
left.  Its windows are nearly equal.  When the heaviest exceeds the capacity the group gets one window more
and is merged again.  Whole windows are cut from long documents first.

Groups end at GROUP_WINDOWS windows' ids or GROUP_PIECES pieces.  They are consecutive documents of one input partition, so there is no shuffle, no text crosses a
task and a lost task is simply run again with the same result; memory is bounded by one group.

A null text is an empty document (just the end id); an empty table gives no pieces; rows that repeat
an id are separate documents; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, keep_only, kept

CAPACITY = 4096
MAX_PIECE = 2048
GROUP_WINDOWS = 192
#: A group also ends at so many pieces, as each starts as a partition of its own.
GROUP_PIECES = 20_000
END_ID = 2
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long")

# ids of plain words straight from the model: letters of Latin-1 stay themselves under the
# tokenizer's normaliser (NFC, lower case), and its splitter cuts exactly at these runs
_RUNS = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ÿ]+|[0-9²³¹¼½¾]|[^A-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼½¾]+")
_PLAIN = re.compile("[!-&(-;=~-~?-{}¡-¬®-ÿ]*")
_MARKS = b".,;:!?"


def _byte_alphabet() -> dict[int, str]:
    """The byte-to-character table of byte-level BPE: printable bytes stay, the others follow from 256."""
    stay = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in stay]
    return {b: chr(b) for b in stay} | {b: chr(256 + n) for n, b in enumerate(rest)}


class WordIds(dict):
    """word (bytes without white space) or run of one -> its ids as little-endian 32-bit bytes; cleared when large."""

    LIMIT = 400_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.alphabet = Tokenizer.from_file(path), _byte_alphabet()
        self.model = self.tokenizer.model
        own = json.loads(self.tokenizer.to_str())
        # the rules above hold for this splitter and normaliser; texts go to any other vocabulary's tokenizer whole
        kinds = [x["type"] for x in (own["normalizer"] or {}).get("normalizers", [])]
        self.by_word = own["model"]["type"] == "BPE" and own["model"].get("end_of_word_suffix") == "</w>" and kinds == ["NFC", "Replace", "Lowercase"]

    def _keep(self, key: bytes, ids: bytes) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        self[key] = ids
        return ids

    def _run(self, run: bytes) -> bytes:
        """The ids of a run in lower case, which are also those of a word that is just this run."""
        found = self.get(run)
        if found is None:
            text = run.decode() if run.isalpha() else run.decode("latin-1").translate(self.alphabet)
            ids = [t.id for t in self.model.tokenize(text)]
            found = self._keep(run, struct.pack(f"<{len(ids)}I", *ids))
        return found

    def __missing__(self, word: bytes) -> bytes:
        run = word.lower()
        if run.isalpha():  # the usual cases first: ASCII letters, and these with one mark
            ids = self._run(run)
            return ids if run == word else self._keep(word, ids)
        if run[-1] in _MARKS and run[:-1].isalpha():
            return self._keep(word, self._run(run[:-1]) + self._run(run[-1:]))
        text = word.decode()
        if _PLAIN.fullmatch(text):
            return self._keep(word, b"".join(self._run(r.encode()) for r in _RUNS.findall(text.lower())))
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return self._keep(word, struct.pack(f"<{len(found)}I", *found))

    def of(self, text: bytes) -> bytes:
        if not self.by_word:
            ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.__getitem__, text.split()))


#: One table per Python worker and vocabulary; entries are a pure function of the word.
_TABLES: dict[str, WordIds] = kept("word ids", {})


def word_ids(path: str) -> WordIds:
    if path not in _TABLES:
        _TABLES[path] = WordIds(path)
    return _TABLES[path]


def difference(sizes: list[int], windows: int) -> list[int]:
    """The window of each item after Karmarkar-Karp differencing of all items into `windows` parts."""
    if not sizes:
        return []
    loads: list[np.ndarray] = []
    sources: list[tuple] = []  # a leaf's item, or the two merged nodes and the slots they came from
    heap: list[tuple[int, int]] = []
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    for item in order:
        load = np.zeros(windows, np.int64)
        load[0] = sizes[item]
        heapq.heappush(heap, (-sizes[item] if windows > 1 else 0, len(loads)))
        loads.append(load)
        sources.append((item,))
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        total = loads[a] + loads[b][::-1]
        slots = np.argsort(-total, kind="stable")
        total = total[slots]
        loads[a] = loads[b] = None  # type: ignore[call-overload]
        heapq.heappush(heap, (-int(total[0] - total[-1]), len(loads)))
        loads.append(total)
        sources.append((a, b, slots))
    place = [0] * len(sizes)
    todo = [(len(loads) - 1, np.arange(windows))]
    while todo:
        node, at = todo.pop()  # at[s]: the final window of the node's slot s
        if len(sources[node]) == 1:
            place[sources[node][0]] = int(at[0])
            continue
        a, b, slots = sources[node]
        own = np.empty(windows, np.int64)
        own[slots] = at
        todo += [(a, own), (b, own[::-1])]
    return place


def windows_of(sizes: list[int], capacity: int) -> list[int]:
    """The window of each item; as few windows as the differencing can keep within the capacity."""
    count = max(1, -(-sum(sizes) // capacity))
    while True:
        place = difference(sizes, count)
        loads = np.bincount(place, weights=sizes, minlength=count)
        if not sizes or loads.max() <= capacity:
            return place
        count += 1


def pieces_of(total: int, capacity: int, max_piece: int) -> list[tuple[int, int]]:
    """(start, length): whole windows, then pieces of max_piece, then the rest as a large and a small piece.

    The small one, an eighth of the rest, is what lets the differencing level the windows.
    """
    lengths = [capacity] * (total // capacity)
    rest = total % capacity
    lengths += [max_piece] * (rest // max_piece)
    rest %= max_piece
    lengths += [n for n in (rest - rest // 8, rest // 8) if n]
    starts = np.cumsum([0, *lengths])
    return list(zip(starts[:-1].tolist(), lengths, strict=True))


def _packer(tokens: Callable[[], WordIds], capacity: int, max_piece: int, group_windows: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("word ids")
        table, schema = tokens(), _arrow_schema()
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []  # doc_id, start, length, crc, doc_tokens
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, rows, held
            parts = [i for i, r in enumerate(rows) if r[2] < capacity]
            place = windows_of([rows[i][2] for i in parts], capacity)
            by_window: dict[int, list[int]] = {}
            for i, w in zip(parts, place, strict=True):
                by_window.setdefault(w, []).append(i)
            out = []
            for members in [*([i] for i, r in enumerate(rows) if r[2] == capacity), *by_window.values()]:
                filled, total = 0, sum(rows[i][2] for i in members)
                for i in members:
                    out.append((*rows[i], sequence, filled, total))
                    filled += rows[i][2]
                sequence += 1
            rows, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

        for part, texts in chunks(batches, keep="word ids"):
            for doc, text in zip(part.column(0).to_pylist(), texts, strict=True):
                ids = memoryview(table.of(text) + struct.pack("<I", END_ID))
                total = len(ids) // 4
                for start, length in pieces_of(total, capacity, max_piece):
                    rows.append((doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total))
                    held += length
                if held >= group_windows * capacity or len(rows) >= GROUP_PIECES:
                    yield flush()
        if rows:
            yield flush()

    return pack


def _arrow_schema() -> pa.Schema:
    return pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


def _table(path: str | None):
    def load() -> WordIds:
        import public_tokenizers

        return word_ids(path or public_tokenizers.path("word_bpe_49k.json"))

    return load


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           capacity: int = CAPACITY, max_piece: int = MAX_PIECE, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """One row per piece; see SCHEMA.  vocabulary: a tokenizer file that every executor has."""
    rows = bounded_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(_packer(_table(vocabulary), capacity, max_piece, group_windows), SCHEMA)
