"""Benchmark decontamination by pigeonhole edit matching.

A test item matches a document when some substring of the document is within the item's error budget
of k = ERRORS * length edits (both lower-cased, every run of other characters than letters, digits and _ as one
space).  The item is cut into k + 1 pieces: k edits leave one of them whole, so every match holds an
exact piece hit.  All pieces of a block of items are found in one pass of an Aho-Corasick automaton
over the whole text, and the surroundings of a hit are verified with Myers' bit-parallel distance.

The test items are a stated query set: they are taken in blocks of at most BLOCK_CHARS characters (an
automaton of bounded size) and each block is held against all documents.  There is no shuffle.

Items shorter than MIN_CHARS after normalisation match exactly, as whole words.  Items that are null or have no word
match nothing; an item_id is given back as it is, null too.  A null or empty text
matches nothing; repeated rows repeat their result; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, keep_only, kept

ERRORS = 0.06
MIN_CHARS = 24
BLOCK_CHARS = 2_000_000
SCHEMA = "doc_id long, item_id long, distance long, error_budget long, item_chars long, match_start long, match_end long"
_WORDS = re.compile(r"\w+")


def normalise(text: str) -> str:
    return " ".join(_WORDS.findall(text.lower()))


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of errors + 1 near-equal pieces."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(least distance of the pattern to a substring of the text, that substring's first possible end)."""
    size = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best = (size, 0)
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        vertical = eq | minus
        eq |= (((eq & plus) + plus) ^ plus)
        horizontal = minus | ~(eq | plus) & full
        down = plus & eq
        if horizontal & high:
            score += 1
        elif down & high:
            score -= 1
        horizontal = horizontal << 1 & full
        plus = (down << 1 & full) | ~(vertical | horizontal) & full
        minus = horizontal & vertical
        if score < best[0]:
            best = (score, at)
    return best


class Matcher:
    """All items of one block: the automaton of their pieces, and the verification."""

    def __init__(self, items: list[tuple[int | None, str]], errors: float = ERRORS, min_chars: int = MIN_CHARS):
        import ahocorasick

        self.items, self.automaton = [], ahocorasick.Automaton()
        for item_id, text in items:
            item = normalise(text or "")
            if not item:
                continue
            budget = int(len(item) * errors) if len(item) >= min_chars else -1  # -1: whole words only
            for offset, piece in pieces(item, max(0, budget)):
                self.automaton.get(piece, None) or self.automaton.add_word(piece, (piece, []))
                self.automaton.get(piece)[1].append((len(self.items), offset))
            self.items.append((item_id, item, budget))
        if self.items:
            self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(item_id, distance, budget, item length, start, end) of the best match of each item that matches."""
        if not self.items or not text:
            return
        page = normalise(text)
        best: dict[int, tuple[int, int, int]] = {}
        tried: dict[int, tuple[int, int]] = {}
        for end, (piece, places) in self.automaton.iter(page):
            for number, offset in places:
                _, item, budget = self.items[number]
                start = end + 1 - len(piece) - offset
                if budget < 0:
                    if number not in best and page[start - 1 : start] in ("", " ") and page[end + 1 : end + 2] in ("", " "):
                        best[number] = (0, start, end + 1)
                    continue
                low, high = start - budget, start + len(item) + budget
                if number in best and best[number][0] == 0 or tried.get(number, (1, 0))[0] <= low and high <= tried.get(number, (1, 0))[1]:
                    continue
                # a wider window than this hit needs, so that the item's next hits fall inside it
                low, high = max(0, low - budget), min(len(page), high + budget)
                tried[number] = (low, high)
                distance, stop = myers(item, page[low:high])
                if distance <= budget and distance < best.get(number, (budget + 1,))[0]:
                    _, back = myers(item[::-1], page[low : low + stop][::-1])
                    best[number] = (distance, low + stop - back, low + stop)
        for number, (distance, start, stop) in sorted(best.items()):
            item_id, item, budget = self.items[number]
            yield item_id, distance, max(0, budget), len(item), start, stop


_MATCHERS: dict[int, Matcher] = kept("matchers", {})


def _matcher(items: list[tuple[int | None, str]], errors: float) -> Matcher:
    key = hash((tuple(items), errors))
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items, errors)
    return _MATCHERS[key]


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about block_chars characters, one block at a time."""
    rows = bounded_batches(items).select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    count = max(1, -(-total // block_chars))
    for block in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block) if count > 1 else rows
        yield sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", errors: float = ERRORS,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item that it holds, with the best match's distance and place in the normalised text."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def held_against(block: list[tuple[int | None, str]]) -> DataFrame:
        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keep_only("matchers")
            matcher = _matcher(block, errors)
            schema = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])
            for part, texts in chunks(batches, keep="matchers"):
                out = [(doc, *found) for doc, t in zip(part.column(0).to_pylist(), texts, strict=True) for found in matcher.find(t)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

        return rows.mapInArrow(match, SCHEMA)

    return reduce(DataFrame.unionByName, map(held_against, item_blocks(items, block_chars=block_chars)))


def contaminated(text: Column, items: DataFrame, errors: float = ERRORS, block_chars: int = BLOCK_CHARS) -> Column:
    """Whether the text holds any item: a condition for filters that keep a document's other columns."""
    def block_condition(block: list[tuple[int | None, str]]) -> Column:
        @F.pandas_udf("boolean")
        def holds(texts: pd.Series) -> pd.Series:
            keep_only("matchers")
            matcher = _matcher(block, errors)
            return texts.map(lambda t: next(matcher.find(t or ""), None) is not None)

        return holds(F.coalesce(text, F.lit("")))

    return reduce(Column.__or__, map(block_condition, item_blocks(items, block_chars=block_chars)))
