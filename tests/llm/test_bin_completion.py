"""Bin completion: the search against the optimum, the ids against the tokenizer, the pieces against every document."""

import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinfold.llm import bin_completion as bc

from .fixtures import corpus, empty, frame


def optimum(items, capacity):
    """Fewest bins, by trying every piece in every bin."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins) if b + items[i] <= capacity}.values():
            bins[j] += items[i]
            go(i + 1, bins)
            bins[j] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def counted(items, capacity):
    return np.bincount(np.array(items, int), minlength=capacity + 1)


def check_plan(plan, counts, capacity):
    used = np.zeros(capacity + 1, int)
    for filling, n in plan:
        assert n > 0 and 0 < sum(s * t for s, t in filling) <= capacity
        for s, t in filling:
            used[s] += t * n
    assert (used == counts).all()
    return sum(n for _, n in plan)


@given(st.sampled_from([10, 20, 50, 100]).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=9))))
@settings(max_examples=150, deadline=None)
def test_small_plans_are_optimal(case):
    capacity, items = case
    counts = counted(items, capacity)
    least = optimum(items, capacity)
    assert bc.least_bins(counts, capacity) <= least == check_plan(bc.plan(counts, capacity), counts, capacity)
    assert check_plan(bc.best_fit(counts, capacity), counts, capacity) >= least


def test_search_beats_its_incumbent():
    rng = np.random.default_rng(0)
    for sizes in (rng.integers(250, 600, 20_000), np.clip(rng.lognormal(5.8, 0.8, 50_000).astype(int) + 1, 1, 1024)):
        counts = counted(sizes, 1024)
        found, first = (check_plan(p, counts, 1024) for p in (bc.plan(counts, 1024, nodes=1500), bc.best_fit(counts, 1024)))
        assert bc.least_bins(counts, 1024) <= found < first
    assert check_plan(bc.plan(counts, 1024, nodes=0), counts, 1024) == first  # out of nodes: the incumbent


def test_dominance():
    assert bc.dominates(((6, 1),), ((3, 2),)) and not bc.dominates(((3, 2),), ((6, 1),))
    assert bc.dominates(((5, 1), (4, 1)), ((4, 1), (3, 1), (1, 2))) and not bc.dominates(((5, 1), (4, 1)), ((3, 3),))
    # 6 + 4 fills a bin of 10: no other filling beside the 6 is needed
    assert bc.fillings(counted([6, 4, 3, 2, 1, 1], 10), 6, 10, 10) == [(((4, 1),), 0)]


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path("byte_bpe_50k.json"))


PARTS = ["a", "B", "'s", "'", " ", "  ", "\n", "\n\n", "\t", "\x0b", "é", "é", " ", " ", "\u0085", "\x1c", "1", "½", "<|endoftext|>", "<|", "字", "!!", "the ", " of"]


@given(st.lists(st.sampled_from(PARTS) | st.characters(codec="utf-8"), max_size=16).map("".join))
@settings(max_examples=500, deadline=None)
def test_ids_are_the_tokenizers(text):
    import public_tokenizers

    table = bc.byte_ids(public_tokenizers.path("byte_bpe_50k.json"))
    ids = table.tokenizer.encode(text, add_special_tokens=False).ids
    assert table.ranked and table.of(text.encode()) == struct.pack(f"<{len(ids)}I", *ids)


def test_long_text_in_slices(tokenizer, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(bc, "SLICE", 50)
    pick = random.Random(4)
    text = "".join(pick.choice(PARTS[:10] + ["word ", " other"]) for _ in range(3000)) + "x" * 500
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    assert bc.byte_ids(public_tokenizers.path("byte_bpe_50k.json")).of(text.encode()) == struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packed_pieces_rebuild_every_document(spark, tokenizer, capacity):
    rows = [*corpus(2), (9000, "<|endoftext|> and more"), *((9001 + i, "same words") for i in range(50))]
    out = bc.packed(frame(spark, rows), capacity=capacity).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    want = defaultdict(list)
    lengths = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, bc.END_ID]
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[doc].append((k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
            lengths.append(b - a)
    assert {d: sorted(p) for d, p in pieces.items()} == {d: sorted(p) for d, p in want.items()}
    assert len(sequences) == check_plan(bc.plan(counted(lengths, capacity), capacity), counted(lengths, capacity), capacity)
    assert len(sequences) <= 1.02 * -(-sum(lengths) // capacity) + 1


def test_same_places_whatever_the_partitions(spark):
    rows = corpus(3)
    for parts in (1, 7):
        out = bc.packed(frame(spark, rows, parts), capacity=64)
        assert out.select("sequence_id", "offset").distinct().count() == out.count()
    assert bc.packed(empty(spark)).collect() == []
