"""Conversation prefix trie against brute force, whatever the layers, runs and partitions; the radix tree against a dict."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinfold.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, id string, pos string, layer string, key string, context string"


def brute(rows):
    """The contract with plain lists."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    for c, turns in own.items():
        turns.sort(key=lambda x: (*x[:2], md5_of(*x[2:])))
        own[c] = [x[2:] for x in turns]
    members, ended = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h, source = zlib.crc32(str(c).encode()) % 4, c - int(abs(c) % 20 * (1 if c >= 0 else -1))
        seq = tuple(own.get(source, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ended[seq].append(c)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * words
    return sorted(((m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, ended[k])).encode()).hexdigest()) for k, m in members.items()), key=repr)


def md5_of(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def found(spark, rows, parts=4, **kw):
    table = spark.createDataFrame([(*r, *"xxxxx") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in pt.conversation_trie(table, **kw).collect()), key=repr)


def conversations(seed, n=60, longest=7):
    pick = random.Random(seed)
    rows, seen = [], [[("user", "hello there"), ("assistant", "hi")]]
    for c in pick.sample(range(-30, 150), n):
        turns = list(pick.choice(seen))[: pick.randrange(6)]
        while len(turns) < pick.randrange(longest):
            turns.append((pick.choice(["user", "assistant", None]), pick.choice(["a b c", "a  b\tc", "", None, "x" * 40, "one", "two words", "é ü"])))
        seen.append(turns)
        rows += [(c, t * 100 - 50, *x) for t, x in enumerate(turns)]
    return rows


@pytest.mark.parametrize("seed, kw", [(1, {}), (2, {"layer_turns": 2, "run": 7}), (3, {"layer_turns": 1, "run": 1}), (4, {"layer_turns": 3, "run": 1000})])
def test_against_brute_force(spark, seed, kw):
    rows = conversations(seed)
    want = brute(rows)
    assert len(want) > 40 and found(spark, rows, **kw) == want


def test_hot_conversation_first_turn_and_copies(spark):
    long = [(400, t, "user", f"turn {t % 7}") for t in range(700)]  # three layers, and three blocks of turn numbers
    rows = long + [(c, t, "user", x) for c in range(401, 700) for t, x in enumerate(["same start", "same end" if c % 3 else f"end {c}"])]
    assert found(spark, rows, run=40) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "no conversation"), (20, None, "user", "null turn first"), (20, -5, "user", "b"), (20, -5, "user", "a"), (20, 9, None, None),
            (20, 9, None, None), (21, 1, "", ""), (22, 1, "a", "b:c"), (23, 1, "a", "b:c"), (45, 3, "user", "word " * 5000), (-1, 1, "x", "y")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, rows[:1]) == []


@given(st.lists(st.lists(st.integers(0, 300), max_size=4), max_size=400), st.integers(1, 2))
@settings(max_examples=60, deadline=None)
def test_radix_tree_is_a_sorted_dict(keys, width):
    root, want = pt.Node(b""), {}
    for i, key in enumerate(keys):
        own = b"".join((k % 256 ** width).to_bytes(width, "big") for k in key)
        pt.insert(root, own, i)
        want[own] = i
    got, stack = [], [(root, root.path)]
    while stack:
        node, prefix = stack.pop()
        assert len(node.ordered()) <= node.room and node.room in (4, 16, 48, 256)
        if node.value is not None:
            got.append((prefix, node.value))
        stack += [(c, prefix + bytes([b]) + c.path) for b, c in reversed(node.ordered())]
    assert got == sorted(want.items())


def test_layouts_grow_and_paths_split():
    root = pt.Node(b"")
    rooms = []
    for i in range(200):
        pt.insert(root, bytes([i, 1, 2, 3]), i)
        rooms.append(root.room)
    assert [rooms.index(r) + 1 for r in (4, 16, 48, 256)] == [1, 5, 17, 49]
    assert root.get(7).path == b"\1\2\3" and root.get(250) is None
    pt.insert(root, bytes([7, 1, 9, 9]), "split")
    assert root.get(7).path == b"\1" and [b for b, _ in root.get(7).ordered()] == [2, 9]
