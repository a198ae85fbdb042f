"""Prefix trie of conversations: adaptive radix trees over fixed-width big-endian turn ids.

A turn's id is 20 bytes, all big-endian: the 128-bit MD5 of its role and text, and the number of words of the text.  A
conversation is the string of its turns' ids, and a node of the trie is a prefix of whole ids.

1. Turns get their place in the conversation from counts of (conversation, block of TURNS turn numbers) and a rank within
   the block, so that a conversation with a third of all rows is spread over many tasks.  Texts never leave the first scan.
2. Conversations are cut into layers of `layer_turns` turns.  A segment's context is a 128-bit hash of all segments before
   it; segments of a layer with the same context stand in the same tree.  So no row, key or list grows with a
   conversation.  A last segment may be empty.
3. Equal segments are counted first (a partial aggregate): a conversation that a third of all others copy is one row.
4. From the deepest layer up, segments are dealt out by ranges of (context, key).  A task builds radix trees of at most
   `run` segments at a time, with nodes of 4, 16, 48 and 256 places and compressed paths, and walks them; only depths that
   are whole turns emit nodes.  A node off the paths of the run's first and last segment lies in this run alone and is
   complete.  The others, two paths a run, are open: they come with what their closed children sum up to, and are
   added up over runs, then over their own open descendants.  So a very common first turn is split like any other range.
5. The tree of a layer hangs below the last node of the segment that leads to its context: its root's totals are joined
   to that segment when the layer above is built.  The driver takes one step for each layer, that is for
   every `layer_turns` turns of the longest conversation, and sees only that number.
6. The ids of conversations that end in a node are joined to strings of at most END_BLOCK ids first; one digest reads
   these in order, batch by batch.

Turns of one conversation with the same turn number are ordered by their ids.  A null role or text is empty.  Rows without a
conv_id belong to no conversation and take no part.  Repeated rows are turns of their own.  An empty table
gives an empty result, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, keep_only, shuffle_partitions, written

TURNS = 256
LAYER_TURNS = 256
RUN = 20_000
END_BLOCK = 4096
WIDTH = 20
WORDS = r"[^ \t-\r]+"
ROOT = b"\0" * 16


# ---------------------------------------------------------------- adaptive radix tree

class Node:
    """One node: the bytes of its compressed path, its value if a key ends here, and its children in one of four layouts.

    Up to 4 and up to 16: sorted key bytes beside their children.  Up to 48: a table of 256 places into a list.
    Beyond: a list of 256.  `add` moves a full node to the next layout.
    """

    __slots__ = ("path", "value", "room", "keys", "children")

    def __init__(self, path: bytes, value=None):
        self.path, self.value, self.room = path, value, 4
        self.keys, self.children = bytearray(), []

    def get(self, byte: int) -> Node | None:
        if self.room <= 16:
            i = bisect_left(self.keys, byte)
            return self.children[i] if i < len(self.keys) and self.keys[i] == byte else None
        if self.room == 48:
            return self.children[self.keys[byte] - 1] if self.keys[byte] else None
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        """Set or replace the child at this byte."""
        if self.room <= 16:
            i = bisect_left(self.keys, byte)
            if i < len(self.keys) and self.keys[i] == byte:
                self.children[i] = child
            elif len(self.keys) < self.room:
                self.keys.insert(i, byte)
                self.children.insert(i, child)
            else:
                self._grow()
                self.put(byte, child)
        elif self.room == 48:
            if self.keys[byte]:
                self.children[self.keys[byte] - 1] = child
            elif len(self.children) < 48:
                self.children.append(child)
                self.keys[byte] = len(self.children)
            else:
                self._grow()
                self.put(byte, child)
        else:
            self.children[byte] = child

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            table = bytearray(256)
            for i, byte in enumerate(self.keys):
                table[byte] = i + 1
            self.keys, self.room = table, 48
        else:
            wide: list[Node | None] = [None] * 256
            for byte, i in enumerate(self.keys):
                if i:
                    wide[byte] = self.children[i - 1]
            self.keys, self.children, self.room = bytearray(), wide, 256

    def ordered(self) -> list[tuple[int, Node]]:
        """(byte, child) by rising byte."""
        if self.room <= 16:
            return list(zip(self.keys, self.children, strict=True))
        if self.room == 48:
            return [(byte, self.children[i - 1]) for byte, i in enumerate(self.keys) if i]
        return [(byte, child) for byte, child in enumerate(self.children) if child is not None]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def insert(root: Node, key: bytes, value) -> None:
    """Put a value at a key; root has an empty path."""
    node, at, above = root, 0, None
    while True:
        shared = _common(node.path, key[at:])
        if shared < len(node.path):  # the path splits: its start becomes a node of its own
            upper = Node(node.path[:shared])
            below, node.path = node.path[shared], node.path[shared + 1 :]
            upper.put(below, node)
            above[0].put(above[1], upper)
            node = upper
        at += shared
        if at == len(key):
            node.value = value
            return
        child = node.get(key[at])
        if child is None:
            node.put(key[at], Node(key[at + 1 :], value))
            return
        above, node, at = (node, key[at]), child, at + 1


# ---------------------------------------------------------------- what a run of segments says about its nodes

NODES = ("id binary, parent binary, open boolean, parent_open boolean, depth long, conv_id long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved long, words long, is_root boolean, path array<binary>")
_KINDS = {"binary": pa.binary(), "boolean": pa.bool_(), "long": pa.int64(), "array<binary>": pa.list_(pa.binary())}


def node_id(context: bytes, prefix: bytes) -> bytes:
    return hashlib.md5(context + prefix).digest()


class Tree:
    """The radix tree of the segments of one context that a run holds."""

    def __init__(self, context: bytes, layer: int, width: int, layer_turns: int):
        self.context, self.base, self.width, self.full = context, layer * layer_turns, width, layer_turns * width
        self.root, self.keys = Node(b""), []

    def add(self, key: bytes, value: tuple) -> None:
        """value: (n_convs, least conv_id, n_children, n_leaves, saved): the last three of what hangs below a full segment."""
        insert(self.root, key, value)
        self.keys.append(key)

    def rows(self, borders: list[bytes]) -> Iterator[tuple]:
        """The nodes (see NODES); those that are prefixes of a border are open."""
        open_at = {}  # prefix length -> border prefixes, by whole turns
        for border in borders:
            for end in range(0, len(border) + 1, self.width):
                open_at.setdefault(end, set()).add(border[:end])
        # post-order over radix nodes: (node, prefix up to and with its path, depth in bytes where its span begins)
        stack = [(self.root, b"", -1, False)]
        done: list[tuple] = []  # results of finished children: (n, least, tops, rows of the topmost turn nodes)
        counts: list[int] = []
        while stack:
            node, prefix, start, seen = stack.pop()
            if not seen:
                children = node.ordered()
                stack.append((node, prefix, start, True))
                counts.append(len(children))
                for byte, child in reversed(children):
                    stack.append((child, prefix + bytes([byte]) + child.path, len(prefix), False))
                continue
            n_parts = counts.pop()
            parts = done[len(done) - n_parts :]
            del done[len(done) - n_parts :]
            n, least, tops = sum(p[0] for p in parts), min((p[1] for p in parts), default=None), [r for p in parts for r in p[2]]
            below = (0, 0, 0)
            if node.value is not None:
                n, least = n + node.value[0], node.value[1] if least is None else min(least, node.value[1])
                below = node.value[2:]
            first = start + 1 + (-(start + 1)) % self.width if start >= 0 else 0  # whole turns in (start, end of the path]
            for end in range(len(prefix) - len(prefix) % self.width, first - 1, -self.width):
                tops = [self._row(prefix[:end], n, least, tops, below if end == len(prefix) else (0, 0, 0), open_at)]
                below = (0, 0, 0)
                for child in tops[0][-1]:
                    yield from self._final(child, tops[0])
                tops[0][-1] = None
            done.append((n, least, tops))
        (_, _, tops), = done
        for row in tops:
            yield from self._final(row, None)

    def _row(self, prefix: bytes, n: int, least: int, tops: list[list], below: tuple, open_at: dict) -> list:
        """[prefix, open, n, least, children, leaves, saved, words, child rows]; of open nodes only closed children count."""
        is_open = prefix in open_at.get(len(prefix), ())
        closed = [t for t in tops if not t[1]]
        children = len(closed) + below[0]
        leaves = sum(t[5] for t in closed) + (below[1] if below[0] else 0)
        saved = sum(t[6] for t in closed) + below[2]
        words = int.from_bytes(prefix[-4:], "big") if prefix else 0
        if not is_open:
            leaves += children == 0
            saved += (n - 1) * words
        return [prefix, is_open, n, least, children, leaves, saved, words, tops]

    def _final(self, row: list, parent: list | None) -> Iterator[tuple]:
        prefix, is_open, n, least, children, leaves, saved, words, _ = row
        own, above = node_id(self.context, prefix), node_id(self.context, prefix[: -self.width]) if prefix else None
        path = [node_id(self.context, prefix[:end]) for end in range(0, len(prefix) + 1, self.width)] if is_open else None
        yield (own, above, is_open, bool(parent and parent[1]), self.base + len(prefix) // self.width, least,
               parent[3] if parent and not parent[1] else None, n, children, leaves, saved, words, not prefix, path)


def _builder(layer: int, layer_turns: int, run: int):
    """Ordered segments (context, key, n, least, children, leaves, saved) -> nodes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        trees: list[Tree] = []
        held = 0

        def emit() -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            for i, tree in enumerate(trees):
                borders = [tree.keys[0]] * (i == 0) + [tree.keys[-1]] * (i == len(trees) - 1)
                for row in tree.rows(borders):
                    rows.append(row)
                    if len(rows) >= 5000:
                        yield _batch(rows)
                        rows = []
            yield _batch(rows)

        for batch in batches:
            for context, key, *value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held >= run:
                    yield from emit()
                    trees, held = [], 0
                if not trees or trees[-1].context != context:
                    trees.append(Tree(context, layer, WIDTH, layer_turns))
                trees[-1].add(key, tuple(value))
                held += 1
        if trees:
            yield from emit()
        trees = []
        give_back()

    return build


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    fields = [c.split() for c in NODES.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


# ---------------------------------------------------------------- turns and segments

def turn_id(role: Column, text: Column) -> Column:
    """40 hex digits: MD5 of the role's length, the role and the text, then the words of the text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.concat(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")),
                    F.lpad(F.lower(F.hex(F.regexp_count(text, F.lit(WORDS)).cast("long"))), 8, "0"))


def numbered(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, pos, turn_id), places from 1; each row is ranked among those of its block of turn numbers."""
    own = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), turn_id(F.col(role), F.col(text)).alias("turn_id"))
    own = own.withColumn("block", F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(2**62))).cast("long"))
    rank = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "turn_id"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = own.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).select("conv_id", "block", F.sum("n").over(earlier).alias("before"))
    later = before.where("before IS NOT NULL")  # most conversations have one block
    ranked = own.withColumn("rank", rank.cast("long")).join(later, ["conv_id", "block"], "left")
    return ranked.select("conv_id", (F.col("rank") + F.coalesce("before", F.lit(0))).alias("pos"), "turn_id")


def rebuilt(turns: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, pos, turn_id or null) after each conversation c took its first crc32(c) % heads turns from conversation c - c % group.

    A conversation without any turn left has one row without place and turn.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    first = F.col("conv_id") - F.col("conv_id") % group
    asked = sizes.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).withColumn("source", first)
    lengths = sizes.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("source"), F.col("own").alias("there"))
    asked = written(asked.join(lengths, "source", "left").select(
        "conv_id", "source", "own", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")), "trie-conversations")
    lent = turns.where((F.col("conv_id") % group == 0) & (F.col("pos") < heads)).select(F.col("conv_id").alias("source"), "pos", "turn_id")
    head = asked.join(lent, "source").where(F.col("pos") <= F.col("taken")).select("conv_id", "pos", "turn_id")
    tail = turns.join(asked.select("conv_id", "h", "taken"), "conv_id").where(F.col("pos") > F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_id")
    none = asked.where((F.col("taken") == 0) & (F.col("own") <= F.col("h"))).select("conv_id", F.lit(None).cast("long"), F.lit(None).cast("string"))
    return head.unionAll(tail).unionAll(none)


def segments(turns: DataFrame, layer_turns: int = LAYER_TURNS) -> DataFrame:
    """(conv_id, layer, context, key, next, end): next is the context below a full segment, end the node where the conversation ends.

    turns: (conv_id, pos, turn_id); a conversation of whole layers gets an empty last segment.
    """
    layer = F.when(F.col("pos").isNull(), F.lit(0)).otherwise(F.floor((F.col("pos") - 1) / layer_turns)).cast("long")
    ordered = F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "turn_id"))))
    cut = turns.groupBy("conv_id", layer.alias("layer")).agg(ordered.alias("t")).select(
        "conv_id", "layer", F.size("t").alias("n"), F.unhex(F.array_join(F.col("t.turn_id"), "")).alias("key"))
    by_layer = Window.partitionBy("conv_id").orderBy("layer")
    whole = by_layer.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashes = [F.bit_xor(F.xxhash64(*c)).over(whole) for c in (("layer", "key"), ("key", "layer", F.lit(1)))]
    last = F.lead("layer").over(by_layer).isNull()
    # the context after this segment
    after = F.unhex(F.concat(*(F.lpad(F.hex(h), 16, "0") for h in hashes)))
    cut = cut.withColumn("after", after).withColumn("last", last)
    cut = cut.withColumn("context", F.coalesce(F.lag("after").over(by_layer), F.lit(ROOT)))
    full = F.col("n") == layer_turns
    cut = cut.withColumn("end", F.when(F.col("last"), F.unhex(F.md5(F.concat("context", "key")))))
    more = cut.where(full & F.col("last")).select(
        "conv_id", (F.col("layer") + 1).alias("layer"), F.col("after").alias("context"), F.lit(b"").alias("key"),
        F.lit(None).cast("binary").alias("next"), F.lit(None).cast("binary").alias("end"))
    own = cut.select("conv_id", "layer", "context", "key", F.when(full, F.col("after")).alias("next"), "end")
    return own.unionAll(more)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered (id, ids) -> (id, SHA-256 of all ids joined by commas)."""
    current, digest = None, None
    for batch in batches:
        out = []
        for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if own != current:
                if current is not None:
                    out.append((current, digest.hexdigest()))
                current, digest = own, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        if out:
            yield _ends(out)
    if current is not None:
        yield _ends([(current, digest.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    ids, digests = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(digests, pa.string())], names=["id", "ends_sha256"])


def ends(cut: DataFrame) -> DataFrame:
    """(id, ends_sha256) of every node in which a conversation ends."""
    block = F.floor(F.col("conv_id") / END_BLOCK).alias("block")
    strings = cut.where("end IS NOT NULL").groupBy(F.col("end").alias("id"), block).agg(
        F.array_join(F.sort_array(F.collect_set("conv_id")).cast("array<string>"), ",").cast("binary").alias("ids"))
    dealt = strings.repartition(shuffle_partitions(cut.sparkSession), "id").sortWithinPartitions("id", "block")
    return dealt.select("id", "ids").mapInArrow(_digest, "id binary, ends_sha256 string")


# ---------------------------------------------------------------- layers

def _closed_up(nodes: DataFrame) -> DataFrame:
    """The open nodes of a layer, each once and complete: sums over runs, then over its open descendants."""
    parts = nodes.where("open").groupBy("id").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("closed"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"),
        F.max("words").alias("words"), F.bool_or("is_root").alias("is_root"), F.any_value("path").alias("path"))
    parts = written(parts, "trie-open")
    opened = parts.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("opened"))
    own = parts.join(opened, "id", "left").withColumn("n_children", F.col("closed") + F.coalesce("opened", F.lit(0)))
    own = own.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).withColumn(
        "saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("words"))
    sums = own.select(F.explode("path").alias("id"), "n_leaves", "saved").groupBy("id").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    parents = parts.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return own.drop("n_leaves", "saved").join(sums, "id").join(parents, "parent", "left")


FINAL = ["id", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "is_root"]


def _layer(cut: DataFrame, below: DataFrame | None, layer: int, layer_turns: int, run: int) -> DataFrame:
    """The nodes of a layer, its trees' roots included (FINAL, and the root's context); below: those of the next layer."""
    keys = cut.where(F.col("layer") == layer).groupBy("context", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.max("next").alias("next"))
    hung = ["n_children", "n_leaves", "saved"]
    if below is None:
        keys = keys.select("context", "key", "n", "least", *(F.lit(0).cast("long").alias(c) for c in hung))
    else:
        roots = below.where("is_root").select(F.col("id").alias("root"), *hung)
        own = F.when(F.col("next").isNotNull(), F.unhex(F.md5("next")))
        keys = keys.withColumn("root", F.coalesce(own, F.concat(F.lit(b"-"), "context", "key"))).join(roots, "root", "left")
        keys = keys.select("context", "key", "n", "least", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in hung))
    keys = written(keys, "trie-keys")
    dealt = keys.repartitionByRange(shuffle_partitions(cut.sparkSession), "context", "key").sortWithinPartitions("context", "key")
    nodes = written(dealt.mapInArrow(_builder(layer, layer_turns, run), NODES), "trie-runs")
    opened = written(_closed_up(nodes).select(*FINAL), "trie-opened")
    parents = opened.select(F.col("id").alias("parent"), F.col("conv_id").alias("above"))
    closed = nodes.where("NOT open")
    under = closed.where("parent_open").join(parents, "parent").withColumn("parent_conv_id", F.col("above"))
    return written(closed.where("NOT parent_open").select(*FINAL).unionAll(under.select(*FINAL)).unionAll(opened), "trie-layer")


def trie(turns: DataFrame, layer_turns: int = LAYER_TURNS, run: int = RUN) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: (conv_id, pos, turn_id), places from 1 without gaps; a row without a place stands for a conversation without turns.
    """
    cut = written(segments(turns, layer_turns), "trie-segments")
    deepest = cut.agg(F.max("layer").alias("m")).first()["m"]
    layers: list[DataFrame] = []
    for layer in range(-1 if deepest is None else deepest, -1, -1):
        layers.append(_layer(cut, layers[-1] if layers else None, layer, layer_turns, run))
    if not layers:
        layers = [_layer(cut, None, 0, layer_turns, run)]
    # of the trees' roots only the top one is a node of its own: the others are the last nodes of the layer above
    nodes = layers[-1]
    for below in layers[:-1]:
        nodes = nodes.unionAll(below.where("NOT is_root"))
    found = ends(cut)
    return nodes.join(found, "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                      layer_turns: int = LAYER_TURNS, run: int = RUN) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns; see `rebuilt` and `trie`."""
    turns = written(numbered(rows, conv_id, turn, role, text), "trie-turns")
    return trie(rebuilt(turns), layer_turns, run)
