"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is read into leaf blocks: the text between two tags of block level, with the open elements
above it.  A block's features are its ancestors' tags and class words and figures of its text (length, share
of link text, closing mark, place on the page).  The field has the labels rest and main text, a
weight for each feature and label and one for each pair of neighbouring labels; it is trained by the
gradient of the log-likelihood (forward-backward, AdaGrad) and decoded by Viterbi.

Blocks keep the open elements above them as a path that they share, and what the path adds to a score or
a gradient is summed once for each element, so deep nesting takes no more than linear time.

Labelled pages: rows of the table whose markup names the article (`article` element) are labelled by
it (but asides, forms, adverts, comments and inner articles of it are rest), and each is also set again into other usual layouts (LAYOUTS), where the place of every block, and
so its label, is known.  At most SAMPLE_PAGES different rows, chosen by a hash, with SAMPLE_CHARS characters in all are used to
train; if they hold no main text, fixed layouts of made-up text are.  All rows are decoded.

Scripts, styles, comments of the markup and everything in `head` (which ends where an
element opens that it cannot hold) are never text.  A null or empty page gives an
empty text; an empty table no rows; repeated rows repeated results; extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks
from .markup import attributes, tokens

SAMPLE_PAGES = 150
SAMPLE_CHARS = 15_000_000
LAYOUTS_PER_PAGE = 3
EPOCHS = 5
SCHEMA = "page_id long, url string, text string, n_chars long"

# Element names of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title template noscript".split())
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

RAW = frozenset("script style textarea iframe noscript template title".split())
NO_MAIN = frozenset("aside footer form nav".split())
NO_MAIN_NAMES = frozenset("ad ads advert advertisement advertisements banner comment comments commentlist cookie disclaimer footer menu nav navbar navigation newsletter notice promo "
                          "related reply respond share sharing sidebar social sponsored subscribe widget".split())

_NAME_WORD = re.compile("[a-z]+")


@dataclass(eq=False)
class Path:
    """An open element below those above it, which the blocks and elements below share."""

    tag: str
    names: tuple[str, ...]  # words of its class, id and role
    parent: Path | None
    fresh: tuple[str, ...]  # its features that no element above has

    def __iter__(self) -> Iterator[tuple[str, ...]]:
        """For every open element, the innermost first: its tag, then its names."""
        at = self
        while at:
            yield (at.tag, *at.names)
            at = at.parent


@dataclass
class Block:
    text: str
    above: Path | tuple[()]
    link_chars: int


def along[T](path: Path | tuple[()], known: dict[Path, T], start: T, step: Callable[[T, Path], T]) -> T:
    """`step` folded over the open elements, the outermost first; `known` keeps the value of each, so each takes one step in all."""
    todo = []
    at = path or None
    while at is not None and at not in known:
        todo.append(at)
        at = at.parent
    value = start if at is None else known[at]
    for at in reversed(todo):
        value = known[at] = step(value, at)
    return value


def leaf_blocks(page: str) -> list[Block]:
    """The page's non-empty leaf blocks in order."""
    blocks: list[Block] = []
    stack: list[Path] = []
    depths: dict[str, list[int]] = {}  # of the open elements of each tag
    active: set[str] = set()  # features of the open elements
    held: list[str] = []
    links = at = link_chars = hidden = 0

    def flush() -> None:
        nonlocal held, link_chars
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                blocks.append(Block(text, stack[-1] if stack else (), link_chars))
        held, link_chars = [], 0

    def add(piece: str) -> None:
        nonlocal link_chars
        if piece and not hidden:
            held.append(piece)
            if links:
                link_chars += len(piece.strip())

    def push(tag: str, names: tuple[str, ...]) -> None:
        nonlocal hidden
        fresh = tuple(f for f in dict.fromkeys((f"tag={tag}", *(f"name={w}" for w in names))) if f not in active)
        active.update(fresh)
        depths.setdefault(tag, []).append(len(stack))
        stack.append(Path(tag, names, stack[-1] if stack else None, fresh))
        hidden += tag in HIDDEN

    def pop(depth: int) -> None:
        nonlocal hidden
        while len(stack) > depth:
            last = stack.pop()
            active.difference_update(last.fresh)
            depths[last.tag].pop()
            hidden -= last.tag in HIDDEN

    for m in tokens(page, RAW):
        add(page[at : m.start])
        at = m.end
        tag = m.tag
        if m.skipped or not tag:
            continue
        if stack and stack[-1].tag == "head" and not m.closing and tag not in HEAD:  # </head> may be left out
            flush()
            pop(len(stack) - 1)
        if tag in VOID:
            if tag in ("br", "hr"):
                flush()
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if m.closing else links + 1
            continue
        flush()
        links = 0
        if m.closing:
            if depths.get(tag):
                pop(depths[tag][-1])
        else:
            if stack and (stack[-1].tag == "p" and tag in CLOSES_P or stack[-1].tag == tag in ("li", "tr", "td", "dt", "dd", "option")):
                pop(len(stack) - 1)
            push(tag, tuple(w for name, value in attributes(m.attributes) if name in ("class", "id", "role") for w in _NAME_WORD.findall(value.lower())))
    add(page[at:])
    flush()
    return blocks


class Row(list):
    """A block's own features; those of its open elements are reached by `above`."""

    above: Path | tuple[()] = ()


def features(blocks: list[Block]) -> list[Row]:
    """The active features of every block."""
    out = []
    total = len(blocks)
    for i, b in enumerate(blocks):
        n = len(b.text)
        own = Row(("bias", f"len{min(7, n.bit_length() // 2)}", f"link{min(3, 4 * b.link_chars // max(1, n))}", f"place{4 * i // total}",
                   "stop" if b.text[-1] in ".!?…" else "nostop", f"digits{min(2, 6 * sum(map(str.isdigit, b.text)) // n)}"))
        if "©" in b.text:
            own.append("copyright")
        if b.above:
            own.append(f"in={b.above.tag}")
            own.above = b.above
        out.append(own)
    return out


@dataclass
class Field:
    """Weights of the chain: emit[feature] for (rest, main), turn[a, b] for neighbours, begin."""

    emit: dict[str, np.ndarray] = field(default_factory=dict)
    turn: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    begin: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def scores(self, rows: list[Row]) -> np.ndarray:
        get = self.emit.get
        known: dict[Path, tuple[float, float]] = {}

        def added(sums: tuple[float, float], found: Iterable[str]) -> tuple[float, float]:
            a, b = sums
            for f in found:
                w = get(f)
                if w is not None:
                    a += w[0]
                    b += w[1]
            return a, b

        out = np.zeros((len(rows), 2))
        for i, row in enumerate(rows):
            above = getattr(row, "above", ())
            out[i] = added(along(above, known, (0.0, 0.0), lambda sums, path: added(sums, path.fresh)), row)
        return out

    def decode(self, rows: list[Row]) -> list[int]:
        """The most probable labels (Viterbi); ties go to rest."""
        if not rows:
            return []
        (t00, t01), (t10, t11) = self.turn.tolist()
        s = self.scores(rows).tolist()
        a, b = s[0][0] + self.begin[0], s[0][1] + self.begin[1]
        back = []
        for x, y in s[1:]:
            back.append((int(b + t10 > a + t00), int(b + t11 > a + t01)))
            a, b = max(a + t00, b + t10) + x, max(a + t01, b + t11) + y
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def marginals(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label marginals, and the expected count of every pair of neighbouring labels."""
        n = len(s)
        forward, backward = np.empty((n, 2)), np.zeros((n, 2))
        forward[0] = s[0] + self.begin
        for i in range(1, n):
            forward[i] = s[i] + np.logaddexp.reduce(forward[i - 1][:, None] + self.turn, axis=0)
        for i in range(n - 2, -1, -1):
            backward[i] = np.logaddexp.reduce(self.turn + s[i + 1] + backward[i + 1], axis=1)
        log_z = np.logaddexp.reduce(forward[-1])
        single = np.exp(forward + backward - log_z)
        pair = np.zeros((2, 2))
        for i in range(1, n):
            pair += np.exp(forward[i - 1][:, None] + self.turn + s[i] + backward[i] - log_z)
        return single, pair


def totals(rows: list[Row], values: np.ndarray) -> dict[str, np.ndarray]:
    """For every feature the sum over the rows that have it, open elements' features included."""
    out: dict[str, np.ndarray] = {}
    below: dict[Path, np.ndarray] = {}
    depths: dict[Path, int] = {}

    def add(found: Iterable[str], value: np.ndarray) -> None:
        for f in found:
            out[f] = out[f] + value if f in out else value

    for row, value in zip(rows, values, strict=True):
        add(row, value)
        if above := getattr(row, "above", ()):
            below[above] = below[above] + value if above in below else value
            along(above, depths, 0, lambda depth, _: depth + 1)
    for path in sorted(depths, key=depths.__getitem__, reverse=True):  # inner elements first
        value = below[path]
        add(path.fresh, value)
        if path.parent:
            below[path.parent] = below[path.parent] + value if path.parent in below else value
    return out


def train(pages: list[tuple[list[Row], list[int]]], epochs: int = EPOCHS, rate: float = 0.4, l2: float = 1e-4) -> Field:
    """AdaGrad on the log-likelihood, page by page in a fixed random order."""
    model, order = Field(), random.Random(7)
    squares: dict[str, np.ndarray] = {}
    turn_squares, begin_squares = np.full((2, 2), 1e-6), np.full(2, 1e-6)
    pages = [p for p in pages if p[0]]
    for _ in range(epochs):
        order.shuffle(pages)
        for rows, labels in pages:
            single, pair = model.marginals(model.scores(rows))
            gold = np.eye(2)[labels]
            difference = gold - single
            gradient = totals(rows, difference)
            for f, g in gradient.items():
                w = model.emit.setdefault(f, np.zeros(2))
                g = g - l2 * w
                q = squares.setdefault(f, np.full(2, 1e-6))
                q += g * g
                w += rate * g / np.sqrt(q)
            turned = np.zeros((2, 2))
            np.add.at(turned, (labels[:-1], labels[1:]), 1)
            g = turned - pair
            turn_squares += g * g
            model.turn = model.turn + rate * g / np.sqrt(turn_squares)
            g = difference[0]
            begin_squares += g * g
            model.begin = model.begin + rate * g / np.sqrt(begin_squares)
    return model


# Usual containers of main text and of everything else, for the labelled layouts.
MAIN = ('<article>', '<main>', '<div class="post-content">', '<div id="content">', '<section class="entry-content">', '<div class="article-body">',
        '<main><article class="post">', '<div class="story text">', '<article><div class="body">', '<div role="main">')
MENUS = ('<nav><ul>', '<ul class="menu">', '<div class="navbar"><ul>', '<header><nav>', '<div id="navigation">', '<div class="breadcrumbs">')
BEFORE = ('<header>', '<div class="header">', '<div class="ad">', '<div class="advert">', '<div class="sponsored banner">', '<div class="cookie-notice">',
          '<div role="alert" class="notice">', '<aside class="sidebar">', '<div class="site-header">', '<form class="search">', '<aside>')
INSIDE = ('<div class="ad">', '<aside>', '<div class="advertisement">', '<div class="share social">', '<form class="newsletter subscribe">',
          '<div class="related">', '<div class="notice">', '<figure class="promo">')
AFTER = ('<footer>', '<div class="footer">', '<section class="comments">', '<div id="comments"><div class="comment">', '<ol class="commentlist"><li class="comment">',
         '<aside class="sidebar">', '<div class="widget">', '<div class="related-posts">', '<form>', '<form class="comment-form">', '<div class="ads">',
         '<div class="sidebar">', '<div class="disclaimer notice">', '<div class="copyright">', '<section class="reader-comments">', '<div class="reply comment">')


def _closed(opening: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<([a-z0-9]+)", opening)))


def layout(title: str, main: list[str], rest: list[str], seed: int) -> tuple[str, list[int]]:
    """A page that sets the blocks into random containers, and the label of each of its leaf blocks."""
    pick = random.Random(seed)
    page, labels = ["<!DOCTYPE html><html><head><title>x</title></head><body>"], []

    def put(container: str, texts: list[str], label: int, inner: tuple[str, ...]) -> None:
        page.append(container)
        for t in texts:
            tag = pick.choice(inner)
            text = html.escape(t)
            page.append(f'<{tag}><a href="/x">{text}</a></{tag}>' if tag == "li" and not label else f"<{tag}>{text}</{tag}>")
            labels.append(label)
        page.append(_closed(container))

    def some(most: int) -> list[str]:
        # of a long main text too, so that a block's own words do not decide alone
        return [pick.choice(rest + main)[: pick.choice((20, 60, 200, 2000))].strip() or "x" for _ in range(pick.randint(1, most))]

    put(pick.choice(MENUS), [t[:12].strip() or "x" for t in some(6)], 0, ("li",))
    for container in pick.sample(BEFORE, pick.randint(0, 3)):
        put(container, some(2), 0, ("p", "div", "label" if "form" in container else "p"))
    body = pick.choice(MAIN)
    page.append(body)
    if title and pick.random() < 0.8:
        put("<h1>", [title], 1, ("span",))
    for t in main:
        put("", [t], 1, ("p", "p", "p", "p", "blockquote", "h2", "div", "li"))
        if pick.random() < 0.15:
            put(pick.choice(INSIDE), some(2), 0, ("p", "div"))
    if pick.random() < 0.3:
        put(pick.choice(AFTER[2:5]), some(3), 0, ("p", "div"))
    page.append(_closed(body))
    for container in pick.sample(AFTER, pick.randint(1, 4)):
        put(container, some(3), 0, ("p", "div", "p"))
    return "".join(page) + "</body></html>", labels


def _part(part: str, path: Path) -> str:
    """Where a block stands: outside, in the article's main text, or in the rest of the article."""
    if part == "outside":
        return "main" if path.tag == "article" and NO_MAIN_NAMES.isdisjoint(path.names) else part
    inner = path.tag == "article" or path.tag in NO_MAIN or not NO_MAIN_NAMES.isdisjoint(path.names)
    return "rest" if inner else part


def article_labels(blocks: list[Block]) -> list[int]:
    """1 for a block inside `article`, but not inside an aside, a form, an advert, comments or an inner article of it."""
    known: dict[Path, str] = {}
    return [int(along(b.above, known, "outside", _part) == "main") for b in blocks]


def labelled(pages: list[str], layouts: int = LAYOUTS_PER_PAGE) -> list[tuple[list[Row], list[int]]]:
    """Training chains of pages whose markup names the article, as they are and in other layouts."""
    out = []
    for number, page in enumerate(pages):
        blocks = leaf_blocks(page)
        labels = article_labels(blocks)
        out.append((features(blocks), labels))
        main = [b.text for b, y in zip(blocks, labels, strict=True) if y and b.above.tag != "h1"]
        rest = [b.text for b, y in zip(blocks, labels, strict=True) if not y] or ["x"]
        title = next((b.text for b, y in zip(blocks, labels, strict=True) if y and b.above.tag == "h1"), "")
        for k in range(layouts if main else 0):
            set_again, labels = layout(title, main[:12], rest, zlib.crc32(f"{number} {k}".encode()))
            found = leaf_blocks(set_again)
            if len(found) == len(labels):
                out.append((features(found), labels))
    return out


def fixed_layouts(number: int = 60) -> list[tuple[list[Row], list[int]]]:
    """Training chains of made-up text, for a table without labelled pages: sentences are main text, short pieces the rest."""
    out = []
    for seed in range(number):
        pick = random.Random(seed)
        main = ["text " * pick.randint(6, 150) + "end." for _ in range(pick.randint(2, 12))]
        set_again, labels = layout("a title", main, ["text " * pick.randint(1, 12) for _ in range(8)], seed)
        found = leaf_blocks(set_again)
        if len(found) == len(labels):
            out.append((features(found), labels))
    return out


def fit(pages: DataFrame, page: str = "html", page_id: str = "page_id", sample: int = SAMPLE_PAGES) -> Field:
    """A field from a bounded sample of the rows whose markup names the article; from fixed layouts if that has no main text."""
    rows = pages.select(F.col(page).alias("html"), F.xxhash64(F.col(page_id), F.col(page)).alias("key"))
    named = rows.where(F.lower("html").contains("<article") & (F.length("html") <= SAMPLE_CHARS))
    keys, left = [], SAMPLE_CHARS
    for r in named.groupBy("key").agg(F.max(F.length("html")).alias("n")).orderBy("key").limit(sample).collect():
        if r["n"] <= left:
            keys.append(r["key"])
            left -= r["n"]
    found = {r["key"]: r["html"] for r in named.where(F.col("key").isin(keys)).dropDuplicates(["key"]).collect()} if keys else {}
    chains = labelled([found[k] for k in keys])
    return train(chains if any(1 in labels for _, labels in chains) else chains + fixed_layouts())


def main_text(page: str, model: Field) -> str:
    blocks = leaf_blocks(page)
    return " ".join(b.text for b, y in zip(blocks, model.decode(features(blocks)), strict=True) if y)


def extracted(pages: DataFrame, model: Field, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page; see SCHEMA."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's features

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            found = [main_text(t, shared.value) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(page), F.lit("")).alias("html"))
    return rows.mapInArrow(extract, SCHEMA)
