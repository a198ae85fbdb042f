"""Secret scan: fixed patterns plus sliding-window Shannon entropy with allow-list suppression.

Base spans come from three patterns (see BASE).  The method adds spans: a candidate is a maximal run
of token characters; over each of its sub-runs of one character class a window slides, its counts
change by one character in and one out, and its entropy follows from the running sum of c*log2(c).
Windows at or above the class threshold are merged into a span.  A candidate is suppressed when an
allow-list pattern matches it whole, a window when it has no digit or no letter (ordinary words,
numbers); a span inside a base span is not reported again.

Every document is scanned whole and alone: no shuffle, memory of one text.  A null or empty text has
no span; an empty table gives no rows; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")
CANDIDATE = re.compile("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: kind: characters of the class, window, bits a character that a window needs.
CLASSES = {
    "entropy_hex": (re.compile("[0-9a-fA-F]{24,}"), 24, 3.0),
    "entropy_alnum": (re.compile("[A-Za-z0-9]{20,}"), 20, 3.7),
    "entropy_base64": (re.compile("[A-Za-z0-9+/_=-]{24,}"), 24, 4.0),
}
#: Whole candidates that are no secrets: words and slugs, paths, numbers, dates, UUIDs, documented examples.
ALLOW = tuple(map(re.compile, (
    r"[A-Za-z]+(?:[/_=+-]+[A-Za-z]+)*[/_=+-]*",
    r"[/_=+-]*[0-9]+(?:[/_=+-]+[0-9]+)*[/_=+-]*",
    r"(?:[/_-]?(?:[A-Za-z]{1,16}|[0-9]{1,8}))(?:[/_-](?:[A-Za-z]{1,16}|[0-9]{1,8}))*[/_-]?",
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r".*EXAMPLE.*",
)))
_SUM = [0.0, *(c * math.log2(c) for c in range(1, 257))]

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "n_entropy long")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), leftmost and non-overlapping within each kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def entropy_windows(text: str, width: int, bits: float) -> Iterator[tuple[int, int]]:
    """Merged spans of the windows of `width` characters with at least `bits` of entropy, a digit and a letter."""
    counts: dict[str, int] = {}
    total, digits = 0.0, 0
    start = end = -1
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        total += _SUM[n + 1] - _SUM[n]
        counts[c] = n + 1
        digits += c.isdigit()
        if i >= width:
            out = text[i - width]
            n = counts[out]
            total += _SUM[n - 1] - _SUM[n]
            counts[out] = n - 1
            digits -= out.isdigit()
        if i >= width - 1 and 0 < digits < width and math.log2(width) - total / width >= bits:
            if start >= 0 and i - width + 1 > end:
                yield start, end
                start = -1
            if start < 0:
                start = i - width + 1
            end = i + 1
    if start >= 0:
        yield start, end


def entropy_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    for c in CANDIDATE.finditer(text):
        word = c.group()
        if any(a.fullmatch(word) for a in ALLOW):
            continue
        for kind, (chars, width, bits) in CLASSES.items():
            for run in chars.finditer(word):
                at = c.start() + run.start()
                found += [(at + s, at + e, kind) for s, e in entropy_windows(run.group(), width, bits)]
    return found


def spans(text: str) -> tuple[list, list]:
    """Base spans, and the spans that the entropy adds; both by start, then kind as in KINDS."""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base, extra = sorted(base_spans(text), key=order), []
    at = reach = 0  # the farthest end of the base spans that start no later than this one
    for found in sorted(entropy_spans(text), key=order):
        while at < len(base) and base[at][0] <= found[0]:
            reach = max(reach, base[at][1])
            at += 1
        if found[1] > reach:
            extra.append(found)
    return base, extra


def written_spans(found: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in SCHEMA.split(", ")])
    for part, texts in chunks(batches):
        out = []
        for doc, text in zip(part.column(0).to_pylist(), texts, strict=True):
            base, extra = spans(text)
            kinds = [k for *_, k in base]
            both = sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
            out.append((doc, kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                        hashlib.sha256(written_spans(base).encode()).hexdigest(), written_spans(both), len(extra)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document; see SCHEMA."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_scan, SCHEMA)
