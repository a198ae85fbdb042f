"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

A text is lower-cased, every run of other characters than letters becomes one space, and its 1- to
3-grams are hashed into FEATURES buckets.  A feature's value is (1 + log count) * idf, and the vector has
length 1.  Document frequencies are counted over all training rows.  The weights are learned by
follow-the-regularised-leader (per-coordinate rates, L1 and L2) from a bounded sample: up to
PER_LANGUAGE rows (in expectation) of every label, chosen by a hash of id and text.  L1 leaves more than half of the
weights of the seen features at zero; only features with a weight are kept.  A temperature is then fitted on a tenth of the
sample that the weights did not see.  Labels are held on the driver, like a dictionary's types: one row each.

Every text is scored whole.  A text that is null or has no letter is `und` with score 0; without any
labelled row every text is `und`; an empty table gives no rows; ties between languages go to the
first in alphabetical order; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, keep_only

FEATURES = 1 << 15
PER_LANGUAGE = 1200
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.1, 1e-6
UNKNOWN = "und"
MIN_SCORE = 0.5
SCHEMA = "doc_id long, lang_pred string, score double"

_LETTER = np.array([chr(i).isalpha() for i in range(0x110000)])


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(feature, count) of the hashed 1- to 3-grams of one text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letters = _LETTER[codes]
    codes = np.where(letters, codes, np.uint32(32))
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # of a run of other characters the first stays, as the space
    c = np.concatenate(([32], codes[keep], [32])).astype(np.uint32)
    grams = [c]
    for j in (1, 2):
        grams.append((grams[-1][:-1] if len(grams[-1]) > 1 else grams[-1][:0]) * np.uint32(0x01000193) + c[j:] * np.uint32(0x9E3779B1))
    hashed = np.concatenate([(g * np.uint32(0x85EBCA6B) + np.uint32(n)) >> np.uint32(17) for n, g in enumerate(grams)])
    dense = np.bincount(hashed, minlength=FEATURES)
    at = np.flatnonzero(dense)
    return at, dense[at]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, value) of length 1; nothing for a text without letters."""
    if not has_letter(text):
        return np.empty(0, np.int64), np.empty(0)
    at, n = counts(text)
    value = (1 + np.log(n)) * idf[at]
    return at, value / np.sqrt((value * value).sum())


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features with a weight, by language; the last row is zero
    temperature: float
    row: np.ndarray  # each feature's row of the weights

    def probabilities(self, text: str | None) -> np.ndarray | None:
        if not self.languages or not has_letter(text):
            return None
        at, value = vector(text, self.idf)
        return softmax(value @ self.weights[self.row[at]] / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        p = self.probabilities(text)
        return (UNKNOWN, 0.0) if p is None else (self.languages[int(p.argmax())], float(p.max()))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net, one row (features, values, language) at a time.

    Sparse weights as (row of each feature, rows): features without any weight share the last row, which is zero.
    """
    seen = np.zeros(FEATURES, bool)
    for at, _, _ in rows:
        seen[at] = True
    place = np.cumsum(seen) - 1
    z, n = np.zeros((int(seen.sum()), languages)), np.zeros((int(seen.sum()), languages))

    def leader(at: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z[at]) <= L1, 0, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for features, value, label in rows:
            at = place[features]
            w = leader(at)
            error = softmax(value @ w)
            error[label] -= 1
            gradient = value[:, None] * error
            squares = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / ALPHA * w
            n[at] += squares
    weights = leader(np.arange(len(z)))
    held = np.flatnonzero(weights.any(axis=1))
    row = np.full(FEATURES, len(held), np.int32)
    row[np.flatnonzero(seen)[held]] = np.arange(len(held))
    return row, np.concatenate([weights[held], np.zeros((1, languages))])


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, on a geometric grid."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.02, 20, 121)
    loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Rows that hold each feature, and all rows with a letter; vectors of tasks are summed 32 at a time."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, np.int64)
        for _, texts in chunks(batches):
            for text in filter(has_letter, texts):
                total[counts(text)[0]] += 1
                total[FEATURES] += 1
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()])], ["part", "total"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in group["total"])
        return pd.DataFrame({"part": [int(group["part"].iloc[0]) // 32], "total": [total.tobytes()]})

    tasks = rows.rdd.getNumPartitions()
    summed = rows.select("text").mapInArrow(count, "part long, total binary")
    while tasks > 32:
        summed = summed.groupBy(F.expr("part div 32")).applyInPandas(add, "part long, total binary")
        tasks = -(-tasks // 32)
    total = sum((np.frombuffer(r["total"], np.int64) for r in summed.collect()), np.zeros(FEATURES + 1, np.int64))
    return total[:-1], int(total[-1])


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int = PER_LANGUAGE) -> Model:
    """A model from the rows with a label; the documents' id only picks the bounded sample."""
    rows = bounded_batches(rows).select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    shares = rows.groupBy("lang").count().orderBy("lang").collect()
    if not shares:
        return Model([], np.ones(FEATURES), np.zeros((1, 0)), 1.0, np.zeros(FEATURES, np.int32))
    frequency, total = _document_frequencies(rows)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    languages = sorted(r["lang"] for r in shares)
    limit = F.create_map(*(F.lit(x) for r in shares for x in (r["lang"], min(1 << 31, (per_language << 31) // r["count"]))))[F.col("lang")]
    key = F.shiftrightunsigned(F.xxhash64("id", "text"), 33)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            found = [vector(t, idf) for t in texts]
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1),
                pa.array([at.astype(np.int32).tobytes() for at, _ in found]), pa.array([v.astype(np.float32).tobytes() for _, v in found])],
                ["key", "lang", "features", "values"])

    sample = rows.where(key < limit).select(key.alias("key"), "lang", "text").mapInArrow(vectors, "key long, lang string, features binary, values binary")
    known = {name: i for i, name in enumerate(languages)}
    learned: list = []
    held: list = []
    for r in sorted(sample.collect(), key=lambda r: (r["key"], r["lang"])):  # by the hash: a fixed random order
        if r["features"]:
            row = (np.frombuffer(r["features"], np.int32), np.frombuffer(r["values"], np.float32).astype(float), known[r["lang"]])
            (held if zlib.crc32(r["features"]) % 10 == 0 else learned).append(row)
    row, weights = follow_the_leader(learned, len(languages))
    logits = np.array([v @ weights[row[at]] for at, v, _ in held]).reshape(len(held), len(languages))
    return Model(languages, idf, weights, fit_temperature(logits, np.array([y for *_, y in held], int)), row)


def predicted(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row; score is the calibrated probability of lang_pred."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES by labels at most

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            found = [shared.value.predict(t) for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return bounded_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(predict, SCHEMA)


def accepted(text: Column, model: Model, session, min_score: float = MIN_SCORE) -> Column:
    """Whether the text has a language and it is predicted with at least min_score."""
    shared = session.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accept(texts: pd.Series) -> pd.Series:
        keep_only()
        return texts.map(lambda t: shared.value.predict(t)).map(lambda p: p[0] != UNKNOWN and p[1] >= min_score)

    return accept(F.coalesce(text, F.lit("")))
