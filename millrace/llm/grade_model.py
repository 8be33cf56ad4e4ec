"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed words.

Grades come from ``labels``: 0 for toxic, 1 for poor, 2 for good texts. One weight for each hashed
feature is shared by all thresholds: P(grade <= j) = 1 / (1 + exp(score - threshold_j)). Documents
get their expected grade and the probability of each grade or a better one, and are kept if
that of the best grade is at least ``least``.

The fit uses at most ``rows`` labelled documents, those with the smallest hashes of their ids; all
documents are scored over their whole texts. Features of fewer than ``floor`` of them get no weight. Null text has no features and gets the prior; rows with null labels or
doc_id are not learnt from. With fewer than two grades the model is the prior. Repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import raw_bytes

GRADES = 3
EDGES = b".,;:!?\"'()[]"


@dataclass(frozen=True)
class Fit:
    rows: int = 8_000
    features: int = 1 << 17
    floor: int = 8
    penalty: float = 1e-3
    rounds: int = 150
    least: float = 0.4


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ..."""
        return sigmoid(scores[:, None] - self.thresholds)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Features(dict):
    """Hashed features of a word: the word itself, and its form where that is unusual."""

    LIMIT = 300_000

    def __init__(self, size: int):
        super().__init__()
        self.mask = size - 1

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= self.LIMIT:
            self.clear()
        core = word.strip(EDGES).lower()
        marks = bytes(c for c in word if 32 < c < 127 and not chr(c).isalnum())
        form = b"\0" + marks[:3] + (b"U" if word.isupper() and len(word) > 1 else b"") + (b"9" if any(48 <= c < 58 for c in word) else b"")
        found = self[word] = (zlib.crc32(core) & self.mask, zlib.crc32(form) & self.mask)
        return found


def features(raw: bytes, cache: Features) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and values; a word counts once, a form by its share among words."""
    words = raw.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    pairs = np.array([cache[w] for w in words], np.int64)
    word_ids = np.unique(pairs[:, 0])
    form_ids, counts = np.unique(pairs[:, 1], return_counts=True)
    values = np.concatenate([np.full(len(word_ids), 1.0), 4.0 * counts / len(words)])
    return np.concatenate([word_ids, form_ids]), values.astype(np.float32)


def grades(labels: DataFrame) -> DataFrame:
    graded = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)
    return graded.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade).alias("grade"))


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    chosen = grades(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.rows)
    rows = docs.select(F.col("doc_id").cast("long"), raw_bytes().alias("t")).join(chosen, "doc_id")
    hashed = rows.select("doc_id", "t", "grade", F.xxhash64("t").alias("hash"))
    size = fit.features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Features(size)
        for batch in batches:
            found = [features(t, cache) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array([f.astype("<i4").tobytes() for f, _ in found], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())], names=["doc_id", "grade", "hash", "f", "v"])

    # At most ``fit.rows`` labels, and of a repeated doc_id the row whose text has the least hash.
    made = hashed.mapInArrow(run, "doc_id long, grade int, hash long, f binary, v binary")
    table = one_row_each(made).toArrow().sort_by("doc_id")
    grade = table["grade"].to_pylist()
    ids = [np.frombuffer(f, "<i4") for f in table["f"].to_pylist()]
    values = [np.frombuffer(v, "<f4") for v in table["v"].to_pylist()]
    return learn(np.array(grade, np.int64), ids, values, fit)


def one_row_each(made: DataFrame) -> DataFrame:
    """``grade, f, v`` once for each doc_id; copies go before anything is collected."""
    least = made.groupBy("doc_id").agg(F.min(F.struct("hash", "grade", "f", "v")).alias("row"))
    return least.select("doc_id", "row.grade", "row.f", "row.v")


def learn(grade: np.ndarray, ids: list[np.ndarray], values: list[np.ndarray], fit: Fit) -> Model:
    """Maximum likelihood with a squared penalty, by Adam over all rows at once."""
    shares = np.array([(np.sum(grade >= j) + 1) / (len(grade) + 2) for j in range(1, GRADES)])
    thresholds = -np.log(shares / (1 - shares))
    weights = np.zeros(fit.features)
    if len(np.unique(grade)) < 2:
        return Model(weights, thresholds)
    column, value = np.concatenate(ids), np.concatenate(values).astype(np.float64)
    row = np.repeat(np.arange(len(grade)), [len(i) for i in ids])
    common = np.bincount(column, minlength=fit.features)[column] >= min(fit.floor, len(grade))
    column, value, row = column[common], value[common], row[common]
    m, v = np.zeros(fit.features + GRADES - 1), np.zeros(fit.features + GRADES - 1)
    edges = lambda t: np.r_[-np.inf, t, np.inf]
    for step in range(1, fit.rounds + 1):
        score = np.bincount(row, weights[column] * value, len(grade))
        ends = edges(thresholds)
        upper, lower = sigmoid(ends[grade + 1] - score), sigmoid(ends[grade] - score)
        chance = np.maximum(upper - lower, 1e-12)
        up, down = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        slope = (up - down) / len(grade)  # of the loss by the score
        g_weights = np.bincount(column, slope[row] * value, fit.features) + fit.penalty * weights
        g_ends = np.array([np.sum(down[grade == j + 1]) - np.sum(up[grade == j]) for j in range(GRADES - 1)]) / len(grade)
        g = np.concatenate([g_weights, g_ends])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        weights -= move[: fit.features]
        thresholds = np.sort(thresholds - move[fit.features :])
    return Model(weights, thresholds)


def score(docs: DataFrame, model: Model, fit: Fit = Fit()) -> DataFrame:
    """``doc_id, expected_grade, p_grade_1, p_grade_2, kept`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as ``fit.features``, whatever the input
    size, least = fit.features, fit.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, known = Features(size), shared.value
        for batch in batches:
            found = [features(t, cache) for t in batch.column(1).to_pylist()]
            scores = np.array([known.weights[f] @ v for f, v in found]) if found else np.zeros(0)
            tails = known.tails(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1)), *(pa.array(tails[:, j]) for j in range(GRADES - 1)),
                 pa.array(tails[:, -1] >= least)],
                names=["doc_id", "expected_grade", "p_grade_1", "p_grade_2", "kept"])

    ddl = "doc_id long, expected_grade double, p_grade_1 double, p_grade_2 double, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), raw_bytes().alias("t")).mapInArrow(run, ddl)
