"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Statistics are shares and means of a whole text's bytes and words, computed
in vectorised passes over Arrow batches and transformed to tame their tails.
Means and covariances of both classes come from one grouped sum over all
labelled rows that are not held out; each class covariance is shrunk towards
the pooled one and towards its scaled diagonal.  The driver factorises two
small matrices once (Cholesky); tasks score with the cached factors: the
difference of the log densities, by Mahalanobis distances, plus that of the
log priors, through the logistic function.

Defined results: a null text counts as empty; an empty text has all
statistics 0 and a score like any other; a null id is never labelled and not
held out; repeated rows and repeated labels count each time; rows with null
quality teach nothing; without labels of both classes nothing can be told
apart and every score is 1; an empty table gives no rows; other columns (lang,
source, the id and the labels among them) are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import buffers, pieces, word_hashes
from .shared import python_tasks, store

FEATURES = ("signs", "bars", "capitals", "capital_words", "digits", "stops", "word_length", "repeats", "returns", "lines", "foreign")
#: Weight of the pooled covariance, and of the scaled diagonal, in each class covariance.
POOLED, DIAGONAL = 0.2, 0.05
THRESHOLD = 0.7


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER = _class(bytes(range(65, 91)))
_LETTER = _class(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGIT = _class(bytes(range(48, 58)))
_STOP = _class(b".,;:?'\"-()/@")
_SIGN = _class(bytes(set(range(33, 127)) - set(range(48, 58)) - set(range(65, 91)) - set(range(97, 123)) - set(b".,;:?'\"-()/@")))
_BAR = _class(b"|!*#$%&")
_LINE = _class(b"\n")


def statistics(column: pa.Array) -> np.ndarray:
    """A row of transformed statistics for each text of a string column."""
    raw, off = buffers(column)
    out = np.zeros((len(off) - 1, len(FEATURES)))
    for first, last in pieces(off):
        out[first:last] = _some(raw[off[first]:off[last]], off[first:last + 1] - off[first])
    return out


def _some(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    n = np.diff(off)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[off[1:]] - total[off[:-1]]

    text, length, h = word_hashes(raw, off)
    words = np.bincount(text, minlength=len(n)) if len(text) else np.zeros(len(n))
    same = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    back2 = (h[2:] == h[:-2]) & (text[2:] == text[:-2])
    repeats = np.bincount(text[1:][same], minlength=len(n)) if len(h) > 1 else np.zeros(len(n))
    returns = np.bincount(text[2:][back2], minlength=len(n)) if len(h) > 2 else np.zeros(len(n))
    upper = _UPPER[raw]
    inner = upper.copy()
    inner[1:] &= upper[:-1]  # a capital after a capital
    inner[off[:-1][off[:-1] < len(raw)]] = False  # a text's first character has none before it
    letters = np.maximum(count(_LETTER[raw]), 1)
    size, many = np.maximum(n, 1), np.maximum(words, 1)
    shares = [count(_SIGN[raw]) / size, count(_BAR[raw]) / many, count(upper) / letters, count(inner) / letters, count(_DIGIT[raw]) / size,
              count(_STOP[raw]) / many, np.log1p(np.bincount(text, weights=length, minlength=len(n)) / many if len(text) else 0 * size),
              repeats / many, returns / many, count(_LINE[raw]) / many, count(raw >= 128) / letters]
    return np.stack([np.sqrt(s) if i not in (5, 6) else s for i, s in enumerate(shares)], 1) * (n > 0)[:, None]


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


@dataclass
class Model:
    """Means, inverse Cholesky factors and log constants of both classes; empty if nothing was learnt."""

    mean: list[np.ndarray]
    factor: list[np.ndarray]
    constant: list[float]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.mean:
            return np.ones(len(x))
        density = [c - 0.5 * np.square((x - m) @ f.T).sum(1) for m, f, c in zip(self.mean, self.factor, self.constant)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -40, 40)))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every row."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), _lists(statistics(b.column(1)))], ["id", "x"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, x array<double>")


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))


def fit(stats: DataFrame, labels: DataFrame, label_id: str = "doc_id", label_col: str = "quality") -> Model:
    """Learn from the labelled rows of ``stats`` (id, x) that are not held out: one grouped sum of
    1, x and the products of x, so the driver gets two rows however many labels there are."""
    d = len(FEATURES)
    known = labels.select(F.col(label_id).alias("id"), F.col(label_col).alias("label")).filter("label in (0, 1)").filter(~held_out("id"))
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i + 1)]
    rows = {r["label"]: r for r in stats.join(known, "id").groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()}
    if len(rows) < 2:
        return Model([], [], [])
    n, means, scatter = [], [], []
    for label in (0, 1):
        r = rows[label]
        n.append(r["n"])
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        second = np.array([[r[f"p{max(i, j)}_{min(i, j)}"] for j in range(d)] for i in range(d)]) / r["n"]
        means.append(mean)
        scatter.append(second - np.outer(mean, mean))
    pooled = (n[0] * scatter[0] + n[1] * scatter[1]) / sum(n)
    factors, constants = [], []
    for label in (0, 1):
        cov = (1 - POOLED) * scatter[label] + POOLED * pooled
        cov = (1 - DIAGONAL) * cov + DIAGONAL * np.diag(np.diag(cov)) + 1e-6 * np.eye(d)
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        constants.append(float(np.log(n[label] / sum(n)) - np.log(np.diag(low)).sum()))
    return Model(means, factors, constants)


def score_statistics(stats: DataFrame, model: Model) -> DataFrame:
    """(id, score) of stored statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.record_batch([b.column(0), pa.array(model.score(x))], ["id", "score"])

    return stats.select("id", "x").mapInArrow(run, f"id {stats.schema['id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    stats = store(with_statistics(docs, id_col, text_col), "statistics")
    scored = score_statistics(stats, fit(stats, labels))
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all columns, without the rows that the model rejects; texts are scored where
    they are read, without a shuffle."""
    python_tasks(docs.sparkSession)
    model = fit(store(with_statistics(docs, id_col, text_col), "statistics"), labels)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(statistics(b.column(at))) >= threshold))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names with dots can't be passed to Python
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
