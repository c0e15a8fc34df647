"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart.llm.tokens import Words, pieces
from tapmart.session import freeze

THRESHOLD = 0.7
# Share of the pooled covariance, and of the identity, in a class covariance.
TO_POOLED, TO_IDENTITY = 0.2, 0.02

STATISTICS = (
    "words", "bytes", "word_length", "length_spread", "upper", "digits", "stops", "marks",
    "symbols", "lines", "distinct", "short", "long", "odd_ends", "top_word", "stutter",
)
_CLASSES = np.zeros((5, 256), dtype=bool)
_CLASSES[0, ord("A") : ord("Z") + 1] = True
_CLASSES[1, ord("0") : ord("9") + 1] = True
_CLASSES[2, [ord(c) for c in ".,"]] = True
_CLASSES[3, [ord(c) for c in "!?;:'\"()-"]] = True
_CLASSES[4, [ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True


def _sums(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[stops] - total[starts]


def statistics_of(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text; counts by logarithm, shares by square root.

    A text without words has zeros except for its length. Null counts as empty.
    """
    texts = texts.fill_null("")
    raw = pa.concat_arrays([texts.cast(pa.large_string())])
    words = Words(raw)
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    buffer = raw.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    a, b = words.offsets[:-1], words.offsets[1:]
    low, high = words.bounds[:-1], words.bounds[1:]
    size = np.maximum(b - a, 1).astype(float)
    count = (high - low).astype(float)
    safe = np.maximum(count, 1)
    length = (words.end - words.start).astype(float)
    mean = _sums(length, low, high) / safe
    spread = np.sqrt(np.maximum(_sums(length * length, low, high) / safe - mean * mean, 0))
    shares = [np.sqrt(_sums(_CLASSES[i][data], a, b) / size) for i in range(5)]
    lines = _sums(data == 10, a, b)
    last = data[words.end - 1] if len(words.end) else data[:0]
    ends_odd = _CLASSES[3][last] | _CLASSES[4][last]
    hashes = words.hashes()
    distinct, top = np.zeros(len(raw)), np.zeros(len(raw))
    for row, (start, stop) in enumerate(zip(low, high)):
        if stop > start:
            _, repeats = np.unique(hashes[start:stop], return_counts=True)
            distinct[row], top[row] = len(repeats), repeats.max()
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
    columns = [
        np.log1p(count), np.log1p(b - a), np.log1p(mean), np.log1p(spread), *shares,
        np.sqrt(lines / safe), np.log1p(distinct) - np.log1p(count),
        np.sqrt(_sums(length <= 3, low, high) / safe), np.sqrt(_sums(length >= 12, low, high) / safe),
        np.sqrt(_sums(ends_odd, low, high) / safe), np.sqrt(top / safe),
        np.sqrt(_sums(again, low, high) / safe),
    ]
    return np.column_stack(columns)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, part in pieces(batch.column("text")):
            rows = statistics_of(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(start, len(part)), pa.array(list(rows))],
                ["id", "statistics"],
            )


def document_statistics(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``id, statistics`` per row, from the whole text."""
    given = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    return given.mapInArrow(_described, f"id {kind}, statistics array<double>")


@dataclass
class QuadraticDiscriminant:
    """Class means, Cholesky factors of the class covariances, and the offsets of the densities."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray

    @classmethod
    def from_moments(cls, counts, sums, products) -> "QuadraticDiscriminant | None":
        """From per-class counts, sums and sums of products; None unless both classes occur."""
        counts = np.asarray(counts, float)
        if len(counts) != 2 or counts.min() < 1:
            return None
        means = sums / counts[:, None]
        scatter = products - counts[:, None, None] * means[:, :, None] * means[:, None, :]
        pooled = scatter.sum(axis=0) / counts.sum()
        size = pooled.shape[0]
        factors, offsets = [], []
        for k in range(2):
            own = (1 - TO_POOLED) * scatter[k] / counts[k] + TO_POOLED * pooled
            level = np.trace(pooled) / size + 1e-9
            own = (1 - TO_IDENTITY) * own + TO_IDENTITY * level * np.eye(size)
            factor = np.linalg.cholesky(own)
            factors.append(np.linalg.inv(factor))
            offsets.append(np.log(counts[k] / counts.sum()) - np.log(np.diag(factor)).sum())
        return cls(means, np.array(factors), np.array(offsets))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        densities = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            y = (x - mean) @ factor.T
            densities.append(offset - 0.5 * (y * y).sum(axis=1))
        return densities[1] - densities[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x), -700, 700)))


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per class of a task: count, sums and sums of products, one number a row."""
    width = len(STATISTICS) + 1
    totals = np.zeros((2, width, width))
    for pdf in batches:
        if len(pdf):
            x = np.column_stack([np.ones(len(pdf)), np.stack(pdf["statistics"].to_numpy())])
            for k in range(2):
                own = x[pdf["label"].to_numpy() == k]
                totals[k] += own.T @ own
    labels, rows, columns = np.nonzero(np.ones_like(totals))
    yield pd.DataFrame(
        {"label": labels, "i": rows, "j": columns, "value": totals.ravel()}
    ).astype({"label": "int32", "i": "int32", "j": "int32"})


def fit_quality(
    statistics: DataFrame, labels: DataFrame, learn: Column, id_column: str = "doc_id",
    label: str = "quality",
) -> QuadraticDiscriminant | None:
    """Fit on all rows of ``statistics`` that satisfy ``learn`` and have a label of 0 or 1.

    Only sums travel: the classes' moments, whose number is fixed.
    """
    marked = (
        labels.where(F.col(label).isin(0, 1))
        .select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
        .distinct()
    )
    rows = statistics.where(learn).join(marked, "id").select("statistics", "label")
    sums = (
        rows.mapInPandas(_moments, "label int, i int, j int, value double")
        .groupBy("label", "i", "j")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    width = len(STATISTICS) + 1
    totals = np.zeros((2, width, width))
    totals[sums["label"], sums["i"], sums["j"]] = sums["value"]
    return QuadraticDiscriminant.from_moments(totals[:, 0, 0], totals[:, 0, 1:], totals[:, 1:, 1:])


def score_quality(
    statistics: DataFrame, model: QuadraticDiscriminant | None, threshold: float = THRESHOLD
) -> DataFrame:
    """``statistics`` with ``score`` and ``predicted``. Without a model every score is 0.5."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            score = np.full(len(pdf), 0.5)
            if model is not None and len(pdf):
                score = model.scores(np.stack(pdf["statistics"].to_numpy()))
            yield pdf.assign(score=score)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in statistics.schema)
    scored = statistics.mapInPandas(add, f"{fields}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def frozen_statistics(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The statistics, written once: fitting and scoring both read them."""
    return freeze(document_statistics(docs, text, id_column), "quality-statistics")
