"""Text quality by positive-unlabelled learning.

Trusted positives and unlabelled texts train a linear model on statistics of the text. Its risk is
estimated without negatives: what the unlabelled texts cost as negatives, less the share of it that
the positives among them cost, and that difference never counts below zero. The class prior is
estimated from the labelled rows that may be learned from.

Defined cases. A null text is empty; an empty text has zero statistics and a score like any other.
Rows without a label are unlabelled, and a label for an unknown id is ignored; of several labels
for an id the smallest counts. Null ids have no label and are held out. With no positives, every
score is the prior, 0.5 if no label is known. Repeated rows and other columns do not matter, and
columns of the output names are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .work import saved

FOLDS = 5
THRESHOLD = 0.3
STEPS = 12
# Of the squared weights, over the number of positives.
PENALTY = 3.0
CLIP = 5.0

_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASSES = np.zeros(256, np.int64)
_CLASSES[ord("a"):ord("z") + 1] = 1
_CLASSES[ord("A"):ord("Z") + 1] = 2
_CLASSES[ord("0"):ord("9") + 1] = 3
_CLASSES[[0x20, 0x09]] = 4
_CLASSES[0x0A:0x0E] = 5
_CLASSES[0x80:] = 6
for _k, _c in enumerate(_MARKS):
    _CLASSES[ord(_c)] = 7 + _k
N_CLASSES = 7 + len(_MARKS)
N_FEATURES = N_CLASSES + 11


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of ``N_FEATURES`` numbers per text: sizes, shares of kinds of bytes, repetition."""
    data, bounds = ta.text_bytes(texts)
    n, size = len(texts), np.diff(bounds)
    out = np.zeros((n, N_FEATURES), np.float32)
    if not len(data):
        return out
    owner = np.repeat(np.arange(n), size)
    kinds = np.bincount(owner * N_CLASSES + _CLASSES[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    out[:, :N_CLASSES] = np.sqrt(kinds / np.maximum(size, 1)[:, None])

    start, end, doc = ta.words(data, bounds)
    n_words = np.bincount(doc, minlength=n)
    per_word = np.maximum(n_words, 1)
    hashes, length = ta.span_hashes(data, start, end), end - start
    follows = doc[1:] == doc[:-1]
    repeats = np.bincount(doc[1:][follows & (hashes[1:] == hashes[:-1])], minlength=n)
    pairs = ta.mixed(hashes[:-1] * np.uint64(3) + hashes[1:])[follows]
    pair_doc = doc[1:][follows]
    shouted = _CLASSES[data[end - 1]]
    marked = np.bincount(doc[shouted >= 7], minlength=n)

    # Lines end at a line feed and with the text.
    feeds = np.flatnonzero(data == 0x0A)
    line_end = np.sort(np.concatenate([feeds, bounds[1:]]))
    line_start = np.concatenate([[0], line_end[:-1] + (data[np.minimum(line_end[:-1], len(data) - 1)] == 0x0A)])
    line_start = np.minimum(line_start, line_end)
    line_doc = np.minimum(np.searchsorted(bounds, line_start, "right") - 1, n - 1)
    filled = line_end > line_start
    line_start, line_end, line_doc = line_start[filled], line_end[filled], line_doc[filled]
    n_lines = np.maximum(np.bincount(line_doc, minlength=n), 1)

    mean = np.bincount(doc, length, n) / per_word
    out[:, N_CLASSES:] = np.stack([
        np.log1p(size), np.log1p(n_words), mean,
        np.sqrt(np.maximum(np.bincount(doc, length * length, n) / per_word - mean * mean, 0)),
        np.sqrt(repeats / per_word), np.sqrt(marked / per_word),
        ta.distinct_counts(doc, hashes, n) / per_word,
        ta.distinct_counts(pair_doc, pairs, n) / np.maximum(n_words - 1, 1),
        np.log1p(size / n_lines), np.log1p(n_lines),
        ta.distinct_counts(line_doc, ta.span_hashes(data, line_start, line_end), n) / n_lines,
    ], axis=1)
    out[size == 0] = 0
    return out


def expanded(features: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Standardised features, their squares, and a constant."""
    z = np.clip((features - mean) / spread, -CLIP, CLIP)
    return np.concatenate([z, z * z, np.ones((len(z), 1))], axis=1)


# --- tables -----------------------------------------------------------------------------

def featured(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` (id) with ``__features``, ``held_out`` and ``__positive``, a trusted positive to learn from."""
    known = labels.groupBy(doc_id).agg(F.min("quality").alias("__quality"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for piece in ta.slices(part, text):
                flat = text_features(piece.column(1)).ravel()
                rows = pa.FixedSizeListArray.from_arrays(pa.array(flat), N_FEATURES).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([piece.column(0), rows], [doc_id, "__features"])

    schema = docs.select(doc_id, F.array(F.lit(0.0).cast("float")).alias("__features")).schema
    fold = F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % FOLDS
    held_out = F.coalesce(fold == 0, F.lit(True))
    return (
        docs.select(doc_id, text).mapInArrow(batches, schema)
        .join(known, doc_id, "left")
        .withColumn("held_out", held_out)
        .withColumn("__known", F.when(~held_out, F.col("__quality")))
        .drop("__quality")
    )


def _summed(table: DataFrame, sums, size: int) -> np.ndarray:
    """The sum of ``sums(features, known)``, ``size`` numbers, over all batches of the table."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for part in parts:
            flat = part.column("__features").flatten().to_numpy(zero_copy_only=False)
            known = part.column("__known").to_numpy(zero_copy_only=False).astype(float)
            total += sums(flat.reshape(-1, N_FEATURES).astype(float), known)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["k", "v"])

    rows = table.select("__features", "__known").mapInArrow(batches, "k long, v double")
    found = rows.groupBy("k").agg(F.sum("v").alias("v")).collect()  # ``size`` rows
    out = np.zeros(size)
    for row in found:
        out[row["k"]] = row["v"]
    return out


class Model:
    """A fitted scorer; ``weights`` is None if there was nothing to learn from."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray | None, prior: float) -> None:
        self.mean, self.spread, self.weights, self.prior = mean, spread, weights, prior

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.prior)
        return 1 / (1 + np.exp(-np.clip(expanded(features, self.mean, self.spread) @ self.weights, -500, 500)))


def fit(table: DataFrame, prior: float | None = None, steps: int = STEPS, penalty: float = PENALTY) -> Model:
    """Minimises the non-negative risk over all rows of a table of :func:`featured`.

    With the logistic loss the unbiased risk is convex, so each step is a Newton step on sums
    over the whole table; it is halved until the non-negative risk falls.
    """
    def moments(x: np.ndarray, known: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x), (known == 1).sum(), (known == 0).sum()], x.sum(0), (x * x).sum(0)])

    n, n_positive, n_negative, *rest = _summed(table, moments, 3 + 2 * N_FEATURES)
    mean = np.array(rest[:N_FEATURES]) / max(n, 1)
    spread = np.sqrt(np.maximum(np.array(rest[N_FEATURES:]) / max(n, 1) - mean * mean, 1e-6))
    if prior is None:
        prior = n_positive / (n_positive + n_negative) if n_positive + n_negative else 0.5
    if not n_positive:
        return Model(mean, spread, None, prior)
    penalty /= n_positive
    dims = 2 * N_FEATURES + 1
    upper = np.triu_indices(dims)

    def parts_at(weights: np.ndarray):
        def sums(x: np.ndarray, known: np.ndarray) -> np.ndarray:
            x = expanded(x, mean, spread)
            margin, positive = x @ weights, known == 1
            p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            return np.concatenate([
                [np.logaddexp(0, margin).sum(), np.logaddexp(0, margin[positive]).sum(),
                 np.logaddexp(0, -margin[positive]).sum()],
                x[positive].sum(0), p @ x, ((x * (p * (1 - p))[:, None]).T @ x)[upper]])

        found = _summed(table, sums, 3 + 2 * dims + len(upper[0]))
        as_negative, positive_as_negative, positive_cost = found[:3]
        below = as_negative / n - prior * positive_as_negative / n_positive
        risk = prior * positive_cost / n_positive + max(0.0, below) + penalty * weights @ weights
        slope = -prior * found[3:3 + dims] / n_positive + found[3 + dims:3 + 2 * dims] / n + 2 * penalty * weights
        bend = np.zeros((dims, dims))
        bend[upper] = found[3 + 2 * dims:] / n
        bend = np.triu(bend) + np.triu(bend, 1).T + 2 * penalty * np.eye(dims)
        return risk, slope, bend

    weights = np.zeros(dims)
    risk, slope, bend = parts_at(weights)
    step = np.linalg.solve(bend, slope)
    for _ in range(steps):
        tried = parts_at(weights - step)
        if tried[0] >= risk:
            step = step / 2
            continue
        done = risk - tried[0] < 1e-5
        weights, (risk, slope, bend) = weights - step, tried
        if done:
            break
        step = np.linalg.solve(bend, slope)
    return Model(mean, spread, weights, prior)


def scored(table: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """A table of :func:`featured` with ``score`` and ``predicted``."""
    base = table.drop("__known")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            flat = part.column("__features").flatten().to_numpy(zero_copy_only=False)
            score = pa.array(model.scores(flat.reshape(-1, N_FEATURES).astype(float)))
            kept = part.drop_columns(["__features"])
            yield pa.RecordBatch.from_arrays([*kept.columns, score], [*kept.schema.names, "score"])

    return base.mapInArrow(batches, base.drop("__features").schema.add("score", "double")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
    prior: float | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """Id, ``held_out``, ``score`` and ``predicted`` of each row of ``docs``."""
    table = saved(featured(docs, labels, text, doc_id), "features")
    return scored(table, fit(table, prior), threshold)


def keep_good(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` without the rows whose text scores below the threshold.

    The model is small and goes to the texts, so texts are not shuffled.
    """
    model = fit(saved(featured(docs, labels, text, doc_id), "features"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for piece in ta.slices(part, text):
                good = model.scores(text_features(piece.column(text)).astype(float)) >= threshold
                yield piece.filter(pa.array(good))

    return docs.mapInArrow(batches, docs.schema)
