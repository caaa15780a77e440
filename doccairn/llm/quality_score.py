"""Quality classifier: naive Bayes features in a support vector machine.

Features are indicators of hashed n-grams: characters as they stand, and runs of character
classes (word shapes and marks), and the share of words that repeat the one before. Each
indicator is scaled by the log-count ratio of its classes; a linear hinge-loss model is fitted
on the scaled rows by dual coordinate descent and its margin is turned into a probability.

The fit reads a bounded sample of labelled rows (``sample_rows``); every text is scored whole.

Defined results: null and empty texts have no indicators and get the score of the bias alone.
If no labelled row is left, or all carry one label, every score is the smoothed label share.
Rows of ``labels`` that repeat an id are training rows each; null labels are left out. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doccairn.llm.grams import code_points, pieces

BITS = 16
WIDTH = 1 << BITS
CHARACTER_ORDERS = (2, 3)
SHAPE_ORDERS = (2, 3, 4)
#: Bound of the training sample, in rows.
SAMPLE_ROWS = 4000
#: Upper edges of the shares of words equal to the word before.
REPEAT_EDGES = (0.0, 0.005, 0.02, 0.1, 0.3, 1.0)
COST, EPOCHS, MIX, SEED = 1.0, 20, 0.75, 17


@dataclass(frozen=True)
class QualityModel:
    #: Row 0: fitted weight times ratio of each feature; row 1: squared ratio, for the norm.
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def _shape_table() -> np.ndarray:
    """Class of each code point below 65,536: letters by case, digits, blanks, else itself."""
    classes = np.arange(1 << 16, dtype=np.uint32)
    for code in range(1 << 16):
        character = chr(code)
        if character.isupper():
            classes[code] = 65
        elif character.isalpha():
            classes[code] = 97
        elif character.isdigit():
            classes[code] = 48
    return classes


_SHAPES: list[np.ndarray] = []


def indicators(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    if not text:
        return np.empty(0, dtype=np.int64)
    if not _SHAPES:
        _SHAPES.append(_shape_table())
    seen = np.zeros(WIDTH * 2 + len(REPEAT_EDGES), dtype=bool)
    codes = code_points(text)
    for order in CHARACTER_ORDERS:
        for part in pieces(codes, order, BITS):
            seen[part] = True
    shapes = np.where(codes < 1 << 16, _SHAPES[0][np.minimum(codes, (1 << 16) - 1)], codes)
    edges = np.concatenate([[True], shapes[1:] != shapes[:-1]])
    for order in SHAPE_ORDERS:
        for part in pieces(shapes[edges], order, BITS):
            seen[WIDTH + part.astype(np.int64)] = True
    words = text.split()
    if words:
        share = sum(map(eq, words, words[1:])) / len(words)
        seen[WIDTH * 2 + int(np.searchsorted(REPEAT_EDGES, share))] = True
    return np.flatnonzero(seen)


def train(rows: list[np.ndarray], labels: np.ndarray) -> QualityModel:
    """Dual coordinate descent on indicator rows scaled by log-count ratios."""
    width, positive = WIDTH * 2 + len(REPEAT_EDGES), labels == 1
    share = (positive.sum() + 1.0) / (len(labels) + 2.0)
    if positive.all() or not positive.any():
        return QualityModel(np.zeros((2, width)), 0.0, 0.0, float(np.log(share / (1 - share))))
    good, bad = np.ones(width), np.ones(width)
    for row, label in zip(rows, positive):
        (good if label else bad)[row] += 1
    ratio = np.log(good / good.sum()) - np.log(bad / bad.sum())
    values = [ratio[r] / max(1e-9, float(np.sqrt((ratio[r] ** 2).sum()))) for r in rows]
    signs = np.where(positive, 1.0, -1.0)
    weights, bias, alpha = np.zeros(width), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(SEED)
    square = np.array([float(v @ v) + 1.0 for v in values])
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (float(weights[rows[i]] @ values[i]) + bias) - 1.0
            moved = min(max(alpha[i] - gradient / square[i], 0.0), COST)
            step = (moved - alpha[i]) * signs[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                alpha[i] = moved
    weights = (1 - MIX) * np.abs(weights).mean() + MIX * weights
    margins = np.array([float(weights[r] @ v) + bias for r, v in zip(rows, values)])
    slope, offset = _calibrate(margins, positive)
    return QualityModel(np.stack([weights * ratio, ratio**2]), bias, slope, offset)


def _calibrate(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset by Newton steps, with smoothed targets."""
    ups, downs = positive.sum(), (~positive).sum()
    target = np.where(positive, (ups + 1) / (ups + 2), 1 / (downs + 2))
    point = np.array([1.0, 0.0])
    columns = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(columns @ point, -35, 35)))
        curve = columns.T @ (columns * (chance * (1 - chance))[:, None]) + 1e-3 * np.eye(2)
        point = point - np.linalg.solve(curve, columns.T @ (chance - target) + 1e-3 * point)
    return float(point[0]), float(point[1])


def score_one(model: QualityModel, text: str | None) -> float:
    row = indicators(text)
    margin = model.bias
    if len(row):
        margin += float(model.weights[0, row].sum() / max(1e-9, np.sqrt(model.weights[1, row].sum())))
    return float(1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -35, 35))))


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Fit on ``documents(id, text)`` and ``labels(id, label)``.

    ``sample_rows`` label rows, the first by a hash of the id, are kept; that bounded list is
    broadcast, so no text is shuffled and the driver gets the sample's indicators only.
    """
    known = labels.where("id is not null and label is not null")
    total = known.count()
    share = min(1.0, 2.0 * sample_rows / total) if total else 1.0
    chosen = (
        known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
        .orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows)
    )

    @F.pandas_udf("array<long>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([indicators(t) for t in texts])

    rows = (
        documents.join(F.broadcast(chosen), "id")
        .select("id", "label", features("text").alias("features")).collect()
    )
    rows.sort(key=lambda r: (r["id"], r["label"], len(r["features"]), r["features"]))
    return train([np.asarray(r["features"], dtype=np.int64) for r in rows], np.array([r["label"] for r in rows]))


def quality(model: QualityModel, text: Column) -> Column:
    """Score between 0 and 1 for a text column."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for texts in batches:
            yield pd.Series([score_one(known, t) for t in texts], dtype="float64")

    return score(text)
