"""Quality rules: counted base rules, then a calibrated logistic regression on hashed n-grams.

Words are maximal runs without ``[\\x20\\x09-\\x0D]``. The base rules count words, characters of
words, symbols, repeated lines and words in repeated windows of three; a text of under 50 words, or
with over half its words in repeated windows, fails them. The regression reads hashed n-grams of
words (a word equal to the one before counts as a mark of its own) and of characters, each family
with logarithmic counts at unit length. Its chance is calibrated on margins of rows that the
margin's own fit did not see, and stands against two fixed thresholds: below ``DROP_BELOW`` a text
goes, from there up to ``KEEP_FROM`` it is kept for review.

The fit reads a bounded sample of labelled rows (``sample_rows``); every text is counted and scored
whole, in Arrow batches.

Defined results: null and empty texts have no words, fail the base rules and get the score of the
bias alone. Without labelled rows of both kinds there is no verdict: the score is the smoothed
share of label 1 and the base rules decide alone. Labels that repeat an id are training rows each;
null ids and labels are left out. Repeated document rows are rows each. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doccairn.llm.grams import code_points, hashed, pieces

BITS = 16
WORD_ORDERS, CHARACTER_ORDERS = (1, 2), (2, 3)
FAMILIES = len(WORD_ORDERS) + len(CHARACTER_ORDERS)
WIDTH = FAMILIES << BITS
#: Bound of the training sample, in rows.
SAMPLE_ROWS = 4000
#: Fixed thresholds of the calibrated chance.
DROP_BELOW, KEEP_FROM = 0.3, 0.7
LEAST_WORDS, MOST_REPEATED = 50, 50
FOLDS, RIDGE, STEPS = 2, 2e-5, 80
SHARE_STEPS = 1 << 30
#: Values of the sample multiplied at once.
BLOCK = 1 << 18
BLANKS, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
#: Stands for a word equal to the one before.
AGAIN = np.uint32(0x5EC0FD)
RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, score double, verdict string"
)


@dataclass(frozen=True)
class RuleModel:
    """``decides`` is false where the sample did not hold both labels."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    decides: bool = True


@dataclass(frozen=True)
class Words:
    """Words of a text as numbers, and the hash of each number's word."""

    numbers: np.ndarray
    hashes: np.ndarray


def words_of(content: bytes) -> Words:
    known: dict[bytes, int] = {}
    found = content.split()
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in found), dtype=np.int64, count=len(found))
    return Words(numbers, np.fromiter(map(crc32, known), dtype=np.uint32, count=len(known)))


def repeated_words(numbers: np.ndarray) -> int:
    """Words inside a window of three that the text holds twice or more."""
    if len(numbers) < 4:
        return 0
    width = int(numbers.max()) + 1
    _, pairs = np.unique(numbers[:-1] * width + numbers[1:], return_inverse=True)
    _, windows, counts = np.unique(pairs[:-1] * width + numbers[2:], return_inverse=True, return_counts=True)
    twice = counts[windows] > 1
    inside = np.zeros(len(numbers), dtype=bool)
    for place in range(3):
        inside[place : place + len(twice)] |= twice
    return int(inside.sum())


def base_counts(text: str, content: bytes, words: Words) -> tuple[int, int, int, int, int]:
    """Words, characters of words, symbols, repeated lines, words in repeated windows."""
    blanks = len(content) - len(content.translate(None, BLANKS))
    symbols = len(content) - len(content.translate(None, SYMBOLS))
    lines = [line for line in content.split(b"\n") if line.strip()]
    return len(words.numbers), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words.numbers)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def features(text: str, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a whole text; words and characters each have length one."""
    shown = words.hashes[words.numbers]
    shown[1:][words.numbers[1:] == words.numbers[:-1]] = AGAIN
    codes = code_points(text)
    buckets, values = [], []
    for first, orders, symbols in ((0, WORD_ORDERS, shown), (len(WORD_ORDERS), CHARACTER_ORDERS, codes)):
        own, counts = [], []
        for place, order in enumerate(orders, first):
            if len(symbols) < 1 << BITS - 3:
                found, times = np.unique(hashed(symbols, order, BITS), return_counts=True)
            else:
                total = np.zeros(1 << BITS, dtype=np.int64)
                for part in pieces(symbols, order, BITS):
                    total += np.bincount(part, minlength=1 << BITS)
                found = np.flatnonzero(total)
                times = total[found]
            own.append(found.astype(np.int32) + (place << BITS))
            counts.append(times)
        weights = 1.0 + np.log(np.concatenate(counts).astype(np.float64))
        buckets.append(np.concatenate(own))
        values.append(weights / max(1.0, np.sqrt(weights @ weights)))
    return np.concatenate(buckets), np.concatenate(values)


class Sample:
    """Rows of buckets and values end to end, walked in blocks of bounded size."""

    def __init__(self, buckets: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray):
        lengths = np.array([len(b) + 1 for b in buckets], dtype=np.int64)
        self.labels = (np.asarray(labels) == 1).astype(np.float64)
        self.ends = np.cumsum(lengths)
        self.buckets, self.values = np.full(lengths.sum(), WIDTH, dtype=np.int32), np.ones(lengths.sum(), dtype=np.float32)
        for end, own, weights in zip(self.ends, buckets, values):
            self.buckets[end - 1 - len(own) : end - 1] = own
            self.values[end - 1 - len(own) : end - 1] = weights

    def blocks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, their buckets and values, and where each row begins among these."""
        first, begin = 0, 0
        while first < len(self.ends):
            last = max(first + 1, int(np.searchsorted(self.ends, begin + BLOCK, side="right")))
            end = int(self.ends[last - 1])
            starts = np.concatenate([[0], self.ends[first : last - 1] - begin])
            yield slice(first, last), self.buckets[begin:end], self.values[begin:end], starts
            first, begin = last, end

    def margins(self, weights: np.ndarray) -> np.ndarray:
        parts = [np.add.reduceat(weights[b] * v, starts) for _, b, v, starts in self.blocks()]
        return np.concatenate(parts) if parts else np.zeros(0)


def regress(sample: Sample, used: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Ridge-penalized logistic weights of the ``used`` rows, the bias last, by accelerated gradient steps."""
    weights = np.zeros(WIDTH + 1)
    ahead, pace, share = weights, 1.0, used / used.sum()
    # Rows have length sqrt(3) at most, which bounds the curvature.
    step = 1.0 / (0.25 * 3.0 + RIDGE)
    for _ in range(steps):
        slope = RIDGE * ahead
        for rows, buckets, values, starts in sample.blocks():
            margins = np.add.reduceat(ahead[buckets] * values, starts)
            errors = share[rows] * (1.0 / (1.0 + np.exp(-np.clip(margins, -35, 35))) - sample.labels[rows])
            slope += np.bincount(buckets, values * np.repeat(errors, np.diff(starts, append=len(values))), WIDTH + 1)
        moved = ahead - step * slope
        quicker = (1.0 + np.sqrt(1.0 + 4.0 * pace * pace)) / 2.0
        ahead = moved + (pace - 1.0) / quicker * (moved - weights)
        weights, pace = moved, quicker
    return weights


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins, with smoothed targets."""
    ups = labels.sum()
    downs = len(labels) - ups
    wanted = np.where(labels == 1, (ups + 1) / (ups + 2), 1 / (downs + 2))
    design, point = np.stack([margins, np.ones_like(margins)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(design @ point, -35, 35)))
        curve = design.T @ (design * (chance * (1 - chance))[:, None]) + 1e-3 * np.eye(2)
        point = point - np.linalg.solve(curve, design.T @ (chance - wanted) + 1e-3 * point)
    return float(point[0]), float(point[1])


def train(sample: Sample) -> RuleModel:
    labels = sample.labels
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    if min(labels.sum(), (1 - labels).sum()) < FOLDS:
        return RuleModel(np.zeros(WIDTH + 1), 0.0, 0.0, float(np.log(share / (1 - share))), False)
    # Each label is dealt over the folds in turn, so that every fold's fit sees both.
    fold = np.zeros(len(labels), dtype=np.int64)
    for label in (0.0, 1.0):
        own = np.flatnonzero(labels == label)
        fold[own] = np.arange(len(own)) % FOLDS
    margins = np.zeros(len(labels))
    for own in range(FOLDS):
        unseen = fold == own
        margins[unseen] = sample.margins(regress(sample, ~unseen))[unseen]
    weights = regress(sample, np.ones(len(labels), dtype=bool))
    return RuleModel(weights, float(weights[-1]), *calibrate(margins, labels))


def judge(model: RuleModel, text: str | None) -> tuple:
    """The counts, verdicts and score of one text, in the order of ``RESULT``."""
    text = text or ""
    content = text.encode("utf-8", "surrogatepass")
    words = words_of(content)
    counts = base_counts(text, content, words)
    raw = model.bias
    if model.decides and text:
        buckets, values = features(text, words)
        raw += float(model.weights[buckets] @ values)
    score = float(1 / (1 + np.exp(-np.clip(model.slope * raw + model.offset, -35, 35))))
    failed = base_failed(counts[0], counts[4])
    dropped = model.decides and score < DROP_BELOW
    verdict = "drop" if failed or dropped else "review" if model.decides and score < KEEP_FROM else "keep"
    return (*counts, failed, not (failed or dropped), score, verdict)


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on ``documents(id, text)`` and ``labels(id, label)``.

    At most ``sample_rows`` label rows, the first by a hash of the id among a hashed share, are
    broadcast, and at most as many rows come back: no text is shuffled or sent to the driver.
    """
    known = labels.where("id is not null and label is not null")
    total = known.count()
    share = min(1.0, 2.0 * sample_rows / total) if total else 1.0
    chosen = (
        known.where(F.pmod(F.xxhash64("id"), F.lit(SHARE_STEPS)) < max(1, int(share * SHARE_STEPS)))
        .orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows)
    )

    @F.pandas_udf("buckets array<int>, values array<float>")
    def rows_of(texts: pd.Series) -> pd.DataFrame:
        found = [features(t or "", words_of((t or "").encode("utf-8", "surrogatepass"))) for t in texts]
        return pd.DataFrame({"buckets": [b for b, _ in found], "values": [v for _, v in found]})

    rows = (
        documents.select("id", "text").join(F.broadcast(chosen), "id")
        .select("id", "label", F.xxhash64("text").alias("key"), rows_of("text").alias("row"))
        .orderBy(F.xxhash64("id"), "id", "label", "key").limit(sample_rows)
        .select("row.buckets", "row.values", "label").toArrow().to_batches()
    )
    return train(Sample(
        [b for r in rows for b in lists(r.column("buckets"))], [v for r in rows for v in lists(r.column("values"))],
        np.array([label for r in rows for label in r.column("label").to_pylist()])))


def lists(column: pa.Array) -> list[np.ndarray]:
    """The rows of a column of lists without nulls, as views."""
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def judged(model: RuleModel, text: Column) -> Column:
    """Struct of ``RESULT`` for a text column."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def judge_all(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        names = [part.split()[0] for part in RESULT.split(", ")]
        for texts in batches:
            yield pd.DataFrame([judge(known, t) for t in texts], columns=names)

    # Else the optimizer runs it again for every field that a query takes.
    return judge_all.asNondeterministic()(text)
