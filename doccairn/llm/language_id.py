"""Language identification: multinomial naive Bayes over hashed character n-grams.

A bounded sample of labelled rows gives counts per (language, n-gram bucket), summed by Spark.
The log-probability matrix (buckets x languages, a fixed size per language) is broadcast;
texts are scored whole, in numpy: a batch of texts is a sparse matrix (texts x buckets, in
compressed rows), and its product with the matrix gives the scores of the batch.

Defined results: a null text and a text without any letter give ``und`` with score 0, and so
does every text if nothing could be learned. Equal posteriors go to the first language in
order of name. A null language or a null training flag is not learned from. Other columns of
the input are not looked at. Texts of any length are read in pieces, never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doccairn.llm.grams import PIECE, code_points, pieces

ORDERS = (1, 2, 3)
BITS = 15
#: Bound of the training sample, in rows.
SAMPLE_ROWS = 4000
#: Steps of the draw; with more labelled rows than ``STEPS * SAMPLE_ROWS`` one step is taken.
STEPS = 1 << 30
#: Languages the broadcast matrix may hold; 2**BITS floats each.
MAX_LANGUAGES = 512
RESULT = "lang_pred string, score double"


@dataclass(frozen=True)
class LanguageModel:
    names: tuple[str, ...]
    weights: np.ndarray
    priors: np.ndarray


def _codes(text: str) -> np.ndarray:
    return code_points(f" {text.lower()} ")


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"]):
            total = counts.setdefault(lang, np.zeros(1 << BITS, dtype=np.int64))
            rows[lang] = rows.get(lang, 0) + 1
            codes = _codes(text)
            for order in ORDERS:
                for part in pieces(codes, order, BITS):
                    total += np.bincount(part, minlength=1 << BITS)
    for lang, total in counts.items():
        used = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": np.append(used, -1), "n": np.append(total[used], rows[lang])})


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from the columns ``id``, ``text``, ``lang``.

    At most about ``sample_rows`` rows, chosen by a hash of the id, are read; the share
    follows from a count of all labelled rows.
    """
    known = labelled.where("text is not null and lang is not null and id is not null")
    total = known.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(STEPS)) < max(1, int(share * STEPS)))
    counted = (
        chosen.select("text", "lang").mapInPandas(_count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    seen = counted.where("bucket = -1").orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    names = tuple(sorted(r["lang"] for r in seen.collect()))
    table = counted.where(F.col("lang").isin(*names)).toPandas()
    counts = np.ones((1 << BITS, len(names)))
    priors = np.zeros(len(names))
    for position, name in enumerate(names):
        own = table[table["lang"] == name]
        grams = own[own["bucket"] >= 0]
        counts[grams["bucket"].to_numpy(), position] += grams["n"].to_numpy()
        priors[position] = np.log(own.loc[own["bucket"] == -1, "n"].sum())
    weights = np.log(counts) - np.log(counts.sum(axis=0)) if names else counts
    return LanguageModel(names, weights.astype(np.float32), priors)


def _batches(texts: list[str]) -> Iterator[list[int]]:
    """Places of texts that together have at most ``PIECE`` characters; a longer text is alone."""
    taken, size = [], 0
    for place, text in enumerate(texts):
        if taken and size + len(text) > PIECE:
            yield taken
            taken, size = [], 0
        taken.append(place)
        size += len(text)
    if taken:
        yield taken


def _posteriors(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """Log posteriors, up to a constant, of a batch: a row per text, a column per language."""
    codes = [_codes(text) for text in texts]
    owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    joined, totals = np.concatenate(codes), np.tile(model.priors, (len(codes), 1))
    for order in ORDERS:
        for number, buckets in enumerate(pieces(joined, order, BITS)):
            begin = number * PIECE
            rows = owner[begin : begin + len(buckets)]
            # an n-gram that ends in the next text is none
            inside = rows == owner[begin + order - 1 : begin + order - 1 + len(buckets)]
            rows, buckets = rows[inside], buckets[inside]
            starts = np.flatnonzero(np.diff(rows, prepend=-1))
            if len(starts):
                totals[rows[starts]] += np.add.reduceat(model.weights.take(buckets, axis=0), starts, axis=0, dtype=np.float64)
    return totals


def predict(model: LanguageModel, texts: pd.Series) -> pd.DataFrame:
    """``lang_pred, score`` of every text."""
    found = pd.DataFrame({"lang_pred": "und", "score": np.zeros(len(texts))})
    known = [n for n, text in enumerate(texts) if text is not None and model.names and any(map(str.isalpha, text))]
    scored = [texts.iloc[n] for n in known]
    for batch in _batches(scored):
        totals = _posteriors(model, [scored[n] for n in batch])
        best = totals.argmax(axis=1)
        places = [known[n] for n in batch]
        found.loc[places, "lang_pred"] = [model.names[n] for n in best]
        found.loc[places, "score"] = 1.0 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
    return found


def language(model: LanguageModel, text: Column) -> Column:
    """Struct of ``lang_pred`` and ``score`` for a text column."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts in batches:
            yield predict(known, texts)

    return score.asNondeterministic()(text)
