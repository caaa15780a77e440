"""Fill-in-middle: texts cut at token boundaries by a learned index from rank to offset.

A token is a run of non-blank characters with the blanks before it; blanks at the end of a text
are a token. The texts of a batch are laid end to end and one index is fitted to all their
boundary offsets: segments, each a line through its first boundary that keeps all others within
``ERROR`` characters, found by narrowing the range of slopes that still fit. What a line misses is
stored as one signed byte per boundary. A cut asks for the offset at a rank: the segment predicts
it and the stored residual makes it exact. Offsets themselves are not kept, so a batch costs one
byte per boundary and a few numbers per segment; texts pass through in pieces of bounded size.

Hashes decide form and ranks: of ``seed:id``, four numbers of 32 bits. The larger share of the
transformed texts (``spm_percent``) puts the suffix first, others the prefix; texts that already
hold a mark, empty ones and the rest stay plain. ``restored`` rebuilds a text from output and form.

Defined results: a null text counts as empty, a null id as the empty string in the hash. Repeated
rows get equal results; other columns are kept as they are unless they bear a name of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from doccairn.llm.grams import code_points

#: Farthest a line may be from a boundary; with rounding it still fits a signed byte.
ERROR = 126
#: Characters laid end to end at once.
PIECE = 1 << 20
FIRST_STRETCH = 256
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUTS = "n long, first long, second long"


class RankIndex:
    """Offsets by rank, kept as line segments and a residual byte per rank."""

    def __init__(self) -> None:
        self._starts: list[int] = []
        self._origins: list[int] = []
        self._slopes: list[float] = []
        self._residuals: list[np.ndarray] = []
        self.size = 0

    def append(self, offsets: np.ndarray) -> None:
        """Fit segments to the next offsets, which rise from rank to rank."""
        at = 0
        while at < len(offsets):
            end, slope = reach(offsets, at)
            line = np.rint(slope * np.arange(end - at)).astype(np.int64) + offsets[at]
            self._starts.append(self.size + at)
            self._origins.append(int(offsets[at]))
            self._slopes.append(slope)
            self._residuals.append((offsets[at:end] - line).astype(np.int8))
            at = end
        self.size += len(offsets)

    @property
    def segments(self) -> int:
        return len(self._starts)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets: predicted by the rank's segment, corrected by its residual."""
        starts = np.array(self._starts, dtype=np.int64)
        at = np.searchsorted(starts, ranks, side="right") - 1
        predicted = np.rint(np.array(self._slopes)[at] * (ranks - starts[at])).astype(np.int64)
        return np.array(self._origins, dtype=np.int64)[at] + predicted + np.concatenate(self._residuals)[ranks]


def reach(offsets: np.ndarray, start: int) -> tuple[int, float]:
    """End of the longest run that a line through its first point follows, and the line's slope."""
    low, high, at, stretch = -np.inf, np.inf, start + 1, FIRST_STRETCH
    while at < len(offsets):
        end = min(len(offsets), at + stretch)
        steps = np.arange(at - start, end - start)
        rise = (offsets[at:end] - offsets[start]).astype(np.float64)
        lows = np.maximum.accumulate(np.maximum(low, (rise - ERROR) / steps))
        highs = np.minimum.accumulate(np.minimum(high, (rise + ERROR) / steps))
        misses = lows > highs
        fitting = int(np.argmax(misses)) if misses.any() else len(misses)
        if fitting:
            low, high = float(lows[fitting - 1]), float(highs[fitting - 1])
        if fitting < len(misses):
            at += fitting
            break
        at, stretch = end, stretch * 2
    return at, (low + high) / 2 if np.isfinite(low) else 0.0


def blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of the texts end to end, and which of them end a text, in bounded pieces.

    The last code point of a piece belongs to the next one: it only shows what follows.
    """
    held, ends, size = [], [], 0
    for text in texts:
        for start in range(0, len(text), PIECE):
            codes = code_points(text[start : start + PIECE])
            last = np.zeros(len(codes), dtype=bool)
            last[-1] = start + PIECE >= len(text)
            held.append(codes)
            ends.append(last)
            size += len(codes)
            if size >= PIECE:
                codes, last = np.concatenate(held), np.concatenate(ends)
                yield codes, last
                held, ends, size = [codes[-1:]], [last[-1:]], 1
    if size:
        closing = np.zeros(1, dtype=np.uint32), np.zeros(1, dtype=bool)
        yield np.concatenate([*held, closing[0]]), np.concatenate([*ends, closing[1]])


def index_texts(texts: list[str]) -> tuple[RankIndex, np.ndarray]:
    """Index of all token boundaries of the texts end to end, and the tokens of each text."""
    index, begin, counts = RankIndex(), 0, []
    index.append(np.zeros(1, dtype=np.int64))
    ends = np.cumsum([len(t) for t in texts])
    for codes, last in blocks(texts):
        blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
        closes = last[:-1] | (~blank[:-1] & blank[1:])
        found = np.flatnonzero(closes) + (begin + 1)
        counts.append(np.bincount(np.searchsorted(ends, found), minlength=len(texts)))
        index.append(found)
        begin += len(codes) - 1
    return index, np.sum(counts, axis=0) if counts else np.zeros(len(texts), dtype=np.int64)


def cut_texts(texts: list[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each text, and the offsets of its two cuts: draws modulo tokens plus one."""
    index, tokens = index_texts(texts)
    before = np.cumsum(tokens) - tokens
    starts = np.cumsum([len(t) for t in texts]) - [len(t) for t in texts]
    ranks = np.sort(draws % (tokens + 1)[:, None], axis=1) + before[:, None]
    return tokens, index.offsets(ranks.ravel()).reshape(ranks.shape) - starts[:, None]


def cuts(text: Column, one: Column, other: Column) -> Column:
    """Struct of a text's tokens and the code points before its first and second cut."""

    @F.pandas_udf(CUTS)
    def cut(texts: pd.Series, ones: pd.Series, others: pd.Series) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame({"n": [], "first": [], "second": []}, dtype="int64")
        tokens, offsets = cut_texts([t or "" for t in texts], np.stack([ones.to_numpy(), others.to_numpy()], axis=1))
        return pd.DataFrame({"n": tokens, "first": offsets[:, 0], "second": offsets[:, 1]})

    # Else the optimizer runs it again for every use.
    return cut.asNondeterministic()(text, one, other)


def draw(key: Column, seed: int, number: int) -> Column:
    """The hash's given group of 32 bits as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("long")


def infilled(text: Column, key: Column, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> Column:
    """Struct of ``n, form, prefix_chars, middle_chars, output``."""
    text = F.coalesce(text, F.lit(""))
    found = cuts(text, draw(key, seed, 0), draw(key, seed, 1))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = (
        F.when((text == "") | marked | (draw(key, seed, 2) % 100 >= percent), "plain")
        .when(draw(key, seed, 3) % 100 < spm_percent, "spm").otherwise("psm")
    )

    def built(cut: Column, form: Column) -> Column:
        first, second = cut["first"].cast("int"), cut["second"].cast("int")
        prefix = F.substr(text, F.lit(1), first)
        middle, suffix = F.substr(text, first + 1, second - first), F.substr(text, second + 1)
        output = (
            F.when(form == "plain", text)
            .when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
            .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        )
        moved = form != "plain"
        return F.struct(
            cut["n"].alias("n"), form.alias("form"), F.when(moved, cut["first"]).alias("prefix_chars"),
            F.when(moved, cut["second"] - cut["first"]).alias("middle_chars"), output.alias("output"))

    # Bound once, so that the cuts are not made again for every field.
    return F.transform(F.array(F.struct(found.alias("cut"), form.alias("form"))), lambda x: built(x["cut"], x["form"]))[0]


def restored(output: Column, form: Column) -> Column:
    """The text from what :func:`infilled` made of it; the marks occur nowhere else in there."""
    parts = F.split(output, "<[PSM]>")
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
    )
