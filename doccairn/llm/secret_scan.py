"""Secrets: patterns of known shapes, and guess costs of values that stand after credential words.

Base kinds: ``assign`` (a credential word, a sign and a value of 12 or more characters), ``access``
(``AKIA`` keys of 18 or more characters) and ``hex`` (runs of 16 or more hexadecimal digits).
The method adds ``guess``: the value after a credential word whose cheapest explanation (split
into dictionary words, dates, repeats, keyboard walks and brute-force runs, found by dynamic
programming) still takes ``10 ** MIN_GUESSES`` guesses or more. A repeat is a piece that follows
itself, once or more, and costs the cheapest explanation of the piece times the repetitions. The
dictionary is a short list of words common in passwords and, from :func:`word_ranks`, the words
that the texts themselves hold twice or more, most frequent first. Base spans stay as they are.

Positions are code points, end exclusive. Defined results: a null text counts as empty; an empty
text has no spans. Rows are handled one by one, so null or repeated ids, repeated rows and
other columns do not matter. Texts and values of any length are handled whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doccairn.storage import discard, settle

#: Least decimal logarithm of the guesses that make a value a secret.
MIN_GUESSES = 10.0
#: Words of the texts in the dictionary, which goes to every task.
DICTIONARY_WORDS = 50_000
#: Letters of a word counted for the dictionary, and words counted in a task before they are sent on.
WORD = re.compile(r"[^\W\d_]{3,24}")
COUNTED = 200_000
#: Levels of counts from a number to its double.
LEVELS_PER_DOUBLING = 64
#: Longest piece that is looked for right after itself.
LONGEST_REPEAT = 24

# Patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api_?key|credentials?|authorization|bearer)["']?\x20*(?::|=>|=)\x20*["']?([^\s"'<>,;]{6,})""",
    re.I | re.A,
)
KEYWORDS = ("pass", "pwd", "secret", "token", "api", "credential", "authorization", "bearer")
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
# Common words of passwords, most common first; callers may pass a longer list.
WORDS = (
    "password", "admin", "welcome", "login", "letmein", "dragon", "monkey", "master", "secret", "test",
    "example", "changeme", "default", "hello", "love", "sunshine", "princess", "football", "shadow", "super",
    "user", "root", "token", "key", "pass", "guest", "server", "public", "private", "access", "summer", "winter",
    "spring", "autumn", "black", "white", "green", "blue", "red", "house", "world", "money", "happy", "secure",
    "demo", "sample", "your", "my", "the", "none", "null", "true", "false", "value", "string", "here", "insert",
)
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_PLACE = {c: (row, column) for row, keys in enumerate(KEYBOARD) for column, c in enumerate(keys)}
RANKS = {word: rank for rank, word in enumerate(WORDS, 1)}


def _beside(a: str, b: str) -> bool:
    first, second = _PLACE.get(a), _PLACE.get(b)
    return first is not None and second is not None and abs(first[0] - second[0]) <= 1 and abs(first[1] - second[1]) <= 1


def _run_ends(value: str, low: str) -> tuple[list[int], list[int]]:
    """For each place, where the run of one character and the keyboard walk that start there end."""
    size = len(value)
    same, walk = [0] * size, [0] * size
    for i in range(size - 1, -1, -1):
        goes = i + 1 < size
        same[i] = same[i + 1] if goes and value[i + 1] == value[i] else i + 1
        walk[i] = walk[i + 1] if goes and low[i + 1] != low[i] and _beside(low[i], low[i + 1]) else i + 1
    return same, walk


_LONGEST: dict[int, tuple[dict[str, int], int]] = {}


def longest_word(ranks: dict[str, int]) -> int:
    """Letters of the longest word; kept with the dictionary, which is asked for every value."""
    known = _LONGEST.get(id(ranks))
    if known is None or known[0] is not ranks:
        _LONGEST.clear()
        known = _LONGEST[id(ranks)] = (ranks, max(map(len, ranks), default=0))
    return known[1]


def _repeats(value: str) -> dict[int, list[tuple[int, int]]]:
    """For each place the pieces of two characters or more that follow themselves, and the end of the last."""
    found: dict[int, list[tuple[int, int]]] = {}
    for piece in range(2, min(LONGEST_REPEAT, len(value) // 2) + 1):
        run = 0
        for i in range(len(value) - piece - 1, -1, -1):
            run = run + 1 if value[i] == value[i + piece] else 0
            if run >= piece and len(set(value[i : i + piece])) > 1:
                found.setdefault(i, []).append((piece, i + piece * (run // piece + 1)))
    return found


def _brute(character: str) -> float:
    if character.isdigit():
        return 1.0
    if character.isalpha():
        return math.log10(26 if character.islower() else 36)
    return math.log10(33)


def guesses(value: str, ranks: dict[str, int] = RANKS) -> float:
    """Decimal logarithm of the guesses of the cheapest segmentation of ``value``."""
    low, size = value.lower(), len(value)
    if len(low) != size:  # a few letters change length when lowered
        low = value
    same, walk = _run_ends(value, low)
    longest, repeats = longest_word(ranks), _repeats(value)
    dates: dict[int, list[int]] = {}
    for match in DATE.finditer(value):
        dates.setdefault(match.start(), []).append(match.end())
    best = [math.inf] * (size + 1)
    best[0] = 0.0
    for i in range(size):
        base = best[i]
        best[i + 1] = min(best[i + 1], base + _brute(value[i]))
        join = base + (math.log10(2) if i else 0.0)
        for j in range(i + 3, min(size, i + longest) + 1):
            rank = ranks.get(low[i:j])
            if rank:
                cased = 0.0 if value[i:j] in (low[i:j], low[i:j].capitalize()) else math.log10(j - i) + 0.3
                best[j] = min(best[j], join + math.log10(rank + 1) + cased)
        for j in dates.get(i, ()):
            best[j] = min(best[j], join + math.log10(365.0 * 120 if j - i > 4 else 120.0))
        for piece, end in repeats.get(i, ()):
            times = (end - i) // piece
            best[end] = min(best[end], join + guesses(value[i : i + piece], ranks) + math.log10(times))
        if same[i] - i >= 3:
            best[same[i]] = min(best[same[i]], join + _brute(value[i]) + math.log10(same[i] - i))
        if walk[i] - i >= 4:
            best[walk[i]] = min(best[walk[i]], join + math.log10(47 * (walk[i] - i)) + 0.3 * (walk[i] - i))
    return best[size]


def spans(text: str | None, least: float = MIN_GUESSES, ranks: dict[str, int] = RANKS) -> list[tuple[int, int, str, int]]:
    """(start, rank of kind, kind, end), by start, then kind."""
    if not text:
        return []
    found = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        for match in ASSIGN.finditer(text):
            if match.end(2) - match.start(2) >= 12:
                found.append((match.start(), 0, "assign", match.end()))
        for match in CONTEXT.finditer(text):
            if guesses(match.group(1), ranks) >= least:
                found.append((match.start(1), 3, "guess", match.end(1)))
    if "AKIA" in text:
        found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def listed(found: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found)


def redact(text: str | None, mark: str = "[secret]", ranks: dict[str, int] = RANKS) -> str | None:
    """The text with every span replaced; overlapping spans become one mark."""
    found = spans(text, ranks=ranks)
    if not found:
        return text
    parts, at = [], 0
    for start, _, _, end in found:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def word_ranks(documents: DataFrame, text: str = "text", most: int = DICTIONARY_WORDS) -> dict[str, int]:
    """Ranks of the words of all texts by frequency, beside those of the short list.

    Words are counted in every task and summed. Those that occur twice or more fall into levels of
    nearly equal counts, and the highest levels that together hold at most ``most`` words come to the
    driver; nothing else does but the sizes of the levels.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for own in batch["text"]:
                counts.update(WORD.findall((own or "").lower()))
                if len(counts) > COUNTED:
                    yield pd.DataFrame(list(counts.items()), columns=["word", "n"])
                    counts.clear()
        yield pd.DataFrame(list(counts.items()), columns=["word", "n"]).astype({"word": "object", "n": "int64"})

    written: list[str] = []
    words = settle(
        documents.select(F.col(f"`{text}`").alias("text")).mapInPandas(counted, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
        .withColumn("level", F.floor(F.log2("n") * LEVELS_PER_DOUBLING).cast("int")), "secret-words", written)
    room, least = most, None
    for row in sorted(words.groupBy("level").agg(F.count("*").alias("held")).collect(), reverse=True):
        room -= row["held"]
        if room < 0:
            break
        least = row["level"]
    found = [] if least is None else sorted(words.where(F.col("level") >= least).select("n", "word").collect(), key=lambda row: (-row["n"], row["word"]))
    discard(documents.sparkSession, written)
    ranks = {row["word"]: rank for rank, row in enumerate(found, 1)}
    for word, rank in RANKS.items():
        ranks[word] = min(rank, ranks.get(word, rank))
    return ranks


def digest(text: Column, ranks: dict[str, int] = RANKS) -> Column:
    """Struct of counts per base kind, the digest of base spans, and all spans."""
    shared = SparkSession.active().sparkContext.broadcast(ranks)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                found = spans(text, ranks=shared.value)
                base = [s for s in found if s[1] < 3]
                kinds = [s[2] for s in base]
                rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                             hashlib.sha256(listed(base).encode()).hexdigest(), listed(found)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scan.asNondeterministic()(text)


def redacted(text: Column, ranks: dict[str, int] = RANKS) -> Column:
    shared = SparkSession.active().sparkContext.broadcast(ranks)

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda text: redact(text, ranks=shared.value))

    return mask.asNondeterministic()(text)
