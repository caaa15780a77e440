"""Text expressions: document string, tokens, keyword tokens, stop words."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, functions as F

# What counts as whitespace (Unicode blanks and the four ASCII
# separators), the characters cut from both ends of a document, and the shape of a keyword.
WHITESPACE = r"(?U)[\s\x1c-\x1f]"
NOT_WHITESPACE = r"(?U)[^\s\x1c-\x1f]"
DOCUMENT_EDGE = ". "
KEYWORD = "[a-z]{3,}"


def document_text(title: Column, body: Column) -> Column:
    """``title. body`` without dots and spaces at either end; nulls count as empty."""
    empty = F.lit("")
    joined = F.concat(F.coalesce(title, empty), F.lit(DOCUMENT_EDGE), F.coalesce(body, empty))
    return F.btrim(joined, F.lit(DOCUMENT_EDGE))


def whitespace_tokens(document: Column) -> Column:
    """Lower-cased tokens between whitespace runs; punctuation stays on its token."""
    return F.array_remove(F.split(F.lower(document), WHITESPACE + "+"), "")


def keyword_tokens(title: Column, body: Column) -> Column:
    """Runs of three or more ASCII letters, also inside longer words."""
    text = F.lower(F.concat_ws(" ", title, body))
    return F.regexp_extract_all(text, F.lit(KEYWORD), F.lit(0))


def has_text(column: Column) -> Column:
    """True if something other than whitespace is left."""
    return F.coalesce(column.rlike(NOT_WHITESPACE), F.lit(False))


def with_stripped_forms(words: list[str]) -> list[str]:
    """The list and the same words without apostrophes, each once."""
    return sorted(set(words) | {word.replace("'", "") for word in words})


def default_stop_words() -> list[str]:
    """Spark's English list with stripped forms, less ``would``, which reports keep."""
    words = StopWordsRemover.loadDefaultStopWords("english")
    return [word for word in with_stripped_forms(words) if word != "would"]
