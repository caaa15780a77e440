"""Posts to documents, tokens, vocabulary and keyword tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from doccairn.functions.text import (
    document_text, keyword_tokens, whitespace_tokens, with_stripped_forms,
)
from doccairn.operators.lookups import lookup_join


def build_documents(posts: DataFrame) -> DataFrame:
    """Add ``document``, the stripped title and body."""
    return posts.withColumn(
        "document", document_text(F.col("cleaned_title"), F.col("cleaned_selftext"))
    )


def tokenize(documents: DataFrame) -> DataFrame:
    """Add ``tokens`` from ``document``."""
    return documents.withColumn("tokens", whitespace_tokens(F.col("document")))


def drop_empty(tokenized: DataFrame) -> DataFrame:
    return tokenized.where(F.size("tokens") > 0)


def token_rows(tokenized: DataFrame, *keep: str) -> DataFrame:
    """One row per token: ``id``, the kept columns, ``pos`` and ``token``."""
    return tokenized.select("id", *keep, F.posexplode("tokens").alias("pos", "token"))


def document_counts(tokenized: DataFrame) -> DataFrame:
    """Documents loaded, dropped for having no token, and kept."""
    empty = F.size("tokens") == 0
    return tokenized.agg(
        F.count("*").alias("loaded"),
        F.count_if(empty).alias("dropped"),
        F.count_if(~empty).alias("kept"),
    )


def vocabulary(tokenized: DataFrame, min_count: int = 1) -> DataFrame:
    """Words with their corpus frequency, from ``min_count`` up."""
    words = tokenized.select(F.explode("tokens").alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("count")).where(F.col("count") >= min_count)


def stop_word_union(stop: DataFrame) -> DataFrame:
    """A ``word`` table and its apostrophe-free forms, each once."""
    bare = stop.select(F.replace("word", F.lit("'"), F.lit("")).alias("word"))
    return stop.select("word").union(bare).distinct()


def drop_stop_words(words: DataFrame, stop: list[str] | DataFrame) -> DataFrame:
    """Keep rows whose ``word`` is not a stop word; a list becomes a plain filter."""
    if isinstance(stop, DataFrame):
        return lookup_join(words, stop.select("word").distinct(), "word", "left_anti")
    return words.where(~F.col("word").isin(with_stripped_forms(stop)))


def keyword_rows(posts: DataFrame, *keep: str) -> DataFrame:
    """One row per keyword token: ``id``, the kept columns, ``pos`` and ``word``."""
    words = keyword_tokens(F.col("cleaned_title"), F.col("cleaned_selftext"))
    return posts.select("id", *keep, F.posexplode(words).alias("pos", "word"))
