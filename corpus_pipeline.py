"""Corpus pipeline: language ID, near-duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; ``run`` writes every
result as Parquet in the shared folder and reads it back for the next stage. All but the last
return the columns of the documents they get. Decisions are about rows, not ids: rows without id
or with a repeated one are judged by their own texts. Rows without text, or without letters, go in
the first stage; further columns pass through; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from doccairn.llm import decontaminate, language_id, near_duplicates, pieces, secret_scan
from doccairn.llm.queries import MODEL_FILE, remainder
from doccairn.storage import settle

#: Least posterior of a language that keeps a document.
LEAST_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a known language; texts without letters or with no clear language go."""
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = language_id.fit(docs.where(~held_out).select(F.col("doc_id").alias("id"), "text", "lang"))
    found = language_id.language(model, F.col("text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), found.alias("found"))
    return rows.where((F.col("found.lang_pred") != "und") & (F.col("found.score") >= LEAST_LANGUAGE_SCORE)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group, linked at 80 % of their word shingles: the smallest id."""
    return near_duplicates.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of the benchmark."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark and count the characters again."""
    redacted = docs.withColumn("text", secret_scan.redacted(F.col("text"), secret_scan.word_ranks(docs)))
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*[f"`{c}`" for c in docs.columns])


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, beside its id, language and source."""
    model = pieces.load(MODEL_FILE)
    coded = docs.select("doc_id", "lang", "source", pieces.encoded(model, F.col("text")).alias("coded"))
    return coded.select("doc_id", "lang", "source", "coded.*")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("SentencePiece", encode_pieces),
]

#: The language model and the merges of the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
