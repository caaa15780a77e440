"""Documents as frequencies over bins of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from doccairn.functions.vectors import total
from doccairn.operators.lookups import lookup_join, weighted_join
from doccairn.sources.posts import ids_are_keys


def counted_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, word, tokens`` of every row's own words; a row without any gives a null word."""
    for batch in batches:
        lists, ids = batch.column("tokens"), batch.column("id")
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode("encode")
        codes, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        rows = np.repeat(np.arange(len(lengths)), lengths)
        keys, counts = np.unique(rows * max(len(names), 1) + codes, return_counts=True)
        empty = np.flatnonzero(lengths == 0)
        places = np.concatenate([keys // max(len(names), 1), empty])
        words = names.take(pa.array(keys % max(len(names), 1)))
        yield pa.record_batch({
            "id": ids.take(pa.array(places)), "word": pa.concat_arrays([words.cast(pa.string()), pa.nulls(len(empty), pa.string())]),
            "tokens": pa.array(np.concatenate([counts, np.ones(len(empty), dtype=np.int64)]).astype(np.int64)),
        })


def row_word_counts(tokenized: DataFrame) -> DataFrame:
    """``id, word, tokens`` of every row by itself; nothing is shuffled."""
    kind = tokenized.schema["id"].dataType.simpleString()
    return tokenized.select("id", "tokens").mapInArrow(counted_lists, f"id {kind}, word string, tokens bigint")


def word_counts(tokenized: DataFrame) -> DataFrame:
    """``id, word, tokens``: the words of each document, counted; a document without any keeps a null.

    Words are counted within their rows; rows are put together only if they share an id.
    """
    counted = row_word_counts(tokenized)
    if ids_are_keys(tokenized):
        return counted
    return counted.groupBy("id", "word").agg(F.sum("tokens").alias("tokens"))


def binned(counted: DataFrame, word_bins: DataFrame) -> DataFrame:
    """Counted words with the ``bin`` of each known one; a ``count`` of the words spares most of the shuffle."""
    if "count" in word_bins.columns:
        return weighted_join(counted, word_bins, "word", "count")
    return lookup_join(counted, word_bins, "word")


def token_bins(tokenized: DataFrame, word_bins: DataFrame) -> DataFrame:
    """``id, word, tokens`` with the ``bin`` of each word; known words only."""
    return binned(word_counts(tokenized), word_bins)


def added_up(rows: pa.Table) -> pa.Table:
    """One row per run of equal ids, with the counts of equal bins added up and any other lists put together."""
    codes = rows["id"].combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])
    runs = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(codes))))
    lists, amounts = rows["bins"].combine_chunks(), rows["counts"].combine_chunks().flatten().to_numpy()
    bins = lists.flatten().to_numpy()
    width = int(bins.max(initial=0)) + 1
    owners = np.repeat(runs, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    keys, place = np.unique(owners * width + bins, return_inverse=True)
    sums = np.zeros(len(keys), dtype=np.int64)
    np.add.at(sums, place, amounts)

    def ends(owned: np.ndarray) -> pa.Array:
        return pa.array(np.concatenate([[0], np.cumsum(np.bincount(owned, minlength=len(starts)))]).astype(np.int32))

    summed = {
        "id": rows["id"].take(pa.array(starts)), "bins": pa.ListArray.from_arrays(ends(keys // width), pa.array(keys % width)),
        "counts": pa.ListArray.from_arrays(ends(keys // width), pa.array(sums)),
    }
    for name in rows.column_names[3:]:
        kept = rows[name].combine_chunks()
        owned = np.repeat(runs, pc.list_value_length(kept).to_numpy(zero_copy_only=False))
        summed[name] = pa.ListArray.from_arrays(ends(owned), kept.flatten())
    return pa.table(summed)


def added_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """:func:`added_up` over a stream; a run may span batches, and what is held of it is one row."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch])
        summed = added_up(rows if held is None else pa.concat_tables([held, rows.cast(held.schema)]))
        held = summed.slice(len(summed) - 1)
        yield from summed.slice(0, len(summed) - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def bin_counts(tokenized: DataFrame, word_bins: DataFrame, *keep: str) -> DataFrame:
    """Per document its bins, their token counts, and the number of known tokens.

    Documents without a known word stay, with empty arrays. Words of a row that meet their bins
    without a shuffle are put together before the one that brings each document together. Columns to
    ``keep`` travel with it as lists of the values of all rows with the id.
    """
    kinds = {name: f"array<{tokenized.schema[name].dataType.simpleString()}>" for name in keep}
    empty = F.array().cast("array<bigint>")
    schema = f"id {tokenized.schema['id'].dataType.simpleString()}, bins array<bigint>, counts array<bigint>"
    found = binned(row_word_counts(tokenized).where("word is not null"), word_bins).select(
        "id", F.array(F.col("bin").cast("bigint")).alias("bins"), F.array("tokens").alias("counts")
    )
    every = tokenized.select("id", empty.alias("bins"), empty.alias("counts"), *[F.array(name).alias(name) for name in keep])
    own = found.mapInArrow(added_runs, schema).withColumns({name: F.array().cast(kind) for name, kind in kinds.items()})
    parts = own.unionByName(every).repartition("id").sortWithinPartitions("id")
    whole = parts.mapInArrow(added_runs, ", ".join([schema, *[f"`{name}` {kind}" for name, kind in kinds.items()]]))
    return whole.withColumn("known", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, b: a + b))


def dense_frequencies(bins: Column, counts: Column, n_bins: int) -> Column:
    """Share of each of ``n_bins`` bins, taken modulo ``n_bins``; all zero where nothing was counted."""

    @F.arrow_udf("array<double>")
    def dense(places: pa.Array, amounts: pa.Array) -> pa.Array:
        rows = np.repeat(np.arange(len(places)), pc.list_value_length(places).to_numpy(zero_copy_only=False))
        cells = rows * n_bins + places.flatten().to_numpy() % n_bins
        filled = np.bincount(cells, amounts.flatten().to_numpy(), len(places) * n_bins).reshape(len(places), n_bins)
        sums = filled.sum(axis=1, keepdims=True)
        shares = np.divide(filled, sums, out=filled, where=sums > 0)
        ends = pa.array(np.arange(len(places) + 1, dtype=np.int32) * n_bins)
        return pa.ListArray.from_arrays(ends, pa.array(shares.ravel()))

    return dense(bins, counts)


def word_bin_vectors(
    tokenized: DataFrame, word_bins: DataFrame, n_bins: int, keep_zero: bool = True,
) -> DataFrame:
    """``id`` and ``vector``: tokens per bin over the known tokens of the document.

    Without ``keep_zero`` the documents with no known word drop out before their vector is built.
    """
    counted = bin_counts(tokenized, word_bins)
    if not keep_zero:
        counted = counted.where(F.col("known") > 0)
    vector = dense_frequencies(F.col("bins"), F.col("counts"), n_bins)
    return counted.select("id", vector.alias("vector"))


def zero_coverage(counted: DataFrame) -> DataFrame:
    """Number of documents without a known word, from :func:`bin_counts`."""
    return counted.agg(F.count_if(F.col("known") == 0).alias("skipped"))


def drop_zero_vectors(vectors: DataFrame) -> DataFrame:
    return vectors.where(total(F.col("vector")) > 0)
