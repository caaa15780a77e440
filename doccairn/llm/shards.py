"""Sharding by sampled splitters.

Every record gets a key (a digest of its text, then its id). A size-weighted sample of keys
gives quantile boundaries, which cut the key range into many fine ranges. A range that holds too
many rows all the same (many small texts, one hot text, records without text or id) is subdivided
by boundaries sampled from its own rows; the last part of a key is a number of the row, so any
range can be. Exact bytes and rows per range are then known (one row per range), and the place of
every record in the whole order follows from running sums inside its own range, so shards are cut
at exact byte positions.

Only keys and sizes move, never texts. The driver holds the boundaries and one row per range:
``shards * RANGES_PER_SHARD``, or one per ``ROWS_PER_RANGE`` rows if that is more, twice at most.

Defined results: a null text has size 1 and no checksum; an empty text has size 1. Null ids
sort first, and rows that tie in everything are numbered in any order, which no output shows.
An empty table gives no rows. Other columns are not looked at, and written records keep them.
"""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from doccairn.llm.rows import keyed_rows
from doccairn.storage import settle

#: Fine ranges per shard, and sampled keys per fine range.
RANGES_PER_SHARD = 8
KEYS_PER_RANGE = 16
#: Rows that one task orders; more rows than this in every range make more ranges.
ROWS_PER_RANGE = 1 << 20
#: A range with more than this many times its share of the rows is subdivided.
OVERFULL = 2
STEPS = 1 << 30


def keyed(records: DataFrame, id_column: str, text: str) -> DataFrame:
    """Columns ``id``, ``place``, ``size`` (UTF-8 bytes plus 1), ``text_crc32`` and ``draw``.

    ``place`` orders the records: digest of the text (blanks if null), id, number of the row.
    """
    body, padded = F.col(text), F.lpad(F.col(id_column).cast("string"), 20, "0")
    return records.select(
        F.col(id_column).alias("id"),
        F.concat(
            F.coalesce(F.md5(body.cast("binary")), F.lit(" " * 32)), F.coalesce(F.hex(padded), F.lit("")), F.lit("-"),
            F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")).alias("place"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    ).withColumn("draw", F.pmod(F.xxhash64("place"), F.lit(STEPS)) / F.lit(float(STEPS)))


def _quantiles(keys: list[str], parts: int) -> set[str]:
    return {keys[i * len(keys) // parts] for i in range(1, parts)} if keys else set()


def splitters(records: DataFrame, ranges: int) -> list[str]:
    """Boundaries of ``ranges`` key ranges of about equal bytes.

    A record is drawn with chance proportional to its size (by a hash of its place, so
    that the draw repeats); the driver gets about ``ranges * KEYS_PER_RANGE`` keys.
    """
    total = records.agg(F.sum("size").alias("bytes")).first()["bytes"] or 0
    if not total:
        return []
    drawn = records.where(F.col("draw") < F.col("size") * F.lit(ranges * KEYS_PER_RANGE / total))
    return sorted(_quantiles(sorted(r["place"] for r in drawn.select("place").collect()), ranges))


def subdivided(records: DataFrame, bounds: list[str], rows_per_range: float) -> list[str]:
    """The boundaries, and further ones inside every range of too many rows."""
    counts = {r["range"]: r["count"] for r in records.groupBy(_range_of(bounds).alias("range")).count().collect()}
    parts = {n: -(-rows // max(1, int(rows_per_range))) for n, rows in counts.items() if rows > OVERFULL * rows_per_range}
    if not parts:
        return bounds
    chances = F.element_at(F.from_json(F.lit(json.dumps(
        [parts[n] * KEYS_PER_RANGE / counts[n] if n in parts else 0.0 for n in range(len(bounds) + 1)])), "array<double>"), F.col("range") + 1)
    drawn = records.withColumn("range", _range_of(bounds)).where(F.col("draw") < chances)
    keys: dict[int, list[str]] = {}
    for row in drawn.select("range", "place").collect():
        keys.setdefault(row["range"], []).append(row["place"])
    return sorted(set(bounds).union(*(_quantiles(sorted(found), parts[n]) for n, found in keys.items())))


def _range_of(bounds: list[str]) -> Column:
    """Number of the range that holds a record, by binary search over the sorted boundaries."""
    listed = F.from_json(F.lit(json.dumps(bounds)), "array<string>")
    steps = [1 << bit for bit in reversed(range(len(bounds).bit_length()))]

    def step(passed: Column, width: Column) -> Column:
        ahead = passed + width
        return F.when(F.get(listed, ahead - 1) <= F.col("place"), ahead).otherwise(passed)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) if steps else F.lit(0)


def shard_by_bytes(records: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = 16) -> DataFrame:
    """``id, size, text_crc32, shard, slot``: shards of near equal bytes, slots without gaps.

    The shard of a record is given by the middle of its bytes in the whole order, so no
    shard is further from the mean than the size of one record.
    """
    rows = settle(keyed(records, id_column, text), "shard-keys")
    total_rows = rows.count()
    ranges = max(shards * RANGES_PER_SHARD, -(-total_rows // ROWS_PER_RANGE))
    bounds = subdivided(rows, splitters(rows, ranges), max(1.0, total_rows / ranges))
    ranged = rows.drop("draw").withColumn("range", _range_of(bounds))
    known = {r["range"]: r for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}
    numbers = sorted(known)
    total = sum(known[n]["bytes"] for n in numbers)
    bytes_before = dict(zip(numbers, accumulate((known[n]["bytes"] for n in numbers), initial=0)))
    rows_before = dict(zip(numbers, accumulate((known[n]["rows"] for n in numbers), initial=0)))
    ordered = Window.partitionBy("range").orderBy("place")
    running = F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    middle = _looked_up("range", bytes_before) + running - F.col("size") / 2
    placed = ranged.select(
        "id", "size", "text_crc32",
        F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(float(max(total, 1)))).cast("int")).alias("shard"),
        (_looked_up("range", rows_before) + F.row_number().over(ordered) - 1).alias("number"))
    # shards follow the order, so a record's slot is its number less that of its shard's first record
    first = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("number").alias("first")).collect()}
    slot = (F.col("number") - _looked_up("shard", first)).cast("long")
    return placed.select("id", "size", "text_crc32", "shard", slot.alias("slot"))


def _looked_up(column: str, values: dict[int, int]) -> Column:
    """Value of a small table of consecutive numbers, as an array literal."""
    if not values:
        return F.lit(0).cast("long")
    listed = ",".join(str(values.get(i, 0)) for i in range(max(values) + 1))
    return F.element_at(F.split(F.lit(listed), ",").cast("array<bigint>"), (F.col(column) + 1).cast("int"))


def write_shards(records: DataFrame, path: str, text: str = "text", shards: int = 16, files_per_shard: int = 8) -> str:
    """Write whole records below ``path``, one folder per shard, in several files each.

    Records and shards meet on a number of the row, so records without id or with a repeated
    one are written once each. Returns the name of the folders' column: ``shard``, with
    underscores if the records have such a column.
    """
    rows, key = keyed_rows(records, "shard-records")
    taken = {column.lower() for column in rows.columns}
    name = next(f"shard{'_' * n}" for n in range(len(taken) + 1) if f"shard{'_' * n}" not in taken)
    placed = shard_by_bytes(rows, key, text, shards).select(
        F.col("id").alias("_record"), F.col("shard").alias(name), F.pmod(F.xxhash64("slot"), F.lit(files_per_shard)).alias("_file"))
    joined = rows.join(placed, F.col(f"`{key}`") == F.col("_record"))
    joined.repartition(name, "_file").drop(key, "_record", "_file").write.partitionBy(name).parquet(path)
    return name
