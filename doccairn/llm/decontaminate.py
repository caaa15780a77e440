"""Benchmark decontamination, with SQL functions only.

Every window of ``WINDOW`` words of the benchmark is normalised; a text's token windows are
scanned where they stand (no row per word) against three bits per window in a bit table that
travels with the plan: one of the first, middle and last word, looked at first, and two of the
whole window. The table's size follows from the number of windows, up to a ceiling. The few
windows that pass meet the benchmark's windows in a hash join on the window's own words, which
verifies them; that side is broadcast up to a checked number of bytes and shuffled beyond it.
The items of the windows met join last, so a window common to many items is one row until then.
No text is shuffled.

Words are runs of digits, letters a-z and code points above 127; A-Z are lowered first. An item of
fewer words than a window is one window. Bit table and join see the same words.

Defined results: null and empty texts have no words and no hits. A row is judged by itself, so
null and repeated ids keep one result row each. Items without words or without id are left out;
items that repeat an id count once. An empty benchmark hits nothing. Other columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from doccairn.llm.rows import keyed_rows
from doccairn.storage import settle

WINDOW = 10
#: Bits of the table: at least ``BITS_PER_WINDOW`` for each window, within these limits (as powers
#: of two). At the ceiling a quarter of a million windows let one window in 60 through by chance.
BITS_PER_WINDOW = 16
LEAST_BITS, MOST_BITS = 20, 22
#: Most bytes of distinct windows whose join side is broadcast.
BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAK), "")


def _hash(words: Column, start: Column, length: int | Column) -> Column:
    return F.xxhash64(F.slice(words, start, length))


def _probe(words: Column, start: Column, length: Column) -> Column:
    """Hash of the first, middle and last word of a window; cheaper than that of the window."""
    first = start - 1
    return F.xxhash64(F.get(words, first), F.get(words, first + (length / 2).cast("int")), F.get(words, first + length - 1))


def benchmark_windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """``window, length, hash, probe, item``: each distinct window of each item."""
    worded = benchmark.where(F.col(item).isNotNull()).select(
        F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("exact"))
    length = F.least(F.size("exact"), F.lit(WINDOW))
    opened = worded.where(F.size("exact") > 0).select(
        "item", "exact", length.alias("length"),
        F.explode(F.sequence(F.lit(1), F.size("exact") - length + 1)).alias("at"))
    return opened.select(
        F.array_join(F.slice("exact", F.col("at"), F.col("length")), " ").alias("window"), "length",
        _hash(F.col("exact"), F.col("at"), F.col("length")).alias("hash"),
        _probe(F.col("exact"), F.col("at"), F.col("length")).alias("probe"), "item").distinct()


def table_bits(windows: int) -> int:
    """Bits of the table for so many distinct windows, as a power of two."""
    return min(max(LEAST_BITS, (windows * BITS_PER_WINDOW - 1).bit_length()), MOST_BITS)


def _places(hashed: Column, bits: int) -> tuple[Column, Column]:
    """The two bits of a hash in the table; a probe takes the first."""
    mask = F.lit((1 << bits) - 1)
    return hashed.bitwiseAND(mask), F.shiftrightunsigned(hashed, 32).bitwiseAND(mask)


def _bit_table(windows: DataFrame, bits: int) -> Column:
    """The bit table as an array literal."""
    first, second = _places(F.col("hash"), bits)
    filled = (
        windows.select(F.explode(F.array(first, second, _places(F.col("probe"), bits)[0])).alias("bit"))
        .groupBy(F.shiftrightunsigned("bit", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect()
    )
    table = [0] * (1 << (bits - 6))
    for row in filled:
        table[row["word"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def _set(table: Column, place: Column) -> Column:
    word = F.element_at(table, (F.shiftrightunsigned(place, 6) + 1).cast("int"))
    return F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1


def _candidates(table: Column, bits: int, length: int) -> Column:
    """Starts of the windows of ``length`` words whose bits are set; few windows are hashed whole."""
    def passes(start: Column) -> Column:
        first, second = _places(_hash(F.col("scan"), start, length), bits)
        probe, _ = _places(_probe(F.col("scan"), start, F.lit(length)), bits)
        return _set(table, probe) & _set(table, first) & _set(table, second)

    none = F.array().cast("array<int>")
    return F.when(F.size("scan") >= length, F.filter(F.sequence(F.lit(1), F.size("scan") - (length - 1)), passes)).otherwise(none)


def _worded(starts: str, length: int) -> Column:
    return F.transform(starts, lambda at: F.struct(
        at.alias("at"), F.lit(length).alias("length"), F.array_join(F.slice("exact", at, length), " ").alias("window")))


def hits(documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document row: ``id, n_words, n_hit, spans, items``.

    ``spans`` has the verified windows as (first word from 1, number of words), ``items`` the
    sorted ids of the items met.
    """
    owned = settle(benchmark_windows(benchmark, item, item_text), "benchmark-windows")
    windows = owned.select("window", "length", "hash", "probe").distinct()
    found = windows.groupBy("length").agg(F.count("*").alias("n"), F.sum(F.octet_length("window")).alias("bytes")).collect()
    lengths, size = sorted(r["length"] for r in found), sum(r["bytes"] for r in found)
    bits = table_bits(sum(r["n"] for r in found))
    table = _bit_table(windows, bits)
    scanned = documents.select(
        F.col(id_column).alias("id"), F.col(text).alias("body"), F.monotonically_increasing_id().alias("row"),
        words_of(F.col(text)).alias("scan"))
    starts = [_candidates(table, bits, n).alias(f"start_{n}") for n in lengths]
    marked = scanned.select("id", "row", "body", F.size("scan").cast("long").alias("n_words"), *starts)
    any_start = F.lit(False)
    for n in lengths:
        any_start = any_start | (F.size(f"start_{n}") > 0)
    worded = marked.withColumn("exact", F.when(any_start, words_of(F.col("body"))))
    parts = [_worded(f"start_{n}", n) for n in lengths]
    nothing = F.array().cast("array<struct<at:int,length:int,window:string>>")
    proposed = worded.select(
        "id", "row", "n_words",
        F.explode_outer(F.when(F.size("exact") > 0, F.concat(nothing, *parts)).otherwise(nothing)).alias("p"))
    side = windows.select("window", F.lit(True).alias("met"))
    if size <= BROADCAST_BYTES:
        side = F.broadcast(side)
    verified = proposed.select("id", "row", "n_words", "p.at", "p.length", "p.window").join(side, "window", "left")
    per_row = verified.groupBy("row").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.collect_list(F.when(F.col("met"), F.struct("at", "length")))).alias("spans"),
        F.collect_set(F.when(F.col("met"), F.col("window"))).alias("met"))
    # a row per window met, the first with the spans; rows that met none have keys of their own
    opened = per_row.select("row", "id", "n_words", "spans", F.posexplode_outer("met").alias("n", "met"))
    keyed = opened.select(
        "row", "id", "n_words", F.when(F.coalesce("n", F.lit(0)) == 0, F.col("spans")).alias("spans"),
        F.coalesce("met", F.concat(F.lit("\0"), F.col("row").cast("string"))).alias("window"))
    gathered = keyed.join(owned.select("window", "item"), "window", "left").groupBy("row").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.first("spans", ignorenulls=True).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"))
    start = F.struct(F.lit(1).alias("free"), F.lit(0).cast("long").alias("n"))

    def cover(state: Column, span: Column) -> Column:
        end = span["at"] + span["length"]
        begin = F.greatest(state["free"], span["at"])
        return F.struct(F.greatest(state["free"], end).alias("free"), (state["n"] + F.greatest(end - begin, F.lit(0))).alias("n"))

    return gathered.select(
        "id", "n_words", F.aggregate("spans", start, cover, lambda state: state["n"]).alias("n_hit"), "spans", "items")


def keep_clean(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a verified window; every row is judged by itself, with or without id."""
    rows, key = keyed_rows(documents, "clean-rows")
    caught = hits(rows, benchmark, key, text).where("n_hit > 0").select(F.col("id").alias("_caught"))
    return rows.join(caught, F.col(f"`{key}`") == F.col("_caught"), "left_anti").drop(key)
