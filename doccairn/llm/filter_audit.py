"""Filter interaction audit: what each filter removes in every order of the filters.

A row's mask says which filters it fails; what happens to a row in any order follows from its mask
alone. So every mask has a wide packed integer for each measure: one field per order and step that
is 1 where the measure counts rows of that mask. Rows are counted by part, mask and label first;
then the packed integers of a part are summed, each as often as its mask occurs, and the fields are
read off the sum. A field has 64 bits and counts rows, so no field can run over into the next.

The five filters of :func:`mask_rows` are: A under 200 words, B under half of the words distinct,
C over 2 % capitals, D a symbol of ``#$%&*|``, E a text that a row with a smaller id has too. For
E only the smallest id of each text travels, joined back on id and text, so a text that any
share of the rows hold is combined before the shuffle and never gathered.

Defined results: a null text is empty, a null part the empty string. A row without id has no
smaller id and is no row's smaller id; it has no label. Rows that repeat an id are rows each; equal
rows with one id do not make each other fail E. An id with several label rows has a label if one
of them has it. Empty tables give no parts. Other columns are not looked at.
"""

from __future__ import annotations

from functools import cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from doccairn.storage import settle

FILTERS = "ABCDE"
FIELD_BITS = 64
MEASURES = ("kept", "removed", "redundant")
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
CAPITALS, SYMBOLS = bytes(range(65, 91)), b"#$%&*|"
COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def orders(filters: str) -> list[str]:
    return ["".join(order) for order in permutations(filters)]


@cache
def packed(filters: str) -> dict[str, list[int]]:
    """For each measure, the integer of every mask; bit i of a mask is the i-th filter."""
    table: dict[str, list[int]] = {name: [] for name in MEASURES}
    for mask in range(1 << len(filters)):
        fields: dict[str, list[int]] = {name: [] for name in MEASURES}
        for order in orders(filters):
            gone = False
            for letter in order:
                fails = bool(mask >> filters.index(letter) & 1)
                fields["removed"].append(fails and not gone)
                fields["redundant"].append(fails and gone)
                gone = gone or fails
                fields["kept"].append(not gone)
        for name, own in fields.items():
            table[name].append(sum(int(bit) << FIELD_BITS * place for place, bit in enumerate(own)))
    return table


def unpack(total: int, fields: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(fields * FIELD_BITS // 8, "little"), dtype="<u8").astype(np.int64)


def report(part: str, counts: pd.DataFrame, filters: str) -> pd.DataFrame:
    """All orders and steps of one part from its ``mask, n, good, toxic`` counts."""
    table, names = packed(filters), orders(filters)
    steps = len(filters)
    fields = len(names) * steps

    def total(measure: str, column: str) -> np.ndarray:
        own = table[measure]
        return unpack(sum(own[mask] * int(n) for mask, n in zip(counts["mask"], counts[column])), fields)

    letters = np.array([filters.index(letter) for order in names for letter in order])
    alone = np.zeros(steps, dtype=np.int64)
    for mask, n in zip(counts["mask"], counts["n"]):
        if int(mask).bit_count() == 1:
            alone[int(mask).bit_length() - 1] += n
    removed = total("removed", "n")
    return pd.DataFrame({
        "part": part, "filter_order": np.repeat(names, steps), "step": np.tile(np.arange(1, steps + 1), len(names)),
        "kept": total("kept", "n"), "removed": removed, "redundant": total("redundant", "n"),
        "unique_fails": alone[letters], "good_lost": total("removed", "good"), "toxic_lost": total("removed", "toxic"),
        "shapley": np.array([removed[letters == f].sum() for f in range(steps)], dtype=np.int64)[letters],
    })


def audit(masked: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every order and step per part, from rows of ``part, mask, n`` and booleans ``good, toxic``.

    ``n`` is how many documents a row stands for. One task gets a part's masks, at most one row
    for each, however many documents there are.
    """
    counted = masked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))

    def of_part(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        return report(key[0], counts, filters)

    measures = ", ".join(f"{name} long" for name in COLUMNS)
    return counted.groupBy("part").applyInPandas(of_part, f"part string, filter_order string, step int, {measures}")


def text_mask(text: str | None) -> int:
    """Filters A to D of one text, as bits."""
    text = text or ""
    content = text.encode("utf-8", "surrogatepass")
    words = content.split()
    capitals = len(content) - len(content.translate(None, CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > CAPITAL_PERCENT * len(text)) << 2
        | (len(content) != len(content.translate(None, SYMBOLS))) << 3
    )


def text_masks(text: Column) -> Column:
    @F.pandas_udf("int")
    def masks(texts: pd.Series) -> pd.Series:
        return pd.Series([text_mask(t) for t in texts], dtype="int32")

    return masks(text)


def mask_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n`` from ``documents(id, text, part)`` and ``labels(id, good, toxic)``."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "id", F.coalesce("part", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        text_masks(text).alias("mask"))
    # Texts are read once; from here on a row is an id, a digest and a few small columns.
    rows = settle(rows.groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("n")), "audit-rows")
    smallest = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.where("id is not null").groupBy("id").agg(F.bool_or("good").alias("good"), F.bool_or("toxic").alias("toxic"))
    named = rows.where("id is not null").join(smallest, ["id", "digest"], "left").join(marks, "id", "left")
    nameless = rows.where("id is null").select("*", F.lit(True).alias("first"), F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    no = F.lit(False)
    return named.unionByName(nameless).select(
        "part", F.col("mask").bitwiseOR(F.when(F.coalesce("first", no), 0).otherwise(1 << FILTERS.index("E"))).alias("mask"),
        F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "n")
