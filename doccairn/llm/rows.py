"""Rows with a key of their own, for decisions that hold for a row and not for its id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from doccairn.storage import settle


def keyed_rows(documents: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The documents, written once with a number per row, and the name of that column.

    The numbers follow the splits of a scan, so they hold for the written table only.
    """
    taken = {column.lower() for column in documents.columns}
    key = next(f"row_key{'_' * n}" for n in range(len(taken) + 1) if f"row_key{'_' * n}" not in taken)
    return settle(documents.withColumn(key, F.monotonically_increasing_id()), name), key
