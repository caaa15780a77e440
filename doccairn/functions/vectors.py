"""Vector expressions between array columns and ML vectors."""

from __future__ import annotations

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F


def as_features(column: Column) -> Column:
    return array_to_vector(column.cast("array<double>"))


def as_array(column: Column) -> Column:
    return vector_to_array(column)


def mean_vector(column: Column) -> Column:
    """Aggregate: the element-wise mean, combined map-side."""
    return as_array(Summarizer.mean(as_features(column)))


def total(column: Column) -> Column:
    """Sum of the elements of one array."""
    return F.aggregate(column, F.lit(0.0), lambda left, right: left + right)


def squared_distance(left: Column, right: Column) -> Column:
    """Meant for tables of a few rows; row-heavy work goes through the Arrow functions."""
    return total(F.zip_with(left, right, lambda a, b: (a - b) * (a - b)))


def l2_normalize(df: DataFrame, column: str = "vector") -> DataFrame:
    """Scale ``column`` to unit length; zero vectors stay zero."""
    raw, unit = f"__raw_{column}", f"__unit_{column}"
    scaled = Normalizer(p=2.0, inputCol=raw, outputCol=unit).transform(
        df.withColumn(raw, as_features(F.col(column)))
    )
    return scaled.withColumn(column, as_array(F.col(unit))).drop(raw, unit)
