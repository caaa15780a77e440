"""The data behind each chart, one DataFrame per chart."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from doccairn.functions.labels import METRICS, config_label, first_words
from doccairn.functions.vectors import as_array, as_features


def titled(series: DataFrame, heading: str, tag: Column) -> DataFrame:
    """A chart's data with its ``title``: the heading and the configuration's tag."""
    return series.withColumn("title", F.concat(F.lit(f"{heading} — "), tag))


def elbow_series(search: DataFrame, best_k: int) -> DataFrame:
    """``k, inertia, silhouette``; an undefined silhouette is drawn at 0."""
    return search.select(
        "k", "inertia", F.coalesce(F.nanvl("silhouette", F.lit(None)), F.lit(0.0)).alias("silhouette"),
        (F.col("k") == best_k).alias("is_best"),
    )


def word_lists(keywords: DataFrame) -> DataFrame:
    """``cluster, words`` from ranked keyword rows."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "word")))
    return keywords.groupBy("cluster").agg(ranked.alias("ranked")).select("cluster", F.col("ranked.word").alias("words"))


def legends(keywords: DataFrame, clusters: DataFrame, words: int = 5) -> DataFrame:
    """``C<id>: first words`` for every cluster."""
    joined = clusters.select("cluster").join(word_lists(keywords), "cluster", "left")
    text = F.coalesce(first_words(F.col("words"), words), F.lit(""))
    return joined.select("cluster", F.concat(F.lit("C"), F.col("cluster"), F.lit(": "), text).alias("legend"))


def cluster_size_series(sizes: DataFrame, keywords: DataFrame, words: int = 3) -> DataFrame:
    joined = sizes.join(word_lists(keywords), "cluster", "left")
    text = F.coalesce(first_words(F.col("words"), words), F.lit(""))
    label = F.concat(F.lit("C"), F.col("cluster"), F.lit("\n"), text)
    return joined.select("cluster", "size", label.alias("label"))


def silhouette_series(complete: DataFrame) -> DataFrame:
    """Per cluster its mean silhouette beside the mean over all rows."""
    overall = complete.agg((F.sum("silhouette_sum") / F.sum("size")).alias("overall")).scalar()
    return complete.select("cluster", "silhouette", overall.alias("overall"))


def metric_rows(flat: DataFrame, *ids: str) -> DataFrame:
    """The four metrics in long form."""
    return flat.unpivot(list(ids), list(METRICS), "metric", "value")


def config_series(flat: DataFrame) -> DataFrame:
    """One method's configurations: ``config_name, metric, value``."""
    return metric_rows(flat, "config_name")


def metric_bars(flat: DataFrame) -> DataFrame:
    """All runs: ``method_key, label, metric, value``."""
    labelled = flat.withColumn("label", config_label(F.col("method"), F.col("config_name")))
    return metric_rows(labelled, "method_key", "label")


def method_average_bars(averages: DataFrame) -> DataFrame:
    return metric_rows(averages, "method")


def principal_components(vectors: DataFrame) -> tuple[DataFrame, list[float]]:
    """Centred ``pc1, pc2`` of every row and their shares of the variance.

    The component sign is fixed by a positive largest loading.
    """
    rows = vectors.withColumn("__features", as_features(F.col("vector")))
    model = PCA(k=2, inputCol="__features", outputCol="__pc").fit(rows)
    loadings = model.pc.toArray()
    means = rows.agg(Summarizer.mean(F.col("__features")).alias("mean")).first()["mean"]
    largest = abs(loadings).argmax(axis=0)
    projected = model.transform(rows).withColumn("__pc", as_array(F.col("__pc")))
    coordinates = {}
    for axis in (0, 1):
        sign = 1.0 if loadings[largest[axis], axis] >= 0 else -1.0
        shift = float(DenseVector(loadings[:, axis]).dot(means))
        coordinates[f"pc{axis + 1}"] = (F.col("__pc")[axis] - shift) * sign
    return projected.withColumns(coordinates).drop("__features", "__pc"), list(model.explainedVariance)


def cluster_map(vectors: DataFrame, legend: DataFrame) -> tuple[DataFrame, list[float]]:
    """``id, cluster, pc1, pc2, legend`` for a scatter plot. ``legend`` has one row per cluster, of any number."""
    placed, variance = principal_components(vectors)
    points = placed.select("id", "cluster", "pc1", "pc2")
    return points.join(legend, "cluster", "left"), variance
