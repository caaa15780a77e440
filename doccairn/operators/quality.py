"""Clustering quality in two passes over the vectors.

Rows are ``id``, ``vector`` (unit length, ``array<double>``) and ``cluster`` (int). The
first pass means each cluster's centroid; the second scores every row against the
centroids. On unit rows the mean cosine distance from x to a cluster is one minus the dot
product of x and the cluster's mean, so the silhouette needs no pairs of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from doccairn.functions.vectors import as_features, mean_vector, squared_distance, total
from doccairn.storage import discard, settle

# Centroids sent to the tasks at once; more are taken in several passes.
CENTROIDS_PER_PASS = 1024
# Clusters whose centroids may stand in one row; more are compared block by block.
CLUSTERS_IN_A_ROW = 64
# Distances held at once in a task.
CELLS = 1 << 21


def centroids(vectors: DataFrame) -> DataFrame:
    """Size and plain mean of every cluster."""
    return vectors.groupBy("cluster").agg(
        F.count("*").alias("size"), mean_vector(F.col("vector")).alias("centroid")
    )


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Centroids:
    """Some of the centroids as a matrix, ordered by cluster."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda row: row["cluster"])
        self.clusters = np.array([row["cluster"] for row in rows], dtype=np.int64)
        self.sizes = np.array([row["size"] for row in rows], dtype=np.int64)
        self.values = np.array([row["centroid"] for row in rows], dtype=np.float64)
        self.norms = np.linalg.norm(self.values, axis=1)
        self.spreads = np.array([row["spread"] if "spread" in row else 0.0 for row in rows], dtype=np.float64)

    @staticmethod
    def passes(table: DataFrame, per_pass: int = CENTROIDS_PER_PASS, *more: str) -> Iterator[Centroids]:
        """Bring ``cluster, size, centroid`` rows to the driver, about ``per_pass`` at a time."""
        table = table.select("cluster", "size", "centroid", *more)
        rows = table.limit(per_pass + 1).collect()
        if len(rows) <= per_pass:
            if rows:
                yield Centroids(rows)
            return
        table = settle(table, "centroids")
        parts = table.count() // (per_pass // 2) + 1
        for part in range(parts):
            rows = table.where(F.pmod(F.xxhash64("cluster"), F.lit(parts)) == part).collect()
            if rows:
                yield Centroids(rows)

    def score(self, vector: Column, cluster: Column) -> Column:
        """Similarity to the own mean and to the best other one, and distances to the own."""

        @F.arrow_udf("struct<own:double,size:bigint,squared:double,cosine:double,other:double>")
        def scored(vectors: pa.Array, labels: pa.Array) -> pa.Array:
            rows = matrix(vectors)
            wanted = labels.to_numpy(zero_copy_only=False).astype(np.int64)
            place = np.minimum(np.searchsorted(self.clusters, wanted), len(self.clusters) - 1)
            here = self.clusters[place] == wanted
            dots = rows @ self.values.T
            lines = np.arange(len(rows))
            own = dots[lines, place]
            dots[lines[here], place[here]] = -np.inf
            other = dots.max(axis=1)
            squared = np.square(rows - self.values[place]).sum(axis=1)
            lengths = np.linalg.norm(rows, axis=1) * self.norms[place]
            cosine = 1.0 - np.divide(own, lengths, out=np.zeros_like(own), where=lengths > 0)
            found = [pa.array(v, mask=~here) for v in (own, self.sizes[place], squared, cosine)]
            best = pa.array(other, mask=np.isneginf(other))
            return pa.StructArray.from_arrays(
                [*found, best], ["own", "size", "squared", "cosine", "other"]
            )

        return scored(vector, cluster)

    def nearest(self, vector: Column) -> Column:
        """Squared distance to the closest centroid and its cluster, the lower on a tie."""

        @F.arrow_udf("struct<squared:double,cluster:int>")
        def closest(vectors: pa.Array) -> pa.Array:
            rows = matrix(vectors)
            reach = np.square(self.norms) - 2.0 * (rows @ self.values.T)
            place = reach.argmin(axis=1)
            squared = np.square(rows - self.values[place]).sum(axis=1)
            return pa.StructArray.from_arrays(
                [pa.array(squared), pa.array(self.clusters[place].astype(np.int32))],
                ["squared", "cluster"],
            )

        return closest(vector)

    def worst_ratio(self, cluster: Column, spread: Column, centroid: Column) -> Column:
        """Largest sum of spreads over the distance to another of these centroids; 0 for one that coincides."""

        @F.arrow_udf("double")
        def worst(labels: pa.Array, spreads: pa.Array, centres: pa.Array) -> pa.Array:
            own, width, rows = labels.to_numpy(), spreads.to_numpy(), matrix(centres)
            found = np.zeros(len(rows))
            step = max(64, CELLS // len(self.values))
            for begin in range(0, len(rows), step):
                part = slice(begin, begin + step)
                scale = np.square(rows[part]).sum(axis=1)[:, None] + np.square(self.norms)
                squared = scale - 2.0 * (rows[part] @ self.values.T)
                # Where two nearly coincide the difference of large numbers says nothing.
                near, by = np.nonzero(squared < 1e-6 * scale)
                squared[near, by] = np.square(rows[part][near] - self.values[by]).sum(axis=1)
                squared[own[part][:, None] == self.clusters] = 0.0
                apart = np.sqrt(np.maximum(squared, 0.0))
                sums = width[part][:, None] + self.spreads
                found[part] = np.divide(sums, apart, out=np.zeros_like(apart), where=apart > 0).max(axis=1)
            return pa.array(found)

        return worst(cluster, spread, centroid)


def score_rows(vectors: DataFrame) -> DataFrame:
    """Add ``silhouette``, ``cosine_distance`` and ``squared_distance`` to every row.

    The silhouette is 0 in a cluster of one and null if there is no other cluster.
    """
    scored = vectors
    for index, part in enumerate(Centroids.passes(centroids(vectors))):
        scored = scored.withColumn("__now", part.score(F.col("vector"), F.col("cluster")))
        now = F.col("__now")
        if index == 0:
            scored = scored.withColumn("__score", now)
        else:
            before = F.col("__score")
            merged = [F.coalesce(now[f], before[f]).alias(f) for f in ("own", "size", "squared", "cosine")]
            best = F.greatest(now["other"], before["other"]).alias("other")
            scored = settle(scored.withColumn("__score", F.struct(*merged, best)), "scored")
        scored = scored.drop("__now")
    score, size = F.col("__score"), F.col("__score")["size"]
    inside = size / (size - 1) * (1.0 - score["own"])
    outside = 1.0 - score["other"]
    widest = F.greatest(inside, outside)
    silhouette = (
        F.when(outside.isNull(), None)
        .when((size == 1) | (widest == 0), 0.0)
        .otherwise((outside - inside) / widest)
    )
    return scored.withColumns({
        "silhouette": silhouette,
        "cosine_distance": score["cosine"],
        "squared_distance": score["squared"],
    }).drop("__score")


def assign_nearest(vectors: DataFrame, table: DataFrame) -> DataFrame:
    """Put every vector into the cluster of the closest ``centroid`` of ``table``."""
    assigned = vectors.drop("cluster")
    for index, part in enumerate(Centroids.passes(table)):
        now = part.nearest(F.col("vector"))
        if index == 0:
            assigned = assigned.withColumn("__best", now)
        else:
            assigned = settle(assigned.withColumn("__best", F.least(F.col("__best"), now)), "assigned")
    best = F.col("__best")
    return assigned.withColumns(
        {"cluster": best["cluster"], "squared_distance": best["squared"]}
    ).drop("__best")


def cluster_stats(scored: DataFrame) -> DataFrame:
    """One row per non-empty cluster from the rows of :func:`score_rows`."""
    return scored.groupBy("cluster").agg(
        F.count("*").alias("size"),
        F.avg("silhouette").alias("silhouette"),
        F.sum("silhouette").alias("silhouette_sum"),
        F.avg(F.sqrt("squared_distance")).alias("spread"),
        F.sum("squared_distance").alias("within"),
        mean_vector(F.col("vector")).alias("centroid"),
    )


def complete_range(stats: DataFrame, k: int) -> DataFrame:
    """Every cluster 0..k-1; empty ones get size 0 and silhouette 0."""
    every = stats.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    empty = F.col("size").isNull()
    return every.join(stats, "cluster", "left").withColumns({
        "size": F.coalesce("size", F.lit(0).cast("bigint")),
        "silhouette": F.when(empty, 0.0).otherwise(F.col("silhouette")),
    })


def cluster_sizes(vectors: DataFrame, k: int) -> DataFrame:
    sizes = vectors.groupBy("cluster").agg(F.count("*").alias("size"))
    return complete_range(sizes.withColumn("silhouette", F.lit(None).cast("double")), k).select(
        "cluster", "size"
    )


def size_spread(sizes: DataFrame) -> DataFrame:
    """Population standard deviation of the sizes, empty clusters included."""
    return sizes.agg(F.stddev_pop("size").alias("cluster_size_std"))


def davies_bouldin(members: Column) -> Column:
    """Index over an array of (size, spread, centroid) structs; coinciding centroids add 0."""

    def worst(one: Column) -> Column:
        def ratio(other: Column) -> Column:
            apart = F.sqrt(squared_distance(one["centroid"], other["centroid"]))
            return F.when(apart > 0, (one["spread"] + other["spread"]) / apart).otherwise(0.0)

        return F.array_max(F.transform(members, ratio))

    return F.when(F.size(members) > 1, total(F.transform(members, worst)) / F.size(members))


def calinski_harabasz(members: Column, rows: Column, within: Column) -> Column:
    """Between over within dispersion per degree of freedom; 1 if nothing varies within."""
    weighted = F.transform(members, lambda m: F.transform(m["centroid"], lambda x: x * m["size"]))
    summed = F.reduce(
        F.slice(weighted, 2, F.size(weighted)), F.element_at(weighted, 1),
        lambda left, right: F.zip_with(left, right, lambda a, b: a + b),
    )
    middle = F.transform(summed, lambda x: x / rows)
    between = total(F.transform(
        members, lambda m: m["size"] * squared_distance(m["centroid"], middle)
    ))
    k = F.size(members)
    index = F.when(within == 0, 1.0).otherwise((between / (k - 1)) / (within / (rows - k)))
    return F.when(k > 1, index)


def blocked_measures(stats: DataFrame, per_pass: int = CENTROIDS_PER_PASS) -> tuple[float | None, float | None]:
    """Davies-Bouldin and Calinski-Harabasz of any number of clusters, for their rows in ``stats``.

    Every pass compares all centroids with a block of them, so no row and no task holds them all,
    and only a block and single sums come to the driver.
    """
    written: list[str] = []
    spark = stats.sparkSession
    members = settle(stats.where("size > 0").select("cluster", "size", "spread", "within", "centroid"), "members", written)
    worst = members.withColumn("worst", F.lit(0.0))
    for part in Centroids.passes(members, per_pass, "spread"):
        ratio = part.worst_ratio(F.col("cluster"), F.col("spread"), F.col("centroid"))
        worst = settle(worst.withColumn("worst", F.greatest("worst", ratio)), "worst-ratios", written)
    found = worst.agg(
        F.count("*").alias("k"), F.sum("size").alias("rows"), F.sum("within").alias("within"), F.avg("worst").alias("worst"),
        Summarizer.mean(as_features(F.col("centroid")), F.col("size").cast("double")).alias("middle"),
    ).first()
    if found["k"] < 2:
        discard(spark, written)
        return None, None
    middle = F.lit([float(x) for x in found["middle"]])
    between = members.agg(F.sum(F.col("size") * squared_distance(F.col("centroid"), middle))).first()[0]
    discard(spark, written)
    if found["within"] == 0:
        return found["worst"], 1.0
    return found["worst"], (between / (found["k"] - 1)) / (found["within"] / (found["rows"] - found["k"]))


def quality(stats: DataFrame, k: int, in_a_row: int = CLUSTERS_IN_A_ROW) -> DataFrame:
    """One row with all measures of a clustering into ``k``; ``stats`` has at most k rows.

    Up to ``in_a_row`` clusters are compared within that row; more go through
    :func:`blocked_measures`, and the row holds numbers alone. ``stats`` should then be stored.
    """
    complete = complete_range(stats, k)
    blocked = k > in_a_row
    present = F.col("size") > 0
    label = F.col("cluster").cast("string")

    def keyed(value: str) -> Column:
        entries = F.array_sort(F.collect_list(F.struct("cluster", label.alias("key"), F.col(value).alias("value"))))
        return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))

    gathered = complete.agg(
        F.sum("size").alias("rows"),
        F.sum("within").alias("within"),
        F.sum("silhouette_sum").alias("silhouette_sum"),
        F.stddev_pop("size").alias("cluster_size_std"),
        keyed("silhouette").alias("per_cluster_silhouette"),
        keyed("size").alias("cluster_sizes"),
        F.count_if(present).alias("clusters"),
        *([] if blocked else [F.collect_list(F.when(present, F.struct("size", "spread", "centroid"))).alias("members")]),
    )
    members, rows = F.col("members"), F.col("rows")
    if blocked:
        bouldin, calinski = (F.lit(value).cast("double") for value in blocked_measures(stats))
    else:
        bouldin, calinski = davies_bouldin(members), calinski_harabasz(members, rows, F.col("within"))
    return gathered.select(
        F.when(F.col("clusters") > 1, F.col("silhouette_sum") / rows).alias("cosine_silhouette"),
        "per_cluster_silhouette",
        bouldin.alias("davies_bouldin"),
        calinski.alias("calinski_harabasz"),
        "cluster_size_std",
        "cluster_sizes",
        F.col("within").alias("inertia"),
    )
