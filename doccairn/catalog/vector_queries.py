"""Vector queries: ``embeddings`` stands in for document vectors, ``label`` for the clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from doccairn.catalog.registry import query, settled_decimals, sql_decimals, table
from doccairn.catalog.text_queries import posts
from doccairn.catalog.word_bin_queries import VECTORS_SQL, DocumentVectors
from doccairn.functions.vectors import l2_normalize as normalize_vectors
from doccairn.operators import describe, quality

LABELS = 10

# Vectors are stretched first so that normalization has work to do.
UNIT_SQL = """raw AS (
  SELECT vec_id AS id, label AS cluster,
         list_transform(embedding, lambda x : CAST(x AS DOUBLE) * (1 + vec_id % 3)) AS v FROM embeddings),
unit AS (SELECT id, cluster, list_transform(v, lambda x : x / sqrt(list_dot_product(v, v))) AS v FROM raw)"""

CENTROID_SQL = """cells AS (SELECT cluster, generate_subscripts(v, 1) AS p, unnest(v) AS x FROM unit),
means AS (SELECT cluster, p, avg(x) AS m FROM cells GROUP BY cluster, p),
cen AS (SELECT cluster, list(m ORDER BY p) AS c FROM means GROUP BY cluster)"""

SCORED_SQL = """scored AS (
  SELECT id, u.cluster, 1 - list_dot_product(v, c) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(c, c))) AS cosine_distance,
         list_distance(v, c) AS distance FROM unit u JOIN cen USING (cluster))"""

# The silhouette by its definition over all pairs of rows.
SILHOUETTE_SQL = """pairs AS (
  SELECT a.id, a.cluster, b.cluster AS other, avg(1 - list_dot_product(a.v, b.v)) AS d
  FROM unit a JOIN unit b ON a.id <> b.id GROUP BY ALL),
ab AS (SELECT id, cluster, max(CASE WHEN other = cluster THEN d END) AS a, min(CASE WHEN other <> cluster THEN d END) AS b
       FROM pairs GROUP BY ALL),
sil AS (SELECT id, cluster, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    stretch = 1 + F.col("vec_id") % 3
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.transform(F.col("embedding").cast("array<double>"), lambda x: x * stretch).alias("vector"),
        F.col("label").alias("cluster"),
    )


def unit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_vectors(vectors(spark, sf_dir))


def scored_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_rows(unit_vectors(spark, sf_dir))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cluster_stats(scored_vectors(spark, sf_dir))


@query(f"""WITH {UNIT_SQL}, cells AS (SELECT id, generate_subscripts(v, 1) AS p, unnest(v) AS x FROM unit)
SELECT id, CAST(p - 1 AS INTEGER) AS pos, {sql_decimals('x')} AS value FROM cells""")
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = unit_vectors(spark, sf_dir).select("id", F.posexplode("vector").alias("pos", "value"))
    return cells.withColumn("value", settled_decimals(F.col("value")))


@query(f"""WITH {UNIT_SQL}, {CENTROID_SQL}, {SCORED_SQL}
SELECT id, cluster, {sql_decimals('cosine_distance')} AS cosine_distance FROM scored""")
def cosine_to_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_vectors(spark, sf_dir).select(
        "id", "cluster", settled_decimals(F.col("cosine_distance")).alias("cosine_distance")
    )


NEAREST_SQL = """ranked AS (
  SELECT id, cluster, cosine_distance, CAST(row_number() OVER (
    PARTITION BY cluster ORDER BY round(cosine_distance, 6), id) AS INTEGER) AS rank FROM scored),
nearest AS (SELECT * FROM ranked WHERE rank <= 10)"""


@query(f"""WITH {UNIT_SQL}, {CENTROID_SQL}, {SCORED_SQL}, {NEAREST_SQL}
SELECT cluster, rank, id, {sql_decimals('cosine_distance')} AS cosine_distance FROM nearest""")
def nearest_to_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    nearest = describe.nearest_to_centroid(scored_vectors(spark, sf_dir))
    return nearest.withColumn("cosine_distance", settled_decimals(F.col("cosine_distance")))


# All documents as posts with vectors and clusters of their own.
DOCUMENT_UNIT_SQL = f"""widths AS (SELECT 100 AS bins), {VECTORS_SQL},
unit AS (SELECT id, label AS cluster, list_transform(v, lambda x : x / sqrt(list_dot_product(v, v))) AS v FROM document_vectors)"""


@query(f"""WITH {DOCUMENT_UNIT_SQL}, {CENTROID_SQL}, {SCORED_SQL}, {NEAREST_SQL}
SELECT cluster, rank, id, reddit_id, subreddit, title, selftext FROM nearest JOIN posts USING (id)""")
def representative_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_rows(DocumentVectors(spark, sf_dir).clustered(100))
    nearest = describe.nearest_to_centroid(scored).drop("cosine_distance")
    return describe.representative_posts(nearest, posts(spark, sf_dir))


@query(f"""WITH {DOCUMENT_UNIT_SQL}
SELECT id, cluster, subreddit, title FROM posts JOIN unit USING (id)""")
def label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = DocumentVectors(spark, sf_dir).clustered(100).select("id", "cluster")
    return posts(spark, sf_dir).join(labels, "id").select("id", "cluster", "subreddit", "title")


@query(f"""WITH {UNIT_SQL}, {CENTROID_SQL},
reach AS (SELECT id, cen.cluster, list_distance(v, c) AS d FROM unit, cen)
SELECT id, CAST(arg_min(cluster, d) AS INTEGER) AS cluster, {sql_decimals('min(d) * min(d)')} AS squared_distance
FROM reach GROUP BY id""")
def assign_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = unit_vectors(spark, sf_dir)
    assigned = quality.assign_nearest(unit, quality.centroids(unit))
    return assigned.select(
        "id", "cluster", settled_decimals(F.col("squared_distance")).alias("squared_distance")
    )


EVERY_SQL = "every AS (SELECT CAST(range AS INTEGER) AS cluster FROM range(12))"


@query(f"""WITH {UNIT_SQL}, {EVERY_SQL}
SELECT e.cluster, count(u.id) AS size FROM every e LEFT JOIN unit u USING (cluster) GROUP BY e.cluster""")
def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes over a range two clusters wider than the labels."""
    return quality.cluster_sizes(vectors(spark, sf_dir), LABELS + 2)


@query(f"""WITH {UNIT_SQL}, {EVERY_SQL}, sizes AS (
  SELECT e.cluster, count(u.id) AS size FROM every e LEFT JOIN unit u USING (cluster) GROUP BY e.cluster)
SELECT {sql_decimals('stddev_pop(size)')} AS cluster_size_std FROM sizes""")
def cluster_size_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = quality.size_spread(quality.cluster_sizes(vectors(spark, sf_dir), LABELS + 2))
    return spread.select(settled_decimals(F.col("cluster_size_std")).alias("cluster_size_std"))


@query(f"WITH {UNIT_SQL}, {SILHOUETTE_SQL} SELECT {sql_decimals('avg(s)')} AS silhouette FROM sil")
def silhouette_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_vectors(spark, sf_dir).agg(settled_decimals(F.avg("silhouette")).alias("silhouette"))


@query(f"""WITH {UNIT_SQL}, {SILHOUETTE_SQL}
SELECT cluster, {sql_decimals('avg(s)')} AS silhouette FROM sil GROUP BY cluster""")
def silhouette_per_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats(spark, sf_dir).select("cluster", settled_decimals(F.col("silhouette")).alias("silhouette"))


@query(f"""WITH {UNIT_SQL}, {SILHOUETTE_SQL}, {EVERY_SQL}
SELECT e.cluster, count(s.id) AS size, {sql_decimals('coalesce(avg(s), 0)')} AS silhouette
FROM every e LEFT JOIN sil s USING (cluster) GROUP BY e.cluster""")
def complete_cluster_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = quality.complete_range(stats(spark, sf_dir), LABELS + 2)
    return complete.select("cluster", "size", settled_decimals(F.col("silhouette")).alias("silhouette"))


@query(f"""WITH {UNIT_SQL}, {CENTROID_SQL}, {SCORED_SQL},
spread AS (SELECT cluster, avg(distance) AS s FROM scored GROUP BY cluster),
ratios AS (SELECT a.cluster, max((x.s + y.s) / list_distance(a.c, b.c)) AS r
           FROM cen a JOIN cen b ON a.cluster <> b.cluster JOIN spread x ON x.cluster = a.cluster
           JOIN spread y ON y.cluster = b.cluster GROUP BY a.cluster)
SELECT {sql_decimals('avg(r)')} AS davies_bouldin FROM ratios""")
def davies_bouldin(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = quality.quality(stats(spark, sf_dir), LABELS)
    return record.select(settled_decimals(F.col("davies_bouldin")).alias("davies_bouldin"))


@query(f"""WITH {UNIT_SQL}, {CENTROID_SQL}, {SCORED_SQL},
middle AS (SELECT list(m ORDER BY p) AS c FROM (SELECT p, avg(x) AS m FROM cells GROUP BY p)),
sizes AS (SELECT cluster, count(*) AS n FROM unit GROUP BY cluster),
between_sum AS (SELECT sum(n * list_distance(cen.c, middle.c) ** 2) AS b, count(*) AS k FROM cen JOIN sizes USING (cluster), middle),
within_sum AS (SELECT sum(distance ** 2) AS w, count(*) AS n FROM scored)
SELECT {sql_decimals('(b / (k - 1)) / (w / (n - k))')} AS calinski_harabasz FROM between_sum, within_sum""")
def calinski_harabasz(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = quality.quality(stats(spark, sf_dir), LABELS)
    return record.select(settled_decimals(F.col("calinski_harabasz")).alias("calinski_harabasz"))


@query(f"""WITH {UNIT_SQL}, {CENTROID_SQL}, {SCORED_SQL}
SELECT {sql_decimals('sum(distance ** 2)')} AS inertia FROM scored""")
def inertia(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_vectors(spark, sf_dir)
    return scored.agg(settled_decimals(F.sum("squared_distance")).alias("inertia"))
