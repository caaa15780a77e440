"""Posts: eight fixed columns from a database or from parquet."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

# The columns of a posts table, and those whose nulls become "".
POST_COLUMNS = (
    "id", "reddit_id", "subreddit", "cleaned_title",
    "cleaned_selftext", "keywords", "title", "selftext",
)
TEXT_COLUMNS = ("cleaned_title", "cleaned_selftext", "title", "selftext")


def clean_posts(raw: DataFrame) -> DataFrame:
    """Numeric ``id`` (null where unparsable) and no nulls in the text columns.

    Columns beyond the eight pass through unchanged.
    """
    extra = [name for name in raw.columns if name not in POST_COLUMNS]
    strings = [F.col(name).cast("string").alias(name) for name in POST_COLUMNS if name != "id"]
    return raw.select(F.col("id").try_cast("bigint").alias("id"), *strings, *extra).fillna("", subset=list(TEXT_COLUMNS))


def spread(rows: DataFrame) -> DataFrame:
    """Scanned rows over all cores.

    A scan with fewer splits than cores is dealt out evenly; a large one stays as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def ids_are_keys(posts: DataFrame) -> bool:
    """Whether every post has an id and no two have the same; only ids are shuffled."""
    return posts.groupBy("id").agg(F.count("*").alias("n")).where("id is null or n > 1").isEmpty()


def keyed_posts(posts: DataFrame) -> DataFrame:
    """Posts numbered in reading order as ``id``, with the id they came with as ``post_id``.

    Store the result before it is used twice: the numbers follow the splits of the scan.
    """
    return posts.withColumn("post_id", F.col("id")).withColumn("id", F.monotonically_increasing_id())


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    return clean_posts(spread(spark.read.parquet(path)))


def literal(value: object) -> str:
    """An id as it is written in a database's SQL."""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def cut_query(source: str, partitions: int) -> str:
    """SQL for the first id of each of ``partitions`` ranges with about as many rows.

    ``source`` is the table, or a sample of it as the database writes one. The database orders the
    ids itself, so ids may be numbers or text, and gaps and crowded stretches do not matter.
    """
    return (
        f"SELECT part, MIN(id) AS cut FROM (SELECT id, NTILE({partitions}) OVER (ORDER BY id) AS part "
        f"FROM {source} WHERE id IS NOT NULL) parts GROUP BY part"
    )


def id_predicates(cuts: list) -> list[str]:
    """One condition per range between rising ``cuts``, and one for rows without an id.

    Every row meets exactly one. Ranges are open at both ends, so rows outside what a sample saw
    are read too; numbers and texts are compared by the database, as it ordered them.
    """
    edges = [literal(cut) for cut in dict.fromkeys(cuts)]
    if not edges:
        return ["id IS NOT NULL", "id IS NULL"]
    inner = [f"id >= {low} AND id < {high}" for low, high in zip(edges, edges[1:])]
    return [f"id < {edges[0]}", *inner, f"id >= {edges[-1]}", "id IS NULL"]


def read_posts_jdbc(
    spark: SparkSession, url: str, table: str = "posts", partitions: int = 16,
    cuts: list | None = None, sample: str | None = None, **options: str,
) -> DataFrame:
    """Posts from a database, read in about ``partitions`` ranges of ``id`` with as many rows each.

    Without ``cuts`` the database is asked for the ids that part ``table``, or ``sample``, evenly.
    Rows without an id are a part of their own; ids that are no numbers become null as elsewhere.
    """
    if cuts is None:
        asked = spark.read.format("jdbc").options(url=url, query=cut_query(sample or table, partitions), **options).load()
        cuts = [row["cut"] for row in sorted(asked.collect(), key=lambda row: row["part"])][1:]
    return clean_posts(spark.read.jdbc(url, table, predicates=id_predicates(cuts), properties=dict(options)))
