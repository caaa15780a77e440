"""What is in each cluster: keywords, groups, and the posts nearest its centroid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from doccairn.functions.text import default_stop_words
from doccairn.operators.corpus import drop_stop_words, keyword_rows

# Groups that the record of a cluster may hold.
MOST_GROUPS = 10_000


def top_rows(df: DataFrame, group: str, order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of every group.

    The filter on ``row_number`` lets Spark cut each partition to ``n`` rows per group
    before the shuffle, so a group of any size costs the last task little.
    """
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)


def occurrence(row: Column, pos: Column) -> Column:
    """Row and position as one number in reading order.

    The minimum of a number is kept by a hash aggregate; that of a struct would first sort
    every token.
    """
    return row.cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + pos


def keyword_counts(
    labelled_posts: DataFrame, cluster: str = "cluster", stop: list[str] | DataFrame | None = None
) -> DataFrame:
    """Frequency and first occurrence of every keyword in every cluster."""
    words = drop_stop_words(
        keyword_rows(labelled_posts, cluster), default_stop_words() if stop is None else stop
    )
    return words.groupBy(cluster, "word").agg(
        F.count("*").alias("count"), F.min(occurrence(F.col("id"), F.col("pos"))).alias("first")
    )


def top_keywords(
    labelled_posts: DataFrame, cluster: str = "cluster", top_n: int = 20,
    stop: list[str] | DataFrame | None = None,
) -> DataFrame:
    """The most frequent keywords of each cluster; ties go to the earlier occurrence."""
    counts = keyword_counts(labelled_posts, cluster, stop)
    order = [F.desc("count"), F.asc("first")]
    return top_rows(counts, cluster, order, top_n).select(cluster, "rank", "word", "count")


def group_distribution(
    labelled_posts: DataFrame, cluster: str = "cluster", group: str = "subreddit"
) -> DataFrame:
    """Posts per group in each cluster; posts without a group do not count."""
    known = labelled_posts.where(F.col(group).isNotNull())
    return known.groupBy(cluster, group).agg(F.count("*").alias("count"))


def with_share(distribution: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Add ``share``, the percentage of its cluster's counted posts."""
    total = F.sum("count").over(Window.partitionBy(cluster))
    return distribution.withColumn("share", 100.0 * F.col("count") / total)


def top_groups(
    distribution: DataFrame, n: int, cluster: str = "cluster", group: str = "subreddit"
) -> DataFrame:
    return top_rows(distribution, cluster, [F.desc("count"), F.asc(group)], n)


def largest_clusters(sizes: DataFrame, n: int = 5) -> DataFrame:
    return sizes.orderBy(F.desc("size"), F.asc("cluster")).limit(n)


def nearest_to_centroid(scored: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` documents of each cluster at the smallest cosine distance to its centroid.

    Distances are compared at six decimals, then by ``id``, so float noise swaps no ranks.
    """
    order = [F.round("cosine_distance", 6).asc(), F.asc("id")]
    return top_rows(scored, "cluster", order, n).select("cluster", "rank", "id", "cosine_distance")


def representative_posts(nearest: DataFrame, posts: DataFrame) -> DataFrame:
    """Fields of the nearest posts.

    ``nearest`` holds a few rows per cluster, but there may be many clusters: whether it goes to
    the posts or both are shuffled is decided by its size at run time.
    """
    fields = posts.select("id", "reddit_id", "subreddit", "title", "selftext")
    return fields.join(nearest, "id")


def split_groups(distribution: DataFrame, most: int, cluster: str = "cluster", group: str = "subreddit") -> tuple[DataFrame, DataFrame]:
    """The ``most`` largest groups of each cluster, and all others.

    The first part is cut to ``most`` rows per cluster in every partition before its shuffle; the
    second is what a join on cluster and group leaves over, so no task holds the groups of a cluster.
    """
    first = top_groups(distribution, most, cluster, group).drop("rank")
    return first, distribution.join(first, [cluster, group], "left_anti")


def cluster_summaries(
    complete: DataFrame, keywords: DataFrame, distribution: DataFrame, representatives: DataFrame,
    most_groups: int = MOST_GROUPS,
) -> DataFrame:
    """Nested record per cluster, as a result document has it.

    Keywords and posts are cut to a few rows per cluster. Groups are all there up to
    ``most_groups`` per cluster; the rest of a cluster with more is :func:`other_groups`.
    """
    distribution, _ = split_groups(distribution, most_groups)
    words = keywords.groupBy("cluster").agg(
        F.array_sort(F.collect_list(F.struct("rank", "word", "count"))).alias("words")
    )
    ranked = F.struct((-F.col("count")).alias("order"), F.col("subreddit").alias("name"), "count")
    groups = distribution.groupBy("cluster").agg(F.array_sort(F.collect_list(ranked)).alias("groups"))
    posts = representatives.groupBy("cluster").agg(F.array_sort(F.collect_list(
        F.struct("rank", "reddit_id", "subreddit", "title", "selftext")
    )).alias("posts"))
    joined = complete
    for part in (words, groups, posts):
        joined = joined.join(part, "cluster", "left")

    def listed(items: str, *fields: str) -> Column:
        kept = F.transform(items, lambda item: F.struct(*[item[name].alias(name) for name in fields]))
        return F.coalesce(kept, F.array())

    return joined.select(
        F.col("cluster").alias("cluster_id"), "size", F.col("silhouette").alias("mean_cosine_silhouette"),
        listed("words", "word", "count").alias("top_keywords"),
        F.map_from_entries(listed("groups", "name", "count")).alias("subreddit_distribution"),
        listed("posts", "reddit_id", "subreddit", "title", "selftext").alias("representative_posts"),
    )


def other_groups(distribution: DataFrame, most_groups: int = MOST_GROUPS) -> DataFrame:
    """``cluster, subreddit, count`` of the groups that :func:`cluster_summaries` has no room for."""
    return split_groups(distribution, most_groups)[1].select("cluster", "subreddit", "count")


def summary_list(summaries: DataFrame) -> DataFrame:
    """All cluster records in one row, by cluster."""
    record = F.struct(*summaries.columns)
    return summaries.agg(F.array_sort(F.collect_list(record), lambda a, b: a["cluster_id"] - b["cluster_id"]).alias("cluster_summaries"))
