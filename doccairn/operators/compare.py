"""Comparison of result documents across configurations and methods.

Inputs hold one row per run: ``method``, ``path`` and the result document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from doccairn.functions.labels import METRICS, PARAGRAPH_METHOD, fixed_text, method_name, method_order, shown


def field(path: str, default: Column | None = None) -> Column:
    """Nested field, or ``default`` where any step of the path is missing."""
    return F.col(path) if default is None else F.coalesce(F.col(path), default)


def flatten_results(results: DataFrame) -> DataFrame:
    """The comparison row of every result document."""
    config, metrics = F.col("config"), F.col("metrics")
    paragraph = F.col("method") == PARAGRAPH_METHOD
    clusters = F.size(metrics["cluster_sizes"])
    variant = F.when(field("config.dm", F.lit(1)) == 1, "PV-DM").otherwise("PV-DBOW")
    word_variant = F.concat(F.lit("W2V dim="), shown(config["w2v_vector_size"]))
    paragraph_info = F.format_string(
        "dim=%s, min_count=%s, epochs=%s, dm=%s", shown(config["vector_size"]),
        shown(config["min_count"]), shown(config["epochs"]), shown(config["dm"]),
    )
    word_info = F.format_string(
        "bins=%s, w2v_dim=%s, w2v_min_count=%s", shown(config["n_bins"]),
        shown(config["w2v_vector_size"]), shown(config["w2v_min_count"]),
    )
    return results.select(
        F.col("method").alias("method_key"),
        method_name(F.col("method")).alias("method"),
        field("config.name", F.lit("unknown")).alias("config_name"),
        "k",
        *[F.nanvl(metrics[name], F.lit(None)).alias(name) for name in METRICS],
        F.when(clusters > 0, clusters).alias("n_clusters"),
        F.col("path").alias("json_path"),
        F.when(paragraph, config["vector_size"]).otherwise(config["n_bins"]).alias("representation_dim"),
        F.when(paragraph, config["min_count"]).otherwise(config["w2v_min_count"]).alias("min_count"),
        F.when(paragraph, config["epochs"]).alias("epochs"),
        F.when(paragraph, variant).otherwise(word_variant).alias("variant"),
        F.when(paragraph, paragraph_info).otherwise(word_info).alias("extra_info"),
    )


def union_results(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right, allowMissingColumns=True)


def ordered(flat: DataFrame) -> DataFrame:
    """Add ``position``: method first, then configuration name. One row per run, so few rows."""
    order = Window.orderBy(method_order(F.col("method_key")), "config_name", "json_path")
    return flat.withColumn("position", F.row_number().over(order))


def best_per_method(flat: DataFrame) -> DataFrame:
    """Best run of each method by the four metrics in turn; missing values come last."""
    best = Window.partitionBy("method_key").orderBy(
        F.desc_nulls_last("cosine_silhouette"), F.asc_nulls_last("davies_bouldin"),
        F.desc_nulls_last("calinski_harabasz"), F.asc_nulls_last("cluster_size_std"), "config_name",
    )
    return flat.withColumn("__rank", F.row_number().over(best)).where("__rank = 1").drop("__rank")


def best_by_silhouette(results: DataFrame) -> DataFrame:
    """Result with the highest silhouette of each method; the first path wins a tie."""
    silhouette = F.nanvl(F.col("metrics.cosine_silhouette"), F.lit(None))
    best = Window.partitionBy("method").orderBy(silhouette.desc(), F.asc("path"))
    scored = results.where(silhouette.isNotNull())
    return scored.withColumn("__rank", F.row_number().over(best)).where("__rank = 1").drop("__rank")


def method_averages(flat: DataFrame) -> DataFrame:
    return flat.groupBy("method_key", "method").agg(*[F.avg(name).alias(name) for name in METRICS])


def theme_lists(
    best: DataFrame, clusters: int = 5, keywords: int = 8, groups: int = 5, posts: int = 3
) -> DataFrame:
    """The largest clusters of each result with the head of every list."""
    by_size = F.array_sort(F.transform(
        "cluster_summaries", lambda c, i: F.struct((-c["size"]).alias("order"), (i + 1).alias("at"))
    ))

    def heads(entry: Column) -> Column:
        cluster = F.element_at("cluster_summaries", entry["at"])
        ranked = F.array_sort(F.transform(
            F.map_entries(cluster["subreddit_distribution"]),
            lambda e: F.struct((-e["value"]).alias("order"), e["key"].alias("name"), e["value"].alias("count")),
        ))
        return F.struct(
            cluster["cluster_id"].alias("cluster"), cluster["size"].alias("size"),
            cluster["mean_cosine_silhouette"].alias("silhouette"),
            F.slice(cluster["top_keywords"], 1, keywords).alias("keywords"),
            F.slice(ranked, 1, groups).alias("groups"),
            F.slice(cluster["representative_posts"], 1, posts).alias("posts"),
        )

    return best.select(
        "method", F.col("config.name").alias("config_name"), "k",
        F.transform(F.slice(by_size, 1, clusters), heads).alias("themes"),
    )


def theme_rows(themes: DataFrame) -> DataFrame:
    """Long form: one row per listed keyword, group or post."""
    one = themes.select("method", "config_name", "k", F.posexplode("themes").alias("at", "theme"))
    listed = F.array(
        F.struct(F.lit("keyword").alias("kind"), F.transform("theme.keywords", lambda w: F.format_string(
            "%s(%d)", w["word"], w["count"])).alias("texts")),
        F.struct(F.lit("group").alias("kind"), F.transform("theme.groups", lambda g: F.format_string(
            "%s:%d", g["name"], g["count"])).alias("texts")),
        F.struct(F.lit("post").alias("kind"), F.transform("theme.posts", lambda p: F.format_string(
            "[r/%s] %s", F.coalesce(p["subreddit"], F.lit("")), F.coalesce(p["title"], F.lit("")))).alias("texts")),
    )
    kinds = one.select(
        "method", "config_name", "k", F.col("theme.cluster").alias("cluster"), F.col("theme.size").alias("size"),
        F.explode(listed).alias("listed"),
    )
    return kinds.select(
        "method", "config_name", "k", "cluster", "size", F.col("listed.kind").alias("kind"),
        F.posexplode("listed.texts").alias("at", "text"),
    ).withColumn("rank", F.col("at") + 1).drop("at")


def theme_text(themes: DataFrame) -> DataFrame:
    """One readable ``text`` per method."""
    def block(theme: Column) -> Column:
        def joined(items: str, form) -> Column:
            return F.array_join(F.transform(theme[items], form), ", ")

        silhouette = F.when(theme["silhouette"].isNull(), "n/a").otherwise(
            fixed_text(theme["silhouette"], 4)
        )
        posts = F.transform(theme["posts"], lambda p, i: F.format_string(
            "    %d. [r/%s] %s", i + 1, F.coalesce(p["subreddit"], F.lit("")), F.coalesce(p["title"], F.lit(""))
        ))
        head = F.array(
            F.format_string("Cluster %d | size=%d | mean silhouette=%s", theme["cluster"], theme["size"], silhouette),
            F.concat(F.lit("  Keywords: "), joined("keywords", lambda w: F.format_string("%s(%d)", w["word"], w["count"]))),
            F.concat(F.lit("  Top subreddits: "), joined("groups", lambda g: F.format_string("%s:%d", g["name"], g["count"]))),
            F.lit("  Representative posts:"),
        )
        return F.array_join(F.concat(head, posts, F.array(F.lit(""))), "\n")

    title = F.array(
        F.concat(method_name(F.col("method")), F.lit(" qualitative cluster summary")),
        F.concat(F.lit("Best config: "), shown(F.col("config_name")), F.lit(" | k="), shown(F.col("k"))),
        F.lit("-" * 60),
    )
    return themes.select("method", F.array_join(F.concat(title, F.transform("themes", block)), "\n").alias("text"))


def theme_report(texts: DataFrame, methods: tuple[str, ...]) -> DataFrame:
    """The texts of ``methods`` in order in one row, parted by a ruled line."""
    wanted = F.array(*[F.lit(m) for m in methods])
    found = texts.where(F.col("method").isin(*methods)).agg(
        F.map_from_entries(F.collect_list(F.struct("method", "text"))).alias("texts")
    )
    parts = F.transform(wanted, lambda m: F.coalesce(F.try_element_at("texts", m), F.lit("No best item found.")))
    return found.select(F.array_join(parts, "\n\n" + "=" * 72 + "\n\n").alias("value"))
