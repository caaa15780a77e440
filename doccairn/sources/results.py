"""Result documents of configuration runs: schema, JSON readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from doccairn.storage import exists

# The layout of a result document as it is written and read.
CONFIG_TYPE = (
    "struct<name:string,vector_size:int,min_count:int,epochs:int,dm:int,"
    "n_bins:int,w2v_vector_size:int,w2v_min_count:int>"
)
METRICS_TYPE = (
    "struct<cosine_silhouette:double,per_cluster_silhouette:map<string,double>,"
    "davies_bouldin:double,calinski_harabasz:double,cluster_size_std:double,"
    "cluster_sizes:map<string,bigint>>"
)
SEARCH_TYPE = "struct<k_values:array<int>,inertias:array<double>,silhouettes:array<double>>"
SUMMARY_TYPE = (
    "struct<cluster_id:int,size:bigint,mean_cosine_silhouette:double,"
    "top_keywords:array<struct<word:string,count:bigint>>,"
    "subreddit_distribution:map<string,bigint>,"
    "representative_posts:array<struct<reddit_id:string,subreddit:string,title:string,selftext:string>>>"
)
RESULT_SCHEMA = (
    f"config {CONFIG_TYPE}, k int, metrics {METRICS_TYPE}, k_search {SEARCH_TYPE}, "
    f"cluster_summaries array<{SUMMARY_TYPE}>"
)
COMBINED_MARK = "all_configs"
# Where a folder lists what belongs to its latest sweep.
MANIFESTS = "_manifests"
RESULT_COLUMNS = ("config", "k", "metrics", "k_search", "cluster_summaries")


def config_struct(config: dict) -> Column:
    """A configuration as the struct of all known fields."""
    names = ("name", "vector_size", "min_count", "epochs", "dm", "n_bins", "w2v_vector_size", "w2v_min_count")
    return F.struct(*[F.lit(config.get(name)).alias(name) for name in names]).cast(CONFIG_TYPE)


def valid_results(documents: DataFrame) -> DataFrame:
    """Only documents with both a configuration and metrics are results."""
    return documents.where(F.col("config").isNotNull() & F.col("metrics").isNotNull())


def entry_path(folder: str, entry: str) -> str:
    """Where the documents of one entry of a manifest are."""
    return f"{folder}/entry={entry}"


def is_finished(spark: SparkSession, folder: str, entry: str) -> bool:
    """Whether the entry's documents were written to the end."""
    return exists(spark, f"{entry_path(folder, entry)}/_SUCCESS")


def write_manifest(spark: SparkSession, folder: str, entries: list[str]) -> None:
    """Make ``entries`` the ones that readers of ``folder`` see, in a version of its own.

    A version counts from when it is complete, so readers see the sweep before or this one.
    """
    version = max([number for number, _ in manifests(spark, folder)], default=0) + 1
    rows = spark.createDataFrame([(entry,) for entry in dict.fromkeys(entries)], "value string")
    rows.coalesce(1).write.text(f"{folder}/{MANIFESTS}/version={version}")


def manifests(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Version numbers and paths of the complete manifests."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MANIFESTS}/version=*/_SUCCESS")
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or []
    paths = [status.getPath().getParent().toString() for status in found]
    return sorted((int(path.rpartition("=")[2]), path) for path in paths)


def listed_entries(spark: SparkSession, folder: str) -> list[str] | None:
    """Entries of the newest manifest, null for a folder without one."""
    found = manifests(spark, folder)
    return [row["value"] for row in spark.read.text(found[-1][1]).collect()] if found else None


def read_results(spark: SparkSession, folder: str, method: str) -> DataFrame:
    """Result documents under ``folder``, tagged with ``method`` and their ``path``.

    In a folder with a manifest these are the documents of its entries, and no others that may
    still lie there. Combined results are skipped by the name of their file or its folder.
    """
    entries = listed_entries(spark, folder)
    paths = folder if entries is None else [entry_path(folder, entry) for entry in entries]
    documents = (
        spark.read.schema(RESULT_SCHEMA)
        .options(multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.json")
        .json(paths)
        .select("*", F.col("_metadata.file_path").alias("path"))
    )
    combined = F.substring_index("path", "/", -2).contains(COMBINED_MARK)
    return valid_results(documents.where(~combined)).withColumn("method", F.lit(method))


def write_result(result: DataFrame, folder: str, whole: bool = False) -> None:
    """One file per result, in folders by configuration name and number among equal names.

    A reader takes one document from a file, so no two results may share one. The few
    results of a sweep are numbered in order of their content. Results of other names stay,
    unless the ``whole`` folder is replaced, which also marks it when it is complete.
    """
    alike = Window.partitionBy("config.name").orderBy(F.to_json(F.struct(*RESULT_COLUMNS)))
    named = result.select(*RESULT_COLUMNS, F.col("config.name").alias("config_name"), F.row_number().over(alike).alias("run"))
    named.write.mode("overwrite").option("ignoreNullFields", False).option(
        "partitionOverwriteMode", "static" if whole else "dynamic"
    ).partitionBy("config_name", "run").json(folder)


def write_entry(result: DataFrame, folder: str, entry: str) -> None:
    """The results of one entry; its folder is complete or counts as absent."""
    write_result(result, entry_path(folder, entry), whole=True)


def combine_results(results: DataFrame, best: DataFrame) -> DataFrame:
    """All results in one document with the name of the recommended configuration.

    ``best`` has at most one row; without one the recommendation is null.
    """
    name = best.agg(F.first("config.name").alias("name")).select("name").scalar()
    return results.agg(
        F.collect_list(F.struct(*RESULT_COLUMNS)).alias("results")
    ).select(name.alias("recommended_configuration"), "results")


def write_text(lines: DataFrame, folder: str) -> None:
    """A report of few lines as one text file."""
    lines.coalesce(1).write.mode("overwrite").text(folder)
