"""One configuration from document vectors to its result document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from doccairn.functions.labels import PARAGRAPH_METHOD, WORD_BIN_METHOD, config_tag
from doccairn.functions.vectors import l2_normalize
from doccairn.operators import charts, clustering, describe, quality, word_bins
from doccairn.operators.embedding import Training, train
from doccairn.plans.corpus import Corpus
from doccairn.sources.results import METRICS_TYPE, SEARCH_TYPE, config_struct
from doccairn.storage import discard, settle


@dataclass(frozen=True)
class Choice:
    """How a run picks its clusters: a given ``k``, or the best of a range."""

    k: int | None = None
    k_min: int = clustering.K_MIN
    k_max: int = clustering.K_MAX
    restarts: int = clustering.RESTARTS


@dataclass(frozen=True)
class Run:
    """A finished run: its result row and the tables its charts need."""

    result: DataFrame
    k: int
    labelled: DataFrame
    stats: DataFrame
    keywords: DataFrame
    search: DataFrame | None
    #: ``cluster, subreddit, count`` of the groups that the summaries have no room for.
    other_groups: DataFrame

    def charts(self) -> dict[str, DataFrame]:
        complete = quality.complete_range(self.stats, self.k)
        points, _ = charts.cluster_map(self.labelled, charts.legends(self.keywords, complete))
        tag = self.result.select(config_tag(F.col("method"), F.col("config"))).scalar()
        drawn = {
            "cluster_map": charts.titled(points, "2-D PCA Projection", tag),
            "cluster_sizes": charts.titled(
                charts.cluster_size_series(complete.select("cluster", "size"), self.keywords), "Cluster Sizes", tag),
            "silhouettes": charts.titled(charts.silhouette_series(complete), "Per-Cluster Silhouette", tag),
        }
        if self.search is not None:
            drawn["elbow"] = charts.elbow_series(self.search, self.k)
        return drawn


def search_record(search: DataFrame | None) -> Column:
    """The search table as one struct; null arrays if k was given."""
    if search is None:
        return F.struct(*[F.lit(None).alias(n) for n in ("k_values", "inertias", "silhouettes")]).cast(SEARCH_TYPE)
    rows = F.array_sort(F.collect_list(F.struct("k", "inertia", "silhouette")))
    record = F.struct(
        rows["k"].alias("k_values"), rows["inertia"].alias("inertias"), rows["silhouette"].alias("silhouettes")
    )
    return search.agg(record.cast(SEARCH_TYPE).alias("k_search")).scalar()


def cluster_and_describe(
    posts: DataFrame, vectors: DataFrame, method: str, config: dict, choice: Choice = Choice(),
    stop: list[str] | DataFrame | None = None,
) -> Run:
    """Normalize, cluster, measure and describe ``id, vector`` rows."""
    passing: list[str] = []
    unit = settle(l2_normalize(vectors.select("id", "vector")), "unit-vectors", passing)
    features = clustering.with_features(unit).persist()
    if choice.k is None:
        found = clustering.search_k(features, choice.k_min, choice.k_max, choice.restarts)
        k, model, search = found.best_k, found.model, found.table
    else:
        k, search = choice.k, None
        model = clustering.fit_kmeans(features, k, choice.restarts)
    labelled = settle(clustering.assign_clusters(features, model), "labelled")
    features.unpersist()
    discard(unit.sparkSession, passing)

    scored = quality.score_rows(labelled)
    stats = settle(quality.cluster_stats(scored), "cluster-stats")
    labels = labelled.select("id", "cluster")
    keywords = settle(describe.top_keywords(
        posts.select("id", "cleaned_title", "cleaned_selftext").join(labels, "id"), stop=stop
    ), "keywords")
    groups = settle(describe.group_distribution(posts.select("id", "subreddit").join(labels, "id")), "groups")
    summaries = describe.cluster_summaries(
        quality.complete_range(stats, k), keywords,
        groups,
        describe.representative_posts(describe.nearest_to_centroid(scored), posts),
    )
    measures = quality.quality(stats, k)
    names = [name for name in measures.columns if name != "inertia"]
    result = settle(measures.select(
        F.lit(method).alias("method"), config_struct(config).alias("config"), F.lit(k).alias("k"),
        F.struct(*names).cast(METRICS_TYPE).alias("metrics"), search_record(search).alias("k_search"),
        describe.summary_list(summaries).scalar().alias("cluster_summaries"),
    ), "result")
    return Run(result, k, labelled, stats, keywords, search, describe.other_groups(groups))


def run_paragraph_vectors(
    corpus: Corpus, config: dict, choice: Choice = Choice(), stop: list[str] | DataFrame | None = None,
    **training: object,
) -> Run:
    """Paragraph vectors of one configuration, clustered and described."""
    plan = Training(
        mode="dm" if config.get("dm", 1) == 1 else "dbow", vector_size=config["vector_size"],
        min_count=config["min_count"], epochs=config["epochs"], **training,
    )
    vectors = train(corpus.tokenized, plan).vectors
    return cluster_and_describe(corpus.posts, vectors, PARAGRAPH_METHOD, config, choice, stop)


def bin_words(word_vectors: DataFrame, n_bins: int, restarts: int = clustering.RESTARTS) -> DataFrame:
    """Cluster ``word, vector`` rows into ``word, bin``."""
    features = clustering.with_features(l2_normalize(word_vectors)).persist()
    model = clustering.fit_kmeans(features, n_bins, restarts)
    binned = settle(clustering.placed(features, model).select("word", F.col("cluster").alias("bin")), "word-bins")
    features.unpersist()
    return binned


def run_word_bins(
    corpus: Corpus, word_vectors: DataFrame, config: dict, choice: Choice = Choice(),
    stop: list[str] | DataFrame | None = None,
) -> Run:
    """Word-bin vectors of one configuration; ``word_vectors`` is shared by all of them."""
    bins = bin_words(word_vectors, config["n_bins"], choice.restarts)
    vectors = word_bins.word_bin_vectors(corpus.tokenized, bins, config["n_bins"], keep_zero=False)
    return cluster_and_describe(corpus.posts, vectors, WORD_BIN_METHOD, config, choice, stop)
