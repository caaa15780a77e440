import numpy as np
import pytest
from pyspark.sql import functions as F

from doccairn.functions.vectors import l2_normalize
from doccairn.operators import charts, clustering, describe, quality


def frame(spark, values, labels):
    rows = [(i, [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(values, labels))]
    return spark.createDataFrame(rows, "id bigint, vector array<double>, cluster int")


def sample(n=60, d=6, k=4, seed=3):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, d))
    labels = rng.integers(0, k, n)
    labels[0], labels[labels == k - 1] = k - 1, 0
    labels[0] = k - 1
    return values / np.linalg.norm(values, axis=1, keepdims=True), labels


def silhouettes(x, labels):
    distance = 1 - x @ x.T
    out = []
    for i, own in enumerate(labels):
        same = (labels == own) & (np.arange(len(x)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a = distance[i, same].mean()
        b = min(distance[i, labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return np.array(out)


def test_measures_equal_their_definitions(spark):
    x, labels = sample()
    scored = quality.score_rows(frame(spark, x, labels))
    expected = silhouettes(x, labels)
    got = np.array([r[0] for r in scored.orderBy("id").select("silhouette").collect()])
    assert np.allclose(got, expected, atol=1e-9) and got[0] == 0.0
    record = quality.quality(quality.cluster_stats(scored), 5).first()
    centres = {c: x[labels == c].mean(axis=0) for c in set(labels)}
    within = sum(((x[labels == c] - m) ** 2).sum() for c, m in centres.items())
    spread = {c: np.linalg.norm(x[labels == c] - m, axis=1).mean() for c, m in centres.items()}
    bouldin = np.mean([max((spread[a] + spread[b]) / np.linalg.norm(centres[a] - centres[b]) for b in centres if b != a) for a in centres])
    between = sum((labels == c).sum() * ((m - x.mean(axis=0)) ** 2).sum() for c, m in centres.items())
    k, n = len(centres), len(x)
    assert record["inertia"] == pytest.approx(within)
    assert record["davies_bouldin"] == pytest.approx(bouldin)
    assert record["calinski_harabasz"] == pytest.approx((between / (k - 1)) / (within / (n - k)))
    assert record["cosine_silhouette"] == pytest.approx(expected.mean())
    sizes = [int((labels == c).sum()) for c in range(5)]
    assert record["cluster_sizes"] == {str(c): s for c, s in enumerate(sizes)}
    assert record["cluster_size_std"] == pytest.approx(np.std(sizes))
    assert record["per_cluster_silhouette"]["4"] == 0.0
    weighted = sum(record["per_cluster_silhouette"][str(c)] * s for c, s in enumerate(sizes)) / n
    assert weighted == pytest.approx(record["cosine_silhouette"])


def test_one_cluster_has_no_measures(spark):
    x, _ = sample(10)
    record = quality.quality(quality.cluster_stats(quality.score_rows(frame(spark, x, [0] * 10))), 1).first()
    assert record["cosine_silhouette"] is None and record["davies_bouldin"] is None
    assert record["calinski_harabasz"] is None and record["cluster_sizes"] == {"0": 10}


def test_coinciding_centroids_and_no_spread(spark):
    x = np.array([[1.0, 0.0]] * 4)
    record = quality.quality(quality.cluster_stats(quality.score_rows(frame(spark, x, [0, 0, 1, 1]))), 2).first()
    assert record["davies_bouldin"] == 0.0 and record["calinski_harabasz"] == 1.0


def test_many_centroids_take_several_passes(spark, monkeypatch):
    x, labels = sample(80, 5, 12)
    vectors = frame(spark, x, labels)
    once = quality.score_rows(vectors).orderBy("id").collect()
    nearest = quality.assign_nearest(vectors, quality.centroids(vectors)).orderBy("id").collect()
    passes = quality.Centroids.passes
    monkeypatch.setattr(quality.Centroids, "passes", staticmethod(lambda table: passes(table, 4)))
    assert np.allclose([r["silhouette"] for r in quality.score_rows(vectors).orderBy("id").collect()], [r["silhouette"] for r in once])
    again = quality.assign_nearest(vectors, quality.centroids(vectors)).orderBy("id").collect()
    assert [r["cluster"] for r in again] == [r["cluster"] for r in nearest]


def test_normalize_keeps_zero_rows(spark):
    rows = l2_normalize(frame(spark, [[3, 4], [0, 0]], [0, 0])).orderBy("id").collect()
    assert rows[0]["vector"] == pytest.approx([0.6, 0.8]) and rows[1]["vector"] == [0.0, 0.0]


def test_principal_components_equal_svd(spark):
    x, labels = sample(50, 6)
    placed, shares = charts.principal_components(frame(spark, x, labels))
    got = np.array([(r["pc1"], r["pc2"]) for r in placed.orderBy("id").collect()])
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    axes = vt[:2] * np.sign(vt[np.arange(2), np.abs(vt[:2]).argmax(axis=1)])[:, None]
    assert np.allclose(got, centred @ axes.T, atol=1e-9)
    assert np.allclose(shares, (s**2 / (s**2).sum())[:2])


def blobs(seed=5):
    rng = np.random.default_rng(seed)
    centres = np.eye(6)[:3]
    x = np.vstack([c + rng.normal(scale=0.05, size=(n, 6)) for c, n in zip(centres, (10, 30, 20))])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_search_finds_separate_clusters(spark):
    x = blobs()
    features = clustering.with_features(frame(spark, x, [0] * len(x))).persist()
    found = clustering.search_k(features, 2, 5, restarts=2)
    assert found.best_k == 3
    labelled = clustering.assign_clusters(features, found.model)
    sizes = [r["size"] for r in labelled.groupBy("cluster").agg(F.count("*").alias("size")).orderBy("cluster").collect()]
    assert sizes == [30, 20, 10]
    rows = {r["k"]: r for r in found.table.collect()}
    scored = quality.score_rows(labelled)
    record = quality.quality(quality.cluster_stats(scored), 3).first()
    assert rows[3]["silhouette"] == pytest.approx(record["cosine_silhouette"])
    assert rows[3]["inertia"] == pytest.approx(record["inertia"])
    assert rows[2]["inertia"] > rows[3]["inertia"]
    labels = np.array([r["cluster"] for r in labelled.orderBy("id").collect()])
    assert silhouettes(x, labels).mean() == pytest.approx(record["cosine_silhouette"])


def test_choice_of_k_prefers_the_first_and_skips_nulls(spark):
    rows = [(2, 9.0, None), (3, 8.0, 0.5), (4, 7.0, 0.5), (5, 6.0, float("nan"))]
    table = spark.createDataFrame(rows, "k int, inertia double, silhouette double")
    assert clustering.select_best_k(table) == 3
    assert clustering.select_best_k(table.where("k = 2"), 2) == 2
    series = {r["k"]: (r["silhouette"], r["is_best"]) for r in charts.elbow_series(table, 3).collect()}
    assert series == {2: (0.0, False), 3: (0.5, True), 4: (0.5, False), 5: (0.0, False)}


def test_many_clusters_are_compared_in_blocks(spark):
    """50,000 clusters: equal to the definitions, and no row holds their centroids."""
    rng = np.random.default_rng(8)
    k, d = 50_000, 4
    centres, sizes, spreads = rng.normal(size=(k, d)), rng.integers(1, 9, k), rng.random(k) / 50
    centres[1] = centres[0]
    schema = "cluster int, size long, silhouette double, silhouette_sum double, spread double, within double, centroid array<double>"
    rows = [(i, int(n), 0.5, 0.5 * int(n), float(s), float(n * s * s), c.tolist()) for i, (n, s, c) in enumerate(zip(sizes, spreads, centres))]
    stats = spark.createDataFrame(rows, schema).repartition(8)
    worst = []
    for begin in range(0, k, 1000):
        part = slice(begin, begin + 1000)
        squared = np.square(centres[part]).sum(axis=1)[:, None] + np.square(centres).sum(axis=1) - 2 * centres[part] @ centres.T
        apart = np.sqrt(np.where(squared > 1e-12, squared, 0))
        ratio = np.divide(spreads[part][:, None] + spreads, apart, out=np.zeros_like(apart), where=apart > 0)
        worst.append(ratio.max(axis=1))
    middle = (centres * sizes[:, None]).sum(axis=0) / sizes.sum()
    between = (sizes * np.square(centres - middle).sum(axis=1)).sum()
    within = (sizes * spreads**2).sum()
    bouldin, calinski = quality.blocked_measures(stats, 8192)
    assert bouldin == pytest.approx(np.concatenate(worst).mean(), rel=1e-6)
    assert calinski == pytest.approx((between / (k - 1)) / (within / (sizes.sum() - k)), rel=1e-9)


def test_blocked_measures_equal_those_in_a_row(spark):
    x, labels = sample(200, 6, 12)
    stats = quality.cluster_stats(quality.score_rows(frame(spark, x, labels)))
    row, blocked = quality.quality(stats, 14).first(), quality.quality(stats, 14, in_a_row=3).first()
    for name in row.asDict():
        assert blocked[name] == (pytest.approx(row[name]) if isinstance(row[name], float) else row[name])
    one = quality.cluster_stats(quality.score_rows(frame(spark, x, [0] * len(x))))
    assert quality.quality(one, 1, in_a_row=0).first()["davies_bouldin"] is None


def test_summaries_of_a_cluster_with_a_million_groups(spark):
    """What the record has no room for is in the table beside it; together they are all groups."""
    names = 1_000_000
    groups = spark.range(names).select(F.lit(0).alias("cluster"), F.concat(F.lit("g"), "id").alias("subreddit"), (1 + F.col("id") % 1000).alias("count"))
    groups = groups.unionByName(spark.createDataFrame([(1, "a", 2), (1, "b", 5)], groups.schema))
    complete = spark.createDataFrame([(0, 10, 0.1), (1, 7, None), (2, 0, 0.0)], "cluster int, size long, silhouette double")
    words = spark.createDataFrame([(0, 1, "w", 3)], "cluster int, rank int, word string, count long")
    posts = spark.createDataFrame([(0, 1, "r", "s", "t", "u")], "cluster int, rank int, reddit_id string, subreddit string, title string, selftext string")
    found = {r["cluster_id"]: r for r in describe.cluster_summaries(complete, words, groups, posts, 100).collect()}
    assert {c: len(r["subreddit_distribution"]) for c, r in found.items()} == {0: 100, 1: 2, 2: 0}
    assert set(found[0]["subreddit_distribution"].values()) == {1000} and found[1]["subreddit_distribution"] == {"a": 2, "b": 5}
    others = describe.other_groups(groups, 100)
    assert others.count() == names - 100 and others.where("cluster <> 0").count() == 0
    total = others.agg(F.sum("count")).first()[0] + sum(found[0]["subreddit_distribution"].values())
    assert total == groups.where("cluster = 0").agg(F.sum("count")).first()[0]
