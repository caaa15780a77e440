import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from doccairn.operators import compare, embedding
from doccairn.operators.embedding import Training
from doccairn.plans import comparison, runs, sweeps
from doccairn.plans.corpus import prepare
from doccairn.plans.runs import Choice
from doccairn.sources import results
from doccairn.sources.posts import clean_posts
from tests.test_text import COLUMNS


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(40):
        words = [f"{['alpha', 'beta'][i % 2]}{'abcdefgh'[w]}" for w in rng.integers(0, 8, 25)]
        group = None if i == 5 else f"g{i % 3}"
        rows.append((str(i), f"r{i}", group, f"title {i}", " ".join(words), None, f"Title {i}", " ".join(words)))
    rows.append(("40", "r40", "g0", "", " . ", None, "", ""))
    return prepare(clean_posts(spark.createDataFrame(rows, COLUMNS)))


def check_result(row, documents):
    metrics, k = row["metrics"], row["k"]
    sizes = metrics["cluster_sizes"]
    assert sum(sizes.values()) == documents and set(sizes) == {str(c) for c in range(k)}
    assert metrics["cluster_size_std"] == pytest.approx(np.std(list(sizes.values())))
    weighted = sum(metrics["per_cluster_silhouette"][c] * n for c, n in sizes.items()) / documents
    assert weighted == pytest.approx(metrics["cosine_silhouette"])
    if row["k_search"]["k_values"]:
        at = row["k_search"]["k_values"].index(k)
        assert row["k_search"]["silhouettes"][at] == pytest.approx(metrics["cosine_silhouette"])
        assert max(row["k_search"]["silhouettes"]) == row["k_search"]["silhouettes"][at]
    assert [s["cluster_id"] for s in row["cluster_summaries"]] == list(range(k))
    for summary in row["cluster_summaries"]:
        counts = [w["count"] for w in summary["top_keywords"]]
        assert counts == sorted(counts, reverse=True) and len(counts) <= 20
        assert summary["size"] == sizes[str(summary["cluster_id"])]
        assert sum(summary["subreddit_distribution"].values()) <= summary["size"]
        assert len(summary["representative_posts"]) == min(10, summary["size"])


@pytest.fixture(scope="module")
def both_sweeps(spark, corpus):
    configs = tuple({"name": n, "vector_size": 6, "min_count": 1, "epochs": 3, "dm": dm} for n, dm in (("small", 1), ("large", 0)))
    bins = tuple({"name": n, "n_bins": b, "w2v_vector_size": 6, "w2v_min_count": 2} for n, b in (("small", 4), ("large", 6)))
    search = Choice(k_min=2, k_max=3, restarts=1)
    return (
        sweeps.sweep_paragraph_vectors(corpus, configs, search, rate=0.1),
        sweeps.sweep_word_bins(corpus, bins, Choice(k=2, restarts=1), epochs=3),
    )


def test_results_hold_their_invariants(both_sweeps):
    for sweep in both_sweeps:
        for row in sweep.results.collect():
            check_result(row, 40)
    assert both_sweeps[1].results.first()["k_search"]["k_values"] is None


def test_charts_cover_every_cluster(both_sweeps):
    run = both_sweeps[0].runs[0]
    drawn = run.charts()
    assert drawn["cluster_map"].count() == 40
    assert drawn["cluster_sizes"].count() == run.k == drawn["silhouettes"].count()
    assert drawn["elbow"].where("is_best").count() == 1


def test_sweeps_are_written_read_and_compared(spark, both_sweeps, tmp_path):
    folders = [str(tmp_path / name) for name in ("paragraph", "bins")]
    for sweep, folder in zip(both_sweeps, folders):
        sweeps.write_sweep(sweep, folder)
    combined = json.loads(next((tmp_path / "bins" / "all_configs").glob("*.json")).read_text())
    assert combined["recommended_configuration"] == both_sweeps[1].best.first()["config"]["name"]
    assert [r["config"]["name"] for r in combined["results"]] == ["small", "large"]
    compared = comparison.compare_folders(spark, *folders)
    rows = compared.table.orderBy("position").collect()
    assert [(r["method_key"], r["config_name"]) for r in rows] == [
        ("doc2vec", "large"), ("doc2vec", "small"), ("word2vec_bow", "large"), ("word2vec_bow", "small")]
    assert {r["variant"] for r in rows} == {"PV-DM", "PV-DBOW", "W2V dim=6"}
    assert compared.best.count() == 2 and compared.bars.count() == 16 and compared.averages.count() == 8
    read = results.read_results(spark, folders[0], "doc2vec").orderBy("config.name").collect()
    kept = both_sweeps[0].results.orderBy("config.name").collect()
    assert [r["cluster_summaries"] for r in read] == [r["cluster_summaries"] for r in kept]
    comparison.write_report(compared, str(tmp_path / "report"))
    text = next((tmp_path / "report").glob("*.txt")).read_text()
    assert text.startswith("Doc2Vec qualitative cluster summary\nBest config: ")
    assert "\n\n" + "=" * 72 + "\n\nWord2Vec BoW qualitative cluster summary\n" in text


def test_a_smaller_sweep_hides_the_one_before(spark, both_sweeps, tmp_path):
    folder, sweep = str(tmp_path), both_sweeps[0]
    sweeps.write_sweep(sweep, folder)
    assert results.read_results(spark, folder, "doc2vec").count() == 2
    only = sweeps.Sweep(sweep.runs[:1], sweep.results.where("config.name = 'small'"), sweep.best)
    sweeps.write_sweep(only, folder)
    assert [r["name"] for r in results.read_results(spark, folder, "doc2vec").select("config.name").collect()] == ["small"]
    # A version that was not finished does not count.
    (tmp_path / results.MANIFESTS / "version=9").mkdir()
    assert [number for number, _ in results.manifests(spark, folder)] == [1, 2]


def test_a_sweep_goes_on_where_it_broke_off(spark, corpus, tmp_path, monkeypatch):
    configs = tuple({"name": n, "n_bins": b, "w2v_vector_size": 6, "w2v_min_count": 2} for n, b in (("small", 4), ("large", 6)))
    folder, made, run = str(tmp_path), [], sweeps.run_word_bins
    choice = Choice(k=2, restarts=1)

    def breaking(corpus, words, config, *rest):
        if config["name"] == "large" and not made.count("large"):
            made.append("large")
            raise RuntimeError("lost")
        made.append(config["name"])
        return run(corpus, words, config, *rest)

    monkeypatch.setattr(sweeps, "run_word_bins", breaking)
    with pytest.raises(RuntimeError):
        sweeps.resume_word_bin_sweep(corpus, folder, configs, choice, epochs=1)
    assert results.listed_entries(spark, folder) is None
    found = sweeps.resume_word_bin_sweep(corpus, folder, configs, choice, epochs=1)
    assert made == ["small", "large", "large"] and found.count() == 2
    for row in found.collect():
        check_result(row, 40)
    again = sweeps.resume_word_bin_sweep(corpus, folder, configs[1:], choice, epochs=1)
    assert made == ["small", "large", "large"] and [r["config"]["name"] for r in again.collect()] == ["large"]
    combined = json.loads(next((tmp_path / "all_configs").glob("*.json")).read_text())
    assert combined["recommended_configuration"] == "large" and len(combined["results"]) == 1
    # Other settings or another corpus are other results.
    entries = {sweeps.entry_of("m", {"a": 1}, mark, choice) for mark in ("1:2", "1:3")}
    assert len(entries | {sweeps.entry_of("m", {"a": 1}, "1:2", Choice())}) == 3


def document(name, silhouette, sizes=None, **config):
    return {"config": {"name": name, **config}, "k": 2, "metrics": {"cosine_silhouette": silhouette, "cluster_sizes": sizes},
            "cluster_summaries": [
                {"cluster_id": 0, "size": 1, "mean_cosine_silhouette": None, "top_keywords": [{"word": "w", "count": 3}],
                 "subreddit_distribution": {"b": 1, "a": 1, "c": 9}, "representative_posts": [{"title": "T", "subreddit": "s"}]},
                {"cluster_id": 1, "size": 5, "mean_cosine_silhouette": 0.25, "top_keywords": [],
                 "subreddit_distribution": {}, "representative_posts": []}]}


def test_plain_files_of_another_tool_are_read(spark, tmp_path):
    """Indented files, missing fields, a combined file and a file without metrics."""
    files = {
        "a.json": document("one", 0.5, {"0": 1, "1": 5}, vector_size=50, min_count=2, epochs=3),
        "b.json": document("two", 0.5, {}, vector_size=50, dm=0), "c.json": document(None, None),
        "d.json": {"config": {"name": "x"}}, "method_all_configs.json": document("skip", 0.9),
    }
    for name, content in files.items():
        (tmp_path / name).write_text(json.dumps(content, indent=2))
    read = results.read_results(spark, str(tmp_path), "doc2vec")
    flat = {r["config_name"]: r for r in compare.flatten_results(read).collect()}
    assert set(flat) == {"one", "two", "unknown"}
    assert (flat["one"]["variant"], flat["two"]["variant"]) == ("PV-DM", "PV-DBOW")
    assert (flat["one"]["n_clusters"], flat["two"]["n_clusters"], flat["unknown"]["n_clusters"]) == (2, None, None)
    assert flat["two"]["extra_info"] == "dim=50, min_count=None, epochs=None, dm=0"
    best = compare.best_by_silhouette(read)
    assert best.first()["config"]["name"] == "one"
    text = compare.theme_text(compare.theme_lists(best)).first()["text"]
    assert text.split("\n") == [
        "Doc2Vec qualitative cluster summary", "Best config: one | k=2", "-" * 60,
        "Cluster 1 | size=5 | mean silhouette=0.2500", "  Keywords: ", "  Top subreddits: ", "  Representative posts:", "",
        "Cluster 0 | size=1 | mean silhouette=n/a", "  Keywords: w(3)", "  Top subreddits: c:9, a:1, b:1",
        "  Representative posts:", "    1. [r/s] T", ""]
    nothing = compare.theme_report(compare.theme_text(compare.theme_lists(best)), ("doc2vec", "word2vec_bow"))
    assert nothing.first()["value"].endswith("\n\nNo best item found.")


def test_no_best_result_leaves_the_recommendation_empty(spark, both_sweeps):
    every = both_sweeps[0].results
    combined = results.combine_results(every, every.where("false")).first()
    assert combined["recommended_configuration"] is None and len(combined["results"]) == 2


@pytest.mark.parametrize("cuts", [None, [3, 7]])
def test_posts_from_jdbc_plan_ranges(spark, cuts):
    """The reader's options without a database: a missing driver is all that may fail."""
    from doccairn.sources.posts import read_posts_jdbc
    with pytest.raises(Exception, match="(?i)driver"):
        read_posts_jdbc(spark, "jdbc:nosuchdb://host/db", cuts=cuts)


IDS = {
    "numbers with gaps": [*range(50), *range(10**9, 10**9 + 50), None, None, -5],
    "texts": [*map(str, range(60)), "x'y", "é", "", "A", "a", None],
    "one id": [7] * 40, "nothing": [], "only nulls": [None] * 5,
}


@pytest.mark.parametrize("kind", IDS)
def test_every_row_meets_one_predicate(spark, kind):
    """Ranges of the cuts that a SQL engine gives, in that engine and in Spark."""
    import duckdb

    from doccairn.sources.posts import cut_query, id_predicates
    text = kind == "texts"
    connection = duckdb.connect()
    connection.execute(f"CREATE TABLE posts (id {'VARCHAR' if text else 'BIGINT'}, n INTEGER)")
    for n, value in enumerate(IDS[kind]):
        connection.execute("INSERT INTO posts VALUES (?, ?)", [value, n])
    cuts = [cut for _, cut in sorted(connection.execute(cut_query("posts", 8)).fetchall())][1:]
    predicates = id_predicates(cuts)
    parts = [connection.execute(f"SELECT n FROM posts WHERE {p}").fetchall() for p in predicates]
    assert sorted(n for part in parts for (n,) in part) == list(range(len(IDS[kind])))
    rows = spark.createDataFrame([(v, n) for n, v in enumerate(IDS[kind])], f"id {'string' if text else 'long'}, n int")
    assert sorted(r["n"] for p in predicates for r in rows.where(p).collect()) == list(range(len(IDS[kind])))
    if kind == "numbers with gaps":
        assert len(predicates) == 9 and max(map(len, parts[:-1])) <= 14


def test_ids_that_are_no_numbers_become_null(spark):
    raw = spark.createDataFrame([("7",), ("x",), (None,)], "id string").select(F.col("id"), *[F.lit(None).cast("string").alias(n) for n in ("reddit_id", "subreddit", "cleaned_title", "cleaned_selftext", "keywords", "title", "selftext")])
    assert sorted(str(r["id"]) for r in clean_posts(raw).collect()) == ["7", "None", "None"]


def test_results_of_one_name_stay_apart(spark, both_sweeps, tmp_path):
    one = both_sweeps[0].results.limit(1)
    nameless = one.withColumn("config", F.col("config").withField("name", F.lit(None).cast("string")))
    results.write_result(one.unionByName(one).unionByName(one).unionByName(nameless).unionByName(nameless), str(tmp_path))
    results.combine_results(one, one).write.json(f"{tmp_path}/all_configs")
    names = [r["name"] for r in results.read_results(spark, str(tmp_path), "doc2vec").select("config.name").collect()]
    assert len(names) == 5 and names.count(None) == 2


def test_posts_without_an_id_or_with_a_repeated_one(spark):
    made = [(None if i % 7 == 0 else str(i // 2), f"word{i % 3} common text", "more common text") for i in range(40)]
    raw = spark.createDataFrame(made, "id string, title string, selftext string").select(
        "*", F.col("title").alias("cleaned_title"), F.col("selftext").alias("cleaned_selftext"),
        *[F.lit(None).cast("string").alias(n) for n in ("reddit_id", "subreddit", "keywords")])
    corpus = prepare(clean_posts(raw))
    assert corpus.tokenized.select("id").distinct().count() == 40
    assert corpus.posts.where("post_id is null").count() == 6
    trained = embedding.train(corpus.tokenized, Training(mode="dbow", vector_size=4, min_count=1, epochs=1))
    assert trained.vectors.select("id").distinct().count() == 40
    assert trained.vectors.join(corpus.posts, "id").count() == 40
