"""Words of documents: counted within their rows, shuffled once, stored for every clustering."""

from doccairn.catalog.word_bin_queries import DocumentVectors
from doccairn.operators import lookups, word_bins


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_clusterings_shuffle_nothing(spark, tmp_path):
    rows = [(i, f"title {i % 3}\nsame words here and {'x' * (i % 4)}", "en", f"src{i}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    vectors = DocumentVectors(spark, str(tmp_path))
    for bins in (5, 20):
        clustered = vectors.clustered(bins, 4)
        assert "Exchange" not in plan_of(clustered)
        assert {len(row["vector"]) for row in clustered.collect()} == {bins}
        assert clustered.count() == 40


def test_words_are_counted_without_a_shuffle(spark):
    rows = [(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["b"])]
    tokenized = spark.createDataFrame(rows, "id bigint, tokens array<string>")
    counted = word_bins.word_counts(tokenized)
    assert "Exchange" not in plan_of(counted)
    assert sorted(map(tuple, counted.collect()), key=str) == sorted([(1, "a", 2), (1, "b", 1), (2, None, 1), (3, None, 1), (4, "b", 1)], key=str)


def test_shared_and_missing_ids_are_put_together(spark):
    rows = [(1, ["a", "b", "a"]), (None, ["a"]), (1, ["c", "z", "a"]), (None, ["b", "c"]), (2, []), (2, ["z"]), (3, None)]
    tokenized = spark.createDataFrame(rows, "id bigint, tokens array<string>").repartition(3)
    lookup = [("a", 0, 5), ("b", 1, 3), ("c", 1, 1)]
    words = {tuple(row) for row in word_bins.word_counts(tokenized).where("word is not null").collect()}
    assert words == {(1, "a", 3), (1, "b", 1), (1, "c", 1), (1, "z", 1), (None, "a", 1), (None, "b", 1), (None, "c", 1), (2, "z", 1)}
    expected = {(1, (0, 1), (3, 2), 5), (None, (0, 1), (1, 2), 3), (2, (), (), 0), (3, (), (), 0)}
    for bins in (spark.createDataFrame(lookup, "word string, bin int, count bigint"), spark.createDataFrame([r[:2] for r in lookup], "word string, bin int")):
        found = [(r["id"], tuple(r["bins"]), tuple(r["counts"]), r["known"]) for r in word_bins.bin_counts(tokenized, bins).collect()]
        assert len(found) == 4 and set(found) == expected


def test_frequent_and_rare_keys_join_alike(spark):
    facts = spark.createDataFrame([(i, f"w{i % 7}") for i in range(50)] + [(99, None)], "id bigint, word string")
    lookup = spark.createDataFrame([(f"w{i}", i, 10**i) for i in range(6)], "word string, bin int, count bigint")
    wanted = sorted(map(tuple, facts.join(lookup.drop("count"), "word").select("id", "word", "bin").collect()))
    for most in (1, 3, 10**9):
        joined = lookups.weighted_join(facts, lookup, "word", "count", most)
        assert sorted(map(tuple, joined.select("id", "word", "bin").collect())) == wanted
    nothing = lookups.weighted_join(facts, lookup.limit(0), "word", "count")
    assert nothing.count() == 0
