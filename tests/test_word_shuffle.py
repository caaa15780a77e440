"""What words and documents of the word-bin step shuffle."""

from pyspark.sql import functions as F

from doccairn.catalog.word_bin_queries import DocumentVectors
from doccairn.operators import lookups, word_bins


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def counted(spark, keys=300):
    """Weights of a long tail: most keys are rare, a few make up nearly all occurrences."""
    return spark.range(keys).select(
        F.concat(F.lit("w"), "id").alias("word"), F.col("id").cast("int").alias("bin"),
        F.when(F.col("id") < 3, 1_000_000).otherwise(F.col("id")).cast("bigint").alias("count"),
    )


def test_as_many_words_as_allowed_go_to_every_task(spark):
    lookup = counted(spark)
    assert lookups.frequent_from(lookup, "count", 300) == float("-inf")
    for most in (3, 50, 200):
        above = lookups.frequent_from(lookup, "count", most)
        assert most - 2 <= lookup.where(F.col("count") > above).count() <= most


def test_no_word_is_shuffled_where_all_may_go_to_every_task(spark):
    facts = spark.range(1000).select("id", F.concat(F.lit("w"), F.col("id") % 400).alias("word"))
    joined = lookups.weighted_join(facts, counted(spark), "word", "count", 300)
    assert "hashpartitioning" not in plan_of(joined)
    assert joined.count() == facts.join(counted(spark), "word").count()


def test_ties_and_missing_weights_lose_nothing(spark):
    lookup = spark.createDataFrame([(f"w{i}", i, None if i == 4 else 5) for i in range(6)], "word string, bin int, count bigint")
    facts = spark.range(60).select("id", F.concat(F.lit("w"), F.col("id") % 7).alias("word"))
    for most in (1, 3, 6):
        joined = lookups.weighted_join(facts, lookup, "word", "count", most)
        assert {tuple(r) for r in joined.select("id", "bin").collect()} == {(i, i % 7) for i in range(60) if i % 7 < 6}


def test_kept_columns_come_with_every_row_of_an_id(spark):
    rows = [(1, ["a", "b"], 7), (1, ["a"], None), (1, [], 7), (2, ["z"], 3), (None, ["b"], 4), (None, None, 5)]
    tokenized = spark.createDataFrame(rows, "id bigint, tokens array<string>, label int").repartition(3)
    lookup = spark.createDataFrame([("a", 0, 5), ("b", 1, 1)], "word string, bin int, count bigint")
    found = {r["id"]: (r["bins"], r["counts"], sorted(r["label"], key=str), r["known"]) for r in word_bins.bin_counts(tokenized, lookup, "label").collect()}
    assert found == {1: ([0, 1], [2, 1], [7, 7, None], 3), 2: ([], [], [3], 0), None: ([1], [1], [4, 5], 1)}


def test_labels_cost_documents_no_second_shuffle(spark, tmp_path, monkeypatch):
    rows = [(i % 30, f"title {i % 3}\nsame words here and {'x' * (i % 4)}", "en", f"src{i % 4}" if i % 5 else None) for i in range(40)]
    rows += [(None, "title same words", "en", "src1")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    plans = []
    settle = DocumentVectors.__init__.__globals__["settle"]
    monkeypatch.setitem(DocumentVectors.__init__.__globals__, "settle", lambda df, *a: plans.append(plan_of(df)) or settle(df, *a))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents = DocumentVectors(spark, str(tmp_path)).documents
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plans[-1]
    labels = sorted(((r["id"], r["label"]) for r in documents.collect()), key=str)
    assert labels == sorted(((i % 30, i % 4 if i % 5 else None) for i in range(40)), key=str)
