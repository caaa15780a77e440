import pytest
from pyspark.sql import functions as F

from doccairn.functions.text import default_stop_words, has_text
from doccairn.operators import corpus, describe
from doccairn.functions.labels import fixed_text
from doccairn.operators.lookups import lookup_join
from doccairn.sources.posts import clean_posts

COLUMNS = "id string, reddit_id string, subreddit string, cleaned_title string, cleaned_selftext string, keywords string, title string, selftext string"


def posts(spark, rows):
    """Posts from (id, subreddit, title, body)."""
    full = [(i, f"r{i}", group, title, body, None, title, body) for i, group, title, body in rows]
    return clean_posts(spark.createDataFrame(full, COLUMNS))


def test_load_coerces_ids_and_fills_text(spark):
    rows = posts(spark, [("1", "a", None, "x"), ("bad", None, "t", None), (None, "a", "", "")]).collect()
    assert [r["id"] for r in rows] == [1, None, None]
    assert rows[0]["cleaned_title"] == "" and rows[1]["selftext"] == ""
    assert rows[1]["subreddit"] is None and rows[0]["keywords"] is None


def test_documents_and_tokens_match_python(spark):
    texts = [("Hello.", "World  again"), ("...", " . "), (" .a. ", "b\x1cc d E\x85f"), ("Ünï", "don't\tSTOP\n"), ("", "")]
    rows = [(str(i), "g", title, body) for i, (title, body) in enumerate(texts)]
    tokenized = corpus.tokenize(corpus.build_documents(posts(spark, rows)))
    found = {r["id"]: (r["document"], r["tokens"]) for r in tokenized.collect()}
    for i, (title, body) in enumerate(texts):
        document = (title + ". " + body).strip(". ")
        assert found[i] == (document, document.lower().split())
    counts = corpus.document_counts(tokenized).first()
    assert (counts["loaded"], counts["dropped"], counts["kept"]) == (5, 2, 3)
    assert corpus.drop_empty(tokenized).count() == 3


def test_keyword_ties_go_to_the_first_occurrence(spark):
    rows = [("2", "g", "beta alpha", "don't café"), ("1", "g", "gamma gamma data2vec", "the")]
    labelled = posts(spark, rows).withColumn("cluster", F.lit(0))
    words = [(r["word"], r["count"]) for r in describe.top_keywords(labelled, stop=["the"]).orderBy("rank").collect()]
    assert words == [("gamma", 2), ("data", 1), ("vec", 1), ("beta", 1), ("alpha", 1), ("don", 1), ("caf", 1)]


def test_top_rows_cut_before_the_shuffle(spark):
    frame = spark.range(100).select("id", (F.col("id") % 2).alias("cluster"))
    top = describe.top_rows(frame, "cluster", [F.asc("id")], 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 6


def test_stop_words(spark):
    words = default_stop_words()
    assert "would" not in words and "dont" in words and "don't" in words
    table = spark.createDataFrame([("don't",), ("the",)], "word string")
    assert {r["word"] for r in corpus.stop_word_union(table).collect()} == {"don't", "dont", "the"}


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_lookup_with_a_hot_key(spark, how):
    """Half of all rows carry one key; broadcast and shuffled lookups agree."""
    facts = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 40)).alias("word"))
    lookup = spark.createDataFrame([("hot", 0)] + [(f"w{i}", i) for i in range(0, 40, 3)], "word string, bin int")
    small = lookup_join(facts, F.broadcast(lookup), "word", how)
    wide = lookup_join(facts, lookup.hint("merge"), "word", how)
    assert sorted(map(str, small.collect())) == sorted(map(str, wide.select(small.columns).collect()))


def test_fixed_text_rounds_the_binary_value(spark):
    values = [0.00015, 0.00025, 0.125, 2.5, 0.5, 0.0, -0.00015, -2.5, 12345.67895, 1e12, 0.99995, 1 / 3] + [i / 100000 + 0.00005 for i in range(300)]
    frame = spark.createDataFrame([(v,) for v in values], "v double").select("v", fixed_text(F.col("v"), 4), fixed_text(F.col("v"), 1))
    for value, four, one in frame.collect():
        assert (four, one.replace("-0.0", "0.0")) == (f"{value:.4f}", f"{value:.1f}".replace("-0.0", "0.0")), value


def test_blank_bodies(spark):
    frame = spark.createDataFrame([("a",), (" \t \x1c",), ("",), (None,)], "s string")
    assert [r[0] for r in frame.select(has_text(F.col("s"))).collect()] == [True, False, False, False]


def test_distribution_ignores_missing_groups(spark):
    labelled = posts(spark, [("1", "a", "", ""), ("2", None, "", ""), ("3", "a", "", ""), ("4", "b", "", "")]).withColumn("cluster", F.lit(0))
    shares = {r["subreddit"]: (r["count"], round(r["share"], 3)) for r in describe.with_share(describe.group_distribution(labelled)).collect()}
    assert shares == {"a": (2, 66.667), "b": (1, 33.333)}
