"""Text queries: ``documents`` stands in for the posts table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doccairn.catalog.registry import query, settled_decimals, sql_decimals, table
from doccairn.functions.text import has_text
from doccairn.operators import corpus, describe
from doccairn.operators.lookups import lookup_join
from doccairn.sources.posts import clean_posts, spread

# A short stop-word list both engines use; one word has an apostrophe.
STOP_WORDS = ["the", "and", "for", "with", "that", "this", "des", "les", "une", "und", "der", "die", "don't"]

BLANKS = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

POSTS_SQL = """posts AS (
  SELECT doc_id AS id, CAST(doc_id AS VARCHAR) AS reddit_id, source AS subreddit, lang,
         split_part(text, chr(10), 1) AS title,
         substr(text, length(split_part(text, chr(10), 1)) + 2) AS selftext
  FROM documents)"""

# A third language loses its text, as posts with nothing left after cleaning do.
GAPPED_SQL = """gapped AS (
  SELECT id, CASE WHEN lang = 'es' THEN ' .' ELSE title END AS title,
         CASE WHEN lang = 'es' THEN '. ' ELSE selftext END AS selftext FROM posts)"""


def token_sql(source: str) -> str:
    return f"""tokenized AS (
  SELECT id, list_filter(string_split_regex(lower(trim(title || '. ' || selftext, '. ')), '{BLANKS}+'),
                         lambda t : t <> '') AS tokens FROM {source})"""


KEYWORD_SQL = """keyword_lists AS (
  SELECT id, lang, regexp_extract_all(lower(title || ' ' || selftext), '[a-z]{3,}') AS words FROM posts),
keywords AS (SELECT id, lang, generate_subscripts(words, 1) - 1 AS pos, unnest(words) AS word FROM keyword_lists)"""

STOP_SQL = "stop AS (SELECT unnest([" + ", ".join(
    "'" + word.replace("'", "''") + "'" for word in STOP_WORDS
) + "]) AS word), all_stop AS (SELECT word FROM stop UNION SELECT replace(word, '''', '') FROM stop)"


def posts(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """``documents`` as posts: the first line is the title, the rest the body."""
    title = F.substring_index("text", "\n", 1)
    body = F.substring(F.col("text"), F.length(title) + 2, F.length("text"))
    return clean_posts(
        spread(table(spark, sf_dir, "documents")).select(
            F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("reddit_id"),
            F.col("source").alias("subreddit"), title.alias("title"), body.alias("selftext"),
            title.alias("cleaned_title"), body.alias("cleaned_selftext"),
            F.lit(None).cast("string").alias("keywords"), *extra,
        )
    )


def posts_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with their language as the cluster."""
    return posts(spark, sf_dir, F.col("lang").alias("cluster"))


def gapped_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = F.col("cluster") == "es"
    return posts_by_language(spark, sf_dir).withColumns({
        "cleaned_title": F.when(blank, " .").otherwise(F.col("cleaned_title")),
        "cleaned_selftext": F.when(blank, ". ").otherwise(F.col("cleaned_selftext")),
    })


def tokenized_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.tokenize(corpus.build_documents(posts(spark, sf_dir)))


@query("""
SELECT TRY_CAST(CASE WHEN lang = 'de' THEN 'x' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS BIGINT) AS id,
       CAST(doc_id AS VARCHAR) AS reddit_id, source AS subreddit,
       CASE WHEN lang = 'fr' THEN '' ELSE split_part(text, chr(10), 1) END AS cleaned_title,
       text AS cleaned_selftext, CAST(NULL AS VARCHAR) AS keywords,
       CASE WHEN lang = 'en' THEN '' ELSE split_part(text, chr(10), 1) END AS title, text AS selftext
FROM documents""")
def load_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.substring_index("text", "\n", 1)
    raw = table(spark, sf_dir, "documents").select(
        F.when(F.col("lang") == "de", F.concat(F.lit("x"), F.col("doc_id")))
        .otherwise(F.col("doc_id").cast("string")).alias("id"),
        F.col("doc_id").alias("reddit_id"), F.col("source").alias("subreddit"),
        F.when(F.col("lang") != "fr", title).alias("cleaned_title"),
        F.col("text").alias("cleaned_selftext"), F.lit(None).alias("keywords"),
        F.when(F.col("lang") != "en", title).alias("title"), F.col("text").alias("selftext"),
    )
    return clean_posts(raw)


@query(f"WITH {POSTS_SQL} SELECT id, trim(title || '. ' || selftext, '. ') AS document FROM posts")
def build_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.build_documents(posts(spark, sf_dir)).select("id", "document")


@query(f"""WITH {POSTS_SQL}, {token_sql('posts')}
SELECT id, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS pos, unnest(tokens) AS token FROM tokenized""")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.token_rows(tokenized_posts(spark, sf_dir))


@query(f"""WITH {POSTS_SQL}, {token_sql('posts')}, words AS (SELECT unnest(tokens) AS word FROM tokenized)
SELECT word, count(*) AS count FROM words GROUP BY word HAVING count(*) >= 5""")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.vocabulary(tokenized_posts(spark, sf_dir), 5)


@query(f"""WITH {POSTS_SQL}, {GAPPED_SQL}, {token_sql('gapped')}
SELECT id, CAST(len(tokens) AS INTEGER) AS n_tokens FROM tokenized WHERE len(tokens) > 0""")
def drop_empty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenized = corpus.tokenize(corpus.build_documents(gapped_posts(spark, sf_dir)))
    return corpus.drop_empty(tokenized).select("id", F.size("tokens").alias("n_tokens"))


@query(f"""WITH {POSTS_SQL}, {GAPPED_SQL}, {token_sql('gapped')}
SELECT count(*) AS loaded, count(*) FILTER (len(tokens) = 0) AS dropped,
       count(*) FILTER (len(tokens) > 0) AS kept FROM tokenized""")
def document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.document_counts(corpus.tokenize(corpus.build_documents(gapped_posts(spark, sf_dir))))


@query(f"WITH {POSTS_SQL}, {KEYWORD_SQL} SELECT id, CAST(pos AS INTEGER) AS pos, word FROM keywords")
def keyword_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.keyword_rows(posts(spark, sf_dir))


@query(f"""WITH {POSTS_SQL}, {KEYWORD_SQL}, {STOP_SQL}
SELECT s.word, count(k.word) AS uses FROM all_stop s LEFT JOIN keywords k ON k.word = s.word GROUP BY s.word""")
def stop_word_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The united stop-word list with the number of uses of each word in the posts."""
    listed = spark.createDataFrame([(word,) for word in STOP_WORDS], "word string")
    union = corpus.stop_word_union(listed)
    uses = lookup_join(corpus.keyword_rows(posts(spark, sf_dir)), union, "word")
    counted = uses.groupBy("word").agg(F.count("*").alias("uses"))
    return union.join(counted, "word", "left").fillna(0, subset=["uses"])


@query(f"""WITH {POSTS_SQL}, {KEYWORD_SQL}, {STOP_SQL}
SELECT id, CAST(pos AS INTEGER) AS pos, word FROM keywords WHERE word NOT IN (SELECT word FROM all_stop)""")
def stop_word_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclusion against a stop-word table, the way a caller passes their own."""
    listed = spark.createDataFrame([(word,) for word in STOP_WORDS], "word string")
    words = corpus.keyword_rows(posts(spark, sf_dir))
    return corpus.drop_stop_words(words, corpus.stop_word_union(listed)).select("id", "pos", "word")


@query(f"""WITH {POSTS_SQL}, {KEYWORD_SQL}, {STOP_SQL},
counts AS (SELECT lang AS cluster, word, count(*) AS count, min((id, pos)) AS first FROM keywords
           WHERE word NOT IN (SELECT word FROM all_stop) GROUP BY lang, word),
ranked AS (SELECT cluster, CAST(row_number() OVER (PARTITION BY cluster ORDER BY count DESC, first) AS INTEGER) AS rank,
                  word, count FROM counts)
SELECT * FROM ranked WHERE rank <= 20""")
def top_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = posts_by_language(spark, sf_dir)
    return describe.top_keywords(labelled, stop=STOP_WORDS)


@query(f"""WITH {POSTS_SQL}
SELECT lang AS cluster, subreddit, count(*) AS count FROM posts WHERE subreddit IS NOT NULL GROUP BY ALL""")
def group_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = posts_by_language(spark, sf_dir)
    return describe.group_distribution(labelled)


@query(f"""WITH {POSTS_SQL},
counts AS (SELECT lang AS cluster, nullif(subreddit, 'src0') AS subreddit, count(*) AS count FROM posts GROUP BY ALL)
SELECT cluster, subreddit, count, {sql_decimals("100.0 * count / CAST(sum(count) OVER (PARTITION BY cluster) AS DOUBLE)")} AS share
FROM counts WHERE subreddit IS NOT NULL""")
def group_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares with one source turned to null, which leaves the totals too."""
    labelled = posts_by_language(spark, sf_dir)
    with_null = labelled.withColumn("subreddit", F.nullif(F.col("subreddit"), F.lit("src0")))
    shares = describe.with_share(describe.group_distribution(with_null))
    return shares.withColumn("share", settled_decimals(F.col("share")))


@query(f"""WITH {POSTS_SQL},
counts AS (SELECT lang AS cluster, subreddit, count(*) AS count FROM posts GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY cluster ORDER BY count DESC, subreddit) AS INTEGER) AS rank FROM counts)
SELECT * FROM ranked WHERE rank <= 5""")
def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = posts_by_language(spark, sf_dir)
    return describe.top_groups(describe.group_distribution(labelled), 5)


@query(f"""WITH {POSTS_SQL}
SELECT id, selftext FROM posts WHERE regexp_matches(selftext, '{BLANKS.replace('[', '[^', 1)}')""")
def blank_body_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).where(has_text(F.col("selftext"))).select("id", "selftext")
