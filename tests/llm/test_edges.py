"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from doccairn.llm import decontaminate, near_duplicates, queries
from tests.llm import brute

CLASHING = "id long, key long, score string, kept int, spans string, row int, found string, shard int, size int, features int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
EXTRA = (1, 2, "x", 3, "y", 4, "z", 5, 6, 7)
PROSE = "The quick brown fox jumps over the lazy dog and then it runs away from the big bad wolf of the forest"
PER_ROW = ["op1_sampled_splitters", "op3_decontaminate", "op4_minhash", "op5_language_id", "op6_personal_data",
           "op7_sentencepiece", "op8_secret_scan", "op9_repeated_bytes", "op10_quality"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    texts = [
        (1, PROSE, "en"), (2, PROSE, "en"), (2, PROSE, "en"), (None, PROSE, "en"), (None, None, None), (3, None, "en"),
        (4, "", "fr"), (5, " \n\t ", None), (6, "12345 !!", "en"), (7, f"{PROSE} . " * 4000, "en"), (8, "é" * 70_000, "fr"),
        (9, "Le petit chat est sur la table avec les autres chats de la maison", "fr"), (9, "Another text of the same id", "en"),
        (-10, "one two three", "en"), (11, "one two three", "en"), (12, "x" * 250_000, "fr"),
    ]
    made = [(i, t, lang, "src", None if t is None else len(t), *EXTRA) for i, t, lang in texts]
    spark.createDataFrame(made, SCHEMA).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (9, None, 0), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "quick brown FOX jumps over the lazy dog and then it runs"), (2, None), (3, ""), (None, PROSE), (4, "one two"), (4, "one two"), (5, "!!")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    vectors = [(20 * i, [float(i), 1.0]) for i in range(4)] + [(1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [float("inf"), 1.0]), (9, [1.0]), (None, [1.0, 1.0])]
    spark.createDataFrame([(i, v, 0, 1) for i, v in vectors], "vec_id long, embedding array<float>, label int, score int").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, odd, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{odd}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_document_row(spark, odd, name):
    found = queries.QUERIES[name](spark, odd)
    ids = sorted(str(r["doc_id"]) for r in found.collect())
    assert ids == sorted(str(r["doc_id"]) for r in spark.read.parquet(f"{odd}/documents.parquet").collect())


@pytest.mark.parametrize("name", [*PER_ROW, "op2_nearest_vectors"])
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).count() == 0


def test_empty_pipeline(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_only_the_benchmark_or_labels_empty(spark, odd, empty, tmp_path):
    for name in ("documents", "embeddings"):
        spark.read.parquet(f"{odd}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{empty}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert queries.op3_decontaminate(spark, str(tmp_path)).where("contaminated").count() == 0
    assert {r["score"] for r in queries.op10_quality(spark, str(tmp_path)).collect()} == {0.5}


def test_defined_results(spark, odd):
    by = lambda name, *columns: {(r["doc_id"], *[r[c] for c in columns]) for r in queries.QUERIES[name](spark, odd).collect()}
    assert {(3, 1, None), (4, 1, 0)} <= by("op1_sampled_splitters", "size", "text_crc32")
    # The prose is an item without id, so only the twelve words of item 1 count, and the two of item 4.
    assert {(1, 22, 12, True), (None, 22, 12, True), (None, 0, 0, False), (11, 3, 2, True)} <= by(
        "op3_decontaminate", "n_words", "n_hit", "contaminated")
    groups = by("op4_minhash", "component_id", "kept")
    assert {(1, 1, True), (2, 1, False), (None, None, True), (3, 3, True), (4, 4, True), (5, 5, True), (11, -10, False)} <= groups
    assert {(3, "und", 0.0), (4, "und", 0.0), (5, "und", 0.0), (6, "und", 0.0)} <= by("op5_language_id", "lang_pred", "score")
    assert {(3, None), (4, 0)} <= by("op7_sentencepiece", "n_tokens")
    assert {(3, 0), (12, 250_000), (8, 140_000), (1, 0)} <= by("op9_repeated_bytes", "n_removed")


def test_vectors_that_take_no_part(spark, odd):
    found = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in queries.op2_nearest_vectors(spark, odd).collect()}
    assert {q for q, *_ in found} == {0, 20, 40, 60} and len(found) == 4 * 5
    assert {v for _, _, v, _ in found} == {0, 20, 40, 60, 1, 2}
    assert (0, 4, 1, 0.5) in found and (0, 5, 2, 0.5) in found and (60, 1, 40, 7.0) in found


COPY, OTHER = " ".join(f"word{i}" for i in range(40)), " ".join(f"other{i}" for i in range(40))


def kept_rows(frame):
    return sorted(str((r["doc_id"], r["text"], r["extra"])) for r in frame.collect())


def test_one_row_of_each_group_stays(spark):
    """Ids that repeat or are missing lose no text, and wholly equal rows leave one."""
    near = COPY + " and one more"
    made = [(5, COPY, 1), (5, OTHER, 2), (3, COPY, 3), (3, COPY, 3), (None, COPY, 4), (None, "alone " + OTHER[::-1], 5), (None, near, 6), (None, None, 7), (None, "", 8), (4, " ", 9)]
    rows = spark.createDataFrame(made, "doc_id long, text string, extra int").withColumn("row_key", F.lit("mine"))
    kept = near_duplicates.keep_one(rows)
    assert kept.columns == rows.columns
    assert kept_rows(kept) == sorted(map(str, [made[1], made[2], made[5], made[7], made[8], made[9]]))
    nameless = spark.createDataFrame([(None, COPY, 1), (None, COPY, 2), (None, OTHER, 3)], "doc_id long, text string, extra int")
    assert sorted(r["text"] for r in near_duplicates.keep_one(nameless).collect()) == sorted([COPY, OTHER])


def test_only_contaminated_rows_go(spark):
    bench = spark.createDataFrame([(1, COPY)], "item_id long, text string")
    made = [(None, COPY, 1), (None, OTHER, 2), (5, COPY, 3), (5, OTHER, 4), (6, None, 5), (None, None, 6)]
    rows = spark.createDataFrame(made, "doc_id long, text string, extra int")
    assert sorted(r["extra"] for r in decontaminate.keep_clean(rows, bench).collect()) == [2, 4, 5, 6]


def test_pipeline_links_from_four_fifths(spark):
    """The stage's groups are those of a plain comparison at 80 %."""
    base = [f"w{i}" for i in range(100)]
    made = [(i, " ".join([*base[: 100 - 2 * i], *(f"x{i}_{j}" for j in range(2 * i))]), "en", "s", 1) for i in range(12)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert kept == sorted(d for d, _, _, stays in brute.linked([r[:2] for r in made], 80) if stays)
    assert kept != sorted(d for d, _, _, stays in brute.linked([r[:2] for r in made], 85) if stays)


def test_pipeline_stages(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    names = docs.columns
    kept = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.settle(stage(spark, docs, odd), f"test-{number}")
        kept.append(docs)
        assert number == 4 or docs.columns == names
    assert kept[0].where("text is null or doc_id in (4, 5, 6)").count() == 0
    assert kept[1].where("doc_id = 2").count() == 0
    assert kept[2].where(F.col("text").contains("quick brown")).count() == 0
    assert kept[4].where("not round_trip").count() == 0
