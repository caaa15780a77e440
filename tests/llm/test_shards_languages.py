"""Subdivided ranges, written shards, and language scores of batches."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from doccairn.llm import language_id, shards
from doccairn.llm.grams import hashed

LETTERS = "abcdefghij "


def placed_by_hand(rows, n):
    """Shard and slot of every (id, digest, size), all bytes in one order."""
    total, upto, slots, found = sum(r[2] for r in rows), 0, {}, []
    for at, digest, size in sorted(rows, key=lambda r: (r[1], r[0])):
        upto += size
        shard = min(n - 1, int((upto - size / 2) * n / total))
        found.append((at, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
    return sorted(found)


def test_range_without_texts_is_subdivided(spark):
    """Two thirds of the rows hold a hundredth of the bytes: null texts, then one hot text."""
    records = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 1, None).when(F.col("id") % 3 == 2, "hot").otherwise(F.repeat(F.col("id").cast("string"), 150)).alias("text"))
    keyed = shards.keyed(records, "doc_id", "text").persist()
    bounds = shards.splitters(keyed, 32)
    finer = shards.subdivided(keyed, bounds, 9000 / 32)
    most = lambda cuts: max(r["count"] for r in keyed.groupBy(shards._range_of(cuts).alias("range")).count().collect())
    assert most(bounds) > 2000 and most(finer) < 1200 and len(finer) <= 2 * 32 and set(bounds) <= set(finer)
    digests = records.select("doc_id", F.coalesce(F.md5("text"), F.lit("")), F.coalesce(F.octet_length("text"), F.lit(0)) + 1).collect()
    found = shards.shard_by_bytes(records, shards=4).select("id", "shard", "slot").collect()
    assert sorted(tuple(r) for r in found) == placed_by_hand([tuple(r) for r in digests], 4)
    keyed.unpersist()


def test_equal_rows_without_ids_are_subdivided(spark):
    records = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    keyed = shards.keyed(records, "doc_id", "text")
    finer = shards.subdivided(keyed, [], 100)
    assert len(finer) == 39
    found = shards.shard_by_bytes(records, shards=4).groupBy("shard").agg(F.count("*"), F.min("slot"), F.max("slot")).collect()
    assert sorted(tuple(r) for r in found) == [(n, 1000, 0, 999) for n in range(4)]


def test_written_shards_hold_every_record_once(spark, tmp_path):
    made = [(n % 7 or None, None if n % 5 == 0 else f"text {n % 11}" * (n % 13), n, "x") for n in range(500)]
    records = spark.createDataFrame(made, "doc_id long, text string, shard long, slot string")
    name = shards.write_shards(records, str(tmp_path / "out"), shards=4, files_per_shard=2)
    read = spark.read.parquet(str(tmp_path / "out"))
    assert name == "shard_" and sorted(map(str, read.select(*records.columns).collect())) == sorted(map(str, records.collect()))
    sizes = [r["b"] for r in read.groupBy(name).agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("b")).collect()]
    longest = max(len(t or "") + 1 for _, t, _, _ in made)
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 2 * longest


def plain_scores(model, text):
    codes = [ord(c) for c in f" {text.lower()} "]
    total = model.priors.copy()
    for order in language_id.ORDERS:
        for at in range(len(codes) - order + 1):
            total += model.weights[hashed(np.array(codes[at : at + order], dtype=np.uint32), order, language_id.BITS)[0]]
    return model.names[int(total.argmax())], 1 / np.exp(total - total.max()).sum()


@pytest.mark.parametrize("piece", [40, 1 << 16])
def test_batch_scores_equal_plain_sums(monkeypatch, piece):
    monkeypatch.setattr("doccairn.llm.grams.PIECE", piece)
    monkeypatch.setattr(language_id, "PIECE", piece)
    draw = np.random.default_rng(3)
    weights = np.log(draw.uniform(0.5, 1.5, (1 << language_id.BITS, 3))).astype(np.float32)
    model = language_id.LanguageModel(("a", "b", "c"), weights, np.log(np.array([5.0, 3.0, 1.0])))
    texts = ["".join(draw.choice(list(LETTERS), n)) for n in (1, 5, 39, 40, 41, 130, 0, 7)]
    texts = [None, "", *texts, "12 !", "Ünï çödé", "x"]
    found = language_id.predict(model, pd.Series(texts))
    for (name, score), text in zip(found.itertuples(index=False, name=None), texts):
        if text is None or not any(c.isalpha() for c in text):
            assert (name, score) == ("und", 0.0)
        else:
            want = plain_scores(model, text)
            assert name == want[0] and score == pytest.approx(want[1], abs=1e-9)
    alone = pd.concat([language_id.predict(model, pd.Series([t])) for t in texts], ignore_index=True)
    assert found.equals(alone)


def test_learned_counts_equal_plain_counts(spark):
    rows = [(1, "ab ab", "x"), (2, "ba", "x"), (3, "zz", "y"), (4, None, "y"), (5, "q", None), (None, "q", "y")]
    model = language_id.fit(spark.createDataFrame(rows, "id long, text string, lang string"))
    counts = np.ones((1 << language_id.BITS, 2))
    for _, text, lang in rows[:3]:
        codes = np.array([ord(c) for c in f" {text} "], dtype=np.uint32)
        for order in language_id.ORDERS:
            for at in range(len(codes) - order + 1):
                counts[hashed(codes[at : at + order], order, language_id.BITS)[0], "xy".index(lang)] += 1
    assert model.names == ("x", "y") and np.allclose(model.weights, np.log(counts) - np.log(counts.sum(axis=0)), atol=1e-5)
    assert np.allclose(np.exp(model.priors), [2, 1])


def test_most_frequent_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    rows = [(n, f"text {n}", f"lang{n % 6}") for n in range(20)]
    rows += [(100 + n, "more", "lang5") for n in range(5)]
    model = language_id.fit(spark.createDataFrame(rows, "id long, text string, lang string"))
    # lang0 and lang1 have four rows each, lang5 eight, the others three
    assert model.names == ("lang0", "lang1", "lang5")


def test_nothing_learned_from_an_empty_table(spark):
    model = language_id.fit(spark.createDataFrame([], "id long, text string, lang string"))
    assert model.names == () and list(language_id.predict(model, pd.Series(["abc"]))["lang_pred"]) == ["und"]
