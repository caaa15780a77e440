import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from doccairn.operators import embedding
from doccairn.operators.corpus import vocabulary
from doccairn.operators.embedding import Deal, Training
from doccairn.storage import SHUFFLE_CLEANUP, exists, settle, shared_dir


def corpus(spark, documents=40, length=30):
    rng = np.random.default_rng(4)
    rows = [(i, [f"w{w}" for w in rng.integers(0, 30, length)]) for i in range(documents)]
    return spark.createDataFrame(rows, "id bigint, tokens array<string>")


def trained(spark, plan):
    result = embedding.train(corpus(spark), plan)
    key = "word" if plan.mode == "skipgram" else "id"
    return np.array([r["vector"] for r in result.vectors.orderBy(key).collect()]), [r["loss"] for r in result.losses.orderBy("round").collect()]


@pytest.mark.parametrize("mode", ["skipgram", "dbow", "dm"])
def test_blocks_of_one_task_train_as_in_their_own(spark, monkeypatch, mode):
    """However many blocks share a task, every block starts from the same vectors and counts once in the mean."""
    plan = Training(mode=mode, vector_size=4, min_count=2, epochs=3, rate=0.1, block_tokens=150, blocks_at_once=5)
    alone = trained(spark, plan)
    monkeypatch.setattr(Deal, "of", staticmethod(lambda blocks, at_once, cores: Deal(blocks, at_once, 2)))
    together = trained(spark, plan)
    assert np.allclose(alone[0], together[0], atol=1e-5) and np.allclose(alone[1], together[1], atol=1e-5)


def test_a_task_lists_a_word_once(spark):
    """Twelve blocks on two tasks pull a common word twice a wave, not twelve times."""
    tokenized, plan = corpus(spark), Training(mode="skipgram", vector_size=4, min_count=2, block_tokens=100, noise_share=0.05)
    words, deal = settle(vocabulary(tokenized, 2), "words"), Deal(12, 12, 2)
    block = F.pmod(F.xxhash64("id"), F.lit(12)).cast("int")
    terms = embedding.block_words(tokenized.select(deal.task(block).alias("block"), "id", "tokens"), words, 12, plan, deal).collect()
    assert len({(r["block"], r["word"]) for r in terms}) == len(terms) <= 60
    own = embedding.block_words(tokenized.select(block.alias("block"), "id", "tokens"), words, 12, plan).collect()
    task = {b: b % 2 for b in range(12)}
    weights = {(b, r["word"]): r["common"] + r["picked"].count(b) for r in terms for b in range(12) if task[b] == r["block"]}
    for row in own:
        assert weights.pop((row["block"], row["word"])) == pytest.approx(row["noise"])
    assert not any(weights.values())


def test_deal_bounds_the_blocks_of_a_task():
    for blocks, cores in ((1, 8), (34, 8), (225, 8), (2250, 12), (2250, 6), (2250, 1)):
        deal = Deal.of(blocks, 256, cores)
        assert -(-deal.at_once // deal.tasks) <= embedding.TASK_BLOCKS
        assert deal.tasks == deal.at_once or deal.tasks % cores == 0


def test_training_leaves_no_tables_but_its_result(spark):
    folder = f"{shared_dir(spark).removeprefix('file:')}/doccairn"
    for mode in ("skipgram", "dbow"):
        plan = Training(mode=mode, vector_size=4, min_count=2, epochs=2, block_tokens=150, blocks_at_once=5)
        spent: list[str] = []
        tokenized = settle(corpus(spark), "own-tokens", spent)
        path, before = spent[0], set(os.listdir(folder))
        assert embedding.train(tokenized, plan, spent).vectors.count()
        assert not exists(spark, path)
        assert {name.rpartition("-")[0] for name in set(os.listdir(folder)) - before} <= {"word-vectors", "training-round"}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    def shuffles():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("shuffle_")

    before = shuffles()
    stored = settle(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    deadline = time.time() + 10
    while shuffles() > before and time.time() < deadline:
        time.sleep(0.1)
    assert shuffles() <= before and stored.count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_tokens_of_any_kind_are_encoded(spark):
    rows = [(0, ["a", "b\na", "a"]), (1, []), (2, [None, "b", ""]), (3, ["x"]), (4, None), (5, [""])]
    documents = spark.createDataFrame([(0, *r) for r in rows], "block int, id bigint, tokens array<string>")
    words = spark.createDataFrame([(0, i, w) for i, w in enumerate(["", "a", "b", "b\na"])], "block int, number int, word string")
    found = {r["id"]: r["tokens"] for r in embedding.encode_documents(documents, words, 1).collect()}
    assert found == {0: [1, 3, 1], 1: [], 2: [2, 0], 3: [], 4: [], 5: [0]}


def test_what_tasks_get_can_be_sent(spark):
    """Classes that name stored tables are sent to tasks by value; none may hold a lock."""
    from pyspark import cloudpickle

    from doccairn import storage
    from doccairn.operators.quality import Centroids

    settle(spark.range(3), "any")
    assert cloudpickle.loads(cloudpickle.dumps(storage.shuffles_removed)) and cloudpickle.loads(cloudpickle.dumps(Centroids))
