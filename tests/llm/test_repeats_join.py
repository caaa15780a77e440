"""Texts without repeats keep out of the join with the spans."""

import random

from doccairn.llm import repeats


def test_only_texts_with_repeats_meet_the_spans(spark):
    draw = random.Random(5)
    word = lambda size: "".join(draw.choice("abcdefgh ") for _ in range(size))
    shared = word(260)
    made = [(i, word(300)) for i in range(12)] + [(20, word(40) + shared), (21, shared + word(40)), (22, None), (23, ""), (None, "ä" * 150), (23, "short é")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = repeats.remove_repeats(spark.createDataFrame(made, "doc_id long, text string"))
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Union" in plan and plan.count("Join") == 1
    assert {r["id"] for r in rows if r["n_removed"]} == {20, 21, None}
    by_text = sorted((str(r["id"]), r["n_bytes"], bytes(r["kept"])) for r in rows if not r["n_removed"])
    assert by_text == sorted((str(i), len((t or "").encode()), (t or "").encode()) for i, t in made if i not in (20, 21, None))
    assert all(r["n_removed"] >= 260 for r in rows if r["id"] in (20, 21))
