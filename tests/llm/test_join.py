"""What the exact join exchanges."""

import random

from siftstone.llm import jaccard_join
from siftstone.llm.jaccard_join import Rule, by_ids, drop_near_copies


def test_rows_left_by_ids_do_not_depend_on_parts(spark, monkeypatch):
    rows = spark.createDataFrame([(i if i % 7 else None, str(i)) for i in range(60)], "doc_id int, text string")
    ids = spark.createDataFrame([(i,) for i in range(0, 60, 4)], "doc_id long")
    for how in ("left_semi", "left_anti"):
        want = sorted(r.text for r in rows.join(ids, "doc_id", how).collect())
        for most in (1_000, 4):
            monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", most)
            made = by_ids(rows, ids, ["doc_id"], how)
            assert sorted(r.text for r in made.collect()) == want
            assert "SortMergeJoin" not in made._jdf.queryExecution().executedPlan().toString()


def test_class_keys_are_exchanged_once(spark, monkeypatch):
    """Copies beyond Spark's own limit of broadcasts do not move the class keys of all sets."""
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcdefghijklmnop", k=30)) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts + texts[:10])), "doc_id long, text string")
    plans, save = {}, jaccard_join.Scratch.save

    def seen(self, df, step):
        plans[step] = df._jdf.queryExecution().executedPlan().toString()
        return save(self, df, step)

    monkeypatch.setattr(jaccard_join.Scratch, "save", seen)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = drop_near_copies(spark, docs, Rule(width=5, num=80, den=100))
        assert sorted(r.doc_id for r in kept.collect()) == list(range(30))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in plans["shared-0"] and plans["shared-0"].count("rangepartitioning") == 1
