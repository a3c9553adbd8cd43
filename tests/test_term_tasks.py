"""Words of texts are dealt to tasks by the bytes of the texts."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablework.operators import features, joins


def test_weights_with_many_tasks(spark, monkeypatch):
    texts = {k: f"all {'many ' * (k % 3 + 1)} w{'abcdefghij'[k % 10] * (k % 7 + 1)}" for k in range(60)}
    rows = spark.createDataFrame([*texts.items(), (60, None), (61, "")], "id long, text string")
    monkeypatch.setattr(features, "TASK_BYTES", sum(len(t) for t in texts.values()) // 40)
    monkeypatch.setattr(joins, "is_small", lambda df: False)  # meet the shuffled join
    found = features.tfidf(rows, "id", "text")
    got = {(r["id"], r["term"]): r["weight"] for r in found.collect()}
    assert found.rdd.getNumPartitions() >= 40
    counts = {k: Counter(t.split()) for k, t in texts.items()}
    seen = Counter(term for c in counts.values() for term in c)
    wanted = {}
    for k, c in counts.items():
        w = {term: tf * (math.log(63 / (1 + seen[term])) + 1) for term, tf in c.items()}
        wanted |= {(k, term): x / math.sqrt(sum(y * y for y in w.values())) for term, x in w.items()}
    assert got == pytest.approx(wanted)


def test_shuffled_lookup_has_the_tasks_asked_for(spark, monkeypatch):
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(2000).select((F.col("id") % 500).alias("k"), "id")
        lookup = facts.groupBy("k").agg(F.count("*").alias("n"))
        met = joins.lookup_join(facts, lookup, ["k"], "inner", tasks=37)
        assert met.rdd.getNumPartitions() == 37 and met.filter("n = 4").count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_text(spark):
    rows = spark.createDataFrame([], "id long, text string")
    assert features.tfidf(rows, "id", "text").collect() == []
