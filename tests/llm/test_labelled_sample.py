from pyspark.sql import functions as F

from tablework.llm import toxicity


def test_learns_from_all_of_some_thousand_labelled_rows(spark, monkeypatch):
    pinned, real = {}, toxicity.pin

    def pin(df, label):
        out = pinned[label] = real(df, label)
        return out

    monkeypatch.setattr(toxicity, "pin", pin)
    docs = spark.range(18_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some plain words "), "id").alias("text"))
    toxicity.learn(docs, docs.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("toxic")))
    learning = docs.filter(~toxicity.held_out(F.col("doc_id"))).count()
    assert 10_000 < learning < 20_000 and pinned["labelled"].count() == learning
