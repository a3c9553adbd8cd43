"""The pipeline's row stages where ids are null or repeated: each row has its own fate."""

import random

import corpus_pipeline

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_rows_with_null_or_repeated_ids(spark, tmp_path):
    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    item = text(20)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = lambda rows: spark.createDataFrame([(d, t, "en", None, 0) for d, t in rows], DOCUMENTS).repartition(3)
    got = lambda stage, rows: sorted(((r.doc_id, r.text) for r in stage(spark, frame(rows), str(tmp_path)).collect()), key=repr)
    same = lambda rows: sorted(rows, key=repr)

    clean, other = text(30), text(30)
    good = [(None, clean), (5, other), (5, other), (None, None), (None, None), (6, "")]
    assert got(corpus_pipeline.drop_contaminated, [*good, (None, f"a {item} b"), (5, f"{item} c"), (7, item)]) == same(good)

    near = lambda t: f"{t} end"
    lone, shared, twice = text(40), text(40), text(40)
    rows = [(None, lone), (None, near(lone)), (None, shared), (3, near(shared)), (8, twice), (8, twice), (8, other),
            (None, None), (None, None), (9, ""), (9, "")]
    out = got(corpus_pipeline.drop_similar, rows)
    assert len([t for _, t in out if t in (lone, near(lone))]) == 1
    assert [x for x in out if x[1] not in (lone, near(lone))] == same(
        [(3, near(shared)), (8, twice), (8, other), (None, None), (None, None), (9, ""), (9, "")])


def test_columns_named_like_those_of_the_stages(spark, tmp_path):
    """Stages hand on whatever other columns the documents have, also for null and repeated ids."""
    schema = DOCUMENTS + ", key string, toxic_score double, gone int, row long, score string"
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    one, two, three = text(30), text(40), f"{text(20)}\n{text(9)}"
    rows = [(None, one), (None, one + " end"), (4, two), (4, two), (4, three), (5, three), (6, None), (6, None), (7, "")]
    full = [(d, t, "en", None, len(t or ""), f"k{k}", 0.5, k, k, "s") for k, (d, t) in enumerate(rows)]
    spark.createDataFrame([(1, text(20))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(full, schema).repartition(2)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema.names == docs.schema.names
        kept[name] = sorted(r.row for r in out.collect())
        assert all((r.key, r.gone, r.toxic_score) == (f"k{r.row}", r.row, 0.5) for r in out.collect())
    assert kept["toxicity"] == kept["decontamination"] == list(range(9))
    assert kept["line_dedup"] == [0, 2, 3, 4, 6, 7, 8]  # equal rows are one document, the second line of nulls is similar
    assert len(kept["jaccard_join"]) == 6 and set(kept["jaccard_join"]) >= {4, 6, 7, 8}
