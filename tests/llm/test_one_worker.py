"""Encoding and decoding take one Python worker a task, and give what they give one after the other."""

import tracemalloc

import corpora
import corpus_pipeline
import public_tokenizers
import pyarrow as pa

from tablework.llm import bpe


def test_pipeline_encodes_and_decodes_in_one_worker(spark, tmp_path):
    docs = corpora.frame(spark, [(1, "one text"), (2, None), (3, "")]).selectExpr("doc_id", "'en' AS lang", "'s' AS source", "text")
    coded = corpus_pipeline.encode(spark, docs, str(tmp_path))
    assert coded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: (r.n_tokens, r.round_trip) for r in coded.collect()} == {1: (2, True), 2: (0, True), 3: (0, True)}


def test_both_at_once_equal_one_after_the_other(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = corpora.frame(spark, [(1, "Ein Text, 12 Wörter!"), (2, None), (3, ""), (4, "日本語\n\n  x"), (4, "twice")])
    both = bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN)
    apart = bpe.decode_ids(bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN), ranks)
    assert both.schema == apart.schema
    assert sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))


def test_ids_of_a_batch_are_decoded_row_by_row():
    shared = type("Shared", (), {"value": {bytes([k % 256]) + str(k).encode(): k for k in range(20_000)}})()
    ids = [[(k * 37 + j) % 20_000 for j in range(2000)] for k in range(500)] + [None, []]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32()))], ["ids"])
    token = {rank: token for token, rank in shared.value.items()}
    tracemalloc.start()
    try:
        out = next(bpe._decoding(shared, "ids", "decoded")(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert out["decoded"].to_pylist() == [None if x is None else b"".join(token[k] for k in x) for x in ids]
    assert peak < 5 * batch.nbytes
