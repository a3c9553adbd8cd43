"""BPE by higher-order functions against the tokenizer library, on awkward texts."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tablework.llm import bpe, folds

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, places int, c0 string, folded int"


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    letters = "abcdefgh  \n\t'0189.,-#é漢字ßΩжы🙂\u0000  "
    found = [None, "", " ", "\n", "a", "'", "don't  stop", "x" * 5000, "漢" * 900, " " * 300, "zq" * 4000 + " end"]
    found += ["".join(draw.choices(letters, k=draw.randrange(1, 90))) for _ in range(300)]
    found += ["".join(draw.choices("etaoinshrdlu", k=k)) for k in range(1, 90)]
    return found + found[:20]


def test_ids_are_those_of_the_tokenizer_library(spark, ranks, texts):
    theirs = tiktoken.Encoding(
        "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.createDataFrame([(k, t, k, "kept", -k) for k, t in enumerate(texts)], SCHEMA).repartition(3)
    coded = folds.encode_words(docs, ranks, public_tokenizers.PATTERN)
    assert coded.columns == [*docs.columns, "ids"]
    rows = coded.withColumn("bytes", folds.bytes_of(F.col("ids"), ranks)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id] or ""
        assert row.ids == theirs.encode_ordinary(text), text
        assert bytes(row.bytes) == text.encode()
        assert (row.text, row.places, row.c0, row.folded) == (texts[row.doc_id], row.doc_id, "kept", -row.doc_id)


def test_digests_are_those_of_the_plain_fold(spark, ranks, texts):
    docs = spark.createDataFrame([(k if k % 7 else None, t) for k, t in enumerate(texts)], "doc_id long, text string")
    def key(row):
        return tuple(str(value) for value in row)

    ours = sorted(folds.word_digests(docs, ranks, public_tokenizers.PATTERN).collect(), key=key)
    assert ours == sorted(bpe.token_digests(docs, ranks, public_tokenizers.PATTERN).collect(), key=key)
    empty = hashlib.sha256(b"").hexdigest()
    assert sum(row.decoded_sha256 == empty for row in ours) == sum(not t for t in texts)


def test_an_empty_table_and_replaced_ids(spark, ranks):
    none = spark.createDataFrame([], "doc_id long, text string, ids string")
    coded = folds.encode_words(none, ranks, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "ids"] and coded.count() == 0
    assert folds.word_digests(none, ranks, public_tokenizers.PATTERN).count() == 0


def test_pieces_keep_every_row(spark, ranks, texts, monkeypatch):
    monkeypatch.setattr(folds, "PIECE_BYTES", 100)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    coded = folds.encode_words(docs, ranks, public_tokenizers.PATTERN)
    ids = {row.doc_id: row.ids for row in coded.collect()}
    plain = {row.doc_id: row.ids for row in bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN).collect()}
    assert ids == plain
