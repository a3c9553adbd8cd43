"""Byte-level BPE by higher-order functions: ranked merges over the bytes of distinct words, by a literal rank map.

Bytes are written as the characters of the same number (Latin-1) inside expressions, so that a part of a word is a
string and joins by ``concat``. The rank map is one literal: cells by CRC-32, each a map of a few tokens, as a lookup in
one map literal would compare every key. Its size is that of the vocabulary.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from tablework.llm.bpe import Splitter, fold_long

#: longer words, in bytes, are folded with their pairs in a heap, as each merge here copies the word's parts
LONGEST = 64
#: bytes of texts whose distinct words are folded together; a text is never cut
PIECE_BYTES = 1 << 22


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The literal: an array of maps from token to rank."""
    cells: list[dict[str, int]] = [{} for _ in range(1 << max(1, len(ranks).bit_length() - 1))]
    for token, rank in ranks.items():
        name = token.decode("latin-1")
        cells[zlib.crc32(name.encode()) % len(cells)][name] = rank
    return F.from_json(F.lit(json.dumps(cells)), "array<map<string,int>>")


def rank_of(table: Column, token: Column) -> Column:
    """Rank of a token, or null."""
    return F.element_at(table[(F.crc32(token.cast("binary")) % F.size(table)).cast("int")], token)


def merge(table: Column, state: Column) -> Column:
    """The leftmost pair of lowest rank becomes one part; without a pair that has a rank the state stays.

    ``state`` has the ``parts`` of a word and the rank of each neighbouring pair in ``worth``.
    """
    parts, worth = state["parts"], state["worth"]

    def joined(at: Column) -> Column:
        return let(F.concat(parts[at - 1], parts[at]), lambda part: F.struct(
            F.concat(F.slice(parts, 1, at - 1), F.array(part), F.slice(parts, at + 2, F.size(parts))).alias("parts"),
            F.concat(
                F.slice(worth, 1, F.greatest(at - 2, F.lit(0))),
                F.when(at > 1, F.array(rank_of(table, F.concat(parts[at - 2], part)))).otherwise(
                    F.array().cast("array<int>")),
                F.when(at < F.size(worth), F.array(rank_of(table, F.concat(part, parts[at + 1])))).otherwise(
                    F.array().cast("array<int>")),
                F.slice(worth, at + 2, F.size(worth))).alias("worth")))

    return let(F.array_min(worth), lambda least: F.when(least.isNull(), state).otherwise(
        let(F.array_position(worth, least).cast("int"), joined)))


def fold(table: Column, word: Column) -> Column:
    """Ids of a word that isn't empty: its own rank if it has one, else those of the parts that ranked merges leave."""

    def merged(parts: Column) -> Column:
        worth = F.transform(
            F.sequence(F.lit(1), F.size(parts) - 1), lambda k: rank_of(table, F.concat(parts[k - 1], parts[k])))
        folded = F.aggregate(
            F.sequence(F.lit(2), F.size(parts)), F.struct(parts.alias("parts"), worth.alias("worth")),
            lambda state, _: merge(table, state))
        return F.transform(folded["parts"], lambda part: rank_of(table, part))

    return let(rank_of(table, word), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(
        let(F.split(word, ""), merged)))


def _distinct_words(docs: DataFrame, ranks: dict[bytes, int], pattern: str, at: int) -> DataFrame:
    """Texts in pieces: ``words`` are a piece's distinct words, ``folded`` the ids of longer ones, which count on behind
    them, and ``docs`` its rows with the numbers of their words in ``places``."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    row = StructType([*docs.schema.fields]).add("places", ArrayType(IntegerType()))

    def cut(rows: pa.RecordBatch, split: Splitter) -> pa.RecordBatch:
        short: dict[str, int] = {}
        long: dict[str, int] = {}
        found = []
        for text in rows.column(at):
            words = split(text.as_py() or "")
            for word in set(words):
                if word not in short and word not in long:
                    kind = short if len(word.encode()) <= LONGEST else long
                    kind[word] = len(kind)
            found.append(words)
        number = short | {word: len(short) + k for word, k in long.items()}
        places = pa.array([np.fromiter(map(number.__getitem__, w), np.int32, len(w)) for w in found], pa.list_(pa.int32()))
        docs = pa.StructArray.from_arrays([*rows.columns, places], [*rows.schema.names, "places"])
        return pa.RecordBatch.from_arrays([
            pa.array([[word.encode().decode("latin-1") for word in short]], pa.list_(pa.string())),
            pa.array([[fold_long(word.encode(), shared.value) for word in long]], pa.list_(pa.list_(pa.int32()))),
            pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), docs)], ["words", "folded", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(pattern)
        for batch in batches:
            sizes = [len(text) if (text := value.as_py()) else 0 for value in batch.column(at)]
            first, held = 0, 0
            for k, size in enumerate(sizes):
                if held and held + size > PIECE_BYTES:
                    yield cut(batch.slice(first, k - first), split)
                    first, held = k, 0
                held += size
            if len(batch) > first:
                yield cut(batch.slice(first), split)

    schema = StructType().add("words", ArrayType(StringType())).add("folded", ArrayType(ArrayType(IntegerType())))
    return docs.mapInArrow(run, schema.add("docs", ArrayType(row)))


def encode_words(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with an array of token ids per text, in the column ``ids``.

    Each match of ``pattern`` is a word of its own; bytes are merged by rank within it, once for the distinct words of a
    few megabytes of texts, without a shuffle. Null and empty texts have no ids. All other columns stay, whatever their
    names, and a column already named ``ids`` is replaced.
    """
    kept = docs.drop(ids)
    names = kept.columns
    inner = kept.toDF(*(f"c{k}" for k in range(len(names))))
    pieces = _distinct_words(inner, ranks, pattern, names.index(text))

    def coded(folded: Column) -> Column:
        return F.transform("docs", lambda doc: F.struct(
            *(doc[c].alias(c) for c in inner.columns),
            F.flatten(F.transform(doc["places"], lambda k: folded[k])).alias("ids")))

    words = let(rank_map(ranks), lambda table: F.transform("words", lambda word: fold(table, word)))
    rows = pieces.select(F.inline(let(F.concat(words, F.col("folded")), coded)))
    return rows.toDF(*names, ids)


def _tokens(ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens by rank; ranks that none has are empty."""
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def _literal(texts: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(texts)), "array<string>")


def bytes_of(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that ids stand for, joined from their tokens' bytes; null ids give null."""
    table = _literal([token.hex() for token in _tokens(ranks)])
    return let(table, lambda pieces: F.unhex(F.array_join(F.transform(ids, lambda k: pieces[k]), "")))


def packed(ids: Column, ranks: dict[bytes, int]) -> Column:
    """Ids as little-endian unsigned 32-bit integers."""
    table = _literal([k.to_bytes(4, "little").hex() for k in range(max(ranks.values()) + 1)])
    return let(table, lambda pieces: F.unhex(F.array_join(F.transform(ids, lambda k: pieces[k]), "")))


def word_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id``, ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (of the bytes that the ids decode to)."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    coded = encode_words(rows, ranks, pattern).select("doc_id", "ids")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(packed(F.col("ids"), ranks), 256).alias("ids_sha256"),
        F.sha2(bytes_of(F.col("ids"), ranks), 256).alias("decoded_sha256"))
