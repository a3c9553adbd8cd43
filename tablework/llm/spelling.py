"""Spelling variants: words one edit apart, found by probing edits of each word against Bloom filters of the vocabulary.

The vocabulary is cut into shards by length, each with a blocked Bloom filter. A task makes the hashes of all words that a
deletion or replacement gives and looks them up in the shard of their length; what passes is spelled out and meets the
vocabulary itself in a join, which removes false positives. An insertion is the deletion seen from the longer word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.words import mix
from tablework.session import pin

#: words of this length and longer share a shard
LONGEST = 64
#: bits of a filter per word, bits set by each, blocks of the smallest filter, and blocks of all filters that are handed to
#: the tasks at once: 8 MB. A larger vocabulary is probed in several passes, each with some of the filters.
BITS, HASHES, LEAST_BLOCKS, PASS_BLOCKS = 16, 5, 1 << 8, 1 << 20
#: edits that a task holds at once
PROBES = 1 << 20

_BASE = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SALT = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Shard:
    """A filter: words of one length, or one of ``parts`` parts of them by hash."""

    length: int
    part: int
    parts: int
    blocks: int


def shards(counts: dict[int, int]) -> list[Shard]:
    """Filters for so many words per length, none larger than a pass."""
    out = []
    for length, n in sorted(counts.items()):
        blocks = max(LEAST_BLOCKS, math.ceil(n * BITS / 64))
        parts = math.ceil(blocks / PASS_BLOCKS)
        out += [Shard(length, part, parts, math.ceil(blocks / parts)) for part in range(parts)]
    return out


def passes(some: list[Shard]) -> list[list[Shard]]:
    """Filters by the pass they are in; each pass is within its bound."""
    out, left = [], 0
    for shard in some:
        if shard.blocks > left:
            out.append([])
            left = PASS_BLOCKS
        out[-1].append(shard)
        left -= shard.blocks
    return out


def _hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the letters at their places and the sums before each, of words of one length (one a row)."""
    powers = np.full(codes.shape[1], _BASE)
    powers[:1] = 1
    placed = mix(codes.astype(np.uint64)) * np.multiply.accumulate(powers)
    before = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    np.cumsum(placed, axis=1, out=before[:, 1:])
    return placed, before


def _slot(value: np.ndarray, shard: Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a value is in this part, its block there, and its bits in the block."""
    h = mix(value)
    mine = ((h & np.uint64(0xFFFF)) * np.uint64(shard.parts)) >> np.uint64(16) == shard.part
    block = ((h >> np.uint64(32)) * np.uint64(shard.blocks)) >> np.uint64(32)
    h, mask = mix(h ^ _SALT), np.zeros(len(h), np.uint64)
    for k in range(HASHES):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return mine, block.astype(np.int64), mask


def _letters(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and code points of the words of a column, by length, in pieces of bounded size."""
    words = column.to_pylist()
    length = np.array([len(w) for w in words], np.int64)
    for size in np.unique(length):
        rows = np.flatnonzero(length == size)
        step = max(1, PROBES // int(size))
        for some in (rows[k:k + step] for k in range(0, len(rows), step)):
            raw = "".join(words[k] for k in some).encode("utf-32-le")
            yield some, np.frombuffer(raw, np.uint32).reshape(len(some), int(size))


def build(vocabulary: DataFrame, some: list[Shard]) -> dict[Shard, np.ndarray]:
    """The filters of a pass. The driver gets one row per block with a word, at most those of a pass."""
    by_length = _by_length(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in _letters(batch.column(0)):
                value = _hashes(codes)[1][:, -1]
                for k, shard in by_length.get(min(codes.shape[1], LONGEST), ()):
                    mine, block, mask = _slot(value, shard)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(int(mine.sum()), k, np.int32)), pa.array(block[mine].astype(np.int32)),
                        pa.array(mask[mine].view(np.int64))], ["shard", "block", "mask"])

    masks = vocabulary.select("word").mapInArrow(run, "shard int, block int, mask long")
    found = masks.groupBy("shard", "block").agg(F.bit_or("mask").alias("mask")).toArrow()
    shard, block, mask = (found[c].to_numpy() for c in ("shard", "block", "mask"))
    out = {}
    for k, one in enumerate(some):
        filled = np.zeros(one.blocks, np.uint64)
        filled[block[shard == k]] = mask[shard == k].view(np.uint64)
        out[one] = filled
    return out


def _by_length(some: list[Shard]) -> dict[int, list[tuple[int, Shard]]]:
    out: dict[int, list[tuple[int, Shard]]] = {}
    for k, shard in enumerate(some):
        out.setdefault(shard.length, []).append((k, shard))
    return out


def _passing(value: np.ndarray, length: int, filters: dict[int, list[tuple[Shard, np.ndarray]]]) -> np.ndarray:
    """The places of the values that a filter of words of this length holds."""
    found = [np.zeros(0, np.int64)]
    for shard, filled in filters.get(min(length, LONGEST), ()):
        mine, block, mask = _slot(value, shard)
        found.append(np.flatnonzero(mine & ((filled[block] & mask) == mask)))
    return np.concatenate(found)


def _edits(codes: np.ndarray, alphabet: np.ndarray, filters: dict) -> Iterator[tuple[int, int, int]]:
    """(word, place, letter) of the deletions (letter -1) and replacements of words of one length that pass a filter.

    A replacement puts in a later letter of the alphabet, as the other word of the pair has the reverse. Of equal letters
    in a row, deleting the last is enough.
    """
    n, size = codes.shape
    placed, before = _hashes(codes)
    whole = before[:, -1:]
    if min(size - 1, LONGEST) in filters:
        without = before[:, :-1] + (whole - before[:, 1:]) * _BACK
        different = np.ones((n, size), bool)
        different[:, :-1] = codes[:, 1:] != codes[:, :-1]
        word, place = np.nonzero(different)
        for k in _passing(without[word, place], size - 1, filters).tolist():
            yield int(word[k]), int(place[k]), -1
    if min(size, LONGEST) in filters:
        powers = np.full(size, _BASE)
        powers[:1] = 1
        powers = np.multiply.accumulate(powers)
        for letter in alphabet.tolist():
            word, place = np.nonzero(codes < letter)
            value = mix(np.array([letter], np.uint64))[0] * powers
            changed = whole[word, 0] - placed[word, place] + value[place]
            for k in _passing(changed, size, filters).tolist():
                yield int(word[k]), int(place[k]), letter


def candidates(vocabulary: DataFrame, alphabet: np.ndarray, filters: dict[Shard, np.ndarray]) -> DataFrame:
    """(word, n, near): each word with those of its edits that pass the filters."""
    sent = vocabulary.sparkSession.sparkContext.broadcast((alphabet, filters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, filled = sent.value
        filters: dict[int, list[tuple[Shard, np.ndarray]]] = {}
        for shard, bits in filled.items():
            filters.setdefault(shard.length, []).append((shard, bits))
        for batch in batches:
            words, rows, near = batch.column(0).to_pylist(), [], []
            for some, codes in _letters(batch.column(0)):
                for k, place, letter in _edits(codes, alphabet, filters):
                    word = words[some[k]]
                    rows.append(int(some[k]))
                    near.append(word[:place] + (chr(letter) if letter >= 0 else "") + word[place + 1:])
            found = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*found.columns, pa.array(near, pa.string())], ["word", "n", "near"])

    return vocabulary.select("word", "n").mapInArrow(run, "word string, n long, near string")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """Pairs (word, n, near, near_n) of words one edit apart, each pair once, from a stored vocabulary (word, n)."""
    length = F.least(F.length("word"), F.lit(LONGEST))
    counts = {r["length"]: r["n"] for r in vocabulary.groupBy(length.alias("length")).agg(F.count("*").alias("n")).collect()}
    every = F.regexp_extract_all("word", F.lit("(?s)."), F.lit(0))
    letters = vocabulary.select(F.explode(F.array_distinct(every)).alias("c")).distinct().collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters), np.uint32)  # code points in use: bounded
    found = []
    for some in passes(shards(counts)):
        lengths = sorted({length for s in some for length in (s.length, s.length + 1)})
        touched = vocabulary.filter(length.isin(lengths))
        found.append(candidates(touched, alphabet, build(vocabulary, some)))
    if not found:
        return vocabulary.select("word", "n", F.lit("").alias("near"), F.col("n").alias("near_n")).limit(0)
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return reduce(DataFrame.unionAll, found).join(known, "near").select("word", "n", "near", "near_n")


def _last(links: DataFrame) -> DataFrame:
    """(word, root): where a chain of links (word, form) ends. Each round doubles the steps that are taken."""
    links = pin(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "links")
    while not links.filter("moved").isEmpty():
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = pin(links.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "links")
    return links.select("word", "root")


def variants(vocabulary: DataFrame) -> DataFrame:
    """Per word of a vocabulary (word, n): ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Two words are near if one inserted, deleted or replaced code point makes one the other. The form of a word is the near
    word of the largest n, of several the first in code-point order, if its n is at least twice the word's, and null
    otherwise. The root is where following forms ends: the word itself if it has none. As n doubles with each step, chains
    are short and end.

    ``vocabulary`` has each word once, no null or empty one, and is stored, since it is read several times. An empty one
    gives an empty result. Other columns are ignored. Words may be long: edits are made as hashes.
    """
    vocabulary = vocabulary.select("word", "n")
    pairs = near_words(vocabulary)
    both = pairs.select(F.explode(F.array(
        F.struct("word", F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form")).alias("other")),
        F.struct(F.col("near").alias("word"), F.struct((-F.col("n")).alias("n"), F.col("word").alias("form")).alias("other")),
    )).alias("side")).select("side.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    enough = -F.col("best.n") >= 2 * F.col("n")
    told = pin(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.form")).alias("form"),
        F.when(enough, -F.col("best.n")).alias("form_n")), "forms")
    roots = _last(told.filter("form IS NOT NULL"))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def text_words(docs: DataFrame, id: str = "doc_id", text: str = "text", least_chars: int = 5) -> DataFrame:
    """(doc_id, word) of the runs of letters in each text that have at least ``least_chars``, A-Z lower-cased, once for
    each time they occur. A letter is one of A-Z, a-z and U+00C0 to U+00FF. A null text has none."""
    runs = F.regexp_extract_all(text, F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least_chars},}}"), F.lit(0))
    found = docs.select(F.col(id).alias("doc_id"), F.explode(runs).alias("word"))
    return found.withColumn("word", lower_ascii(F.col("word")))


def lower_ascii(word: Column) -> Column:
    return F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(words: DataFrame, least_chars: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n) of the words of at least so many code points that occur at least so often, stored."""
    counts = words.filter(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return pin(counts.filter(F.col("n") >= least_count), "vocabulary")
