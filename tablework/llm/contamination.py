"""Benchmark windows in documents: a prefix-filtered set join with exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.sketches import Bloom, bloom
from tablework.llm.words import ALPHANUMERIC, pieces, words
from tablework.session import pin

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: words after lower-casing A-Z; the byte class ALPHANUMERIC is the same
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def item_windows(items: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """Windows of items as (item_id, window, length): ``size`` consecutive words, or all words of a shorter item."""
    found = F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), F.lit(WORD), 0)
    rows = items.select(F.col(id).cast("string").alias("item_id"), found.alias("words")).filter("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    rows = rows.select("item_id", "words", F.explode(starts).alias("at"))
    window = F.slice("words", F.col("at"), F.lit(size))
    return rows.select("item_id", F.array_join(window, " ").alias("window"), F.size(window).alias("length")).distinct()


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """Shingles of windows: (window_id, length, size, offset, key)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for part in pieces(batch.column(1)):
                found = words(part, ALPHANUMERIC)
                text, at, key = found.shingles(shingle)
                row = part.first_row + text
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[row]), pa.array(lengths[row]), pa.array(np.minimum(lengths[row], shingle)),
                    pa.array((at - found.first[text]).astype(np.int32)), pa.array(key.view(np.int64))],
                    ["window_id", "length", "size", "offset", "key"])

    return windows.select("window_id", "window", "length").mapInArrow(
        cut, "window_id long, length int, size int, offset int, key long")


def _shingles_of(found, sizes: list[int]):
    """Shingles of every size that windows have, as (text, first word, key); short texts have no run of their own."""
    cut = [found.shingles(k, short=False) for k in sizes]
    return [np.concatenate(x) for x in zip(*cut)] if cut else [np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.uint64)]


def _frequencies(docs: DataFrame, sizes: list[int], wanted: Bloom) -> DataFrame:
    """How often each wanted shingle stands in the documents: (key, n). Counted per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch.column(0)):
                key = _shingles_of(words(part, ALPHANUMERIC), sizes)[2]
                key, n = np.unique(key[wanted.holds(key)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    return docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _found_prefixes(docs: DataFrame, sizes: list[int], wanted: Bloom, size: int) -> DataFrame:
    """One row per document (key null), and one per place of a wanted shingle with the words around it.

    ``row`` numbers the rows of documents, as ids may be null or repeated. ``lead`` is the number of words in
    ``around`` before the shingle.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0)
            for part in pieces(batch.column(1)):
                found = words(part, ALPHANUMERIC)
                text, at, key = _shingles_of(found, sizes)
                hit = np.flatnonzero(wanted.holds(key))
                text, at, key = text[hit], at[hit], key[hit]
                low = np.maximum(at - (size - 1), found.first[text])
                high = np.minimum(at + size, found.first[text + 1])
                raw, begins, ends = found.data.tobytes(), found.starts, found.ends
                around = [
                    b" ".join(raw[begins[w]:ends[w]] for w in range(a, b)).decode()
                    for a, b in zip(low.tolist(), high.tolist())
                ]
                every = np.arange(len(part))
                row = np.concatenate([every, text])
                none = np.ones(len(row), bool)
                none[len(every):] = False
                blank = np.zeros(len(every), np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(number + part.first_row + row), ids.take(pa.array(part.first_row + row)),
                    pa.array(found.counts[row].astype(np.int64)),
                    pa.array(np.concatenate([blank, key.view(np.int64)]), mask=none),
                    pa.array(np.concatenate([blank, at - found.first[text]]), mask=none),
                    pa.array(np.concatenate([blank, at - low]), mask=none),
                    pa.array([None] * len(every) + around, pa.string())],
                    ["row", "doc_id", "n_words", "key", "place", "lead", "around"])
            number += batch.num_rows

    return docs.select("doc_id", "text").mapInArrow(
        find, f"row long, doc_id {id_type}, n_words long, key long, place long, lead long, around string")


def contamination(
    docs: DataFrame, items: DataFrame, size: int = 13, shingle: int = 5, doc_id: str = "doc_id", doc_text: str = "text",
    item_id: str = "item_id", item_text: str = "text", one_in: int = 20, log_bits: int = 22,
) -> DataFrame:
    """Which words of documents lie in windows of benchmark items.

    Per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``n_items`` and
    ``items`` (ids of items with occurring windows, sorted as strings), ``contaminated`` (some word is hit, and at
    least one in ``one_in``).

    Windows are sets of word shingles. A document that contains a window contains all its shingles, so one necessary
    shingle is enough to find it: the prefix of length one in the order of rarity, which the counts in all documents
    give. Documents emit only places whose shingle passes a Bloom filter of the prefixes; the filter has a fixed size,
    and what passes wrongly finds no partner in the join. A candidate must leave room for the window before and after
    the shingle (position and length), and then hold the very words. Windows whose rarest shingle no document has are
    dropped before.

    A null text has no words. Rows are judged each, also where ids are null or repeated. An item without id hits words,
    but isn't listed. Extra columns are ignored.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text"))
    per_item = pin(item_windows(items, item_id, item_text, size), "item-windows")
    windows = pin(
        per_item.select("window", "length").distinct().select("*", F.monotonically_increasing_id().alias("window_id")), "windows"
    )
    tokens = pin(_window_shingles(windows, shingle), "window-shingles")
    sizes = sorted(r["size"] for r in tokens.select("size").distinct().collect())  # at most ``shingle`` values
    counts = pin(_frequencies(docs, sizes, bloom(tokens, "key", log_bits)), "frequencies")
    rarest = F.min(F.struct("n", "key", "offset")).alias("rarest")
    prefix = tokens.join(counts, "key", "left").groupBy("window_id", "length").agg(
        F.min(F.coalesce("n", F.lit(0))).alias("least"), rarest
    ).filter("least > 0").select("window_id", "length", "rarest.key", "rarest.offset")
    prefix = pin(prefix.join(windows.select("window_id", "window"), "window_id"), "prefixes")
    found = pin(_found_prefixes(docs, sizes, bloom(prefix, "key", log_bits), size), "places")

    start = F.col("place") - F.col("offset")
    body = F.slice(F.split("around", " "), (F.col("lead") - F.col("offset") + 1).cast("int"), F.col("length"))
    occur = pin(
        found.filter("key IS NOT NULL").join(prefix, "key")
        .filter((F.col("lead") >= F.col("offset")) & (start + F.col("length") <= F.col("n_words")))
        .filter(F.array_join(body, " ") == F.col("window"))
        .select("row", "window_id", "window", start.alias("start"), (start + F.col("length")).alias("end")), "occurrences"
    )
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    hits = occur.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    named = (
        occur.select("row", "window").distinct().join(per_item.filter("item_id IS NOT NULL"), "window")
        .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    rows = found.filter("key IS NULL").select("row", "doc_id", "n_words")
    out = rows.join(hits, "row", "left").join(named, "row", "left")
    n_hit, none = F.coalesce("n_hit", F.lit(0)).cast("long"), F.array().cast("array<string>")
    listed = F.coalesce("items", none)
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"),
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"),
    )
