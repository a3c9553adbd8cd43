"""Language of texts by bit-sliced Bloom filters of letter trigrams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from tablework.llm.sketches import slots
from tablework.session import pin

UNKNOWN = "und"
PIECE_CHARS = 1 << 19


@lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for everything else."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        if (text := chr(c)).isalpha():
            lower = text.lower()
            table[c] = ord(lower) if len(lower) == 1 else c
    return table


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, trigram) of every letter with its neighbours; what is no letter counts as a space."""
    lengths = np.array([len(t) for t in texts], np.int64)
    # a space before, between and after texts, so that no trigram crosses from one into the next
    joined = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    code = _letters()[joined].astype(np.uint64)
    middle = np.flatnonzero(code)
    gram = (code[middle - 1] << np.uint64(42)) | (code[middle] << np.uint64(21)) | code[middle + 1]
    ends = np.cumsum(lengths + 1)
    return np.searchsorted(ends, middle, "right") if len(texts) else middle, gram


def _parts(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about a fixed number of letters, each with the number of its first text."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        held.append(text or "")
        size += len(held[-1])
        if size >= PIECE_CHARS:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held


@dataclass
class LanguageFilters:
    """One Bloom filter per language, stored by bit: ``masks[bit]`` has the languages whose filter has that bit.

    ``masks`` has a column of 64 languages for every 64 of them; ``wrong`` is each filter's rate of false positives.
    """

    languages: list[str]
    log_bits: int
    hashes: int
    masks: np.ndarray
    wrong: np.ndarray

    def languages_of(self, grams: np.ndarray) -> np.ndarray:
        """Bit masks of all languages that contain each trigram, one column per 64 languages."""
        at = slots(grams, self.log_bits, self.hashes)
        found = self.masks[at[0]]
        for k in range(1, self.hashes):
            found &= self.masks[at[k]]
        return found

    def estimate(self, texts: list[str]) -> np.ndarray:
        """How many trigrams of each text belong to each language, corrected for false positives; negative: none."""
        text, gram = trigrams(texts)
        total = np.bincount(text, minlength=len(texts)).astype(float)
        found = self.languages_of(gram) if len(gram) else np.zeros((0, self.masks.shape[1]), np.uint64)
        out = np.empty((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            bit = (found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits = np.bincount(text[bit.astype(bool)], minlength=len(texts))
            out[:, i] = (hits - total * self.wrong[i]) / (1 - self.wrong[i])
        out[total == 0] = np.nan
        return out

    def decide(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text: the winner's share of all corrected counts.

        Ties, and texts none of whose trigrams is known, go to the language that comes first (the most frequent).
        """
        names, scores = [], []
        for counts in self.estimate(texts):
            if not len(self.languages) or np.isnan(counts[0]):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            counts = np.maximum(counts, 0.0)
            best, total = int(counts.argmax()), float(counts.sum())
            names.append(self.languages[best])
            scores.append(min(1.0, float(counts[best]) / total) if total > 0 else 0.0)
        return names, scores


def gram_counts(docs: DataFrame) -> DataFrame:
    """Trigrams of each language in all texts: (lang, gram, n), counted in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def told():
            for lang, (gram, n) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)],
                    ["lang", "gram", "n"])

        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist())
            for first, part in _parts(texts):
                text, gram = trigrams(part)
                here = langs[first:first + len(part)]
                for lang in np.unique(here):
                    some, n = np.unique(gram[(here == lang)[text]], return_counts=True)
                    if lang in held:
                        old, m = held[lang]
                        both, where = np.unique(np.concatenate([old, some]), return_inverse=True)
                        total = np.zeros(len(both), np.int64)
                        np.add.at(total, where, np.concatenate([m, n]))
                        some, n = both, total
                    held[str(lang)] = (some, n.astype(np.int64))
            if sum(len(g) for g, _ in held.values()) > 1 << 20:
                yield from told()
                held.clear()
        yield from told()

    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_filters(
    docs: DataFrame, share: float = 2e-5, contrast: float = 0.1, log_bits: int = 20, hashes: int = 4
) -> LanguageFilters:
    """Filters from the columns text and lang, over all rows where both are given.

    A trigram is in a language's filter if it makes up at least ``share`` of the language's trigrams, and at least
    ``contrast`` of its share in the language where it is most common. A language has at most 1 / share such trigrams,
    which bounds the filters, and the driver gets at most ``2 ** log_bits`` masks.
    """
    counts = pin(gram_counts(docs), "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    order = [r["lang"] for r in totals.orderBy(F.desc("all"), "lang").collect()]  # as many as there are languages
    if not order:
        return LanguageFilters([], log_bits, hashes, np.zeros((1 << log_bits, 1), np.uint64), np.zeros(0))
    shares = counts.join(F.broadcast(totals), "lang").select("lang", "gram", (F.col("n") / F.col("all")).alias("share"))
    tops = shares.filter(F.col("share") >= share).groupBy("gram").agg(
        F.max("share").alias("top"), F.collect_list(F.struct("lang", "share")).alias("own"))  # one entry per language
    chosen = tops.select("gram", F.explode("own").alias("o"), "top").filter(F.col("o.share") >= contrast * F.col("top"))
    number = {lang: i for i, lang in enumerate(order)}

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            at = slots(batch.column(1).to_numpy().view(np.uint64), log_bits, hashes)
            mask = np.tile(np.uint64(1) << (lang % 64).astype(np.uint64), hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.ravel().astype(np.int64)), pa.array(np.tile(lang // 64, hashes)), pa.array(mask.view(np.int64))],
                ["slot", "column", "mask"])

    table = (
        chosen.select("o.lang", "gram").mapInArrow(bits, "slot long, column long, mask long")
        .groupBy("slot", "column").agg(F.bit_or("mask").alias("mask")).toArrow()
    )
    masks = np.zeros((1 << log_bits, (len(order) + 63) // 64), np.uint64)
    masks[table["slot"].to_numpy(), table["column"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    filled = np.array([
        np.count_nonzero((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) / len(masks) for i in range(len(order))
    ])
    return LanguageFilters(order, log_bits, hashes, masks, filled ** hashes)


def identify(docs: DataFrame, filters: LanguageFilters, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` of each whole text; columns of these names are replaced.

    A null text, or one without letters, is ``und`` with score 0, as is every text if nothing was learned.
    """
    docs = docs.drop("lang_pred", "score")
    at, shared = docs.columns.index(text), docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for _, part in _parts(batch.column(at).to_pylist()):
                more = shared.value.decide(part)
                names += more[0]
                scores += more[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"])

    schema = StructType([*docs.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    return docs.mapInArrow(run, schema)
