"""Repetition inside a text: characters of words that stand in repeated lines and in repeated word n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.words import NOT_SPACE, Texts, Words, mix, pieces, words

# Fixed values, as published for web text, in percent: how many of a text's characters may stand in repeated n-grams of so
# many words, and how many in repeated lines. The number of repeated lines has no limit: of three lines it says little.
NGRAM_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_LIMIT = 20

#: the n-grams of the base rule, the least words of a text, and the largest percentage of words in repeated n-grams
WINDOW, LEAST_WORDS, WINDOW_LIMIT = 8, 20, 30
SYMBOLS = "#*$%&|<>"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


class Rolling:
    """Hashes of the windows of a sequence of 64-bit values, of any length from one pass of prefix sums.

    A window is a polynomial modulo 2 ** 64: the difference of two prefix sums, divided by the power at which it begins.
    """

    def __init__(self, values: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(_BASE, len(values)), dtype=np.uint64)])
        self.back = _powers(_BACK, len(values))

    def windows(self, at: np.ndarray, size: int) -> np.ndarray:
        """The hashes of the windows of ``size`` values that begin ``at``."""
        return mix((self.sums[at + size] - self.sums[at]) * self.back[at])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.multiply.accumulate(out)


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and which have occurred before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    often, again = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    return often, again


def covered(begins: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in at least one of the spans."""
    steps = np.bincount(begins, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[bounds])


def measure(part: Texts, sizes: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The counts of each text of a piece, by the name of their column."""
    cut = words(part, NOT_SPACE)
    cut = Words(part.data, cut.starts, cut.ends, cut.first)  # case matters here
    chars = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
    size = chars[cut.ends] - chars[cut.starts]
    n, text = len(size), cut.text

    begins = np.concatenate([part.offsets[:-1], np.flatnonzero(part.data == 10) + 1])
    begins.sort(kind="stable")
    ends = np.concatenate([begins[1:], [len(part.data)]])
    line_text = np.searchsorted(part.offsets, begins, "right") - 1
    first, last = np.searchsorted(cut.starts, begins), np.searchsorted(cut.starts, ends)
    some = np.flatnonzero(last > first)  # lines with a word
    begins, ends, line_text, first, last = (x[some] for x in (begins, ends, line_text, first, last))
    ends = ends - (part.data[ends - 1] == 10)
    lines = Words(part.data, begins, ends, np.zeros(0, np.int64)).hashes()
    _, again = repeats(mix(lines + line_text.astype(np.uint64) * _BASE))
    out = {
        "n_words": cut.counts.astype(np.int64), "word_chars": _sums(size, cut.first),
        "n_symbols": _sums(_SYMBOL[part.data], part.offsets),
        "n_dup_lines": np.bincount(line_text[again], minlength=len(part)),
        "dup_line_chars": _sums(size * covered(first[again], last[again], n), cut.first),
    }
    hashes, turn = Rolling(cut.hashes()), text.astype(np.uint64) * _BASE
    at = np.arange(n)
    for k in sorted(sizes):  # a window can only repeat where the shorter ones do
        at = at[at + k <= cut.first[text[at] + 1]]
        often, again = repeats(mix(hashes.windows(at, k) + turn[at]))
        out[f"dup_chars_{k}"] = _sums(size * covered(at[again], at[again] + k, n), cut.first)
        at = at[often]
        if k == WINDOW:
            out["n_repeat_words"] = _sums(covered(at, at + k, n), cut.first)
    return out


def within(count: str, of: str, percent: int) -> Column:
    return 100 * F.col(count) <= percent * F.col(of)


def repetition(
    docs: DataFrame, id: str = "doc_id", text: str = "text", limits: Mapping[int, int] = NGRAM_LIMITS
) -> DataFrame:
    """How much of each text repeats: counts, ``base_failed``, and ``kept``, the verdict.

    Words are separated by ASCII white space, and case matters. ``dup_chars_k`` has the characters of words inside an
    n-gram of k words that stood before in the same text, and ``dup_line_chars`` those inside such lines; a word counts
    once however many n-grams hold it. ``n_repeat_words`` counts the words of n-grams of eight that occur more than once,
    the first occurrence included. ``base_failed`` holds for texts of fewer than 20 words and for those with more than
    30 % of their words in such n-grams; ``kept`` needs that not, and each share at or below its limit.

    N-grams and lines are compared by 64-bit hashes within their text. A null or empty text has no word, and fails.
    Repeated rows and null ids are judged one by one, an empty table gives an empty result, and other columns are
    ignored, whatever their names. A text is never cut: a task holds a few megabytes, or one longer text.
    """
    sizes = tuple(sorted({*limits, WINDOW}))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
    names += [f"dup_chars_{k}" for k in sizes]
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch.column(1)):
                found = measure(part, sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first_row, len(part)), *(pa.array(found[c], pa.int64()) for c in names)],
                    ["doc_id", *names])

    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    found = rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names))
    base = (F.col("n_words") < LEAST_WORDS) | ~within("n_repeat_words", "n_words", WINDOW_LIMIT)
    rules = [within("dup_line_chars", "word_chars", LINE_LIMIT)]
    rules += [within(f"dup_chars_{k}", "word_chars", limit) for k, limit in limits.items()]
    kept = ~base & reduce(lambda a, b: a & b, rules)
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        kept.alias("kept"), "dup_line_chars", *[f"dup_chars_{k}" for k in sizes])
