"""Runs of words that repeat with a period, from the longest common prefixes of each text's suffixes.

Suffixes that agree in their first L words are one class. Classes are united by decreasing L, as Kruskal's algorithm unites
trees, and each keeps its positions in order. When a union at L makes two positions neighbours, the stretch from the first
to L words behind the second has their distance as its period. A run is found at its first position and the one a period
later: no position of the same class lies between these two, or the run would have a smaller period.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.repetition import Rolling, covered, repeats
from tablework.llm.words import NOT_SPACE, Texts, Words, mix, pieces, words

#: positions in one list of an ordered set; a longer set is several lists
LIST = 4096

_TURN = np.uint64(0x9E3779B97F4A7C15)


class Positions:
    """An ordered set of numbers in lists of bounded length, so that an insertion moves few of them."""

    __slots__ = ("lists", "firsts")

    def __init__(self, first: int):
        self.lists, self.firsts = [[first]], [first]

    def around(self, x: int) -> tuple[int, int]:
        """The members next below and above ``x``, -1 where there is none."""
        k = max(bisect(self.firsts, x) - 1, 0)
        some = self.lists[k]
        at = bisect(some, x)
        above = some[at] if at < len(some) else self.firsts[k + 1] if k + 1 < len(self.firsts) else -1
        return (some[at - 1] if at else -1), above

    def add(self, x: int) -> None:
        k = max(bisect(self.firsts, x) - 1, 0)
        some = self.lists[k]
        some.insert(bisect(some, x), x)
        if len(some) > LIST:
            half = len(some) // 2
            self.lists[k:k + 1] = [some[:half], some[half:]]
            self.firsts[k:k + 1] = [some[0], some[half]]
        else:
            self.firsts[k] = some[0]

    def __iter__(self) -> Iterator[int]:
        for some in self.lists:
            yield from some


def prefix_ranks(value: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... values, until all differ. ``ends`` has the end of each one's text;
    values of different texts differ."""
    n = len(value)
    place = np.arange(n)
    ranks, size = [np.unique(value, return_inverse=True)[1].astype(np.int64)], 1
    while n and ranks[-1].max() + 1 < n:
        rank = ranks[-1]
        there = place + size < ends
        behind = np.zeros(n, np.int64)  # 0 behind the end of a text
        behind[there] = rank[place[there] + size] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        ranks.append(new)
        size *= 2
    return ranks


def common_prefixes(ranks: list[np.ndarray], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and the length of the longest common prefix of each one and the next."""
    order = np.argsort(ranks[-1], kind="stable")
    left, right = order[:-1], order[1:]
    lcp = np.zeros(len(left), np.int64)
    for k in range(len(ranks) - 2, -1, -1):
        inside = np.flatnonzero((left + lcp < ends[left]) & (right + lcp < ends[right]))
        step = lcp[inside]
        lcp[inside] += (ranks[k][left[inside] + step] == ranks[k][right[inside] + step]) * (1 << k)
    return order, lcp


def neighbours(left: np.ndarray, right: np.ndarray, lcp: np.ndarray, times: int) -> list[tuple[int, int, int]]:
    """(i, j, L): positions that the union at L makes neighbours in their class, at most ``L / times`` apart.

    ``left`` and ``right`` are neighbours in the order of suffixes, with their common prefixes; unions go by decreasing L.
    """
    where, index = np.unique(np.concatenate([left, right]), return_inverse=True)
    descending = np.argsort(-lcp, kind="stable")
    first, second = index[:len(left)][descending].tolist(), index[len(left):][descending].tolist()
    spot = where.tolist()
    parent, size = list(range(len(spot))), [1] * len(spot)
    members: list = [None] * len(spot)  # of a class of one there is no set
    found = []
    for a, b, common in zip(first, second, lcp[descending].tolist()):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if size[a] < size[b]:
            a, b = b, a
        parent[b] = a
        if members[a] is None:
            members[a] = Positions(a)
        into, reach = members[a], common // times
        added = [b] if members[b] is None else list(members[b])
        last = -1  # all are looked up before the first is added: those of one class have met before
        for x, then in zip(added, [*added[1:], len(spot)]):
            below, above = into.around(x)
            if below > last and spot[x] - spot[below] <= reach:
                found.append((spot[below], spot[x], common))
            if -1 < above < then and spot[above] - spot[x] <= reach:
                found.append((spot[x], spot[above], common))
            last = x
        for x in added:
            into.add(x)
        size[a] += size[b]
        members[b] = None
    return found


def find_runs(cut: Words, least: int, times: int) -> np.ndarray:
    """Rows (text, start, length, period) of all runs in the texts of a piece, by text, start and period.

    A run of length at least ``max(least, times * period)`` repeats all but one period of itself, ``least`` less a
    ``times``-th of it at the shortest: texts in which no stretch of so many words occurs twice have none, and shorter
    common prefixes unite nothing.
    """
    shortest = -(-least * (times - 1) // times)
    value = mix(cut.hashes() + cut.text.astype(np.uint64) * _TURN)
    at = np.arange(len(value))
    at = at[at + shortest <= cut.first[cut.text + 1]]
    often, _ = repeats(Rolling(value).windows(at, shortest))
    some = np.unique(cut.text[at[often]])
    if not len(some):
        return np.zeros((0, 4), np.int64)
    counts = cut.counts[some]
    begins = np.cumsum(counts) - counts
    own = np.repeat(np.arange(len(some)), counts)
    value = value[np.arange(len(own)) - begins[own] + cut.first[some][own]]
    ends = (begins + counts)[own]

    ranks = prefix_ranks(value, ends)
    order, lcp = common_prefixes(ranks, ends)
    near = np.flatnonzero(lcp >= shortest)
    pairs = neighbours(order[near], order[near + 1], lcp[near], times - 1)
    i, j, common = np.array(pairs, np.int64).reshape(-1, 3).T
    first = begins[own[i]]
    whole = (common + j - i >= least) & ((i == first) | (ranks[0][i - 1] != ranks[0][j - 1]))
    out = np.stack([some[own[i]], i - first, common + j - i, j - i], 1)[whole]
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _joined(cut: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts of the words to keep, joined by one space."""
    some, text = np.flatnonzero(keep), cut.text[keep]
    more = np.concatenate([text[1:] == text[:-1], [False]])[:len(some)]  # a word follows, and so does a byte between
    data = cut.data.copy()
    data[cut.ends[some][more]] = 32
    size = cut.ends[some] - cut.starts[some] + more
    total = np.concatenate([[0], np.cumsum(size)])
    bounds = total[np.searchsorted(text, np.arange(len(cut.first)))]
    return data[covered(cut.starts[some], cut.ends[some] + more, len(data))], bounds


def _struct(found: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(found[:, k], pa.int64()) for k in (1, 2, 3)], ["start", "length", "period"])


def word_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``runs`` and ``collapsed``, the text with one period left of each run.

    Words are separated by ASCII white space. A run is a stretch of words with smallest period p, so that words p apart
    are equal, which no neighbouring word continues and which has at least ``max(least, times * p)`` words; ``runs`` lists
    (start, length, period) by start, then period. ``times`` is 2 or more. ``collapsed`` has the words that no run holds
    behind its first period, joined by one space.

    Words are told apart by 64-bit hashes. A null or empty text has no words, no runs and an empty ``collapsed``.
    Repeated rows and null ids are handled one by one, an empty table gives an empty result, and other columns are
    ignored, whatever their names. A text is never cut: a task holds a few megabytes, or one longer text, and takes
    n log n steps for it.
    """
    if times < 2:
        raise ValueError("a run has at least two periods")
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first_row, len(part)), *_columns(part, least, times)],
                    ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def _columns(part: Texts, least: int, times: int) -> list[pa.Array]:
    cut = words(part, NOT_SPACE)
    cut = Words(part.data, cut.starts, cut.ends, cut.first)  # case matters here
    found = find_runs(cut, least, times)
    begins = cut.first[found[:, 0]] + found[:, 1]
    gone = covered(begins + found[:, 3], begins + found[:, 2], len(cut.starts))
    data, bounds = _joined(cut, ~gone)
    listed = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(found[:, 0], np.arange(len(part) + 1)), pa.int32()), _struct(found))
    joined = pa.LargeStringArray.from_buffers(len(part), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data.tobytes()))
    return [pa.array(cut.counts, pa.int64()), listed, joined.cast(pa.string())]
