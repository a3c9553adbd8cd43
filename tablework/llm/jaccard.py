"""Documents with similar sets of word n-grams: an exact self-join by PartEnum signatures.

Sets of sizes a and b have a Jaccard similarity of at least p/q exactly if they differ in at most
(q - p) (a + b) / (q + p) elements. Sizes are cut into bands, each wider by q/p, so that similar sets are in the same or in
neighbouring bands. For a band and the next one, the feature domain is cut by a hash into n1 parts of n2 cells each, and a
set's signatures are its elements in every n2 - k2 cells of a part. With at most k differences, fewer than
n1 - k / (k2 + 1) parts have more than k2, so two sets share all signatures of some subset in the others.

A signature of no element tells nothing, and one of elements that very many documents have tells little. Both are left out,
and n1 has ``spare`` parts more: if one of two similar sets has at most ``spare`` such parts, a telling part remains. A set
with more of them is signed again by another hash, as often as it takes, at first counting frequent elements as none, then
only missing ones. Whatever elements are counted as frequent, no similar pair is lost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.linking import Signer, Threshold, clashes, distinct_sets, histogram, named, settle, shared_signatures
from tablework.llm.sketches import Bloom, bloom
from tablework.llm.words import NOT_SPACE, mix, pieces, seeded, words
from tablework.session import pin, pin_result


@dataclass(frozen=True)
class Layout:
    """How the sets of a band and of the next are signed."""

    parts: int
    cells: int
    left_out: int
    spare: int

    @property
    def subsets(self) -> list[tuple[int, ...]]:
        return list(combinations(range(self.cells), self.cells - self.left_out))

    @property
    def signatures(self) -> int:
        return self.parts * len(self.subsets)


class Similarity(Threshold):
    """Bands and layouts for a Jaccard similarity of at least ``p / q``."""

    def __init__(self, p: int = 3, q: int = 4, largest: int = 1 << 34):
        super().__init__(p, q)
        lows, highs, low = [], [], 1
        while low <= largest:
            lows.append(low)
            highs.append(low * q // p)
            low = highs[-1] + 1
        object.__setattr__(self, "lows", lows)
        object.__setattr__(self, "highs", highs)

    def band(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, "right") - 1

    @lru_cache(None)
    def layout(self, band: int) -> Layout:
        """The cheapest layout for pairs within a band, or of it and the next.

        The cost is the expected number of signatures over all hashes that a set of the band's smallest size needs, where
        signatures of few elements count more, as they meet by chance.
        """
        low, high = self.lows[band], self.highs[band]
        most = self.differences(high, min(high * self.q // self.p, self.highs[band + 1]))
        best = None
        for cells, out in ((1, 0), (3, 1), (4, 2), (5, 2)):
            needed, spare = most // (out + 1) + 1, 0
            if needed * (out + 1) > low:  # the smallest sets could never have enough telling parts
                continue
            while spare <= max(2, needed):
                some = Layout(needed + spare, cells, out, spare)
                per_cell = low / (some.parts * cells)
                mean = some.parts * min(1.0, math.comb(cells, out) * math.exp(-per_cell * (cells - out)))
                likely = 0.5 * math.erfc((mean - spare - 0.5) / math.sqrt(2 * max(mean, 1e-9)))
                cost = some.signatures / max(likely, 1e-3) * (1 + 12 / (per_cell * (cells - out)) ** 2)
                if best is None or cost < best[0]:
                    best = cost, some
                spare += max(1, needed // 40)
        return best[1]


def _sums(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.uint64)
    np.add.at(out, at, values)
    return out


def signatures(
    first: np.ndarray, value: np.ndarray, frequent: np.ndarray, similarity: Similarity
) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) of sets: set i has the elements ``value[first[i]:first[i + 1]]``, all different."""
    sizes = np.diff(first)
    bands = similarity.band(sizes)
    owners, signs = [], []
    for shift in (0, 1):  # each set is the smaller one in pairs of its band, and the larger one of the band below
        for band in np.unique(bands[sizes > 0]):
            if band < shift:
                continue
            tag = int(band) - shift
            layout = similarity.layout(tag)
            todo, level = np.flatnonzero((bands == band) & (sizes > 0)), 0
            while len(todo):
                length = sizes[todo]
                of = np.repeat(np.arange(len(todo)), length)
                at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(first[todo], length)
                some = seeded(value[at], 100 + level)
                cells = layout.parts * layout.cells
                cell = of * cells + ((some >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
                shape = (len(todo), layout.parts, layout.cells)
                total = _sums(mix(some), cell, len(todo) * cells).reshape(shape)
                telling = cell[~frequent[at]] if level == 0 else cell
                count = np.bincount(telling, minlength=len(todo) * cells).reshape(shape)
                weak = np.zeros(shape[:2], bool)
                names = mix(np.arange(layout.parts, dtype=np.uint64) + np.uint64((tag << 40) + (level << 34)))
                for k, subset in enumerate(map(list, layout.subsets)):
                    nothing = count[:, :, subset].sum(2) == 0
                    weak |= nothing
                    sign = mix(total[:, :, subset].sum(2, dtype=np.uint64) + names + mix(np.array([k], np.uint64)))
                    row, part = np.nonzero(~nothing)
                    owners.append(todo[row])
                    signs.append(sign[row, part])
                todo = todo[weak.sum(1) > layout.spare]
                level += 1
    if not owners:
        return np.zeros(0, int), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(signs)


def _sets(part, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of texts, sorted within each text: (first, value)."""
    found = words(part, NOT_SPACE)
    text, _, value = found.shingles(size)
    return distinct_sets(text, value, len(part))


def _identity(first: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set; 0 for an empty one."""
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    low, high = (mix(_sums(seeded(value, k), of, len(first) - 1)) for k in (50, 51))
    none = np.diff(first) == 0
    low[none] = high[none] = 0
    return low, high


def document_sets(docs: DataFrame, size: int, common: float = 0.002) -> DataFrame:
    """One row per document: (row, doc_id, low, high, n, histogram, frequent).

    ``frequent`` has, on one row per batch, the elements that more than a share ``common`` of the batch's different sets
    have, and at least four of them.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, values, seen = [], [], set()
            for part in pieces(batch.column(1)):
                first, value = _sets(part, size)
                low, high = _identity(first, value)
                rows.append((low, high, np.diff(first), histogram(first, value)))
                new = np.array([x not in seen and not seen.add(x) for x in low.tolist()], bool)
                values.append(value[np.repeat(new, np.diff(first))])
            if not rows:
                continue
            low, high, n, cells = (np.concatenate(x) for x in zip(*rows))
            every, counts = np.unique(np.concatenate(values), return_counts=True)
            frequent = every[counts >= max(4, common * len(seen))]
            lists: list = [None] * len(low)
            lists[0] = frequent.view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(number + np.arange(len(low))), batch.column(0), pa.array(low.view(np.int64)),
                pa.array(high.view(np.int64)), pa.array(n.astype(np.int64)),
                pa.array([h.tobytes() for h in cells], pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                ["row", "doc_id", "low", "high", "n", "histogram", "frequent"])
            number += len(low)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"row long, doc_id {kind}, low long, high long, n long, histogram binary, frequent array<long>")


def _signer(size: int, similarity: Similarity, frequent: Bloom, taken: Bloom) -> Signer:
    """Signatures of the different sets of a batch of texts."""

    def sign(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owners, signs, names, known = [np.zeros(0, int)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
        for part in pieces(batch.column(0)):
            first, value = _sets(part, size)
            ids = named(*_identity(first, value), taken)
            keep = np.zeros(len(ids), bool)
            keep[np.unique(ids, return_index=True)[1]] = True
            value, first = value[np.repeat(keep, np.diff(first))], np.concatenate([[0], np.cumsum(np.diff(first)[keep])])
            owner, some = signatures(first, value, frequent.holds(value), similarity)
            owners.append(owner + known)
            signs.append(some)
            names.append(ids[keep])
            known += len(names[-1])
        return np.concatenate(names), np.concatenate(owners), np.concatenate(signs)

    return sign


def _texts_of(docs: DataFrame, size: int, taken: Bloom) -> Callable[[DataFrame], DataFrame]:
    """The texts of the sets in given pairs, one for each set; a Bloom filter of fixed size picks them."""

    def texts_of(pairs: DataFrame) -> DataFrame:
        wanted = bloom(pairs.select(F.explode(F.array("least", "id")).alias("id")).distinct(), "id", 23)

        def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen: set[int] = set()
                for part in pieces(batch.column(0)):
                    ids = named(*_identity(*_sets(part, size)), taken)
                    some = [i for i in np.flatnonzero(wanted.holds(ids)).tolist() if not (ids[i] in seen or seen.add(ids[i]))]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[some].view(np.int64)),
                        batch.column(0).take(pa.array([part.first_row + i for i in some], pa.int64()))], ["id", "text"])

        return pin(docs.select("text").mapInArrow(take, "id long, text string").dropDuplicates(["id"]), "texts")

    return texts_of


def _components(docs: DataFrame, sets: DataFrame, size: int, similarity: Similarity) -> DataFrame:
    """(low, high, component_id) of each different set of words."""
    frequent = bloom(sets.select(F.explode("frequent").alias("value")), "value", 22)
    some = sets.filter("n > 0")
    taken = clashes(some.select("low", "high").distinct())
    raw = some.groupBy("low", "high").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("histogram").alias("histogram"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = named(*(batch.column(i).to_numpy().view(np.uint64) for i in (0, 1)), taken)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids.view(np.int64))], [*batch.schema.names, "id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    classes = pin(raw.mapInArrow(name, f"low long, high long, doc_id {kind}, n long, histogram binary, id long"), "named", "zstd")
    # about one signature per element; a bucket for each million
    elements = classes.agg(F.sum("n")).first()[0] or 0
    log_buckets = max(3, math.ceil(math.log2(max(1, elements) / (1 << 20))))
    signer = _signer(size, similarity, frequent, taken)
    stars = pin(shared_signatures(docs.select("text"), signer, log_buckets), "stars")
    parts = settle(
        stars, classes.select("id", "n", "histogram"), _texts_of(docs, size, taken), lambda part: _sets(part, size), similarity)

    grouped = classes.join(parts, "id", "left").select(
        "low", "high", "doc_id", F.coalesce("part", "id").alias("part"))
    grouped = pin(grouped, "grouped")
    names = grouped.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(pin(names, "names"), "part").select("low", "high", "component_id")


def similar_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, p: int = 3, q: int = 4
) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of at least ``p / q`` of their word n-grams.

    One row per document: ``doc_id``, ``n_shingles`` (its distinct n-grams), ``component_id`` (the smallest id that links
    reach, its own included). Words are runs of anything but ASCII white space, A-Z lower-cased; a text with fewer than
    ``size`` words is one n-gram; a text without words, or null, has none and is linked with nothing. Documents
    with equal sets are one class, whatever their number, and rows may repeat ids. A null id never names a group that
    has another. Extra columns are ignored; an empty table gives an empty result.

    Pairs that share a signature are verified by counting common elements; no similar pair is without one.
    """
    docs = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    similarity = Similarity(p, q)
    sets = pin(document_sets(docs, size), "sets", "zstd")
    told = pin_result(docs.sparkSession, lambda: _components(docs, sets, size, similarity), "told")
    return sets.join(told, ["low", "high"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
