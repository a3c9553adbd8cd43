"""Linking similar sets: from shared signatures to groups, without losing a pair that shares one.

A set is known by a 64-bit id. Signatures come as stars, that link the sets which share one to the smallest of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.components import components
from tablework.llm.sketches import Bloom, bloom
from tablework.llm.words import Texts, mix, pieces, seeded
from tablework.session import pin

#: hash classes of a histogram
CELLS = 512
#: bytes of the texts of pairs whose elements a task counts at once; the last pair may be longer
PAIR_BYTES = 1 << 18
#: of its open signatures, so many tell a member whether a pair was met under an earlier one
TELLING = 32


@dataclass(frozen=True)
class Threshold:
    """A Jaccard similarity of at least ``p / q``."""

    p: int = 3
    q: int = 4

    def differences(self, a: int, b: int) -> int:
        """Most elements in which sets of these sizes may differ."""
        return (self.q - self.p) * (a + b) // (self.q + self.p)

    def needed(self, sizes: np.ndarray) -> np.ndarray:
        """Fewest common elements of sets whose sizes add up to ``sizes``."""
        return -(-self.p * sizes // (self.p + self.q))


def named(low: np.ndarray, high: np.ndarray, taken: Bloom) -> np.ndarray:
    """The id of a set with two 64-bit hashes: the first one, but made from the second where different sets share the first."""
    low, clash = low.copy(), taken.holds(low)
    low[clash] = mix(high[clash] ^ np.uint64(0x5555555555555555))
    return low


def clashes(classes: DataFrame) -> Bloom:
    """The first hashes that different sets share; ``classes`` has each (low, high) once."""
    return bloom(classes.groupBy("low").count().filter("count > 1"), "low", 16)


def histogram(first: np.ndarray, value: np.ndarray) -> np.ndarray:
    """How many elements each set has in each hash class; saturated counts are taken as unknown."""
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return counted(of, (seeded(value, 60) >> np.uint64(55)).astype(np.int64), len(first) - 1, CELLS)


def counted(owner: np.ndarray, cell: np.ndarray, count: int, cells: int) -> np.ndarray:
    """Histograms of ``cells`` classes from the owner and class of each element."""
    return np.minimum(np.bincount(owner * cells + cell, minlength=count * cells), 255).astype(np.uint8).reshape(count, cells)


def distinct_sets(owner: np.ndarray, value: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Elements as sorted sets: set i has ``value[first[i]:first[i + 1]]``."""
    order = _sorted_by(owner, value, count)
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return np.searchsorted(owner, np.arange(count + 1)), value


def _sorted_by(owner: np.ndarray, value: np.ndarray, count: int) -> np.ndarray:
    """Order by owner and value: by one key of the owner and the first bits of the value, which nearly always decide."""
    shift = np.uint64(max(1, count.bit_length()))
    key = (owner.astype(np.uint64) << (np.uint64(64) - shift)) | (value >> shift)
    order = np.argsort(key)
    key, some = key[order], value[order]
    if ((key[1:] == key[:-1]) & (some[1:] != some[:-1])).any():
        return np.lexsort((value, owner))
    return order


#: what tells whether sets can be similar: two words of a sketch, and the set's size, 0 for a set that is like any other
ABOUT = np.dtype([("low", "<u8"), ("high", "<u8"), ("n", "<u2")])
#: signatures of a bucket meet in so many turns, so that a task unpacks one turn's share of them at once
TURNS = 8


def _packed(sign: np.ndarray, owner: np.ndarray, ids: np.ndarray, about: np.ndarray | None = None) -> bytes:
    """Signatures without their first 24 bits, each with its set: seven bytes a signature, and once what is told of the set."""
    some = np.zeros(len(ids), bool)
    some[owner] = True
    used, where = np.flatnonzero(some), (np.cumsum(some) - 1)[owner]
    head = np.array([len(sign), len(used)], "<i8").tobytes()
    wide = "<u2" if len(used) <= 65536 else "<u4"
    return b"".join((
        head, (sign >> np.uint64(8) & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), (sign & np.uint64(0xFF)).astype("u1").tobytes(),
        where.astype(wide).tobytes(), ids[used].astype("<u8").tobytes(), b"" if about is None else about[used].tobytes()))


def _fields(blob: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What is packed, in place: the first four bytes and the last of each signature, its set, the sets' ids, what is told of them."""
    n, m = np.frombuffer(blob, "<i8", 2).tolist()
    wide, at = np.dtype("<u2" if m <= 65536 else "<u4"), 16
    top, low = np.frombuffer(blob, "<u4", n, at), np.frombuffer(blob, "u1", n, at := at + 4 * n)
    where = np.frombuffer(blob, wide, n, at := at + n)
    ids = np.frombuffer(blob, "<u8", m, at := at + wide.itemsize * n)
    return top, low, where, ids, np.frombuffer(blob, ABOUT, -1, at + 8 * m)


def _unpacked(blob: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, the number of the set of each, the sets' ids, and what is told of the sets."""
    top, low, where, ids, told = _fields(blob)
    return top.astype(np.uint64) << np.uint64(8) | low, where, ids, told


def _entries(blob: bytes | pa.Buffer, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the signatures whose last bits are ``turn`` of ``TURNS``: the signatures, the id of each one's set, and what is told of it."""
    top, low, where, ids, told = _fields(blob)
    mine = np.flatnonzero(low % TURNS == turn)
    where = where[mine]
    return top[mine].astype(np.uint64) << np.uint64(8) | low[mine], ids[where], told[where] if len(told) else told


def _key(sign: np.ndarray, bucket) -> np.ndarray:
    """The name of a signature, from what is packed and its bucket."""
    return (sign & np.uint64((1 << 40) - 1)) ^ mix(np.atleast_1d(np.asarray(bucket, np.uint64)))


def _stars(sign: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted signatures: which entries are the smallest id of their signature, and the others as (sign, least, id)."""
    start = np.ones(len(sign), bool)
    start[1:] = sign[1:] != sign[:-1]
    leader = np.flatnonzero(start)
    least = ids[leader][np.cumsum(start) - 1]
    other = ids != least
    return leader, sign[other], least[other], ids[other]


def _gathered(batches: Iterator[pa.RecordBatch], size: int = 1 << 23, count: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Batches joined to some of about ``size`` bytes or ``count`` rows, and cut to that where they are larger."""
    held, total, rows = [], 0, 0
    for whole in batches:
        step = max(1, whole.num_rows // max(1, whole.nbytes // size))
        for batch in (whole.slice(k, step) for k in range(0, whole.num_rows, step)):
            held.append(batch)
            total, rows = total + batch.nbytes, rows + batch.num_rows
            if total >= size or rows >= count:
                yield pa.concat_batches(held)
                held, total, rows = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def _size_of_runs(some: np.ndarray) -> np.ndarray:
    """For each of sorted values, how many are equal to it."""
    start = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]])[:len(some)])
    size = np.diff(np.append(start, len(some)))
    return np.repeat(size, size)


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    up = parent[at]
    while not np.array_equal(up, above := parent[up]):
        up = above
    return up


def _shorten(parent: np.ndarray) -> None:
    """Let every member name its root; paths halve in every turn."""
    at = np.flatnonzero(parent != np.arange(len(parent)))
    while len(at):
        above = parent[parent[at]]
        at, above = at[rise := above != parent[at]], above[rise]
        parent[at] = above


#: from what is told of as many sets on both sides, or of one on the first, whether two sets can be similar
Near = Callable[[np.ndarray, np.ndarray], np.ndarray]


def near_groups(
    group: np.ndarray, about: np.ndarray, near: Near, threshold: Threshold, large: int = 1024, at_once: int = 1 << 18
) -> np.ndarray:
    """The first member that each member of a group is connected with by sets that can be similar. Groups are numbered in
    ascending order, and sizes ascend in a group.

    In groups of up to ``large``, members a step apart are compared, for ascending steps, as far as they aren't connected
    yet. In larger ones, a member takes along all that are near it, and those what is near them. A group with a set that
    is like any other stays whole.
    """
    parent = np.arange(len(group))
    size = np.bincount(group)
    first = np.cumsum(size) - size
    whole = np.bincount(group, about["n"] == 0) > 0
    parent[whole[group]] = first[group][whole[group]]
    end, step = (first + size)[group], 1
    left = np.flatnonzero((size <= large)[group] & ~whole[group])
    n = about["n"].astype(np.int64)
    limit = n * threshold.q // threshold.p
    while len(left := left[left + step < end[left]]):
        # once a partner is too large, all later ones are
        left = left[n[left + step] <= limit[left]]
        for k in range(0, len(left), at_once):
            a = left[k:k + at_once]
            a = a[parent[a] != parent[a + step]]
            a = a[near(about[a], about[a + step])]
            b = a + step
            while len(a):
                a, b = _roots(parent, a), _roots(parent, b)
                apart = a != b
                a, b = a[apart], b[apart]
                np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
                if step < 16:
                    _shorten(parent)
        if step & (step - 1) == 0:
            _shorten(parent)
        step += 1
    for g in np.flatnonzero((size > large) & ~whole).tolist():
        todo = np.arange(first[g], first[g] + size[g])
        while len(todo):
            front, todo = [todo[:1]], todo[1:]
            name = front[0][0]
            while front and len(todo):
                for x in front.pop().tolist():
                    hit = near(about[x:x + 1], about[todo])
                    if hit.any():
                        parent[todo[hit]] = name
                        front.append(todo[hit])
                        todo = todo[~hit]
    _shorten(parent)
    return parent


#: from the columns of a batch: ids of its sets, (set number, signature) of all signatures, and what is told of the sets, if
#: sets are to be told apart by it
Signer = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray] | tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def shared_signatures(
    rows: DataFrame, signer: Signer, log_buckets: int, near: Near | None = None, threshold: Threshold = Threshold(), crowd: int = 64
) -> DataFrame:
    """Signatures that different sets share, as stars: (key, least, id).

    A task first joins equal signatures of its own batch and hands on one entry for each, so that a signature of very
    many sets reaches its bucket once per batch. A bucket gets packed entries of a bounded part of all signatures.

    With ``near``, signatures that sets share by chance are left out: the sets of a signature are cut into those that
    are connected by sets that can be similar. For that all sets must meet in the bucket, so only signatures of more than
    ``crowd`` sets of a batch are joined before, and the entry for them counts as one that is like any other.
    """

    def bucket_of(sign: np.ndarray) -> np.ndarray:
        return sign >> np.uint64(64 - log_buckets) if log_buckets else np.zeros(len(sign), np.uint64)

    def row(bucket: int, stars: bool, blob: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([stars]), pa.array([blob], pa.binary())], ["bucket", "stars", "blob"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for batch in _gathered(batches):
            ids, owner, some, *told = signer(batch)
            if not len(some):
                continue
            about = told[0] if told else None
            order = np.argsort(some) if near else np.lexsort((ids[owner], some))
            owner, some = owner[order], some[order]
            joined = np.flatnonzero(_size_of_runs(some) > crowd) if near else np.arange(len(some))
            if near:
                order = np.lexsort((ids[owner[joined]], some[joined]))
                owner[joined] = owner[joined][order]
                about = about.copy()
            leader, key, least, member = _stars(some[joined], ids[owner[joined]])
            passed = np.ones(len(some), bool)
            passed[joined] = False
            passed[joined[leader]] = True
            if near:
                about["n"][owner[joined[leader]]] = 0
            owner, some = owner[passed], some[passed]
            key = _key(key, bucket_of(key))
            bucket = bucket_of(some).astype(np.int64)
            cuts = np.searchsorted(bucket, np.arange((1 << log_buckets) + 1))
            for b in np.unique(bucket).tolist():
                here = slice(cuts[b], cuts[b + 1])
                yield row(b, False, _packed(some[here], owner[here], ids, about))
            for k in range(0, len(key), 1 << 17):
                turn += 1
                here = slice(k, k + (1 << 17))
                yield row(turn % (1 << log_buckets), True, np.concatenate([key[here], least[here], member[here]]).tobytes())

    def met(packed: list, bucket: int) -> np.ndarray:
        """Stars (key, least, id) of some entries of a bucket, with all entries of a signature."""
        some, names, about = (np.concatenate(x) for x in zip(*packed))
        if near is None:
            order = np.lexsort((names, some))
            key, *star = _stars(some[order], names[order])[1:]
            return np.stack([_key(key, bucket), *star])
        where = np.argsort(some)
        where = where[_size_of_runs(some[where]) > 1]
        where = where[np.lexsort((names[where], some[where]))]
        some = some[where]
        # batches that have the same set tell the same of it, but for one that is like any other
        new = np.ones(len(some), bool)
        new[1:] = (some[1:] != some[:-1]) | (names[where[1:]] != names[where[:-1]])
        wild = np.logical_or.reduceat(about["n"][where] == 0, np.flatnonzero(new)) if len(some) else np.zeros(0, bool)
        some, where = some[new], where[new]
        told = about[where]
        told["n"][wild] = 0
        group = np.cumsum(np.concatenate([[True], some[1:] != some[:-1]])[:len(some)]) - 1
        order = np.lexsort((told["n"], group))
        some, where, told, wild = some[order], where[order], told[order], wild[order]
        centre, ids = near_groups(group, told, near, threshold), names[where]
        least = ids.copy()
        np.minimum.at(least, centre, ids)
        least = least[centre]
        whole = (np.bincount(group, wild) > 0)[group] if len(group) else wild
        key = np.where(whole, _key(some, bucket), mix(_key(some, bucket) ^ least))
        return np.stack([key, least, ids])[:, least != ids]

    def meet(found: pa.Table) -> pa.Table:
        # the blobs stay where Arrow has them
        blobs = [x.as_buffer() for x in found["blob"]]
        stars = found["stars"].to_pylist()
        out = [np.frombuffer(b, np.uint64).reshape(3, -1) for b, star in zip(blobs, stars) if star]
        packed = [b for b, star in zip(blobs, stars) if not star]
        if packed:
            out += [met([_entries(b, turn) for b in packed], found["bucket"][0].as_py()) for turn in range(TURNS)]
        return pa.table(list(np.concatenate(out, 1).view(np.int64)), ["key", "least", "id"])

    blobs = rows.mapInArrow(sign, "bucket int, stars boolean, blob binary")
    return blobs.groupBy("bucket").applyInArrow(meet, "key long, least long, id long")


def _cells(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Histograms of equal length, one a row."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), len(rows[0]) if rows else 0)


#: what is told of the sets that share a signature, and whether two of them can be similar by it
Tell = tuple[np.dtype, Near]


def _can_be_similar(a: pa.ChunkedArray | pa.Array, b: pa.ChunkedArray | pa.Array, tell: Tell) -> np.ndarray:
    kind, near = tell
    return near(*(np.frombuffer(b"".join(x.to_pylist()), kind) for x in (a, b)))


def _pruned(pairs: DataFrame, classes: DataFrame, threshold: Threshold, tell: Tell | None = None) -> DataFrame:
    """Pairs (least, id) whose sizes and histograms, and what else is told, allow enough common elements: with ``need``, that
    number."""
    side = classes.select("id", "n", "histogram", *(["about"] if tell else []))
    one, other = ([c, *(f"{x}_{k}" for x in side.columns[1:])] for c, k in (("least", "a"), ("id", "b")))
    both = pairs.join(side.toDF(*one), "least").join(side.toDF(*other), "id")
    both = both.select("least", "id", *(x for two in zip(one[1:], other[1:]) for x in two))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (batch.column(i).to_numpy() for i in (2, 3))
            need = threshold.needed(a + b)
            fits = np.flatnonzero(
                (np.minimum(a, b) >= need) & (_most_common(_cells(batch.column(4)), _cells(batch.column(5))) >= need)
                & (_can_be_similar(batch.column(6), batch.column(7), tell) if tell else True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(fits)), batch.column(1).take(pa.array(fits)), pa.array(need[fits])],
                ["least", "id", "need"])

    return both.mapInArrow(run, "least long, id long, need long")


def _most_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper bound of common elements from histograms; a saturated class bounds nothing."""
    low = np.minimum(a, b)
    return np.where((low == 255).any(-1), 1 << 40, low.sum(-1, dtype=np.int64))


#: from some texts, their sets: set i has the elements ``value[first[i]:first[i + 1]]``
Cutter = Callable[[Texts], tuple[np.ndarray, np.ndarray]]


def _similar(pairs: DataFrame, texts: DataFrame, cut: Cutter) -> DataFrame:
    """The pairs (least, id, need) with at least ``need`` common elements, of (id, text).

    Texts travel, and their sets are cut where a pair meets: a text is several times smaller than its elements.
    """

    def sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [(part.first_row, *cut(part)) for part in pieces(column)]
        owner = np.concatenate([np.repeat(np.arange(len(first) - 1) + row, np.diff(first)) for row, first, _ in found])
        return owner, np.concatenate([value for _, _, value in found])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = sum(pc.binary_length(batch.column(i)).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 4))
            turn = np.cumsum(size) // PAIR_BYTES
            for begin in np.flatnonzero(np.concatenate([[True], turn[1:] != turn[:-1]])[:len(turn)]).tolist():
                some = batch.slice(begin, int(np.searchsorted(turn, turn[begin], "right")) - begin)
                owner, value = (np.concatenate(x) for x in zip(sets(some.column(3)), sets(some.column(4))))
                # an element of both sets of a pair comes twice
                order = _sorted_by(owner, value, some.num_rows)
                owner, value = owner[order], value[order]
                twice = (owner[1:] == owner[:-1]) & (value[1:] == value[:-1])
                good = np.bincount(owner[1:][twice], minlength=some.num_rows) >= some.column(2).to_numpy()
                yield some.select([0, 1]).filter(pa.array(good))

    both = (
        pairs.join(texts.toDF("least", "a"), "least").join(texts.toDF("id", "b"), "id").select("least", "id", "need", "a", "b")
    )
    return both.mapInArrow(count, "least long, id long")


def _open_lists(stars: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, id, part, n): members of signatures that have members in different groups.

    Copies share most of their signatures, so that many signatures have the very same members: of these, told apart by
    their number and two sums of hashes, one is enough.
    """
    # a member of a task's own star has met that star's centre, but not the smallest of all
    centres = stars.groupBy("key").agg(F.min("least").alias("id"), F.max("least").alias("last")).filter("id <> last")
    seen = stars.select("key", "id").unionByName(centres.select("key", "id")).distinct()
    seen = pin(seen.join(parts, "id", "left").select("key", "id", F.coalesce("part", "id").alias("part")), "members")
    lists = seen.groupBy("key").agg(
        F.min("part").alias("a"), F.max("part").alias("b"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    one = pin(lists.filter("a <> b").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n"), "open")
    return seen.join(one, "key")


def _rest(
    stars: DataFrame, parts: DataFrame, classes: DataFrame, threshold: Threshold, tell: Tell | None = None, block: int = 2048
) -> DataFrame:
    """Pairs (least, id) that share a signature but aren't connected yet, as far as their bounds allow a link.

    Members were compared with the smallest one of their star already, so a signature matters here only if it has other
    members in different groups. They are cut into blocks of about ``block``, and blocks meet pairwise, so that no task gets more than
    two blocks of a signature at once. A pair that shares several signatures leaves the task of the first one only: each
    member knows its first ``TELLING`` signatures, and a pair that both know under an earlier one was met there.
    """
    members = pin(_open_lists(stars, parts), "open-members")
    told = members.groupBy("id").agg(F.slice(F.array_sort(F.collect_list("key")), 1, TELLING).alias("known"))
    extra = ["about"] if tell else []
    about = pin(told.join(classes.select(F.col("id"), F.col("n").alias("size"), "histogram", *extra), "id"), "open-sets")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("id"), blocks).cast("int")
    spread = members.select("key", "id", "part", mine.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    rows = spread.join(about, "id").select(
        "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "id", "part",
        F.col("size").alias("n"), "histogram", "known", *extra)
    rows = rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "n")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            # the last group may go on in the next batch
            group = _groups(table)
            last = int(np.searchsorted(group, group[-1])) if len(group) else 0
            yield _close_pairs(table.slice(0, last), group[:last], threshold, tell)
            held = table.slice(last)
        if held is not None:
            yield _close_pairs(held, _groups(held), threshold, tell)

    return rows.mapInArrow(meet, "least long, id long").distinct()


def _groups(table: pa.Table) -> np.ndarray:
    """Number of the group of each row: rows in turn with equal key and blocks."""
    columns = [table.column(c).to_numpy() for c in ("key", "p", "q")]
    new = np.zeros(table.num_rows, bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


_NONE = np.iinfo(np.int64).max


def _known(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of signatures as rows of equal length."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.int64()))
    sizes = lists.value_lengths().to_numpy()
    out = np.full((len(sizes), TELLING), _NONE)
    out[np.arange(TELLING) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _met_before(known: np.ndarray, a: np.ndarray, b: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which pairs know a common signature smaller than the key they meet under."""
    out = np.zeros(len(a), bool)
    for k in range(0, len(a), 1 << 13):
        x, y, limit = known[a[k:k + (1 << 13)]], known[b[k:k + (1 << 13)]], key[k:k + (1 << 13), None, None]
        out[k:k + (1 << 13)] = ((x[:, :, None] == y[:, None, :]) & (x[:, :, None] < limit)).any((1, 2))
    return out


def _close_pairs(
    table: pa.Table, group: np.ndarray, threshold: Threshold, tell: Tell | None = None, at_once: int = 1 << 18
) -> pa.RecordBatch:
    """Pairs in one group whose sets aren't connected, as far as sizes and histograms, and what else is told, allow a link."""
    key, ids, part, n, own, p, q = (table.column(c).to_numpy() for c in ("key", "id", "part", "n", "own", "p", "q"))
    cells, known = _cells(table.column("histogram")), _known(table.column("known"))
    about = np.frombuffer(b"".join(table.column("about").to_pylist()), tell[0]) if tell else None
    out, left, step = [np.zeros((2, 0), np.int64)], np.arange(len(ids)), 1
    while len(left := left[left + step < len(ids)]):
        other = left + step
        # sizes ascend in a group: once a partner is too large, all later ones are
        left = left[(group[other] == group[left]) & (n[other] * threshold.p <= n[left] * threshold.q)]
        a, b = left, left + step
        some = (part[a] != part[b]) & ((p[a] == q[a]) | (own[a] != own[b]))
        a, b = a[some], b[some]
        for k in range(0, len(a), at_once):
            x, y = a[k:k + at_once], b[k:k + at_once]
            if tell:
                fits = tell[1](about[x], about[y])
                x, y = x[fits], y[fits]
            fits = _most_common(cells[x], cells[y]) >= threshold.needed(n[x] + n[y])
            x, y = x[fits], y[fits]
            new = ~_met_before(known, x, y, key[x])
            out.append(np.stack([np.minimum(ids[x[new]], ids[y[new]]), np.maximum(ids[x[new]], ids[y[new]])]))
        step += 1
    pairs = np.unique(np.concatenate(out, 1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["least", "id"])


def settle(
    stars: DataFrame, classes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], cut: Cutter, threshold: Threshold,
    tell: Tell | None = None,
) -> DataFrame:
    """Groups of similar sets: (id, part) for every set that is linked with another.

    ``stars`` (key, least, id) are shared signatures, ``classes`` (id, n, histogram) the sets' sizes and histograms, and
    ``texts_of`` gives (id, text), once per set, of pairs (least, id); ``cut`` makes the sets of texts. With ``tell``, classes
    have what is told of each set in ``about``.

    First, every signature's members meet its smallest one. Members that this leaves in different groups are then compared
    with each other, so that no link between sets that share a signature is lost.
    """

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = pin(_pruned(pairs, classes, threshold, tell), "candidates")
        return pin(_similar(pairs, texts_of(pairs), cut), "links")

    pairs = stars.select("least", "id").distinct()
    parts = components(linked(pairs), "least", "id").toDF("id", "part")
    more = linked(_rest(stars, parts, classes, threshold, tell).join(pairs, ["least", "id"], "left_anti"))
    if more.isEmpty():
        return parts
    return components(parts.toDF("least", "id").unionByName(more), "least", "id").toDF("id", "part")
