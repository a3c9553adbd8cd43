"""Byte-level BPE: encode whole texts by a table of ranks, and decode ids to bytes."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from tablework.llm.words import pieces

#: distinct words that a task remembers; a forgotten word is folded again
REMEMBERED = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token per line, base64 then rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Merges:
    """Ranks of pairs of tokens, for folding many words at once."""

    #: longer words are folded one by one, with their pairs in a heap
    LONGEST = 64
    _NONE = 1 << 30

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {
            (ranks[token[:k]] << 32) + ranks[token[k:]]: rank
            for token, rank in ranks.items() for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or a large number."""
        key = (left << 32) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], self._NONE)

    def fold(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers.

        A word starts as its bytes; the leftmost pair of lowest rank is merged until no pair has a rank. A token's id
        is its rank, so that a pair's rank is the id of what it merges to. Words of one length are folded together.
        """
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if (whole := self.ranks.get(word)) is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(word) > self.LONGEST:
                out[i] = np.array(fold_long(word, self.ranks), "<u4").tobytes()
            else:
                by_length.setdefault(len(word), []).append(i)
        for length, those in by_length.items():
            if length:
                self._fold_equal(np.array(those), np.frombuffer(b"".join(words[i] for i in those), np.uint8), length, out)
        return out

    def _fold_equal(self, those: np.ndarray, letters: np.ndarray, length: int, out: list[bytes]) -> None:
        ids = self.byte[letters.reshape(-1, length)]
        worth = self._rank(ids[:, :-1], ids[:, 1:])
        while True:
            best = worth.argmin(1) if worth.shape[1] else np.zeros(len(ids), int)
            rank = worth[np.arange(len(ids)), best] if worth.shape[1] else np.full(len(ids), self._NONE)
            done = rank == self._NONE
            for i, row in zip(those[done].tolist(), ids[done].astype("<u4")):
                out[i] = row.tobytes()
            going = ~done
            if not going.any():
                return
            those, ids, worth, best, rank = those[going], ids[going], worth[going], best[going], rank[going]
            rows, width = np.arange(len(ids)), ids.shape[1] - 1
            ids[rows, best] = rank
            ids = ids[rows[:, None], np.arange(width) + (np.arange(width) > best[:, None])]
            if width > 1:
                worth = worth[rows[:, None], np.arange(width - 1) + (np.arange(width - 1) >= best[:, None])]
                right, left = np.flatnonzero(best < width - 1), np.flatnonzero(best > 0)
                worth[right, best[right]] = self._rank(ids[right, best[right]], ids[right, best[right] + 1])
                worth[left, best[left] - 1] = self._rank(ids[left, best[left] - 1], ids[left, best[left]])
            else:
                worth = worth[:, :0]


def fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same fold for one word of any length, in n log n steps."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins here
    alive = [True] * n
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        if not alive[i] or (j := end[i]) >= n or ranks.get(word[i:end[j]]) != rank:
            continue
        alive[j], end[i] = False, end[j]
        if end[i] < n:
            before[end[i]] = i
            if (r := ranks.get(word[i:end[end[i]]])) is not None:
                heapq.heappush(heap, (r, i))
        if before[i] >= 0 and (r := ranks.get(word[before[i]:end[i]])) is not None:
            heapq.heappush(heap, (r, before[i]))
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


def _class(kind: str, below: int) -> str:
    """The characters of a general category below a code point, for a character class."""
    return "".join(re.escape(c) for c in map(chr, range(below)) if unicodedata.category(c).startswith(kind))


class Splitter:
    """Finds the words of a text.

    Texts in Latin letters alone, the usual case, are cut by the standard library, which takes half the time; it
    lacks classes like \\p{L}, so their Latin members are listed. Other texts are cut by the pattern as it is.
    """

    _BELOW = 0x250

    def __init__(self, pattern: str):
        latin = pattern.replace("\\p{L}", "{L}").replace("\\p{N}", "{N}")
        letters, numbers = _class("L", self._BELOW), _class("N", self._BELOW)
        for name, members in (("{L}", letters), ("{N}", numbers)):
            # inside of a class the members, elsewhere a class of its own
            latin = re.sub(rf"(\[[^\]]*){re.escape(name)}", lambda m: m[1] + members, latin)
            latin = latin.replace(name, f"[{members}]")
        self.latin = None if "\\p" in latin else re.compile(latin)
        # the two libraries disagree on which of these are white space
        self.other = re.compile(f"[^\\x00-\\x1b\\x20-{chr(self._BELOW - 1)}]")
        self.any = regex.compile(pattern)

    def __call__(self, text: str) -> list[str]:
        if self.latin is None or self.other.search(text):
            return self.any.findall(text)
        return self.latin.findall(text)


class Encoder:
    """Encodes texts; each distinct word is folded once, as long as it is remembered."""

    PIECE_CHARS = 1 << 20

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges, self.words, self.known = Merges(ranks), Splitter(pattern), {}

    def __call__(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= self.PIECE_CHARS:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        found = [self.words(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*found).difference(self.known))
        self.known.update(zip(new, self.merges.fold([w.encode() for w in new])))
        for words in found:
            yield b"".join(map(self.known.__getitem__, words))


def _keep_rank_map(spark, ranks):
    """The rank table, shared with the tasks once; its size is that of the vocabulary, not of the data."""
    return spark.sparkContext.broadcast(ranks)


#: batches with one more column
Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _encoding(shared: Broadcast, pattern: str, text: str, ids: str) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(shared.value, pattern)
        for batch in batches:
            # ids take more than their texts, and a batch may have tens of megabytes of these
            for part in pieces(batch.column(text)):
                some = batch.slice(part.first_row, len(part))
                texts = (t.as_py() or "" for t in some.column(text))
                found = pa.array([np.frombuffer(x, "<i4") for x in encode(texts)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*some.columns, found], [*some.schema.names, ids])

    return run


def _decoding(shared: Broadcast, ids: str, out: str) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            # one row's ids at a time are Python numbers, each several times larger than in Arrow
            found = [
                b"".join(map(token.__getitem__, x.values.to_numpy().tolist())) if x.is_valid else None for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, out])

    return run


def encode_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with an array of token ids per text, in the column ``ids``.

    Each match of ``pattern`` is a word of its own; bytes are merged by rank within it. Null and empty texts have no
    ids. All other columns stay, and a column already named ``ids`` is replaced.
    """
    docs = docs.drop(ids)
    run = _encoding(_keep_rank_map(docs.sparkSession, ranks), pattern, text, ids)
    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(ids, ArrayType(IntegerType())))


def encode_and_decode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """``decode_ids`` of ``encode_texts``, one after the other on each batch, so that a task has one Python worker and not two."""
    docs = docs.drop(ids, out)
    shared = _keep_rank_map(docs.sparkSession, ranks)
    encode, decode = _encoding(shared, pattern, text, ids), _decoding(shared, ids, out)
    kind = StructType([*docs.schema.fields]).add(ids, ArrayType(IntegerType())).add(out, BinaryType())
    return docs.mapInArrow(lambda batches: decode(encode(batches)), kind)


def token_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id``, ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (of the bytes that the ids decode to). Texts are encoded, and the ids decoded, in one pass."""
    shared = _keep_rank_map(docs.sparkSession, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pieces = Encoder(shared.value, pattern), {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            counts, hashes, decoded = [], [], []
            for packed in encode(t.as_py() or "" for t in batch.column(1)):
                ids = np.frombuffer(packed, "<u4").tolist()
                counts.append(len(ids))
                hashes.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(b"".join(map(pieces.__getitem__, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                "n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode_ids(rows: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the bytes that their ids stand for, in the column ``out``; null ids give null."""
    rows = rows.drop(out)
    run = _decoding(_keep_rank_map(rows.sparkSession, ranks), ids, out)
    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add(out, BinaryType()))
