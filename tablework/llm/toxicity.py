"""Toxic language: learned stems, found with misspellings by Levenshtein automata on a trie, weighed by context."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from tablework.session import pin

WORD = re.compile(r"[^\W\d_]+")
SHORTEST, LONGEST = 3, 12
#: words on either side of a term in which quotation marks count
WINDOW = 8
# fixed values: marks that open or close a quotation
QUOTES = frozenset("\"“”„«»‹›")


@dataclass(frozen=True)
class Term:
    """A stem, and how strongly it speaks for toxicity (log odds)."""

    stem: str
    weight: float


class Automaton:
    """Finds a stem at the start of a word, within a number of edits that depends on the stem's length.

    The Levenshtein automata of all stems run on their common trie: a state is a set of (node, edits spent), and
    states are joined with their letters' successors the first time they are met. A word costs one step per letter
    until no stem is left.
    """

    #: states kept before the table is built anew
    MOST_STATES = 200_000

    def __init__(self, terms: list[Term], fuzzy: bool = True):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, int] = {}  # node: term
        self.room = [0]  # most edits that any stem through a node allows
        for number, term in enumerate(terms):
            node, edits = 0, self.edits(term.stem) if fuzzy else 0
            self.room[0] = max(self.room[0], edits)
            for letter in term.stem:
                if letter not in self.children[node]:
                    self.children.append({})
                    self.room.append(0)
                    self.children[node][letter] = len(self.children) - 1
                node = self.children[node][letter]
                self.room[node] = max(self.room[node], edits)
            self.ends.setdefault(node, number)
        self.allowed = [self.edits(t.stem) if fuzzy else 0 for t in terms]
        self._start_over()

    @staticmethod
    def edits(stem: str) -> int:
        return 0 if len(stem) < 5 else 1 if len(stem) < 9 else 2

    def _start_over(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.best: list[tuple[int, int] | None] = []
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the nodes reached by leaving out letters of the stem; the fewest edits count."""
        todo = list(nodes.items())
        while todo:
            node, spent = todo.pop()
            if nodes.get(node, 9) < spent:
                continue
            for child in self.children[node].values():
                if spent + 1 <= self.room[child] and nodes.get(child, 9) > spent + 1:
                    nodes[child] = spent + 1
                    todo.append((child, spent + 1))
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        key = frozenset(nodes.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            found = [(e, self.ends[n]) for n, e in nodes.items() if n in self.ends and e <= self.allowed[self.ends[n]]]
            self.best.append(min(found, key=lambda x: (x[0], -len(self.terms[x[1]].stem), x[1])) if found else None)
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int:
        nodes: dict[int, int] = {}

        def reach(node: int, spent: int) -> None:
            if spent <= self.room[node] and nodes.get(node, 9) > spent:
                nodes[node] = spent

        for node, spent in self.sets[state]:
            for c, child in self.children[node].items():
                reach(child, spent + (c != letter))
            if node:  # a letter too many, but not before the first
                reach(node, spent + 1)
        self.steps[state][letter] = following = self._state(self._closed(nodes))
        return following

    def find(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the best stem that the word begins with, or None."""
        if len(self.sets) > self.MOST_STATES:
            self._start_over()
        state, found = self.start, None
        for letter in word:
            following = self.steps[state].get(letter)
            state = self._step(state, letter) if following is None else following
            if (here := self.best[state]) is not None and (found is None or here[0] <= found[0]):
                found = here
            if not self.sets[state]:
                break
        return found


FEATURES = ("weight", "exact", "quoted", "misspelled", "density")


class Scanner:
    """Features of texts; remembers which of the words it met hold a term."""

    MOST_WORDS = 1 << 19

    def __init__(self, terms: list[Term]):
        self.automaton, self.terms = Automaton(terms), terms
        self.clean: set[str] = set()
        self.hits: dict[str, tuple[int, int]] = {}

    def _learn(self, words: list[str]) -> None:
        if len(self.clean) > self.MOST_WORDS:
            self.clean.clear()
        for word in set(words).difference(self.clean).difference(self.hits):
            if (found := self.automaton.find(word)) is not None:
                self.hits[word] = found
            else:
                self.clean.add(word)
        if len(self.hits) > self.MOST_WORDS:
            self.hits.clear()
            self._learn(words)

    def matches(self, text: str) -> list[dict]:
        """Terms in a text: the word, its term, edits, character offset, and whether it stands in a quotation."""
        lower = text.lower()
        words = WORD.findall(lower)
        self._learn(words)
        if not self.hits or self.hits.keys().isdisjoint(words):
            return []
        spans, out = [(m.start(), m.end()) for m in WORD.finditer(lower)], []
        for k, word in enumerate(words):
            if (found := self.hits.get(word)) is None:
                continue
            left = lower[spans[max(0, k - WINDOW)][0]:spans[k][0]]
            right = lower[spans[k][1]:spans[min(len(spans) - 1, k + WINDOW)][1]]
            # inside a quotation that is still open here: an odd number of marks before, and one after
            quoted = sum(c in QUOTES for c in left) % 2 == 1 and any(c in QUOTES for c in right)
            out.append({"word": word, "term": self.terms[found[1]].stem, "edits": found[0], "at": spans[k][0],
                        "quoted": quoted, "weight": self.terms[found[1]].weight, "words": len(words)})
        return out

    def features(self, text: str) -> list[float]:
        found = self.matches(text)
        exact = [m for m in found if not m["edits"] and not m["quoted"]]
        return [
            max((m["weight"] for m in exact), default=0.0),
            math.log1p(sum(m["weight"] for m in exact)),
            math.log1p(sum(m["quoted"] for m in found)),
            math.log1p(sum(m["edits"] > 0 and not m["quoted"] for m in found)),
            100 * len(exact) / found[0]["words"] if found else 0.0,
        ]


def held_out(id) -> F.Column:
    """Rows that are kept from all learning."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents outside of the held-out ones, as (doc_id, text, label, fold).

    They are those with the smallest hashes of their ids, so the sample is the same for any layout; its size bounds the
    broadcast. A document with several labels counts as toxic if one of them says so; equal texts count once.
    """
    chosen = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sample = text.join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy(F.md5("text").alias("h")).agg(
        F.min_by(F.struct("doc_id", "text"), "doc_id").alias("d"), F.max("label").alias("label"))
    return sample.select("d.doc_id", "d.text", "label", (F.abs(F.xxhash64("h")) % 2).cast("int").alias("fold"))


def stem_counts(sample: DataFrame) -> DataFrame:
    """In how many documents of each fold and label a word begins with a stem: (stem, fold, label, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def told():
            rows = [(*key, n) for key, n in seen.items()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.int64()))],
                ["stem", "fold", "label", "n"])

        for batch in batches:
            for text, label, fold in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = set(WORD.findall(text.lower()))
                stems = {w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)}
                seen.update((s, fold, label) for s in stems)
            if len(seen) > 500_000:
                yield told()
                seen.clear()
        if seen:
            yield told()

    spread = sample.select("text", "label", "fold")
    counts = spread.mapInArrow(count, "stem string, fold int, label int, n long")
    return counts.groupBy("stem", "fold", "label").agg(F.sum("n").alias("n"))


def choose_terms(counts: DataFrame, sizes: dict[tuple[int, int], int], folds: tuple[int, ...], most: int = 4000) -> list[Term]:
    """Stems that are significantly more frequent in toxic documents of some folds.

    A stem's log-likelihood ratio must exceed twice the logarithm of the number of stems tried, so that chance lets
    through about one, however large the sample; at most ``most`` stems are kept. A stem that owes its documents to a
    chosen extension is left out, and so is an extension no more toxic than the chosen stem that it begins with.
    """
    toxic, clean = (sum(sizes.get((f, label), 0) for f in folds) for label in (1, 0))
    if not toxic or not clean:
        return []

    def total(label: int):
        return F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0)).cast("double")

    table = counts.filter(F.col("fold").isin(*folds)).groupBy("stem").agg(total(1).alias("t"), total(0).alias("c")).filter("t >= 3")

    def part(n, all_n):
        seen = F.col("t") + F.col("c")
        return F.when(n > 0, n * F.log(n / (seen * (all_n / (toxic + clean))))).otherwise(0.0)

    def rest(n, all_n):
        left = F.lit(float(toxic + clean)) - F.col("t") - F.col("c")
        return F.when(all_n - n > 0, (all_n - n) * F.log((all_n - n) / (left * (all_n / (toxic + clean))))).otherwise(0.0)

    ratio = 2 * (part(F.col("t"), toxic) + part(F.col("c"), clean)
                 + rest(F.col("t"), F.lit(float(toxic))) + rest(F.col("c"), F.lit(float(clean))))
    odds = F.log(((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("c") + 0.5) / (clean + 1)))
    tried = max(2, table.count())
    found = (
        table.select("stem", "t", "c", ratio.alias("g"), odds.alias("odds"))
        .filter((F.col("g") >= 2 * math.log(tried) + 2) & (F.col("odds") >= math.log(4)))
        .orderBy(F.desc("g"), F.desc(F.length("stem")), "stem").limit(most).collect()
    )
    least = 2 * math.log(tried) + 2
    chosen: dict[str, tuple[float, float, float]] = {}  # stem: log odds, toxic and clean documents
    for row in found:
        stem, t, c = row["stem"], row["t"], row["c"]
        shorter = next((stem[:k] for k in range(len(stem) - 1, 0, -1) if stem[:k] in chosen), None)
        if shorter:
            # worth a stem of its own only if it is much more toxic than its family
            base = chosen[shorter]
            if _odds(t, c, toxic, clean) < base[0] + 1 or _likelihood_ratio(t, c, base[1], base[2]) < least:
                continue
        else:
            # what is left without the extensions that already are stems
            below = [v for k, v in chosen.items() if k.startswith(stem)]
            t, c = max(0.0, t - sum(v[1] for v in below)), max(0.0, c - sum(v[2] for v in below))
            if below and (_likelihood_ratio(t, c, toxic, clean) < least or _odds(t, c, toxic, clean) < math.log(4)):
                continue
        chosen[stem] = (_odds(t, c, toxic, clean), t, c)
    return [Term(stem, odds) for stem, (odds, _, _) in chosen.items()]


def _odds(t: float, c: float, toxic: float, clean: float) -> float:
    """Log odds of a stem with ``t`` of ``toxic`` and ``c`` of ``clean`` documents."""
    return math.log(((t + 0.5) / (toxic + 1)) / ((c + 0.5) / (clean + 1)))


def _likelihood_ratio(t: float, c: float, toxic: float, clean: float) -> float:
    """How surprising these counts are if toxic and clean documents had the stem equally often."""
    out, share = 0.0, (t + c) / (toxic + clean)
    for n, of in ((t, toxic), (c, clean)):
        for seen, expected in ((n, of * share), (of - n, of * (1 - share))):
            out += seen * math.log(seen / expected) if seen > 0 and expected > 0 else 0.0
    return 2 * out


@dataclass(frozen=True)
class ToxicityModel:
    """A lexicon, and the weights of a text's features."""

    terms: tuple[Term, ...]
    weights: tuple[float, ...]
    intercept: float


def _featured(rows: DataFrame, terms: dict[int, list[Term]]) -> DataFrame:
    """(label, features) of sample rows, with the terms learned from the other fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanners = {f: Scanner(t) for f, t in terms.items()}
        for batch in batches:
            texts, labels, folds = (batch.column(i).to_pylist() for i in range(3))
            found = [scanners[f].features(t) for t, f in zip(texts, folds)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(float, labels), pa.float64()), pa.array(found, pa.list_(pa.float64()))], ["label", "features"])

    return rows.select("text", "label", "fold").mapInArrow(run, "label double, features array<double>")


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> ToxicityModel:
    """Fit the lexicon and its weights on at most ``sample_rows`` labelled documents outside of the held-out ones.

    Each half of the sample gets its features from stems of the other half, so that the weights know how well stems hold
    on texts they weren't learned from; the final lexicon is learned from both. Without toxic or without clean labels
    nothing is learned, and every text scores 0.
    """
    sample = pin(labelled_sample(docs, labels, sample_rows), "labelled")
    sizes = {(r["fold"], r["label"]): r["count"] for r in sample.groupBy("fold", "label").count().collect()}
    counts = pin(stem_counts(sample.repartition(max(8, sample.sparkSession.sparkContext.defaultParallelism))), "stems")
    terms = choose_terms(counts, sizes, (0, 1))
    if not terms:
        return ToxicityModel((), (0.0,) * len(FEATURES), -20.0)
    other = {f: choose_terms(counts, sizes, (1 - f,)) or terms for f in (0, 1)}
    rows = _featured(sample, other).select("label", array_to_vector("features").alias("features"))
    fitted = LogisticRegression(regParam=1e-3, maxIter=100).fit(rows)
    return ToxicityModel(tuple(terms), tuple(fitted.coefficients.toArray().tolist()), float(fitted.intercept))


def score_texts(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """The rows with a toxicity score from 0 to 1; null and empty texts have no term and score like any such text."""
    docs = docs.drop(out)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(list(model.terms))
        for batch in batches:
            scores = []
            for t in batch.column(at):
                x = model.intercept + sum(w * v for w, v in zip(model.weights, scanner.features(t.as_py() or "")))
                scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, x)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(out, DoubleType()))


def toxic_spans(docs: DataFrame, model: ToxicityModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per term found: (doc_id, word, term, edits, at, quoted); ``at`` counts in the lower-cased text."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(list(model.terms))
        for batch in batches:
            ids, out = batch.column(0), []
            for k, t in enumerate(batch.column(1)):
                out += [(k, m["word"], m["term"], m["edits"], m["at"], m["quoted"]) for m in scanner.matches(t.as_py() or "")]
            if out:
                k, *rest = zip(*out)
                kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(k, pa.int64())), *(pa.array(c, t) for c, t in zip(rest, kinds))],
                    ["doc_id", "word", "term", "edits", "at", "quoted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, word string, term string, edits int, at int, quoted boolean")
