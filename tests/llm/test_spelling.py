import random
import re
import zlib

import corpora
import pytest

from tablework.llm import spelling
from tablework.llm.queries import OPERATORS


def edits(word, alphabet):
    cut = {word[:k] + word[k + 1:] for k in range(len(word))}
    changed = {word[:k] + c + word[k + 1:] for k in range(len(word)) for c in alphabet}
    longer = {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in alphabet}
    return (cut | changed | longer) - {word}


def brute(counts):
    alphabet = {c for w in counts for c in w}
    near = {w: edits(w, alphabet) & counts.keys() for w in counts}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out, key=repr)


def random_words(seed, n=400, letters="abcé"):
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(n)}
    words |= {w * 20 for w in rng.sample(sorted(words), 20)}  # in the shard of long words
    words |= {w[:-1] for w in words if len(w) > 60} | {w + "a" for w in words if len(w) > 60} | {"a" * 64, "a" * 65, "a" * 63}
    return {w: rng.choice([3, 4, 6, 7, 12, 30, 70]) for w in words}


def _variants(spark, counts):
    frame = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    return sorted(map(tuple, spelling.variants(frame).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed):
    counts = random_words(seed)
    assert _variants(spark, counts) == brute(counts)


def test_other_scripts_and_long_words(spark):
    counts = {"中文字": 3, "中文": 9, "中国文": 4, "\U0001f600ab": 3, "\U0001f601ab": 7, "z" * 3000: 5, "z" * 2999: 11}
    assert _variants(spark, counts) == brute(counts)


def test_many_passes_and_parts_give_the_same(spark, monkeypatch):
    """Filters too large for one pass: a length in several parts, lengths in several passes."""
    counts = random_words(3, 600)
    monkeypatch.setattr(spelling, "LEAST_BLOCKS", 4)
    monkeypatch.setattr(spelling, "PASS_BLOCKS", 16)
    some = spelling.shards({k: sum(min(len(w), 64) == k for w in counts) for k in range(1, 65)})
    assert max(s.parts for s in some) > 1 and len(spelling.passes(some)) > 3
    assert all(sum(s.blocks for s in p) <= 16 for p in spelling.passes(some))
    assert _variants(spark, counts) == brute(counts)


def test_long_chains_reach_their_end(spark):
    counts = {"a" * k: 3 * 2 ** k for k in range(1, 40)}
    assert _variants(spark, counts) == brute(counts)


def test_empty_vocabulary(spark):
    assert _variants(spark, {}) == []
    words = spelling.text_words(corpora.empty(spark))
    assert spelling.vocabulary(words).collect() == []


def test_query_equals_brute_force(spark, tmp_path):
    """Runs, planted slips and counts from the contract's words, on random texts and hard ones."""
    rng = random.Random(4)
    base = sorted(w * 2 for w in random_words(5, 120) if 2 < len(w) < 9)
    texts = [" ".join(rng.choice([w, w.capitalize(), w.upper(), w + "-x1"]) for w in rng.choices(base, k=80)) for _ in range(120)]
    rows = list(enumerate(texts)) + [
        (None, "Null Null nulls nulls nulls Nulla"), (5, texts[5]), (7, None), (8, ""), (9, "×÷×÷×" * 3), (10, "x" * 20_000)]
    corpora.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = OPERATORS["op13_spelling_variants"](spark, str(tmp_path)).collect()

    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert len(counts) > 100 and sorted(map(tuple, got), key=repr) == brute(counts)
