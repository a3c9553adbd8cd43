import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import corpora
import pytest

from tablework.llm import runs
from tablework.llm.queries import OPERATORS

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(words, least=24, times=3):
    """All runs, by comparing each word with the one a period later, for every period."""
    n, out, seen = len(words), [], set()
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if length >= max(least, times * p) and (i, length) not in seen:  # found with a smaller period before
                seen.add((i, length))
                out.append((i, length, p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for s, length, p in found for k in range(s + p, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def periodic_texts(seed, n=150):
    rng = random.Random(seed)
    out = [None, "", " \n", "a", " ".join("x" * 30), " ".join("ab" * 12), " ".join("abc" * 8), " ".join("ab" * 11 + "a")]
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(1, 7)):
            letters = [f"w{rng.randrange(4)}" for _ in range(rng.randrange(1, 14))]
            words += letters * rng.randrange(1, 12) if rng.random() < 0.6 else [f"w{rng.randrange(3)}" for _ in range(rng.randrange(60))]
            if rng.random() < 0.3:  # a run of runs
                words += words[-40:] * rng.randrange(1, 5)
        out.append(rng.choice([" ", "  ", "\n", " \t"]).join(words))
    return out


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 2), (4, 3), (1, 2), (30, 5)])
def test_runs_equal_brute_force(spark, least, times):
    texts = periodic_texts(least)
    got = runs.word_runs(corpora.frame(spark, list(enumerate(texts))), least=least, times=times).collect()
    assert len(got) == len(texts)
    for r in got:
        words = WORD.findall(texts[r.doc_id] or "")
        want = brute(words, least, times)
        assert [tuple(x) for x in r.runs] == want, texts[r.doc_id]
        assert r.n_words == len(words) and r.collapsed == collapsed(words, want)


def test_hard_rows(spark):
    df = corpora.hard(spark)
    got = runs.word_runs(df)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    rows = got.collect()
    assert len(rows) == df.count()
    assert all((r.collapsed == "" and r.runs == []) for r in rows if r.doc_id in (1, 2, 3))
    assert runs.word_runs(corpora.empty(spark)).collect() == []


def test_fewer_than_two_periods_are_refused(spark):
    with pytest.raises(ValueError):
        runs.word_runs(corpora.empty(spark), times=1)


def test_long_texts_of_few_words_stay_cheap(spark):
    """Ordered sets as long as the text: 200,000 equal words, and 200,000 of a period of two."""
    rows = [(1, "x " * 200_000), (2, "x y " * 100_000), (3, " ".join(f"w{k}" for k in range(200_000)))]
    start = time.perf_counter()
    got = {r.doc_id: (r.runs, r.collapsed[:20]) for r in runs.word_runs(corpora.frame(spark, rows)).collect()}
    assert [tuple(x) for x in got[1][0]] == [(0, 200_000, 1)] and got[1][1] == "x"
    assert [tuple(x) for x in got[2][0]] == [(0, 200_000, 2)] and got[2][1] == "x y"
    assert got[3][0] == []
    assert time.perf_counter() - start < 60


def test_ordered_sets_keep_their_order():
    rng = random.Random(3)
    numbers = rng.sample(range(100_000), 20_000)
    some = runs.Positions(numbers[0])
    for x in numbers[1:]:
        some.add(x)
    assert list(some) == sorted(numbers)
    have = set(numbers)
    for x in rng.sample(sorted(set(range(100_000)) - have), 300):
        below, above = some.around(x)
        assert below == max((y for y in numbers if y < x), default=-1) and above == min((y for y in numbers if y > x), default=-1)


def test_query_equals_brute_force(spark, tmp_path):
    """The planted periods and the digests, from the contract's words, on random texts and hard ones."""
    rng = random.Random(8)
    texts = periodic_texts(9, 100) + [
        " ".join(rng.choices([f"v{k}" for k in range(900)], k=rng.randrange(1, 400))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(None, "no id"), (5, texts[5])]
    corpora.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = OPERATORS["op12_periodic_runs"](spark, str(tmp_path)).collect()

    def want(doc_id, text):
        words = WORD.findall(text or "")
        n = len(words)
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if doc_id is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
                hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in found).encode()).hexdigest(),
                hashlib.sha256(collapsed(words, found).encode()).hexdigest())

    assert sorted(map(tuple, got), key=repr) == sorted((want(*r) for r in rows), key=repr)
    assert any(zlib.crc32(str(k).encode()) % 10 == 0 and r.n_runs for k, r in ((r.doc_id, r) for r in got))
