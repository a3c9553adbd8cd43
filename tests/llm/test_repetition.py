import random
import re

import corpora
import numpy as np

from tablework.llm import repetition
from tablework.llm.words import mix

WORD = re.compile("[^\x20\x09-\x0d]+")
SIZES = range(5, 11)


def brute(text):
    """The columns of a text, from their definitions."""
    text = text or ""
    words = WORD.findall(text)
    out = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": 0, "dup_line_chars": 0}
    seen = set()
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                out["n_dup_lines"] += 1
                out["dup_line_chars"] += sum(map(len, WORD.findall(line)))
            seen.add(line)
    for k in SIZES:
        places = {}
        for i in range(len(words) - k + 1):
            places.setdefault(tuple(words[i:i + k]), []).append(i)
        again = {j for at in places.values() for i in at[1:] for j in range(i, i + k)}
        out[f"dup_chars_{k}"] = sum(len(words[j]) for j in again)
        if k == 8:
            out["n_repeat_words"] = len({j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + k)})
    out["base_failed"] = len(words) < 20 or 100 * out["n_repeat_words"] > 30 * len(words)
    out["kept"] = (
        not out["base_failed"] and 100 * out["dup_line_chars"] <= 20 * out["word_chars"]
        and all(100 * out[f"dup_chars_{k}"] <= (20 - k) * out["word_chars"] for k in SIZES))
    return out


def repeating(seed, n=300):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        lines, vocabulary = [], [f"{'é' * rng.randrange(3)}w{k}" for k in range(rng.choice([2, 8, 60, 500]))]
        for _ in range(rng.randrange(1, 9)):
            if lines and rng.random() < 0.3:
                lines.append(rng.choice(lines) + rng.choice(["", "", " "]))
            else:
                lines.append(rng.choice([" ", "  ", "\t"]).join(rng.choices(vocabulary, k=rng.randrange(40))))
        out.append(rng.choice(["", " ", "#% "]) + "\n".join(lines) + rng.choice(["", "\n", "\r\n\n"]))
    return out


def _check(df):
    texts = [(r.doc_id, r.text) for r in df.collect()]
    got = repetition.repetition(df).collect()
    assert len(got) == len(texts)
    names = [c for c in got[0].asDict() if c != "doc_id"]
    key = lambda r: repr(r)
    want = sorted(((d, *(brute(t)[c] for c in names)) for d, t in texts), key=key)
    assert sorted(map(tuple, got), key=key) == want


def test_counts_equal_brute_force(spark):
    _check(corpora.frame(spark, list(enumerate(repeating(1)))))


def test_hard_rows(spark):
    _check(corpora.hard(spark))
    assert repetition.repetition(corpora.empty(spark)).collect() == []


def test_both_verdicts_occur(spark):
    rng = random.Random(2)
    fresh = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))
    rows = [(1, fresh), (2, "\n".join([fresh, "one two three four five six"] * 2)), (3, fresh + " " + " ".join(fresh.split()[:30]))]
    got = {r.doc_id: (r.base_failed, r.kept) for r in repetition.repetition(corpora.frame(spark, rows)).collect()}
    assert got == {1: (False, True), 2: (True, False), 3: (False, False)}


def test_windows_hash_alike_wherever_they_stand():
    values = mix(np.tile(np.arange(7, dtype=np.uint64), 9))
    rolling = repetition.Rolling(values)
    for size in (1, 5, 13):
        found = rolling.windows(np.arange(40), size)
        assert all((found[k] == found[j]) == (k % 7 == j % 7) for k in range(40) for j in range(40))
