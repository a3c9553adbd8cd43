import re
from collections import defaultdict

import corpora
import numpy as np
import pytest

from tablework.llm import jaccard, lines
from tablework.llm.jaccard import Similarity
from tablework.llm.linking import Threshold


def _groups(sets, p=3, q=4):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and q * len(a & sets[j]) >= p * len(a | sets[j]):
                parent[find(i)] = find(j)
    out = defaultdict(list)
    for i in range(len(sets)):
        out[find(i)].append(i)
    return list(out.values())


def _shingles(text):
    lower = "".join(c.lower() if c < "\x80" else c for c in text or "")
    w = [x for x in re.split("[\x20\x09-\x0d]+", lower) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def _expected(rows):
    sets = [_shingles(t) for _, t in rows]
    out = []
    for group in _groups(sets):
        known = [rows[i][0] for i in group if rows[i][0] is not None]
        for i in group:
            out.append((rows[i][0], len(sets[i]), min(known) if known else None))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in jaccard.similar_documents(df).collect()), key=repr)


@pytest.mark.parametrize("seed", [1])
def test_same_groups_as_all_pairs(many_partitions, seed):
    rows = corpora.similar(seed)
    df = corpora.frame(many_partitions, rows).repartition(7)
    assert _got(df) == _expected(rows)


def test_hard_rows(spark):
    df = corpora.hard(spark)
    assert _got(df) == _expected([(r.doc_id, r.text) for r in df.collect()])


def test_empty_tables(spark):
    assert jaccard.similar_documents(corpora.empty(spark)).count() == 0
    assert lines.line_report(corpora.empty(spark)).count() == 0
    assert lines.drop_repeated_lines(corpora.empty(spark)).count() == 0


def test_similar_sets_share_a_signature_and_layouts_count_differences():
    rng = np.random.default_rng(5)
    similarity = Similarity()
    for size in (*range(1, 40), 77, 150, 400, 1000):
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 60, size, dtype=np.uint64))
            drop = int(rng.integers(0, max(1, len(a) // 4 + 1)))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 60, int(rng.integers(0, drop + 2)), dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if 4 * common < 3 * (len(a) + len(b) - common):
                continue
            for frequent in (0.0, 0.3, 1.0):
                often = set(a[rng.random(len(a)) < frequent].tolist())
                value, first = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
                flags = np.array([v in often for v in value.tolist()])
                owner, sign = jaccard.signatures(first, value, flags, similarity)
                assert set(sign[owner == 0].tolist()) & set(sign[owner == 1].tolist()), (size, drop, frequent)
    low = similarity.lows
    assert all(similarity.differences(h, h) >= 0 and h == l * 4 // 3 for l, h in zip(low, similarity.highs))
    assert any(len(similarity.layout(b).subsets) > 1 for b in range(20))


def test_threshold_arithmetic():
    t = Threshold(3, 4)
    assert t.needed(np.array([7, 14, 8])).tolist() == [3, 6, 4]
    assert t.differences(10, 11) == 3


def _normal(line):
    return re.sub("[\x20\x09-\x0d]+", " ", "".join(c.lower() if c < "\x80" else c for c in line)).strip(" ")


def _dropped(rows, least_words=5):
    found = [(d, t or "", k, _normal(x)) for d, t in rows for k, x in enumerate((t or "").split("\n"))]
    found = [x for x in found if x[3]]
    unique = sorted({x[3] for x in found})
    # a line of few words is linked with its copies only
    sets = [frozenset(n[i:i + 5] for i in range(max(1, len(n) - 4))) if n.count(" ") + 1 >= least_words or len(n) >= 20
            else frozenset([(n,)]) for n in unique]
    out = defaultdict(set)
    for group in _groups(sets):
        names = {unique[i] for i in group}
        places = [x[:3] for x in found if x[3] in names]
        first = min(places, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        for place in places:
            if place != first:
                out[place[:2]].add(place[2])
    return out


def _line_rows(seed=4):
    import random

    rng = random.Random(seed)
    words = [f"word{k}" for k in range(500)]
    base = [" ".join(rng.choices(words, k=rng.choice([2, 5, 9, 30]))) for _ in range(60)]
    rows = []
    for d in range(50):
        own = rng.sample(base, 6)
        own = [x.replace(rng.choice(x.split()), "changed", 1) if rng.random() < 0.3 and len(x) > 60 else x for x in own]
        rows.append((d, "\n".join([*own, "", "short line", own[0].upper()])))
    return rows


def test_lines_are_cut_like_text():
    import pyarrow as pa

    from tablework.llm.words import pieces

    rng = __import__("random").Random(8)
    texts = ["", "\n", "a\n", "\na", None, " x  Y\t\n\n z ", "é\n\n", "\n\n"]
    texts += ["".join(rng.choice("ab \n\tÉ") for _ in range(rng.randrange(40))) for _ in range(300)]
    for least in (0, 1, 2):
        for limit in (1, 50, 1 << 20):
            got = []
            for part in pieces(pa.array(texts, pa.string()), limit):
                text, number, cut = lines.cut_lines(part, least)
                raw = cut.data.tobytes()
                got += [(part.first_row + t, n, raw[a:b].decode()) for t, n, a, b in zip(
                    text.tolist(), number.tolist(), cut.offsets[:-1].tolist(), cut.offsets[1:].tolist())]
            want = [(k, n, _normal(x)) for k, t in enumerate(texts) for n, x in enumerate((t or "").split("\n"))]
            assert got == [x for x in want if x[2] and x[2].count(" ") + 1 >= least]


@pytest.mark.parametrize("least_words", [5, 1])  # the pipeline's and the query's
def test_lines_against_brute_force(many_partitions, least_words):
    rows = _line_rows()
    df = corpora.frame(many_partitions, rows).repartition(5)
    got = {r.doc_id: set(r.dropped) for r in lines.line_report(df, least_words=least_words).collect() if r.dropped}
    assert got == {d: k for (d, _), k in _dropped(rows, least_words).items()}


def test_sketches_are_those_of_the_sets():
    import pyarrow as pa

    from tablework.llm.words import pieces

    rng = __import__("random").Random(2)
    texts = ["ab" * 300, "x", "", "é" * 9, "中文" * 40] + ["".join(rng.choices("ab c", k=rng.randrange(400))) for _ in range(200)]
    for part in pieces(pa.array(texts, pa.string())):
        n, cells = lines._sketches(part)
        first, _ = lines._line_sets(part)
        assert n.tolist() == np.diff(first).tolist() == [len(_shingles_of(t)) for t in texts]
        assert cells.astype(int).sum(1).tolist() == n.tolist()


def test_sketches_do_not_depend_on_the_piece():
    import pyarrow as pa

    from tablework.llm.words import pieces

    few = next(iter(pieces(pa.array(["one line among few", "two"]))))
    many = next(iter(pieces(pa.array([*map(str, range(5000)), "one line among few"]))))
    assert lines._sketches(few)[1][0].tolist() == lines._sketches(many)[1][-1].tolist()


def _shingles_of(line):
    return {line[i:i + 5] for i in range(max(1, len(line) - 4))} if line else set()


def test_pairs_are_met_under_their_first_signature():
    from tablework.llm import linking

    known = np.full((4, linking.TELLING), linking._NONE)
    known[0, :3], known[1, :2], known[2, :2], known[3, :1] = [1, 5, 9], [5, 9], [7, 9], [2]
    a, b = np.array([0, 0, 0, 1, 0]), np.array([1, 1, 2, 2, 3])
    assert linking._met_before(known, a, b, np.array([5, 9, 9, 9, 9])).tolist() == [False, True, False, False, False]


def test_near_copies_leave_few_candidates(many_partitions, monkeypatch):
    """A thousand copies of one text with changes of their own: every pair shares signatures, often many."""
    import random

    from tablework.llm import linking

    rng = random.Random(6)
    base = rng.choices([f"w{k}" for k in range(400)], k=120)
    texts = []
    for _ in range(1000):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    seen, close = [], linking._rest

    def counted(*a, **k):
        rest = linking.pin(close(*a, **k), "rest")
        seen.append(rest.count())  # now, as steps are deleted once the result is written
        return rest

    monkeypatch.setattr(linking, "_rest", counted)
    df = corpora.frame(many_partitions, list(enumerate(texts))).repartition(6)
    got = _got(df)
    assert got == _expected(list(enumerate(texts)))
    assert seen[0] < 20_000  # of half a million pairs


def test_lines_of_hard_rows(spark):
    df = corpora.hard(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    report = lines.line_report(df).collect()
    assert len(report) == len(rows)
    want = {d: k for (d, _), k in _dropped(rows).items()}
    assert {r.doc_id: set(r.dropped) for r in report if r.dropped} == want
    kept = lines.drop_repeated_lines(df)
    assert kept.columns == df.columns
    texts = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    # the second of the equal long texts loses its only line, and goes; null and blank texts stay
    assert texts == sorted(((d, t) for d, t in rows if d != 6), key=repr)
