"""Documents with everything that can go wrong, and random ones with copies and near copies."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, h string, norm string, key long, row long, n long, "
    "id long, part long, low long, high long, line int, doc string, words int, score_ double"
)
#: values of the columns whose names clash with names that operators use
CLASH = ("x", "y", 1, 2, 3, 4, 5, 6, 7, 8, "z", 9, 0.5)


def frame(spark, rows):
    """Rows of (doc_id, text[, lang]) with all the other columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, len(r[1] or ""), *CLASH) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def hard(spark):
    long_text = " ".join(f"w{k % 997}x{k % 31}" for k in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long_text), (6, long_text), (None, "no id here at all, none"),
        (None, "no id here at all, none"), (7, "same row"), (7, "same row"), (8, "A  b\tc\nD e f"), (9, "a b c d e f"),
        (10, "été 中文 \U0001f600 naïve"), (11, "x" * 50_000), (12, "?!  ... 12 3"),
    ]
    return frame(spark, rows)


def empty(spark):
    return frame(spark, [])


def similar(seed, groups=25, copies=6, words=60):
    """(doc_id, text) of groups of changed copies, with a passage that many documents share."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = " ".join(rng.choices(vocabulary, k=20))
    out = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([4, 7, 12, words, 3 * words]))
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(0, max(1, len(own) // 12) + 1)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            text = " ".join(own[rng.randrange(0, 3):])
            out.append(f"{passage} {text}" if g % 3 == 0 else text)
    rng.shuffle(out)
    return list(enumerate(out))
