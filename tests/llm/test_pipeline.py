"""The pipeline against a plain version of all its stages."""

import math
import random

import public_tokenizers
import tiktoken
from test_linking import _dropped, _groups, _shingles
from test_operators import RANKS, _contaminated

import corpus_pipeline
from tablework.llm import toxicity

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def _corpus():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(900)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([8, 25])))) for k in range(12)]
    texts = [None, "", "  \n", "short"]
    for k in range(90):
        lines = [" ".join(rng.choices(words, k=rng.choice([3, 9, 25]))) for _ in range(rng.choice([1, 3, 5]))]
        if k % 6 == 0:
            lines[0] += " utter garbagehead person"
        if k % 7 == 0:
            lines.insert(0, "this line is in very many documents of the corpus")
        if k % 9 == 0:
            lines.append("before " + items[k % 12][1].upper() + " after")
        texts.append("\n".join(lines))
        if k % 5 == 0:
            # copies, whose lines go, and the same words in other lines, which only the documents' similarity tells
            texts += [texts[-1], texts[-1].replace("w1", "v1", 1), " ".join(texts[-1].split("\n"))]
    rng.shuffle(texts)
    docs = [(d, t, "en", None if d % 3 else "s", len(t or "")) for d, t in enumerate(texts)]
    return docs, [(d, 1, int("garbagehead" in (t or ""))) for d, t, *_ in docs if d % 4 != 1], items


def test_same_tokens_as_plain_stages(spark, tmp_path):
    docs, labels, items = _corpus()
    tables = (("documents", docs, DOCUMENTS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string"))
    for name, rows, schema in tables:
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    model = toxicity.learn(spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "labels.parquet")))
    scanner = toxicity.Scanner(list(model.terms))

    def toxic(text):
        x = model.intercept + sum(w * v for w, v in zip(model.weights, scanner.features(text or "")))
        return 1 / (1 + math.exp(-x)) >= corpus_pipeline.TOXIC

    left = [(d, t) for d, t, *_ in docs if not toxic(t)]
    assert 0 < len(left) < len(docs) and not any("garbagehead" in (t or "") for _, t in left)
    gone, cut = _dropped(left), []
    for d, t in left:
        if (d, t or "") in gone:
            t = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d, t])
            if not t.strip(" \t\n\x0b\x0c\r"):
                continue
        cut.append((d, t))
    kept = sorted(min(cut[i] for i in group) for group in _groups([_shingles(t) for _, t in cut]))
    bad = {x[0] for x in _contaminated(kept, items) if x[-1]}
    assert bad and len(kept) < len(cut) < len(left)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    want = [(d, encoding.encode_ordinary(t or "")) for d, t in kept if d not in bad]
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "ids", "round_trip").collect())
    assert got == [(d, ids, True) for d, ids in want]


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], DOCUMENTS)
    for name, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, str(tmp_path))
        assert out.schema.names == empty.schema.names and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, str(tmp_path)).count() == 0
