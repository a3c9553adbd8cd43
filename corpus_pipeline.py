"""From raw documents to tokens: toxic documents go, repeated lines go, of similar documents one stays, contaminated
documents go, and what is left is encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import bpe, contamination, jaccard, lines, toxicity
from tablework.session import pin, prepare

#: score from which a document is toxic
TOXIC = 0.3


def _free(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that the documents don't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a key that orders them by id, nulls last, then text, and differs for all rows, and the key's
    name. Written once, as row numbers depend on how rows are read."""
    name = _free(docs, "key")
    key = F.struct(
        F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"),
        F.monotonically_increasing_id().alias("row"))
    return pin(docs.withColumn(name, key), "numbered"), name


def _without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Numbered documents without the rows whose keys are in ``gone``."""
    other = _free(docs, "gone")
    gone = pin(gone.select(F.col("doc_id.row").alias(other)), "gone")
    return docs.join(gone, F.col(key)["row"] == F.col(other), "left_anti").drop(key)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit; lexicon and weights are learned from the labels. Each row is judged by its own
    text, so rows that repeat an id, or have none, stay or go one by one; a null text has the score of an empty one."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _free(docs, "toxic_score")
    return toxicity.score_texts(docs, model, out=score).filter(F.col(score) < TOXIC).drop(score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document has, copies of any length and similar lines of some; a document of which
    nothing is left goes. Rows that repeat id and text are one document; null and blank texts have no line and stay."""
    kind = docs.schema["n_chars"].dataType
    left = lines.drop_repeated_lines(docs)
    return left.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that are linked by similarity, one: that with the smallest id, a null id only if no row has another."""
    rows, key = _numbered(docs)
    found = jaccard.similar_documents(rows, id=key)
    return _without(rows, key, found.filter("doc_id.row <> component_id.row"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that don't hold benchmark windows in one word of twenty, each judged by its own text."""
    rows, key = _numbered(docs)
    found = contamination.contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id=key)
    return _without(rows, key, found.filter("contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's text, and whether they decode to its very bytes; a null text has no token."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    texts = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    coded = bpe.encode_and_decode(texts, ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.encode("text", "UTF-8")).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", drop_similar),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: tokens can't be computed in SQL; the tests hold the pipeline against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each but the last is written and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
