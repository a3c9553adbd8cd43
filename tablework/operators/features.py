"""Scaling, encoding, term weights, splits and group means in SQL form."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.functions.hashing import hash_number
from tablework.operators.joins import lookup_join
from tablework.operators.position import global_position
from tablework.session import pin


def standard_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Add (x - mean) / population deviation of each column; a constant column gives 0."""
    stats = [s for c in columns for s in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]
    moments = df.agg(*stats).select(F.struct("*").alias("moments")).scalar()
    return (
        df.withColumn("_moments", moments)
        .withColumns(
            {
                f"{c}{suffix}": F.when(F.col(f"_moments.s_{c}") == 0, F.lit(0.0)).otherwise(
                    (F.col(c) - F.col(f"_moments.m_{c}")) / F.col(f"_moments.s_{c}")
                )
                for c in columns
            }
        )
        .drop("_moments")
    )


def scale_selected(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns scaled and first, the others unchanged behind them."""
    rest = [c for c in df.columns if c not in columns]
    scaled = standard_scale(df, columns)
    return scaled.select(*[F.col(f"{c}_scaled").alias(c) for c in columns], *rest)


def multi_hot_long(df: DataFrame, key: str, category: str) -> DataFrame:
    """(key, category, 1) for each category a key has."""
    return df.select(key, category).filter(F.col(category).isNotNull()).distinct().withColumn("value", F.lit(1))


def multi_hot(df: DataFrame, key: str, category: str, vocabulary: Sequence[str]) -> DataFrame:
    """One 0/1 column per vocabulary entry; entries outside the vocabulary are ignored."""
    flags = [F.max((F.col(category).eqNullSafe(F.lit(v))).cast("int")).alias(v) for v in vocabulary]
    return df.groupBy(key).agg(*flags)


def numbered_categories(df: DataFrame, category: str) -> DataFrame:
    """(category, index): the distinct categories in order, numbered from 0 across partitions, as a stored table."""
    found = df.select(category).filter(F.col(category).isNotNull()).distinct()
    return pin(global_position(found, [category], "index", unique=True), "categories")


def sparse_indicators(df: DataFrame, key: str, category: str, numbered: DataFrame | None = None) -> DataFrame:
    """Per key its categories as a sparse 0/1 row: (key, size, indices), where ``indices`` are the numbers of its
    categories in order and ``size`` is how many categories there are.

    No category reaches the driver, so that there may be as many as rows. ``numbered`` gives the numbers of an earlier
    table instead; categories it doesn't have are ignored, and a key without any has no indices. A key's list is one row.
    """
    numbered = numbered_categories(df, category) if numbered is None else numbered
    pairs = df.select(key, category).distinct()
    met = lookup_join(pairs, numbered, [category], "left")
    rows = met.groupBy(key).agg(F.array_sort(F.collect_set("index")).alias("indices"))
    size = numbered.agg(F.coalesce(F.max("index") + 1, F.lit(0)).alias("size")).scalar()
    return rows.select(key, size.alias("size"), "indices")


def indicator_vector(size: str, indices: str) -> Column:
    """A sparse row as a vector for a model."""
    return F.udf(lambda n, some: Vectors.sparse(n, some, [1.0] * len(some)), VectorUDT(), useArrow=False)(size, indices)


def vocabulary(df: DataFrame, category: str, limit: int = 10_000) -> list[str]:
    """Sorted distinct categories, to be used as columns; more than ``limit`` is an error."""
    rows = df.select(category).filter(F.col(category).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{category} has more than {limit} values; use the long form")
    return sorted(r[0] for r in rows)


#: bytes of texts whose words a task counts, sorts or joins; they take about twenty times as much memory
TASK_BYTES = 8 << 20


def term_counts(df: DataFrame, key: str, text: str, pattern: str = "[A-Za-z]+", tasks: int | None = None) -> DataFrame:
    """(key, term, tf): lower-cased matches of ``pattern`` per text, whose ``key`` is unique.

    Texts are distributed by key before they are cut, since a text is smaller than its words: the count per
    (key, term) then needs no further shuffle. ``tasks`` are those of the session, if not given.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(f"({pattern})"), F.lit(1))
    spread = df.select(key, text).repartition(*[tasks] if tasks else [], key)
    terms = spread.select(key, F.explode(found).alias("term")).select(key, F.lower("term").alias("term"))
    return terms.groupBy(key, "term").agg(F.count("*").alias("tf"))


def tfidf(df: DataFrame, key: str, text: str) -> DataFrame:
    """Weights (key, term, weight): count * (ln((1 + n) / (1 + df)) + 1), each row scaled to length 1.

    ``key`` is unique. The counts are stored, so that texts are cut into words once and not again for the document
    frequencies. A term that is in most texts has one count per text, and is joined apart from the others. Words are
    dealt to tasks by the bytes of their texts, so that a task's memory doesn't grow with the table.
    """
    whole = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")).first()
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-whole["bytes"] // TASK_BYTES))
    counts = pin(term_counts(df, key, text, tasks=tasks), "terms")
    seen = counts.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log((1 + F.lit(whole["n"]).cast("double")) / (1 + F.col("df"))) + 1
    weighted = lookup_join(counts, seen, ["term"], "inner", tasks=tasks).select(key, "term", (F.col("tf") * idf).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return weighted.repartition(tasks, key).select(key, "term", (F.col("w") / norm).alias("weight"))


def split_train_test(df: DataFrame, keys: Sequence[str], train_percent: int = 67, seed: int = 43) -> DataFrame:
    """Add ``is_train`` from a hash of the key: the same rows on any partitioning and on any rerun."""
    bucket = F.pmod(hash_number(seed, *keys), F.lit(100))
    return df.withColumn("is_train", bucket < train_percent)


def folds(df: DataFrame, keys: Sequence[str], n: int, seed: int = 7, name: str = "fold") -> DataFrame:
    """Add a fold number in [0, n) from a hash of the key."""
    return df.withColumn(name, F.pmod(hash_number(seed, *keys), F.lit(n)).cast("int"))


def group_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    """Sum, count and mean per group."""
    sums = df.groupBy(group).agg(F.sum(value).cast("double").alias("total"), F.count(value).alias("n"))
    return sums.withColumn("mean", F.try_divide("total", F.col("n").cast("double")))


def all_present(columns: Sequence[str]) -> Column:
    """True where no listed column is null; scoring rejects the other rows."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
