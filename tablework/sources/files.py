"""Delimited, JSON and mixed file deliveries."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.text import route


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, *, encoding: str = "UTF-8",
    glob: str | None = None,
) -> DataFrame:
    """CSV with a header row and a declared schema; a value that does not fit becomes null."""
    reader = spark.read.schema(schema).option("header", True).option("encoding", encoding)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path if isinstance(path, str) else list(path))


# kinds of text that a column may hold, the first that fits all its values wins: type, shape
_KINDS = [
    ("boolean", r"(?i)^(true|false)$"), ("int", r"^[+-]?\d+$"), ("bigint", r"^[+-]?\d+$"),
    ("double", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), ("date", r"^\d{4}-\d{2}-\d{2}$"),
    ("timestamp", r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}.*$"),
]


def _filled(column: str) -> Column:
    """The text of a cell without outer spaces; an empty one is missing."""
    return F.nullif(F.trim(F.col(f"`{column}`")), F.lit(""))


def infer_types(text: DataFrame) -> T.StructType:
    """The types of columns of text, from the votes of all their values in one aggregation.

    A column gets the first of boolean, int, bigint, double, date and timestamp that every value has the shape and range
    of. Missing values have no vote, so that integers with gaps stay integers; a column without a value is text.
    """
    votes = [
        F.array(F.count(_filled(c)), *[
            F.count_if(_filled(c).rlike(shape) & _filled(c).try_cast(kind).isNotNull()) for kind, shape in _KINDS
        ]).alias(f"v{k}")
        for k, c in enumerate(text.columns)]
    if not votes:
        return T.StructType()
    counted = text.agg(*votes).first()
    out = T.StructType()
    for c, (n, *fitting) in zip(text.columns, counted):
        kind = next((kind for (kind, _), k in zip(_KINDS, fitting) if n and k == n), "string")
        out = out.add(T.StructField(c, T.StringType() if kind == "string" else _TYPES[kind]))
    return out


_TYPES = {
    "boolean": T.BooleanType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp": T.TimestampType()}


def infer_csv(spark: SparkSession, path: str, *, encoding: str = "UTF-8") -> DataFrame:
    """CSV with the types that its values agree on, for looking at a new delivery; jobs declare their schema."""
    text = spark.read.option("header", True).option("encoding", encoding).csv(path)
    types = infer_types(text)
    return text.select(*[
        (F.col(f"`{f.name}`") if f.dataType == T.StringType() else _filled(f.name).try_cast(f.dataType)).alias(f.name)
        for f in types])


def _without_first(lines: DataFrame, n: int) -> DataFrame:
    """Lines of files, with their ``_metadata``, without the first ``n`` of each file, whatever their text.

    These are in the file's first split, so only that split's lines are numbered; the rest stays spread over tasks.
    """
    marked = lines.withColumns({
        "_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.file_block_start"), "_line": F.monotonically_increasing_id()})
    in_file = Window.partitionBy("_file").orderBy("_line")
    first = marked.filter("_at = 0").withColumn("_n", F.row_number().over(in_file)).filter(F.col("_n") > n).drop("_n")
    return first.unionByName(marked.filter("_at > 0"))


def read_titled_csv(spark: SparkSession, path: str, schema: T.StructType, titles: int = 1) -> DataFrame:
    """Text export of a sheet whose column names follow ``titles`` title lines, as in a spreadsheet.

    The first ``titles + 1`` lines of each file are left out by their position.
    """
    body = _without_first(spark.read.text(path), titles + 1)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return body.select(F.from_csv("value", ddl).alias("r")).select("r.*")


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, *, whole_file: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """JSON lines, or with ``whole_file`` one record or one array of records per file."""
    reader = spark.read.schema(schema).option("multiLine", whole_file)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path if isinstance(path, str) else list(path))


def read_manifest(spark: SparkSession, manifest: str, schema: T.StructType | str, *, encoding: str = "UTF-8") -> DataFrame:
    """Load exactly the CSV files listed in a manifest ``{"entries": [{"url", "mandatory"}]}``.

    A missing mandatory file is an error, a missing optional one is left out. Names are taken as they are, also with
    commas, brackets or stars. The list of file names, not their rows, passes through the driver, as it does for any
    path list.
    """
    entries = spark.read.option("multiLine", True).schema(
        "entries array<struct<url: string, mandatory: boolean>>"
    ).json(manifest).select(F.inline("entries"))
    present = [r["url"] for r in entries.collect() if r["mandatory"] or path_exists(spark, r["url"])]
    if not present:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("header", True).option("encoding", encoding)
    return reader.option("ignoreMissingFiles", False).csv([_literal(url) for url in present])


def path_exists(spark: SparkSession, url: str) -> bool:
    """Whether there is a file or folder, in whatever store the path is of."""
    path = spark._jvm.org.apache.hadoop.fs.Path(url)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _literal(url: str) -> str:
    """A path whose pattern signs stand for themselves."""
    return "".join(f"\\{c}" if c in "\\{}[]*?^" else c for c in url)


def file_path() -> Column:
    """Path of the file a row came from (file sources only)."""
    return F.col("_metadata.file_path")


def read_routed(
    spark: SparkSession, folder: str, routes: Mapping[str, str], glob: str = "*.csv", header: bool = False
) -> DataFrame:
    """Raw lines of a mixed folder with the table each belongs to, by a fragment of the path below ``folder``; with
    ``header`` the first line of each file is left out."""
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(folder)
    path = file_path()
    if header:
        lines, path = _without_first(lines, 1), F.col("_file")
    below = F.substring_index(path, folder.rstrip("/").rpartition("/")[2] + "/", -1)
    return lines.select(route(below, routes).alias("table_name"), below.alias("file_name"), "value")


def read_split_table(
    spark: SparkSession, folder: str, fragment: str, schema: T.StructType | str, *, encoding: str = "UTF-8"
) -> DataFrame:
    """All parts of one table of a split delivery, ``<fragment>_<index>_<date>.csv``."""
    return read_csv(spark, folder, schema, encoding=encoding, glob=f"*{fragment}*.csv")


def encoding_audit(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """One verdict per file: ``ascii``, ``utf-8`` or ``latin-1``, from all of its bytes; an empty file is ``ascii``.

    The text source hands on the bytes of each line unchanged, so files are checked in splits, not whole. Empty files
    have no line; their names come from the list of files that the driver holds for any read.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path if isinstance(path, str) else list(path))
    level = (
        F.when(~F.is_valid_utf8("value"), 2).when(F.octet_length("value") > F.char_length("value"), 1).otherwise(0)
    )
    worst = lines.select(F.col("_metadata.file_path").alias("file_path"), level.alias("level")).groupBy(
        "file_path"
    ).agg(F.max("level").alias("level"))
    listed = spark.createDataFrame([(re.sub("^file:/+", "file:/", f), 0) for f in lines.inputFiles()], worst.schema)
    worst = worst.unionByName(listed).groupBy("file_path").agg(F.max("level").alias("level"))
    names = F.array(F.lit("ascii"), F.lit("utf-8"), F.lit("latin-1"))
    return worst.select("file_path", F.get(names, F.col("level")).alias("encoding"))
