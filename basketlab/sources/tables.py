"""Readers for CSV, JSON-lines, Parquet and text, with fallbacks between sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from basketlab import versions
from basketlab.sources.schemas import BASKET_LINES

NO_SOURCE = "none"


def file_format(path: str) -> str:
    name = path.rstrip("/").lower()
    for ending, kind in ((".csv", "csv"), (".json", "json"), (".jsonl", "json"), (".txt", "text")):
        if name.endswith(ending):
            return kind
    return "parquet"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read one table: its current version, or what plain files lie at the path.

    The manifest of a versioned table names the format, otherwise it follows from the
    ending of the path.  CSV needs a schema, because inferring it is another full pass
    over the file.
    """
    stored = versions.current(spark, path)
    kind, path = (file_format(path), path) if stored is None else (stored.kind, stored.folder)
    reader = spark.read
    if kind == "csv":
        if schema is None:
            raise ValueError("a CSV table needs an explicit schema")
        reader = reader.option("header", True)
    if schema is not None and kind != "text":
        reader = reader.schema(schema)
    df = reader.format(kind).load(path)
    return df.select(*columns) if columns else df


def read_if_exists(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame | None:
    """The table, or None when nothing lies at the path."""
    try:
        return read_table(spark, path, schema, columns)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def count_or_zero(spark: SparkSession, path: str, schema: T.StructType | None = None) -> int:
    df = read_if_exists(spark, path, schema)
    return 0 if df is None else df.count()


def read_first_available(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType
) -> tuple[DataFrame, str]:
    """The first table that exists and has a row, and the path that served it.

    With nothing available: an empty DataFrame and ``none``.
    """
    for path in paths:
        df = read_if_exists(spark, path, schema)
        if df is not None and not df.isEmpty():
            return df, path
    return spark.createDataFrame([], schema), NO_SOURCE


def with_source(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source", F.lit(source))


def read_baskets_json(spark: SparkSession, path: str) -> DataFrame:
    """Baskets from JSON lines ``{"order_id": .., "items": [..]}``."""
    return read_table(spark, path, BASKET_LINES)


def read_stored(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]
) -> DataFrame:
    """Chosen fields of a stored result."""
    return read_table(spark, path, schema, columns)
