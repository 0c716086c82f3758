"""Timing marks from execution logs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketlab.functions.labels import LOG_PATTERNS, OPTIONAL_MARKS


# the start of a line: date with a year of four or two digits, time, optional fraction
STAMP = r"^\s*(?:\d\d)?(\d\d[-/]\d\d[-/]\d\d)[ T](\d\d:\d\d:\d\d(?:[.,]\d{1,6})?)"
PART = r"part-0*(\d+)[^/]*$"


def _stamp(line: Column) -> Column:
    """The time a line starts with, null without one."""
    day = F.translate(F.regexp_extract(line, STAMP, 1), "/", "-")
    time = F.translate(F.regexp_extract(line, STAMP, 2), ",", ".")
    return F.try_to_timestamp(F.concat(F.lit("20"), day, F.lit(" "), time))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with ``line_order``: time, number of the part file, file, split, line within the split.

    The time a line starts with comes first, so files may have any names; a line without
    a time counts as older than all that have one.  Among equal times the part files
    follow their number, not its text.  A split is read by one task in file order, so
    the last keys give the order of its lines however the files were cut into tasks.
    """
    file = F.col("_metadata.file_path")
    return spark.read.text(path).select(
        "value",
        F.struct(
            _stamp(F.col("value")).alias("time"),
            F.coalesce(F.regexp_extract(file, PART, 1).try_cast("long"), F.lit(-1).cast("long")).alias("part"),
            file.alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("line_order"),
    )


def log_marks(lines: DataFrame, patterns: Mapping[str, str] = LOG_PATTERNS) -> DataFrame:
    """Last value of every mark found: columns mark, value (text).

    One scan; each line is matched against all patterns and partial maxima are
    combined before the shuffle, so only one row per mark and task moves.
    """
    found = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(mark).alias("mark"),
                    F.regexp_extract("value", pattern, 1).alias("value"),
                )
                for mark, pattern in patterns.items()
            ]
        ),
        lambda hit: hit["value"] != "",
    )
    hits = lines.select(F.explode(found).alias("hit"), "line_order")
    return hits.groupBy(F.col("hit.mark").alias("mark")).agg(
        F.max_by("hit.value", "line_order").alias("value")
    )


def checked_timings(marks: DataFrame, patterns: Iterable[str] = LOG_PATTERNS) -> dict[str, object]:
    """Marks as numbers; a missing required mark is an error, a missing version is the running Spark's.

    The table holds at most one row per pattern.
    """
    values = {row["mark"]: row["value"] for row in marks.collect()}
    missing = [m for m in patterns if m not in OPTIONAL_MARKS and m not in values]
    if missing:
        raise ValueError(f"timing marks missing from the log: {', '.join(missing)}")
    timings: dict[str, object] = {
        mark: float(value) for mark, value in values.items() if mark not in OPTIONAL_MARKS
    }
    timings["spark_version"] = values.get("spark_version", marks.sparkSession.version)
    return timings
