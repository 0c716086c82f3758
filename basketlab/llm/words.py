"""The word rule that the operators share.

Words are runs of anything but the six ASCII blanks.  ``bytes.split`` without
arguments and ``bytes.lower`` follow exactly this rule and touch ASCII only, so text
is handled as UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# fixed value: the word pattern of the contracts
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def lower_words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of pairs from the 64-bit hashes of their parts; the order of the parts counts."""
    key = (left ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F) + right
    key = (key ^ key >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return key ^ key >> np.uint64(32)


def input_partitions(df: DataFrame) -> int:
    """Partitions that Spark cuts the input into: a size of the work that costs no pass over the data."""
    return max(1, df.rdd.getNumPartitions())


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into slices whose ``column`` holds about ``max_bytes``; a longer single value stays whole."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > max_bytes:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield batch.slice(begin)
