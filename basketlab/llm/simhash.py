"""SimHash near-duplicates found by multi-index hashing.

A fingerprint is cut into two segments of 32 bits.  Four differing bits leave at most
two in one of the segments, and two values at distance two or less share a value at
distance one or less from both.  So each distinct fingerprint is entered in the table
of each segment under the 33 values of the ball of radius one, and fingerprints that
meet in a table row are compared in full.  Inside a table row members are linked by
growing components, never by listing all pairs; connected components follow in Spark.

Scale: copies are one fingerprint before anything is listed, so a text that a third
of all rows repeat is one entry.  66 short entries for each distinct fingerprint are
shuffled once by table row.

Defined results: null and empty texts have fingerprint zero and link like any other;
fewer than four words make one shingle; a null id counts only when a group has no
other; repeated rows are returned once each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from basketlab.llm.components import connected_components
from basketlab.llm.runs import run_bounds, whole_runs
from basketlab.llm.words import lower_words
from basketlab.storage import materialize

SHINGLE = 4
SEED = 42
SEGMENT_BITS = 32
MAX_BITS = 4


def fingerprint(text: str | None) -> int:
    """Signed 64-bit value; a bit is set if over half of the shingle hashes set it."""
    words = lower_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
        starts = [0, *[e + 1 for e in ends]]
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :])])
    hashes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        counts += np.unpackbits(hashes[i : i + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = pa.array([fingerprint(t.as_py()) for t in batch.column(1)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), values, batch.column(2)], ["doc_id", "fp", "text_key"])


def _bits(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values.view(np.uint64))  # of a signed value it would count the absolute value's


def _row_links(values: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Links that join what the links of one table row join, at most one for each member."""
    left = values
    while left.size > 1:
        front, left = [left[0]], left[1:]
        while front and left.size:
            near = _bits(left ^ front[-1]) <= max_bits
            here = front.pop()
            found, left = left[near], left[~near]
            for other in found:
                yield int(here), int(other)
            front.extend(found)


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key -> links (a, b)."""
    for table in whole_runs(batches, "key"):
        fp = table.column("fp").to_numpy()
        begin, size = run_bounds(table.column("key").to_numpy())
        two = begin[size == 2]
        near = two[_bits(fp[two] ^ fp[two + 1]) <= max_bits]
        pairs = set(zip(fp[near].tolist(), fp[near + 1].tolist()))
        for b, n in zip(begin[size > 2], size[size > 2]):
            pairs.update(_row_links(fp[b : b + n], max_bits))
        a, b = zip(*pairs) if pairs else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that connect all within ``max_bits`` (4 at most) differing bits."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("two segments with balls of radius one find up to four differing bits")
    ball = SEGMENT_BITS + 1
    low = F.col("fp").bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
    high = F.shiftrightunsigned("fp", SEGMENT_BITS)
    entry = F.col("entry")
    bit = entry % ball
    flip = F.when(bit == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftleft(1L, cast(entry % {ball} - 1 as int))"))
    value = F.when(entry < ball, low.bitwiseXOR(flip)).otherwise(
        high.bitwiseXOR(flip).bitwiseOR(F.lit(1 << SEGMENT_BITS))
    )
    entries = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(2 * ball - 1))).alias("entry"))
    return (
        entries.select(value.alias("key"), "fp")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda batches: _links(batches, max_bits), "a long, b long")
    )


def _grouped(docs: DataFrame, id_col: str, text_col: str, max_bits: int) -> DataFrame:
    """(doc_id, text_key, fp, component, component_id) of every row; component tells groups apart also without ids."""
    text = F.col(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    marked = materialize(texts.mapInArrow(_fingerprints, "doc_id long, fp long, text_key long"), "simhash-fingerprints")
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    # written first: a task that finds links and joins them up would hold two Python workers
    found = connected_components(materialize(links(classes.select("fp"), max_bits), "simhash-links"))
    placed = classes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    firsts = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    return marked.join(materialize(placed.join(firsts, "component").drop("first"), "simhash-groups"), "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the smallest id reachable over links."""
    return _grouped(docs, id_col, text_col, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest id.

    A group without an id keeps one row too.  Of rows that share the smallest id, in one
    group, the text decides; rows that share an id in different groups stay.
    """
    firsts = _grouped(docs, id_col, text_col, max_bits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = firsts.groupBy("component").agg(F.min("doc_id").alias("kept_id"), F.min("text_key").alias("kept_key")).drop("component")
    # the row as one value, so no column of the documents can clash
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_key"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text_key"]).select("row.*")
