"""Target-distribution importance resampling with prefix CRCs.

Features are all runs of one to three words; a feature falls into one of 10,000 buckets
by its CRC-32.  A bucket's gain is the floored log ratio of its smoothed share in the
target texts to that in all documents; a document's weight is the sum over its features.
Adding Gumbel noise drawn from the id and keeping the highest scores draws documents
without replacement in proportion to exp(weight / 1000).

A text is normalised to its words, each after one blank, and scanned once; the running
CRC is stored after each word.  As the CRC of a text AB is the CRC of A, moved by the
length of B, xor the CRC of B, two stored prefixes give the CRC of any run between
them: the first is moved by the run's length and cancelled.  Moving by n bytes is a
linear map over GF(2), kept as tables for each base-256 digit of n, so a whole batch of
runs is derived at once.

Scale: two passes over the texts where they lie.  Counts are a table of 10,000 numbers
whatever the input.  Ranks come from a range-partitioned sort of narrow rows, numbered
within each partition and moved by the sizes of the partitions before it.

Defined results: null and empty texts have no features and weight 0; a null id draws
its noise from an empty id and comes last among ties; repeated rows are documents of
their own, equal ones in any order; without target texts every gain follows from the
corpus alone; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from basketlab.llm.counting import count_table
from basketlab.llm.words import slices
from basketlab.operators.order import numbered
from basketlab.storage import materialize

# fixed values of the contract
BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42

POLYNOMIAL = 0xEDB88320
BATCH_BYTES = 1 << 20

# letters a-z, digits and all bytes beyond ASCII belong to words
_CLEAN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


def clean_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_CLEAN).split() if text else []


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


_BYTE = _byte_table()


def _step(register: np.ndarray) -> np.ndarray:
    """The CRC register after one zero byte."""
    return _BYTE[register & 0xFF] ^ (register >> 8)


def _apply(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map, given by its values for each of the four bytes."""
    return table[0][values & 255] ^ table[1][values >> 8 & 255] ^ table[2][values >> 16 & 255] ^ table[3][values >> 24]


def _powers(one: np.ndarray) -> np.ndarray:
    """The maps of 0 to 255 times a map."""
    out = [np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]]
    for _ in range(255):
        out.append(_apply(one, out[-1]))
    return np.stack(out)


def _shift_tables(digits: int = 4) -> list[np.ndarray]:
    one = _step(np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None])
    tables = []
    for _ in range(digits):
        tables.append(_powers(one))
        one = _apply(one, tables[-1][255])
    return tables


_SHIFT = _shift_tables()


def shift(crcs: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """CRCs moved over as many bytes: what they add to the CRC of a longer text."""
    for digit, table in enumerate(_SHIFT):
        times = n_bytes >> 8 * digit & 255
        if digit == 0 or times.any():
            crcs = (
                table[times, 0, crcs & 255]
                ^ table[times, 1, crcs >> 8 & 255]
                ^ table[times, 2, crcs >> 16 & 255]
                ^ table[times, 3, crcs >> 24]
            )
    return crcs


def _running(words: list[bytes]) -> list[int]:
    """The CRC before the first word and after each, every word with a blank before it."""
    return list(accumulate([b" " + w for w in words], lambda crc, w: crc32(w, crc), initial=0))


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of words of each text; CRC of each feature, and the text it belongs to."""
    words = [clean_words(t) for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    after = np.array([crc for w in words for crc in _running(w)], np.uint32)
    # the register after one blank more: where a word itself begins
    begin = ~(_BYTE[(~after ^ np.uint32(0x20)) & 0xFF] ^ (~after >> 8))
    length = np.array([n for w in words for n in (0, *[len(x) + 1 for x in w])], np.int64)
    place = np.cumsum(length)
    doc = np.repeat(np.arange(len(words)), n_words + 1)
    crcs, owners = [], []
    for n in range(1, LONGEST + 1):
        first = np.flatnonzero(doc[:-n] == doc[n:])
        last = first + n
        crcs.append(after[last] ^ shift(begin[first], place[last] - place[first] - 1))
        owners.append(doc[first])
    return n_words, np.concatenate(crcs), np.concatenate(owners)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for part in slices(batch, "text", BATCH_BYTES):
        n_words, crcs, owners = features(part.column("text").to_pylist())
        yield part, n_words, crcs % BUCKETS, owners


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features in each bucket, over a column of texts."""
    return count_table(texts, lambda batch: (buckets for _, _, buckets, _ in _parts(batch)), BUCKETS, 250)


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed shares."""
    t_all, s_all = float(target.sum() + BUCKETS), float(corpus.sum() + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for t, s in zip(target.tolist(), corpus.tolist())],
        np.int64,
    )


def _weights(gain: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, n_words, buckets, owners in _parts(batch):
                n = len(n_words)
                held = [
                    np.bincount(owners, minlength=n).astype(np.int64),
                    np.bincount(owners, gain[buckets], minlength=n).astype(np.int64),  # sums far below 2**53
                ]
                columns = [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in (n_words, *held)]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return weigh


def gumbel(doc_id: Column) -> Column:
    """Noise in thousandths, drawn from the id."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; rank is null for documents not drawn.

    ``target`` has a column of texts of the same name.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    gain = gains(bucket_counts(target.select(F.col(text_col).alias("text"))), bucket_counts(texts.select("text")))
    weighed = texts.mapInArrow(_weights(gain), "doc_id long, n_words long, n_features long, weight long")
    # rows without an id may be equal in all columns; their number spreads them over the sorted partitions
    weighed = materialize(weighed.withColumn("row", F.monotonically_increasing_id()), "weights")
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id")))
    long_enough = F.col("n_words") >= min_words
    order = [long_enough.desc(), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranked = numbered(scored, order, "place", "scored-documents")
    drawn: int = weighed.where(long_enough).count() * percent // 100
    return ranked.select(
        "doc_id", "n_words", "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    )


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents drawn, with all their columns; rows that share an id are drawn together."""
    ids = resample(docs, target, id_col, text_col, percent).where(F.col("rank").isNotNull()).select("doc_id").distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("key"))
    return whole.join(ids, F.col("key").eqNullSafe(F.col("doc_id")), "left_semi").select("row.*")
