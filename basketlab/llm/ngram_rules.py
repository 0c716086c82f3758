"""Quality rules: fixed text rules, then a hashed n-gram likelihood ratio.

Trusted documents (labelled good and not toxic) and the raw corpus each give counts of
hashed byte trigrams over all their texts.  A document's score is the mean over its
trigrams of log P(trusted) - log P(raw), both smoothed by one count for each bucket.
Documents under ``threshold`` (nats for each trigram) are rejected, the same for every
document and size.  Bytes keep their case: shouting and symbols show.

Scale: each task counts into an array of ``1 << bits`` numbers and sends it in blocks,
which are added by block; the summed table is bounded by the number of buckets and goes to the
tasks with the scoring function.  Finding the trusted texts moves the texts once, in a
sort-merge join by id; everything else is read where it lies.

Defined results: null and empty texts have zeros, fail the base rules and are not kept;
without trusted documents the method's verdict is to keep; repeated labels of an id
count as bad if one of them does; a null id has no label; repeated rows are documents
of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# fixed values of the base rules
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

ORDER = 3
BITS = 16
THRESHOLD = -1.0
BLOCK = 256


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, first occurrences included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    if len(number) == len(words):
        return 0
    key = np.zeros(n, np.uint64)
    for i in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + n] + np.uint64(1)
    _, first, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    twice = count[back] > 1
    rows = np.lib.stride_tricks.sliding_window_view(ids, window)
    if (rows[twice] != rows[first[back[twice]]]).any():  # two windows share a hash
        seen = Counter(map(tuple, rows.tolist()))
        twice = np.array([seen[tuple(r)] > 1 for r in rows.tolist()])
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def base_rules(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeats = repeated_words(words)
    return (
        len(words),
        len(text) - len(data) + len(data.translate(None, BLANKS)),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        len(words) < MIN_WORDS or 100 * repeats > MAX_REPEATED_PERCENT * len(words),
    )


def buckets(text: str | None, bits: int = BITS) -> np.ndarray:
    """Hashed byte n-grams of the whole text."""
    data = np.frombuffer((text or "").encode(), np.uint8).astype(np.uint64)
    n = len(data) - ORDER + 1
    if n < 1:
        return np.empty(0, np.int64)
    key = np.zeros(n, np.uint64)
    for i in range(ORDER):
        key = (key << np.uint64(8)) | data[i : i + n]
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << bits, np.int64)
    for batch in batches:
        for text in batch.column(0):
            b = buckets(text.as_py(), bits)
            if len(b) > len(total) // 8:
                total += np.bincount(b, minlength=len(total))
            else:
                np.add.at(total, b, 1)
    yield _blocks(dict(enumerate(total.reshape(-1, BLOCK))))


def _blocks(blocks: dict[int, np.ndarray]) -> pa.RecordBatch:
    """A row for each block of neighbouring buckets that has a count."""
    held = {i: n.tobytes() for i, n in blocks.items() if n.any()}
    columns = [pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["block", "counts"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[block] = total.get(block, 0) + np.frombuffer(counts, np.int64)
    yield _blocks(total)


def bucket_counts(texts: DataFrame, bits: int = BITS) -> np.ndarray:
    """Counts of all n-grams of a column of texts; as long as there are buckets."""
    schema = "block long, counts binary"
    counted = texts.mapInArrow(lambda x: _count(x, bits), schema).repartition("block").mapInArrow(_add, schema)
    out = np.zeros((1 << bits) // BLOCK * BLOCK).reshape(-1, BLOCK)
    for row in counted.collect():  # a row for each block
        out[row["block"]] += np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def log_ratio(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not trusted.any():
        return np.zeros(len(raw))
    smooth = lambda n: np.log((n + 1) / (n.sum() + len(n)))
    return smooth(trusted) - smooth(raw)


def trusted_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    good = good.where("quality = 1 and toxic = 0").select(F.col("doc_id").alias("trusted"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # the table of trusted ids grows with the corpus, so it is not broadcast at any size
    return texts.join(good.hint("merge"), F.col("doc_id") == F.col("trusted"), "left_semi").select("text")


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
     ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
     ("log_ratio", pa.float64()), ("kept", pa.bool_())]
)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = BITS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Counts of the base rules, the score and the verdict for every row; labels are (doc_id, quality, toxic)."""
    raw = bucket_counts(docs.select(text_col), bits)
    ratio = log_ratio(bucket_counts(trusted_texts(docs, labels, id_col, text_col), bits), raw)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                rules, b = base_rules(text), buckets(text, bits)
                mean = float(ratio[b].mean()) if len(b) else 0.0
                rows.append((doc_id, *rules, mean, not rules[-1] and mean >= threshold))
            columns = list(zip(*rows)) if rows else [()] * len(_OUT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        score,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, log_ratio double, kept boolean",
    )
