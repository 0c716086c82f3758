"""What the tasks of the repeated-string removal hold and send grows with blocks, not with rows."""

import tracemalloc

import numpy as np
import pyarrow as pa
import xxhash
from cases import documents

from basketlab.llm import suffix_dedup


def test_a_chunks_anchors_travel_as_blocks():
    h = np.repeat(np.arange(6_000), 4)  # each twice in chunk 0, once in chunk 1, and once more in chunk 2
    chunk = np.tile([0, 0, 1, 2], 6_000)
    lone = pa.RecordBatch.from_pydict({"h": [7_000], "chunk": [0], "n": [1]})
    reports = pa.RecordBatch.from_pydict({"h": h, "chunk": chunk, "n": np.where(h == 5, 9, 1)})
    out = pa.Table.from_batches(suffix_dedup._repeated(iter([reports, lone]), hot=20))
    assert out.num_rows == 3
    for row in out.to_pylist():
        assert np.frombuffer(row["h"], np.int64).tolist() == list(range(6_000))
        assert np.flatnonzero(np.frombuffer(row["hot"], np.uint8)).tolist() == [5]


def test_only_the_earliest_places_chunk_is_told_it():
    texts = [bytes([65 + i]) * 100 for i in range(3)]
    rows = [(i, c, xxhash.xxh3_128_digest(t), t, 9, c, 4, 2) for i, t in enumerate(texts) for c in range(50)]
    rows.append((3, 0, xxhash.xxh3_128_digest(b"alone"), b"Z" * 100, 9, 0, 4, 1))
    batch = pa.RecordBatch.from_pylist([dict(zip(suffix_dedup._SENT.names, r)) for r in rows], suffix_dedup._SENT)
    out = pa.Table.from_batches(suffix_dedup._judge(iter([batch]), 100))
    assert out.num_rows == 50
    verdicts = {r["chunk"]: suffix_dedup._Verdicts(pa.Table.from_pylist([r], out.schema)) for r in out.to_pylist()}
    cid = np.frombuffer(b"".join([xxhash.xxh3_128_digest(t) for t in [*texts, b"alone"]]), "<u8").reshape(-1, 2)
    for c, mine in verdicts.items():
        number = mine.find(cid)
        assert (number >= 0).tolist() == [True] * 3 + [False]
        assert mine.is_first(number, np.full(4, c), np.full(4, 4)).tolist() == [c == 0] * 3 + [False]
        assert not mine.is_first(number, np.full(4, c), np.full(4, 5)).any()


def test_contexts_that_share_half_a_hash_are_told_apart():
    verdicts = suffix_dedup._Verdicts(pa.table({c: pa.array([], pa.binary()) for c in ("cid", "place", "size", "repeats")}))
    assert verdicts.find(np.zeros((2, 2), np.uint64)).tolist() == [-1, -1]
    verdicts.cid = np.array([[1, 1], [1, 3], [1, 7], [2, 0]], np.uint64)
    verdicts.order = np.array([2, 0, 3, 1])
    asked = np.array([[1, 7], [1, 2], [1, 1], [2, 0], [3, 3], [2, 9]], np.uint64)
    assert verdicts.find(asked).tolist() == [3, -1, 2, 1, -1, -1]


def test_sending_holds_no_object_for_each_window():
    data = np.random.default_rng(3).integers(97, 123, 300_000).astype(np.uint8)
    docs = pa.table({"chunk": [0], "rid": [0], "ord": [0], "text": [data.tobytes().decode()]})
    h = np.unique(suffix_dedup.contexts(data, np.zeros(1, np.int64))[0])
    wanted = pa.table({"chunk": [0], "h": pa.array([h.tobytes()], pa.binary()), "hot": pa.array([b"\1" * len(h)], pa.binary())})
    tracemalloc.start()
    sent = suffix_dedup._send(docs, wanted, 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sent.num_rows == len(data) - 99
    assert peak < 400 * sent.num_rows


def test_short_rows_leave_in_few_partitions(spark):
    docs = documents(spark).repartition(24)
    assert suffix_dedup.dedup_spans(docs).rdd.getNumPartitions() < 24
