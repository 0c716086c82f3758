"""Removing byte strings that also start earlier, by sorting suffixes.

A byte goes if a window of ``length`` bytes that covers it also starts earlier.  All
windows of a corpus are too many to sort, so the sort is restricted to those that can
repeat, without losing one:

1. Each window picks the 32-byte string with the smallest hash inside it, its anchor.
   Equal windows pick equal anchors.  A stretch of windows with the same anchor is one
   context.  Chunks of documents report the hashes of their anchors, once each.
2. Anchors that occur once in the corpus are done.  For the others a chunk sends its
   distinct contexts, each with its earliest place, to the task of the anchor.
3. There equal contexts are merged, and where an anchor has several, the suffixes that
   start at their windows are sorted by hash-compared mergesort (``suffix_sort``).
   Neighbours with a common extension of ``length`` form a class; all but its earliest
   start are repeats.
4. The verdicts go back to the chunks, which mark the bytes and cut them.

Scale: text is shuffled once, into a table bucketed by chunk; then a chunk sends each
distinct anchor and context once, so a passage that a third of all documents share is
one row for a chunk, not one for a document.  An anchor with more than ``HOT``
occurrences is split: its windows go each to the task of their own hash, so a common
phrase between ever different neighbours does not gather in one task.  Very long texts
are hashed in pieces.  The chunked table lies in the shared folder.

Memory: anchors and verdicts travel to the chunks as packed blocks, a row for a chunk
and up to ``BLOCK`` of them, so the sort by chunk holds few rows.  Tasks hold contexts
as numbers; their bytes are cut out of the text where they are sent or sorted.  Only the
chunk with a context's earliest place is told that place, the others drop it everywhere.

Defined results: null text is empty; texts shorter than ``length`` stay as they are;
documents of equal id are ordered as read, null ids come last; repeated rows are
copies of each other; an empty table gives an empty result; other columns are ignored
or, with ``keep_rows``, carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from basketlab.llm.runs import run_bounds, whole_runs
from basketlab.llm.suffix_sort import Suffixes, powers, prefix_hashes
from basketlab.llm.words import input_partitions
from basketlab.storage import bucketed, materialize

LENGTH = 100
ANCHOR = 32
PIECE = 1 << 18
HOT = 5_000
SORT_BATCH = 1 << 14
BLOCK = 1 << 17
SENT_ROWS = 10_000
LAST = (1 << 63) - 1


def _mixed(data: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each place on, the same wherever the bytes stand."""
    p = prefix_hashes(data)
    h = (p[ANCHOR:] - p[:-ANCHOR]) * powers(len(data))[1][: len(data) - ANCHOR + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _picked(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place of its anchor (the leftmost of the smallest), and all anchor hashes."""
    h = _mixed(data)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span, have = length - ANCHOR + 1, 1
    while 2 * have <= span:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    if have < span:
        rest = span - have
        key = np.minimum(key[:-rest], key[rest:])
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64), h


def contexts(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last): stretches of windows with one anchor, never across the documents that begin at ``starts``."""
    found = []
    ends = np.r_[starts[1:], len(data)]
    for a in range(0, max(len(data) - length + 1, 0), PIECE):
        piece = data[a : a + PIECE + length - 1]
        at, h = _picked(piece, length)
        inside = np.zeros(len(at) + 1, np.int8)
        ok = ends - starts >= length
        np.add.at(inside, np.clip(starts[ok] - a, 0, len(at)), 1)
        np.add.at(inside, np.clip(ends[ok] - length + 1 - a, 0, len(at)), -1)
        valid = np.cumsum(inside[:-1]) > 0
        first = np.zeros(len(at), bool)
        begins = starts - a
        first[begins[(begins >= 0) & (begins < len(at))]] = True
        first[0] = True
        first[1:] |= at[1:] != at[:-1]
        first[1:] |= ~valid[:-1]
        begin = np.flatnonzero(first & valid)
        stop = np.flatnonzero(valid & np.r_[first[1:] | ~valid[1:], True])
        found.append((h[at[begin]].view(np.int64), begin + a, stop + a))
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _buffers(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, starts) of stretches of rows with about PIECE bytes; a longer text is a stretch alone."""
    texts, row = table.column("text"), 0
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False) if len(texts) else np.empty(0, np.int64)
    while row < len(sizes):
        held = np.cumsum(sizes[row : row + 100_000])
        n = max(1, int(np.searchsorted(held, PIECE, "right")))
        data = b"".join([x.as_buffer().to_pybytes() for x in texts.slice(row, n)])
        yield row, np.frombuffer(data, np.uint8), np.r_[0, held[: n - 1]].astype(np.int64)
        row += n


def _report(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Documents -> (h, chunk, n) once for each anchor and stretch of documents."""
    for batch in batches:
        chunk = batch.column("chunk").to_numpy()
        begin, size = run_bounds(chunk)
        for b, n in zip(begin, size):
            for _, data, starts in _buffers(batch.slice(b, n)):
                h, count = np.unique(contexts(data, starts, length)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(np.full(len(h), chunk[b]), pa.int64()), pa.array(count, pa.int64())],
                    ["h", "chunk", "n"],
                )


def _cells(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary column: the bytes of the items of ``data`` from one end to the next."""
    width = data.itemsize * int(np.prod(data.shape[1:]))
    offsets = (np.r_[0, ends] * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _items(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """What the cells of a binary column hold, one after the other."""
    return np.frombuffer(b"".join([x.as_buffer() for x in column]), kind)


def _packed(chunk: np.ndarray, **values: np.ndarray) -> pa.RecordBatch:
    """A row for each chunk with its values as cells."""
    order = np.argsort(chunk, kind="stable")
    begin, size = run_bounds(chunk[order])
    cells = [_cells(x[order], begin + size) for x in values.values()]
    return pa.RecordBatch.from_arrays([pa.array(chunk[order][begin], pa.int64()), *cells], ["chunk", *values])


def _repeated(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """Reports sorted by anchor -> (chunk, h, hot) packed: a chunk's anchors that occur more than once, each once."""
    held: list[tuple] = []

    def block() -> pa.RecordBatch:
        chunk, h, often = (np.concatenate(x) for x in zip(*held))
        held.clear()
        return _packed(chunk, h=h, hot=often)

    for table in whole_runs(batches, "h"):
        h, n, chunk = (table.column(c).to_numpy() for c in ("h", "n", "chunk"))
        begin, size = run_bounds(h)
        total = np.repeat(np.add.reduceat(n, begin), size)
        order = np.lexsort((chunk, h))
        order = order[total[order] > 1]
        if not len(order):
            continue
        h, chunk, total = h[order], chunk[order], total[order]
        once = np.r_[True, (h[1:] != h[:-1]) | (chunk[1:] != chunk[:-1])]
        held.append((chunk[once], h[once], (total[once] > hot).astype(np.uint8)))
        if sum(len(x) for x, *_ in held) >= BLOCK:
            yield block()
    if held:
        yield block()


def _instances(docs: pa.Table, wanted: pa.Table, length: int) -> Iterator[tuple]:
    """(data, first, last, row, place in the row, h, id as two numbers) of the wanted contexts of each stretch of rows.

    The context of a hot anchor is cut into its windows; a window's group is its own hash.
    """
    want = _items(wanted.column("h"), "<i8")
    where = np.argsort(want)
    want, is_hot = want[where], _items(wanted.column("hot"), "u1")[where].astype(bool)
    if not len(want):
        return
    for row, data, starts in _buffers(docs):
        h, first, last = contexts(data, starts, length)
        at = np.minimum(np.searchsorted(want, h), len(want) - 1)
        kept = np.flatnonzero(want[at] == h)
        cut = is_hot[at[kept]]
        plain, split = kept[~cut], kept[cut]
        lens = last[split] - first[split] + 1
        each = np.repeat(first[split] - np.r_[0, np.cumsum(lens)[:-1]], lens) + np.arange(lens.sum())
        a, b = np.r_[first[plain], each], np.r_[last[plain], each]
        raw, digest = data.tobytes(), xxhash.xxh3_128_digest
        ids = b"".join([digest(raw[i:j]) for i, j in zip(a.tolist(), (b + length).tolist())])
        cid = np.frombuffer(ids, "<u8").reshape(-1, 2)
        group = np.r_[h[plain], cid[len(plain) :, 0].view(np.int64)]
        doc = np.searchsorted(starts, a, "right") - 1
        yield raw, a, b, doc + row, a - starts[doc], group, cid


def _earliest(cid: np.ndarray, place: np.ndarray, n: np.ndarray, *rest: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each context once: at its earliest place, with the number of its places."""
    order = np.lexsort((place, cid[:, 1], cid[:, 0]))
    if not len(order):
        return cid, place, n, *rest
    ids = cid[order]
    begin = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1)])
    first = order[begin]
    return cid[first], place[first], np.add.reduceat(n[order], begin), *(x[first] for x in rest)


def _send(docs: pa.Table, wanted: pa.Table, length: int) -> pa.Table:
    """A chunk's distinct contexts, each with its earliest place and the number of its places."""
    order, rid = docs.column("ord").to_numpy(), docs.column("rid").to_numpy()
    in_order = np.lexsort((rid, order))
    rank = np.empty(len(in_order), np.int64)
    rank[in_order] = np.arange(len(in_order))
    texts, found, before = [], [], 0
    for raw, a, b, doc, pos, group, cid in _instances(docs, wanted, length):
        found.append(_earliest(cid, rank[doc] << 32 | pos, np.ones(len(a), np.int64), group, a + before, b + before + length))
        texts.append(raw)
        before += len(raw)
    if not found:
        return _SENT.empty_table()
    cid, place, n, group, a, b = _earliest(*(np.concatenate(x) for x in zip(*found)))
    del found
    data = b"".join(texts)
    del texts
    batches = []
    for i in range(0, len(n), SENT_ROWS):
        some = slice(i, i + SENT_ROWS)
        doc, rows = in_order[place[some] >> 32], len(n[some])
        columns = [
            pa.array(group[some]),
            pa.array(np.full(rows, docs.column("chunk")[0].as_py()), pa.int64()),
            _cells(cid[some], np.arange(1, rows + 1)),
            pa.array([data[x:y] for x, y in zip(a[some].tolist(), b[some].tolist())], pa.binary()),
            *(pa.array(x) for x in (order[doc], rid[doc], place[some] & 0xFFFFFFFF, n[some])),
        ]
        batches.append(pa.RecordBatch.from_arrays(columns, schema=_SENT))
    return pa.Table.from_batches(batches, _SENT)


_SENT = pa.schema(
    [("h", pa.int64()), ("chunk", pa.int64()), ("cid", pa.binary()), ("context", pa.binary()), ("ord", pa.int64()),
     ("rid", pa.int64()), ("pos", pa.int64()), ("n", pa.int64())]
)
_VERDICT = pa.schema(
    [("chunk", pa.int64()), ("cid", pa.binary()), ("place", pa.binary()), ("size", pa.binary()), ("repeats", pa.binary())]
)


def _sorted_repeats(group: np.ndarray, texts: list[bytes], places: tuple[np.ndarray, ...], length: int) -> list[bytes]:
    """Distinct contexts, ascending by group, with their earliest places -> bit for each window: it starts earlier too.

    Empty where no window does.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(texts)), windows)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = np.repeat(np.cumsum(sizes) - sizes, windows) + within
    number = np.unique(group, return_inverse=True)[1]
    order, new = Suffixes(data, length).classes(starts, number[owner])
    doc, rid, pos = (x[owner] for x in places)
    rank = np.empty(len(owner), np.int64)
    rank[np.lexsort((pos + within, rid, doc))] = np.arange(len(owner))
    best = np.minimum.reduceat(rank[order], np.flatnonzero(new))
    repeat = np.empty(len(owner), bool)
    repeat[order] = rank[order] != best[np.cumsum(new) - 1]
    return [np.packbits(x).tobytes() if x.any() else b"" for x in np.split(repeat, np.cumsum(windows)[:-1])]


def _judged(table: pa.Table, length: int) -> tuple[tuple, tuple]:
    """Whole groups of contexts -> (chunk, cid) where a context goes at all places, and (chunk, cid, place, bits) of earliest places."""
    h, chunk, doc, rid, pos, n = (table.column(c).to_numpy() for c in ("h", "chunk", "ord", "rid", "pos", "n"))
    cid = _items(table.column("cid"), "<u8").reshape(-1, 2)
    order = np.lexsort((pos, rid, doc, cid[:, 1], cid[:, 0], h))
    ids, groups = cid[order], h[order]
    new = np.r_[True, (groups[1:] != groups[:-1]) | (ids[1:] != ids[:-1]).any(axis=1)]
    first, later = order[new], order[~new]
    begin, size = run_bounds(h[first])
    several = np.flatnonzero(np.repeat(size > 1, size))
    bits = [b""] * len(first)
    if len(several):
        rows = first[several]
        contexts_ = table.column("context").take(pa.array(rows))
        windows = np.cumsum(pc.binary_length(contexts_).to_numpy() - length + 1)
        starts, members = run_bounds(h[rows])
        # a batch ends with the group that fills it
        batch = np.repeat(np.r_[0, windows[starts[1:] - 1]] // SORT_BATCH, members)
        for b, s in zip(*run_bounds(batch)):
            some = rows[b : b + s]
            found = _sorted_repeats(h[some], contexts_.slice(b, s).to_pylist(), (doc[some], rid[some], pos[some]), length)
            for i, x in zip(several[b : b + s].tolist(), found):
                bits[i] = x
    told = np.flatnonzero((n[first] > 1) | np.array([len(x) > 0 for x in bits]))
    at = first[told]
    return (chunk[later], cid[later]), (chunk[at], cid[at], np.c_[rid[at], pos[at]], [bits[i] for i in told.tolist()])


def _judge(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by group -> verdicts for the chunks that hold them, packed."""
    everywhere: list[tuple] = []
    earliest: list[tuple] = []

    def blocks() -> Iterator[pa.RecordBatch]:
        if everywhere:
            chunk, cid = (np.concatenate(x) for x in zip(*everywhere))
            packed = _packed(chunk, cid=cid)
            missing = pa.nulls(packed.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([*packed.columns, missing, missing, missing], schema=_VERDICT)
        if earliest:
            chunk, cid, place = (np.concatenate(x) for x in list(zip(*earliest))[:3])
            bits = [b for *_, some in earliest for b in some]
            packed = _packed(chunk, cid=cid, place=place, size=np.array([len(b) for b in bits], "<u4"))
            order = np.argsort(chunk, kind="stable").tolist()
            begin, size = run_bounds(chunk[order])
            repeats = [b"".join([bits[i] for i in order[b : b + s]]) for b, s in zip(begin.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays([*packed.columns, pa.array(repeats, pa.binary())], schema=_VERDICT)
        everywhere.clear()
        earliest.clear()

    held = 0
    for table in whole_runs(batches, "h"):
        rest, first = _judged(table, length)
        for kind, some in ((everywhere, rest), (earliest, first)):
            if len(some[0]):
                kind.append(some)
                held += len(some[0])
        if held >= BLOCK:
            yield from blocks()
            held = 0
    yield from blocks()


class _Verdicts:
    """A chunk's verdicts, found by context."""

    def __init__(self, blocks: pa.Table):
        known = pc.is_valid(blocks.column("place"))
        some, rest = blocks.filter(known), blocks.filter(pc.invert(known))
        cid = np.concatenate([_items(x.column("cid"), "<u8") for x in (some, rest)]).reshape(-1, 2)
        self.order = np.lexsort((cid[:, 1], cid[:, 0]))
        self.cid = cid[self.order]
        self.place = _items(some.column("place"), "<i8").reshape(-1, 2)
        self.ends = np.cumsum(_items(some.column("size"), "<u4"), dtype=np.int64)
        self.repeats = _items(some.column("repeats"), "u1")

    def find(self, cid: np.ndarray) -> np.ndarray:
        """The number of each context's verdict, -1 for none."""
        at = np.searchsorted(self.cid[:, 0], cid[:, 0])
        open_ = np.arange(len(cid))
        out = np.full(len(cid), -1)
        while (open_ := open_[at[open_] < len(self.cid)]).size:
            here = self.cid[at[open_]]
            open_, here = open_[same := here[:, 0] == cid[open_, 0]], here[same]
            hit = here[:, 1] == cid[open_, 1]
            out[open_[hit]] = self.order[at[open_[hit]]]
            open_ = open_[~hit]
            at[open_] += 1  # another context with the same first half
        return out

    def is_first(self, number: np.ndarray, rid: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Where a context stands at its earliest place."""
        out = (number >= 0) & (number < len(self.place))
        out[out] = (self.place[number[out]] == np.c_[rid[out], pos[out]]).all(axis=1)
        return out

    def windows(self, number: int) -> np.ndarray:
        """Windows of the context at its earliest place that start earlier too."""
        bits = self.repeats[self.ends[number - 1] if number else 0 : self.ends[number]]
        return np.flatnonzero(np.unpackbits(bits))


def _cut(docs: pa.Table, wanted: pa.Table, verdicts: _Verdicts, length: int) -> Iterator[tuple[bytes, int]]:
    """(kept bytes, number of removed runs) of each document of a chunk."""
    rid = docs.column("rid").to_numpy()
    marked: dict[int, list[tuple[int, int]]] = {}
    for _, a, b, doc, pos, _, cid in _instances(docs, wanted, length) if len(verdicts.cid) else ():
        number = verdicts.find(cid)
        first = verdicts.is_first(number, rid[doc], pos)
        whole = np.flatnonzero((number >= 0) & ~first)
        inside = [(i, w) for i in np.flatnonzero(first).tolist() if len(w := verdicts.windows(number[i]))]
        at = np.concatenate([whole, *(np.full(len(w), i) for i, w in inside)])
        begin = np.concatenate([pos[whole], *(pos[i] + w for i, w in inside)])
        end = np.concatenate([pos[whole] + (b - a)[whole], *(pos[i] + w for i, w in inside)]) + length
        order = np.lexsort((begin, doc[at]))
        if not len(order):
            continue
        row, begin, end = doc[at[order]], begin[order], end[order]
        base = row * (int(end.max()) + 1)  # keeps the rows apart
        reach = np.maximum.accumulate(base + end)
        runs = np.flatnonzero(np.r_[True, (base + begin)[1:] > reach[:-1]])
        ends = reach[np.r_[runs[1:] - 1, len(row) - 1]] - base[runs]
        for i, x, y in zip(row[runs].tolist(), begin[runs].tolist(), ends.tolist()):
            marked.setdefault(i, []).append((x, y))
    for i, text in enumerate(docs.column("text")):
        data, spans = text.as_buffer().to_pybytes(), marked.get(i, ())
        edges = [0, *[x for s in spans for x in s], len(data)]
        yield b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2])]) if spans else data, len(spans)


def chunked(docs: DataFrame, parts: int, id_col: str, text_col: str, keep_rows: bool) -> DataFrame:
    """(chunk, rid, ord, doc_id, text) bucketed by chunk in the shared folder; ``row`` holds the other columns."""
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")] if keep_rows else []
    numbered = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("ord"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *rest,
    ).withColumn("chunk", F.pmod(F.xxhash64("rid"), F.lit(4 * parts)))
    sorted_rows = numbered.repartition(parts, "chunk").sortWithinPartitions("chunk")
    return bucketed(sorted_rows, "chunk", parts, "suffix-chunks", {"compression": "zstd"})


def dedup_spans(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_rows: bool = False,
    hot: int = HOT,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; with ``keep_rows`` also kept (text) and row."""
    if length < ANCHOR:
        raise ValueError(f"windows hold an anchor of {ANCHOR} bytes")
    parts = input_partitions(docs)
    table = chunked(docs, parts, id_col, text_col, keep_rows)
    texts = table.select("chunk", "rid", "ord", "doc_id", "text", *(["row"] if keep_rows else []))
    reports = texts.select("chunk", "text").mapInArrow(lambda x: _report(x, length), "h long, chunk long, n long")
    wanted = (
        reports.repartition("h")
        .sortWithinPartitions("h")
        .mapInArrow(lambda x: _repeated(x, hot), "chunk long, h binary, hot binary")
        .repartition(max(1, parts // 16), "chunk")
    )
    wanted = materialize(wanted, "suffix-wanted")
    sent = (
        texts.select("chunk", "rid", "ord", "text")
        .groupBy("chunk")
        .cogroup(wanted.groupBy("chunk"))
        .applyInArrow(
            lambda a, b: _send(a, b, length),
            "h long, chunk long, cid binary, context binary, ord long, rid long, pos long, n long",
        )
    )
    verdicts = (
        sent.repartition("h")
        .sortWithinPartitions("h")
        .mapInArrow(lambda x: _judge(x, length), "chunk long, cid binary, place binary, size binary, repeats binary")
    )
    # a chunk's verdicts and wanted anchors travel together
    both = verdicts.unionByName(wanted, allowMissingColumns=True)
    schema = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    if keep_rows:
        schema = schema.add("kept", "string").add("row", texts.schema["row"].dataType)

    def finish(mine: pa.Table, sent_back: pa.Table) -> pa.Table:
        is_anchor = pc.is_valid(sent_back.column("h"))
        verdicts = _Verdicts(sent_back.filter(pc.invert(is_anchor)))
        size = pc.binary_length(mine.column("text")).to_pylist()
        left, spans, hashes, kept = [], [], [], []
        for data, runs in _cut(mine, sent_back.filter(is_anchor), verdicts, length):
            left.append(len(data))
            spans.append(runs)
            hashes.append(hashlib.sha256(data).hexdigest())
            if keep_rows:
                kept.append(data.decode(errors="ignore"))
        out = [
            mine.column("doc_id"),
            pa.array(size, pa.int64()),
            pa.array([n - k for n, k in zip(size, left)], pa.int64()),
            pa.array(spans, pa.int64()),
            pa.array(hashes, pa.string()),
        ]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if keep_rows:
            out += [pa.array(kept, pa.string()), mine.column("row")]
            names += ["kept", "row"]
        return pa.table(out, names=names)

    out = (
        texts.groupBy("chunk")
        .cogroup(both.groupBy("chunk"))
        .applyInArrow(finish, schema)
    )
    # without the texts the rows are short: they leave in few files instead of one for each bucket
    return out if keep_rows else out.hint("rebalance")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with repeated strings cut out, in their own columns.

    A string may begin or end inside a character; what is left of such a character is
    dropped.  Documents of which nothing is left go.
    """
    cut = dedup_spans(docs, id_col=id_col, text_col=text_col, keep_rows=True, **options)
    columns = [F.col("kept").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    return cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes"))).select(*columns)
