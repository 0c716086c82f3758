"""Hidden Markov language model over words, and a smoothed unigram base.

The model emits words from hidden states.  It is trained in two spells.  In the first,
words are tied: the most frequent ``TOP`` words of the training documents are classes
of their own, all others share classes by their ending, and a word comes from its class
by its smoothed count; the end of a text is a class too.  Baum-Welch runs on all training
documents, cut into segments; each task sums expected counts, and the sums are added by
class.  In the second spell every word seen ``OWN_COUNT`` times or more in training gets
emissions of its own: a last expectation step counts (word, state), the counts are
summed by word in a Spark table as long as the vocabulary, and each word's share of a
state follows its count and, by a part ``PRIOR``, what the tied model expects of it,
within the mass that the tied model gives to all such words.  So the number of parameters grows with the corpus, and
every text has a probability.  Whole texts are scored by the scaled forward recursion.

Scale: texts are read once and written, bucketed by chunk, as numbers of the chunk's own
vocabulary; no text moves after that.  The chunks' vocabularies meet in buckets of words
and go there and back as packed blocks, a row for each chunk and bucket: words with their
counts one way, and places among the bucket's words, counts and classes the other.  Expected
counts and weights of words take the same ways, so a word moves once for a chunk, however
often it occurs, and needs no key of its own.  Buckets are as many as partitions, so what
meets in one does not grow with the input, up to ``BUCKETS``; from there both buckets and
what meets in one grow with the square root, or blocks would grow many and short.  What all
tasks get is the tied table, ``STATES`` numbers for each of at most TOP + REST + 1 classes,
and the places of the TOP words.

Defined results: null text is empty and scores its end only; a null id is held out;
without training documents every token has base probability 1 and the model is
uniform; repeated rows are documents of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from basketlab.llm.runs import run_bounds
from basketlab.llm.words import input_partitions, lower_words, slices
from basketlab.storage import bucketed, materialize

STATES = 8
TOP = 8192
REST = 1024
ROUNDS = 5
SEGMENT = 128
BLOCK = 2048
CHUNK_WORDS = 600_000
BUCKETS = 1024
BATCH_BYTES = 2 << 20
SMOOTH = 0.1
OWN_COUNT = 5
PRIOR = 0.1
END = 0


class Numbers(dict):
    """Gives each new key the next number."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def held_out(doc_id: int | None) -> bool:
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def _packed(values: np.ndarray) -> bytes:
    """Numbers, whole ones in as few bytes as the largest needs; bytes of equal rank lie together and are compressed."""
    if values.dtype.kind != "f":
        values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    planes = values.reshape(-1, 1).view(np.uint8).T.tobytes()
    return values.dtype.str.encode() + _squeezed(planes)


def _unpacked(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:3].decode())
    planes = np.frombuffer(_opened(data[3:]), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _opened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _all_unpacked(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [_unpacked(x) for x in column.to_pylist()]


def _joined(parts: list[np.ndarray], kind: type = np.int64) -> np.ndarray:
    return np.concatenate([*parts, np.empty(0, kind)]).astype(kind, copy=False)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_ENCODED = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("ids", pa.binary()), ("bucket", pa.int64()),
     ("local", pa.binary()), ("words", pa.binary()), ("n", pa.binary())]
)


def _blocks(chunk: int, words: Numbers, counts: np.ndarray, buckets: int) -> list[pa.RecordBatch]:
    """A chunk's words, sorted in each bucket, their numbers and their training counts; a row for each bucket."""
    texts, rows = list(words), []
    bucket = np.fromiter(map(crc32, texts), np.int64, len(texts)) % buckets
    order = np.argsort(bucket, kind="stable")
    for at, n in zip(*run_bounds(bucket[order])):
        part = sorted(map(texts.__getitem__, order[at : at + n].tolist()))
        local = np.fromiter(map(words.__getitem__, part), np.int64, n)
        row = (chunk, None, None, None, int(bucket[order[at]]))
        # a word holds no blank, so blanks keep words apart
        rows.append((*row, _packed(local), _squeezed(b" ".join(part)), _packed(counts[local])))
    return _table(rows, _ENCODED).to_batches()


def _encode(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Documents -> their words as numbers of the chunk, and the chunk's words with their training counts in blocks."""
    chunk, words, counts = TaskContext.get().partitionId() << 24, Numbers(), np.zeros(0, np.int64)
    for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.array(list(map(words.__getitem__, lower_words(text.as_py()))), np.int32)
            held = held_out(doc_id)
            if len(counts) < len(words):
                counts = np.r_[counts, np.zeros(2 * len(words) - len(counts), np.int64)]
            if not held and len(ids):
                seen, n = np.unique(ids, return_counts=True)
                counts[seen] += n
            rows.append((chunk, doc_id, held, ids.tobytes(), None, None, None, None))
            if len(words) >= CHUNK_WORDS:
                yield from _blocks(chunk, words, counts, buckets)
                chunk, words, counts = chunk + 1, Numbers(), np.zeros(0, np.int64)
        yield from _table(rows, _ENCODED).to_batches()
    yield from _blocks(chunk, words, counts, buckets)


def _endings(words: list[bytes]) -> np.ndarray:
    """Classes of words by their last two characters."""
    last = pc.utf8_slice_codeunits(pa.array(words, pa.large_binary()).cast(pa.large_string()), -2).dictionary_encode()
    found = [crc32(x.encode()) % REST + TOP + 1 for x in last.dictionary.to_pylist()]
    return np.array(found, np.int64)[last.indices.to_numpy()]


_TOLD = ["chunk", "bucket", "places", "c", "rest"]
_BEST = ["codes", "counts", "classes", "words", "tokens", "types"]
_MET = pa.schema([(x, pa.int64()) for x in _TOLD[:2]] + [(x, pa.binary()) for x in _TOLD[2:] + _BEST])


def _meet(blocks: pa.Table) -> pa.Table:
    """All blocks of a bucket -> what each chunk is told, and a row without a chunk.

    A chunk is told its words' places among the bucket's words, their counts and their
    classes by ending.  The row without a chunk has counts and classes of the bucket's
    words, its most frequent words, and the training words of each class by ending.
    """
    bucket = blocks.column("bucket")[0].as_py()
    parts = [_opened(x).split() for x in blocks.column("words").to_pylist()]
    every = [w for part in parts for w in part]
    known = sorted(set(every))
    place = np.fromiter(map(dict(zip(known, range(len(known)))).__getitem__, every), np.int64, len(every))
    c = np.zeros(len(known), np.int64)
    np.add.at(c, place, _joined(_all_unpacked(blocks.column("n"))))
    rest = _endings(known)
    places = np.split(place, np.cumsum([len(x) for x in parts])[:-1])
    rows = [
        (chunk, bucket, _packed(np.diff(x, prepend=0)), _packed(c[x]), _packed(rest[x]), *[None] * len(_BEST))
        for chunk, x in zip(blocks.column("chunk").to_pylist(), places)
    ]
    best = np.argsort(-c, kind="stable")[:TOP]  # equal counts lie in the order of the words
    best = best[c[best] > 0]
    tokens = np.zeros(REST, np.int64)
    np.add.at(tokens, rest - (TOP + 1), c)
    types = np.bincount(rest[c > 0] - (TOP + 1), minlength=REST)
    words = _squeezed(b" ".join([known[i] for i in best.tolist()]))
    found = (_packed((bucket << 32) + best), _packed(c[best]), _packed(rest[best]), words, _packed(tokens), _packed(types))
    return _table([*rows, (None, bucket, None, _packed(c), _packed(rest), *found)], _MET)


def _best(lists: pa.Table) -> tuple:
    """The most frequent of the words in lists, and the sums by class."""
    code, c, rest = (_joined(_all_unpacked(lists.column(x))) for x in _BEST[:3])
    words = [w for x in lists.column("words").to_pylist() for w in _opened(x).split()]
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    best = order[np.argsort(-c[order], kind="stable")[:TOP]]
    sums = [np.sum(_all_unpacked(lists.column(x)), axis=0, dtype=np.int64) for x in ("tokens", "types")]
    return code[best], c[best], rest[best], [words[i] for i in best.tolist()], *sums


def _merged(lists: pa.Table) -> pa.Table:
    code, c, rest, words, tokens, types = _best(lists)
    row = (_packed(code), _packed(c), _packed(rest), _squeezed(b" ".join(words)), _packed(tokens), _packed(types))
    return _table([row], pa.schema([(x, pa.binary()) for x in _BEST]))


def _told_best(lists: pa.Table) -> pa.Table:
    """Rows (code, n, class, word) of the most frequent words, and (class, n, types) of the classes by ending."""
    code, c, rest, words, tokens, types = _best(lists)
    top = [(*x, None) for x in zip(code.tolist(), c.tolist(), rest.tolist(), [w.decode() for w in words])]
    sums = [(None, int(n), TOP + 1 + i, None, int(t)) for i, (n, t) in enumerate(zip(tokens, types)) if t]
    kinds = [("code", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("word", pa.string()), ("types", pa.int64())]
    return _table(top + sums, pa.schema(kinds))


class Top(NamedTuple):
    """The most frequent words, as places in buckets in ascending order, and their classes."""

    code: np.ndarray
    own: np.ndarray

    def classes(self, bucket: np.ndarray | int, place: np.ndarray, rest: np.ndarray) -> np.ndarray:
        if not len(self.code):
            return rest
        code = (bucket << 32) + place
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.own[at], rest)


class Counts(NamedTuple):
    """Training totals and, for each class, the words and distinct words in it."""

    tokens: int
    types: int
    ends: int
    class_tokens: np.ndarray
    class_types: np.ndarray

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + SMOOTH) / (self.tokens + SMOOTH * (self.types + 1)))


class Words(NamedTuple):
    """A chunk's vocabulary: counts and classes by number, and for each bucket the numbers and places of its words."""

    c: np.ndarray
    cls: np.ndarray
    blocks: list[tuple[int, np.ndarray, np.ndarray]]


def _vocabulary(chunk: pa.Table, answers: pa.Table, top: Top) -> Words:
    own = chunk.filter(pc.is_valid(chunk.column("bucket"))).sort_by("bucket")
    answers = answers.sort_by("bucket")
    local, places = _all_unpacked(own.column("local")), [np.cumsum(x, dtype=np.int64) for x in _all_unpacked(answers.column("places"))]
    buckets, number = own.column("bucket").to_pylist(), _joined(local)
    bucket = np.repeat(np.array(buckets, np.int64), [len(x) for x in local])
    c, cls = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    c[number] = _joined(_all_unpacked(answers.column("c")))
    cls[number] = top.classes(bucket, _joined(places), _joined(_all_unpacked(answers.column("rest"))))
    return Words(c, cls, list(zip(buckets, local, places)))


def _documents(chunk: pa.Table) -> pa.Table:
    return chunk.filter(pc.is_valid(chunk.column("ids")))


def _texts(docs: pa.Table) -> list[np.ndarray]:
    """Words of the documents of a chunk, as numbers."""
    return [np.frombuffer(x, np.int32) for x in docs.column("ids").to_pylist()]


def _inside(count: np.ndarray, cls: np.ndarray, totals: Counts) -> np.ndarray:
    """Share of each word in its class."""
    share = (count + SMOOTH) / (totals.class_tokens[cls] + SMOOTH * (totals.class_types[cls] + 1))
    share[(cls > END) & (cls <= TOP)] = 1.0
    return share


def _classed(chunk: pa.Table, answers: pa.Table, top: Top) -> pa.Table:
    """Training documents of a chunk -> their classes."""
    cls, docs = _vocabulary(chunk, answers, top).cls, _documents(chunk)
    held = docs.column("held_out").to_pylist()
    rows = [np.r_[cls[ids], END].astype(np.uint16).tobytes() for ids, h in zip(_texts(docs), held) if not h]
    return pa.table([pa.array(rows, pa.binary())], names=["classes"])


class Parameters(NamedTuple):
    start: np.ndarray  # (state)
    move: np.ndarray  # (from, to)
    emit: np.ndarray  # (class, state), sums to 1 over classes

    @staticmethod
    def first(class_counts: np.ndarray, states: int = STATES, seed: int = 7) -> Parameters:
        share = (class_counts + SMOOTH) / (class_counts + SMOOTH).sum()
        emit = share[:, None] * np.random.default_rng(seed).uniform(0.2, 1.8, (len(share), states))
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return Parameters(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def expected_counts(
    classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, p: Parameters, words: np.ndarray | None = None, n_words: int = 0
) -> tuple:
    """(start, move, emit) counts of segments of ``classes`` under the parameters, by forward-backward.

    With ``words``, numbers below ``n_words`` in the places of the classes, emit counts are theirs.
    """
    states = len(p.start)
    told, n_told = (classes, len(p.emit)) if words is None else (words, n_words)
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((n_told, states))
    order = np.argsort(-sizes, kind="stable")
    for block in range(0, len(order), BLOCK):
        pick = order[block : block + BLOCK]
        begin, size = starts[pick], sizes[pick]
        steps = int(size[0])
        active = [int(np.searchsorted(-size, -t, "left")) for t in range(steps)]
        seen = [classes[begin[:n] + t] for t, n in enumerate(active)]
        alpha, scale = [], []
        for t in range(steps):
            a = p.start * p.emit[seen[0]] if t == 0 else (alpha[-1][: active[t]] @ p.move) * p.emit[seen[t]]
            scale.append(a.sum(axis=1, keepdims=True))
            alpha.append(a / scale[-1])
        beta = np.ones((active[-1], states))
        gamma = [alpha[-1]]
        for t in range(steps - 2, -1, -1):
            n = active[t + 1]
            ahead = p.emit[seen[t + 1]] * beta / scale[t + 1]
            move += alpha[t][:n].T @ ahead
            beta = np.concatenate([ahead @ p.move.T, np.ones((active[t] - n, states))])
            gamma.append(alpha[t] * beta)
        start += gamma[-1].sum(axis=0)
        every = np.concatenate([told[begin[:n] + t] for t, n in zip(range(steps - 1, -1, -1), active[::-1])])
        share = np.concatenate(gamma)
        for k in range(states):
            emit[:, k] += np.bincount(every, share[:, k], n_told)
    return start, move * p.move, emit


def _cuts(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the segments of texts that lie one after another."""
    starts, lengths, at = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    for size in sizes:
        cuts = np.arange(at, at + size, SEGMENT)
        at += size
        starts.append(cuts)
        lengths.append(np.minimum(SEGMENT, at - cuts))
    return np.concatenate(starts), np.concatenate(lengths)


def _segments(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = [np.frombuffer(x.as_buffer(), np.uint16) for x in column]
    return np.concatenate([*flat, np.empty(0, np.uint16)]), *_cuts([len(x) for x in flat])


def _expect(batches: Iterator[pa.RecordBatch], p: Parameters) -> Iterator[pa.RecordBatch]:
    """Classes of documents -> expected counts as rows (row, counts); states' rows follow those of the classes."""
    total = np.zeros((len(p.emit) + 1 + len(p.start), len(p.start)))
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            start, move, emit = expected_counts(*_segments(batch.column(0).slice(at, 1024)), p)
            total += np.concatenate([emit, start[None], move])
    seen = np.flatnonzero(total.any(axis=1))
    columns = [pa.array(seen, pa.int64())] + [pa.array(total[seen, k]) for k in range(total.shape[1])]
    yield pa.RecordBatch.from_arrays(columns, ["row", *[f"k{k}" for k in range(total.shape[1])]])


def baum_welch(classed: DataFrame, class_counts: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Parameters:
    """Parameters after ``rounds`` of training on the classes of the training documents."""
    p = Parameters.first(class_counts, states)
    texts = classed
    prior = (class_counts + SMOOTH) / (class_counts + SMOOTH).sum()
    names = [f"k{k}" for k in range(states)]
    schema = "row long, " + ", ".join(f"{n} double" for n in names)
    for _ in range(rounds):
        found = texts.mapInArrow(lambda x, p=p: _expect(x, p), schema).groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
        total = np.zeros((len(p.emit) + 1 + states, states))
        for row in found.collect():  # a row for each class and state
            total[row[0]] = row[1:]
        if not total.any():
            break
        emit, start, move = total[: len(p.emit)], total[len(p.emit)], total[len(p.emit) + 1 :]
        emit = emit + prior[:, None]
        p = Parameters(
            (start + SMOOTH) / (start + SMOOTH).sum(), (move + SMOOTH) / (move + SMOOTH).sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
        )
    return p


def _word_counts(chunk: pa.Table, answers: pa.Table, top: Top, p: Parameters) -> pa.Table:
    """A chunk's expected (word, state) counts over its training documents, for words that get emissions of their own."""
    c, cls, blocks = _vocabulary(chunk, answers, top)
    docs, n = _documents(chunk), len(c)
    total = np.zeros((n + 1, len(p.start)))
    texts = [ids for ids, h in zip(_texts(docs), docs.column("held_out").to_pylist()) if not h]
    for at in range(0, len(texts), 1024):
        part = texts[at : at + 1024]
        words = np.concatenate([x for ids in part for x in (ids, [n])]).astype(np.int64)  # n is the end
        classes = np.r_[cls, END][words]
        total += expected_counts(classes, *_cuts([len(ids) + 1 for ids in part]), p, words, n + 1)[2]
    rows = []
    for bucket, local, places in blocks:
        own = (c[local] >= OWN_COUNT) & total[local].any(axis=1)
        counts = total[local[own]].astype(np.float32)
        rows.append((bucket, _packed(np.diff(places[own], prepend=0)), _packed(counts)))
    return _table(rows, pa.schema([("bucket", pa.int64()), ("places", pa.binary()), ("counts", pa.binary())]))


def _sum_words(counted: pa.Table, words: pa.Table, top: Top, tied, tokens: int, states: int) -> pa.Table:
    """Counts of a bucket's words from all chunks -> the words' weights in each state, and sums of weights and tied shares."""
    bucket = words.column("bucket")[0].as_py()
    c, rest = (_unpacked(words.column(x)[0].as_py()).astype(np.int64) for x in ("c", "rest"))
    place = np.flatnonzero(c >= OWN_COUNT)
    rank = np.cumsum(c >= OWN_COUNT) - 1
    total = np.zeros((len(place), states))
    for places, counts in zip(counted.column("places").to_pylist(), counted.column("counts").to_pylist()):
        # a chunk has a word once
        total[rank[np.cumsum(_unpacked(places), dtype=np.int64)]] += _unpacked(counts).reshape(-1, states)
    share = tied(c[place], top.classes(bucket, place, rest[place]))
    weight = (1 - PRIOR) * total + PRIOR * (tokens / states * share)
    sums = np.concatenate([weight.sum(axis=0), share.sum(axis=0)])
    row = (bucket, _packed(weight.astype(np.float32)), sums.tobytes())
    return _table([row], pa.schema([("bucket", pa.int64()), ("weights", pa.binary()), ("sums", pa.binary())]))


def _deal(answers: pa.Table, weights: pa.Table, states: int) -> pa.Table:
    """What a bucket told the chunks, and its words' weights -> for each chunk the weights of its words."""
    weight = _unpacked(weights.column("weights")[0].as_py()).reshape(-1, states)
    whole = answers.filter(pc.is_null(answers.column("chunk")))
    rank = np.cumsum(_unpacked(whole.column("c")[0].as_py()) >= OWN_COUNT) - 1
    rows = []
    for row in answers.filter(pc.is_valid(answers.column("chunk"))).to_pylist():
        place = np.cumsum(_unpacked(row["places"]), dtype=np.int64)[_unpacked(row["c"]) >= OWN_COUNT]
        rows.append((row["chunk"], row["bucket"], _packed(weight[rank[place]])))
    return _table(rows, pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("weights", pa.binary())]))


def log10_likelihoods(texts: list[np.ndarray], p: Parameters) -> np.ndarray:
    """Exact log10 probability of each sequence of emissions, by the scaled forward recursion over all texts at once.

    ``p.emit`` may have a row for each class or for each word.
    """
    sizes = np.array([len(x) for x in texts], np.int64)
    flat = np.concatenate([*texts, np.empty(0, np.int64)]).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    begin, size = begin[order], sizes[order]
    total, state = np.zeros(len(texts)), None
    for t in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -t, "left"))
        seen = p.emit[flat[begin[:n] + t]]
        state = p.start * seen if t == 0 else (state[:n] @ p.move) * seen
        scale = state.sum(axis=1)
        total[:n] += np.log10(scale)
        state /= scale[:, None]
    out = np.empty(len(texts))
    out[order] = total
    return out


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = max(input_partitions(docs), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    buckets = min(parts, math.isqrt(BUCKETS * parts))
    small = {"compression": "zstd"}
    encoded = texts.mapInArrow(
        lambda x: _encode(x, buckets),
        "chunk long, doc_id long, held_out boolean, ids binary, bucket long, local binary, words binary, n binary",
    )
    # a chunk comes from one task, so this writes few files and moves nothing
    encoded = bucketed(encoded, "chunk", parts, "lm-encoded", small)
    blocks = encoded.where("bucket is not null").select("chunk", "bucket", "words", "n")
    lists = ", ".join(f"{x} binary" for x in _BEST)
    met = blocks.groupBy("bucket").applyInArrow(_meet, "chunk long, bucket long, places binary, c binary, rest binary, " + lists)
    met = materialize(met, "lm-met")
    # lists of TOP words meet in groups first, then the groups' lists
    best = met.where("chunk is null").select("bucket", *_BEST).groupBy(F.pmod("bucket", F.lit(math.isqrt(buckets) + 1)))
    best = best.applyInArrow(_merged, lists).groupBy().applyInArrow(
        _told_best, "code long, n long, class long, word string, types long"
    )
    found = best.select("code", "n", "class", F.xxhash64("word").alias("key"), "types").collect()  # TOP + REST rows at most
    class_tokens, class_types = np.zeros(TOP + REST + 1), np.zeros(TOP + REST + 1)
    for row in found:
        if row["code"] is None:
            class_tokens[row["class"]], class_types[row["class"]] = row["n"], row["types"]
    frequent = sorted((r for r in found if r["code"] is not None), key=lambda r: (-r["n"], r["key"]))
    for own, row in enumerate(frequent, END + 1):
        class_tokens[row["class"]] -= row["n"]
        class_types[row["class"]] -= 1
        class_tokens[own], class_types[own] = row["n"], 1
    code = np.array([r["code"] for r in frequent], np.int64)
    order = np.argsort(code)
    top = Top(code[order], order + END + 1)
    ends = encoded.where("ids is not null and not held_out").count()
    tokens, types = int(class_tokens.sum()) + ends, int(class_types.sum()) + (ends > 0)
    totals = Counts(tokens, types, ends, class_tokens, class_types)

    # dealt first, so each bucket is one file
    answers = met.where("chunk is not null").select(*_TOLD)
    answers = bucketed(answers.repartition(parts, "chunk"), "chunk", parts, "lm-answers")
    chunks = encoded.select("chunk", "doc_id", "held_out", "ids", "bucket", "local").groupBy("chunk")
    classed = chunks.cogroup(answers.groupBy("chunk")).applyInArrow(lambda a, b: _classed(a, b, top), "classes binary")
    emitted = class_tokens.copy()
    emitted[END] = ends
    model = baum_welch(materialize(classed, "lm-classed", small), emitted, states, rounds)

    def tied(c: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return _inside(c, cls, totals)[:, None] * model.emit[cls]

    counted = chunks.cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda a, b: _word_counts(a, b, top, model), "bucket long, places binary, counts binary"
    )
    words = met.where("chunk is null").select("bucket", "c", "rest")
    weights = counted.groupBy("bucket").cogroup(words.groupBy("bucket")).applyInArrow(
        lambda a, b: _sum_words(a, b, top, tied, tokens, states), "bucket long, weights binary, sums binary"
    )
    weights = materialize(weights, "lm-weights")
    weight, mass = np.zeros(states), np.zeros(states)
    for row in weights.select("sums").collect():  # a row for each bucket
        both = np.frombuffer(row["sums"], float)
        weight, mass = weight + both[:states], mass + both[states:]
    told, dealt = met.select("chunk", "bucket", "places", "c"), weights.select("bucket", "weights")
    sent = told.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInArrow(
        lambda a, b: _deal(a, b, states), "chunk long, bucket long, weights binary"
    )
    sent = answers.unionByName(sent, allowMissingColumns=True)

    def finish(chunk: pa.Table, sent: pa.Table) -> pa.Table:
        docs, dealt = _documents(chunk), pc.is_valid(sent.column("weights"))
        c, cls, blocks = _vocabulary(chunk, sent.filter(pc.invert(dealt)), top)
        emit = tied(c, cls)
        own = _joined([local[c[local] >= OWN_COUNT] for _, local, _ in blocks])
        if len(own):
            rows = _joined(_all_unpacked(sent.filter(dealt).sort_by("bucket").column("weights")), np.float32)
            emit[own] = rows.reshape(-1, states) * (mass / weight)
        p = Parameters(model.start, model.move, np.concatenate([emit, model.emit[END][None]]))
        base = totals.base(np.r_[c, ends])
        ids = [np.r_[x, len(c)].astype(np.int64) for x in _texts(docs)]
        seen = np.r_[c, ends] > 0
        columns = [
            docs.column("doc_id"), docs.column("held_out"), pa.array([len(x) for x in ids], pa.int64()),
            pa.array([int(seen[x].sum()) for x in ids], pa.int64()), pa.array([tokens] * len(ids), pa.int64()),
            pa.array([float(base[x].sum()) for x in ids], pa.float64()), pa.array(_scored(ids, p), pa.float64()),
        ]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return chunks.cogroup(sent.groupBy("chunk")).applyInArrow(finish, _OUT)


def _scored(texts: list[np.ndarray], p: Parameters) -> np.ndarray:
    parts = [log10_likelihoods(texts[at : at + 2048], p) for at in range(0, len(texts), 2048)]
    return np.concatenate([*parts, np.empty(0)])
