"""Quality classifier from weak labels.

Heuristic labellers and, where there are any, two annotations vote good, bad or
nothing on every document.  One labeller knows loaded words: those that annotated toxic
documents have several times as often as others, learnt from the data's own labels; no
word is given.  Expectation-maximisation over the counts of vote patterns estimates how
often each labeller says what about good, poor and toxic documents, and from that the
probability of each pattern to be bad.  What an annotation calls bad stays bad: it
teaches on its own where no other labeller speaks.  These posterior labels train a
linear scorer on hashed words, word beginnings and shape marks; its weights are not
negative, so a long clean text cannot outweigh what speaks against it.  The scorer
decides.

Scale: votes are numbers, counted by pattern (at most 3**7) over all documents.  Only
the training set of the loaded words and of the scorer is a sample: the ``sample``
annotated rows (of all rows, if none is annotated) with the smallest hash of their id;
both are learnt in one task.  Texts are never shuffled.

Defined results: null and empty texts are short texts; without an annotation the
annotators abstain; repeated labels of an id count as bad if one of them does; a null
id has no label; without bad or without good training rows every document is kept;
repeated rows get equal verdicts; an empty table gives an empty result; other columns
are ignored, or kept by ``keep_good``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketlab.storage import materialize

SAMPLE = 20_000
BITS = 20
MIN_DOCS = 3
MIN_LIFT = 8.0
EPOCHS = 6
RATE = 0.3
START = 5
KEEP_ALL = -1.0  # bias of a scorer that has learnt nothing
ABSTAIN, GOOD, BAD = 0, 1, 2
LABELLERS = ("repeats", "symbols", "capitals", "short", "loaded words", "annotated quality", "annotated toxicity")
QUALITY, TOXICITY = LABELLERS.index("annotated quality"), LABELLERS.index("annotated toxicity")
TOXIC_VOTES = (LABELLERS.index("loaded words"), TOXICITY)
LOADED_SHARE = 0.02  # of the annotated toxic documents that a loaded word must be in
MARKS = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
SYMBOLS = b"#*$%&|<>!"


def _shape(text: str, data: bytes, words: list[bytes]) -> tuple[float, float, float]:
    """Shares of capitals, of symbols and of repeated word pairs."""
    capitals = sum(map(str.isupper, text)) / max(len(text), 1)
    symbols = 1 - len(data.translate(None, SYMBOLS)) / max(len(data), 1)
    pairs = max(len(words) - 1, 1)
    return capitals, symbols, 1 - len(set(zip(words, words[1:]))) / pairs if len(words) > 1 else 0.0


def _buckets(words: Iterable[bytes], bits: int = BITS) -> set[int]:
    return {crc32(w) & ((1 << bits) - 1) for w in words}


def votes(text: str | None, loaded: frozenset[int] = frozenset()) -> list[int]:
    """The votes of the labellers that read the text; ``loaded`` are buckets of words."""
    text = text or ""
    data = text.encode()
    words = data.lower().split()
    capitals, symbols, repeats = _shape(text, data, words)
    plain = {w.strip(MARKS) for w in set(words)}
    return [
        BAD if repeats > 0.6 else GOOD,
        BAD if symbols > 0.05 else GOOD,
        BAD if capitals > 0.5 else GOOD,
        BAD if len(words) < 10 else GOOD,
        BAD if loaded and not loaded.isdisjoint(_buckets(plain)) else ABSTAIN,
    ]


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Hashed words without marks, beginnings of longer words and marks of the shape, each once."""
    text = text or ""
    data = text.encode()
    words = data.lower().split()
    plain = {w.strip(MARKS) for w in set(words)}
    plain.discard(b"")
    capitals, symbols, repeats = _shape(text, data, words)
    common = max(Counter(words).values(), default=0) / max(len(words), 1)
    levels = ((b"capitals", 10 * capitals), (b"symbols", 50 * symbols), (b"repeats", 10 * repeats), (b"common", 10 * common))
    # a mark for each level that is reached
    marks = [b"\0%s%d" % (name, i) for name, level in levels for i in range(1, min(int(level), 9) + 1)]
    found = set(map(crc32, plain))
    found.update([crc32(b"\1" + w[:START]) for w in plain if len(w) > START])
    found.update(map(crc32, marks))
    return np.unique(np.fromiter(found, np.int64, len(found)) & ((1 << bits) - 1))


def _vote(loaded: frozenset[int]):
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast = pa.array(["".join(map(str, votes(t.as_py(), loaded))) for t in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), cast], ["doc_id", "votes"])

    return vote


def telling_buckets(rows: list[tuple[np.ndarray, float]], at_least: float, bits: int = BITS) -> np.ndarray:
    """Flags of the buckets that ``at_least`` bad rows have, MIN_LIFT times as often as good rows."""
    bad = sum(y for _, y in rows)
    good = len(rows) - bad
    every, of_bad = np.zeros(1 << bits), np.zeros(1 << bits)
    for f, y in rows:
        every[f] += 1
        of_bad[f] += y
    return (of_bad >= at_least) & ((of_bad + 0.5) / (bad + 1) > MIN_LIFT * (every - of_bad + 1) / (good + 1))


def loaded_words(rows: list[tuple[np.ndarray, bool]], bits: int = BITS) -> frozenset[int]:
    """Buckets of words that a share of the toxic rows and hardly any other have."""
    toxic = sum(y for _, y in rows)
    return frozenset(np.flatnonzero(telling_buckets(rows, max(MIN_DOCS, LOADED_SHARE * toxic), bits)).tolist())


def estimate(patterns: dict[str, int], rounds: int = 60) -> tuple[np.ndarray, dict[str, float]]:
    """EM over counted vote patterns -> (labeller, kind, vote) probabilities and each pattern's probability to be bad.

    The latent kinds are good, poor and toxic, because labellers of one of the two
    faults know nothing of the other.  Start: a fault is there if somebody votes for it.
    What is annotated as toxic is toxic and what is annotated as bad is not good, in
    every round; documents without an annotation say nothing of the annotators.  One
    hundredth of a vote for each possibility keeps probabilities off zero.
    """
    cast = np.array([[int(v) for v in p] for p in patterns], np.int64).reshape(len(patterns), len(LABELLERS))
    n = np.array(list(patterns.values()), float)
    toxic = (cast[:, TOXIC_VOTES] == BAD).any(axis=1) if len(n) else np.empty(0, bool)
    poor = (np.delete(cast, TOXIC_VOTES, axis=1) == BAD).any(axis=1) if len(n) else np.empty(0, bool)
    kind = np.where(toxic, 2, np.where(poor, 1, 0))
    possible = np.ones((3, len(n)))
    if len(n):
        possible[0, (cast[:, QUALITY] == BAD) | (cast[:, TOXICITY] == BAD)] = 0
        possible[1, cast[:, TOXICITY] == BAD] = 0
    share = np.where(np.arange(3)[:, None] == kind, 0.9, 0.05) * possible
    share /= share.sum(axis=0)
    table = np.zeros((cast.shape[1], 3, 3))
    for _ in range(rounds if len(n) else 0):
        weight = n * share
        for v in range(3):
            table[:, :, v] = ((cast == v).T[:, None, :] * weight[None]).sum(axis=2) + 0.01
        # an annotator who was not asked says nothing, whatever the document is
        table[[QUALITY, TOXICITY], :, ABSTAIN] = 0
        table /= table.sum(axis=2, keepdims=True)
        table[[QUALITY, TOXICITY], :, ABSTAIN] = 1
        score = np.log((weight.sum(axis=1) + 0.01) / (n.sum() + 0.03))[:, None] + sum(
            np.log(table[i][:, cast[:, i]]) for i in range(cast.shape[1])
        )
        share = np.exp(score - score.max(axis=0)) * possible + 1e-300 * possible
        share /= share.sum(axis=0)
    return table, dict(zip(patterns, (1 - share[0]).tolist()))


def train(rows: list[tuple[np.ndarray, float]], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, weights, bias) of the scorer: adaptive gradient steps, weights never under zero.

    A bucket takes part if at least MIN_DOCS bad rows have it, MIN_LIFT times as often
    as good rows.
    """
    bad = sum(y for _, y in rows)
    good = len(rows) - bad
    none = np.empty(0, np.int64), np.empty(0), KEEP_ALL
    if bad < 0.5 or good < 0.5:
        return none
    telling = telling_buckets(rows, MIN_DOCS, bits)
    used = np.flatnonzero(telling)
    if not len(used):
        return none
    place = np.zeros(1 << bits, np.int64)
    place[used] = np.arange(len(used))
    sparse = [place[f[telling[f]]] for f, _ in rows]
    label = np.array([y for _, y in rows])
    weight, squares, bias, bias_squares = np.zeros(len(used)), np.full(len(used), 0.01), -3.0, 1.0
    shuffle = np.random.default_rng(1)
    for _ in range(EPOCHS):
        order = shuffle.permutation(len(rows))
        for i in range(0, len(order), 64):
            part = order[i : i + 64]
            all_ = np.concatenate([sparse[j] for j in part])
            own = np.repeat(np.arange(len(part)), [len(sparse[j]) for j in part])
            margin = bias + np.bincount(own, weight[all_], len(part))
            off = 1 / (1 + np.exp(-np.clip(margin, -50, 50))) - label[part]
            step = np.bincount(all_, off[own], len(used))
            squares += step * step
            weight = np.maximum(weight - RATE * step / np.sqrt(squares), 0)
            bias_squares += off.sum() ** 2
            bias -= RATE * off.sum() / np.sqrt(bias_squares)
    return used, weight, float(bias)


class Model:
    """The loaded words, the labellers' table, the patterns' probabilities and the scorer."""

    def __init__(
        self,
        loaded: frozenset[int],
        table: np.ndarray,
        patterns: dict[str, float],
        used: np.ndarray,
        weights: np.ndarray,
        bias: float,
    ):
        self.loaded, self.table, self.patterns, self.bias = loaded, table, patterns, bias
        self.weights = dict(zip(used.tolist(), weights.tolist()))

    def p_bad(self, text: str | None) -> float:
        margin = self.bias + sum(self.weights.get(b, 0.0) for b in features(text).tolist())
        return float(1 / (1 + np.exp(-np.clip(margin, -50, 50))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Votes of all documents, EM over their patterns, and the scorer from a bounded sample; labels are (doc_id, quality, toxic)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    notes = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    notes = materialize(notes.where("_id is not null and (quality is not null or toxic is not null)"), "weak-notes")

    # at most ``sample`` ids, so they may travel to every task
    ids = texts.where("doc_id is not null").select("doc_id").distinct()
    place = F.xxhash64("doc_id")
    noted = ids.join(notes, F.col("doc_id") == F.col("_id"))
    chosen = noted if not noted.isEmpty() else ids.select("*", *[F.lit(None).cast("int").alias(c) for c in ("quality", "toxic")])
    chosen = chosen.orderBy(place, "doc_id").limit(sample).select(F.col("doc_id").alias("_id"), "toxic", place.alias("place"))
    chosen = materialize(chosen, "weak-sample")
    picked = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("place", "doc_id", "toxic", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).astype(np.int32).tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], ["place", "doc_id", "toxic", "found"])

    def gather(batches: Iterator[pa.RecordBatch]) -> list[tuple]:
        rows = [r for b in batches for r in zip(*[c.to_pylist() for c in b.columns])]
        rows.sort(key=lambda r: (r[0], r[1], r[3]))
        return [(np.frombuffer(f, np.int32).astype(np.int64), y) for _, _, y, f in rows]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = [(f, y > 0) for f, y in gather(batches) if y is not None]
        yield pa.RecordBatch.from_arrays([pa.array(sorted(loaded_words(told)), pa.int64())], ["bucket"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, weights, bias = train(gather(batches))
        yield pa.RecordBatch.from_arrays([pa.array([-1, *used.tolist()]), pa.array([bias, *weights.tolist()])], ["bucket", "weight"])

    described = materialize(picked.mapInArrow(describe, "place long, doc_id long, toxic int, found binary"), "weak-features")
    loaded = frozenset(r["bucket"] for r in described.repartition(1).mapInArrow(load, "bucket long").collect())

    say = lambda good: F.when(good, F.lit(str(GOOD))).when(~good, F.lit(str(BAD))).otherwise(F.lit(str(ABSTAIN)))
    voted = texts.mapInArrow(_vote(loaded), "doc_id long, votes string").join(notes, F.col("doc_id") == F.col("_id"), "left")
    cast = F.concat("votes", say(F.col("quality") == 1), say(F.col("toxic") == 0)).alias("votes")
    voted = materialize(voted.select("doc_id", cast), "weak-votes")
    counts = {r["votes"]: r["count"] for r in voted.groupBy("votes").count().collect()}
    table, patterns = estimate(dict(sorted(counts.items())))

    # at most 3**7 patterns and the votes of the sampled ids
    wanted = voted.join(F.broadcast(chosen.select("_id")), F.col("doc_id") == F.col("_id"), "left_semi")
    rated = wanted.groupBy("doc_id").agg(F.min("votes").alias("votes"))
    known = docs.sparkSession.createDataFrame(sorted(patterns.items()), "votes string, bad double")
    rated = rated.join(F.broadcast(known), "votes").select("doc_id", "bad")
    described = described.join(F.broadcast(materialize(rated, "weak-rated")), "doc_id").select("place", "doc_id", "bad", "found")
    learnt = described.repartition(1).mapInArrow(learn, "bucket long, weight double").orderBy("bucket").collect()
    # the first row is the bias; without training rows there is none, and every document is kept
    buckets, weights = [r["bucket"] for r in learnt[1:]], [r["weight"] for r in learnt[1:]]
    bias = learnt[0]["weight"] if learnt else KEEP_ALL
    return Model(loaded, table, patterns, np.array(buckets, np.int64), np.array(weights), bias)


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, p_bad, kept) of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = [model.p_bad(t.as_py()) for t in batch.column(1)]
            kept = pa.array([x < 0.5 for x in p], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), kept], ["doc_id", "p_bad", "kept"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(score, "doc_id long, p_bad double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the classifier keeps, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    text = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.p_bad(t.as_py()) < 0.5 for t in batch.column(text)], pa.bool_()))

    # plain names on the way, because those of the documents may hold dots
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)
