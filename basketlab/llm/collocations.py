"""Phrase collocations by dynamic itemset counting.

Phrases are runs of one to three words within pieces of text, counted for each
language.  The texts are dealt into shards that are scanned in a cycle, one shard a
step, all lengths at once.  Single words are counted from the first step; a longer
phrase joins at the first shard after both its subphrases (without its last and without
its first word) have reached the threshold, and is counted until it has seen every shard
once.  So scans of different lengths overlap, and a phrase that cannot be frequent is
never counted.

Which phrases have reached the threshold, and after which step, is told to the tasks in
two tables of fixed size, one for words and one for pairs: a phrase's step is the later
one of its two slots.  Slots are set once and never change, so every task, in every
step, derives the same steps for the same phrase, and a phrase that shares its slots
with others starts early at worst; it is still counted over one full cycle.

Counts go by 64-bit hashes of phrase and language.  Phrases whose cycle is over leave
the running counts: frequent ones go to the result, others are dropped.  A last scan
spells the frequent ones of two words and more, shard after shard until all are spelled;
should two of what it sees share a hash, all is counted again under another seed.
Beyond that, phrases are told apart by 62 bits: of a thousand million one pair in ten
corpora would be counted together.

Scale: tasks count their part before anything is shuffled, and send blocks of sorted
hashes, a few bytes for each different phrase; ranges of hashes are merged each in one
task, so ``spark.sql.shuffle.partitions`` sets what a task holds.  The running counts
hold phrases within their cycle only.  The tables sent to tasks have a fixed size; a corpus
with more frequent phrases than slots prunes less and counts as exactly.  Cuts and
containment are equi-joins on hashes.  The list of a language is cut by a histogram of
its scores and ranked in salted groups first, so no task sees all its candidates.

Defined results: null texts are empty; a null language is ``und``; an empty language is
one of its own; languages without candidates have no rows; repeated rows count each
time; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from basketlab.llm.counting import Shipped, bit_table, may_hold, slots
from basketlab.llm.words import mixed, slices
from basketlab.storage import materialize, remove, scratch_path

# fixed values of the contract
UNKNOWN = "und"
LONGEST = 3
THRESHOLD = 10
TOP = 2000
SCALE = 1_000_000
CONTAINED_PERCENT = 50

SHARDS = 3
SLOT_BITS = 23
NEVER = 255
BATCH_BYTES = 1 << 19
HELD = 1 << 19
SPELLED = 1 << 16
SALTS = 64
PARTS = 4  # ranges of keys for each shuffle partition

# piece separators become line breaks, tabs become blanks
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
_BREAK = xxhash.xxh3_64_intdigest(b"\n")


def piece_words(text: str | None) -> list[bytes]:
    """Words of the text in order, with a line break between pieces."""
    if not text:
        return []
    data = text.encode().lower().translate(_PIECES).replace(b"\n", b" \n ")
    return [w for w in data.split(b" ") if w]


def _leveled(key: np.ndarray, level: int) -> np.ndarray:
    """The number of words in the two lowest bits."""
    return key & ~np.uint64(3) | np.uint64(level)


class Phrases:
    """Keys of all phrases of a batch of texts: ``keys[n - 1][i]`` is the phrase of n words from word i on."""

    def __init__(self, langs: list[str | None], texts: list[str | None], longest: int, seed: int):
        self.words: list[bytes] = []
        hashes: list[int] = []
        self.langs, self.ends = [UNKNOWN if x is None else x for x in langs], []
        digest = xxhash.xxh3_64_intdigest
        for lang, text in zip(self.langs, texts):
            own = xxhash.xxh64_intdigest(lang.encode(), seed)
            words = piece_words(text)
            words.append(b"\n")
            self.words += words
            hashes += [_BREAK if w == b"\n" else digest(w, own) for w in words]
            self.ends.append(len(self.words))
        base = np.array(hashes, np.uint64)
        whole = base != np.uint64(_BREAK)
        self.keys, self.there = [_leveled(base, 1)], [whole]
        for n in range(2, longest + 1):
            base = mixed(base[:-1], self.keys[0][n - 1 :])
            whole = whole[:-1] & self.there[0][n - 1 :]
            self.keys.append(_leveled(base, n))
            self.there.append(whole)


def _steps(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The step after which each key had reached the threshold, NEVER for most."""
    one, two = slots(keys, len(table).bit_length() - 1)
    return np.maximum(table[one], table[two])


def _starts(phrases: Phrases, reached: list[np.ndarray], n: int) -> np.ndarray:
    """First step of each phrase of n words; NEVER while a subphrase is rare."""
    if n == 1:
        return np.zeros(len(phrases.keys[0]), np.int64)
    parts = _steps(reached[n - 2], phrases.keys[n - 2])
    later = np.maximum(parts[:-1], parts[1:]).astype(np.int64)
    return np.where(later == NEVER, NEVER, later + 1)


# counts travel and lie as blocks: the sorted keys of a range of keys and of one first step, and their counts
_BLOCKS = "part int, start int, keys binary, counts binary, old boolean"
_BLOCKS_TYPE = pa.schema([("part", pa.int32()), ("start", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("old", pa.bool_())])


def _blocks(start: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[tuple]:
    """Blocks of sorted keys, one for each range of keys that has any."""
    edges = [(i << 64) // parts for i in range(1, parts)]
    cuts = [0, *np.searchsorted(keys, np.array(edges, np.uint64)).tolist(), len(keys)]
    for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            yield part, start, keys[a:b].tobytes(), counts[a:b].astype(np.int64).tobytes(), False


def _scan(step: int, shards: int, sent: list[Shipped], longest: int, seed: int, parts: int):
    """Counts of the phrases that are within their cycle at this step, as blocks."""

    def rows(held: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
        found = []
        for start, keys in held.items():
            found += _blocks(start, *np.unique(np.concatenate(keys), return_counts=True), parts)
        columns = list(zip(*found)) if found else [()] * len(_BLOCKS_TYPE)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCKS_TYPE)], schema=_BLOCKS_TYPE)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = [table.open() for table in sent]
        held: dict[int, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                phrases = Phrases(part.column("lang").to_pylist(), part.column("text").to_pylist(), longest, seed)
                for n in range(1, longest + 1):
                    keys, there = phrases.keys[n - 1], phrases.there[n - 1]
                    starts = _starts(phrases, reached, n)
                    for start in range(max(0, step - shards + 1), step + 1):  # those whose cycle covers this step
                        now = keys[there & (starts == start)]
                        if len(now):
                            held.setdefault(start, []).append(now)
                            size += len(now)
                if size > HELD:
                    yield rows(held)
                    held, size = {}, 0
        if held:
            yield rows(held)

    return scan


_MERGED = "kind string, part int, start int, keys binary, counts binary"
_MERGED_TYPE = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("start", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _merge(step: int, shards: int, threshold: int):
    """Blocks sorted by part -> running counts, phrases found, and keys that have just reached the threshold."""

    def merged(part: int, blocks: list[tuple]) -> Iterator[tuple]:
        for start in sorted({b[0] for b in blocks}):
            mine = [b for b in blocks if b[0] == start]
            keys = np.concatenate([np.frombuffer(b[1], np.uint64) for b in mine])
            counts = np.concatenate([np.frombuffer(b[2], np.int64) for b in mine])
            before = np.where(np.repeat([b[3] for b in mine], [len(b[1]) // 8 for b in mine]), counts, 0)
            order = np.argsort(keys)
            keys, counts, before = keys[order], counts[order], before[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            keys, counts, before = keys[first], np.add.reduceat(counts, first), np.add.reduceat(before, first)
            enough = counts >= threshold
            new = keys[enough & (before < threshold)]
            if len(new):
                yield "reached", part, start, new.tobytes(), None
            if start + shards - 1 <= step:  # its cycle is over: what is rare is dropped here
                if enough.any():
                    yield "found", part, start, keys[enough].tobytes(), counts[enough].tobytes()
            else:
                yield "running", part, start, keys.tobytes(), counts.tobytes()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(part: int, blocks: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) if (found := list(merged(part, blocks))) else [()] * len(_MERGED_TYPE)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MERGED_TYPE)], schema=_MERGED_TYPE)

        part, blocks = None, []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("part", "start", "keys", "counts", "old")]):
                if row[0] != part and blocks:
                    yield out(part, blocks)
                    blocks = []
                part = row[0]
                blocks.append(row[1:])
        if blocks:
            yield out(part, blocks)

    return merge


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, counts = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64) for c in ("keys", "counts"))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])


def _level(key: Column) -> Column:
    return key.bitwiseAND(F.lit(3))


def frequent(
    texts: DataFrame, threshold: int, longest: int = LONGEST, shards: int = SHARDS, bits: int = SLOT_BITS, seed: int = 0
) -> DataFrame:
    """Phrases (key, n) that occur ``threshold`` times or more in texts (lang, text, shard)."""
    spark = texts.sparkSession
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    reached = [np.full(1 << bits, NEVER, np.uint8) for _ in range(longest - 1)]
    running: DataFrame | None = None
    found: list[DataFrame] = []
    step, last, path = 0, shards - 1, ""
    while step <= last:
        scan = _scan(step, shards, [Shipped(table) for table in reached], longest, seed, parts)
        blocks = texts.where(F.col("shard") == step % shards).select("lang", "text").mapInArrow(scan, _BLOCKS)
        if running is not None:
            blocks = blocks.unionByName(running.withColumn("old", F.lit(True)))
        merged = blocks.repartition("part").sortWithinPartitions("part").mapInArrow(_merge(step, shards, threshold), _MERGED)
        before, path = path, scratch_path(spark, "phrase-counts")
        merged.write.partitionBy("kind").parquet(path)
        if before:
            remove(spark, f"{before}/kind=running")
        written = spark.read.schema(_MERGED).parquet(path)
        for level in range(1, longest):
            now = written.where("kind = 'reached'").select("keys")
            new = bit_table(now, bits, packed=True, pick=_of_level(level)) & (reached[level - 1] == NEVER)
            if new.any():
                reached[level - 1][new] = step
                last = max(last, step + shards)
        found.append(written.where("kind = 'found'").select("keys", "counts").mapInArrow(_unpacked, "key long, n long"))
        running = written.where("kind = 'running'").select("part", "start", "keys", "counts")
        step += 1
    return materialize(_union(found), "frequent-phrases")


def _of_level(level: int) -> Callable[[np.ndarray], np.ndarray]:
    """Which keys are those of phrases of so many words."""
    return lambda keys: keys & np.uint64(3) == np.uint64(level)


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def _spell(sent: Shipped, longest: int, seed: int):
    """Phrases of two words and more whose slots are set -> (key, lang, phrase), once or more in each task."""

    def rows(held: dict[int, tuple[str, bytes]]) -> pa.RecordBatch:
        langs, names = zip(*held.values()) if held else ((), ())
        columns = [
            pa.array(np.array(list(held), np.uint64).view(np.int64)),
            pa.array(langs, pa.string()),
            pa.array([x.decode() for x in names], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["key", "lang", "phrase"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.open()
        held: dict[int, tuple[str, bytes]] = {}
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                phrases = Phrases(part.column("lang").to_pylist(), part.column("text").to_pylist(), longest, seed)
                words, langs, ends = phrases.words, phrases.langs, np.array(phrases.ends)
                for n in range(2, longest + 1):
                    keys = phrases.keys[n - 1]
                    at = np.flatnonzero(phrases.there[n - 1] & may_hold(wanted, keys))
                    keys, first = np.unique(keys[at], return_index=True)
                    owner = np.searchsorted(ends, at[first], "right")
                    for key, i, o in zip(keys.tolist(), at[first].tolist(), owner.tolist()):
                        name = langs[o], b" ".join(words[i : i + n])
                        if held.setdefault(key, name) != name:  # two phrases share a hash: show both
                            yield rows({key: name})
                if len(held) > SPELLED:
                    yield rows(held)
                    held = {}
        yield rows(held)

    return spell


def spelled(texts: DataFrame, keys: DataFrame, longest: int, shards: int, bits: int = SLOT_BITS, seed: int = 0) -> DataFrame:
    """(key, lang, phrase, shared) of the phrases (key) of two words and more; ``shared`` if two of them have the key.

    Shard after shard, each asked only for what those before did not spell.
    """
    name = F.struct("lang", "phrase")
    left, out = keys.where(_level(F.col("key")) > 1).select("key"), []
    for shard in range(shards):
        wanted = bit_table(left, bits)
        if not wanted.any():
            break
        rows = texts.where(F.col("shard") == shard).select("lang", "text")
        named = rows.mapInArrow(_spell(Shipped(wanted), longest, seed), "key long, lang string, phrase string")
        names = named.groupBy("key").agg(F.min(name).alias("name"), F.max(name).alias("other")).join(left, "key", "left_semi")
        names = names.select("key", "name.lang", "name.phrase", (F.col("name") != F.col("other")).alias("shared"))
        out.append(materialize(names, "spelled-phrases"))
        left = materialize(left.join(out[-1].select("key"), "key", "left_anti"), "unspelled-phrases")
    empty = texts.sparkSession.createDataFrame([], "key long, lang string, phrase string, shared boolean")
    return _union(out or [empty])


def _cut(longest: int, seed: int):
    """(key, lang, phrase) -> also the keys of both parts of each cut and of all shorter phrases inside."""
    names = ["key", "lang", "phrase", "firsts", "rests", "inner"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = Phrases(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), longest, seed)
            keys = [k.view(np.int64).tolist() for k in phrases.keys]
            out, begin = [], 0
            for end in phrases.ends:
                n = end - begin - 1
                firsts = [keys[k - 1][begin] for k in range(1, n)]
                rests = [keys[n - k - 1][begin + k] for k in range(1, n)]
                inner = [keys[m - 1][begin + i] for m in range(2, n) for i in range(n - m + 1)]
                out.append((firsts, rests, inner))
                begin = end
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (zip(*out) if out else ([], [], []))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names[:3]], *lists], names)

    return cut


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of 38 digits, enough for 10**16 occurrences."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = (wide(a) * wide(a)) * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", top, wide(left) * wide(right)).cast("long")


def scored(names: DataFrame, counts: DataFrame, longest: int, seed: int = 0) -> DataFrame:
    """Candidates (lang, phrase, a, l, r, score) that no longer candidate covers.

    ``names`` are (key, lang, phrase), ``counts`` (key, n) of all frequent phrases.
    """
    schema = "key long, lang string, phrase string, firsts array<long>, rests array<long>, inner array<long>"
    cut = names.select("key", "lang", "phrase").mapInArrow(_cut(longest, seed), schema)
    cut = materialize(cut.join(counts.withColumnRenamed("n", "a"), "key"), "candidate-phrases")
    side = lambda key, n: counts.select(F.col("key").alias(key), F.col("n").alias(n))
    cuts = cut.select("key", "a", F.posexplode(F.arrays_zip("firsts", "rests")).alias("k", "parts"))
    cuts = cuts.select("key", "a", "k", "parts.firsts", "parts.rests").join(side("firsts", "l"), "firsts").join(side("rests", "r"), "rests")
    score = exact_score(F.col("a"), F.col("l"), F.col("r"))
    best = cuts.groupBy("key").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    longer = cut.select(F.explode("inner").alias("key"), "a").groupBy("key").agg(F.max("a").alias("longer"))
    kept = cut.join(best, "key").join(longer, "key", "left")
    covered = F.coalesce(F.col("longer") * 100 >= F.col("a") * CONTAINED_PERCENT, F.lit(False))
    return kept.where(~covered).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def ranked(candidates: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language by score, frequency and phrase, with their rank."""
    candidates = materialize(candidates, "scored-phrases")
    # scores are whole numbers up to a million, so a language's histogram is bounded
    levels = candidates.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("same"))
    above = F.sum("same").over(W.partitionBy("lang").orderBy(F.desc("score"))) - F.col("same")
    reach = levels.withColumn("above", above).where(F.col("above") < top).groupBy("lang").agg(F.min("score").alias("least"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    near = candidates.join(reach, "lang").where("score >= least").withColumn("salt", salt)
    near = near.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    place = F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")
    return near.withColumn("rank", place).where(F.col("rank") <= top).drop("salt", "least")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> the number of words of each language, one row each in a task."""
    total: Counter[str] = Counter()
    for batch in batches:
        for part in slices(batch, "text", BATCH_BYTES):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text")):
                # what separates pieces and words is white space now, and the only one there is
                total[lang] += len(text.as_py().encode().translate(_PIECES).split())
    columns = [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["lang", "n"])


def word_totals(texts: DataFrame) -> DataFrame:
    """(lang, n): all word occurrences of texts (lang, text).

    Counted text by text in the tasks: a regular expression of Spark's would hold every
    word of a text as a string before it counts them.
    """
    counted = texts.select("lang", "text").mapInArrow(_count_words, "lang string, n long")
    return materialize(counted.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    top: int = TOP,
    longest: int = LONGEST,
    shards: int = SHARDS,
    bits: int = SLOT_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two to ``longest`` (3 at most) words of each language."""
    if longest not in (2, 3):
        raise ValueError("phrases have two or three words")
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    shard = F.monotonically_increasing_id() % shards
    texts = docs.select(lang.alias("lang"), F.col(text_col).alias("text")).where(F.length("text") > 0).withColumn("shard", shard)
    path = scratch_path(spark, "phrase-shards")
    texts.write.partitionBy("shard").parquet(path)
    texts = spark.read.schema("lang string, text string, shard long").parquet(path)
    seed, names = -1, None
    while names is None or not names.where("shared").isEmpty():
        seed += 1
        counts = frequent(texts, threshold, longest, shards, bits, seed)
        names = spelled(texts, counts, longest, shards, bits, seed)
    totals = word_totals(texts)
    best = ranked(scored(names, counts, longest, seed), top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
