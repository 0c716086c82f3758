"""Similarity join on word n-grams by rare-first prefix filtering.

Two documents link when their sets of distinct four-word shingles have a Jaccard
similarity of 0.85 or more.  Shingles have one order, rare ones first; sets at the
threshold share a shingle within their prefixes, the first n - ceil(0.85 n) + 1 of n.
Only sets that meet there are candidates.  They are tested, cheapest first, by

* length: neither may be smaller than 0.85 of the other;
* position: behind the first common shingle of both prefixes there must be enough left;
* suffix: the shingles are split into 128 parts by their hash, and the smaller counts of
  each part must add up to enough;

and each pair that passes is verified once, by intersecting the whole sets.

The order follows counts in a hashed table of fixed size, in steps of an eighth of a
doubling, then the hash.  Any order that all documents share finds every link; the
table's size decides only how well it tells rare from frequent on a large corpus.

Documents with equal sets are one class, before anything is joined.  A large group of
near copies would still meet pair by pair, so links are sought in rounds.  In a round
each shared shingle picks a hub, the member whose shingles are the most frequent ones
of the corpus (in a group of edited copies that is the original or what is nearest to
it), and members are paired with hubs only.  Links found make components; a shingle
whose members are all in one component has nothing left to tell.  After the hub rounds
the pairs that remain between different components are all tested.  A pair within one
component cannot change the result and is the only thing left out.

Scale: the texts are read twice for their shingles and once more in each round for the
texts of the pairs that passed; 15 % of the shingles are shuffled once, as four longs, and those that two
classes share are told where they arrive.  A table of flags of fixed size thins out the
texts where they lie, before the exact joins; on a corpus that fills it it thins out
less.  Sets of candidates alone are moved.  All joins are equi-joins that adaptive
execution can split.

Defined results: null, empty and blank texts have an empty set and are linked with
nothing; one to three words make one shingle; a null id counts only when a component
has no other; repeated rows are returned once each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlab.llm.components import connected_components
from basketlab.llm.counting import Shipped, bit_table, count_table, may_hold
from basketlab.llm.words import lower_words, mixed, slices
from basketlab.storage import materialize

SHINGLE = 4
PERCENT = 85
SEED = 42
RARITY_BITS = 22
TOKEN_BITS = 56
PIVOTS = 128
HUB_ROUNDS = 2
BEFORE = 4
FILTER_BITS = 23
BATCH_BYTES = 1 << 20


def shingle_hashes(text: str | None) -> np.ndarray:
    """Distinct hashes of the shingles, from those of their words; empty without words."""
    words = lower_words(text)
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(w, SEED) for w in words], np.uint64)
    last = max(1, len(words) - SHINGLE + 1)
    out = hashes[:last]
    for i in range(1, min(SHINGLE, len(words))):
        out = mixed(out, hashes[i : last + i])
    return np.unique(out)


def _slots(bits: int):
    def slots(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in slices(batch, "text", BATCH_BYTES):
            for text in part.column("text"):
                yield (shingle_hashes(text.as_py()) >> np.uint64(64 - bits)).astype(np.int64)

    return slots


def rarity(texts: DataFrame, bits: int = RARITY_BITS) -> np.ndarray:
    """A byte for each slot of the table: the logarithm of its count."""
    counts = count_table(texts, _slots(bits), 1 << bits, 4096)
    return np.minimum(8 * np.log2(counts + 1), 255).astype(np.uint8)


def tokens(hashes: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Shingles as sorted numbers below 2**63: rarity on top, then the hash."""
    bits = len(rare).bit_length() - 1
    top = rare[(hashes >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64) >> np.uint64(1)
    return np.sort(top << np.uint64(TOKEN_BITS) | hashes & np.uint64((1 << TOKEN_BITS) - 1)).astype(np.int64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


_MARKED = "doc_id long, text_key long, n_shingles long, set_key binary, short_key long, usual int, parts array<int>, prefix array<long>"
_MARKED_TYPE = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
     ("short_key", pa.int64()), ("usual", pa.int32()), ("parts", pa.list_(pa.int32())), ("prefix", pa.list_(pa.int64()))]
)


def _parts(found: np.ndarray) -> np.ndarray:
    """Members between fixed pivots; the low bits of a hash place it evenly."""
    return np.bincount(found & (PIVOTS - 1), minlength=PIVOTS).astype(np.int32)


def _mark(sent: Shipped, percent: int):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = sent.open()
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                rows = []
                for doc_id, text_key, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))):
                    hashes = shingle_hashes(text)
                    found = tokens(hashes, rare)
                    n = len(found)
                    usual = int((found >> TOKEN_BITS).sum()) // n if n else 0
                    key = xxhash.xxh3_128_digest(hashes.tobytes(), SEED)
                    short = int.from_bytes(key[:8], "big", signed=True)
                    rows.append((doc_id, text_key, n, key, short, usual, _parts(found), found[: prefix_length(n, percent)] if n else found))
                columns = list(zip(*rows)) if rows else [()] * len(_MARKED_TYPE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _MARKED_TYPE)], schema=_MARKED_TYPE
                )

    return mark


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with short_key, n_shingles, prefix -> prefix shingles (token, short_key, n, pos), of copies in a batch those of one."""
    for batch in batches:
        _, at = np.unique(batch.column("short_key").to_numpy(), return_index=True)
        batch = batch.take(pa.array(np.sort(at)))
        prefix = batch.column("prefix")
        token = prefix.flatten().to_numpy()
        size = np.diff(prefix.offsets.to_numpy())
        pos = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
        key, n = (np.repeat(batch.column(c).to_numpy(), size) for c in ("short_key", "n_shingles"))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (token, key, n, pos)], ["token", "short_key", "n", "pos"])


def _wanted_texts(sent: Shipped):
    """Rows whose text_key has its slots set."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.open()
        for batch in batches:
            yield batch.filter(pa.array(may_hold(wanted, batch.column("text_key").to_numpy())))

    return keep


def _sets(sent: Shipped):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = sent.open()
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                found = [tokens(shingle_hashes(t.as_py()), rare) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("cls"), pa.array(found, pa.list_(pa.int64()))], ["cls", "members"])

    return sets


def needed(n: Column, m: Column, percent: int) -> Column:
    """Least intersection of sets of n and m members at the threshold."""
    return F.ceil((n + m) * percent / (100 + percent))


def _like_sizes(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _met(pairs: DataFrame, percent: int) -> DataFrame:
    """Rows (a, n, i, b, m, j), a shingle in both prefixes -> distinct pairs that length and position let pass.

    The shingle need not be the pair's first common one: as many as lie before it may be common too.
    """
    left = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    enough = needed(F.col("n"), F.col("m"), percent)
    like = pairs.where(_like_sizes(F.col("n"), F.col("m"), percent) & (F.least("i", "j") + left >= enough))
    return like.select("a", "n", "b", "m").distinct()


def _verified(pairs: DataFrame, digests: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Links (a, b) among distinct pairs (a, n, b, m): the suffix filter first, then the whole sets of what is left."""

    def side(table: DataFrame, name: str, column: str) -> DataFrame:
        return table.select(F.col("cls").alias(name), F.col(column).alias(f"{column}_{name}"))

    common = F.aggregate(
        F.arrays_zip("parts_a", "parts_b"), F.lit(0).cast("long"), lambda n, x: n + F.least(x["parts_a"], x["parts_b"])
    )
    likely = pairs.join(side(digests, "a", "parts"), "a").join(side(digests, "b", "parts"), "b")
    likely = materialize(likely.where(common >= needed(F.col("n"), F.col("m"), percent)).select("a", "b"), "likely-pairs")
    if likely.isEmpty():
        return likely
    sets = fetch(likely.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
    both = likely.join(side(sets, "a", "members"), "a").join(side(sets, "b", "members"), "b")
    shared = F.size(F.array_intersect("members_a", "members_b"))
    either = F.size("members_a") + F.size("members_b") - shared
    return materialize(both.where(shared * 100 >= either * percent).select("a", "b"), "set-links")


def _paired(one: DataFrame, other: DataFrame) -> DataFrame:
    """Columns a, n, i, b, m, j from two tables of members that meet by token, in different components."""
    left = one.select("token", F.col("cls").alias("a"), "n", F.col("pos").alias("i"), F.col("component").alias("_one"))
    right = other.select(
        "token", F.col("cls").alias("b"), F.col("n").alias("m"), F.col("pos").alias("j"), F.col("component").alias("_two")
    )
    return left.join(right, "token").where("_one <> _two").drop("token", "_one", "_two")


def _spread(members: DataFrame) -> DataFrame:
    """Rows (cls, n, component, pos, met, before): a shared shingle of a member and at most ``BEFORE`` of those just before it."""
    in_order = F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("rows")
    of_class = members.groupBy("cls", "n", "component").agg(in_order)
    spread = of_class.select("cls", "n", "component", "rows.token", F.posexplode("rows").alias("at", "row"))
    kept = F.least(F.col("at"), F.lit(BEFORE))
    before = F.slice("token", F.col("at") - kept + 1, kept).alias("before")
    return spread.select("cls", "n", "component", "row.pos", F.col("row.token").alias("met"), before)


def _all_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, n, b, m) of members in different components that length and position let pass.

    Each row carries the last ``BEFORE`` shared shingles that its member has before, so a
    pair comes out at its first common shingle and again only where none of these is
    common; what comes out twice is dropped.  A row's size does not grow with the prefix.
    """
    spread = _spread(members)
    one = spread.select(*[F.col(c).alias(d) for c, d in (("cls", "a"), ("n", "n"), ("pos", "i"), ("component", "c1"), ("met", "met"), ("before", "b1"))])
    two = spread.select(*[F.col(c).alias(d) for c, d in (("cls", "b"), ("n", "m"), ("pos", "j"), ("component", "c2"), ("met", "met2"), ("before", "b2"))])
    left = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    passes = (
        (F.col("met") == F.col("met2"))
        & (F.col("a") < F.col("b"))
        & (F.col("c1") != F.col("c2"))
        & _like_sizes(F.col("n"), F.col("m"), percent)
        & (left >= needed(F.col("n"), F.col("m"), percent))
        & ~F.arrays_overlap("b1", "b2")
    )
    return one.join(two, passes).select("a", "n", "b", "m").dropDuplicates(["a", "b"])


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with their component now, of those shingles that meet in several components."""
    placed = members.drop("component").join(found, F.col("cls") == F.col("node"), "left").drop("node")
    placed = placed.withColumn("component", F.coalesce("component", "cls"))
    several = placed.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return placed.join(several.where("least <> most").select("token"), "token", "left_semi")


def link_classes(
    classes: DataFrame, fetch: Callable[[DataFrame], DataFrame], members: DataFrame, percent: int, rounds: int
) -> DataFrame:
    """(node, component) of all classes (cls, parts) that have a link.

    ``members`` are (token, cls, n, pos); ``fetch`` turns classes (cls) into their sets
    (cls, members).  At least one of the ``rounds`` with hubs is needed.
    """
    if rounds < 1:
        raise ValueError("rounds is 1 or more")
    digests = classes.select("cls", "parts")
    open_ = members.withColumn("component", F.col("cls")).withColumn("hub", F.lit(-1).cast("long"))
    links, tested = None, None
    for _ in range(rounds):
        # the next hub of a shingle: the most usual member that has not been one
        hub = F.min(F.when(F.col("cls") > F.col("hub"), F.struct("cls", "n", "pos", "component")))
        hubs = open_.groupBy("token").agg(hub.alias("h")).where("h is not null").select("token", "h.*")
        met = _met(_oriented(_paired(hubs, open_)), percent)
        met = materialize(met if tested is None else met.join(tested, ["a", "b"], "left_anti"), "hub-pairs")
        new = _verified(met, digests, fetch, percent)
        links = new if links is None else links.unionByName(new)
        tested = met.select("a", "b") if tested is None else tested.unionByName(met.select("a", "b"))
        found = connected_components(links)
        tried = hubs.select("token", F.col("cls").alias("hub"))
        open_ = materialize(_open(members, found).join(tried, "token", "left").fillna(1 << 62, ["hub"]), "open-members")
        if open_.isEmpty():
            return found
    rest = _all_pairs(open_, percent).join(tested, ["a", "b"], "left_anti")
    new = _verified(materialize(rest, "rest-pairs"), digests, fetch, percent)
    return connected_components(links.unionByName(new))


def _oriented(pairs: DataFrame) -> DataFrame:
    """The same rows with a < b."""
    turn = F.col("a") > F.col("b")
    swap = lambda x, y: F.when(turn, F.col(y)).otherwise(F.col(x))
    names = [("a", "b"), ("n", "m"), ("i", "j"), ("b", "a"), ("m", "n"), ("j", "i")]
    return pairs.select(*[swap(x, y).alias(x) for x, y in names])


def join_similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    bits: int = RARITY_BITS,
    rounds: int = HUB_ROUNDS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; component_id is the smallest id reachable over links."""
    text = F.col(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    rare = Shipped(rarity(texts.select("text"), bits))
    marked = materialize(keyed.mapInArrow(_mark(rare, percent), _MARKED), "shingle-prefixes")

    # classes of equal sets, numbered so that a smaller number means more usual shingles
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    filled = marked.where("n_shingles > 0")
    grouped = filled.groupBy("set_key").agg(
        F.min(first).alias("first"), F.min("short_key").alias("short_key"), F.min("usual").alias("usual"), F.min("parts").alias("parts")
    )
    number = F.shiftleft((F.lit(127) - F.col("usual")).cast("long"), 55) + F.monotonically_increasing_id()
    classes = materialize(grouped.withColumn("cls", number), "shingle-classes")

    # prefix shingles of two classes or more; copies have one key and share nothing
    entries = filled.select("short_key", "n_shingles", "prefix").mapInArrow(_entries, "token long, short_key long, n long, pos long")
    together = Window.partitionBy("token")
    ends = entries.withColumn("least", F.min("short_key").over(together)).withColumn("most", F.max("short_key").over(together))
    # what lies together by shingle need not move again to lose its copies
    met = ends.where("least <> most").drop("least", "most").dropDuplicates(["token", "short_key"])
    members = materialize(met.join(classes.select("short_key", "cls"), "short_key").drop("short_key"), "prefix-members")

    places = classes.select("cls", "first.doc_id", "first.text_key")

    def fetch(ids: DataFrame) -> DataFrame:
        """Whole sets of classes, from the text of one row of each; other texts go where they are read."""
        wanted = materialize(places.join(ids, "cls"), "wanted-classes")
        flags = Shipped(bit_table(wanted.select("text_key"), FILTER_BITS))
        thinned = keyed.mapInArrow(_wanted_texts(flags), "doc_id long, text string, text_key long")
        row = F.col("k.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("k.text_key") == F.col("w.text_key"))
        again = thinned.alias("k").join(wanted.alias("w"), row).select("w.cls", "k.text").dropDuplicates(["cls"])
        return materialize(again.mapInArrow(_sets(rare), "cls long, members array<long>"), "shingle-sets")

    found = link_classes(classes, fetch, members, percent, rounds)
    placed = classes.join(found, F.col("cls") == F.col("node"), "left").select(
        "set_key", F.col("first.doc_id").alias("first"), F.coalesce("component", "cls").alias("component")
    )
    placed = materialize(placed, "placed-classes")
    ids = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    classed = materialize(placed.join(ids, "component").select("set_key", "component_id"), "class-components")
    whole = filled.join(classed, "set_key")
    alone = marked.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return whole.select("doc_id", "n_shingles", "component_id").unionByName(alone.select("doc_id", "n_shingles", "component_id"))
