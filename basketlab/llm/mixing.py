"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is counted in blocks of equally many words: ``block_words``, or fewer, down to
one, so that a block is at most a fiftieth of the smallest source.  Sources get seats (blocks) by
the highest quotients target/(2k-1); the seats of a source go to its shards the same
way; a shard's documents form one stream in seeded order, cut into blocks, and the
shard's quota is dealt over its blocks from a seeded start, so every block is taken
either m or m+1 times.  All of it is DataFrame expressions.

Scale: one pass counts words; after that only (id, source, size) moves.  A source is
cut into shards of about ``shard_words`` words, so a source with a third of all rows
spreads over many tasks.  Windows without a partition run over the table of sources
(one row each, so some millions of sources are the bound), those by source over its
shards (one row each).  Candidate quotients
are at most three per row, because seats that are certain are counted, not listed.

Defined results: null text has size 0; null is a source of its own, ordered last;
sources of size 0 get target 0; a null id is an id like any other; repeated rows are
separate documents; an empty table gives an empty result; other columns are ignored
(or, with ``keep_rows``, carried along untouched).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlab.llm.words import word_count
from basketlab.storage import materialize

MAX_REPEATS = 3
SMALLEST_SHARE = 50  # a block is at most this part of the smallest source


def targets(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> and weight, target.

    Weights go round the sources by code point, null last.  A target stops at ``cap``
    times the source's size and the excess is shared again by weight.  With sources
    ordered by cap/weight the capped ones come first; the level that the rest share
    is the largest value of (what is left) / (weight that is left).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    order = [F.col("_ratio"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    return (
        sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
        .withColumn("_cap", F.lit(float(cap)) * F.col("source_size"))
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_left", F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_level", F.max(F.col("_left") / F.sum("weight").over(after)).over(whole))
        .withColumn("target", F.least(F.col("_cap"), F.col("weight") * F.col("_level")).cast("double"))
        .select("source", "source_size", "weight", "target")
    )


def apportion(parties: DataFrame, group: list[str], key: list[str], votes: str, seats: str) -> DataFrame:
    """Adds ``quota``: the seats of each party by highest quotients votes/(2k-1) within its group.

    ``seats`` is the number to hand out, equal on all rows of a group; ties go to the
    first key.  Seats that a party holds at a lower and at a higher total bound the
    contested ones, at most three for each party on average; only those are ranked.
    """
    everyone = Window.partitionBy(*group)
    share = F.col(votes) / F.col("_votes")
    best = Window.partitionBy(*group).orderBy(F.col("_quotient").desc(), *[F.col(k).asc_nulls_last() for k in key])
    held = (
        parties.withColumn("_votes", F.sum(votes).over(everyone).cast("double"))
        .withColumn("_n", F.count(F.lit(1)).over(everyone))
        .withColumn("_share", F.when(F.col("_votes") > 0, share).otherwise(0.0))
        .withColumn("_sure", F.floor(F.col("_share") * F.greatest(F.col(seats) - F.col("_n"), F.lit(0)) + 0.5))
        .withColumn("_most", F.floor(F.col("_share") * (F.col(seats) + F.col("_n")) + 0.5))
        .withColumn("_sure", F.when(F.col(seats) > F.col("_n"), F.col("_sure")).otherwise(F.lit(0)).cast("long"))
        .withColumn("_open", F.col(seats) - F.sum("_sure").over(everyone))
    )
    contested = F.when(F.col("_most") > F.col("_sure"), F.sequence(F.col("_sure") + 1, F.col("_most").cast("long")))
    names = [*parties.columns, "_sure"]
    return (
        held.withColumn("_seat", F.explode_outer(contested))
        .withColumn("_quotient", F.coalesce(F.col(votes) / (2 * F.col("_seat") - 1), F.lit(-1.0)))
        .withColumn("_won", ((F.row_number().over(best) <= F.col("_open")) & F.col("_seat").isNotNull()).cast("long"))
        .groupBy(*names)
        .agg(F.sum("_won").alias("_won"))
        .withColumn("quota", F.col("_sure") + F.col("_won"))
        .drop("_sure", "_won")
    )


def _taken_before(x: Column) -> Column:
    """Words that the mix takes from the first ``x`` words of a shard's stream."""
    block = F.col("_block")
    j = F.floor(x / block).cast("long")
    turn = lambda k: F.floor((k + F.col("_offset")) * F.col("_extra") / F.col("_blocks")).cast("long")
    whole = turn(j) - turn(F.lit(0))
    in_block = (turn(j + 1) - turn(j)) * (x - j * block)
    return F.col("_times") * x + block * whole + in_block


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (1, 2, 3),
    seed: int = 42,
    block_words: int = 8,
    shard_words: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep_rows: bool = False,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies) of every row, and ``row`` with ``keep_rows``.

    ``taken`` counts words with repeats, at most three times the size.  ``copies`` is
    the same mix in whole documents: the running share is rounded along the stream,
    so the copies of a shard add up to its share.
    """
    columns = [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")]
    sized = docs.select(*columns, *([F.struct("*").alias("row")] if keep_rows else []))
    if not keep_rows:
        sized = materialize(sized, "mix-sizes")
    sources = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    smallest = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(Window.partitionBy())
    block = F.greatest(F.least(F.floor(smallest / SMALLEST_SHARE), F.lit(block_words)), F.lit(1)).cast("long")
    goals = targets(sources, weights).withColumn("_block", F.coalesce(block, F.lit(1).cast("long")))
    goals = goals.withColumn("_seats", F.round(F.sum("target").over(Window.partitionBy()) / F.col("_block")).cast("long"))
    seats = apportion(goals, [], ["source"], "target", "_seats").withColumnRenamed("quota", "_source_quota")
    seats = seats.withColumn("_shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long"))
    seats = materialize(seats.select("source", "source_size", "target", "_source_quota", "_shards", "_block"), "mix-seats")

    place = F.xxhash64(F.lit(seed), F.col("doc_id"))
    dealt = sized.join(seats.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    dealt = dealt.withColumn("_place", place).withColumn("_shard", F.pmod(F.xxhash64("_place"), F.col("_shards")))
    if not keep_rows:
        dealt = materialize(dealt, "mix-dealt")
    shards = dealt.groupBy("source", "_shard").agg(
        F.sum("size").alias("_shard_size"), F.max("_source_quota").alias("_source_quota"), F.max("_block").alias("_block")
    )
    quotas = apportion(shards, ["source"], ["_shard"], "_shard_size", "_source_quota")
    quotas = (
        quotas.withColumn("_blocks", F.greatest(F.ceil(F.col("_shard_size") / F.col("_block")), F.lit(1)).cast("long"))
        .withColumn("quota", F.least(F.col("quota"), MAX_REPEATS * F.col("_blocks")))
        .withColumn("_times", F.floor(F.col("quota") / F.col("_blocks")).cast("long"))
        .withColumn("_extra", F.col("quota") - F.col("_times") * F.col("_blocks"))
        .withColumn("_offset", F.pmod(F.xxhash64(F.lit(seed), "source", "_shard"), F.col("_blocks")))
    )
    quotas = materialize(
        quotas.select(
            F.col("source").alias("_source"), F.col("_shard").alias("_of"), "_block", "_blocks", "_times", "_extra", "_offset"
        ),
        "mix-quotas",
    )
    stream = Window.partitionBy("source", "_shard").orderBy("_place", F.col("doc_id").asc_nulls_last(), "size")
    so_far = stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ratio = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0.0)
    return (
        dealt.withColumn("_end", F.sum("size").over(so_far))
        .drop("_source", "_block")
        .join(quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_of")))
        .withColumn("taken", _taken_before(F.col("_end")) - _taken_before(F.col("_end") - F.col("size")))
        .withColumn("_ratio", ratio)
        .withColumn("_copies", F.sum("_ratio").over(so_far))
        .withColumn("copies", (F.floor(F.col("_copies") + 0.5) - F.floor(F.col("_copies") - F.col("_ratio") + 0.5)).cast("int"))
        .select("doc_id", "source", "size", "source_size", "target", "taken", "copies", *(["row"] if keep_rows else []))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, whole, each as often as the mix repeats it."""
    return (
        mix(docs, keep_rows=True, **options)
        .where(F.col("copies") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("row.*")
    )
