"""From raw documents to encoded training text, in five stages.

Each stage takes what its predecessor kept.  All but the last return the columns of
documents; the last returns the encoded documents.

Odd inputs are those of the operators: null and empty texts are short texts to the
classifier and one group to the near-duplicate stage; documents of which nothing is left
go; a null id stays only where a group has no other; extra columns are kept; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlab.llm import mixing, pieces, simhash, suffix_dedup, weak_labels
from basketlab.storage import materialize


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return weak_labels.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash fingerprints linked at four or fewer differing bits stays."""
    return simhash.keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings that also start earlier are cut out; documents of which nothing is left go."""
    cut = suffix_dedup.deduplicated(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents leave or come up to three times, so that sources reach their target weights."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", classified),
    ("SimHash near-dedup", without_near_copies),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding", encoded),
]

# No stage can be stated in SQL: models, hashes and byte strings decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; every other stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
