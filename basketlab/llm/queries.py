"""Registered queries of the subpackage: thin calls of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlab.llm import (
    chat,
    collocations,
    hidden_markov,
    importance,
    jaccard_join,
    merkle,
    mixing,
    ngram_rules,
    pieces,
    simhash,
    site_style,
    suffix_dedup,
    weak_labels,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations")).select("conv_id", "n_turns", "n_equal", "rendered")


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_spans(table(spark, sf_dir, "documents"))


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return weak_labels.classify(docs, weak_labels.fit(docs, table(spark, sf_dir, "labels")))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score(table(spark, sf_dir, "documents"))


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extract(table(spark, sf_dir, "pages"))


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_similar(table(spark, sf_dir, "documents"))
