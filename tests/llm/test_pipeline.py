"""The stages one after another on the smallest tables."""

from conftest import SMALL

import corpus_pipeline
from basketlab.llm import queries
from basketlab.storage import materialize


def test_stages(spark):
    docs = queries.table(spark, SMALL, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        assert docs.columns == columns, name
        docs = materialize(stage(spark, docs, SMALL), "stage")
        sizes.append(docs.count())
        if name == "suffix-array dedup":
            assert docs.where("n_chars <> length(text)").count() == 0
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    assert docs.where("not exact").count() == 0 and docs.where("n_pieces > 0").count() > 0


def test_the_near_duplicate_stage_is_the_operator(spark):
    """One document of each component that op6 reports stays, with extra columns of any name."""
    docs = queries.table(spark, SMALL, "documents").selectExpr("*", "'x' AS _id", "'y' AS _key", "'z' AS _text_key", "1 AS row")
    kept = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    groups = {r["component_id"] for r in queries.REGISTRY["op6_simhash"](spark, SMALL).collect()}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == groups and kept.count() == len(groups)


def test_one_query_for_each_operator():
    import __spark_entry__

    numbers = sorted(int(n[2:].split("_")[0]) for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()
