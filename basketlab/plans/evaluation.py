"""Evaluation and parameter study of a trained model, published as documents."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketlab.functions.labels import EVALUATION_KS, SWEEP_CONFIGS, SWEEP_MIN_ITEM_FREQ
from basketlab.operators import baskets as B
from basketlab.operators import evaluate as E
from basketlab.operators import mining as M
from basketlab.plans.market_basket import Model, Settings, in_scope
from basketlab.sinks import publish as P
from basketlab.sources.retail import Retail
from basketlab.storage import materialize


def evaluation_document(
    model: Model,
    baskets: DataFrame,
    catalog_size: Column,
    ks: Sequence[int] = EVALUATION_KS,
) -> DataFrame:
    """One row: how many baskets were looked at, what the rules can reach, measures per K."""
    header = E.evaluation_header(baskets)
    sides = M.rule_sides(model.rules, catalog_size)
    measures = E.evaluate(baskets, model.rules, model.popular, catalog_size, ks)
    return header.select(
        "*",
        catalog_size.alias("catalog_size"),
        *[sides.select(c).scalar().alias(c) for c in sides.columns],
        P.rows_as_array(measures, ["k"]).alias("metrics_by_k"),
    )


def publish_evaluation(
    model: Model, baskets: DataFrame, catalog_size: Column, out_dir: str, settings: Settings = Settings()
) -> None:
    """Evaluation document and one row per sweep configuration below ``out_dir``.

    Every configuration is reported: if one lies below the support of the model, the
    model's baskets are mined again at the lowest support asked for, in as many
    partitions as the ``settings`` say.
    """
    P.write_table(
        evaluation_document(model, baskets, catalog_size), f"{out_dir}/evaluation", "json"
    )
    lowest = min(support for _, support, _ in SWEEP_CONFIGS)
    itemsets = model.itemsets
    if lowest < model.min_support:
        itemsets = M.mine(model.baskets, lowest, model.n_baskets, settings.mining_partitions)
    P.write_table(M.sweep(itemsets, model.n_baskets, SWEEP_CONFIGS, settings.min_lift), f"{out_dir}/experiments")


STUDY = Settings(min_item_freq=SWEEP_MIN_ITEM_FREQ)


def parameter_study(
    retail: Retail, configs: Sequence[tuple[str, float, float]] = SWEEP_CONFIGS, settings: Settings = STUDY
) -> DataFrame:
    """One row per configuration on baskets of their own, pruned at a lower item threshold.

    Split, item threshold, basket size, lift and mining partitions follow the ``settings``; support and
    confidence follow each configuration.  Baskets and itemsets are computed once, at
    the lowest support, for all configurations; ``training_seconds`` is that shared
    mining time and ``total_seconds`` adds the preparation of the baskets.
    """
    started = time.perf_counter()
    scope = in_scope(retail, settings)
    built = B.build_baskets(scope.lines, scope.products, settings.min_item_freq, settings.min_basket_size)
    baskets = materialize(built.select("items"), "baskets")
    n = baskets.count()
    prepared = time.perf_counter()
    itemsets = M.mine(baskets, min(support for _, support, _ in configs), n, settings.mining_partitions)
    mined = time.perf_counter()
    return M.sweep(itemsets, n, configs, settings.min_lift).select(
        "*",
        F.lit(round(mined - prepared, 2)).alias("training_seconds"),
        F.lit(round(mined - started, 2)).alias("total_seconds"),
    )
