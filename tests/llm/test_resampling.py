"""Importance resampling against one CRC for each feature."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from cases import ROWS, documents, empty
from conftest import SMALL

from basketlab.llm import importance, queries

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TARGET = [("The old river runs slowly past the QUIET mill",), (None,), ("",), ("日本語 bridges 7",)]


def brute_features(text):
    words = WORD.findall((text or "").encode().lower())
    return [b" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def brute(rows, target, percent=5, min_words=20):
    """Rows (doc_id, text) -> (doc_id, n_features, weight, score, rank)."""
    counts = lambda texts: Counter(crc32(f) % 10000 for t in texts for f in brute_features(t)[0])
    s, t = counts([x for _, x in rows]), counts(target)
    s_all, t_all = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000.0) / ((s[b] + 1.0) * (t_all + 10000.0))))
    out = []
    for doc_id, text in rows:
        found, n_words = brute_features(text)
        weight = sum(gain(crc32(f) % 10000) for f in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n_words])
    fit = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): i for i, r in enumerate(fit[: len(fit) * percent // 100], 1)}
    return [(*r[:4], ranks.get(id(r))) for r in out]


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_resampling(spark, percent):
    target = spark.createDataFrame(TARGET, "text string")
    got = importance.resample(documents(spark), target, percent=percent).drop("n_words").collect()
    want = brute([r[:2] for r in ROWS], [t for (t,) in TARGET], percent)
    assert Counter(map(tuple, got)) == Counter(want)


def test_whole_table(spark):
    docs, target = (queries.table(spark, SMALL, n) for n in ("documents", "benchmark"))
    got = queries.REGISTRY["op12_importance_resampling"](spark, SMALL).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert Counter(map(tuple, got)) == Counter(brute(rows, [r[0] for r in target.select("text").collect()]))


def test_ranks_over_many_partitions(spark):
    """Equal scores, equal ids and null ids spread over the sorted partitions."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(3000).selectExpr("if(id % 3 = 0, null, id % 50) AS doc_id", "repeat(concat('w', id % 7, ' '), 25) AS text")
        got = importance.resample(rows, spark.createDataFrame(TARGET, "text string"), percent=50).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 1501))
    key = lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"] or 0)
    assert [key(r) for r in drawn] == sorted(key(r) for r in got)[:1500]


def test_odd_inputs(spark):
    target = spark.createDataFrame(TARGET, "text string")
    assert importance.resample(empty(spark), target).count() == 0
    assert importance.resample(documents(spark), target.limit(0)).count() == len(ROWS)
    clash = documents(spark).selectExpr("*", "'x' AS `a.b`", "'x' AS rank")
    drawn = importance.draw(clash, target, percent=100)
    assert drawn.columns == clash.columns
    fit = [r for r in brute([r[:2] for r in ROWS], [], 100) if r[4]]
    ids = {r[0] for r in fit}
    assert sorted(drawn.select("doc_id").collect(), key=str) == sorted([(r[0],) for r in ROWS if r[0] in ids], key=str)


def test_crc_of_any_run():
    texts = ["x" * 70000 + " b c " + "y" * 300 + " Z", "日本語 9 é", None, " - "]
    n_words, crcs, owners = importance.features(texts)
    want = Counter((i, crc32(f)) for i, t in enumerate(texts) for f in brute_features(t)[0])
    assert Counter(zip(owners.tolist(), crcs.tolist())) == want and n_words.tolist() == [5, 3, 0, 0]
    long = importance.shift(np.array([crc32(b"ab")], np.uint32), np.array([1 << 17]))
    assert int(long[0]) ^ crc32(bytes(1 << 17)) == crc32(b"ab" + bytes(1 << 17))
