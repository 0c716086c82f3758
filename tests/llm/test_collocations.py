"""Collocations against plain counting, and the cycles of the counting."""

import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from cases import ROWS, documents, empty
from compare import compare, connect
from conftest import SMALL

from basketlab.llm import collocations, counting, oracles, queries


def brute(rows, threshold=10, top=2000, longest=3):
    """Rows (lang, text) -> (lang, rank, phrase, a, l, r, n, score)."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        data = (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", data):
            words = [w.decode() for w in re.split(rb"[ \t]+", piece) if w]
            total[lang] += len(words)
            for n in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        covered = Counter()
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    covered[p[i : i + n]] = max(covered[p[i : i + n]], a)
        kept = []
        for p, a in candidates.items():
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if 100 * covered[p] < 50 * a:
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return out


def corpus(seed, n_docs=60):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(30)] + ["New", "york", "cíty", "x.y", " z"]
    rows = []
    for i in range(n_docs):
        some = rng.choice(len(words), rng.integers(0, 60), p=np.r_[np.full(30, 0.5 / 30), np.full(5, 0.1)])
        text = "".join(words[w] + str(rng.choice([" ", "\t ", ", ", "\n", " ", " "])) for w in some)
        rows.append(([None, "en", "", "DE"][i % 4], text + "NEW York city " * (i % 3)))
    return rows


@pytest.mark.parametrize("shards,bits,threshold,longest", [(1, 10, 2, 3), (2, 4, 10, 3), (3, 16, 2, 3), (5, 12, 10, 2)])
def test_collocations(spark, shards, bits, threshold, longest):
    """Whatever the number of shards and slots, also with slots that are all taken."""
    rows = corpus(shards)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = collocations.collocations(docs, threshold=threshold, top=25, longest=longest, shards=shards, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, threshold, 25, longest)
    assert len(want) >= 4 and Counter(map(tuple, got.collect())) == Counter(want)


def test_odd_inputs(spark):
    docs = documents(spark).selectExpr("*", "source AS lang", "'x' AS phrase", "'x' AS start", "'x' AS a")
    got = collocations.collocations(docs, threshold=2).collect()
    assert Counter(map(tuple, got)) == Counter(brute([(r[2], r[1]) for r in ROWS], 2))
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert empty(spark).count() == 0


def test_shared_hash_counts_again(spark, monkeypatch):
    """Under seed 0 all pairs share a few hashes; the result must be that of another seed."""
    seeds = []

    class Poor(collocations.Phrases):
        def __init__(self, langs, texts, longest, seed):
            super().__init__(langs, texts, longest, seed)
            if seed == 0:
                self.keys[1:] = [collocations._leveled(k % np.uint64(5) << np.uint64(50), n) for n, k in enumerate(self.keys[1:], 2)]

    def noted(*args, frequent=collocations.frequent):
        seeds.append(args[-1])
        return frequent(*args)

    monkeypatch.setattr(collocations, "Phrases", Poor)
    monkeypatch.setattr(collocations, "frequent", noted)
    rows = corpus(9)
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), threshold=3)
    assert Counter(map(tuple, got.collect())) == Counter(brute(rows, 3)) and seeds == [0, 1]


def test_word_totals(spark):
    """What no separator cuts is a word; other blanks and control bytes are parts of words."""
    texts = [("en", "a b\u00a0c d\x1ce\x85f"), ("en", ".,;: \t!?\n\x0b\x0c\r"), ("", "x.y z"), ("en", "a\u2028b. c")]
    got = collocations.word_totals(spark.createDataFrame(texts, "lang string, text string").repartition(3))
    assert {r["lang"]: r["n"] for r in got.collect()} == {"en": 5, "": 3}


def test_tasks_hold_one_python_worker(spark, monkeypatch):
    """No step that runs Python feeds another within a task: each takes a worker with the memory of one."""
    seen = []

    def noted(keys, *args, flags=collocations.bit_table, **kwargs):
        seen.append(keys._jdf.queryExecution().executedPlan().toString())
        return flags(keys, *args, **kwargs)

    monkeypatch.setattr(collocations, "bit_table", noted)
    docs = spark.createDataFrame(corpus(4), "lang string, text string")
    assert collocations.collocations(docs, threshold=3).count() > 0
    assert len(seen) > 6 and not any("InArrow" in plan for plan in seen)


def test_every_phrase_sees_each_shard_once():
    """Steps of the subphrases give the first step; a phrase is counted in as many steps as there are shards."""
    phrases = collocations.Phrases(["en"], ["a b c. d"], 3, 0)
    for first, second, third in product([0, 1, 3, collocations.NEVER], repeat=3):
        words = np.full(1 << 12, collocations.NEVER, np.uint8)
        for key, step in zip(phrases.keys[0][:3], (first, second, third)):
            for slot in counting.slots(np.array([key]), 12):
                words[slot] = step
        starts = collocations._starts(phrases, [words, words], 2)
        later = [max(first, second), max(second, third)]
        assert starts[:2].tolist() == [x if x == collocations.NEVER else x + 1 for x in later]
        counted = [[s <= step < s + 4 for step in range(20)].count(True) for s in starts[:2]]
        assert counted == [0 if x == collocations.NEVER else 4 for x in later]


def test_exact_score(spark):
    a, left, right = 9_999_999_999_999_999, 10_000_000_000_000_001, 10_000_000_000_000_003
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(a, left, right), (10, 10, 10), (10, 30, 70)], "a long, l long, r long")
    got = [r[0] for r in rows.select(collocations.exact_score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [10**6 * a * a // (left * right), 10**6, 10**8 // 2100]


@pytest.mark.parametrize("name", ["op11_collocations", "op12_importance_resampling", "op13_jaccard_join"])
def test_sql(spark, name):
    con = connect(SMALL)
    different, rows = compare(spark, con, SMALL, name, queries.REGISTRY[name], oracles.oracle_sql()[name])
    assert not different and rows > 100
