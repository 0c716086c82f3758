"""The similarity join against all pairs."""

from collections import Counter

import numpy as np
import pytest
from cases import ROWS, documents, empty, prose
from conftest import SMALL

from basketlab.llm import counting, jaccard_join, queries


def brute(rows, percent=85):
    """Rows (doc_id, text) -> (doc_id, n_shingles, component_id)."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and a and 100 * len(a & b) >= percent * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for g, (doc_id, _) in zip(group, rows):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return [(doc_id, len(s), least.get(g)) for (doc_id, _), s, g in zip(rows, sets, group)]


def edited(text: str, rng, share: float, tag: str) -> str:
    words = text.split()
    for i in np.flatnonzero(rng.random(len(words)) < share):
        words[i] = f"{tag}{i}"
    return " ".join(words)


@pytest.mark.parametrize("bits", [1, 12])
def test_join(spark, bits):
    """Also with a table of two counters: the order of shingles must not matter for the result."""
    got = jaccard_join.join_similar(documents(spark), bits=bits).collect()
    assert Counter(map(tuple, got)) == Counter(brute([r[:2] for r in ROWS]))
    assert jaccard_join.join_similar(empty(spark)).count() == 0


@pytest.mark.parametrize("rounds", [1, 2])
@pytest.mark.parametrize("percent", [85, 60])
def test_edited_copies(spark, percent, rounds):
    """Groups of edited copies, chains of edits and a common passage, whatever the hubs find."""
    rng, texts = np.random.default_rng(percent), []
    fresh = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 5000, n))
    for group in range(4):
        base = fresh(60 + 40 * group)
        texts += [base, base.upper(), base + " " + fresh(3)]
        texts += [edited(base, rng, 0.02, f"e{group}x{k}") for k in range(8)]
        chain = base
        for k in range(6):
            texts.append(chain := edited(chain, rng, 0.015, f"c{group}x{k}"))
    passage = fresh(50)
    texts += [passage + " " + fresh(n) for n in (5, 8, 12, 20, 40, 60, 60)]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    got = jaccard_join.join_similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), percent=percent, rounds=rounds)
    want = brute(rows, percent)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert 5 < len({c for _, _, c in want}) < len(rows)


def test_threshold_is_met_exactly(spark):
    """17 of 20 shingles link, 16 of 19 do not."""
    words = [f"w{i}" for i in range(40)]
    one = " ".join(words[:20])
    rows = [(1, one), (2, " ".join(words[:23])), (3, " ".join(words[100:]) + "a b c d"), (4, " ".join(words[24:]))]
    sizes = {1: 17, 2: 20, 3: 1, 4: 13}
    got = {r["doc_id"]: r for r in jaccard_join.join_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r["n_shingles"] for i, r in got.items()} == sizes
    assert got[2]["component_id"] == 1 and got[4]["component_id"] == 4
    rows[1] = (2, " ".join(words[1:23]))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.join_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4}


def test_large_group_makes_few_pairs(spark, monkeypatch):
    """400 different edits of one text: pairs tested stay in proportion to the group, not its square."""
    seen = {}

    def counted(df, label, write=jaccard_join.materialize):
        out = write(df, label)
        if label in ("hub-pairs", "rest-pairs"):
            seen[label] = max(seen.get(label, 0), out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", counted)
    rng = np.random.default_rng(1)
    base = " ".join(f"w{x}" for x in rng.integers(0, 900, 300))
    texts = [base]
    for k in range(400):  # each links with the original, few with each other
        words = base.split()
        for i in rng.choice(300, 4, False):
            words[i] = f"e{k}x{i}"
        texts.append(" ".join(words))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = jaccard_join.join_similar(rows).collect()
    assert {r["component_id"] for r in got} == {0} and sum(seen.values()) < 4 * len(texts)


def test_all_pairs_of_long_prefixes(spark):
    """A row carries few shingles however long the prefix, and each pair that shares a shingle comes out once."""
    rng = np.random.default_rng(5)
    sets = [np.sort(rng.choice(400, 40, False)).tolist() for _ in range(30)]
    sets[1] = sorted({*sets[0][::2], *range(1000, 1020)})  # in between, more of its own than a row carries
    rows = [(t, c, 1000, i, c % 7) for c, found in enumerate(sets) for i, t in enumerate(found)]
    members = spark.createDataFrame(rows, "token long, cls long, n long, pos long, component long").repartition(3)
    assert max(len(r["before"]) for r in jaccard_join._spread(members).collect()) == jaccard_join.BEFORE
    got = jaccard_join._all_pairs(members, 85).collect()
    want = {(a, b) for b in range(30) for a in range(b) if a % 7 != b % 7 and set(sets[a]) & set(sets[b])}
    assert Counter((r["a"], r["b"]) for r in got) == Counter(want)


def test_counters_travel_in_few_bytes(spark):
    """Small counts take a byte each, large ones as many as they need, and the sums are exact."""
    small, large = counting._rows({0: np.ones(1000, np.int64), 3: np.r_[1 << 33, np.zeros(999, np.int64)]}).column("counts").to_pylist()
    assert len(small) == 1000 and len(large) == 8000
    rows = spark.range(3000).repartition(5).selectExpr("id", "if(id < 2900, 7, id) AS slot")
    got = counting.count_table(rows, lambda batch: [batch.column("slot").to_numpy()], 3000, 1000)
    assert got[7] == 2900 and got[2900:].tolist() == [1] * 100 and got.sum() == 3000


def test_whole_table(spark):
    rows = [tuple(r) for r in queries.table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    got = queries.REGISTRY["op13_jaccard_join"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == Counter(brute(rows))
    assert prose(3) and max(r["n_shingles"] for r in got) > 100
