"""Suffix sort, repeated strings, SimHash, components and fingerprints against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import PASSAGE, ROWS, documents, empty, prose
from pyspark.sql import functions as F

from basketlab.llm import components, merkle, simhash, suffix_dedup
from basketlab.llm.suffix_sort import Suffixes

LAST = (1 << 63) - 1


def cut(texts: list[str | None], length: int = 100) -> list[tuple]:
    """Windows seen before, one by one, over texts in order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if (window := data[p : p + length]) in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("letters", [2, 26])
@pytest.mark.parametrize("depth", [1, 5, 64, 100])
def test_suffix_sort(letters, depth):
    rng = np.random.default_rng(letters)
    data = rng.integers(97, 97 + letters, 900).astype(np.uint8)
    data = np.concatenate([data, data[100:500], np.full(200, 97, np.uint8)])
    places = np.arange(len(data) - depth + 1)
    group = np.sort(rng.integers(0, 4, len(places)))
    text = data.tobytes()
    key = lambda i: (group[i], text[places[i] : places[i] + depth])
    order, new = Suffixes(data, depth).classes(places, group)
    assert order.tolist() == sorted(range(len(places)), key=key)
    assert new.tolist() == [k == 0 or key(order[k]) != key(order[k - 1]) for k in range(len(order))]


def test_suffix_sort_survives_collisions():
    data = np.frombuffer(PASSAGE.encode() * 3, np.uint8)
    suffixes = Suffixes(data, 20)
    suffixes.hashes[:] = 0  # every comparison beyond eight bytes claims equality
    places = np.arange(len(data) - 19)
    order, _ = suffixes.classes(places, np.zeros(len(places), int))
    text = data.tobytes()
    assert [text[i : i + 20] for i in order] == sorted(text[i : i + 20] for i in places)


@pytest.mark.parametrize("hot", [0, 5_000])
def test_repeated_strings(spark, hot):
    """Equal ids are ordered as read, so their rows are compared as a multiset; the rest row by row."""
    got = suffix_dedup.dedup_spans(documents(spark), hot=hot).collect()
    rows = sorted(ROWS, key=lambda r: LAST if r[0] is None else r[0])
    want = {}
    for swap in (False, True):
        order = [r for r in rows if r[0] != 6]
        sixes = [r for r in rows if r[0] == 6]
        at = next(i for i, r in enumerate(order) if r[0] == 8)
        order[at:at] = sixes[::-1] if swap else sixes
        want[swap] = Counter((r[0], *c) for r, c in zip(order, cut([r[1] for r in order])))
    assert Counter(tuple(r) for r in got) in want.values()
    assert suffix_dedup.dedup_spans(empty(spark)).count() == 0


def test_deduplicated_keeps_columns(spark):
    docs = documents(spark)
    out = suffix_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert PASSAGE in texts[1] and PASSAGE not in texts[2]


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) * 2 > len(shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b])


def test_near_duplicates(spark):
    got = Counter(map(tuple, simhash.near_duplicates(documents(spark)).collect()))
    prints = [(r[0], brute_fingerprint(r[1])) for r in ROWS]
    groups = list(range(len(prints)))
    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints):
            if (a ^ b).bit_count() <= 4 and groups[i] != groups[j]:
                groups = [groups[i] if g == groups[j] else g for g in groups]
    first = {g: min((p[0] for p, h in zip(prints, groups) if h == g and p[0] is not None), default=None) for g in groups}
    assert got == Counter((i, f"{f:016x}", first[g]) for (i, f), g in zip(prints, groups))
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_first(documents(spark)).groupBy("doc_id").count().where("count > 1").count() == 0


def test_every_link_within_four_bits_is_found(spark):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 40)]
    values = set(base)
    for b in base:
        for flips in (1, 2, 3, 4, 5):
            mask = sum(1 << int(i) for i in rng.choice(64, flips, replace=False))
            values.add(((b ^ mask) + (1 << 63)) % (1 << 64) - (1 << 63))
    values = sorted(values)
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"))
    placed = {r["node"]: r["component"] for r in components.connected_components(found).collect()}
    group = {v: v for v in values}
    for a in values:
        for b in values:
            if ((a ^ b) % (1 << 64)).bit_count() <= 4 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {v: low if g == high else g for v, g in group.items()}
    assert {v: placed.get(v, v) for v in values} == group


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long").repartition(5)
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def brute_pieces(line: bytes) -> list[bytes]:
    """Pieces of a paragraph: after 8 bytes at least, where the hash of the last 8 says so or after 64."""
    out, begin = [], 0
    for end in range(1, len(line) + 1):
        if end - begin < 8:
            continue
        h = 0
        for byte in line[end - 8 : end]:
            h = (h * merkle._FACTOR + int(merkle._VALUES[byte])) % (1 << 32)
        if (h >> 28 == 0 or end - begin == 64) and end < len(line):
            out.append(line[begin:end])
            begin = end
    return [*out, line[begin:]]


def brute_tree(text: str) -> tuple:
    """Sections of paragraphs of pieces, as nested tuples; an empty line ends a section."""
    sections = [[]]
    for line in text.encode().split(b"\n"):
        pieces = brute_pieces(line)
        sections[-1].append(tuple([*pieces[:-1], pieces[-1] + b"\n"]))
        if not line.strip():
            sections.append([])
    return tuple(tuple(s) for s in sections if s)


def weight(node) -> int:
    return len(node) if isinstance(node, bytes) else sum(map(weight, node))


def brute_likeness(a: tuple, b: tuple) -> float:
    """Twice the bytes of what both have, whole sections first, then paragraphs, then pieces, over all bytes."""
    common, one, two = 0, list(a), list(b)
    while one and two:
        both = Counter(one) & Counter(two)
        common += sum(weight(n) * k for n, k in both.items())
        one, two = (Counter(one) - both).elements(), (Counter(two) - both).elements()
        one, two = ([c for n in side if not isinstance(n, bytes) for c in n] for side in (one, two))
    return 2 * common / (weight(a) + weight(b))


def test_fingerprints(spark):
    """Against nested tuples; rows of one id may stand in any order."""
    rows = sorted(((LAST if i is None else i, t or "") for i, t, _ in ROWS))
    got = merkle.fingerprints(documents(spark)).collect()
    hashes = {brute_tree(t): merkle.tree(t).hash.hex() for _, t in rows}
    assert len(set(hashes.values())) == len(hashes) == len({t for _, t in rows})
    wanted = []
    for swap in (False, True):
        order = list(rows)
        at = [k for k, r in enumerate(rows) if r[0] == 6]
        if swap:
            order[at[0] : at[-1] + 1] = [rows[k] for k in reversed(at)]
        want = []
        for k, (i, text) in enumerate(order):
            following = order[(k + 1) % len(order)][1]
            new = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
            a, b, c = brute_tree(text), brute_tree(new), brute_tree(following)
            sha = hashlib.sha256(new.encode()).hexdigest()
            near = [round(brute_likeness(a, x), 12) for x in (b, c)]
            want.append((None if i == LAST else i, len(text), sha, merkle.tree(text).hash.hex(), merkle.tree(new).hash.hex(), *near))
        wanted.append(Counter(want))
    rounded = Counter((*r[:5], round(r["near_edited"], 12), round(r["near_next"], 12)) for r in got)
    assert rounded in wanted
    assert merkle.fingerprints(empty(spark)).count() == 0
    lone = merkle.fingerprints(documents(spark).where("doc_id = 2")).collect()
    assert len(lone) == 1 and lone[0]["near_next"] == 1.0


def test_rows_without_an_id_are_spread(spark):
    """90 % null ids, half of them one text: no range holds much more than its share, and each row has one successor."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 20_000, 1, 6).selectExpr(
            "if(id % 10 = 0, id, null) AS doc_id", "if(id % 2 = 0, 'one text of many', concat('text ', id)) AS text"
        )
        sizes = [r["count"] for r in merkle.ordered(rows).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 4 and max(sizes) < 2 * 20_000 / len(sizes)
        few = rows.where("coalesce(doc_id, 1) % 40 = 0 or hash(text) % 40 = 0")
        got = merkle.fingerprints(few).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    texts = Counter(r["text"] for r in few.collect())
    prints = {merkle.tree(t).hash.hex(): t for t in texts}
    assert Counter(prints[r["fingerprint"]] for r in got) == texts


def test_tree_locates_edits():
    before = "first section\nwith two paragraphs\n\nsecond section here"
    after = before.replace("second", "other")
    assert merkle.tree(before).hash == merkle.tree(before).hash != merkle.tree(after).hash
    assert {(s, p) for s, p, _, _ in merkle.edits(before, after)} == {(1, 0)}
    assert merkle.edits(before, before) == []
    assert merkle.likeness(merkle.tree(""), merkle.tree("")) == 1.0 and merkle.likeness(merkle.tree(""), merkle.tree("a")) == 0.0


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    rows = [
        *[(i, t) for i, t, _ in ROWS],
        (None, prose(40, 11)),
        (None, prose(40, 11)),
        (None, prose(45, 12)),
        (20, prose(35, 13)),
        (20, prose(55, 14)),
    ]
    prints = [brute_fingerprint(t) for _, t in rows]
    groups = list(range(len(rows)))
    for i, a in enumerate(prints):
        for j, b in enumerate(prints):
            if (a ^ b).bit_count() <= 4 and groups[i] != groups[j]:
                groups = [groups[i] if g == groups[j] else g for g in groups]
    out = simhash.keep_first(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component string"))
    assert out.columns == ["doc_id", "text", "component"]
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    where = [groups[rows.index(r)] for r in kept]
    assert sorted(where) == sorted(set(groups))
    for (doc_id, _), g in zip(kept, where):
        ids = [r[0] for r, h in zip(rows, groups) if h == g and r[0] is not None]
        assert doc_id == min(ids, default=None)
    assert simhash.keep_first(empty(spark)).count() == 0
    clash = documents(spark)
    assert simhash.keep_first(clash).columns == clash.columns and simhash.keep_first(clash).count() > 5


@pytest.mark.parametrize("text", ["Thsh " * 557, "x" * 3000, "日本語のとても長い文" * 150, "".join(chr(97 + i * i % 26) for i in range(4000))])
def test_an_edit_of_a_uniform_text_leaves_most_of_it_alike(text):
    new = merkle.edited(text, prose(600, 3))
    one, two = merkle.tree(text), merkle.tree(new)
    kept = len(text[: len(text) - len(text) // 4].encode())
    assert abs(merkle.likeness(one, two) - 2 * kept / (one.size + two.size)) < 0.05
    assert one.size == len(text.encode()) + 1


def test_leaves_hold_the_whole_text_once():
    for text in ["", "\n", "a\n\nb" * 40, prose(300, 2), "é" * 200 + "\n" + "12345678" * 30 + "\n"]:
        sizes = [leaf.size for s in merkle.tree(text).children for p in s.children for leaf in p.children]
        assert sum(sizes) == len(text.encode()) + 1 and max(sizes) <= merkle.MOST + 1
    front = prose(200, 5)
    assert merkle.likeness(merkle.tree(front), merkle.tree("new " + front)) > 0.9


def test_links_are_written_before_they_are_joined_up(spark, monkeypatch):
    """No step that runs Python feeds another within a task: each takes a worker with the memory of one."""
    seen = []

    def noted(found, components=simhash.connected_components):
        seen.append(found._jdf.queryExecution().executedPlan().toString())
        return components(found)

    monkeypatch.setattr(simhash, "connected_components", noted)
    docs = spark.createDataFrame([(i, f"one two three four {i % 3}") for i in range(12)], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 12
    assert len(seen) == 1 and "InArrow" not in seen[0]
