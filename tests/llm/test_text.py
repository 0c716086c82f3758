"""Mixing, chats, pieces, language model, classifier, rules and pages."""

import math
from collections import Counter
from itertools import product
from zlib import crc32

import duckdb
import numpy as np
import pytest
from cases import LABELS, ROWS, documents, empty, prose
from compare import compare, connect
from conftest import SMALL
from pyspark.sql import functions as F

from basketlab.llm import chat, hidden_markov, mixing, ngram_rules, oracles, pieces, queries, site_style, weak_labels


def brute_targets(sizes, weights=(1, 2, 3)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3.0 * sizes[s] if s in capped else left * weight[s] / sum(weight[r] for r in rest) for s in names}
        over = {s for s in rest if target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix(spark):
    out = mixing.mix(documents(spark)).collect()
    sizes = Counter()
    for _, text, source in ROWS:
        sizes[source] += len((text or "").encode().split())
    target = brute_targets(sizes)
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((i, len((t or "").encode().split())) for i, t, _ in ROWS)
    taken = Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 24 for s in sizes)
    assert Counter(map(tuple, out)) == Counter(map(tuple, mixing.mix(documents(spark)).collect()))
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_documents(documents(spark)).columns == documents(spark).columns


@pytest.mark.parametrize("size,n_docs", [(1, 1), (4, 2), (8, 3), (20, 5), (200, 7)])
def test_small_sources_reach_their_targets(spark, size, n_docs):
    """600 sources of a few words: taken is within a word or 2 % of the target, and the sums agree."""
    cuts = np.linspace(0, size, n_docs + 1).astype(int)
    rows = [(s * 100 + d, " ".join(["w"] * int(cuts[d + 1] - cuts[d])), f"s{s:03d}") for s in range(600) for d in range(n_docs)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    target = brute_targets({f"s{s:03d}": size for s in range(600)})
    taken = Counter()
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - t) <= max(1, 0.02 * t) for s, t in target.items())
    assert abs(sum(taken.values()) - 600 * size) <= 0.001 * 600 * size


def test_seats_go_to_the_highest_quotients(spark):
    votes = {"a": 53, "b": 24, "c": 23, "d": 1, "e": 0}
    for seats in (0, 1, 4, 7, 50):
        quotients = sorted(((v / (2 * k - 1), p) for p, v in votes.items() for k in range(1, seats + 1)), key=lambda x: (-x[0], x[1]))
        want = Counter(p for _, p in quotients[:seats])
        rows = spark.createDataFrame([(p, v, seats) for p, v in votes.items()], "party string, votes long, seats long")
        got = {r["party"]: r["quota"] for r in mixing.apportion(rows, [], ["party"], "votes", "seats").collect()}
        assert got == {p: want[p] for p in votes}


CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "hello"),
    (3, 2, "user", "bye<|im_end|>"), (4, 0, None, None), (5, 0, "user", "hi"), (5, 1, "assistant", "other"), (5, 1, "assistant", "other"),
    (6, 0, "user", "hi"), (6, 1, "assistant", "other"), (None, None, "user", "x"),
]


def test_chats_keep_maximal_conversations(spark):
    table = spark.createDataFrame(CHATS, "conv_id long, turn int, role string, text string").selectExpr("*", "'x' AS place", "1 AS h1")
    got = {r["conv_id"]: (r["n_turns"], r["n_equal"], r["rendered"]) for r in chat.format_chats(table).collect()}
    assert set(got) == {None, 3, 4, 5}
    assert got[5][:2] == (2, 2) and got[4][2] == "<|im_start|>unknown\n<|im_end|>\n"
    assert got[3][2].count("<|im_end|>") == 3 and "bye<|im_end |>" in got[3][2]
    assert chat.format_chats(table.limit(0)).count() == 0


def test_chats_equal_sql(spark):
    name = "op8_chat_formatting"
    assert compare(spark, connect(SMALL), SMALL, name, queries.REGISTRY[name], oracles.oracle_sql()[name])[0] == ""


def brute_best(codec, stretch):
    best = [0.0] + [-math.inf] * len(stretch)
    for end in range(1, len(stretch) + 1):
        for start in range(end):
            if piece := codec.vocabulary.pieces.get(stretch[start:end]):
                best[end] = max(best[end], best[start] + piece[1])
    return best[-1]


def test_pieces(spark):
    codec = pieces.Codec(pieces.Vocabulary.load())
    score = {i: s for i, s in codec.vocabulary.pieces.values()}
    for stretch in ["▁the", "▁Ouwhea", "international", "▁▁▁x", "éàü", "▁anticonstitutionnellement"]:
        ids = codec.best(stretch)
        assert sum(score[i] for i in ids) == brute_best(codec, stretch)
        assert b"".join(codec.texts[i] for i in ids).decode() == stretch.replace("▁", " ")
    out = pieces.encode(documents(spark))
    rows = out.collect()
    assert all(r["exact"] and r["n_pieces"] == len(r["ids"]) for r in rows) and len(rows) == len(ROWS)
    assert Counter(map(tuple, pieces.decode(out).collect())) == Counter((i, t or "") for i, t, _ in ROWS)
    assert pieces.encode(empty(spark)).count() == 0
    assert all(r[0] for r in queries.op2_sentencepiece(spark, SMALL).select("exact").collect())


def test_forward_recursion_sums_all_paths():
    p = hidden_markov.Parameters.first(np.array([5.0, 3, 2, 1]), states=3)
    text = np.array([1, 3, 0, 2, 0], np.uint16)
    total = 0.0
    for path in product(range(3), repeat=len(text)):
        chance = p.start[path[0]] * p.emit[text[0], path[0]]
        for a, b, c in zip(path, path[1:], text[1:]):
            chance *= p.move[a, b] * p.emit[c, b]
        total += chance
    assert hidden_markov.log10_likelihoods([text, text[:1]], p)[0] == pytest.approx(math.log10(total))
    start, move, emit = hidden_markov.expected_counts(text, np.array([0, 3]), np.array([3, 2]), p)
    assert start.sum() == pytest.approx(2) and move.sum() == pytest.approx(3) and emit.sum(axis=1) == pytest.approx([2, 1, 1, 1])


def check_base(rows, docs):
    counts, ends = Counter(), 0
    held = lambda i: crc32(b"" if i is None else str(i).encode()) % 10 == 0
    for i, text in docs:
        if not held(i):
            counts.update((text or "").encode().lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    want = []
    for i, text in docs:
        words = (text or "").encode().lower().split()
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*map(counts.__getitem__, words), ends])
        want.append((i, held(i), len(words) + 1, sum(counts[w] > 0 for w in words) + (ends > 0), n, round(base, 6)))
    assert Counter((*r[:5], round(r["base_score"], 6)) for r in rows) == Counter(want)


def test_language_model(spark):
    check_base(hidden_markov.score(documents(spark)).collect(), [r[:2] for r in ROWS])
    assert hidden_markov.score(empty(spark)).count() == 0
    unseen = hidden_markov.score(documents(spark).where("doc_id is null")).collect()
    assert unseen[0]["base_score"] == 0.0 and unseen[0]["train_tokens"] == 0


def plain_forward_backward(seq, start, move, emit):
    """Log likelihood and state posteriors of one sequence, step by step in plain numbers."""
    states = range(len(start))
    alpha = [[start[k] * emit[seq[0]][k] for k in states]]
    for x in seq[1:]:
        alpha.append([sum(alpha[-1][j] * move[j][k] for j in states) * emit[x][k] for k in states])
    beta = [[1.0 for _ in states]]
    for x in reversed(seq[1:]):
        beta.insert(0, [sum(move[j][k] * emit[x][k] * beta[0][k] for k in states) for j in states])
    whole = sum(alpha[-1])
    gamma = [[a * b / whole for a, b in zip(*rows)] for rows in zip(alpha, beta)]
    moves = [
        [[alpha[t][j] * move[j][k] * emit[seq[t + 1]][k] * beta[t + 1][k] / whole for k in states] for j in states]
        for t in range(len(seq) - 1)
    ]
    return math.log10(whole), gamma, moves


def test_language_model_against_plain_baum_welch(spark, monkeypatch):
    """Two tied rounds, the round by word and all scores, one sequence after another; also with more words than classes."""
    monkeypatch.setattr(hidden_markov, "TOP", 6)
    monkeypatch.setattr(hidden_markov, "REST", 4)
    monkeypatch.setattr(hidden_markov, "OWN_COUNT", 2)
    rows = [(i, prose(4 + 3 * i % 17, i)) for i in range(24)] + [(30, ""), (31, None), (32, "never seen words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in hidden_markov.score(docs, states=3, rounds=2).collect()}
    texts = {i: (t or "").lower().split() for i, t in rows}
    held = {i: crc32(str(i).encode()) % 10 == 0 for i in texts}
    counts = Counter(w for i, t in texts.items() if not held[i] for w in t)
    ends = sum(not h for h in held.values())
    best = sorted(counts, key=lambda w: (-counts[w], w.encode()))[:6]
    key = {r[0]: r[1] for r in spark.createDataFrame([(w,) for w in best], "w string").selectExpr("w", "xxhash64(w)").collect()}
    top = {w: k for k, w in enumerate(sorted(best, key=lambda w: (-counts[w], key[w])), 1)}
    cls = lambda w: top.get(w, crc32(w[-2:].encode()) % 4 + 7)
    in_class, types = Counter(), Counter()
    for w, n in counts.items():
        in_class[cls(w)] += n
        types[cls(w)] += 1
    inside = lambda w: 1.0 if w in top else (counts[w] + 0.1) / (in_class[cls(w)] + 0.1 * (types[cls(w)] + 1))
    emitted = np.array([ends, *[in_class[k] for k in range(1, 11)]], float)
    p = hidden_markov.Parameters.first(emitted, 3)
    prior = (emitted + 0.1) / (emitted + 0.1).sum()
    for _ in range(2):
        start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((11, 3))
        for i, t in texts.items():
            if not held[i]:
                seq = [*map(cls, t), 0]
                _, gamma, moves = plain_forward_backward(seq, p.start, p.move, p.emit)
                start += gamma[0]
                move += np.sum(moves, axis=0) if moves else 0
                for x, g in zip(seq, gamma):
                    emit[x] += g
        emit = emit + prior[:, None]
        p = hidden_markov.Parameters(
            (start + 0.1) / (start + 0.1).sum(), (move + 0.1) / (move + 0.1).sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
        )
    own, tokens = Counter(), sum(counts.values()) + ends
    word_counts = {w: np.zeros(3) for w, n in counts.items() if n >= 2}
    for i, t in texts.items():
        if not held[i]:
            _, gamma, _ = plain_forward_backward([*map(cls, t), 0], p.start, p.move, p.emit)
            for w, g in zip(t, gamma):
                if w in word_counts:
                    word_counts[w] += g
    tied = lambda w: inside(w) * p.emit[cls(w)]
    weight = {w: 0.9 * n + 0.1 * tokens / 3 * tied(w) for w, n in word_counts.items()}
    mass, all_ = sum(tied(w) for w in weight), sum(weight.values())
    assert len(weight) > 6 and own == Counter()
    for i, t in texts.items():
        emit = [weight[w] * mass / all_ if w in weight else tied(w) for w in t] + [p.emit[0]]
        want, _, _ = plain_forward_backward(range(len(emit)), p.start, p.move, emit)
        assert got[i]["score"] == pytest.approx(want, rel=1e-5, abs=1e-6)


def test_language_model_beats_base_on_held_out_texts(spark):
    rows = queries.op3_language_model(spark, SMALL).collect()
    docs = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    check_base(rows, docs)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_moves_words_in_blocks(spark, monkeypatch):
    """15,250 distinct words in 60 documents: what is written between the steps has a row a document or block, not a word."""
    written = Counter()

    def counted(write):
        def wrapped(df, *args):
            table = write(df, *args)
            written["rows"] += table.count()
            return table

        return wrapped

    monkeypatch.setattr(hidden_markov, "materialize", counted(hidden_markov.materialize))
    monkeypatch.setattr(hidden_markov, "bucketed", counted(hidden_markov.bucketed))
    rows = [(i, " ".join(f"w{i * 250 + j}é" for j in range(500)) + " often" * 9) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check_base(hidden_markov.score(docs, rounds=1).collect(), rows)
    assert 0 < written["rows"] < 400


def test_language_model_scores_alike_however_words_are_cut(spark, monkeypatch):
    """One chunk and a bucket a partition, or many chunks and fewer buckets: the scores agree."""
    rows = [(i, prose(4 + 3 * i % 17, i) + f" once{i}") for i in range(24)] + [(30, ""), (31, None), (30, "never seen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name, value in (("TOP", 5), ("REST", 4), ("OWN_COUNT", 3)):
        monkeypatch.setattr(hidden_markov, name, value)
    whole = sorted(hidden_markov.score(docs.coalesce(1), rounds=2).collect())
    monkeypatch.setattr(hidden_markov, "CHUNK_WORDS", 6)
    monkeypatch.setattr(hidden_markov, "BUCKETS", 2)
    cut = sorted(hidden_markov.score(docs.repartition(5), rounds=2).collect())
    assert [r[:5] for r in whole] == [r[:5] for r in cut]
    for column in ("base_score", "score"):
        assert [r[column] for r in cut] == pytest.approx([r[column] for r in whole], rel=1e-6)


def test_classifier_on_labelled_documents(spark):
    docs, labels = (queries.table(spark, SMALL.replace("0.001", "0.01"), t) for t in ("documents", "labels"))
    train = labels.where("crc32(cast(doc_id as string)) % 2 = 0")
    verdict = weak_labels.classify(docs, weak_labels.fit(docs, train))
    rows = verdict.join(labels.where("crc32(cast(doc_id as string)) % 2 = 1"), "doc_id").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    poor = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(clean) >= 0.97 * len(clean) and sum(poor) <= 0.25 * len(poor)


def test_toxic_words_of_any_kind_are_learnt_from_the_labels(spark):
    """Half of the labels teach; the ten insults of the data are replaced by ten other words throughout."""
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = (queries.table(spark, folder, t) for t in ("documents", "labels"))
    insults = "idiot moron stupid loser scum trash worthless disgusting pathetic clown".split()
    text = F.col("text")
    for i, word in enumerate(insults):
        text = F.regexp_replace(text, rf"(?i)\b{word}\b", f"grumbl{chr(97 + i) * 3}")
    docs = docs.withColumn("text", text)
    taught = labels.where("crc32(cast(doc_id as string)) % 2 = 0")
    model = weak_labels.fit(docs, taught)
    assert len(model.loaded) >= 10
    rows = weak_labels.classify(docs, model).join(labels.where("crc32(cast(doc_id as string)) % 2 = 1"), "doc_id").collect()
    toxic = [r["kept"] for r in rows if r["toxic"] == 1]
    clean = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(toxic) <= 0.1 * len(toxic) and sum(clean) >= 0.97 * len(clean) and len(toxic) > 150


def test_an_annotation_alone_keeps_its_row_bad():
    quiet = "11110"
    patterns = {quiet + "11": 900, quiet + "12": 60, quiet + "00": 500, "11120" + "21": 30, "11120" + "00": 20}
    _, bad = weak_labels.estimate(patterns)
    assert bad[quiet + "12"] == pytest.approx(1) and bad["1112021"] == pytest.approx(1)
    assert bad[quiet + "11"] < 0.1 and bad[quiet + "00"] < 0.3


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(0)
    kind = rng.choice(3, 20_000, p=[0.7, 0.2, 0.1])
    says = [np.where(rng.random(len(kind)) < right, np.where(kind == 1, 2, 1), np.where(kind == 1, 1, 2)) for right in (0.95, 0.9, 0.85, 0.8)]
    says.append(np.where(kind == 2, 2, 0))
    says += [np.where(rng.random(len(kind)) < 0.9, np.where(kind == 1, 2, 1), 0), np.where(kind == 2, 2, 1)]
    patterns = Counter("".join(map(str, row)) for row in zip(*says))
    table, bad = weak_labels.estimate(dict(sorted(patterns.items())))
    assert table[0, 1, 2] == pytest.approx(0.95, abs=0.03) and table[3, 0, 1] == pytest.approx(0.8, abs=0.03)
    right = sum(n for p, n in patterns.items() for k in [bad[p] > 0.5] if k)
    assert abs(right - (kind > 0).sum()) < 600


def test_classifier_on_awkward_rows(spark):
    for rows in ([], [(1, 0, 0), (1, 1, 1), (None, 1, 0), (2, None, None), (5, 1, 0)]):
        labels = spark.createDataFrame(rows, LABELS)
        model = weak_labels.fit(documents(spark), labels)
        assert weak_labels.classify(documents(spark), model).count() == len(ROWS)
        assert weak_labels.keep_good(documents(spark), labels).columns == documents(spark).columns
        assert weak_labels.classify(empty(spark), weak_labels.fit(empty(spark), labels)).count() == 0


def brute_rules(text):
    text = text or ""
    blank = " \t\n\x0b\x0c\r"
    words = text.encode().split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.strip(blank)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    chars = sum(c not in blank for c in text)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed


def test_rules(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (10, 0, 0), (None, 1, 0)], LABELS)
    rows = ngram_rules.judge(documents(spark), labels).collect()
    assert Counter(tuple(r)[:7] for r in rows) == Counter((i, *brute_rules(t)) for i, t, _ in ROWS)
    assert not any(r["kept"] for r in rows if r["base_failed"])
    trusted, raw = Counter(), Counter()
    for i, text, _ in ROWS:
        b = ngram_rules.buckets(text).tolist()
        raw.update(b)
        trusted.update(b if i in (1, 2) else [])
    size = 1 << ngram_rules.BITS
    ratio = lambda x: math.log((trusted[x] + 1) / (trusted.total() + size) * (raw.total() + size) / (raw[x] + 1))
    for r in rows:
        texts = [t for i, t, _ in ROWS if i == r["doc_id"]]
        means = [np.mean([ratio(x) for x in ngram_rules.buckets(t).tolist()]) if t else 0.0 for t in texts]
        assert any(abs(m - r["log_ratio"]) < 1e-9 for m in means)
    unlabelled = ngram_rules.judge(documents(spark), spark.createDataFrame([], LABELS)).collect()
    assert all(r["kept"] != r["base_failed"] for r in unlabelled)
    assert ngram_rules.judge(empty(spark), labels).count() == 0


@pytest.mark.parametrize("text", ["a b a b a b a b a b a b", prose(200, 3), "a b c d e a b c d e f", "", "x " * 50])
def test_repeated_words(text):
    assert ngram_rules.repeated_words(text.encode().split()) == brute_rules(text)[4]


PAGES = [
    (1, "http://a.example/1", "<nav><a>menu</a></nav><article><h1>T &amp; t</h1><p><b>x  y<br><p>z</article><footer>f</footer>"),
    (2, None, None), (3, "broken url", ""), (4, "http://a.example/2", "<p>lone <i>text</i> 1 < 2"),
    (5, "http://b.example", "<div class='cookie-notice'>n</div><main><aside>s</aside><header>H</header>m<form>f</form></main><ul class=comments><li>c</ul>"),
    (6, "http://c.example", "<div>" * 3000 + "deep" + "</div>" * 3000), (6, "http://c.example", "<div>" * 3000 + "deep" + "</div>" * 3000),
    (7, "http://d.example", "<script>var a = '<p>no</p>'</script><!-- <p>no --><style>p{}</style><p hidden>no</p><td>a<td>b"),
]


def test_pages(spark):
    table = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "1 AS paths")
    got = Counter((r["page_id"], r["text"]) for r in site_style.extract(table).collect())
    texts = {1: "T & t\nx y\nz", 2: "", 3: "", 4: "lone text 1 < 2", 5: "H\nm", 6: "deep", 7: "a b"}
    assert got == Counter((i, texts[i]) for i, _, _ in PAGES)
    assert site_style.extract(table.limit(0)).count() == 0


def test_what_a_site_repeats_goes(spark):
    page = "<body><div class=x><p>Welcome to our site, number one in town</p></div><div class=y><p>Story {0} tells of {0}</p></div></body>"
    rows = [(i, f"http://s.example/{i}", page.format(i)) for i in range(30)]
    rows += [(99, "http://other.example/", page.format(99))]
    got = {r[0]: r[2] for r in site_style.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story {i} tells of {i}" for i in range(30))
    assert got[99].startswith("Welcome")


def test_generated_pages_give_their_articles(spark):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in queries.table(spark, SMALL, "pages").collect()}
    for r in queries.op10_html_extraction(spark, SMALL).collect():
        article = re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def texts_of(spark, rows):
    return {r[0]: r[2] for r in site_style.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_what_a_site_repeats_goes_inside_articles(spark):
    page = "<body><article><p>Story {0} of {0}</p><div class=x>Tell your friends</div>{1}<p>Written by the desk</p></article></body>"
    rows = [(i, f"http://s.example/{i}", page.format(i, f"<p>More of {i}</p>" * (i % 3))) for i in range(30)]
    got = texts_of(spark, rows)
    assert all(got[i] == "\n".join([f"Story {i} of {i}"] + [f"More of {i}"] * (i % 3)) for i in range(30))


def test_copies_of_a_page_count_once_in_the_style_tree(spark):
    page = "<html><body><div class=x>Welcome</div><div class=y><p>Story {0} tells of {0}</p></div></body></html>"
    rows = [(i, "http://same.example/", page.format(0)) for i in range(8)]
    rows += [(i, "http://s.example/", page.format(i if i < 130 else 100)) for i in range(100, 220)]
    rows += [(i, "http://lists.example/", f"<ul>{'<li>one</li>' * 9}</ul><p>{i}</p>") for i in range(300, 303)]
    rows += [(i, "http://bare.example/", f"<div class=x>Welcome</div><i hidden>{i}</i>") for i in range(400, 410)]
    got = texts_of(spark, rows)
    assert all(got[i] == "Welcome\nStory 0 tells of 0" for i in range(8))
    assert all(got[i] == "Story {0} tells of {0}".format(i if i < 130 else 100) for i in range(100, 220))
    assert all(got[i].startswith("one\none") for i in range(300, 303))
    assert all(got[i] == "Welcome" for i in range(400, 410))


@pytest.mark.parametrize(
    "page, text",
    [
        ("<body class='has-sidebar'><article class='category-notices'>T</article><div class='cookie-notice'>no</div></body>", "T"),
        ("<html id=menu><body class=banner><div class='widget'><article>T</article></div></body></html>", "T"),
        ("<article><p style='overflow:hidden'>A</p><p><a href='/hidden-gems'>B</a></p><p data-hidden='false'>C</p></article>", "A\nB\nC"),
        ("<p title='a hidden class=ad'>A</p><p HIDDEN>no</p><p aria-hidden='true'>no</p><p class='x ad'>no</p>", "A"),
        ("<article>T</article><div class=comments><article>no</article></div>", "T"),
    ],
)
def test_names_and_attributes_count_as_a_whole(page, text):
    assert "\n".join(site_style.blocks(site_style.parse(page), frozenset(), frozenset())) == text


STORIES = [" ".join(f"{w}{i}" for w in prose(40, i).split()) for i in range(40)]


def test_near_copies_of_an_article_keep_it(spark):
    """Ten pages with one article and a line that differs: no evidence of what the site repeats."""
    page = "<article><h1>On rivers</h1><p>{0}</p><p>{1}</p><p>Views: {2}</p></article>"
    rows = [(i, "http://near.example/", page.format(STORIES[0], STORIES[1], i)) for i in range(10)]
    body = "<body><div><p>{0}</p></div><div><p>{1}</p></div><p>Views: {2}</p></body>"
    rows += [(i, "http://bare.example/", body.format(STORIES[0], STORIES[1], i)) for i in range(10, 20)]
    short = "<article><h1>On rivers</h1><p>They flow to the sea, slowly.</p><p>Views: {0}</p></article>"
    rows += [(i, "http://short.example/", short.format(i)) for i in range(20, 30)]
    # beside many other articles too, from which the site's own line goes
    site = "<article><h1>T{0}</h1><p>{1}</p><p>Share this story</p></article>"
    rows += [(i, "http://site.example/", site.format(i, STORIES[i - 30])) for i in range(30, 60)]
    rows += [(i, "http://site.example/", page.format(STORIES[38], STORIES[39], i)[:-10] + "<p>Share this story</p></article>") for i in range(60, 72)]
    got = texts_of(spark, rows)
    assert all(got[i] == f"On rivers\n{STORIES[0]}\n{STORIES[1]}\nViews: {i}" for i in range(10))
    assert all(got[i] == f"{STORIES[0]}\n{STORIES[1]}\nViews: {i}" for i in range(10, 20))
    assert all(got[i] == f"On rivers\nThey flow to the sea, slowly.\nViews: {i}" for i in range(20, 30))
    assert all(got[i] == f"T{i}\n{STORIES[i - 30]}" for i in range(30, 60))
    assert all(got[i] == f"On rivers\n{STORIES[38]}\n{STORIES[39]}\nViews: {i}" for i in range(60, 72))


def test_headings_inline_elements_lists_and_tables_of_articles_stay(spark):
    page = (
        "<article><header><h1>Land {0}</h1></header><h2>History</h2><p>{1}</p><h2>Climate</h2><p>see <a>here</a> for {0} and "
        "<b>Note</b> x{0}</p><table><tr><th>Area</th><td>large</td></tr><tr><td><p>Coast</p></td><td>none</td></tr></table>"
        "<ul><li>rain</li><li>{0} days</li></ul><div class=x><p>Share this</p></div></article>"
    )
    rows = [(i, "http://atlas.example/", page.format(i, STORIES[i])) for i in range(30)]
    got = texts_of(spark, rows)
    for i in range(30):
        want = f"Land {i}\nHistory\n{STORIES[i]}\nClimate\nsee here for {i} and Note x{i}\nArea large\nCoast\nnone\nrain\n{i} days"
        assert got[i] == want


def test_own_words_at_a_repeated_place_stay(spark):
    """The last paragraph is nearly always the site's line; where it is the story's end it is kept."""
    page = "<article><p>{0}</p><p>{1}</p></article>"
    rows = [(i, "http://s.example/", page.format(STORIES[i], "Written by the desk" if i else "And so it ended.")) for i in range(40)]
    got = texts_of(spark, rows)
    assert got[0] == f"{STORIES[0]}\nAnd so it ended." and all(got[i] == STORIES[i] for i in range(1, 40))


def test_importance_is_the_larger_entropy(spark):
    """Entropies of every node anew, from plain lists of the pages that are evidence."""
    page = "<article><p>{0}</p><div>{1}</div><section><p>{2}</p>{3}</section></article>"
    rows = [(i, "http://s.example/", page.format(STORIES[i], "x" if i % 3 else "y", f"own {i}", "<i>k</i>" * (i % 2))) for i in range(20)]
    rows += rows[:5] + [(50, "http://s.example/", "<article><p>Tell</p><p>Tell</p></article>")]
    table = spark.createDataFrame([("s.example", r[2]) for r in rows], "host string, html string")
    raw = table.mapInArrow(site_style._merge, site_style._ROWS_TYPE)
    tree, _ = site_style.style_tree(raw)
    got = {r["key"]: (r["pages"], r["importance"]) for r in tree.collect()}
    said, shown = {}, {}
    for text in {r[2] for r in rows}:
        layout = site_style.Layout(site_style.parse(text))
        for node, begin, end in layout.elements:
            for key in node.keys:
                place = (text, "\n".join(layout.segments[begin:end]), tuple(c.style for c in node.children if not isinstance(c, str)))
                said.setdefault(key, set()).add(place)

    def entropy(values):
        counts, n = Counter(values), len(values)
        return -sum(c / n * math.log(c / n) for c in counts.values()) / math.log(n) if n > 1 else 1.0

    assert got.keys() == said.keys() and len(got) > 8
    for key, places in said.items():
        pages, importance = got[key]
        assert pages == len(places)
        assert importance == pytest.approx(max(entropy([p[1] for p in places]), entropy([p[2] for p in places])), abs=1e-9)
