"""Document fingerprints as Merkle trees over sections, paragraphs and short pieces.

A text is cut at its blank lines into sections, these at line ends into paragraphs,
and a paragraph into pieces of 8 to 64 bytes where a rolling hash of the last 8 bytes
says so, words or not, so that the cuts meet again soon after an edit.  A leaf hashes its piece, an inner node the hashes
below it; the root is the fingerprint.  Equal roots mean equal texts.  To compare two
trees, equal nodes are taken off level by level from above, so only differing branches
are opened; the leaves left over locate the edits.  Likeness is the share of characters
in common nodes.

Scale: to meet its successor a document moves once, by range of its id and of a hash of
its text, so many rows of one id or of none are spread as well.  Tasks read their sorted
range as a stream; only the first and last document of each range meet the neighbouring
range's in a second, small step.

Defined results: null text is empty; two empty texts are alike (1), an empty and
another one are not (0); null ids come last; documents of equal id are ordered by
a hash of their text; a lone document succeeds itself; repeated rows are documents of their own; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from basketlab.llm.words import slices
from basketlab.storage import materialize

ROLL = 8  # bytes that decide a cut, none of them before the piece
LEAST = 8
MOST = 64
CUT_BITS = 4
LAST = (1 << 63) - 1
BATCH_BYTES = 4 << 20


class Node(NamedTuple):
    hash: bytes
    size: int  # characters below
    children: tuple[Node, ...] = ()


def _inner(children: list[Node]) -> Node:
    h = hashlib.blake2b(b"".join([c.hash for c in children]), digest_size=16, person=b"node").digest()
    return Node(h, sum(c.size for c in children), tuple(children))


_VALUES = np.random.default_rng(42).integers(0, 1 << 32, 256, np.uint32)
_FACTOR = 0x9E3779B1


def _cuts(data: bytes) -> list[int]:
    """Places behind every ROLL bytes whose hash asks for a cut."""
    if len(data) < ROLL:
        return []
    values = _VALUES[np.frombuffer(data, np.uint8)]
    n = len(values) - ROLL + 1
    rolled = values[:n].copy()
    for k in range(1, ROLL):
        rolled *= np.uint32(_FACTOR)
        rolled += values[k : k + n]
    return (np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + ROLL).tolist()


def tree(text: str | None) -> Node:
    """Root, sections, paragraphs, leaves; sizes count bytes and a line end."""
    data = (text or "").encode()
    cuts = [*_cuts(data), len(data) + 1]
    sections: list[list[Node]] = [[]]
    at = begin = 0
    for line in data.split(b"\n"):
        end, leaves = begin + len(line), []
        stop = end + 1
        while begin < stop:
            while cuts[at] < begin + LEAST and cuts[at] <= end:
                at += 1
            cut = min(cuts[at], begin + MOST)
            if cut >= end:
                cut = stop  # the last piece has the line end
            piece = data[begin : min(cut, end)]
            leaves.append(Node(hashlib.blake2b(piece, digest_size=16).digest(), cut - begin))
            begin = cut
        sections[-1].append(_inner(leaves))
        if not line.strip():
            sections.append([])
    return _inner([_inner(s) for s in sections if s])


def _differing(a: list[Node], b: list[Node]) -> tuple[int, list[Node], list[Node]]:
    """Size of the nodes that both lists have, and the nodes that the other list lacks."""
    spare = Counter(n.hash for n in b) & Counter(n.hash for n in a)
    size, rest = 0, []
    left = spare.copy()
    for n in a:
        if left[n.hash] > 0:
            left[n.hash] -= 1
            size += n.size
        else:
            rest.append(n)
    left, other = spare, []
    for n in b:
        if left[n.hash] > 0:
            left[n.hash] -= 1
        else:
            other.append(n)
    return size, rest, other


def compare(a: Node, b: Node) -> tuple[float, list[Node], list[Node]]:
    """Likeness of two trees from 0 to 1, and the leaves that only one of them has."""
    if a.hash == b.hash:
        return 1.0, [], []
    common, one, two = 0, [a], [b]
    while any(n.children for n in one) and any(n.children for n in two):
        one, two = [c for n in one for c in n.children], [c for n in two for c in n.children]
        size, one, two = _differing(one, two)
        common += size
    return 2 * common / (a.size + b.size), one, two


def likeness(a: Node, b: Node) -> float:
    return compare(a, b)[0]


def edits(before: str | None, after: str | None) -> list[tuple[int, int, int, bool]]:
    """Where two texts differ: (section, paragraph, leaf, whether it is the text before) of each leaf that only one has."""
    one, two = tree(before), tree(after)
    _, lost, new = compare(one, two)
    out = []
    for root, only, is_before in ((one, lost, True), (two, new, False)):
        wanted = {id(n) for n in only}
        for s, section in enumerate(root.children):
            for p, paragraph in enumerate(section.children):
                out += [(s, p, i, is_before) for i, leaf in enumerate(paragraph.children) if id(leaf) in wanted]
    return out


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_FIELDS = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_EDGE = [("edge", pa.string()), ("range", pa.int32()), ("ord", pa.int64()), ("text", pa.string())]
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _row(doc_id: int | None, text: str, own: Node, following: str, other: Node) -> tuple:
    new = edited(text, following)
    changed = tree(new) if new != text else own
    sha = hashlib.sha256(new.encode()).hexdigest()
    return (doc_id, len(text), sha, own.hash.hex(), changed.hash.hex(), likeness(own, changed), likeness(own, other))


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _id(ord_: int) -> int | None:
    return None if ord_ == LAST else ord_


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (ord, text) of a range -> a row for each document but the last, and the range's edges with their text."""
    nothing = (None,) * len(_FIELDS)
    number = TaskContext.get().partitionId()
    waiting = None
    for batch in batches:
        for part in slices(batch, "text", BATCH_BYTES):
            rows = []
            for ord_, text in zip(part.column("ord").to_pylist(), part.column("text").to_pylist()):
                own = tree(text)
                if waiting is None:
                    rows.append((*nothing, "first", number, ord_, text))
                else:
                    rows.append((*_row(_id(waiting[0]), waiting[1], waiting[2], text, own), None, None, None, None))
                waiting = (ord_, text, own)
            yield _batch(rows, _FIELDS + _EDGE)
    if waiting is not None:
        yield _batch([(*nothing, "last", number, waiting[0], waiting[1])], _FIELDS + _EDGE)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            _row(_id(ord_), text, tree(text), following, tree(following))
            for ord_, text, following in zip(*[batch.column(n).to_pylist() for n in ("ord", "text", "following")])
        ]
        yield _batch(rows, _FIELDS)


def ordered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ord, text) in ranges of ascending id, then hash of the text; null ids last.

    Many rows of one id, or without any, are spread over ranges by the hash of their
    text, and equal rows, whose order cannot matter, by a number of their own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("ord"), text.alias("text"),
        F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row"),
    )
    return keyed.repartitionByRange("ord", "h", "row").sortWithinPartitions("ord", "h", "text").select("ord", "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited form, with the likeness to that form and to the next document."""
    rows = ordered(docs, id_col, text_col).mapInArrow(_ranges, SCHEMA + ", edge string, range int, ord long, text string")
    found = materialize(rows, "merkle-ranges")
    firsts = found.where("edge = 'first'").select(F.col("range").alias("next"), F.col("text").alias("following"))
    lasts = found.where("edge = 'last'").select("range", "ord", "text")
    # a row for each range that has documents: whose first document follows its last one
    along = Window.orderBy("next")
    follows = firsts.select(
        F.col("next").alias("of"), F.coalesce(F.lead("next").over(along), F.min("next").over(Window.partitionBy())).alias("next")
    )
    pairs = lasts.join(follows, F.col("range") == F.col("of")).join(firsts, "next").select("ord", "text", "following")
    return found.where("edge is null").drop("edge", "range", "ord", "text").unionByName(pairs.mapInArrow(_pairs, SCHEMA))
