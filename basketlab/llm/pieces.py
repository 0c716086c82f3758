"""SentencePiece encoding and decoding by a Viterbi over an Aho-Corasick automaton.

The vocabulary comes from a given SentencePiece model file; nothing is trained.  Text
gets a leading blank and blanks become U+2581.  An automaton over all pieces reads a
stretch of text once; at each place it reports every piece that ends there (its output
links), and each report relaxes the best sum of piece scores up to that place.
Characters without a piece, and U+2581 itself, fall back to byte pieces.  Decoding
gives the text back exactly.

No piece has a blank after another character, nor a line end beside another character
(checked on loading), so the best segmentation of a text is that of its stretches, and
a task remembers those it has met, ``REMEMBERED`` at most.

Scale: one pass over the texts without a shuffle; a task holds the automaton and the
bounded memory of stretches.

Defined results: null text is empty; empty text has no pieces; a null id is an id like
any other; repeated rows are encoded each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from basketlab.llm.words import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
REMEMBERED = 200_000
BATCH_BYTES = 8 << 20


class Vocabulary(NamedTuple):
    pieces: dict[str, tuple[int, float]]  # text -> id, score
    byte_ids: list[int]  # by byte

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, [-1] * 256
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(text[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[text] = (i, model.get_score(i))
        if -1 in byte_ids:
            raise ValueError("the model has no piece for some bytes")
        for text in pieces:
            if BLANK in text.lstrip(BLANK) or len(text) > 1 and ("\n" in text or any(c not in pieces for c in text)):
                raise ValueError(f"stretches cannot be encoded one by one because of the piece {text!r}")
        return Vocabulary(pieces, byte_ids)


class Codec(dict):
    """Encodes and decodes texts; as a dict it maps a stretch to its ids as int32 bytes."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for text, (i, score) in vocabulary.pieces.items():
            self.automaton.add_word(text, (len(text), i, score))
        self.automaton.make_automaton()
        single = "".join(re.escape(p) for p in vocabulary.pieces if len(p) == 1 and p not in (BLANK, "\n"))
        self.stretch = re.compile(f"{BLANK}+[{single}]*|[{single}]+|.", re.S)
        self.texts = [b""] * (1 + max(max(vocabulary.byte_ids), *(i for i, _ in vocabulary.pieces.values())))
        for text, (i, _) in vocabulary.pieces.items():
            self.texts[i] = text.replace(BLANK, " ").encode()
        for byte, i in enumerate(vocabulary.byte_ids):
            self.texts[i] = bytes([byte])
        self.lengths = [0] * len(self.texts)
        for text, (i, _) in vocabulary.pieces.items():
            self.lengths[i] = len(text)
        self.literal_blank = self._bytes(BLANK)

    def _bytes(self, char: str) -> bytes:
        return np.array([self.vocabulary.byte_ids[b] for b in char.encode()], np.int32).tobytes()

    def best(self, stretch: str) -> list[int]:
        """Ids of the segmentation with the largest sum of scores; of equal sums the one with the longer last piece."""
        score, last = [], []  # by number of characters; every place ends some piece
        at, best, piece = -1, 0.0, 0
        for end, (length, i, gain) in self.automaton.iter(stretch):
            if end != at:
                score.append(best)
                last.append(piece)
                at, best = end, -1e300
            total = score[end + 1 - length] + gain
            if total > best:
                best, piece = total, i
        score.append(best)
        last.append(piece)
        ids, at = [], len(stretch)
        while at:
            ids.append(last[at])
            at -= self.lengths[last[at]]
        return ids[::-1]

    def __missing__(self, stretch: str) -> bytes:
        if len(stretch) == 1 and stretch not in self.vocabulary.pieces:
            ids = self._bytes(stretch)
        else:
            ids = array("i", self.best(stretch)).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(stretch) < 64:
            self[stretch] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        parts = (" " + text).split(BLANK)  # a literal U+2581 stands between the parts
        found = [b"".join(map(self.__getitem__, self.stretch.findall(p.replace(" ", BLANK)))) for p in parts]
        return np.frombuffer(self.literal_blank.join(found), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.texts.__getitem__, ids.tolist()))
        return data[1:].decode(errors="replace")  # without the leading blank


SCHEMA = "doc_id long, n_pieces long, n_byte_pieces long, ids array<int>, exact boolean"


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pieces, n_byte_pieces, ids, exact) of every row; exact tells that decoding gave the text back."""
    vocabulary = Vocabulary.load(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        is_byte = np.zeros(len(codec.texts), bool)
        is_byte[vocabulary.byte_ids] = True
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                texts = [t.as_py() or "" for t in part.column("text")]
                ids = [codec.encode(t) for t in texts]
                sizes = np.array([len(i) for i in ids], np.int64)
                flat = np.concatenate([*ids, np.empty(0, np.int32)])
                offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                fallen = np.r_[0, np.cumsum(is_byte[flat])]
                ends = np.cumsum(sizes)
                columns = [
                    part.column("doc_id"),
                    pa.array(sizes),
                    pa.array(fallen[ends] - fallen[ends - sizes], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(flat)),
                    pa.array([codec.decode(i) == t for i, t in zip(ids, texts)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "n_byte_pieces", "ids", "exact"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text)."""
    vocabulary = Vocabulary.load(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        for batch in batches:
            texts = [codec.decode(np.array(i.as_py() or [], np.int32)) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
