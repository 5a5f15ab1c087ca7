"""SentencePiece encoding by shared-prefix Viterbi, and decoding.

A text is marked (a mark before it, and for each space) and cut into units: marks with the characters up to the next mark, line
feeds alone. No piece reaches over such a cut, so the best segmentation of a text is that of its units. The distinct units of
a batch are sorted, which is a depth-first walk of their trie; the forward scores of the prefix that a unit shares with the
one before it stay, and only its other characters are worked off. Among equally good segmentations the one whose last
piece is the longest wins, for every prefix.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleframe.llm.hashing import chunked
from aisleframe.llm.pieces import MARK, VOCABULARY, Pieces, load, shared_prefix

# A mark of the text itself travels as this character, which no text of valid UTF-8 holds; it is written as bytes.
_OWN_MARK = "\udcff"
_UNIT = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
MEMO = 300_000


def marked(text: str) -> str:
    return MARK + text.replace(MARK, _OWN_MARK).replace(" ", MARK)


def _raw(char: str) -> bytes:
    return MARK.encode() if char == _OWN_MARK else char.encode("utf-8", "surrogatepass")


class Encoder:
    """Best segmentations by forward scores; ids of the units met lately are kept, in two tables of bounded size."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.tree = pieces.backwards()
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def learn(self, units: Iterable[str]) -> None:
        """Ids of units, in sorted order, sharing the forward scores of common prefixes."""
        bytes_, tree, known = self.pieces.bytes_, self.tree, self.known
        best, back, last, before = [0.0], [0], [()], ""
        for unit in sorted(units):
            k = shared_prefix(before, unit)
            del best[k + 1:], back[k + 1:], last[k + 1:]
            for j in range(k, len(unit)):
                score, first, part = None, j, ()
                node = tree
                for i in range(j, -1, -1):
                    node = node.get(unit[i])
                    if node is None:
                        break
                    piece = node.get("")
                    if piece is not None:
                        s = best[i] + piece[1]
                        if score is None or s >= score:
                            score, first, part = s, i, piece[2]
                if first == j and len(part) != 1:  # no piece ends here: the character's bytes
                    raw = _raw(unit[j])
                    score, part = best[j] + sum([bytes_[b][1] for b in raw]), tuple([bytes_[b][0] for b in raw])
                best.append(score)
                back.append(first)
                last.append(part)
            parts, j = [], len(unit)
            while j:
                parts.append(last[j])
                j = back[j]
            known[unit] = [i for part in reversed(parts) for i in part]
            before = unit

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; the units of all texts together are one walk."""
        cut = [_UNIT.findall(marked(t)) if t else [] for t in texts]
        units = set().union(*cut)
        if len(self.known) + len(units) > MEMO:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = []
        for u in units:
            if u not in known:
                if u in older:
                    known[u] = older[u]
                else:
                    new.append(u)
        self.learn(new)
        return [[i for u in units for i in known[u]] for units in cut]


class Decoder:
    def __init__(self, pieces: Pieces):
        size = max([i for i, _ in pieces.words.values()] + [i for i, _ in pieces.bytes_]) + 1
        self.raw: list[bytes | None] = [None] * size
        for piece, (i, _) in pieces.words.items():
            self.raw[i] = piece.replace(MARK, " ").encode()
        for b, (i, _) in enumerate(pieces.bytes_):
            self.raw[i] = bytes([b])

    def decode(self, ids: Iterable[int]) -> bytes:
        """The text of ids; control ids and ids outside the vocabulary are an error."""
        raw = self.raw
        parts = [raw[i] for i in ids]
        if None in parts:
            raise ValueError("an id that stands for no text")
        return b"".join(parts)[1:]


def _encode(pieces: Pieces, keep: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(pieces), Decoder(pieces)
        for part, raw in chunked(batches):
            ids = encoder.encode([t.decode("utf-8", "replace") for t in raw])
            same = [decoder.decode(i) == t for i, t in zip(ids, raw, strict=True)]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in keep], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                 pa.array([len(i) for i in ids], pa.int64()), pa.array(same, pa.bool_())],
                names=[*keep, "ids", "n_pieces", "exact"])
    return run


def _columns(df: DataFrame, keep: tuple[str, ...], more: str) -> str:
    return ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema], more])


def encode(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), vocabulary: str = VOCABULARY) -> DataFrame:
    """`keep`, ids, n_pieces and exact (decoding the ids gives the text again) of each row of docs (text).

    Whole texts, unchanged: no normalisation, no end pieces. Null and empty texts have no ids. Rows that repeat give equal rows.
    Characters without a piece are written as bytes, so every text can be written. The vocabulary is read by the driver.
    Other columns of docs are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(vocabulary))  # a few ten thousand pieces
    return docs.select(*keep, "text").mapInArrow(
        lambda batches: _encode(shared.value, list(keep))(batches), _columns(docs, keep, "ids array<int>, n_pieces bigint, exact boolean"))


def decode(encoded: DataFrame, keep: tuple[str, ...] = ("doc_id",), vocabulary: str = VOCABULARY) -> DataFrame:
    """`keep` and text of each row of encoded (ids); null ids give the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(vocabulary))
    names = list(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            texts = [decoder.decode(i or []) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(texts, pa.binary()).cast(pa.string())], names=[*names, "text"])

    return encoded.select(*keep, F.col("ids")).mapInArrow(run, _columns(encoded, keep, "text string"))
