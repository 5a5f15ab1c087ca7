"""A public SentencePiece vocabulary as a unigram model: pieces, ids and log-probabilities, and its lattice over marked words.

The vocabulary files in use keep merge ranks as scores. A piece of rank r gets a probability in proportion to 1 / (r + 10)
(Zipf's law over ranks); a byte piece gets the smallest of these, less PENALTY, so bytes stand in only where no piece fits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

MARK = "▁"
PENALTY = 10.0
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Pieces:
    """piece -> (id, log-probability); byte value -> (id, log-probability). A few ten thousand entries, sent to each task."""

    words: dict[str, tuple[int, float]]
    bytes_: list[tuple[int, float]]
    longest: int = field(init=False)
    endings: frozenset[str] = field(init=False)

    def __post_init__(self):
        self.longest = max(map(len, self.words), default=1)
        self.endings = frozenset(p[i:] for p in self.words for i in range(len(p)))

    def backwards(self) -> dict:
        """The pieces as a trie from their last character to the first; at "" of a node its (id, log-probability, (id,))."""
        root: dict = {}
        for piece, (i, lp) in self.words.items():
            node = root
            for char in reversed(piece):
                node = node.setdefault(char, {})
            node[""] = (i, lp, (i,))
        return root

    def with_scores(self, words: dict[int, float], bytes_: float) -> Pieces:
        """The same pieces with other log-probabilities: by id, and one for all bytes."""
        return Pieces({p: (i, words[i]) for p, (i, _) in self.words.items()}, [(i, bytes_) for i, _ in self.bytes_])


def load(path: str = VOCABULARY) -> Pieces:
    """Read on the driver; tasks get the result. Control and unknown pieces are left out; all 256 byte pieces must be there."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks, bytes_ = {}, {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            bytes_[int(model.id_to_piece(i)[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ranks[model.id_to_piece(i)] = (i, -model.get_score(i))
    if len(bytes_) != 256:
        raise ValueError(f"{path} has no byte pieces")
    bad = [p for p in ranks if MARK in p.lstrip(MARK) or len(p) > 1 and "\n" in p]
    if bad:
        raise ValueError(f"pieces that reach over a word's start: {bad[:5]}")
    total = math.log(sum(1 / (r + 10) for _, r in ranks.values()))
    words = {p: (i, -math.log(r + 10) - total) for p, (i, r) in ranks.items()}
    least = min(lp for _, lp in words.values()) - PENALTY
    return Pieces(words, [(bytes_[b], least) for b in range(256)])


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    k = 0
    while a[k] == b[k]:
        k += 1
    return k


class Lattice:
    """All segmentations of one marked word after another; forward scores of a prefix shared with the word before stay."""

    def __init__(self, pieces: Pieces):
        self.words, self.bytes_, self.endings = pieces.words, pieces.bytes_, pieces.endings
        self.before = ""
        self.arcs: list[list] = [[]]  # for each end: (first, piece or None for bytes, log-probability)
        self.alpha = [0.0]

    def total(self, word: str) -> float:
        """Log of the summed probability of all segmentations of the marked word, by forward recursion in log space."""
        k = shared_prefix(self.before, word)
        alpha, arcs, words, endings = self.alpha, self.arcs, self.words, self.endings
        del alpha[k + 1:], arcs[k + 1:]
        for j in range(k + 1, len(word) + 1):
            here, terms = [], []
            for i in range(j - 1, -1, -1):
                part = word[i:j]
                if part not in endings:
                    break
                known = words.get(part)
                if known is not None:
                    here.append((i, part, known[1]))
                    terms.append(alpha[i] + known[1])
            char = word[j - 1]
            if char not in words:
                raw = char.encode("utf-8", "surrogatepass")
                lp = len(raw) * self.bytes_[0][1]
                here.append((j - 1, None, lp))
                terms.append(alpha[j - 1] + lp)
            arcs.append(here)
            if len(terms) == 1:
                alpha.append(terms[0])
            else:
                top = max(terms)
                alpha.append(top + math.log(sum([math.exp(t - top) for t in terms])))
        self.before = word
        return alpha[-1]

    def expect(self, word: str, into: dict, weight: float = 1.0) -> None:
        """Adds the expected number of each piece (None: bytes) in a segmentation of the word, times weight."""
        self.total(word)
        flow = [0.0] * (len(word) + 1)
        flow[-1] = weight
        exp, alpha = math.exp, self.alpha
        for j in range(len(word), 0, -1):
            f = flow[j]
            if f:
                base = alpha[j]
                for i, part, lp in self.arcs[j]:
                    share = f * exp(alpha[i] + lp - base)
                    flow[i] += share
                    into[part] = into.get(part, 0.0) + share
