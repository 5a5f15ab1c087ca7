import math
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aisleframe.llm import lm_score as L
from aisleframe.llm.pieces import MARK, Lattice, Pieces, load

SMALL = Pieces(
    {p: (i + 256, -1.0 - 0.37 * i) for i, p in enumerate(["▁", "a", "b", "▁a", "ab", "▁ab", "ba", "aba", "bab"])}, [(i, -9.0) for i in range(256)])


def segmentations(text):
    if not text:
        yield []
    for k in range(1, len(text) + 1):
        if text[:k] in SMALL.words:
            for rest in segmentations(text[k:]):
                yield [(text[:k], SMALL.words[text[:k]][1]), *rest]
    if text and text[0] not in SMALL.words:
        for rest in segmentations(text[1:]):
            yield [(None, -9.0 * len(text[0].encode())), *rest]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abé", max_size=8), min_size=1, max_size=6))
def test_lattice_against_all_segmentations(words):
    lattice = Lattice(SMALL)
    for w in words:
        all_of_them = list(segmentations(MARK + w))
        parts = [math.exp(sum(lp for _, lp in s)) for s in all_of_them]
        assert lattice.total(MARK + w) == pytest.approx(math.log(sum(parts)))
        own, found = {}, {}
        for s, p in zip(all_of_them, parts, strict=True):
            for piece, _ in s:
                own[piece] = own.get(piece, 0.0) + p / sum(parts)
        lattice.expect(MARK + w, found)
        assert found == pytest.approx(own)


def test_long_words_do_not_underflow():
    assert -1e7 < Lattice(SMALL).total(MARK + "ab" * 20_000) < -1e4


def rows():
    rng = random.Random(6)
    syllables = ["tan", "ver", "lo", "mi", "ka", "ren"]
    text = lambda: " ".join("".join(rng.choice(syllables) for _ in range(rng.choice([1, 1, 1, 2, 3]))) for _ in range(rng.randint(1, 60)))
    out = [(i, text()) for i in range(120)]
    return out + [(500, None), (501, ""), (502, "Tan TAN ÉT\x0b\n tan."), (None, "tan lo"), (0, out[0][1]), (503, "unseen" * 40)]


@pytest.mark.parametrize("head", [L.HEAD, 3])
def test_against_plain_counts(docs_of, head):
    table = rows()
    found = L.score_texts(docs_of(table), head=head).collect()
    tokens = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    train = {}
    for k, t in table:
        for w in [*tokens(t), ""] if not held(k) else []:
            train[w] = train.get(w, 0) + 1
    n, v = sum(train.values()), len(train)
    # the fitted pieces, by one step of expectation over distinct training words
    pieces, sums = load(), {}
    lattice = Lattice(pieces)
    for w in train:
        if w:
            lattice.expect(MARK + w, sums)
    total = sum(sums.values()) + 0.1 * (len(pieces.words) + 256)
    fitted = Lattice(pieces.with_scores(
        {i: math.log((sums.get(p, 0.0) + 0.1) / total) for p, (i, _) in pieces.words.items()}, math.log((sums.get(None, 0.0) + 25.6) / 256 / total)))
    free = L.DISCOUNT * v / n

    def model(w):
        c = train.get(w, 0)
        if not w:
            return math.log10((c - L.DISCOUNT) / n)
        lat = fitted.total(MARK + w)
        return math.log10(max(c - L.DISCOUNT, 0) / n + free * math.exp(lat)) if c else (lat + math.log(free)) / math.log(10)

    assert len(found) == len(table)
    own = sorted(
        (str(k), held(k), len(ws), sum(w in train for w in ws), n, sum(math.log10((train.get(w, 0) + 1) / (n + v + 1)) for w in ws), sum(map(model, ws)))
        for k, t in table for ws in [[*tokens(t), ""]])
    for have, want in zip(sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in found), own, strict=True):
        assert have[:5] == want[:5] and have[5:] == pytest.approx(want[5:], rel=1e-9)


def test_without_training_rows(docs_of):
    from pyspark.sql import functions as F
    found = L.score_texts(docs_of([(1, "a b"), (2, None)]), held=F.lit(True)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert all(r["score"] <= 0 for r in found)
    assert L.score_texts(docs_of([])).collect() == []


def test_least_count(spark):
    counts = [9, 9, 7, 5, 5, 5, 1, 0, 70_000, 70_001, 900_000]
    words = spark.createDataFrame([(str(i), n) for i, n in enumerate(counts)], "word string, n long")
    for head in range(len(counts) + 2):
        least = L._least_count(words, head)
        taken = [n for n in counts if n >= least]
        assert len(taken) <= head
        if head >= len(counts):
            assert len(taken) == len(counts)
    assert L._least_count(words, 5) == 9  # the three 5s and the 7 do not fit below 900000, 70001, 70000, 9, 9
    assert L._least_count(words.filter("n < 0"), 5) > 1 << 60
