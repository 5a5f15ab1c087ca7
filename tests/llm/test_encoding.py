import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aisleframe.llm.encoding import _OWN_MARK, Decoder, Encoder, _raw, decode, encode, marked
from aisleframe.llm.pieces import Pieces, load


@pytest.fixture(scope="module")
def pieces():
    return load()


SMALL = Pieces(
    {p: (i + 256, -1.0 - 0.37 * i) for i, p in enumerate(["▁", "a", "b", "▁a", "ab", "▁ab", "ba", "aba", "▁▁", "bab", "abab", "é"])},
    [(i, -20.0) for i in range(256)])


def best(text):
    """The best sum over all segmentations, by trying all of them."""
    if not text:
        return 0.0
    found = []
    for k in range(1, len(text) + 1):
        if text[:k] in SMALL.words:
            found.append(SMALL.words[text[:k]][1] + best(text[k:]))
    if text[0] not in SMALL.words:
        found.append(-20.0 * len(_raw(text[0])) + best(text[1:]))
    return max(found)


def value(ids):
    scores = {i: lp for i, lp in [*SMALL.words.values(), *SMALL.bytes_]}
    return sum(scores[i] for i in ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé \n▁x", max_size=9), max_size=5))
def test_against_all_segmentations(texts):
    encoder, decoder = Encoder(SMALL), Decoder(SMALL)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert decoder.decode(ids) == text.encode()
        assert value(ids) == pytest.approx(best(marked(text)) if text else 0.0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_round_trip(pieces, texts):
    encoder, decoder = Encoder(pieces), Decoder(pieces)
    for _ in range(2):
        assert [decoder.decode(i) for i in encoder.encode(texts)] == [t.encode() for t in texts]


def test_order_and_memory_do_not_matter(pieces, monkeypatch):
    texts = ["the theme of them", "them the", "a  b\n\nc ▁", "", "theme theme"] * 3
    whole = Encoder(pieces).encode(texts)
    monkeypatch.setattr("aisleframe.llm.encoding.MEMO", 3)
    single = Encoder(pieces)
    assert [single.encode([t])[0] for t in reversed(texts)] == whole[::-1]


def test_tables(spark, docs_of):
    texts = ["Thé  word\n▁ \U0001f600", None, "", "x" * 50_000, "repeat", "repeat"]
    rows = [(i // 1, t) for i, t in enumerate(texts)] + [(None, "repeat")]
    coded = encode(docs_of(rows))
    found = coded.collect()
    assert all(r["exact"] and r["n_pieces"] == len(r["ids"]) for r in found) and len(found) == 7
    assert {r["n_pieces"] for r in found if r["doc_id"] in (1, 2)} == {0}
    back = {r["doc_id"]: r["text"] for r in decode(coded).collect()}
    assert back == {**{i: t or "" for i, t in enumerate(texts)}, None: "repeat"}
    assert encode(docs_of([])).collect() == []


def test_unknown_ids(pieces):
    with pytest.raises(ValueError):
        Decoder(pieces).decode([1])
    assert _OWN_MARK not in load().words
