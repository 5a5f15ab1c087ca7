import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from aisleframe.llm import hashing
from aisleframe.llm.hashing import Texts, chunked, hash_words

WORDS = re.compile("[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet="ab é\t\n\x0b\x1c\x85 ▁", max_size=40), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_windows_are_equal_where_words_are(texts, n):
    found = Texts([t.encode() for t in texts])
    words = [WORDS.findall(t) for t in texts]
    assert found.counts.tolist() == [len(w) for w in words]
    h, at = found.windows(n)
    own = [tuple(w[i: i + n]) for w in words for i in range(len(w) - n + 1)]
    assert len(h) == len(own)
    assert len(set(h.tolist())) == len(set(own)) and len({*zip(h.tolist(), own, strict=True)}) == len(set(own))
    assert found.position(at).tolist() == [i for w in words for i in range(len(w) - n + 1)]


def test_only_ascii_letters_are_lowered():
    a, b = Texts(["ÄB".encode(), "Äb".encode()], lower=True).hash.tolist()
    assert a == b
    a, b = Texts(["Ä".encode(), "ä".encode()], lower=True).hash.tolist()
    assert a != b


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = ("one two  three\n" * 50 + "x" * 300 + " end").encode()
    whole = hash_words(text)
    monkeypatch.setattr(hashing, "CHUNK", 64)
    parts = hash_words(text)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()


def test_slices_keep_every_row(monkeypatch):
    monkeypatch.setattr(hashing, "CHUNK", 10)
    texts = ["", None, "abc", "x" * 25, "defgh", "ij", None, "klmnopqrst", "u"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(9)), "text": texts})
    seen = [(i, t) for part, raw in chunked([batch, batch.slice(0, 0)]) for i, t in zip(part.column("id").to_pylist(), raw, strict=True)]
    assert seen == [(i, (t or "").encode()) for i, t in enumerate(texts)]
