import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from aisleframe.llm.hashing import Texts
from aisleframe.llm.substring_dedup import _kmer_words, _sampled, remove_repeats

WORDS = re.compile("[^\x20\x09-\x0D]+")


def brute(texts, window=35):
    words = [WORDS.findall(t or "") for t in texts]
    count = Counter(tuple(w[i: i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i: i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 3)))
    text = lambda n: [word() for _ in range(n)]
    passage, other = text(60), text(35)
    texts = [
        text(80) + passage + text(40), passage + text(20), text(10) + passage, text(3) + other, other, text(50) + other[:34] + text(4),
        ["x"] * 200, ["x"] * 36, ["a", "b"] * 40, passage[:50] + other + passage[20:], text(34), text(500)]
    whole = text(120)
    near = list(whole)
    near[60] = "changed"
    texts += [whole, whole, near, text(30) + whole[10:90] + text(5) + whole[40:110]]
    joined = [" ".join(t) for t in texts]
    return [*joined, None, "", "  \n ", joined[0].replace(" ", "\n\t"), joined[4]]


def test_against_brute_force(docs_of):
    texts = corpus()
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"], r["kept_sha256"]) for r in remove_repeats(docs_of(texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts)


def test_rows_that_repeat_count_as_texts(docs_of):
    text = " ".join(f"w{i}" for i in range(40))
    rows = remove_repeats(docs_of([(1, text), (1, text), (None, "short one"), (2, " ".join(f"v{i}" for i in range(90)))])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in rows) == [(0, 0), (1, 40), (1, 40), (2, 0)]


def test_empty_table(docs_of):
    assert remove_repeats(docs_of([]), window=10).collect() == []


@pytest.mark.parametrize("window", [6, 10, 35])
def test_every_window_holds_a_sampled_kmer(window):
    k = _kmer_words(window)
    rng = np.random.default_rng(3)
    for size in (2, 5, 1000):
        h = Texts([" ".join(map(str, rng.integers(0, size, 4000))).encode()]).hash
        marks = np.zeros(len(h) + 1, int)
        marks[_sampled(h, k)] = 1
        sums = np.concatenate(([0], np.cumsum(marks)))
        starts = np.arange(len(h) - window + 1)
        assert (sums[starts + window - k + 1] - sums[starts]).min() >= 1


def test_window_too_short(docs_of):
    with pytest.raises(ValueError):
        remove_repeats(docs_of(["a"]), window=5)
