import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from aisleframe.llm import quality as Q

WORDS = re.compile("[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORDS.findall(text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:], strict=False)) if grams[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def clean(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(n)) + "."


def corpus():
    rng = random.Random(9)
    rows = []
    for i in range(260):
        rows.append((i, clean(rng, rng.randint(50, 300)), ("en", "de")[i % 2], f"s{i % 4}"))
    for i in range(12):
        rows.append((1000 + i, " ".join(w + "###" for w in clean(rng, 120).split()), "en", "s0"))
        rows.append((1100 + i, clean(rng, 120).upper().replace(" ", "!! "), "de", "s1"))
    line = clean(rng, 12)
    rows += [(2000, "\n".join([line] * 9), "en", "s0"), (2001, "a b c " * 40, "en", None), (2002, None, None, None), (2003, "", "en", "s0"),
             (2004, " \n\t ", "en", "s0"), (2005, "\n".join([line, clean(rng, 60), "é ü", "é ü", line + " "]), "fr", "s9"),
             (2005, clean(rng, 70), "xx", None), (2006, "x" * 3000 + " " + clean(rng, 80), "en", "s2")]
    return rows


@pytest.fixture(scope="module")
def judged(docs_of):
    return {(r["doc_id"], r["n_words"]): r for r in Q.quality_verdicts(docs_of(corpus())).collect()}


def test_plain_counts_and_rules(judged):
    rows = corpus()
    assert len(judged) == len(rows)
    for k, text, *_ in rows:
        own = base(text)
        r = judged[(k, own[0])]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == own
        assert r["base_failed"] == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert not (r["base_failed"] and r["kept"])


def test_clean_texts_stay_and_junk_goes(judged):
    for (k, _), r in judged.items():
        if k < 1000:
            assert r["kept"]
        elif k < 2000:
            assert not r["kept"] and not r["base_failed"]


def brute_distances(x):
    """The same estimate with numpy on one group: quartiles, steps on whole histogram tiers while the determinant falls, scale by the
    median tier."""
    n, floors = len(x), np.array(list(Q.VECTOR.values()))
    order = np.sort(x, axis=0)
    at = lambda p: order[max(math.ceil(p * n) - 1, 0)]
    mean, inverse = at(0.5), np.diag(1 / np.maximum(((at(0.75) - at(0.25)) / 1.349) ** 2, floors ** 2))
    square = lambda: np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
    tier = lambda: np.floor(np.log(np.maximum(square(), 1e-9)) * Q.TIERS).astype(int)

    def last(share):
        t = tier()
        return max(v for v in set(t.tolist()) if (t < v).sum() < n * share)

    det = math.inf
    while True:
        inner = x[tier() <= last(Q.H)]
        cov = inner.T @ inner / len(inner) - np.outer(inner.mean(axis=0), inner.mean(axis=0))
        np.fill_diagonal(cov, np.maximum(np.diag(cov), floors ** 2))
        new = np.linalg.slogdet(cov)[1]
        if new >= det - Q.FALLS:
            break
        det, mean, inverse = new, inner.mean(axis=0), np.linalg.inv(cov)
    factor = max(math.exp((last(0.5) + 0.5) / Q.TIERS) / Q.chi_square(0.5, Q.D), 1.0)
    return square() / factor


def test_estimate_against_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, Q.D)) @ rng.normal(size=(Q.D, Q.D))
    x[:40] += 30
    rows = [("g", *map(float, r)) for r in x] + [("h", *map(float, r)) for r in x[:150] * 3]
    df = spark.createDataFrame(rows, ["group", *Q.NAMES]).repartition(3)
    model = Q.estimates(df)
    found = df.join(model, "group").select("group", *Q.NAMES, Q._distance().alias("d")).collect()
    for group, own in (("g", x), ("h", x[:150] * 3)):
        have = {tuple(r[n] for n in Q.NAMES): r["d"] for r in found if r["group"] == group}
        assert [have[tuple(map(float, r))] for r in own] == pytest.approx(brute_distances(own).tolist(), rel=1e-6)


def test_determinant_falls_with_the_steps(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, Q.D)) @ rng.normal(size=(Q.D, Q.D))
    x[:140] = x[:140] * 0.2 + 9
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], ["group", *Q.NAMES])
    dets = [Q.estimates(df, steps=k).first()["det"] for k in (1, 2, 4, Q.STEPS)]
    assert all(b <= a for a, b in zip(dets, dets[1:], strict=False)) and dets[-1] < dets[0]


def test_moderate_outliers(docs_of):
    """Symbols count by what the others of a source have: 10 to 25 in 100 words stay where all have them, and go where none has."""
    rng = random.Random(11)

    def marked(share):
        return " ".join(w + "#" * (rng.random() < share) for w in clean(rng, rng.randint(150, 300)).split())

    rows = [(i, clean(rng, rng.randint(60, 300)), "en", "plain") for i in range(300)]
    rows += [(1000 + i, marked(rng.uniform(0.1, 0.25)), "en", "marked") for i in range(300)]
    rows += [(2000 + i, marked(rng.uniform(0.15, 0.25)), "en", "plain") for i in range(8)]
    found = {r["doc_id"]: r["kept"] for r in Q.quality_verdicts(docs_of(rows)).collect()}
    assert all(kept for k, kept in found.items() if k < 2000) and not any(kept for k, kept in found.items() if k >= 2000)


def test_null_language_and_source_are_told_apart(docs_of):
    rng = random.Random(12)
    rows = [(i, clean(rng, 80), *(("x", None), (None, "x"))[i % 2]) for i in range(240)]
    assert all(r["kept"] for r in Q.quality_verdicts(docs_of(rows)).collect())


def test_empty_table(docs_of):
    assert Q.quality_verdicts(docs_of([])).collect() == []


def test_quantiles():
    assert Q.chi_square(0.95, 6) == pytest.approx(12.59, rel=0.01) and Q.chi_square(0.5, 6) == pytest.approx(5.348, rel=0.01)


def test_many_groups_are_dealt(docs_of, monkeypatch):
    shape = lambda: sorted(
        (str(r["doc_id"]), r["n_words"], r["kept"], round(r["distance"] or 0.0, 6)) for r in Q.quality_verdicts(docs_of(corpus())).collect())
    sent = shape()
    monkeypatch.setattr(Q, "SENT_BYTES", -1)
    assert shape() == sent
