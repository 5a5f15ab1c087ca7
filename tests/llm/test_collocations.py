import random
import re
from collections import Counter

import pytest

from aisleframe.llm import collocations as c

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, least, top, within=50):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i: i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = {}
    for p, a in found.items():
        if any(len(q) > len(p) and q[0] == p[0] and 100 * b >= within * a
               and any(q[1 + i: len(p) + i] == p[1:] for i in range(len(q) - len(p) + 1)) for q, b in found.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[p[:k + 1]] * f[(p[0], *p[k + 1:])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), f[p[:k + 1]], f[(p[0], *p[k + 1:])]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, all_ in out.items() for i, (s, a, p, left, right) in enumerate(sorted(all_)[:top]))


def corpus(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["New", "York", "the", "É", "naïve", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts += rng.choices(words, weights) + [rng.choice([" ", "  ", "\t", ". ", ", ", "\n", " ", " "])]
            if rng.random() < 0.1:
                parts += ["new York City", " "]
        rows.append(("".join(parts), ("en", "fr", None)[i % 7 % 3]))
    copy = "this long copied line, stands again and again! here"
    return rows + [(copy, "en")] * 40 + [(None, "en"), ("", "de"), ("alone", "xx"), (" \n.,", None), ("a b " * 5000, "en")]


@pytest.mark.parametrize("settings", [
    {"least": 3, "top": 12}, {"least": 2, "top": 10_000, "sample_every": 3}, {"least": 10, "top": 5, "sample_every": 1},
    {"least": 5, "top": 50, "bitmap_bits": 1 << 15, "sample_every": 1000}])
def test_against_brute_force(spark, settings):
    rows = corpus()
    docs = spark.createDataFrame([(t, x, 1, "k") for t, x in rows], "text string, lang string, n int, key string").repartition(5)
    found = sorted(tuple(r[k] for k in COLUMNS) for r in c.collocations(docs, **settings).collect())
    assert found == brute(rows, settings["least"], settings["top"])


def test_failures_of_the_border_are_closed(spark):
    # an empty sample proposes nothing: words, pairs and triples are all found by further passes
    rows = [("one two three four", "en")] * 12
    docs = spark.createDataFrame(rows, "text string, lang string")
    calls = []
    counter, c._counter = c._counter, lambda now, before: calls.append(before) or counter(now, before)
    try:
        found = c.collocations(docs, sample_every=1 << 40).collect()
    finally:
        c._counter = counter
    assert len(calls) == 4 and {r["phrase"] for r in found} == {"one two three", "two three four"}


def test_scores_of_more_than_64_bits(spark):
    row = spark.createDataFrame([(4_000_000_000_000, 5_000_000_000_000, 6_000_000_000_000)], "a long, l long, r long")
    assert row.select(c._score("a", "l", "r").alias("s")).first()["s"] == 1_000_000 * 16 // 30


def test_empty_table(spark):
    assert c.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
