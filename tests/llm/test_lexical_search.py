import math
import random
import re
from collections import Counter

import pytest

from aisleframe.llm import lexical_search
from aisleframe.llm.lexical_search import ranked_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top):
    bags = [(k, Counter(ts), len(ts)) for k, ts in ((k, terms(t)) for k, t in docs) if ts]
    n, total = len(bags), sum(b[2] for b in bags)
    df = Counter(t for b in bags for t in b[1])
    wanted = {}
    for k, t in items:
        wanted.setdefault(k, set()).update(terms(t))
    out = []
    for item, ts in wanted.items():
        scored = []
        for k, tf, size in bags:
            m = 50 + 50 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in ts if tf[t])
            if score > 0:
                scored.append((-score, k is None, k or 0, k))
        out += [(item, r + 1, k, -s) for r, (s, _, _, k) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def tables(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "naïve", "日本語", "ß", "42", "İ"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: rng.choice([" ", "-", ". "]).join(rng.choices(words, weights, k=n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(200)]
    copy = text(30)
    docs += [(1000 + rng.randrange(500), copy) for _ in range(90)]  # copies, ids may repeat
    docs += [(None, copy), (None, text(9)), (7, None), (8, ""), (9, " .,-"), (-4, copy.upper() + " zzz"), (11, "w1 " * 300_000)]
    items = [(i, text(rng.randint(1, 15))) for i in range(25)] + [(3, "W5 w6"), (3, None), (90, None), (91, "nowhere"), (None, "w1 w2"), (None, "w3")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"top": 7, "block_terms": 60}, {"top": 100}])
def test_against_brute_force(spark, settings, monkeypatch):
    monkeypatch.setattr(lexical_search, "SALTS", 3)
    docs, items = tables()
    left = spark.createDataFrame([(k, t, 1, 2) for k, t in docs], "doc_id long, text string, n int, item_id int").repartition(6)
    right = spark.createDataFrame([(k, t, 5) for k, t in items], "item_id long, text string, doc_id int")
    found = [tuple(r) for r in ranked_documents(left, right, **settings).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[1])) == brute(docs, items, settings.get("top", 50))


def test_small_memory_changes_nothing(monkeypatch):
    """Classes are scored piece by piece, and the best are thinned out again and again."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    term, item = np.nonzero(rng.random((40, 9)) < 0.3)
    items = lexical_search._Items(term, item, 40, 9)
    bags = [np.array([(t, rng.integers(1, 5)) for t in np.flatnonzero(rng.random(40) < 0.4)], lexical_search._BAG) for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({
        "class": list(range(300)), "bag": [b.tobytes() for b in bags], "m": [60 + i % 3 for i in range(300)],
        "first_id": [None if i % 50 == 7 else 500 - i for i in range(300)]})
    weight = rng.integers(1, 9, 40)
    best = lambda: {tuple(r.values()) for p in lexical_search._scored(items, weight, 5)([batch]) for r in p.to_pylist()}
    whole = best()
    monkeypatch.setattr(lexical_search, "CELLS", 64)
    assert best() == whole and len(whole) == 45


def test_no_documents_or_items(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_documents(docs.limit(0), items).collect() == [] and ranked_documents(docs, items.limit(0)).collect() == []
