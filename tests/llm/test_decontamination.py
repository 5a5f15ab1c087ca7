import itertools
import random
import re

import pytest

from aisleframe.llm import decontamination as D

WORDS = re.compile(r"[^\W_]+")


def brute(docs, items):
    best = {}
    for k, text in docs:
        have = WORDS.findall((text or "").lower())
        for item, wanted in items:
            want = WORDS.findall((wanted or "").lower())
            n = len(want)
            if n < D.LEAST_WORDS:
                continue
            width, misses = min(n, D.WINDOW), D.MISSES if n >= D.WINDOW else 0
            for d in range(-n, len(have)):
                covered = set()
                for s in range(max(0, -d), min(n, len(have) - d) - width + 1):
                    if sum(want[s + j] == have[s + j + d] for j in range(width)) >= width - misses:
                        covered.update(range(s, s + width))
                if covered:
                    best[k, item] = (n, max(len(covered), best.get((k, item), (0, 0))[1]))
    return sorted((k, i, n, c) for (k, i), (n, c) in best.items())


def corpus():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(150)] + ["the"] * 30
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [text(n) for n in (40, 25, 13, 14, 12, 6, 5, 4, 1)] + [["same"] * 20]
    docs = []
    for item in items:
        for misses in (0, 1, 2, 3, 6):
            copy = list(item)
            for p in rng.sample(range(len(copy)), min(misses, len(copy))):
                copy[p] = "other"
            docs.append(text(rng.randint(0, 30)) + copy + text(rng.randint(0, 30)))
        docs.append(text(9) + item[: len(item) // 2] + text(5) + item[len(item) // 2:])
        docs.append(item[3:])
    docs += [text(100) for _ in range(10)] + [items[0] * 3]
    rows = [(i, ", ".join(d).replace("w1", "W1")) for i, d in enumerate(docs)] + [(900, None), (901, ""), (902, "... -- _")]
    rows += [rows[0], (0, rows[3][1])]
    return rows, [(i, " ".join(t)) for i, t in enumerate(items)] + [(50, None), (51, ""), (0, " ".join(items[0]))]


@pytest.mark.parametrize("limit", [D.BROADCAST_SEEDS, 0])
def test_against_brute_force(spark, docs_of, monkeypatch, limit):
    monkeypatch.setattr(D, "BROADCAST_SEEDS", limit)
    docs, items = corpus()
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, h string")
    found = D.leaks(docs_of(docs), table).collect()
    assert sorted(map(tuple, found)) == brute(docs, dict(items).items())


def test_every_leak_shares_a_seed():
    """All ways to differ in up to MISSES of WINDOW words, from even and odd positions."""
    for parity, misses in itertools.product(range(D.STEP), range(D.MISSES + 1)):
        for off in itertools.combinations(range(D.WINDOW), misses):
            assert any(
                at + mask[-1] < D.WINDOW and not set(off) & {at + k for k in mask}
                for mask in D.MASKS for at in range(parity, D.WINDOW, D.STEP))


def test_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.leaks(docs_of([]), items).collect() == []
    assert D.leaks(docs_of(["a b c d e f"]), items.limit(0)).collect() == []
    assert [tuple(r) for r in D.leaks(docs_of(["x A b c, d e F"]), items).collect()] == [(0, 1, 6, 6)]


def brute_short(docs, items):
    """Items below a window with a share of misses; words are given as lists."""
    found = set()
    for k, have in docs:
        for item, want in items:
            n = len(want)
            if any(sum(a != b for a, b in zip(want, have[d: d + n])) <= n * D.MISSES // D.WINDOW for d in range(len(have) - n + 1)):
                found.add((k, item, n, n))
    return sorted(found)


def test_short_items(spark, docs_of):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(n, text(n)) for n in range(1, D.WINDOW)]
    docs = []
    for _, item in items:
        for p in range(len(item)):
            docs.append(text(6) + item[:p] + ["other"] + item[p + 1:] + text(5))
        docs += [text(3) + item + text(4), item, item[1:], [*item[:1], "x", "y", *item[3:]]]
    docs = list(enumerate(docs))
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = D.leaks(docs_of([(k, " ".join(d)) for k, d in docs]), table, short_items=True).collect()
    assert sorted(map(tuple, found)) == brute_short(docs, items)
    assert {r["item_id"] for r in found} == set(range(1, D.WINDOW))


def test_scripts_without_spaces(spark, docs_of):
    question = "\u6c34\u5728\u6807\u51c6\u5927\u6c14\u538b\u4e0b\u7684\u6cb8\u70b9\u662f\u591a\u5c11\u6444\u6c0f\u5ea6"
    table = spark.createDataFrame([(1, question), (2, "\u30ab\u30bf\u30ab\u30ca\u306e\u554f\u984c"), (3, "Tokyo \u6771\u4eac")], "item_id long, text string")
    changed = question[:5] + "\u5730" + question[6:]
    docs = [f"\u6211\u60f3\u77e5\u9053{question}\u8c22\u8c22", f"\u6211{changed}\u3002", question[:8], "\u3053\u306e\u30ab\u30bf\u30ab\u30ca\u306e\u554f\u984c\u3067\u3059", "in tokyo\u6771\u4eac"]
    found = D.leaks(docs_of(docs), table, short_items=True).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 17, 17), (1, 1, 17, 17), (3, 2, 7, 7), (4, 3, 3, 3)]
