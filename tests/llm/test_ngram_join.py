import random

import pyarrow as pa
import pytest

from aisleframe.llm import ngram_join, shared
from aisleframe.llm.components import components
from aisleframe.llm.ngram_join import near_duplicate_groups


def grams(text, n):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i: i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def brute(rows, n=5, percent=80):
    sets = [grams(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[top(i)] = top(j)
    smallest = {}
    for i, (k, _) in enumerate(rows):
        smallest[top(i)] = min(smallest.get(top(i), k), k)
    return sorted((k, len(s), smallest[top(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def corpus(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    line = text(9)
    texts = [line + text(rng.randint(5, 60)) for _ in range(60)]
    base = text(80)
    for _ in range(40):  # a large group of near copies, some at the threshold, some chained
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(80)] = rng.choice(vocabulary)
        texts.append(copy)
    chain = text(100)
    for i in range(12):
        chain = list(chain)
        chain[8 * i: 8 * i + 3] = text(3)
        texts.append(chain)
    texts += [text(k) for k in (1, 2, 3, 4, 5)] * 2 + [["a"], ["A"], ["a", "b"], ["a", "b", "a", "b", "a", "b"], ["a", "b"] * 9]
    rng.shuffle(texts)
    rows = [(i + 10, " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(5, None), (6, ""), (7, " \n"), (3, rows[0][1].upper()), (rows[1][0], rows[1][1])]


@pytest.mark.parametrize("settings", [{"n": 4, "percent": 85}, {"common": 3, "bitmap_bits": 64}, {"n": 2, "percent": 60, "common": 4, "rounds": 1, "fragments": 1}])
def test_against_brute_force(docs_of, settings):
    rows = corpus()
    found = near_duplicate_groups(docs_of(rows), **settings).collect()
    own = {k: v for k, v in settings.items() if k in ("n", "percent")}
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute(rows, **own)


def test_nothing_to_link(docs_of):
    assert near_duplicate_groups(docs_of([])).collect() == []
    found = near_duplicate_groups(docs_of([(4, None), (5, "one two three four five")])).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == [(4, 0, 4), (5, 1, 5)]


def test_components_of_long_chains_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (3, 2), (2, 9), (9, 3), (150, 40)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    own = {r["node"]: r["root"] for r in found}
    assert own == {**{i: 40 for i in range(100, 161)}, 40: 40, 7: 7, 2: 2, 3: 2, 9: 2}


def test_a_pair_that_shares_many_common_grams_is_made_once(spark):
    rows = [(g, c, 60, 0, g, c % 2) for c in range(20) for g in range(12)]
    entries = spark.createDataFrame(rows, "gram long, cls long, n long, rare long, at int, root long")
    made = ngram_join._first_meetings(entries, 80)
    assert made.count() == made.distinct().count() == 100  # of 1,200 meetings


def test_a_pair_is_not_made_where_too_little_follows_its_first_common_gram(spark):
    kind = "gram long, cls long, n long, rare long, at int, root long"
    for place, n in ((6, 1), (7, 0)):  # 60 grams each: 54 of them must be shared
        entries = spark.createDataFrame([(5, 1, 60, 0, 0, 1), (5, 2, 60, 0, place, 2)], kind)
        assert ngram_join._first_meetings(entries, 80).count() == n


def test_a_task_gets_its_texts_in_batches_of_bounded_size(spark, docs_of, monkeypatch):
    monkeypatch.setattr(shared, "BATCH", 1 << 16)
    before = spark.conf.get(shared.BATCH_BYTES, None)
    spark.conf.unset(shared.BATCH_BYTES)
    try:
        near_duplicate_groups(docs_of(["a b c d e f"]))
        texts = spark.range(0, 900, 1, 1).selectExpr("repeat('x', 1000) AS text")
        sizes = texts.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
        assert len(sizes) > 9 and max(r["n"] for r in sizes) < 1 << 17
        spark.conf.set(shared.BATCH_BYTES, "12345")
        near_duplicate_groups(docs_of(["a b c d e f"]))
        assert spark.conf.get(shared.BATCH_BYTES) == "12345"
    finally:
        spark.conf.set(shared.BATCH_BYTES, before) if before else spark.conf.unset(shared.BATCH_BYTES)
