import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from aisleframe.llm.toxicity import Model, SpelledTerms, allowed_errors, toxicity_scores

TERMS = ["grumble", "nasty", "wretched", "vile", "scoundrel"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=10), min_size=1, max_size=6), st.lists(st.text("abcd", max_size=11), max_size=12))
def test_automaton_finds_what_the_distance_says(terms, words):
    automaton = SpelledTerms(set(terms))
    for w in words + [t[:2] + "d" + t[2:] for t in terms] + [t[1:] for t in terms]:
        own = {(t, d) for t in terms if (d := distance(t, w)) <= allowed_errors(t)}
        assert set(automaton.match(w)) == own


def test_quotation_counts_apart():
    model = Model({"grumble": 3.0})
    plain, quoted = model.features("you grumble all day"), model.features('she wrote: "you grumble" all day')
    assert plain[2] == 0.0 < quoted[2] and plain[0] == quoted[0]
    assert model.features("nothing here") is None and model.features("") is None
    assert model.features("you gruhmble")[1] > 0


def table(n=400):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("lmnoprst") for _ in range(rng.randint(2, 7)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 120))]
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                term = rng.choice(TERMS)
                if rng.random() < 0.2 and len(term) > 4:
                    k = rng.randrange(len(term))
                    term = term[:k] + "z" + term[k + 1:]
                words.insert(rng.randrange(len(words)), term)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic if i % 29 else None))
    rows += [(n, None), (n + 1, ""), (None, "a vile and nasty scoundrel"), (0, rows[0][1])]
    return rows, labels + [(None, 1, 1), (99999, 0, 1), (1, 1, 0)]


def test_held_out_accuracy(spark, docs_of):
    rows, labels = table()
    df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = toxicity_scores(docs_of(rows), df).collect()
    assert len(found) == len(rows)
    truth = {i: t for i, _, t in labels if i is not None and t is not None}
    right = held = 0
    for r in found:
        k = r["doc_id"]
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (k is not None and zlib.crc32(str(k).encode()) % 5 == 0)
        if r["held_out"] and k in truth:
            held += 1
            right += r["predicted"] == truth[k]
    assert held > 50 and right / held > 0.95
    assert all(r["predicted"] == 0 for r in found if r["doc_id"] in (400, 401))
    assert [r["predicted"] for r in found if r["doc_id"] is None] == [1]


def test_held_out_labels_are_not_read(spark, docs_of):
    rows, labels = table(200)
    wrong = [(i, q, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    score = lambda y: sorted((str(r["doc_id"]), r["score"]) for r in toxicity_scores(
        docs_of(rows), spark.createDataFrame(y, "doc_id long, quality int, toxic int")).collect())
    assert score(labels) == score(wrong)


def test_no_labels(spark, docs_of):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r["score"], r["predicted"]) for r in toxicity_scores(docs_of(["a b", None]), empty).collect()] == [(0.0, 0)] * 2
    assert toxicity_scores(docs_of([]), empty).collect() == []
