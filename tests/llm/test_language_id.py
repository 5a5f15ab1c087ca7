import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from aisleframe.llm import language_id
from aisleframe.llm.language_id import Calibration, Models, kneser_ney, predict_languages

SYLLABLES = {"aa": ["ba", "na", "ti", "ko", "re"], "bb": ["sch", "ung", "er", "ein", "lich"], "cc": ["ña", "ción", "lle", "re", "ti"]}


def symbols(text, order):
    out = [0] * (order - 1)
    for c in text.lower():
        if unicodedata.category(c)[0] in "LM":
            out.append(ord(c))
        elif out[-1] not in (0, 32):
            out.append(32)
    return out


def counts_of(texts, order):
    """Counts by order: of n-grams for the highest, of different symbols before them for the others."""
    grams = Counter()
    for t in texts:
        s = symbols(t, order)
        grams.update(tuple(s[i - order + 1: i + 1]) for i in range(order - 1, len(s)))
    counts = {order: grams}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    return counts


def probability(counts, gram, unseen):
    k = len(gram)
    if not k:
        return unseen
    own = counts[k]
    once, twice = sum(c == 1 for c in own.values()), sum(c == 2 for c in own.values())
    discount = once / (once + 2 * twice) if once and twice else 0.5
    same = [c for g, c in own.items() if g[:-1] == gram[:-1]]
    lower = probability(counts, gram[1:], unseen)
    if not same:
        return lower
    return max(own[gram] - discount, 0) / sum(same) + discount * len(same) / sum(same) * lower


def texts_of(lang, n, rng, words=40):
    word = lambda: "".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3)))
    return [" ".join(word() for _ in range(rng.randint(3, words))) + rng.choice([".", "! 42", "", "\n\n"]) for _ in range(n)]


def models_of(samples, order):
    rows = []
    for lang, texts in samples.items():
        codes, _, _ = language_id._symbols(texts, order)
        rows += [dict(zip(("lang", "k", "grams", "shares", "contexts", "weights"), (lang, k + 1, *(x.tobytes() for x in t)), strict=True))
                 for k, t in enumerate(kneser_ney(codes, order))]
    return Models(rows)


def test_against_brute_force(monkeypatch):
    rng = random.Random(5)
    order = 4
    samples = {lang: texts_of(lang, 12, rng) for lang in SYLLABLES}
    models = models_of(samples, order)
    counts = {lang: counts_of(t, order) for lang, t in samples.items()}
    unseen = 1 / (len({g for c in counts.values() for g in c[1]}) + 1)
    asked = ["Ba na-TI 9 schein", "xyz ción", "", "!!", "İstanbul é", "re" * 40, "a\0b"]
    for size in (1 << 19, 7):
        monkeypatch.setattr(language_id, "CHUNK", size)
        bits, n, letters = models.bits(asked)
        for i, text in enumerate(asked):
            s = symbols(text, order)
            assert n[i] == len(s) - order + 1 and letters[i] == sum(unicodedata.category(c)[0] == "L" for c in text.lower())
            for j, lang in enumerate(models.langs):
                total = -sum(math.log2(probability(counts[lang], tuple(s[k - order + 1: k + 1]), unseen)) for k in range(order - 1, len(s)))
                assert math.isclose(bits[j, i], total / max(n[i], 1), rel_tol=1e-9)


def test_probabilities_sum_to_one():
    rng = random.Random(6)
    counts = counts_of(texts_of("aa", 10, rng), 3)
    every = [g[0] for g in counts[1]]
    seen = defaultdict(float)
    for context in [(0, 0), (ord("b"), ord("a")), (ord("q"), ord("q")), (ord("a"), 32)]:
        seen[context] = sum(probability(counts, (*context, w), 1 / (len(every) + 1)) for w in [*every, ord("q")])
    assert all(math.isclose(x, 1) for x in seen.values())


def table(spark, rows):
    return spark.createDataFrame([(k, t, x, 1, 2) for k, t, x in rows], "doc_id long, text string, lang string, key int, n int").repartition(4)


def test_held_out_accuracy_and_rejection(spark):
    rng = random.Random(7)
    rows = [(t, lang) for lang in SYLLABLES for t in texts_of(lang, 120, rng)]
    rng.shuffle(rows)
    rows = [(i, *r) for i, r in enumerate(rows)]
    odd = [(900, None, "aa"), (901, "", None), (902, "12 .. 34", "bb"), (903, "жшщ " * 60, None), (904, "ba na ti " * 200_000, None),
           (None, "baba nana", "zz"), (905, rows[0][1], rows[1][2])]
    # a copy with another label once, and a hot text many times
    hot = [(1000 + i, "ung ein er", "bb") for i in range(200)]
    held_out = F.col("doc_id") % 4 == 2
    found = {r["doc_id"]: r for r in predict_languages(table(spark, rows + odd + hot), held_out, order=4).collect()}
    assert len(found) == len(rows + odd + hot)
    right = [found[k]["lang_pred"] == lang for k, _, lang in rows if k % 4 == 2]
    assert sum(right) >= 0.98 * len(right) and all(found[k]["held_out"] == (k % 4 == 2) for k, _, _ in rows)
    assert [found[k]["lang_pred"] for k in (900, 901, 902)] == ["und"] * 3 and found[900]["score"] == 0 and found[900]["bits_per_char"] is None
    assert found[903]["rejected"] and found[903]["score"] < 0.5
    assert found[904]["lang_pred"] == "aa" and not found[904]["rejected"] and found[904]["score"] > 0.9
    assert not found[None]["held_out"] and found[None]["lang_pred"] in SYLLABLES  # zz is not learned from a row without an id
    accepted = [not found[k]["rejected"] for k, _, lang in rows if found[k]["lang_pred"] == lang]
    assert sum(accepted) >= 0.95 * len(accepted)


def test_the_labels_of_held_out_rows_are_not_looked_at(spark):
    rng = random.Random(8)
    rows = [(i, t, lang) for i, (t, lang) in enumerate((t, lang) for lang in SYLLABLES for t in texts_of(lang, 30, rng))]
    other = [(k, t, "cc" if k % 4 == 2 else lang) for k, t, lang in rows]
    held_out = F.col("doc_id") % 4 == 2
    one, two = (sorted(map(str, predict_languages(table(spark, r), held_out).collect())) for r in (rows, other))
    assert one == two


def test_sample_is_bounded(spark):
    rows = [(i, f"t{i} " * (500 if i % 10 == 0 else 5), "aa") for i in range(400)]
    got = language_id._sample(table(spark, rows + rows), 20, 400).collect()
    assert 1 <= len(got) <= 20 and sum(len(r["text"]) for r in got[:-1]) < 400 + 2000
    long_only = language_id._sample(table(spark, [(1, "x" * 5000, "aa"), (2, "y" * 5000, "aa")]), 20, 400).collect()
    assert len(long_only) == 1


def test_one_language_and_none(spark):
    held_out = F.col("doc_id") == 2
    found = predict_languages(table(spark, [(1, "ba na", "aa"), (2, "ti", None)]), held_out).collect()
    assert {r["lang_pred"] for r in found} == {"aa"} and all(0 <= r["score"] <= 1 for r in found)
    found = predict_languages(table(spark, [(1, "ba na", None), (2, "ti", "aa")]), held_out).collect()
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in found] == [("und", 0.0, True)] * 2
    assert predict_languages(table(spark, []), held_out).collect() == []


def test_calibration_is_a_chance():
    rng = np.random.default_rng(9)
    lang = rng.integers(0, 3, 3000)
    bits = rng.normal(3, 0.5, (3, 3000))
    bits[lang, np.arange(3000)] -= 0.8
    n = rng.integers(5, 200, 3000)
    c = Calibration(lang[:2000], bits[:, :2000], n[:2000])
    chance, right = c.chance(bits[:, 2000:], n[2000:]), bits[:, 2000:].argmin(axis=0) == lang[2000:]
    assert np.all((chance >= 0) & (chance <= 1)) and chance[right].mean() > chance[~right].mean()
