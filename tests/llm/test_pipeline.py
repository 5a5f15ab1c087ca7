import random

import pytest
from pyspark.sql import functions as F
from test_decontamination import brute as leaks
from test_ngram_join import brute as groups
from test_quality import base, clean
from test_substring_dedup import brute as repeats

import corpus_pipeline as P
from aisleframe.llm.encoding import decode
from aisleframe.llm.quality import quality_verdicts
from aisleframe.llm.queries import QUERIES, SQL

COLUMNS = [*P.COLUMNS]


@pytest.fixture(scope="module")
def folder(spark, docs_of, tmp_path_factory):
    rng = random.Random(12)
    words = lambda n: clean(rng, n).split()
    items = [words(30), words(16)]
    passage = words(60)
    texts = [words(rng.randint(60, 200)) for _ in range(150)]
    for i in range(0, 30, 3):
        texts[i] = texts[i][:20] + passage + texts[i][20:]
    for i in range(40, 60, 4):
        texts[i] = texts[i][:10] + items[i % 2] + texts[i][10:]
    for i in range(70, 90):
        texts.append(texts[i][:-1] + ["end"] * (i % 2) if i % 3 else list(texts[i]))
    rows = [(i, " ".join(t), "en", f"s{i % 2}") for i, t in enumerate(texts)]
    rows += [(800 + i, " ".join(w + "###" for w in words(90)), "en", "s0") for i in range(3)]
    rows += [(900, None, "en", "s0"), (901, "", None, None), (902, "too short", "en", "s1"), (903, "a b c " * 60, "en", "s1"), rows[5], (None, " ".join(words(90)), "en", "s1")]
    path = tmp_path_factory.mktemp("tables")
    docs_of(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def rows_of(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS).collect()], key=str)


def test_stages_against_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = {}
    for k, (name, stage) in enumerate(P.STAGES):
        out = f"{tmp_path}/{k}"
        stage(spark, docs, folder).write.parquet(out)
        made[k] = (docs, spark.read.parquet(out))
        docs = made[k][1]
        assert name and (k == 4 or docs.columns == COLUMNS)

    before, after = made[0]
    verdicts = {(r["doc_id"], r["n_words"]): r["kept"] for r in quality_verdicts(before).collect()}
    want = [r for r in rows_of(before) if verdicts[r[0], base(r[1])[0]]]
    assert rows_of(after) == want and len(want) == 172 and all(r[0] is None or r[0] < 800 for r in want)

    before, after = made[1]
    texts = rows_of(before)
    group = {k: root for k, _, root in groups([(r[0], r[1]) for r in texts if r[0] is not None])}
    want = sorted({r for r in texts if r[0] is None or group[r[0]] == r[0]}, key=str)
    assert rows_of(after) == want and len(want) == 151

    before, after = made[2]
    texts = rows_of(before)
    cut = repeats([r[1] for r in texts])
    want = [(r[0], c[2], *r[2:4], len(c[2])) if c[1] else r for r, c in zip(texts, cut, strict=True)]
    assert rows_of(after) == sorted(want, key=str) and sum(c[1] > 0 for c in cut) >= 10

    before, after = made[3]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaking = {k for k, *_ in leaks([(r[0], r[1]) for r in rows_of(before)], items)}
    want = [r for r in rows_of(before) if r[0] not in leaking]
    assert rows_of(after) == want and len(leaking) >= 4

    before, after = made[4]
    assert sorted((str(r["doc_id"]), r["text"]) for r in decode(after).collect()) == sorted((str(r[0]), r[1]) for r in rows_of(before))
    assert after.filter(~F.col("exact")).count() == 0
    assert sorted(map(str, P.run(spark, folder).collect())) == sorted(map(str, after.collect()))


def test_clean_texts_stay(spark, docs_of):
    rng = random.Random(77)
    docs = docs_of([clean(rng, rng.randint(60, 250)) for _ in range(120)]).select(*COLUMNS)
    for _, stage in P.STAGES[:3]:
        assert rows_of(stage(spark, docs, "")) == rows_of(docs)


def test_empty_table(spark, docs_of, folder):
    docs = docs_of([]).select(*COLUMNS)
    for _, stage in P.STAGES:
        assert stage(spark, docs, folder).collect() == []


def test_registered():
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14)) and SQL.keys() <= QUERIES.keys()
    assert len(P.STAGES) == 5


def test_near_duplicates_go_by_row(spark, docs_of):
    rng = random.Random(31)
    a, b, c, d, e, f = (clean(rng, 80) for _ in range(6))
    rows = [(1, a), (5, a + " more"), (5, b), (5, c), (6, d), (6, d), (None, e), (None, e + " more"), (None, f), (None, c), (8, ""), (8, "")]
    found = P.ngram_jaccard_join(spark, docs_of(rows).select(*COLUMNS), "").collect()
    texts = sorted(((r["doc_id"], r["text"]) for r in found), key=str)
    either = (None, e) if (None, e) in texts else (None, e + " more")
    assert texts == sorted([(1, a), (5, b), (5, c), (6, d), either, (None, f), (8, ""), (8, "")], key=str)
