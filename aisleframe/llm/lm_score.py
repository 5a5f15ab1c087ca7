"""Probability of texts under a word model whose rare words are backed by a subword lattice.

A token is a word or the end of a text. P(token) = (c - D) / N for a token seen c times among N training tokens, plus the
mass that the discount D frees times the lattice probability of the marked word: the sum over all its segmentations
into pieces of an existing vocabulary, by forward recursion in log space. In lattice terms a training word is one
more arc, from the word's start to its end. The vocabulary's own scores weight the segmentations first; one step of
expectation over all distinct training words fits them to the corpus.

Nothing that grows with the corpus passes the driver: word counts are one grouped table, the most frequent HEAD words
(a fixed number) go to the tasks, and all other words of a text meet their scores in a join on the word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisleframe.llm.hashing import chunked
from aisleframe.llm.pieces import MARK, VOCABULARY, Lattice, Pieces, load
from aisleframe.llm.shared import stash

DISCOUNT = 0.75
HEAD = 1 << 16
EXACT = 1 << 12
FLUSH = 400_000
LOG10 = math.log(10)


def held_out(doc_id: str = "doc_id", of: int = 7, remainder: int = 2) -> Column:
    """crc32 of the id as text, modulo `of`, equals `remainder`; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % of == remainder, F.lit(False))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their number in training and in all texts, added up per task and given out when the table is full."""
    train: Counter = Counter()
    other: Counter = Counter()

    def out() -> pa.RecordBatch:
        words = list(train.keys() | other.keys())
        done = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()).cast(pa.string()), pa.array([train[w] for w in words], pa.int64())],
            names=["word", "n"])
        train.clear()
        other.clear()
        return done

    for part, texts in chunked(batches):
        for text, held in zip(texts, part.column("held_out").to_pylist(), strict=True):
            (other if held else train).update(text.lower().split())
        if len(train) + len(other) > FLUSH:
            yield out()
    yield out()


def _expect(pieces: Pieces):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, sums = Lattice(pieces), {}
        for batch in batches:
            for word in sorted(batch.column("word").to_pylist()):
                lattice.expect(MARK + word, sums)
        ids = {None: -1, **{p: i for p, (i, _) in pieces.words.items()}}
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[p] for p in sums], pa.int32()), pa.array(list(sums.values()), pa.float64())], names=["piece", "expected"])
    return run


def _fitted(pieces: Pieces, words: DataFrame) -> Pieces:
    """The pieces with log-probabilities in proportion to their expected numbers, each raised by a tenth."""
    sums = words.select("word").mapInArrow(_expect(pieces), "piece int, expected double").groupBy("piece").agg(F.sum("expected").alias("e"))
    found = {r["piece"]: r["e"] for r in sums.collect()}  # at most one row per piece of the vocabulary
    total = math.log(sum(found.values()) + 0.1 * (len(pieces.words) + 256))
    each = {i: math.log(found.get(i, 0.0) + 0.1) - total for i, _ in pieces.words.values()}
    return pieces.with_scores(each, math.log((found.get(-1, 0.0) + 25.6) / 256) - total)


def _lattice(pieces: Pieces):
    """(word, n, lattice): natural log of the marked word's probability."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch.column("word")))
            scores = [lattice.total(MARK + w) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(scores, pa.float64())], names=["word", "n", "lattice"])
    return run


def _by_head(head):
    """For each text one row of sums over its frequent words (word is null) and a row for each of its other words."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, none = head.value, (None, None, None)
        for part, texts in chunked(batches):
            keys, words, numbers, sums = [], [], [], []
            for i, (key, text) in enumerate(zip(part.column("row").to_pylist(), texts, strict=True)):
                base = model = 0.0
                known = 0
                split = text.lower().split()
                for word, k in Counter(split).items():
                    b, m, seen = frequent.get(word, none)
                    if b is None:
                        keys.append(key)
                        words.append(word)
                        numbers.append(k)
                    else:
                        base += k * b
                        model += k * m
                        known += k * seen
                sums.append((base, model, known, len(split)))
            n, rest = part.num_rows, len(keys)
            columns = [part.column("row").to_pylist(), part.column("doc_id").to_pylist(), part.column("held_out").to_pylist()]
            columns += [list(c) for c in zip(*sums, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys + columns[0], pa.int64())]
                + [pa.array(words + [None] * n, pa.binary()).cast(pa.string()), pa.array(numbers + [None] * n, pa.int32())]
                + [pa.array([None] * rest + x, kind) for x, kind in zip(
                    columns[1:], (part.schema.field("doc_id").type, pa.bool_(), pa.float64(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                names=["row", "word", "k", "doc_id", "held_out", "base", "model", "known", "tokens"])
    return run


def _least_count(words: DataFrame, head: int) -> int:
    """The smallest count that at most `head` words reach. Counts from EXACT on are looked at in steps of 1/256 of a doubling, so
    the histogram has a fixed number of rows, and a word table of any size sends no more than that to the driver."""
    fine = F.floor(F.log2(F.col("n").cast("double") / EXACT) * 256).cast("int") + EXACT
    steps = words.select(F.when(F.col("n") < EXACT, F.col("n").cast("int")).otherwise(fine).alias("step"), "n")
    room, least = head, None
    for row in steps.groupBy("step").agg(F.count("*").alias("k"), F.min("n").alias("n")).orderBy(F.desc("step")).collect():
        room -= row["k"]
        if room < 0:
            break
        least = row["n"]
    return (1 << 62) if least is None else least


def score_texts(
    docs: DataFrame, held: Column | None = None, vocabulary: str = VOCABULARY, discount: float = DISCOUNT, head: int = HEAD,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of docs (doc_id, text).

    Tokens are the text's words, A-Z lower-cased, and one end. Counts come from all rows that are not held out (default: crc32 of
    the id modulo 7 is not 2). base_score adds log10((c + 1) / (N + V + 1)) over the tokens, score the log10 probability under
    the model above. Null and empty texts are one end token. Rows that repeat count and are scored as rows of their own.
    With no training rows every token is unknown: N and V are 0, the base gives 0 for each token, and the lattice alone
    scores words. Other columns of docs are not looked at.
    """
    held = held_out() if held is None else held
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held.alias("held_out"), "text")
    counts = stash(
        rows.select("held_out", "text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    seen = counts.agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
    ends = rows.filter(~F.col("held_out")).count()
    total, distinct = (seen["n"] or 0) + ends, (seen["v"] or 0) + (ends > 0)
    pieces = _fitted(load(vocabulary), counts.filter("n > 0"))

    free = math.log(discount * distinct / total) if total else 0.0
    c = F.col("n").cast("double")
    backed = F.exp(F.col("lattice") + free)
    own = F.when(c > 0, (c - discount) / max(total, 1)).otherwise(0.0)
    model = F.when(c > 0, F.log10(own + backed)).otherwise((F.col("lattice") + free) / LOG10)
    words = stash(counts.mapInArrow(_lattice(pieces), "word string, n long, lattice double").select(
        "word", "n", F.log10((c + 1) / float(total + distinct + 1)).alias("b"), model.alias("m")))
    top = words.filter(F.col("n") >= _least_count(words, head)).collect()  # at most `head` rows
    frequent = spark.sparkContext.broadcast({r["word"].encode(): (r["b"], r["m"], r["n"] > 0) for r in top})
    end_base = math.log10((ends + 1) / (total + distinct + 1))
    # a text's end is no marked word: its lattice probability is 0, unless nothing was seen at all
    end_model = math.log10((ends - discount) / total) if ends else 0.0

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = stash(rows.mapInArrow(
        _by_head(frequent),
        f"row long, word string, k int, doc_id {kind}, held_out boolean, base double, model double, known long, tokens long"))
    texts = parts.filter("word is null").drop("word", "k")
    rest = parts.filter("word is not null").select("row", "word", "k").join(words, "word").groupBy("row").agg(
        F.sum(F.col("k") * F.col("b")).alias("more_base"), F.sum(F.col("k") * F.col("m")).alias("more_model"),
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("more_known"))
    zero = lambda name: F.coalesce(name, F.lit(0))
    return texts.join(rest, "row", "left").select(
        "doc_id", "held_out", (F.col("tokens") + 1).alias("n_tokens"),
        (F.col("known") + zero("more_known") + int(ends > 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base") + end_base).alias("base_score"),
        (F.col("model") + zero("more_model") + end_model).alias("score"))
