"""The best documents for each of a set of items by weighted terms, each bag of terms scored once.

1. Documents are reduced to the terms that items have: a bag of (term, occurrences), and the number of all their terms.
2. Documents whose bag and length part m are the same score the same for every item. They are one class: rows meet by a
   hash and are told apart by the whole bag and m. Exact copies, and texts that differ only in words no item has, so cost one score.
3. Classes are scored against all items of a block, in whole numbers. Each task keeps the best classes of each item: as a class
   has a member at least, the first `top` classes by score and smallest id hold the first `top` documents.
4. Only these classes are expanded into their members, by ascending id.

Items are worked off in blocks with a bounded number of terms, one pass over the documents for each block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aisleframe.llm.hashing import CHUNK, as_bytes
from aisleframe.llm.shared import stash

TOP = 50
BLOCK_TERMS = 1 << 20
CELLS = 1 << 22
SALTS = 32
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BAG = np.dtype([("term", "<u4"), ("tf", "<u4")])


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, A-Z lower-cased, in lists of about half a megabyte of text."""
    at = 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and (text[end] >= 0x80 or chr(text[end]).isalnum()):
            end += 1
        yield _TERM.findall(text[at:end].lower())
        at = end


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, terms = [], []
        for i, text in enumerate(as_bytes(batch.column("text"))):
            found = {t for part in _terms(text) for t in part}
            ids += [i] * len(found)
            terms += found
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id").take(pa.array(ids, pa.int64())), pa.array(terms, pa.binary())], names=["item_id", "term"])


def _bags(vocabulary: dict[bytes, int]):
    """(doc_id, n, bag) of each text with terms; the bag holds the terms of the vocabulary by ascending number."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, bags = [], [], []
            for i, text in enumerate(as_bytes(batch.column("text"))):
                n, counts = 0, Counter()
                for part in _terms(text):
                    n += len(part)
                    counts.update(part)
                if n:
                    known = sorted((vocabulary[t], k) for t, k in counts.items() if t in vocabulary)
                    rows.append(i)
                    sizes.append(n)
                    bags.append(np.array(known, _BAG).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())],
                names=["doc_id", "n", "bag"])
    return run


def _frequencies(n_terms: int):
    """(term, df): documents of the classes that hold a term, added up per task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            members = np.asarray(batch.column("members"))
            bags = [np.frombuffer(b, _BAG) for b in as_bytes(batch.column("bag"))]
            if bags:
                np.add.at(df, np.concatenate(bags)["term"], np.repeat(members, [len(b) for b in bags]))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])
    return run


class _Items:
    """The items of a block by term: for term t, `of[starts[t]:starts[t + 1]]` are the numbers of the items that have it."""

    def __init__(self, term: np.ndarray, item: np.ndarray, n_terms: int, n_items: int):
        self.n = n_items
        self.of = item[np.argsort(term, kind="stable")]
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=n_terms))))

    def scores(self, bags: list[np.ndarray], m: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """scores[c, i] of class c for item i."""
        flat = np.concatenate(bags)
        row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        tf = flat["tf"].astype(np.int64)
        value = weight[flat["term"]] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row]))
        first = self.starts[flat["term"]]
        many = self.starts[flat["term"] + 1] - first
        ends = np.cumsum(many)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many - first, many)
        out = np.zeros(len(bags) * self.n, np.int64)
        np.add.at(out, np.repeat(row, many) * self.n + self.of[at], np.repeat(value, many))
        return out.reshape(len(bags), self.n)

    def pieces(self, bags: list[np.ndarray]) -> Iterator[slice]:
        """Runs of classes of which neither scores nor single additions pass CELLS; a class alone where it does by itself."""
        cost = np.array([max(self.n, int((self.starts[b["term"] + 1] - self.starts[b["term"]]).sum())) for b in bags])
        at = 0
        while at < len(bags):
            end = max(at + 1, at + int(np.searchsorted(np.cumsum(cost[at:]), CELLS, "right")))
            yield slice(at, end)
            at = end


def _best(item: np.ndarray, score: np.ndarray, null: np.ndarray, first: np.ndarray, top: int) -> np.ndarray:
    """Places of each item's first `top` entries by score falling, then smallest id, null last."""
    order = np.lexsort((first, null, -score, item))
    sorted_items = item[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items, "left")
    return order[rank < top]


def _scored(items: _Items, weight: np.ndarray, top: int):
    """(item, class, first_id, score): the best classes of each item, of those of one task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64, np.int64)]  # item, score, null, first, class
        least = np.ones(items.n, np.int64)
        for batch in batches:
            bags = [np.frombuffer(b, _BAG) for b in as_bytes(batch.column("bag"))]
            null = np.asarray(batch.column("first_id").is_null())
            first = np.asarray(batch.column("first_id").fill_null(0))
            m, key = np.asarray(batch.column("m")), np.asarray(batch.column("class"))
            for piece in items.pieces(bags):
                scores = items.scores(bags[piece], m[piece], weight)
                row, item = np.nonzero(scores >= least)
                new = (item, scores[row, item], null[piece][row], first[piece][row], key[piece][row])
                kept = [np.concatenate(x) for x in zip(kept, new, strict=True)]
                if len(kept[0]) > max(CELLS // 8, 4 * items.n * top):
                    kept = [x[_best(*kept[:4], top)] for x in kept]
                    full = np.flatnonzero(np.bincount(kept[0], minlength=items.n) >= top)
                    worst = np.full(items.n, np.iinfo(np.int64).max)
                    np.minimum.at(worst, kept[0], kept[1])
                    least[full] = worst[full]
        kept = [x[_best(*kept[:4], top)] for x in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept[0]), pa.array(kept[4]), pa.array(kept[3], mask=kept[2]), pa.array(kept[1])],
            names=["item", "class", "first_id", "score"])
    return run


def _first_per(df: DataFrame, keys: list[str], order: list, top: int) -> DataFrame:
    """The first `top` rows of each key, found among parts of it before."""
    salted = df.withColumn("salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    ranked = lambda d, by: d.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= top)
    return ranked(ranked(salted, [*keys, "salt"]).drop("rank", "salt"), keys)


def _block(spark: SparkSession, docs: DataFrame, terms: DataFrame, kind: str, top: int) -> DataFrame:
    pairs = terms.toArrow()  # a block has a bounded number of rows
    if not pairs.num_rows:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    ids = pairs.column("item_id").combine_chunks().dictionary_encode("encode")
    words = pairs.column("term").combine_chunks().dictionary_encode()
    vocabulary = {bytes(t): i for i, t in enumerate(words.dictionary.to_pylist())}
    n_items, n_terms = len(ids.dictionary), len(vocabulary)
    items = _Items(np.asarray(words.indices).astype(np.int64), np.asarray(ids.indices).astype(np.int64), n_terms, n_items)

    bags = stash(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_bags(vocabulary), "doc_id long, n long, bag binary"))
    count = bags.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    n_docs, length = count["n"], count["l"] or 1
    m = F.expr(f"50 + cast((cast(50 as decimal(38, 0)) * n * {n_docs}BD) div {length}BD as bigint)")
    members = bags.filter("length(bag) > 0").select("doc_id", "bag", m.alias("m")).withColumn("class", F.xxhash64("bag", "m"))
    classes = stash(members.groupBy("class", "bag", "m").agg(F.count("*").alias("members"), F.min("doc_id").alias("first_id")))

    df = np.zeros(n_terms, np.int64)
    counted = classes.select("bag", "members").mapInArrow(_frequencies(n_terms), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in counted.collect():  # at most one row for each term of the block
        df[r["term"]] = r["df"]
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)

    best = classes.select("class", "bag", "m", "first_id").mapInArrow(
        _scored(items, weight, top), "item long, class long, first_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("first_id")]
    best = stash(_first_per(stash(best), ["item"], order, top).select("item", "class", "first_id", "score"))
    # a class is named by its hash and smallest member; members are verified by the whole bag and m
    named = best.select("class", F.col("first_id").alias("smallest")).distinct()
    shown = stash(classes.join(named, "class").filter(F.col("first_id").eqNullSafe(F.col("smallest"))).select("class", "bag", "m", "smallest"))
    near = members.join(stash(shown.select("class").distinct()), "class", "left_semi")
    inside = near.join(shown, ["class", "bag", "m"]).select("class", "smallest", "doc_id")
    inside = stash(_first_per(inside, ["class", "smallest"], [F.asc_nulls_last("doc_id")], top).drop("rank"))
    of_item = best.join(inside, "class").filter(F.col("first_id").eqNullSafe(F.col("smallest"))).select("item", "doc_id", "score")
    ranked = _first_per(of_item, ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], top)
    named_items = spark.createDataFrame([(i, v) for i, v in enumerate(ids.dictionary.to_pylist())], f"item long, item_id {kind}")
    return ranked.join(named_items, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents of docs (doc_id, text) for each item of items (item_id, text).

    Terms are runs of digits, letters and all beyond ASCII, A-Z lower-cased. A term in df of N documents with terms weighs
    w = floor(1000 * ln((2 N + 2) / (2 df + 1))); a document of n terms has m = 50 + 50 n N div L, with L the terms of all; its score adds up
    w * ((10^9 tf) div (1000 tf + 20 m)) over the item's different terms. Documents without a score above 0 are not listed, equal
    scores go by ascending doc_id. A null or empty text has no terms; a document row is a document also where its id repeats, and a null
    doc_id comes last among equals; item rows of one id (null too) are one item. Empty tables give no rows. Other columns are not
    looked at.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    terms = stash(items.select("item_id", "text").mapInArrow(_item_terms, f"item_id {kind}, term binary").distinct())
    blocks = -(-terms.count() // block_terms)
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks or 1))
    found = [stash(_block(spark, docs, terms.filter(block == b), kind, top)) for b in range(blocks)]
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
