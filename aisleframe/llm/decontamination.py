"""Benchmark items in training texts by spaced-seed hashing, with DataFrame functions only.

A leak is an aligned window of WINDOW words of which at most MISSES differ. Fixed masks pick positions of a span; the words
at these positions, hashed, are a seed. Items give seeds from every position, texts from every second one: for each way to
place up to MISSES differing words in a window, and for either parity, some mask at some offset misses all of them (a
test runs through all cases), so every leak shares a seed. Seeds meet in a join; each hit names a diagonal, on which the
words of text and item are compared one by one.

Items shorter than a window are windows of their own. With short_items they may differ in as many words in proportion, and
give one seed more than that, from pieces that share no word: one of them is unchanged in every leak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisleframe.llm.shared import stash

WINDOW = 13
MISSES = 2
STEP = 2
MASKS = ((0, 3, 4, 7, 8), (0, 1, 3, 4, 5), (0, 1, 6, 7, 8))
LEAST_WORDS = 5
# Scripts written without spaces: Thai, Lao, Myanmar, Khmer, kana and Han. The first range lets other letters pass quickly.
UNSPACED = (
    r"(?=[\u0e00-\x{3ffff}])[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3040-\u30ff\u31f0-\u31ff"
    r"\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\x{20000}-\x{3ffff}]")
BROADCAST_SEEDS = 1_000_000  # item seeds that are sent to all tasks; more are joined by shuffling


def word_hashes(text: Column, characters: bool = False) -> Column:
    """Hashes of the text's words: runs of letters and digits, lower-cased; of scripts without spaces each character, if asked for."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    words = F.split(F.regexp_replace(lower, UNSPACED, " $0 ") if characters else lower, r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seed(mask: int, i: Column) -> Column:
    """The seed of a mask at position i of the column h; shorter ends give a hash of fewer words, which no item has."""
    return F.xxhash64(F.lit(mask), *[F.get(F.col("h"), i + k) for k in MASKS[mask]])


def _positions(step: int, last: Column) -> Column:
    return F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))


def _item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item, at) of the items that fill a window."""
    long = items.filter(F.col("n") >= WINDOW)

    def of_mask(m: int) -> Column:
        return F.transform(
            _positions(1, F.col("n") - 1 - MASKS[m][-1]), lambda i: F.struct(_seed(m, i).alias("seed"), i.alias("at")))

    return long.select("item", F.explode(F.flatten(F.array(*map(of_mask, range(len(MASKS)))))).alias("s")).select("s.seed", "item", "s.at")


def _text_seeds(rows: DataFrame) -> DataFrame:
    """(row_key, seed, at) of every STEP-th position of each text."""
    seeds = F.flatten(F.transform(
        _positions(STEP, F.size("h") - 1), lambda i: F.array(*[_seed(m, i) for m in range(len(MASKS))])))
    at = (F.floor(F.col("k") / len(MASKS)) * STEP).cast("int")
    return rows.select("row_key", F.posexplode(seeds).alias("k", "seed")).select("row_key", "seed", at.alias("at"))


def _spans(n: int) -> Column:
    """Hashes of all n consecutive words."""
    return F.transform(_positions(1, F.size("h") - n), lambda i: F.xxhash64(F.slice("h", i + 1, n)))


def _joined(texts: DataFrame, items: DataFrame, on: str) -> DataFrame:
    """Hits of text seeds on item seeds; the item side goes to all tasks only where it is counted to be small."""
    few = items.count() <= BROADCAST_SEEDS
    return texts.join(F.broadcast(items) if few else items, on)


def _pieces(items: DataFrame) -> DataFrame:
    """(item, at, size, seed) of the items: misses + 1 pieces of words, as long as each other but for a word."""
    pieces = F.col("misses") + 1
    cut = lambda k: F.floor(F.col("n") * k / pieces).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.col("misses")), lambda k: F.struct(cut(k).alias("at"), (cut(k + 1) - cut(k)).alias("size")))
    return items.select("item", "h", F.explode(parts).alias("p")).select(
        "item", "p.at", "p.size", F.xxhash64(F.slice("h", F.col("p.at") + 1, F.col("p.size"))).alias("seed"))


def _diagonals(rows: DataFrame, items: DataFrame) -> DataFrame:
    """(row_key, item, diagonal) of all seed hits; the diagonal is the text position that meets the item's first word."""
    hits = _joined(_text_seeds(rows), stash(_item_seeds(items)).withColumnRenamed("at", "item_at"), "seed").select(
        "row_key", "item", (F.col("at") - F.col("item_at")).alias("diagonal"))
    short = stash(_pieces(items.filter(F.col("n") < WINDOW)))
    sizes = [r["size"] for r in short.select("size").distinct().collect()]  # fewer than WINDOW values
    for n in sorted(sizes):
        found = rows.select("row_key", F.posexplode(_spans(n)).alias("pos", "seed"))
        hits = hits.unionByName(_joined(found, short.filter(F.col("size") == n).drop("size"), "seed").select(
            "row_key", "item", (F.col("pos") - F.col("at")).alias("diagonal")))
    return hits.distinct()


def _overlap(pairs: DataFrame) -> DataFrame:
    """Adds `overlap`: words of the item inside matching windows on the diagonal. A window is WINDOW words, or a shorter item."""
    first = F.greatest(F.lit(0), -F.col("diagonal"))
    last = F.least(F.col("n"), F.size("h") - F.col("diagonal")) - F.col("width")
    same = F.transform(F.col("item_h"), lambda w, j: F.when(F.get(F.col("h"), j + F.col("diagonal")) == w, 1).otherwise(0))
    equal = lambda s: F.aggregate(F.slice("same", s + 1, F.col("width")), F.lit(0), lambda n, x: n + x)
    starts = F.when(last >= first, F.filter(F.sequence(first, last), lambda s: equal(s) >= F.col("width") - F.col("misses")))
    inside = F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + F.col("width") - 1))))
    return pairs.withColumn("same", same).withColumn("overlap", F.coalesce(F.size(inside), F.lit(0)))


def leaks(docs: DataFrame, benchmark: DataFrame, keep: str = "doc_id", short_items: bool = False) -> DataFrame:
    """`keep`, item_id, item_words and overlap_words of each pair of a row of docs (text) and an item (item_id, text) it leaks.

    overlap_words counts the item's words inside matching windows, on the diagonal that has most. An item shorter than a
    window leaks where it stands whole and unchanged; items with fewer than LEAST_WORDS words are not searched. With short_items
    an item of n < WINDOW words, however few, may differ in n * MISSES / WINDOW of them, rounded down, and in scripts without
    spaces each character counts as a word. Null and empty texts leak nothing; an id that stands on several rows, in either table, gives one row per pair with the largest overlap. Without
    items or texts there are no rows. Other columns of both tables are not looked at.
    """
    rows = docs.select(F.col(keep).alias("id"), "text", F.xxhash64(keep, "text").alias("row_key"))
    words = word_hashes(F.col("text"), short_items)
    fewer = F.floor(F.col("n") * MISSES / WINDOW).cast("int") if short_items else F.lit(0)
    misses = F.when(F.col("n") < WINDOW, fewer).otherwise(MISSES)
    items = stash(
        benchmark.select("item_id", words.alias("h")).withColumn("n", F.size("h"))
        .filter(F.col("n") >= (1 if short_items else LEAST_WORDS)).withColumn("misses", misses)
        .withColumn("item", F.xxhash64("item_id", "h")).dropDuplicates(["item"]))
    hashed = rows.select("row_key", words.alias("h"))
    diagonals = stash(_diagonals(hashed, items))
    keys = stash(diagonals.select("row_key").distinct())
    texts = rows.join(keys, "row_key", "left_semi").dropDuplicates(["row_key"]).select("id", "row_key", words.alias("h"))
    pairs = diagonals.join(items.select("item", "item_id", "n", "misses", F.col("h").alias("item_h")), "item").join(texts, "row_key")
    pairs = pairs.withColumn("width", F.least("n", F.lit(WINDOW)))
    return _overlap(pairs).filter("overlap > 0").groupBy(F.col("id").alias(keep), "item_id").agg(
        F.max(F.col("n").cast("long")).alias("item_words"), F.max(F.col("overlap").cast("long")).alias("overlap_words"))
