"""Exact Jaccard self-join of word n-gram sets by vertical partitioning, and the groups its links form.

The global n-gram order is (common or not, hash). A set of n grams that is to reach the threshold t with another shares one
of its first n - ceil(t * n) + 1 grams with it, so only these prefixes are matched. Grams that stand in many prefixes
are common and go last, by a bitmap of fixed size; whatever the bitmap holds, the order is the same for all sets and the
result exact. Equal sets are one class from the start.

The order is cut into fragments. A candidate pair's overlap is counted in each fragment by itself, on the pieces that the two
sets have there, and the partial counts are summed per pair. Candidates are of two kinds:

* Pairs that share a rare gram of their prefixes meet by it; their number is bounded as no rare gram is frequent. What
  they share of the rare part is counted in that join, and the common part adds no more than the smaller of their two.
* Other pairs share only common grams, so their overlap is at most the smaller number of common grams. First each class
  meets the pivots of a few of its common grams: the class with the largest common part, which is the middle of a group of near
  copies, at the grams that most classes share. Classes that linked are one group; at the end the pairs of different groups that still share a common gram
  and whose common parts are large enough are counted. Such a pair is made where it first meets, if what both have from there on
  can reach the threshold, and not again at each further gram. Groups of near copies are so never expanded into all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aisleframe.llm.components import components
from aisleframe.llm.hashing import Texts, chunked, mix, signed, windows
from aisleframe.llm.shared import bound_batches, stash

N = 5
PERCENT = 80
COMMON = 24
BITMAP_BITS = 1 << 23
FRAGMENTS = 4
ROUNDS = 3
#: Grams of each class at which it meets a pivot in a round. A round only finds groups early; the pairs it leaves out meet at the end.
MEETINGS = 4
#: Grams before each one of a class by which most later meetings of a pair are known; a pair that meets again farther on is only made again.
BEFORE = 16
PASSES = 4
LARGELY = 4


def _sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """The sorted set of n-gram hashes of each text; the whole sequence as one gram where it is shorter than n words."""
    found = Texts(texts, lower=True)
    grams = windows(found.hash, n)
    ends = np.cumsum(found.counts)
    for count, end in zip(found.counts.tolist(), ends.tolist(), strict=True):
        if count >= n:
            yield np.unique(grams[end - count: end - n + 1])
        else:
            yield windows(found.hash[end - count: end], count) if count else np.empty(0, np.uint64)


def _is_common(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bit = h & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1


def _prefix(grams: np.ndarray, percent: int, bits: np.ndarray | None) -> tuple[np.ndarray, int]:
    """The prefix of a set in the global order, and how many rare grams it begins with."""
    p = _prefix_length(len(grams), percent) if len(grams) else 0
    if bits is None or not _is_common(grams[:p], bits).any():
        return grams[:p], p
    last = _is_common(grams, bits)
    rare = grams[~last][:p]
    return np.concatenate([rare, grams[last]])[:p], len(rare)


def _rare_grams(n: int, percent: int, bitmap: bytes | None):
    """The rare grams of all prefixes; with a bitmap, of the prefixes that it changes, and of all of a set that is largely common."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        for _, texts in chunked(batches):
            found = []
            for grams in _sets(texts, n):
                prefix, rare = _prefix(grams, percent, bits)
                first = grams[: len(prefix)]
                if bits is None:
                    found.append(first)
                elif (known := _is_common(first, bits)).sum() * LARGELY >= max(len(first), 1):
                    found.append(grams[~_is_common(grams, bits)])
                elif known.any():
                    found.append(prefix[:rare])
            flat = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(signed(flat))], names=["gram"])
    return run


def _base(n: int, percent: int, bitmap: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)
        for part, texts in chunked(batches):
            sizes, one, two, prefixes, rares = [], [], [], [], []
            for grams in _sets(texts, n):
                prefix, rare = _prefix(grams, percent, bits)
                sizes.append(len(grams))
                one.append(int(np.sum(mix(grams))))
                two.append(int(np.sum(mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)))))
                prefixes.append(signed(prefix))
                rares.append(rare)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row_key"), pa.array(sizes, pa.int64()),
                 pa.array(signed(np.array(one, np.uint64))), pa.array(signed(np.array(two, np.uint64))),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(rares, pa.int64())],
                names=["doc_id", "row_key", "n", "one", "two", "prefix", "rare"])
    return run


def _pieces(n: int, bitmap: bytes, fragments: int, wanted: bytes | None):
    """(row_key, fragment, grams): each set cut along the global order; of the rows that the bitmap of wanted keys lets pass."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)
        for part, texts in chunked(batches):
            keys = np.asarray(part.column("row_key"))
            if wanted is not None:
                pass_ = _is_common(keys.astype(np.int64).view(np.uint64), np.frombuffer(wanted, np.uint8))
                keys, texts = keys[pass_], [t for t, x in zip(texts, pass_.tolist(), strict=True) if x]
                if not texts:
                    continue
            rows, at, pieces = [], [], []
            for key, grams in zip(keys.tolist(), _sets(texts, n), strict=True):
                where = ((grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64) + fragments * _is_common(grams, bits)
                for f in np.unique(where).tolist():
                    rows.append(key)
                    at.append(f)
                    pieces.append(signed(grams[where == f]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(at, pa.int32()), pa.array(pieces, pa.list_(pa.int64()))],
                names=["row_key", "fragment", "grams"])
    return run


def _bits_of(keys: DataFrame, bits: int) -> bytes:
    """A column of 64-bit keys as a bitmap of fixed size, with the bit of the lowest digits of each."""
    out = np.zeros(bits // 8, np.uint8)
    key = keys.columns[0]
    rows = keys.groupBy(F.expr(f"shiftright({key} & {bits - 1}L, 3)").alias("byte")).agg(
        F.bit_or(F.expr(f"shiftleft(1, cast({key} & 7L as int))")).alias("bits")).collect()
    for r in rows:  # at most one row for each byte of the bitmap
        out[r["byte"]] = r["bits"]
    return out.tobytes()


def _bitmap(frequent: DataFrame, common: int, bits: int) -> bytes:
    """Frequent grams (gram, n) as a bitmap; where they are too many for its size, the most frequent."""
    tiers = {r["tier"]: r["size"] for r in frequent.groupBy(F.floor(F.log2("n")).cast("int").alias("tier"))
             .agg(F.count("*").alias("size")).collect()}  # at most 63 rows
    room, least = bits // 8, common
    for tier in sorted(tiers, reverse=True):
        room -= tiers[tier]
        if room < 0:
            least = 1 << (tier + 1)
            break
    return _bits_of(frequent.filter(F.col("n") >= least).select("gram"), bits)


def _common_grams(rows: DataFrame, n: int, percent: int, common: int, bits: int) -> bytes:
    """The bitmap of common grams: those of many prefixes, then those of many prefixes as they are without the first."""
    bitmap = None
    for _ in range(PASSES):
        grams = rows.select("row_key", "text").mapInArrow(_rare_grams(n, percent, bitmap), "gram long")
        frequent = stash(grams.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") >= common))
        more = _bitmap(frequent, common, bits)
        if bitmap is not None:
            more = (np.frombuffer(bitmap, np.uint8) | np.frombuffer(more, np.uint8)).tobytes()
        if more == bitmap:
            break
        bitmap = more
    return bitmap


def _overlaps(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
    """(a, b, overlap): partial counts of each fragment, summed per pair."""
    left = pieces.select(F.col("row_key").alias("a"), "fragment", F.col("grams").alias("of_a"))
    right = pieces.select(F.col("row_key").alias("b"), "fragment", F.col("grams").alias("of_b"))
    partial = (
        pairs.join(left, "a").join(right, ["b", "fragment"])
        .select("a", "b", "na", "nb", F.size(F.array_intersect("of_a", "of_b")).cast("long").alias("part")))
    return partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("overlap"))


def _links(pairs: DataFrame, pieces: DataFrame, percent: int) -> DataFrame:
    overlap = F.col("overlap")
    return _overlaps(pairs, pieces).filter(overlap * 100 >= percent * (F.col("na") + F.col("nb") - overlap)).select("a", "b")


def _near_sizes(percent: int):
    return F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb")


def _least_overlap(percent: int):
    return F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent) - 1e-9)


# Grouped sides of joins are written first: a join of two plain shuffles is one whose hot keys Spark can split.
def _open(entries: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Entries of the grams that still join classes of different groups."""
    entries = entries.drop("is_common", "root", "k")
    if groups is None:
        entries = entries.withColumn("root", F.col("cls"))
    else:
        entries = entries.join(groups.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    apart = entries.groupBy("gram").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("k")).filter("x != y").select("gram", "k")
    return stash(entries.join(stash(apart), "gram"))


def _side(entries: DataFrame, x: str, *more: str) -> DataFrame:
    return entries.select("gram", *[F.col(c).alias(f"{c}_{x}") for c in ("cls", "n", "rare", "root", *more)])


def _met(entries: DataFrame, other: DataFrame, percent: int, once: bool = False) -> DataFrame:
    """Pairs of classes of different groups that meet at a gram, the smaller class first, with sizes that may reach the threshold.

    once: both sides are the same entries, and each pair is wanted in one order only.
    """
    pairs = _side(entries, "x").join(_side(other, "y"), "gram")
    if once:
        pairs = pairs.filter("cls_x < cls_y")
    first = F.col("cls_x") < F.col("cls_y")
    pick = lambda c, name: [
        F.when(first, F.col(f"{c}_x")).otherwise(F.col(f"{c}_y")).alias(f"{name}a"),
        F.when(first, F.col(f"{c}_y")).otherwise(F.col(f"{c}_x")).alias(f"{name}b")]
    sizes = F.least("n_x", "n_y") * 100 >= percent * F.greatest("n_x", "n_y")
    return pairs.filter((F.col("root_x") != F.col("root_y")) & sizes).select(*pick("cls", ""), *pick("n", "n"), *pick("rare", "r"))


def _by_common(entries: DataFrame, other: DataFrame, percent: int) -> DataFrame:
    """Of the pairs that meet at common grams, those whose common parts alone can reach the threshold."""
    small = F.least(F.col("na") - F.col("ra"), F.col("nb") - F.col("rb"))
    return _met(entries, other, percent).filter(small >= _least_overlap(percent)).select("a", "b", "na", "nb").distinct()


def _first_meetings(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs that share common grams only, where these can reach the threshold, made at the first gram they share.

    entries have all grams of each class that classes of different groups share, and their places ``at`` in the class's
    order, which is the same for all. No shared gram lies before the first one, so the overlap is at most what the class with less has
    from there on; at a later gram that is still less. A gram is a later one where the pair shares one of the few before it.
    """
    few = Window.partitionBy("cls").orderBy("at").rowsBetween(-BEFORE, -1)
    entries = stash(entries.withColumn("before", F.collect_list("gram").over(few)))
    side = lambda x: _side(entries, x, "at", "before")
    na, nb = F.col("n_x"), F.col("n_y")
    left = F.least(na - F.col("at_x"), nb - F.col("at_y"))
    reach = left >= F.ceil((na + nb) * percent / (100 + percent) - 1e-9)
    again = F.arrays_overlap("before_x", "before_y")
    pairs = side("x").join(side("y"), "gram").filter(F.col("cls_x") < F.col("cls_y"))
    return pairs.filter((F.col("root_x") != F.col("root_y")) & (F.least(na, nb) * 100 >= percent * F.greatest(na, nb)) & reach & ~again).select(
        F.col("cls_x").alias("a"), F.col("cls_y").alias("b"), na.alias("na"), nb.alias("nb"))


def _pivots(entries: DataFrame, salt: int) -> DataFrame:
    """One class of each gram: first the one with the largest common part, later a drawn one."""
    middle = F.when(F.lit(salt) == 0, F.col("rare") / F.col("n")).otherwise(0.0)
    order = F.struct(middle.alias("m"), F.xxhash64("cls", F.lit(salt)).alias("o"), "cls", "n", "rare", "root")
    return stash(entries.groupBy("gram").agg(F.min(order).alias("p"))).select("gram", "p.cls", "p.n", "p.rare", "p.root")


def _meetings(entries: DataFrame, salt: int) -> DataFrame:
    """A few entries of each class: first those at the grams with most classes, later drawn ones."""
    order = F.desc("k") if salt == 0 else F.xxhash64("gram", F.lit(salt))
    place = F.row_number().over(Window.partitionBy("cls").orderBy(order, "gram"))
    return entries.withColumn("place", place).filter(F.col("place") <= MEETINGS)


def _by_rare(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs that share rare prefix grams, where these and all else that they may have in common can reach the threshold.

    Beyond the prefix of one of them lie ceil(percent * n / 100) - 1 grams, and of its common prefix grams no more are
    in the other than that has itself.
    """
    counted = _met(entries, entries, percent, once=True).groupBy("a", "b", "na", "nb", "ra", "rb").agg(F.count("*").alias("k"))
    beyond = lambda n: F.ceil(F.col(n) * percent / 100 - 1e-9) - 1
    inside = lambda n, r: F.col(n) - beyond(n) - F.col(r)
    most = F.col("k") + F.least(inside("na", "ra"), inside("nb", "rb")) + F.greatest(beyond("na"), beyond("nb"))
    return counted.filter(most >= _least_overlap(percent)).select("a", "b", "na", "nb")


def _grouped(rare: DataFrame, common: DataFrame, pieces_of, percent: int, rounds: int) -> DataFrame | None:
    """(node, root) of all linked classes. pieces_of gives the pieces of the classes that some pairs name."""
    links = groups = tried = None

    def take(pairs: DataFrame) -> None:
        nonlocal links, groups, tried
        pairs = stash(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        if pairs.limit(1).count():
            found = stash(_links(pairs, pieces_of(pairs), percent))
            links = found if links is None else links.unionByName(found)
            tried = pairs.select("a", "b") if tried is None else tried.unionByName(pairs.select("a", "b"))
            groups = components(links)

    for salt in range(rounds):
        common = _open(common, groups)
        if not common.limit(1).count():
            break
        take(_by_common(_meetings(common, salt), _pivots(common, salt), percent))
    take(_by_rare(_open(rare, groups), percent))
    common = _open(common, groups)
    take(_first_meetings(common, percent).distinct())
    return groups


def near_duplicate_groups(
    docs: DataFrame, n: int = N, percent: int = PERCENT, common: int = COMMON, bitmap_bits: int = BITMAP_BITS,
    fragments: int = FRAGMENTS, rounds: int = ROUNDS,
) -> DataFrame:
    """doc_id, n_shingles and component_id for each row of docs (doc_id, text).

    A document's set holds the distinct n-grams of its words, A-Z lower-cased; with fewer than n words the whole sequence is
    its one gram. Two documents link when 100 * intersection >= percent * union. component_id is the smallest doc_id that
    links reach, the row's own included. Null or empty texts have an empty set, n_shingles 0 and link with nothing; rows
    that repeat an id are rows of their own with that id. Other columns of docs are not looked at. An empty table gives none.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    bitmap = _common_grams(rows, n, percent, common, bitmap_bits)
    base = stash(rows.mapInArrow(
        _base(n, percent, bitmap), f"doc_id {kind}, row_key long, n long, one long, two long, prefix array<long>, rare long"))
    classes = stash(base.filter("n > 0").groupBy("one", "two").agg(
        F.min("row_key").alias("cls"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("rare").alias("rare"),
        F.min("doc_id").alias("first_id")))
    prefixes = classes.select("cls", F.posexplode("prefix").alias("at", "gram"), "rare").select(
        "gram", "cls", (F.col("at") >= F.col("rare")).alias("is_common"), F.when(F.col("at") >= F.col("rare"), F.col("at")).alias("at"))
    shared = stash(prefixes.groupBy("gram").agg(F.count("*").alias("k")).filter("k > 1").select("gram"))
    entries = stash(prefixes.join(shared, "gram").join(classes.select("cls", "n", "rare"), "cls"))

    def pieces_of(pairs: DataFrame) -> DataFrame:
        needed = stash(pairs.select(F.explode(F.array("a", "b")).alias("row_key")).distinct())
        texts = rows.select("row_key", "text")
        # few against the bitmap's size: it lets little else pass, and no text is shuffled
        wanted = _bits_of(needed, bitmap_bits) if needed.count() * 8 <= bitmap_bits else None
        if wanted is None:
            texts = texts.join(needed, "row_key", "left_semi")
        pieces = texts.mapInArrow(_pieces(n, bitmap, fragments, wanted), "row_key long, fragment int, grams array<long>")
        return stash(pieces.join(needed, "row_key", "left_semi").dropDuplicates(["row_key", "fragment"]))

    groups = _grouped(entries.filter("not is_common").drop("at"), entries.filter("is_common"), pieces_of, percent, rounds)
    return _result(spark, base, classes, groups)


def _result(spark: SparkSession, base: DataFrame, classes: DataFrame, groups: DataFrame | None) -> DataFrame:
    named = classes.select("one", "two", "cls", "first_id")
    if groups is None:
        named = named.withColumn("component_id", F.col("first_id"))
    else:
        named = named.join(groups.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = named.join(smallest, "root")
    full = base.filter("n > 0").join(named.select("one", "two", "component_id"), ["one", "two"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = base.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)
