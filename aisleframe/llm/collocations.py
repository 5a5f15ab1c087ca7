"""Phrases whose words stand together more often than apart, mined from a sample and counted exactly (Toivonen).

1. A sample of the texts proposes frequent words and word pairs, at a lowered threshold.
2. A full pass counts all words, the pairs of proposed words and the triples of proposed pairs. These are the proposed phrases
   together with their negative border: the phrases that are not proposed while all their parts are.
3. Where a phrase of the border turns out frequent, phrases that hold it were not counted. A further pass counts those, and so on
   until no frequent phrase is outside of what was proposed. Phrases have at most three words, so three passes are enough.

Proposed phrases travel as bitmaps of a fixed size. A bit that two phrases share only makes a pass count more than it must.
Phrases are compared by pairs of 64-bit hashes; the texts of those in the result are read from the documents in the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aisleframe.llm.hashing import chunked, hash_words, mix, signed
from aisleframe.llm.shared import stash

LEAST = 10
TOP = 2000
SAMPLE_EVERY = 16
WITHIN_PERCENT = 50
BITMAP_BITS = 1 << 26
BUFFER = 1 << 18
_BUCKET = 1 << 15
_PUNCTUATION = b".,;:!?"
_TO_SPACE = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
_BREAK = np.zeros(256, bool)
_BREAK[[*_PUNCTUATION, 10, 11, 12, 13]] = True
_SPLIT = _BREAK.copy()
_SPLIT[[9, 32]] = True
_LEFT = np.uint64(0xD6E8FEB86659FD93)
KEY = ["lang", "len", "x", "y"]
SCHEMA = "lang string, len int, x long, y long, n long"


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _join(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One hash of the phrase that consists of two given ones."""
    return mix(x * _LEFT + mix(y))


class _Words:
    """Words of a few texts as hashes that also tell the language, and where pairs and triples inside a piece begin."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.buf = b"\n".join(texts).lower()
        word, self.start = hash_words(self.buf.translate(_TO_SPACE))
        self.names = sorted(set(langs))
        number = {lang: i for i, lang in enumerate(self.names)}
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.lang = np.array([number[x] for x in langs], np.int64)[np.searchsorted(ends, self.start, "right")]
        self.word = mix(word ^ np.array([_seed(x) for x in self.names], np.uint64)[self.lang])
        piece = np.searchsorted(np.flatnonzero(_BREAK[np.frombuffer(self.buf, np.uint8)]), self.start)
        self.pairs = np.flatnonzero(piece[1:] == piece[:-1])
        self.triples = np.flatnonzero(piece[2:] == piece[:-2])
        self.pair = _join(self.word[:-1], self.word[1:])

    def text(self, first: int, n: int) -> str:
        words = []
        for s in self.start[first: first + n].tolist():
            e = s
            while e < len(self.buf) and not _SPLIT[self.buf[e]]:
                e += 1
            words.append(self.buf[s:e])
        return b" ".join(words).decode("utf-8", "replace")


def _has(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _due(key: np.ndarray, at: np.ndarray, now: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """Of the phrases made of the parts at `at` and behind it, those with both parts proposed now and not before."""
    known = _has(now, key)
    due = known[at] & known[at + 1]
    if before is not None:
        old = _has(before, key)
        due &= ~(old[at] & old[at + 1])
    return at[due]


class _Counts:
    """Counts of phrases, added up in memory and given out about BUFFER keys at a time."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, names: list[str], lang: np.ndarray, n: int, x: np.ndarray, y: np.ndarray) -> None:
        if len(x):
            self.parts.append((names, lang, n, x, y))
            self.size += len(x)

    def flush(self) -> pa.RecordBatch:
        names = sorted({name for part in self.parts for name in part[0]})
        number = {name: i for i, name in enumerate(names)}
        lang = np.concatenate([np.array([number[x] for x in p[0]], np.int64)[p[1]] for p in self.parts])
        n = np.concatenate([np.full(len(p[3]), p[2], np.int32) for p in self.parts])
        x, y = (np.concatenate([p[k] for p in self.parts]) for k in (3, 4))
        _, first, counts = np.unique(_join(x ^ n.astype(np.uint64), y), return_index=True, return_counts=True)
        self.parts, self.size = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()).take(pa.array(lang[first])), pa.array(n[first]), pa.array(signed(x[first])),
             pa.array(signed(y[first])), pa.array(counts)], names=[*KEY, "n"])


def _totals(found: _Words) -> pa.RecordBatch:
    zeros = np.zeros(len(found.names), np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(found.names, pa.string()), pa.array(zeros.astype(np.int32)), pa.array(zeros), pa.array(zeros),
         pa.array(np.bincount(found.lang, minlength=len(zeros)))], names=[*KEY, "n"])


def _counter(now: tuple[bytes, bytes] | None, before: tuple[bytes, bytes] | None):
    """Counts of phrases by chunk, and of all words per language as length 0.

    Without bitmaps, all words and pairs. Else pairs and triples that are due now; words and totals in the first pass.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = now and [np.frombuffer(b, np.uint8) for b in now]
        old = before and [np.frombuffer(b, np.uint8) for b in before]
        counts = _Counts()
        for part, texts in chunked(batches):
            found = _Words(texts, part.column("lang").to_pylist())
            if not len(found.word):
                continue
            pairs = found.pairs if new is None else _due(found.word, found.pairs, new[0], old and old[0])
            counts.add(found.names, found.lang[pairs], 2, found.word[pairs], found.word[pairs + 1])
            if new is not None:
                triples = _due(found.pair, found.triples, new[1], old and old[1])
                counts.add(found.names, found.lang[triples], 3, found.pair[triples], found.pair[triples + 1])
            if old is None:
                counts.add(found.names, found.lang, 1, found.word, np.zeros_like(found.word))
                yield _totals(found)
            if counts.size >= BUFFER:
                yield counts.flush()
        if counts.size:
            yield counts.flush()
    return run


def _frequent(rows: DataFrame, counter, least: int) -> DataFrame:
    counts = rows.mapInArrow(counter, SCHEMA).groupBy(*KEY).agg(F.sum("n").alias("n"))
    return stash(counts.filter((F.col("len") == 0) | (F.col("n") >= least)))


def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A pair's own hash beside the hashes of its words."""
    for part in batches:
        x, y = (np.asarray(part.column(c)).astype(np.int64).view(np.uint64) for c in ("x", "y"))
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(signed(_join(x, y)))], names=[*part.schema.names, "key"])


def _with_key(pairs: DataFrame) -> DataFrame:
    return pairs.select(*KEY, "n").mapInArrow(_keys, f"{SCHEMA}, key long")


def _bits(keys: DataFrame, bits: int) -> bytes:
    """A column `key` of 64-bit keys as a bitmap of the lowest digits; at most bits / 32768 rows come to the driver."""
    at = F.col("key").bitwiseAND(bits - 1)
    rows = (
        keys.select(at.alias("at")).distinct().select(F.shiftright("at", 15).alias("bucket"), F.col("at").bitwiseAND(_BUCKET - 1).alias("bit"))
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect())
    out = np.zeros((max(1, bits // _BUCKET), _BUCKET // 8), np.uint8)
    for r in rows:
        out[r["bucket"]] = np.frombuffer(r["bitmap"], np.uint8)
    return out.tobytes()


def _proposed(counts: DataFrame, bits: int) -> tuple[bytes, bytes]:
    words = counts.filter("len = 1").select(F.col("x").alias("key"))
    pairs = _with_key(counts.filter("len = 2")).select("key")
    return _bits(words, bits), _bits(pairs, bits)


def _both(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
    return tuple((np.frombuffer(x, np.uint8) | np.frombuffer(y, np.uint8)).tobytes() for x, y in zip(a, b, strict=True))


def frequent_phrases(rows: DataFrame, least: int, sample_every: int, bits: int) -> DataFrame:
    """(lang, len, x, y, n): all phrases of one to three words found `least` times or more, and with len 0 each language's words."""
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(sample_every)) == 0)
    lowered = max(2, least // (2 * sample_every))
    now = _proposed(_frequent(sample, _counter(None, None), lowered), bits)
    counted = before = None
    while True:
        found = _frequent(rows, _counter(now, before), least)
        counted = found if counted is None else counted.unionByName(found)
        wider = _both(now, _proposed(counted, bits))
        if wider == now:
            return counted
        before, now = now, wider


def _score(a: str, left: str, right: str):
    """floor(1000000 * a * a / (left * right)) in whole numbers of 38 digits."""
    wide = lambda c: f"cast({c} as decimal(38, 0))"
    return F.expr(f"cast(({wide(1_000_000)} * {a} * {a}) div ({wide(left)} * {right}) as bigint)")


def _scored(counted: DataFrame, within: int) -> DataFrame:
    """Pairs and triples with their weakest cut, without those that mostly stand inside a longer one."""
    words = counted.filter("len = 1").select("lang", F.col("x").alias("w"), F.col("n").alias("f"))
    pairs = _with_key(counted.filter("len = 2")).withColumnRenamed("n", "a")
    first = words.select("lang", F.col("w").alias("x"), F.col("f").alias("l"))
    second = words.select("lang", F.col("w").alias("y"), F.col("f").alias("r"))
    pairs = stash(pairs.join(first, ["lang", "x"]).join(second, ["lang", "y"]))
    triples = counted.filter("len = 3").select(*KEY, F.col("n").alias("a"))
    left = pairs.select("lang", F.col("key").alias("x"), F.col("a").alias("l2"), F.col("l").alias("l1"))
    right = pairs.select("lang", F.col("key").alias("y"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    cut = triples.join(left, ["lang", "x"]).join(right, ["lang", "y"]).withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    later = F.col("s2") < F.col("s1")
    triples = stash(cut.select(*KEY, "a", *[F.when(later, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(n) for c, n in (("l", "l"), ("r", "r"), ("s", "score"))]))
    inside = triples.select("lang", F.col("x").alias("key"), "a").unionByName(triples.select("lang", F.col("y").alias("key"), "a"))
    inside = stash(inside.groupBy("lang", "key").agg(F.max("a").alias("most")))
    alone = pairs.join(inside, ["lang", "key"], "left").filter(F.col("most").isNull() | (100 * F.col("most") < within * F.col("a")))
    return stash(alone.withColumn("score", _score("a", "l", "r")).select(*triples.columns).unionByName(triples))


def _first_rows(scored: DataFrame, top: int) -> DataFrame:
    """The rows that may be among a language's first: down to the score, and at that score the count, where `top` is reached.

    Found with histograms: a language has at most 1001 thousands of scores, then 1000 scores in the thousand where the
    place lies, then the counts at that score.
    """
    rows = scored.withColumn("tier", F.expr("score div 1000"))
    reached = None
    for by in ("tier", "score", "a"):
        here = rows.select("lang", by, F.lit(0).alias("taken")) if reached is None else rows.join(reached, [c for c in reached.columns if c != "taken"]).select(
            "lang", by, "taken", *[c for c in reached.columns if c not in ("lang", "taken")])
        kept = [c for c in here.columns if c != by]
        upto = Window.partitionBy("lang").orderBy(F.desc(by))
        counts = stash(here.groupBy(*kept, by).agg(F.count("*").alias("k")))
        counts = counts.withColumn("before", F.col("taken") + F.sum("k").over(upto) - F.col("k")).filter(F.col("before") < top)
        at = [F.min(by).alias(by), F.min_by("before", by).alias("taken")]
        reached = stash(counts.groupBy("lang", *[c for c in kept if c not in ("lang", "taken")]).agg(*at))
    least = reached.select("lang", F.col("score").alias("last"), F.col("a").alias("least"))
    enough = (F.col("score") > F.col("last")) | ((F.col("score") == F.col("last")) & (F.col("a") >= F.col("least")))
    return stash(scored.join(least, "lang").filter(enough).select(*scored.columns))


def _texts_of(bitmap: bytes):
    """(lang, len, x, y, phrase) once per chunk for each pair and triple that the bitmap lets pass."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)
        for part, texts in chunked(batches):
            found = _Words(texts, part.column("lang").to_pylist())
            for n, at, parts in ((2, found.pairs, found.word), (3, found.triples, found.pair)):
                key = _join(parts[at], parts[at + 1])
                at, key = at[hit := _has(bits, key)], key[hit]
                at = at[np.unique(key, return_index=True)[1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([found.names[k] for k in found.lang[at].tolist()], pa.string()), pa.array(np.full(len(at), n, np.int32)),
                     pa.array(signed(parts[at])), pa.array(signed(parts[at + 1])),
                     pa.array([found.text(i, n) for i in at.tolist()], pa.string())], names=[*KEY, "phrase"])
    return run


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, sample_every: int = SAMPLE_EVERY, within: int = WITHIN_PERCENT,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases of two or three words found `least` times or more.

    Texts of docs (text, lang), A-Z lower-cased, are split at `.,;:!?` and line ends into pieces and those at spaces and tabs into
    words; phrases do not reach over pieces. n counts a language's words, a the phrase, l and r the parts of the cut with the
    lowest floor(1000000 * a * a / (l * r)), the first of equal ones. Phrases go whose words stand in a longer frequent one
    with at least `within` percent of their occurrences. Order: score, a, both falling, then phrase in byte order. A null text is empty, a null
    lang is `und`; repeated rows count each time; other columns are not looked at; an empty table gives no rows.
    """
    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    counted = frequent_phrases(rows, least, sample_every, bitmap_bits)
    best = _first_rows(_scored(counted, within), top)
    wanted = _bits(best.select(*KEY, F.col("a").alias("n")).mapInArrow(_keys, f"{SCHEMA}, key long"), bitmap_bits)
    phrases = stash(rows.mapInArrow(_texts_of(wanted), "lang string, len int, x long, y long, phrase string")
                    .groupBy(*KEY).agg(F.min("phrase").alias("phrase")))
    totals = counted.filter("len = 0").select("lang", F.col("n").alias("words"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.join(phrases, KEY).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
