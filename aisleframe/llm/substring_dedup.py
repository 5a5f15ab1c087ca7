"""Long repeated word spans, found on a compacted de Bruijn graph of sampled token k-mers.

1. k-mers of K words are sampled by their own content: a k-mer counts when its smallest S-word hash stands first or
   last in it (a closed syncmer; ties go to the left). Of any K - S consecutive k-mers one is sampled, so every
   window of `window` words holds one, and equal windows hold the same ones at the same places.
2. Sampled k-mers that occur twice or more are the vertices; the step to the next such k-mer that overlaps it, with
   its distance, is an edge. Joins give every vertex whether all its occurrences leave by one edge and enter by one.
3. Paths through such vertices compact: all occurrences of a path have the same words and it occurs at least twice, so
   a path of `window` words or more is a repeated span at each of its source coordinates.
4. Windows that contain repeated vertices but reach over the end of a path are verified by their own hash and count.

Words are compared by 64-bit hashes of k-mers and windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aisleframe.llm.hashing import Texts, as_bytes, chunked, signed, windows
from aisleframe.llm.shared import stash

WINDOW = 35
S = 2


def _kmer_words(window: int) -> int:
    """The longest k-mer of which each window holds a sampled one: window - K + 1 >= K - S."""
    if window < 6:
        raise ValueError("a window has at least six words")
    return (window + 1 + S) // 2


def _running_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` consecutive values, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return x if have == width else np.minimum(x[: len(x) - (width - have)], x[width - have:])


def _sampled(h: np.ndarray, k: int) -> np.ndarray:
    """First words of the closed syncmers among the k-mers of a sequence of word hashes."""
    small = windows(h, S)
    n = k - S + 1
    if len(small) < n:
        return np.empty(0, np.int64)
    whole, but_last = _running_min(small, n), _running_min(small, n - 1)
    first = small[: len(whole)] == whole
    last = small[n - 1:] < but_last[: len(whole)]
    return np.flatnonzero(first | last)


def _kmers(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunked(batches):
            found = Texts(texts)
            at = _sampled(found.hash, k)
            at = at[found.of[at] == found.of[at + k - 1]]
            rows = np.asarray(part.column("row_key"))[found.of[at]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(windows(found.hash, k)[at])), pa.array(rows), pa.array(found.position(at).astype(np.int32))],
                names=["kmer", "row_key", "at"])
    return run


def _spans_of(h: np.ndarray, marks: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(spans of long compacted paths as [first, end), first words of windows still to verify) of one text.

    marks: sorted 4 * position + 2 * leaves by one edge + enters by one edge, of its repeated k-mers.
    """
    at, one_out, one_in = marks >> 2, (marks >> 1) & 1, marks & 1
    joined = (np.diff(at) < k) & (one_out[:-1] == 1) & (one_in[1:] == 1)
    first = np.flatnonzero(np.concatenate(([True], ~joined)))
    last = np.append(first[1:], len(at)) - 1
    spans = np.stack([at[first], at[last] + k], axis=1)
    spans = spans[spans[:, 1] - spans[:, 0] >= window]
    n = len(h) - window + 1
    if n < 1:
        return spans, np.empty(0, np.int64)
    reach = window - k + 1
    once = np.zeros(len(h) + 2, np.int64)
    known = _sampled(h, k)
    once[known] = 1
    repeated = np.zeros(len(h) + 2, np.int64)
    repeated[at] = 1
    total = np.concatenate(([0], np.cumsum(once - repeated)))
    some = np.concatenate(([0], np.cumsum(repeated)))
    starts = np.arange(n)
    open_ = (some[starts + reach] > some[starts]) & (total[starts + reach] == total[starts])
    for a, b in spans:
        open_[a: b - window + 1] = False
    return spans, np.flatnonzero(open_)


def _candidates(k: int, window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunked(batches):
            marks = part.column("marks").to_pylist()
            keys = part.column("row_key").to_pylist()
            found = Texts(texts)
            ends = np.cumsum(found.counts)
            rows, hashes, firsts, stops = [], [], [], []
            for i, key in enumerate(keys):
                h = found.hash[ends[i] - found.counts[i]: ends[i]]
                spans, starts = _spans_of(h, np.asarray(marks[i], np.int64), k, window)
                whole = signed(windows(h, window))
                rows.append(np.full(len(spans) + len(starts), key, np.int64))
                hashes += [None] * len(spans) + whole[starts].tolist()
                firsts.append(np.concatenate([spans[:, 0], starts]))
                stops.append(np.concatenate([spans[:, 1], starts + window]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(rows)), pa.array(hashes, pa.int64()),
                     pa.array(np.concatenate(firsts).astype(np.int32)), pa.array(np.concatenate(stops).astype(np.int32))],
                    names=["row_key", "window", "first", "stop"])
    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row_key, spans array<struct<first, stop>>): word spans of each text covered by windows that occur elsewhere.

    docs: row_key (64-bit key of the row; equal keys mean equal texts) and text. Texts without such a span are not in
    the result. Spans of a text may overlap; a text's spans are bounded by its own length.
    """
    k = _kmer_words(window)
    found = stash(docs.select("row_key", "text").mapInArrow(_kmers(k), "kmer long, row_key long, at int"))
    # grouped sides are written before they are joined, so that a k-mer of very many texts can be split in the join
    twice = stash(found.groupBy("kmer").agg(F.count("*").alias("n")).filter("n > 1").select("kmer"))
    vertices = found.join(twice, "kmer").repartition("row_key").dropDuplicates(["row_key", "at"])
    order = Window.partitionBy("row_key").orderBy("at")
    edge = lambda step: F.when(
        F.abs(step("at") - F.col("at")) < k, F.xxhash64(step("kmer"), step("at") - F.col("at")))
    steps = stash(vertices.select(
        "kmer", "row_key", "at",
        edge(lambda c: F.lead(c).over(order)).alias("leave"), edge(lambda c: F.lag(c).over(order)).alias("enter")))
    one = lambda c: (F.count(c) == F.count("*")) & (F.min(c) == F.max(c))
    degrees = stash(steps.groupBy("kmer").agg(
        F.coalesce(one("leave"), F.lit(False)).alias("one_out"), F.coalesce(one("enter"), F.lit(False)).alias("one_in")))
    marks = (
        steps.join(degrees, "kmer")
        .select("row_key", (F.col("at").cast("long") * 4 + F.col("one_out").cast("int") * 2 + F.col("one_in").cast("int")).alias("mark"))
        .groupBy("row_key").agg(F.sort_array(F.collect_list("mark")).alias("marks")))
    # a row_key that stands twice has its spans twice; the windows of both rows count
    checked = stash(
        docs.select("row_key", "text").join(marks, "row_key")
        .mapInArrow(_candidates(k, window), "row_key long, window long, first int, stop int"))
    again = stash(checked.filter("window is not null").groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window"))
    hits = checked.filter("window is not null").join(again, "window").select("row_key", "first", "stop")
    spans = checked.filter("window is null").select("row_key", "first", "stop").unionByName(hits)
    return spans.groupBy("row_key").agg(F.collect_set(F.struct("first", "stop")).alias("spans"))


def _strip(names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept, digest = [], [], [], []
            for text, spans in zip(as_bytes(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
                words = text.split()
                n_words.append(len(words))
                if spans:
                    drop = np.zeros(len(words) + 1, np.int64)
                    for s in spans:
                        drop[s["first"]] += 1
                        drop[s["stop"]] -= 1
                    free = np.cumsum(drop)[:-1] == 0
                    words = [w for w, f in zip(words, free.tolist(), strict=True) if f]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
                digest.append(hashlib.sha256(kept[-1]).hexdigest())
            made = {
                "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()), "kept_sha256": pa.array(digest, pa.string())}
            yield pa.RecordBatch.from_arrays(
                [made.get(n) if n in made else batch.column(n) for n in names], names=names)
    return run


def strip_spans(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (text, spans: null or as `repeated_spans` gives them) with `columns`, n_removed and kept_text."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.select(*columns).schema}
    schema = ", ".join(f"`{n}` {t}" for n, t in {**kinds, "n_removed": "bigint", "kept_text": "string"}.items())
    return rows.mapInArrow(_strip([*kinds, "n_removed", "kept_text"]), schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, keep: tuple[str, ...] = ("doc_id",), with_text: bool = True) -> DataFrame:
    """Each row of docs without the words of repeated spans: `keep` columns, n_words, n_removed, kept_text, kept_sha256.

    A word goes when a window of `window` consecutive words that covers it stands a second time anywhere, in the same
    text or in another row; windows are judged on the input. kept_text has the other words joined by one space. A null
    or empty text has no words and the digest of the empty string; a text shorter than the window keeps all its words.
    Rows with the same id and text count as two texts. Other columns of docs, whatever their names, are not looked at.
    """
    base = docs.select(*keep, "text").withColumn("row_key", F.xxhash64(*keep, "text"))
    spans = repeated_spans(base, window)
    joined = base.join(spans, "row_key", "left").drop("row_key")
    kept = {f.name: f.dataType.simpleString() for f in docs.select(*keep).schema}
    made = {"n_words": "bigint", "n_removed": "bigint", **({"kept_text": "string"} if with_text else {}), "kept_sha256": "string"}
    schema = ", ".join(f"`{n}` {t}" for n, t in {**kept, **made}.items())
    return joined.mapInArrow(_strip([*kept, *made]), schema)
