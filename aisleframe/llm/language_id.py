"""The language of texts by interpolated Kneser-Ney models over characters.

Each language has one model of character n-grams, fitted on a bounded sample of labelled texts. Hashes of n-grams and of their contexts stand
in sorted arrays, one for all languages, with each language's discounted share and back-off weight beside them. A text gets
the language whose model needs the fewest bits a character. How often such a choice is right is calibrated on labelled texts that
no model has seen, from the lead over the second language, the bits above what the language usually needs, and the length. The
calibration also sees each of these texts with its own language taken away, as a text of an unknown language. Choices that are less
certain than nearly all right ones are marked as rejected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisleframe.llm.hashing import CHUNK, chunked, mix
from aisleframe.llm.shared import stash

ORDER = 5
#: A language is learned from at most so many different texts with so many characters, one text beyond them included.
SAMPLE_TEXTS = 2_000
SAMPLE_CHARS = 2_000_000
#: One of so many sample texts serves for calibration only.
CALIBRATION_EVERY = 8
ACCEPTED_SHARE = 0.995
NO_LANGUAGE = "und"
_STEP = np.uint64(0x9FB21C651E98DF25)
_DRAWN = 1 << 20


@cache
def _kinds() -> np.ndarray:
    """By code point: 2 for letters, 1 for marks, which stand in words as well, else 0."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)], np.uint8)


def _symbols(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, number of the text of each, letters of each text).

    Lower-cased; all between words is one space; order - 1 zeros stand before each text.
    """
    low = [t.lower().replace("\0", " ") for t in texts]
    gap = "\0" * (order - 1)
    codes = np.frombuffer((gap + gap.join(low)).encode("utf-32-le", "replace"), "<u4")
    owner = np.repeat(np.arange(len(low)), [len(t) + order - 1 for t in low])
    kind = _kinds()[codes]
    letters = np.bincount(owner[kind == 2], minlength=len(low))
    inside = kind > 0
    start = codes == 0
    keep = inside | start
    keep[1:] |= ~keep[1:] & inside[:-1]
    return np.where(inside | start, codes, 32)[keep], owner[keep], letters


def _hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For k from 0 to order, the hash of the k symbols that end at each place."""
    found = [np.zeros(len(codes), np.uint64)]
    for _ in range(order):
        before = np.concatenate((np.zeros(1, np.uint64), found[-1][:-1]))
        found.append(mix(before * _STEP + codes.astype(np.uint64) + np.uint64(1)))
    return found


def kneser_ney(codes: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each k from 1 to order: (n-grams, their discounted shares, contexts, their back-off weights), by ascending hash.

    The highest order counts n-grams; each lower one counts the different symbols that stand before its n-grams.
    """
    h = _hashes(codes, order)
    at = np.flatnonzero(codes)
    grams, first, counts = np.unique(h[order][at], return_index=True, return_counts=True)
    at = at[first]
    tables = []
    for k in range(order, 0, -1):
        once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
        discount = once / (once + 2 * twice) if once and twice else 0.5
        contexts, inverse = np.unique(h[k - 1][at - 1] if k > 1 else np.zeros(len(at), np.uint64), return_inverse=True)
        total = np.bincount(inverse, counts)
        tables.append((grams, (counts - discount) / total[inverse], contexts, discount * np.bincount(inverse) / total))
        if k > 1:
            grams, first, counts = np.unique(h[k - 1][at], return_index=True, return_counts=True)
            at = at[first]
    return tables[::-1]


def _fit(order: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        codes, _, _ = _symbols(rows["text"].tolist(), order)
        out = [(key[0], k + 1, *(x.tobytes() for x in table)) for k, table in enumerate(kneser_ney(codes, order))]
        return pd.DataFrame(out, columns=["lang", "k", "grams", "shares", "contexts", "weights"])
    return run


def _merged(keys: list[np.ndarray], values: list[np.ndarray], default: float) -> tuple[np.ndarray, np.ndarray]:
    """All keys in order, and a row of values for each language."""
    every = np.unique(np.concatenate(keys))
    table = np.full((len(keys), len(every)), default)
    for row, k, v in zip(table, keys, values, strict=True):
        row[np.searchsorted(every, k)] = v
    return every, table


def _place(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Models:
    """The models of all languages side by side."""

    def __init__(self, rows: list):
        self.langs = sorted({r["lang"] for r in rows})
        self.order = max(r["k"] for r in rows)
        of = {(r["lang"], r["k"]): r for r in rows}
        read = lambda k, name, kind: [np.frombuffer(of[x, k][name], kind) for x in self.langs]
        orders = range(1, self.order + 1)
        self.shares = [_merged(read(k, "grams", np.uint64), read(k, "shares", float), 0.0) for k in orders]
        self.weights = [_merged(read(k, "contexts", np.uint64), read(k, "weights", float), 1.0) for k in orders]
        self.unseen = 1 / (len(self.shares[0][0]) + 1)

    def probabilities(self, h: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """Of the symbol at each place behind those before it, in each language."""
        p = np.full((len(self.langs), len(at)), self.unseen)
        for k in range(1, self.order + 1):
            keys, weights = self.weights[k - 1]
            place, known = _place(keys, h[k - 1][at - 1] if k > 1 else np.zeros(len(at), np.uint64))
            p *= np.where(known, weights[:, place], 1.0)
            keys, shares = self.shares[k - 1]
            place, known = _place(keys, h[k][at])
            p += np.where(known, shares[:, place], 0.0)
        return p

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bits a character in each language, characters, letters) of each text; no bits where it has no character."""
        codes, owner, letters = _symbols(texts, self.order)
        total = np.zeros((len(self.langs), len(texts)))
        reach = self.order - 1
        for start in range(0, len(codes), CHUNK):
            low = max(0, start - reach)
            part, of = codes[low: start + CHUNK], owner[low: start + CHUNK]
            h = _hashes(part, self.order)
            at = np.flatnonzero(part)
            at = at[at >= start - low]
            _, first, inverse = np.unique(h[self.order][at], return_index=True, return_inverse=True)
            logs = -np.log2(self.probabilities(h, at[first]))
            for row, log in zip(total, logs, strict=True):
                row += np.bincount(of[at], log[inverse], len(texts))
        n = np.bincount(owner[codes != 0], minlength=len(texts))
        return total / np.maximum(n, 1), n, letters


class Calibration:
    """The chance that a choice is right, and the least one that is accepted."""

    def __init__(self, lang: np.ndarray, bits: np.ndarray, n: np.ndarray):
        """lang: the right language's number for each text; bits: a row for each language."""
        count = bits.shape[0]
        own = bits[lang, np.arange(len(lang))]
        every = own.mean() if len(own) else 0.0
        self.usual = np.array([own[lang == i].mean() if (lang == i).any() else every for i in range(count)])
        x, right = self._features(bits, n), bits.argmin(axis=0) == lang
        if count > 1:
            without = bits.copy()
            without[lang, np.arange(len(lang))] = np.inf
            x, label = np.concatenate([x, self._features(without, n)]), np.concatenate([right, np.zeros(len(lang), bool)])
        else:
            label = right
        self.coef = self._logistic(x, label)
        own = np.sort(self._chance(x[: len(lang)][right]))
        # the share holds for unseen texts where so many lie below it of one more; too few texts prove none
        below = int((len(own) + 1) * (1 - ACCEPTED_SHARE))
        self.least = float(own[below - 1]) if below else 0.5

    def _features(self, bits: np.ndarray, n: np.ndarray) -> np.ndarray:
        low = np.sort(bits, axis=0)
        lead = np.minimum(low[1] - low[0], 4.0) if len(low) > 1 else np.full(bits.shape[1], 4.0)
        lead = np.where(np.isfinite(lead), lead, 4.0)
        above = np.clip(low[0] - self.usual[bits.argmin(axis=0)], -8.0, 8.0)
        size = np.log2(n + 1.0)
        return np.stack([np.ones_like(size), lead, above, size, lead * size, above * size], axis=1)

    @staticmethod
    def _logistic(x: np.ndarray, label: np.ndarray, keep: float = 1e-2) -> np.ndarray:
        """Coefficients by Newton steps, held near zero so that cases without any error still have some."""
        coef = np.zeros(x.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep * np.eye(len(coef)), x.T @ (label - p) - keep * coef)
            coef = coef + step
            if np.abs(step).max() < 1e-8:
                break
        return coef

    def _chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.coef, -30, 30)))

    def chance(self, bits: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self._chance(self._features(bits, n))


def _measured(models: Models):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunked(batches):
            bits, n, _ = models.bits([t.decode("utf-8", "replace") for t in texts])
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array(bits.T.tolist(), pa.list_(pa.float64())), pa.array(n)], names=["lang", "bits", "n"])
    return run


def _predicted(models: Models, calibration: Calibration):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*models.langs, NO_LANGUAGE], pa.string())
        for part, texts in chunked(batches):
            bits, n, letters = models.bits([t.decode("utf-8", "replace") for t in texts])
            none = letters == 0
            score = np.where(none, 0.0, calibration.chance(bits, n))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), names.take(pa.array(np.where(none, len(models.langs), bits.argmin(axis=0)))),
                 pa.array(score), pa.array(none | (score < calibration.least)), pa.array(bits.min(axis=0), mask=none)],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected", "bits_per_char"])
    return run


def _sample(labelled: DataFrame, texts: int, chars: int) -> DataFrame:
    """(lang, key, text): a bounded number of different texts of each language, drawn by their hash, overlong ones last."""
    labelled = labelled.filter("text is not null and lang is not null").select("lang", "text", F.xxhash64("text").alias("key"))
    counts = stash(labelled.groupBy("lang").agg(F.count("*").alias("k")))
    drawn = labelled.join(counts, "lang").filter(F.pmod("key", F.lit(_DRAWN)) * F.col("k") < 2 * texts * _DRAWN)
    drawn = stash(drawn.select("lang", "key", "text").dropDuplicates(["lang", "key"]))
    size = F.length("text").cast("long")
    order = Window.partitionBy("lang").orderBy("long", "key")
    ranked = drawn.select("lang", "key", size.alias("size"), (size > chars).alias("long")).select(
        "lang", "key", "size", F.row_number().over(order).alias("at"), F.sum("size").over(order).alias("upto"))
    chosen = ranked.filter((F.col("at") <= texts) & (F.col("upto") - F.col("size") < chars)).select("lang", "key")
    return stash(drawn.join(chosen, ["lang", "key"]))


def predict_languages(
    docs: DataFrame, held_out: Column, order: int = ORDER, sample_texts: int = SAMPLE_TEXTS, sample_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, bits_per_char for each row of docs (doc_id, text, lang).

    Models learn from rows with a text and a lang where `held_out` is false; lang is not looked at otherwise. A language is learned
    from at most `sample_texts` different texts, and until `sample_chars` characters are reached. score is the calibrated chance that
    lang_pred is right; rejected marks choices less certain than 99.5 of 100 right ones,
    or below 0.5 where fewer than 199 texts serve for calibration. Null texts and texts without a letter
    are `und` with score 0, rejected and without bits; so is every text where there is nothing to learn from. Of languages with
    equal bits the first by name is taken. Where `held_out` is null the row is shown as not held out and not learned from. Repeated
    rows get equal results; other columns are not looked at; an empty table gives no rows.
    """
    schema = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean, bits_per_char double"
    sample = _sample(docs.filter(~held_out), sample_texts, sample_chars)
    aside = F.pmod(F.xxhash64("key"), F.lit(CALIBRATION_EVERY)) == 0
    fitted = sample.withColumn("aside", aside)
    # a language whose few texts were all set aside learns from these
    known = fitted.filter("not aside").select("lang").distinct()
    own = fitted.filter("not aside").unionByName(fitted.join(known, "lang", "left_anti"))
    with_letters = own.filter(F.col("text").rlike(r"\p{L}"))
    rows = with_letters.select("lang", "text").groupBy("lang").applyInPandas(
        _fit(order), "lang string, k int, grams binary, shares binary, contexts binary, weights binary").collect()  # bounded by the sample
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    if not rows:
        return asked.select("doc_id", "held_out", F.lit(NO_LANGUAGE).alias("lang_pred"), F.lit(0.0).alias("score"),
                            F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("bits_per_char"))
    models = Models(rows)
    seen = fitted.filter(F.col("aside") & F.col("lang").isin(models.langs) & F.col("text").rlike(r"\p{L}")).select("lang", "text")
    seen = seen.mapInArrow(_measured(models), "lang string, bits array<double>, n long").collect()
    number = {lang: i for i, lang in enumerate(models.langs)}
    calibration = Calibration(
        np.array([number[r["lang"]] for r in seen], np.int64), np.array([r["bits"] for r in seen]).reshape(-1, len(number)).T,
        np.array([r["n"] for r in seen], np.int64))
    return asked.mapInArrow(_predicted(models, calibration), schema)
