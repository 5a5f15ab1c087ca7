"""Toxicity scores from a learned lexicon, matched with spelling errors, and the windows around its hits.

1. Lexicon: words whose document counts in toxic and other training texts differ beyond chance, with their log odds.
2. Matching: the lexicon is a trie; the Levenshtein automata of its terms, run on it at once, give one automaton whose
   states are sets of (trie node, errors). States are made when a word first needs them, so a word that leads to no term
   ends after a few letters.
3. Context: a hit between quotation marks is counted apart; words near hits carry log odds of their own, learned
   from the windows around hits in toxic and other texts (words of report on one side, of address on the other).
4. A logistic regression over the sums of a text gives its score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisleframe.llm.hashing import chunked

MAX_ROWS = 20_000  # labelled texts that the model is fitted on: those with the smallest hashes of their ids
LEXICON = 1_000  # terms of the model, and of its context words, at most: those that tell most
EVIDENCE = 30.0  # likelihood ratio from which a word's counts are no chance
WINDOW = 6
MEMO = 200_000
FEATURES = 7

_WORD = re.compile(r"\w+")
_QUOTED = re.compile(r'"[^"\n]{1,300}"|“[^”\n]{1,300}”|„[^“\n]{1,300}“|«[^»\n]{1,300}»')


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def allowed_errors(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class SpelledTerms:
    """The lexicon trie and the Levenshtein automata of its terms as one automaton, built as words run through it."""

    def __init__(self, terms: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.left: list[int] = [0]  # errors that the most tolerant term below a node allows
        for term in sorted(terms):
            node, path = 0, [0]
            for char in term:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.left.append(0)
                node = self.children[node][char]
                path.append(node)
            self.term[node] = term
            for n in path:
                self.left[n] = max(self.left[n], allowed_errors(term))
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, errors: dict[int, int]) -> int:
        """The state of these nodes and errors, with all nodes that leaving out letters of a term leads to."""
        todo = list(errors)
        while todo:
            node = todo.pop()
            e = errors[node] + 1
            for child in self.children[node].values():
                if e <= self.left[child] and e < errors.get(child, 9):
                    errors[child] = e
                    todo.append(child)
        key = frozenset(errors.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
        return self.ids[key]

    def _step(self, state: int, char: str) -> int:
        errors: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if e <= self.left[node] and e < errors.get(node, 9):
                errors[node] = e

        for node, e in self.sets[state]:
            reach(node, e + 1)
            for letter, child in self.children[node].items():
                reach(child, e if letter == char else e + 1)
        to = self._state(errors) if errors else -1
        self.steps[state][char] = to
        return to

    def match(self, word: str) -> list[tuple[str, int]]:
        """(term, errors) of all terms within their allowed distance of the word."""
        state = self.start
        for char in word:
            to = self.steps[state].get(char)
            state = self._step(state, char) if to is None else to
            if state < 0:
                return []
        return [(t, e) for n, e in self.sets[state] if (t := self.term[n]) and e <= allowed_errors(t)]


class Model:
    """Term and context log odds, words that only look like terms, and the regression; small, and sent to each task."""

    def __init__(self, terms: dict[str, float], alike: frozenset[str] = frozenset(), context: dict[str, float] | None = None):
        self.terms, self.alike, self.context = terms, alike, context or {}
        self.center = np.zeros(FEATURES)
        self.scale = np.ones(FEATURES)
        self.weights: np.ndarray | None = None
        self.bias = -30.0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("automaton", "memo")}

    def hit(self, word: str) -> tuple[float, int] | None:
        """(weight, errors) of the term the word stands for, the heaviest if there are several."""
        if "memo" not in self.__dict__:
            self.automaton, self.memo = SpelledTerms(self.terms), {}
        found = self.memo.get(word, 0)
        if found == 0:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            found = None
            if word in self.terms:
                found = (self.terms[word], 0)
            elif word not in self.alike:
                near = self.automaton.match(word)
                if near:
                    found = max((self.terms[t] * 0.5 ** e, e) for t, e in near)
            self.memo[word] = found
        return found

    def hits(self, words: list[str]) -> dict[str, tuple[float, int]]:
        return {w: h for w in set(words) if (h := self.hit(w)) is not None}

    def features(self, text: str) -> list[float] | None:
        """Sums over the hits of the whole text; None where there is no hit."""
        low = text.lower()
        words = _WORD.findall(low)
        hits = self.hits(words)
        if not hits:
            return None
        at = [i for i, w in enumerate(words) if w in hits]
        exact = sum(hits[words[i]][0] for i in at if hits[words[i]][1] == 0)
        spelled = sum(hits[words[i]][0] for i in at if hits[words[i]][1] > 0)
        quoted_words = Counter(w for m in _QUOTED.finditer(low) for w in _WORD.findall(m.group()))
        quoted = sum(h[0] * quoted_words[w] for w, h in hits.items())
        around = 0.0
        dense = 0.0
        for i in at:
            window = words[max(0, i - WINDOW): i] + words[i + 1: i + 1 + WINDOW]
            around += sum(self.context.get(w, 0.0) for w in window)
            dense = max(dense, sum(hits[w][0] for w in window if w in hits))
        n = len(words)
        return [math.log1p(exact), math.log1p(spelled), math.log1p(quoted), around / len(at), math.log1p(dense),
                len({w for w in hits}) ** 0.5, (exact + spelled) / math.sqrt(n)]

    def score(self, text: str) -> float:
        """Between 0 and 1; the lower, the fewer hits. Without a fitted regression 0."""
        if self.weights is None:
            return 0.0
        made = self.features(text)
        x = (np.array(made if made else [0.0] * FEATURES) - self.center) / self.scale
        z = float(x @ self.weights) + self.bias
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> None:
        """Logistic regression by Newton's method on standardised sums."""
        self.center, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        a = np.column_stack([(x - self.center) / self.scale, np.ones(len(x))])
        w = np.zeros(a.shape[1])
        keep = np.diag([ridge] * FEATURES + [1e-3])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + keep, a.T @ (y - p) - keep @ w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.weights, self.bias = w[:-1], float(w[-1])


def _texts(part: pa.RecordBatch, texts: list[bytes]) -> Iterator[tuple[str, int]]:
    for text, toxic in zip(texts, part.column("toxic").to_pylist(), strict=True):
        yield text.decode(errors="replace"), toxic


def _partial_counts(toxic: Counter, clean: Counter) -> pa.RecordBatch:
    words = list(toxic.keys() | clean.keys())
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array([toxic[w] for w in words], pa.int64()), pa.array([clean[w] for w in words], pa.int64())],
        names=["word", "t", "c"])


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of toxic and other texts that hold a word."""
    sums = (Counter(), Counter())
    for part, texts in chunked(batches):
        for text, toxic in _texts(part, texts):
            sums[0 if toxic else 1].update(set(_WORD.findall(text.lower())))
        if len(sums[0]) + len(sums[1]) > MEMO:
            yield _partial_counts(*sums)
            sums = (Counter(), Counter())
    yield _partial_counts(*sums)


def _context_counts(model: Model):
    """Numbers of toxic and other texts that hold a word near a hit."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = (Counter(), Counter())
        for part, texts in chunked(batches):
            for text, toxic in _texts(part, texts):
                words = _WORD.findall(text.lower())
                hits = model.hits(words)
                near = {w for i, word in enumerate(words) if word in hits
                        for w in words[max(0, i - WINDOW): i + 1 + WINDOW] if w not in hits}
                sums[0 if toxic else 1].update(near)
        yield _partial_counts(*sums)
    return run


def _rows(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunked(batches):
            made = [(model.features(t) or [0.0] * FEATURES, y) for t, y in _texts(part, texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in made], pa.list_(pa.float64())), pa.array([y for _, y in made], pa.int32())], names=["x", "toxic"])
    return run


def _telling(counts: DataFrame, n_toxic: int, n_clean: int, most: int, evidence: float, least: int) -> dict[str, float]:
    """Words whose share among toxic texts is not that among the others, with smoothed log odds; at most `most` of them."""
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    share = n_toxic / max(n_toxic + n_clean, 1)
    part = lambda seen, due: F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)
    ratio = 2 * (part(t, (t + c) * share) + part(c, (t + c) * (1 - share)))
    odds = F.log((t + 0.5) / (n_toxic - t + 0.5)) - F.log((c + 0.5) / (n_clean - c + 0.5))
    found = counts.groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).select(
        "word", "t", "c", ratio.alias("g"), odds.alias("odds")).filter((F.col("g") >= evidence) & (F.col("t") + F.col("c") >= least))
    return {r["word"]: r["odds"] for r in found.orderBy(F.desc("g"), "word").limit(most).collect()}


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The model from labels (doc_id, toxic), of which at most max_rows texts are used, those of equal text once.

    Conflicting labels of an id count as toxic; null labels and ids without a text are left out.
    """
    sample = (
        labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic")).cache()
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sum(n for y, n in sizes.items() if y), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        texts.unpersist()
        return Model({})
    counts = texts.mapInArrow(_word_counts, "word string, t long, c long")
    odds = _telling(counts.filter(F.length("word") > 2), n_toxic, n_clean, LEXICON, EVIDENCE, 5)
    terms = {w: o for w, o in odds.items() if o > 1.5}
    model = Model(terms)
    # words near a term that other texts hold as well are words of their own
    near = texts.mapInArrow(_spelled(model), "word string, t long, c long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    alike = near.filter(F.col("c") * n_toxic >= F.col("t") * n_clean).orderBy(F.desc("c"), "word").limit(100 * LEXICON).collect()
    model = Model(terms, frozenset(r["word"] for r in alike))
    nearby = texts.mapInArrow(_context_counts(model), "word string, t long, c long")
    model.context = _telling(nearby, n_toxic, n_clean, LEXICON, EVIDENCE, 20)
    found = texts.mapInArrow(_rows(model), "x array<double>, toxic int").collect()  # at most max_rows short vectors
    texts.unpersist()
    model.fit(np.array([r["x"] for r in found]), np.array([float(r["toxic"] > 0) for r in found]))
    return model


def _spelled(model: Model):
    """Misspelled terms of the sample with the numbers of toxic and other texts that hold them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = (Counter(), Counter())
        for part, texts in chunked(batches):
            for text, toxic in _texts(part, texts):
                hits = model.hits(_WORD.findall(text.lower()))
                sums[0 if toxic else 1].update(w for w, (_, e) in hits.items() if e)
        yield _partial_counts(*sums)
    return run


def _score(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunked(batches):
            scores = [model.score(t.decode(errors="replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= 0.5) of each row of docs (doc_id, text).

    held_out rows (crc32 of the id as text modulo 5 is 0; a null id is none) are not learned from. Whole texts are scored; null
    and empty texts as texts without a hit. Rows that repeat score alike. Without labels of both kinds all scores are 0.
    Other columns of docs and labels are not looked at.
    """
    model = fit(docs, labels.filter(~held_out()), max_rows)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        _score(model), f"doc_id {kind}, held_out boolean, score double, predicted int")
