"""Quality rules: plain word rules, then robust multivariate outliers per language and source.

Each text that passes the plain rules gives a vector of transformed statistics. For every language and source (and every
language, and all texts, for groups that are too small) a minimum-covariance-determinant estimate is found: start from
medians and quartiles, keep the share H of rows with the smallest distances, take mean and covariance of those, and
repeat until no group's determinant falls any more; of all steps the smallest determinant counts. A variance is raised to its
floor only where the group's own is below it. A last step scales the covariance so that the median distance is that of a chi-square. Texts whose squared
Mahalanobis distance is beyond the chi-square quantile CUT are rejected.

The rows are never gathered: a step is one histogram of distances and one set of moment sums per group, both
combined on the map side; one row per group is all that the matrix work sees.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisleframe.llm.hashing import Texts, as_bytes, chunked, mix
from aisleframe.llm.shared import stash

H = 0.75
STEPS = 30  # at most; some ten are usual
FALLS = 1e-3  # of the determinant's logarithm: a smaller fall is the end
CUT = 0.9999999
LEAST_ROWS = 100
SENT_BYTES = 8 << 20  # of models; more are joined by a shuffle
SALT = 64
TIERS = 32  # histogram steps for each factor e of a squared distance
#: Statistic vector and the smallest standard deviation each part is taken to have where a group has hardly any spread. With CUT, from a
#: median of 0, some 7 symbols in 100 words are then too many. A line that stands twice raises two parts, whose floors are larger:
#: one such line in a short text is no junk.
VECTOR = {"v_length": 0.15, "v_symbols": 0.3, "v_dup_lines": 0.5, "v_repeats": 0.6, "v_upper": 0.35, "v_points": 0.35}
NAMES = list(VECTOR)
D = len(NAMES)
PAIRS = [(i, j) for i in range(D) for j in range(i, D)]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_points")

_SYMBOLS = b"#*$%&|<>"
_POINTS = b"!\"'()+,-./:;=?@[\\]^_`{}~"
_NO_CHARACTER = bytes([9, 10, 11, 12, 13, 32, *range(0x80, 0xC0)])  # white space, and bytes that continue a character


def chi_square(p: float, d: int) -> float:
    """Quantile p of the chi-square with d degrees of freedom (Wilson and Hilferty's approximation)."""
    a = 2 / (9 * d)
    return d * (1 - a + NormalDist().inv_cdf(p) * a ** 0.5) ** 3


def _repeat_words(found: Texts) -> np.ndarray:
    """For each text, its words in 3-word windows that it holds twice or more."""
    h, at = found.windows(3)
    key = h ^ mix(found.of[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(found.hash) + 3, bool)
    for k in range(3):
        covered[at[twice] + k] = True
    return np.bincount(found.of[covered[: len(found.hash)]], minlength=len(found.counts))


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def _less(text: bytes, without: bytes) -> int:
    return len(text) - len(text.translate(None, without))


def _count(keep: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunked(batches):
            found = Texts(texts)
            counts = [
                found.counts, [len(t.translate(None, _NO_CHARACTER)) for t in texts], [_less(t, _SYMBOLS) for t in texts],
                [_dup_lines(t) for t in texts], _repeat_words(found),
                [_less(t, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") for t in texts], [_less(t, _POINTS) for t in texts]]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in keep], *[pa.array(x, pa.int64()) for x in counts]], names=[*keep, *COUNTS])
    return run


def statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """`keep` and the counts of each row's whole text; a null or empty text has none of anything."""
    types = {f.name: f.dataType.simpleString() for f in docs.select(*keep).schema}
    schema = ", ".join(f"`{n}` {t}" for n, t in {**types, **dict.fromkeys(COUNTS, "bigint")}.items())
    return docs.select(*keep, "text").mapInArrow(_count(list(keep)), schema)


def _vectors() -> list[Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    share = lambda c, of: F.log1p(F.lit(100.0) * F.col(c) / of)
    made = [F.log(chars / words), share("n_symbols", words), share("n_dup_lines", words), share("n_repeat_words", words),
            share("n_upper", chars), share("n_points", chars)]
    return [c.alias(n) for n, c in zip(NAMES, made, strict=True)]


def _distance() -> Column:
    """Squared Mahalanobis distance of a row joined with its group's mean (m_i) and inverse covariance (s_i_j)."""
    off = [F.col(n) - F.col(f"m_{i}") for i, n in enumerate(NAMES)]
    terms = [off[i] * off[j] * F.col(f"s_{i}_{j}") * (1 if i == j else 2) for i, j in PAIRS]
    return sum(terms[1:], terms[0])


def _tier() -> Column:
    return F.floor(F.log(F.greatest(_distance(), F.lit(1e-9))) * TIERS).cast("int")


_MODEL = ["group", "rows", "det", *[f"m_{i}" for i in range(D)], *[f"s_{i}_{j}" for i, j in PAIRS]]
_MODEL_TYPES = ", ".join(f"`{n}` " + ("string" if n == "group" else "bigint" if n == "rows" else "double") for n in _MODEL)


def _invert(pdfs):
    """One row per group: from count and moment sums to mean and inverse covariance."""
    for pdf in pdfs:
        rows = []
        for r in pdf.itertuples(index=False):
            mean = np.array([getattr(r, f"t_{i}") for i in range(D)]) / r.rows
            cov = np.empty((D, D))
            for i, j in PAIRS:
                cov[i, j] = cov[j, i] = getattr(r, f"u_{i}_{j}") / r.rows - mean[i] * mean[j]
            cov += np.diag([max(s * s - cov[i, i], 0.0) for i, s in enumerate(VECTOR.values())])
            inverse = np.linalg.inv(cov)
            rows.append((r.group, r.rows, float(np.linalg.slogdet(cov)[1]), *mean.tolist(), *[float(inverse[i, j]) for i, j in PAIRS]))
        yield type(pdf)(rows, columns=_MODEL)


def _moments(rows: DataFrame) -> DataFrame:
    sums = [F.sum(n).alias(f"t_{i}") for i, n in enumerate(NAMES)]
    sums += [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"u_{i}_{j}") for i, j in PAIRS]
    return rows.groupBy("group").agg(F.count("*").alias("rows"), *sums).mapInPandas(_invert, _MODEL_TYPES)


def _start(rows: DataFrame) -> DataFrame:
    """Median and quartile spread of each part, without correlations."""
    q = rows.groupBy("group").agg(
        F.count("*").alias("rows"), *[F.percentile_approx(n, [0.25, 0.5, 0.75], 1000).alias(n) for n in NAMES])
    cols = [F.col(n)[1].alias(f"m_{i}") for i, n in enumerate(NAMES)]
    for i, j in PAIRS:
        spread = (F.col(NAMES[i])[2] - F.col(NAMES[i])[0]) / 1.349
        value = 1 / F.greatest(spread * spread, F.lit(VECTOR[NAMES[i]] ** 2)) if i == j else F.lit(0.0)
        cols.append(value.alias(f"s_{i}_{j}"))
    return q.select("group", "rows", F.lit(float("inf")).alias("det"), *cols)


def _few(model: DataFrame) -> bool:
    """Whether the rows of a model, one for each group, take at most SENT_BYTES."""
    return (model.agg(F.sum(F.octet_length("group") + 8 * len(_MODEL))).first()[0] or 0) <= SENT_BYTES


def _with_model(rows: DataFrame, model: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """Rows with their group's model. Few groups go to every task; else a group's rows are dealt over SALT tasks. The rows are the same."""
    if few:
        return rows.join(F.broadcast(model), "group", how)
    dealt = rows.withColumn("salt", F.pmod(F.hash(*NAMES), F.lit(SALT)))
    each = model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return dealt.join(each, ["group", "salt"], how).drop("salt")


def _quantile_tier(rows: DataFrame, model: DataFrame, share: float, few: bool) -> DataFrame:
    """(group, tier): the histogram tier up to which the given share of the group's rows lies."""
    tiers = _with_model(rows, model, few).select("group", _tier().alias("tier")).groupBy("group", "tier").agg(F.count("*").alias("k"))
    order = Window.partitionBy("group").orderBy("tier")
    whole = Window.partitionBy("group")
    below = F.sum("k").over(order) - F.col("k")
    return tiers.select("group", "tier", below.alias("below"), F.sum("k").over(whole).alias("n")) \
        .filter(F.col("below") < F.col("n") * share).groupBy("group").agg(F.max("tier").alias("last"))


def estimates(vectors: DataFrame, h: float = H, steps: int = STEPS) -> DataFrame:
    """Mean and inverse covariance of each group of vectors (group, v_*), one row per group."""
    model = stash(_start(vectors))
    few = _few(model)
    for _ in range(steps):
        limits = stash(model.join(_quantile_tier(vectors, model, h, few), "group"))
        inner = _with_model(vectors, limits, few).filter(_tier() <= F.col("last")).select("group", *NAMES)
        step = _moments(inner).select("group", F.struct(*_MODEL[2:]).alias("new"))
        falls = F.col("new.det") < F.col("det") - FALLS
        better = [F.when(falls, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in _MODEL[2:]]
        model = stash(model.join(step, "group").select("group", "rows", *better, falls.alias("fell")))
        fell = model.filter("fell").limit(1).count()
        model = model.drop("fell")
        if not fell:
            break
    middle = _quantile_tier(vectors, model, 0.5, few)
    # never narrower than estimated: a group of nearly equal texts keeps its floors
    factor = F.greatest(F.exp((F.col("last") + 0.5) / TIERS) / chi_square(0.5, D), F.lit(1.0))
    scaled = [(F.col(f"s_{i}_{j}") / factor).alias(f"s_{i}_{j}") for i, j in PAIRS]
    return stash(model.join(middle, "group").select("group", "rows", "det", *[f"m_{i}" for i in range(D)], *scaled))


def _groups() -> list[Column]:
    """The groups a row belongs to, the narrowest first: language and source, language, all."""
    lang, source = F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))
    return [F.concat(F.lit("2 "), lang, F.lit("\x01"), source), F.concat(F.lit("1 "), lang), F.lit("0")]


def quality_verdicts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), cut: float = CUT, least_rows: int = LEAST_ROWS) -> DataFrame:
    """A row for each row of docs (doc_id, text, lang, source): `keep`, its counts, base_failed, kept and distance.

    base_failed: fewer than 50 words, or more than half of the words in 3-word windows that the text repeats. kept is false
    for these and for outliers of the robust estimate of their language and source; a group with fewer than `least_rows`
    texts that pass the plain rules uses that of its language, then that of all texts, and with no estimate at all the text
    stays. Null or empty texts have no words and fail; null lang or source is a group like any other. distance is null
    where the plain rules failed. Rows that repeat are judged alike. Other columns of docs are not looked at.
    """
    named = docs.select(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)], "lang", "source", "text")
    plain = statistics(named, (*[f"keep_{i}" for i in range(len(keep))], "lang", "source"))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    plain = stash(plain.withColumn("base_failed", failed))
    vectors = plain.filter("not base_failed").select(F.explode(F.array(*_groups())).alias("group"), *_vectors())
    models = estimates(vectors).filter(F.col("rows") >= F.when(F.col("group") == "0", 1).otherwise(least_rows))
    few = _few(models)
    judged = plain.select("*", *_vectors())
    options = []
    for i, group in enumerate(_groups()):
        model = models.filter(F.col("group").startswith(str(2 - i)))
        judged = _with_model(judged.withColumn("group", group), model, few, "left")
        judged = judged.withColumn(f"d_{i}", _distance()).drop(*_MODEL)
        options.append(F.col(f"d_{i}"))
    distance = F.when(~F.col("base_failed"), F.coalesce(*options))
    kept = ~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= chi_square(cut, D))
    return judged.select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", kept.alias("kept"), distance.alias("distance"))
