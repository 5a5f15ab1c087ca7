"""Exact order statistics without sorting a whole group in one task.

Values are put into coarse buckets, the buckets are counted with map-side combine, and only the running
totals of the (few) buckets pass through a window. Rows are then ranked inside their own bucket, or only in
the bucket that holds the wanted rank. Nothing depends on sampling, so a retried task gives the same answer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aisleframe.functions.columns import join_null_safe

SCALE = 10_000  # values are compared at four decimals, as the report tables store them


BUCKET_WIDTH = 4_096


# far above the noise of a double sum, far below a ten-thousandth: a half rounds up however its sum was ordered
HALF = 0.5 + 1e-6


def fixed4(value: Column) -> Column:
    """A double as a whole number of ten-thousandths, halves up."""
    return F.floor(value * SCALE + HALF).cast("bigint")


MEDIAN_RANKS = {"lo": "(n + 1) div 2", "hi": "n div 2 + 1"}


def order_statistics(df: DataFrame, by: list[str], value: str, ranks: dict[str, str], weight: str | None = None) -> DataFrame:
    """The values at wanted ranks of every group.

    ``value`` is a bigint column; ``ranks`` names SQL expressions of the group's size ``n``, counted from 1 over
    the multiset in which a value appears ``weight`` times. Returns ``by`` + (name, value).

    Two passes over ``df``: the first ships one count per group and bucket, the second only the values of the
    buckets that hold a wanted rank, already counted per value. Neither a hot group nor a hot value meets in one task.
    """
    freq = F.sum(weight) if weight else F.count(F.lit(1))
    # filtered before, so the default is never used; it marks the column as never NULL for the join
    bucketed = df.filter(F.col(value).isNotNull()).withColumn(
        "_bucket", F.coalesce(F.floor(F.col(value) / F.lit(BUCKET_WIDTH)), F.lit(0).cast("bigint")))
    group = W.partitionBy(*(by or [F.lit(0)]))
    upto = group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    buckets = (
        bucketed.groupBy(*by, "_bucket").agg(freq.alias("_in_bucket"))
        .withColumn("_end", F.sum("_in_bucket").over(upto))
        .withColumn("n", F.sum("_in_bucket").over(group))
    )
    start, end = F.col("_end") - F.col("_in_bucket"), F.col("_end")
    options = F.array(*[F.struct(F.lit(name).alias("name"), F.expr(rank).alias("rank")) for name, rank in ranks.items()])
    inside = F.filter(options, lambda option: (option["rank"] > start) & (option["rank"] <= end))
    wanted = (
        buckets.select(*by, "_bucket", start.alias("_start"), inside.alias("_ranks"))
        .filter(F.size("_ranks") > 0)
    )
    near = (
        join_null_safe(bucketed, wanted.select(*by, "_bucket"), [*by, "_bucket"], "left_semi")
        .groupBy(*by, "_bucket", F.col(value).alias("_value")).agg(freq.alias("_n"))
    )
    running = W.partitionBy(*by, "_bucket").orderBy("_value").rowsBetween(W.unboundedPreceding, 0)
    return (
        join_null_safe(near.withColumn("_upto", F.sum("_n").over(running)), wanted, [*by, "_bucket"])
        .select(*by, "_value", (F.col("_start") + F.col("_upto")).alias("_upto"), F.inline("_ranks"))
        .filter(F.col("_upto") >= F.col("rank"))
        .groupBy(*by, "name").agg(F.min("_value").alias("value"))
    )


def exact_median(df: DataFrame, by: list[str], value: str, alias: str, weight: str | None = None) -> DataFrame:
    """Interpolated median of a bigint (ten-thousandths) column per group, as a double."""
    found = order_statistics(df, by, value, MEDIAN_RANKS, weight)
    return found.groupBy(*by).agg((F.avg("value") / SCALE).alias(alias))


def step_up_cut(df: DataFrame, p_value: str, rate: float) -> dict:
    """The Benjamini-Hochberg cut of all rows: tested rows, flagged rows and the cut-off p-value.

    With m tests, a p-value can only pass at rank k if k >= ceil(p * m / rate), so the step-up rule is the
    largest k with at least k such thresholds <= k. Thresholds are counted in two levels of about sqrt(m)
    buckets, so no window sees more than sqrt(m) rows, whatever m is.
    """
    tested = df.filter(F.col(p_value).isNotNull())
    m = tested.count()
    if m == 0:
        return {"tested": 0, "flagged": 0, "cutoff": None}
    width = max(1, math.isqrt(m))
    need = F.greatest(F.ceil(F.col(p_value) * F.lit(float(m)) / F.lit(rate)), F.lit(1)).cast("bigint")
    # p above the rate can pass at no rank
    counted = (
        tested.filter(F.col(p_value) <= rate).groupBy(need.alias("need"))
        .agg(F.count(F.lit(1)).alias("n"), F.max(p_value).alias("top"))
        .withColumn("bucket", F.floor(F.col("need") / F.lit(width)))
    )
    whole = W.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counted.groupBy("bucket").agg(F.sum("n").alias("n")).select(
        F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("before"))
    inside = W.partitionBy("bucket").orderBy("need").rowsBetween(W.unboundedPreceding, 0)
    cut = (
        counted.join(offsets, F.col("bucket") == F.col("b"))
        .withColumn("upto", F.col("before") + F.sum("n").over(inside))
        .filter(F.col("upto") >= F.col("need"))
        .agg(F.max("upto").alias("flagged"), F.max("top").alias("cutoff"))
        .first()
    )
    return {"tested": m, "flagged": int(cut["flagged"] or 0), "cutoff": cut["cutoff"]}
