"""Zero-sale runs with their tests, promotion events and family summaries.

The report model only fixes the columns of these tables; the formulas are stated with each function.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aisleframe.config import BuildConfig
from aisleframe.functions.columns import date_key, day_number, is_true, join_null_safe
from aisleframe.functions.ranks import exact_median, fixed4, step_up_cut

PAIR = ["store_nbr", "item_nbr"]


def scored_days(series: DataFrame, cfg: BuildConfig) -> DataFrame:
    """The zero-filled series with a run id and the sums over the previous rows. One shuffle by pair."""
    by_day = W.partitionBy(*PAIR).orderBy(day_number("date"))
    previous = by_day.rowsBetween(-cfg.lookback_days, -1)
    so_far = by_day.rowsBetween(W.unboundedPreceding, 0)
    return series.select(
        *PAIR, "date", "full_day", "no_sale_row", "units",
        # rows without a sale between two sales share the number of sales so far: that number is the run's id
        F.count_if(~F.col("no_sale_row")).over(so_far).alias("run_id"),
        F.count(F.lit(1)).over(previous).alias("history_days"),
        F.sum("units").over(previous).alias("prior_sum"),
        F.sum(F.col("units") * F.col("units")).over(previous).alias("prior_squares"),
    )


def zero_sale_runs(series: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Zero-sale runs per pair, with the rate and dispersion of the rows before the run.

    A run counts its full trading days; partial days neither end nor lengthen it. Tested are runs that start
    on or after the stock-out cut-off with a whole history of positive mean. With mean m and sample variance
    v of the history, dispersion a = max((v - m) / m^2, 0).
    """
    days = F.lit(cfg.lookback_days)
    runs = (
        scored_days(series, cfg).filter(F.col("no_sale_row"))
        .groupBy(*PAIR, "run_id")
        .agg(
            F.min(F.when(F.col("full_day"), F.col("date"))).alias("start_date"),
            F.max(F.when(F.col("full_day"), F.col("date"))).alias("end_date"),
            F.count_if(F.col("full_day")).alias("run_days"),
            F.count(F.lit(1)).alias("spine_days"),
            F.min_by(F.struct("history_days", "prior_sum", "prior_squares"), "date").alias("before"),
        )
        .filter(
            (F.col("run_days") > 0) & (F.col("start_date") >= F.lit(cfg.stockout_from))
            & (F.col("before.history_days") == days) & (F.col("before.prior_sum") > 0))
    )
    mean = F.col("before.prior_sum") / days
    variance = (F.col("before.prior_squares") - F.col("before.prior_sum") * F.col("before.prior_sum") / days) / (days - 1)
    excess = F.greatest((variance - mean) / (mean * mean), F.lit(0.0))
    return runs.select(
        *PAIR, "start_date", "end_date", "run_days", "spine_days",
        (F.datediff("end_date", "start_date") + 1).cast("bigint").alias("calendar_days"),
        mean.alias("lambda_units"), excess.alias("dispersion"))


def poisson_p(rate: Column, days: Column) -> Column:
    """Chance of no sale in so many days at a Poisson rate."""
    return F.exp(-rate * days)


def negative_binomial_p(rate: Column, dispersion: Column, days: Column) -> Column:
    """Chance of no sale in so many days: (1 + a m)^(-n / a), the Poisson chance where a is 0."""
    overdispersed = F.exp(-days / dispersion * F.log(F.lit(1.0) + dispersion * rate))
    return F.when(dispersion > 0, overdispersed).otherwise(poisson_p(rate, days))


def run_tests(runs: DataFrame) -> DataFrame:
    rate, spread, days = F.col("lambda_units"), F.col("dispersion"), F.col("run_days")
    return runs.select(
        "*",
        negative_binomial_p(rate, spread, days).alias("p_value"),
        poisson_p(rate, days).alias("p_poisson"),
        (rate * days).alias("expected_lost_units"),
    )


def flag_runs(tested: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Runs at or below the cut-off p-value of the false discovery rate. ``tested`` should be a written table."""
    cutoff = step_up_cut(tested, "p_value", cfg.false_discovery_rate)["cutoff"]
    hit = F.lit(False) if cutoff is None else F.coalesce(F.col("p_value") <= F.lit(cutoff), F.lit(False))
    return tested.withColumn("is_flagged", hit)


def fact_stockout_run(flagged: DataFrame) -> DataFrame:
    return flagged.select(
        F.col("store_nbr").alias("store_key"), F.col("item_nbr").alias("item_key"),
        date_key("start_date").alias("start_date_key"), date_key("end_date").alias("end_date_key"),
        "run_days", "spine_days", "calendar_days", "lambda_units", "dispersion", "p_value", "p_poisson",
        "expected_lost_units", "is_flagged")


def test_summary(tested: DataFrame, cfg: BuildConfig) -> DataFrame:
    """One row: runs tested, flagged by either test, the cut-off and the flags chance alone could give there."""
    spark = tested.sparkSession
    nb = step_up_cut(tested, "p_value", cfg.false_discovery_rate)
    poisson = step_up_cut(tested, "p_poisson", cfg.false_discovery_rate)
    chance = None if nb["cutoff"] is None else nb["cutoff"] * nb["tested"]
    return spark.createDataFrame(
        [(nb["tested"], nb["flagged"], nb["cutoff"], chance, poisson["flagged"])],
        "tested_runs bigint, flagged_runs bigint, bh_cutoff double, max_chance_flags double, poisson_flagged_runs bigint")


def store_weeks(series: DataFrame, flagged: DataFrame, trading: DataFrame, stores: DataFrame,
                cfg: BuildConfig) -> DataFrame:
    """Per store and week (from Monday): tested item-days, and those inside a flagged run.

    Tested is every full trading day of a pair with a whole history from the cut-off on. Flagged days come
    from unrolling the flagged runs, so the long series is read once.
    """
    by_day = W.partitionBy(*PAIR).orderBy(day_number("date"))
    week = F.trunc("date", "WEEK").alias("week_start")
    tested = (
        series.withColumn("nth", F.row_number().over(by_day))
        .filter((F.col("nth") > cfg.lookback_days) & (F.col("date") >= F.lit(cfg.stockout_from)) & F.col("full_day"))
        .groupBy("store_nbr", week).agg(F.count(F.lit(1)).alias("item_days"))
    )
    inside = (
        flagged.filter("is_flagged")
        .select("store_nbr", F.explode(F.sequence("start_date", "end_date")).alias("date"))
        .groupBy("store_nbr", "date").agg(F.count(F.lit(1)).alias("runs"))
        .join(trading.filter("full_day").select("store_nbr", "date"), ["store_nbr", "date"])
        .groupBy("store_nbr", week).agg(F.sum("runs").alias("flagged_days"))
    )
    days = F.coalesce("flagged_days", F.lit(0))
    return (
        tested.join(inside, ["store_nbr", "week_start"], "left")
        .join(stores.select(F.col("store_key").alias("store_nbr"), "city"), "store_nbr", "left")
        .select(
            F.col("store_nbr").alias("store_key"), "city", "week_start", date_key("week_start").alias("week_start_key"),
            "item_days", days.alias("flagged_days"), F.try_divide(days, "item_days").alias("rate"))
    )


def promo_events(fact: DataFrame, dates: DataFrame, items: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Consecutive promotion days of a pair, compared with the baseline, and the days after.

    PU, PB: units and baseline of the event's days with a positive baseline; QU, QB: the same over
    post-promotion days in the following week. uplift = PU/PB - 1, post dip = QU/QB - 1,
    net lift = (PU+QU)/(PB+QB) - 1, the last two blank if another promotion falls into that week.
    An event touches payday or a holiday if one of its days is the 15th, a month's last day or a holiday.
    """
    day = F.col("date")
    rows = fact.join(dates.select("date_key", "date", "is_national_holiday"), "date_key").select(
        "store_key", "item_key", "date", is_true(F.col("on_promo")).alias("promo"), "post_promo_window",
        F.when(F.col("baseline_units") > 0, F.col("baseline_units")).alias("usual"),
        F.when(F.col("baseline_units") > 0, F.col("units")).alias("sold"),
        ((F.dayofmonth(day) == 15) | (day == F.last_day(day)) | F.col("is_national_holiday")).alias("special"))
    by_day = W.partitionBy("store_key", "item_key").orderBy(day_number("date"))
    after = by_day.rangeBetween(1, cfg.post_promo_days)
    post = F.col("post_promo_window")
    windowed = rows.select(
        "*",
        F.date_sub("date", F.count_if("promo").over(by_day.rowsBetween(W.unboundedPreceding, 0)).cast("int")).alias("island"),
        F.struct(
            F.sum(F.when(post, F.col("sold"))).over(after).alias("units"),
            F.sum(F.when(post, F.col("usual"))).over(after).alias("expected"),
            F.count_if("promo").over(after).alias("promos"),
        ).alias("after"),
    )
    events = (
        windowed.filter("promo").groupBy("store_key", "item_key", "island")
        .agg(
            F.min("date").alias("start_date"), F.max("date").alias("end_date"),
            F.count(F.lit(1)).alias("promo_days"),
            F.sum("sold").alias("promo_units"), F.sum("usual").alias("baseline_units"),
            F.max_by("after", "date").alias("after"), F.bool_or("special").alias("touches_payday_or_holiday"),
        )
    )
    alone = F.col("after.promos") == 0
    post_units = F.when(alone, F.col("after.units"))
    post_expected = F.when(alone, F.col("after.expected"))
    return (
        events.join(items.select("item_key", "family"), "item_key", "left")
        .select(
            "store_key", "item_key", "family",
            date_key("start_date").alias("start_date_key"), date_key("end_date").alias("end_date_key"),
            "promo_days", "promo_units", "baseline_units",
            F.try_divide(F.col("promo_units") - F.col("baseline_units"), "baseline_units").alias("uplift"),
            post_units.alias("post_units"), post_expected.alias("post_expected_units"),
            F.try_divide(post_units - post_expected, post_expected).alias("post_dip"),
            (F.try_divide(F.col("promo_units") + post_units, F.col("baseline_units") + post_expected) - 1).alias("net_lift"),
            "touches_payday_or_holiday")
    )


# The minimal standard random generator: multiplicative, modulo a Mersenne prime.
GENERATOR, MODULUS = 48_271, 2**31 - 1
METRICS = ("uplift", "dip", "net")


def poisson_steps() -> list[int]:
    """Ends of the Poisson(1) distribution on the generator's scale: a number above the n-th end draws more than n.

    They go on until no number is left above: the tail beyond is smaller than one step of the generator.
    """
    ends, total = [], 0.0
    while not ends or ends[-1] < MODULUS - 1:
        total += math.exp(-1) / math.factorial(len(ends))
        ends.append(round(total * MODULUS))
    return ends


def generator_steps(count: int) -> list[int]:
    """Factors from a seed to the first, second, ... number of its random stream."""
    return [pow(GENERATOR, n, MODULUS) for n in range(1, count + 1)]


def replicate_weights(events: DataFrame, replicates: int) -> DataFrame:
    """Events repeated per bootstrap replicate with a Poisson(1) weight; rows of weight 0 are left out.

    Each event has its own random stream, seeded by a digest of its keys; replicate r takes the stream's r-th
    number. A rerun or a retried task therefore draws the same sample, at the cost of one digest per event.
    """
    keys = ["store_key", "item_key", "start_date_key"]
    digest = F.conv(F.substring(F.md5(F.concat_ws(":", *keys)), 1, 8), 16, 10).cast("bigint")
    factors = F.array(*[F.lit(step).cast("bigint") for step in generator_steps(replicates)])
    weight = sum(((F.col("number") > end).cast("int") for end in poisson_steps()), F.lit(0))
    others = [c for c in events.columns if c not in keys]
    # rows multiply by the number of replicates here, so even a small table is first spread over all tasks
    spread = events.repartition(int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    return (
        spread.select(*others, (digest % (MODULUS - 1) + 1).alias("seed"))
        .select(*others, "seed", F.posexplode(factors).alias("replicate", "factor"))
        .select(*others, "replicate", (F.col("seed") * F.col("factor") % MODULUS).alias("number"))
        .select(*others, "replicate", weight.alias("weight"))
        .filter("weight > 0")
    )


def _per_metric(events: DataFrame) -> DataFrame:
    """The three event values under each other: ``series`` (three per family), v, and what else is there."""
    stacked = F.inline(F.array(*[
        F.struct((F.col("family_no") * len(METRICS) + i).alias("series"), F.col(m).alias("v"))
        for i, m in enumerate(METRICS)]))
    others = [c for c in events.columns if c not in (*METRICS, "family_no")]
    return events.select(*others, stacked).filter(F.col("v").isNotNull())


def promo_family_summary(events: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Per family: events and the medians of uplift, dip and net lift with bootstrap 95% intervals.

    The interval's ends are the 2.5% and 97.5% points of the medians of the bootstrap replicates.
    """
    # families are numbered, so the many replicate rows carry a small number instead of a name
    families = events.select("family").distinct().withColumn(
        "family_no", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("family")))
    values = join_null_safe(events, families, ["family"]).select(
        F.coalesce("family_no", F.lit(0)).alias("family_no"), "store_key", "item_key", "start_date_key",
        fixed4(F.col("uplift")).alias("uplift"), fixed4(F.col("post_dip")).alias("dip"),
        fixed4(F.col("net_lift")).alias("net"))
    known = _per_metric(values.select("family_no", *METRICS))
    centre = exact_median(known, ["series"], "v", "median")
    sizes = known.groupBy("series").agg(F.count(F.lit(1)).alias("n"))
    drawn = replicate_weights(_per_metric(values), cfg.bootstrap_replicates)
    medians = exact_median(drawn, ["series", "replicate"], "v", "m", weight="weight")
    # at most one row per replicate in each group
    ends = medians.groupBy("series").agg(
        F.percentile("m", F.lit(0.025)).alias("lo"), F.percentile("m", F.lit(0.975)).alias("hi"))
    by_metric = (
        sizes.join(centre, "series", "left").join(ends, "series", "left")
        .withColumn("family_no", F.expr(f"series div {len(METRICS)}"))
        .withColumn("metric", F.element_at(F.array(*map(F.lit, METRICS)), F.col("series") % len(METRICS) + 1))
        .join(families, "family_no")
    )

    def pick(metric: str, column: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(column)))

    columns = [pick(m, part).alias(f"{m}_{part}") for m in METRICS for part in ("median", "lo", "hi")]
    summary = by_metric.groupBy("family").agg(
        *[F.coalesce(pick(m, "n"), F.lit(0)).alias(name)
          for m, name in zip(METRICS, ("n_events", "n_dip_events", "n_net_events"))],
        *columns)
    return summary.select(
        "family", "n_events", "uplift_median", "uplift_lo", "uplift_hi", "n_dip_events", "dip_median", "dip_lo",
        "dip_hi", "n_net_events", "net_median", "net_lo", "net_hi")
