"""Calendar, stores, promotion baselines and stock-out flags.

Daily sales have one row per store, item and day, so a window over one store and item sees at most one row
per calendar day, however many raw lines a hot pair has: those are added up, with map-side combine, before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aisleframe.config import BuildConfig
from aisleframe.functions.columns import by_month, date_key, day_number, is_true, tasks_for


def dim_date(sales: DataFrame, store_days: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per day from the first to the last day of sales or receipts."""
    ends = (
        sales.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
        .unionByName(store_days.agg(F.min("date").alias("lo"), F.max("date").alias("hi")))
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )
    days = ends.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    marked = days.join(holidays.select("date", F.lit(True).alias("hit")), "date", "left")
    weekday = F.weekday("date") + 1
    return marked.select(
        date_key("date").alias("date_key"), "date",
        F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month_num"),
        F.date_format("date", "MMM").alias("month_name"),
        (F.year("date") * 100 + F.month("date")).alias("month_key"),
        F.weekofyear("date").alias("iso_week"), F.extract(F.lit("YEAROFWEEK"), "date").alias("iso_year"),
        weekday.alias("weekday_num"), F.date_format("date", "E").alias("weekday_name"),
        (weekday >= 6).alias("is_weekend"),
        is_true(F.col("hit")).alias("is_national_holiday"),
    )


def stg_store(stores: DataFrame, transactions: DataFrame, selected: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Stores that ever had receipts. A store already trading when the data starts has no known opening date."""
    first = transactions.groupBy("store_nbr").agg(F.min("date").alias("first_day"))
    data_start = transactions.agg(F.min("date").alias("start")).scalar()
    known = F.col("first_day") > F.date_add(data_start, cfg.opening_grace_days)
    opened = first.select("store_nbr", F.when(known, F.col("first_day")).alias("opening_date"))
    kept = stores.join(selected, "store_nbr", "left_semi") if cfg.sample else stores
    return kept.join(opened, "store_nbr").select(
        F.col("store_nbr").alias("store_key"), "store_nbr", "city", "state", F.col("type").alias("store_type"),
        "cluster", "opening_date")


def trading_days(store_days: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Per store and trading day: trading days in the lookback before it, and whether it was a full day.

    A day is full if its receipts reach the given share of the store's trailing mean; a first day has no mean.
    """
    before = W.partitionBy("store_nbr").orderBy(day_number("date")).rangeBetween(-cfg.lookback_days, -1)
    return (
        store_days.filter(F.col("receipts") > 0)
        .withColumn("trading_days", F.count(F.lit(1)).over(before))
        .withColumn("full_day", F.col("receipts") >= F.lit(cfg.min_receipts_share) * F.avg("receipts").over(before))
        .select("store_nbr", "date", "receipts", "trading_days", "full_day")
    )


def sales_lookback(sales: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Daily sales with what happened in the days before, per store and item. One shuffle, one sort."""
    pair = W.partitionBy("store_nbr", "item_nbr")
    by_day = pair.orderBy(day_number("date"))
    lookback = by_day.rangeBetween(-cfg.lookback_days, -1)
    recent = by_day.rangeBetween(-cfg.post_promo_days, -1)
    promo = is_true(F.col("on_promo"))
    return sales.select(
        "date", "store_nbr", "item_nbr", "units", "return_units", "on_promo",
        F.sum(F.when(promo, 0.0).otherwise(F.col("units"))).over(lookback).alias("base_units_sum"),
        F.count_if(promo).over(lookback).alias("promo_days_in_lookback"),
        F.count_if(promo).over(recent).alias("promo_days_recent"),
        # the rows are already sorted by day: the first day is a running minimum, no second pass
        F.min("date").over(by_day.rowsBetween(W.unboundedPreceding, 0)).alias("first_sale"),
    ).withColumn(
        "post_promo_window", ~is_true(F.col("on_promo")) & (F.col("promo_days_recent") > 0)
    ).withColumn(
        "has_full_history", F.datediff("date", "first_sale") >= cfg.lookback_days
    )


def fact_sales(sales: DataFrame, trading: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Sales with the promotion baseline: usual units per trading day, on promotion and post-promotion rows only.

    Sales meet their store's trading day in the shuffle that deals the fact out by month and slice of stores, as facts are
    stored: both are stacked, and a window over one store and day hands its trading days to the sales.
    """
    judged = (is_true(F.col("on_promo")) | F.col("post_promo_window")) & F.col("has_full_history")
    rows = sales_lookback(sales, cfg).select(
        "date", "store_nbr", "item_nbr", "units", "return_units", "on_promo", "post_promo_window",
        F.when(judged, F.coalesce("base_units_sum", F.lit(0.0))).alias("base_units"),
        F.when(judged, F.col("promo_days_in_lookback")).alias("promo_days"), F.lit(True).alias("sold"))
    stacked = rows.unionByName(trading.select("store_nbr", "date", "trading_days"), allowMissingColumns=True)
    dealt = by_month(stacked, F.year("date") * 100 + F.month("date"), ["store_nbr"], tasks_for(sales))
    days = F.max("trading_days").over(W.partitionBy("_month", "_slice", "store_nbr", "date"))
    usual = F.try_divide("base_units", (F.col("trading_days") - F.col("promo_days")).cast("double"))
    return dealt.withColumn("trading_days", days).filter("sold").select(
        date_key("date").alias("date_key"), F.col("store_nbr").alias("store_key"), F.col("item_nbr").alias("item_key"),
        "units", "return_units", "on_promo", "post_promo_window", usual.alias("baseline_units"))


def stockout_pairs(sales: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Store-item pairs that could reach the expected-units threshold at all, with their selling span."""
    since = F.date_sub(F.lit(cfg.stockout_from), 2 * cfg.lookback_days)
    return (
        sales.filter(F.col("date") >= since).groupBy("store_nbr", "item_nbr")
        .agg(F.min("date").alias("first_sale"), F.max("date").alias("last_sale"), F.sum("units").alias("units"))
        .filter(F.col("units") >= cfg.min_expected_units * cfg.lookback_days)
        .select("store_nbr", "item_nbr", "first_sale", "last_sale")
    )


def stockout_spine(pairs: DataFrame, trading: DataFrame) -> DataFrame:
    """Every trading day of the pair's store inside the selling span.

    The span is unrolled per pair and matched on (store, date): a chain with few stores, or one that holds a
    third of all pairs, still spreads over all tasks, which a join on the store alone would not.
    """
    days = pairs.select("store_nbr", "item_nbr", F.explode(F.sequence("first_sale", "last_sale")).alias("date"))
    return days.join(trading.select("store_nbr", "date", "full_day"), ["store_nbr", "date"])


def stockout_series(spine: DataFrame, sales: DataFrame, cfg: BuildConfig) -> DataFrame:
    """The spine with the day's units; a day without a sales row has zero units."""
    # no spine day lies before this, so older sales need not be shuffled
    since = F.date_sub(F.lit(cfg.stockout_from), 2 * cfg.lookback_days)
    sold = sales.filter(F.col("date") >= since).select(
        "store_nbr", "item_nbr", "date", F.col("units").alias("sold_units"), F.lit(True).alias("has_row"))
    return spine.join(sold, ["store_nbr", "item_nbr", "date"], "left").select(
        "store_nbr", "item_nbr", "date", "full_day",
        F.coalesce("sold_units", F.lit(0.0)).alias("units"), F.col("has_row").isNull().alias("no_sale_row"))


def score_series(series: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Expected daily units from the previous rows, history length and days with sales in the next days."""
    by_day = W.partitionBy("store_nbr", "item_nbr").orderBy(day_number("date"))
    previous = by_day.rowsBetween(-cfg.lookback_days, -1)
    coming = by_day.rangeBetween(1, cfg.lookback_days)
    return series.select(
        "*",
        F.avg("units").over(previous).alias("lambda_units"),
        F.count(F.lit(1)).over(previous).alias("history_days"),
        F.count_if(F.col("units") > 0).over(coming).alias("future_sales"),
    )


def fact_stockout_risk(series: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Full trading days without a sale of an item that usually sells and sells again afterwards."""
    flagged = (
        (F.col("date") >= F.lit(cfg.stockout_from)) & F.col("full_day") & F.col("no_sale_row")
        & (F.col("history_days") == cfg.lookback_days) & (F.col("lambda_units") >= cfg.min_expected_units)
        & (F.col("future_sales") > 0)
    )
    return score_series(series, cfg).filter(flagged).select(
        date_key("date").alias("date_key"), F.col("store_nbr").alias("store_key"), F.col("item_nbr").alias("item_key"),
        F.round("lambda_units", 2).alias("expected_units"))
