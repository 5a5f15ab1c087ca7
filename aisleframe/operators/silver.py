"""Cleaning: store selection, daily sales, receipts, national holidays, staged dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aisleframe.config import BuildConfig
from aisleframe.functions.columns import date_key

# Holiday types that close or change a trading day nationwide.
HOLIDAY_TYPES = ("Holiday", "Transfer", "Additional", "Bridge")


def select_stores(stores: DataFrame, transactions: DataFrame, cfg: BuildConfig) -> DataFrame:
    """All stores, or in a sample build the busiest few of each sample city."""
    if not cfg.sample:
        return stores.select("store_nbr")
    in_cities = stores.filter(F.col("city").isin(*cfg.sample_cities))
    volume = (
        transactions.filter(F.col("date") >= F.lit(cfg.volume_from))
        .groupBy("store_nbr").agg(F.sum("transactions").alias("receipts"))
    )
    busiest = W.partitionBy("city").orderBy(F.coalesce("receipts", F.lit(0)).desc(), F.col("store_nbr"))
    return (
        in_cities.join(volume, "store_nbr", "left")
        .withColumn("place", F.row_number().over(busiest))
        .filter(F.col("place") <= cfg.sample_per_city)
        .select("store_nbr")
    )


def clean_sales(train: DataFrame, selected: DataFrame, cfg: BuildConfig) -> DataFrame:
    """One row per date, store and item: sold and returned units apart, the promotion flag three-valued."""
    sold = F.col("unit_sales")
    kept = train.filter(F.col("date") >= F.lit(cfg.start_date)).join(selected, "store_nbr", "left_semi")
    return kept.groupBy("date", "store_nbr", "item_nbr").agg(
        F.sum(F.greatest(sold, F.lit(0.0))).alias("units"),
        F.sum(F.greatest(-sold, F.lit(0.0))).alias("return_units"),
        F.bool_or("onpromotion").alias("on_promo"),
    )


def store_day(transactions: DataFrame, selected: DataFrame, cfg: BuildConfig) -> DataFrame:
    kept = transactions.filter(F.col("date") >= F.lit(cfg.start_date)).join(selected, "store_nbr", "left_semi")
    return kept.select("date", "store_nbr", F.col("transactions").alias("receipts"))


def national_holidays(events: DataFrame) -> DataFrame:
    national = (F.col("locale") == "National") & F.col("type").isin(*HOLIDAY_TYPES) & ~F.col("transferred")
    return events.filter(national).select("date").distinct()


def stg_item(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("item_nbr").alias("item_key"), "item_nbr", "family", "class",
        (F.col("perishable") == 1).alias("is_perishable"))


def stg_store_day(days: DataFrame) -> DataFrame:
    return days.select(date_key("date").alias("date_key"), F.col("store_nbr").alias("store_key"), "receipts")
