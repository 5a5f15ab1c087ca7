"""The layers as written tables.

Each table is one lazy DataFrame; tables that several others read are written to the work folder as Parquet
first, so later plans start from a file with known size and nothing is computed twice. A lost executor costs
only its own tasks: written tables need no lineage.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleframe.config import BuildConfig
from aisleframe.operators import conform, deepdive, gold, silver, targets
from aisleframe.session import starting_partitions

#: The partition column of facts: the month of their day, as year * 100 + month.
FACT_MONTH = "fact_month"
GOLD_TABLES = ("dim_date", "stg_store", "stg_item", "stg_store_day", "fact_sales", "fact_stockout_risk")


class Warehouse:
    """Tables of one build. ``inputs`` offers the raw files and master data as DataFrames, one method each."""

    # cheap or read once: kept as a plan
    UNWRITTEN = {"store_day", "stg_store_day", "national_holidays", "region", "state_region", "stg_item"}

    # one folder per month, sorted by day inside each file: a report over a few days opens the files of their months
    BY_DATE = {"fact_sales", "fact_store_day", "fact_stockout_risk"}

    # facts whose own shuffle has brought the rows of a month together
    BY_MONTH = {"fact_sales", "fact_store_day"}

    # read by several windows over the same keys: bucketed by them, so that no window shuffles the table again
    BUCKETED = {"series": (["store_nbr", "item_nbr"], "date")}

    def __init__(self, spark: SparkSession, inputs, folder: str, cfg: BuildConfig, domain: str = "chain.example",
                 manager_city: str | None = None, access_since: int = 20160101):
        self.spark, self.inputs, self.folder, self.cfg = spark, inputs, folder.rstrip("/"), cfg
        self.domain, self.access_since = domain, access_since
        self.manager_city = manager_city or cfg.sample_cities[0]
        self._ready: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A table with the columns of the model."""
        stored = self.stored(name)
        return stored.drop(FACT_MONTH) if name in self.BY_DATE else stored

    def stored(self, name: str) -> DataFrame:
        """A table as it is stored: facts also have the month that their folders are named by."""
        if name not in self._ready:
            plan = getattr(self, f"_{name}")()
            if name in self.BUCKETED:
                plan = self._bucketed(name, plan)
            elif name not in self.UNWRITTEN:
                plan = self._written(name, plan)
            self._ready[name] = plan
        return self._ready[name]

    def _written(self, name: str, plan: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        if name in self.BY_DATE:
            # rebalancing gives every month few files of a fit size, and splits a month that holds too much for one
            plan = plan.withColumn(FACT_MONTH, F.expr("cast(date_key div 100 as int)"))
            plan = plan if name in self.BY_MONTH else plan.hint("rebalance", FACT_MONTH)
            plan.sortWithinPartitions(FACT_MONTH, "date_key").write.mode("overwrite").partitionBy(FACT_MONTH).parquet(path)
        else:
            plan.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(plan.schema).parquet(path)

    def _bucketed(self, name: str, plan: DataFrame) -> DataFrame:
        """The table in as many buckets as a shuffle has partitions, each one file sorted by keys and day."""
        keys, day = self.BUCKETED[name]
        buckets = starting_partitions(self.spark)
        table = f"{name}_{hashlib.sha1(self.folder.encode()).hexdigest()[:12]}"
        plan.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys, day).option(
            "path", f"{self.folder}/{name}").saveAsTable(table)
        return self.spark.table(table)

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in names}

    # --- silver ---

    def _selected_stores(self):
        return silver.select_stores(self.inputs.stores(), self.inputs.transactions(), self.cfg)

    def _sales(self):
        return silver.clean_sales(self.inputs.train(), self.table("selected_stores"), self.cfg)

    def _transactions(self):
        return self.inputs.transactions()

    def _store_day(self):
        return silver.store_day(self.table("transactions"), self.table("selected_stores"), self.cfg)

    def _national_holidays(self):
        return silver.national_holidays(self.inputs.holidays_events())

    # --- gold ---

    def _dim_date(self):
        return gold.dim_date(self.table("sales"), self.table("store_day"), self.table("national_holidays"))

    def _stg_store(self):
        return gold.stg_store(self.inputs.stores(), self.table("transactions"), self.table("selected_stores"), self.cfg)

    def _stg_item(self):
        return silver.stg_item(self.inputs.items())

    def _stg_store_day(self):
        return silver.stg_store_day(self.table("store_day"))

    def _trading(self):
        return gold.trading_days(self.table("store_day"), self.cfg)

    def _fact_sales(self):
        return gold.fact_sales(self.table("sales"), self.table("trading"), self.cfg)

    def _series(self):
        sales = self.table("sales")
        spine = gold.stockout_spine(gold.stockout_pairs(sales, self.cfg), self.table("trading"))
        return gold.stockout_series(spine, sales, self.cfg)

    def _fact_stockout_risk(self):
        return gold.fact_stockout_risk(self.table("series"), self.cfg)

    def _risk_pairs(self):
        """The pairs of the stock-out fact, numbered without gaps inside each file."""
        pairs = self.table("fact_stockout_risk").select("store_key", "item_key").distinct()
        return pairs.withColumn("pair_no", F.monotonically_increasing_id())

    # --- master data and conformed tables ---

    def _region(self):
        return self.inputs.region()

    def _state_region(self):
        return self.inputs.state_region()

    def _store_profile(self):
        return self.inputs.store_profile()

    def _item_price(self):
        return targets.item_price(self.inputs.list_price(), self.inputs.family_margin())

    def _store_month(self):
        return targets.store_month_value(self.table("fact_sales"), self.table("dim_date"), self.table("item_price"))

    def _weekday_weight(self):
        return targets.weekday_weights(self.table("fact_sales"), self.table("dim_date"), self.table("item_price"))

    def _sales_target_month(self):
        return targets.monthly_targets(self.table("store_month"), self.cfg)

    def _sales_target_day(self):
        return targets.daily_targets(self.table("sales_target_month"), self.table("weekday_weight"))

    def _weather_daily(self):
        return self.inputs.weather_daily()

    def _city_geo(self):
        return conform.city_match(self.table("stg_store").select("city"), self.inputs.geo_candidates())

    def _user_access(self):
        stores = self.table("stg_store")
        busiest = targets.busiest_store(stores, self.table("stg_store_day"), self.manager_city, self.access_since)
        access = targets.user_access(stores, self.table("state_region"), busiest, self.domain)
        return conform.scoped_access(access, stores)

    def _dim_store(self):
        return conform.dim_store(
            self.table("stg_store"), self.table("store_profile"), self.table("state_region"), self.table("region"))

    def _dim_item(self):
        return conform.dim_item(self.table("stg_item"), self.table("item_price"))

    def _fact_store_day(self):
        return conform.fact_store_day(
            self.table("stg_store_day"), self.table("sales_target_month"), self.table("dim_date"),
            self.table("stg_store"), self.table("weather_daily"), self.table("weekday_weight"))

    # --- deep dive ---

    def _tested_runs(self):
        return deepdive.run_tests(deepdive.zero_sale_runs(self.table("series"), self.cfg))

    def _flagged_runs(self):
        return deepdive.flag_runs(self.table("tested_runs"), self.cfg)

    def _fact_stockout_run(self):
        return deepdive.fact_stockout_run(self.table("flagged_runs"))

    def _stockout_store_week(self):
        return deepdive.store_weeks(
            self.table("series"), self.table("flagged_runs"), self.table("trading"), self.table("stg_store"), self.cfg)

    def _stockout_bh_summary(self):
        return deepdive.test_summary(self.table("tested_runs"), self.cfg)

    def _fact_promo_event(self):
        return deepdive.promo_events(
            self.table("fact_sales"), self.table("dim_date"), self.table("stg_item"), self.cfg)

    def _promo_family_summary(self):
        return deepdive.promo_family_summary(self.table("fact_promo_event"), self.cfg)
