"""Order-line tables in the shape of the chain's raw files.

A *grain* says what counts as a store and what as an item:

- ``supplier_part``: stores are suppliers, items are parts. Facts and dimensions grow with the data.
- ``nation_brand``: stores are nations, items are brands. Pairs sell nearly every day, so baselines and
  stock-out flags have something to say.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleframe.config import BuildConfig
from aisleframe.functions.columns import ratio

GRAINS = ("supplier_part", "nation_brand")

# Margins of the order-line families (the part types), as hundredths of the price.
TYPE_MARGIN_PCT = {"ECONOMY": 15, "LARGE": 20, "MEDIUM": 25, "PROMO": 30, "SMALL": 35, "STANDARD": 40}
BRAND_FAMILIES = 5

HOLIDAY_TYPE = {
    "1-URGENT": "Holiday", "2-HIGH": "Transfer", "3-MEDIUM": "Additional", "4-NOT SPECIFIED": "Bridge",
    "5-LOW": "Work Day",
}
HOLIDAY_TOTAL, TRANSFERRED_TOTAL = 485_000, 495_000


def order_line_config(base: BuildConfig | None = None) -> BuildConfig:
    """The chain's parameters moved to the years and cities of the order-line tables."""
    return replace(
        base or BuildConfig(),
        volume_from=date(1998, 1, 1),
        stockout_from=date(1998, 1, 1),
        sample_cities=("NATION_9", "NATION_11"),
        full_month_min_days=5,
    )


@dataclass(frozen=True)
class OrderLineFeed:
    spark: SparkSession
    path: str
    grain: str = "supplier_part"

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}.parquet")

    @property
    def by_brand(self) -> bool:
        return self.grain == "nation_brand"

    def lines(self, with_items: bool = True) -> DataFrame:
        """Order lines with date, store and (where asked for) item number."""
        lines = self.raw("lineitem").withColumn("date", F.to_date("l_shipdate"))
        if not self.by_brand:
            return lines.withColumn("store_nbr", F.col("l_suppkey")).withColumn("item_nbr", F.col("l_partkey"))
        stores = self.raw("supplier").select("s_suppkey", (F.col("s_nationkey") + 1).cast("bigint").alias("store_nbr"))
        placed = lines.join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
        if not with_items:
            return placed
        items = self.raw("part").select("p_partkey", brand_number().alias("item_nbr"))
        return placed.join(items, F.col("l_partkey") == F.col("p_partkey"))

    def train(self) -> DataFrame:
        returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
        return self.lines().select(
            "date", "store_nbr", "item_nbr",
            F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("unit_sales"),
            F.when(F.col("l_discount") != 0, F.col("l_discount") >= 0.09).alias("onpromotion"),
        )

    def transactions(self) -> DataFrame:
        return (
            self.lines(with_items=False).groupBy("date", "store_nbr")
            .agg(F.countDistinct("l_orderkey").cast("bigint").alias("transactions"))
        )

    def stores(self) -> DataFrame:
        nations = self.raw("nation").select(
            "n_nationkey", F.col("n_name").alias("city"), F.col("n_name").alias("state"),
            F.col("n_regionkey").cast("bigint").alias("cluster"))
        if self.by_brand:
            stores = nations.withColumn("store_nbr", (F.col("n_nationkey") + 1).cast("bigint"))
        else:
            suppliers = self.raw("supplier").select(F.col("s_suppkey").alias("store_nbr"), "s_nationkey")
            stores = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        letter = F.substring(F.lit("ABCDE"), (F.col("store_nbr") % 5 + 1).cast("int"), F.lit(1))
        return stores.select("store_nbr", "city", "state", letter.alias("type"), "cluster")

    def items(self) -> DataFrame:
        if self.by_brand:
            return self.raw("part").select(brand_number().alias("item_nbr")).distinct().select(
                "item_nbr",
                F.format_string("GROUP %d", F.col("item_nbr") % BRAND_FAMILIES).alias("family"),
                F.col("item_nbr").alias("class"),
                (F.col("item_nbr") % 2).alias("perishable"),
            )
        return self.raw("part").select(
            F.col("p_partkey").alias("item_nbr"), F.col("p_type").alias("family"),
            F.col("p_size").cast("bigint").alias("class"), (F.col("p_size") % 2).cast("bigint").alias("perishable"))

    def list_price(self) -> DataFrame:
        """item_nbr, family, unit_price. A brand's price is its parts' mean price, cut to whole cents."""
        price = F.col("p_retailprice")
        if self.by_brand:
            cents = F.round(price * 100).cast("bigint")
            return (
                self.raw("part").groupBy(brand_number().alias("item_nbr"))
                .agg(F.sum(cents).alias("cents"), F.count(F.lit(1)).alias("parts"))
                .select("item_nbr", F.format_string("GROUP %d", F.col("item_nbr") % BRAND_FAMILIES).alias("family"),
                        (F.expr("cents div parts") / 100).cast("decimal(10,2)").alias("unit_price"))
            )
        return self.raw("part").select(
            F.col("p_partkey").alias("item_nbr"), F.col("p_type").alias("family"),
            price.cast("decimal(10,2)").alias("unit_price"))

    def family_margin(self) -> DataFrame:
        """family, margin: the parameter table of the cost model."""
        if self.by_brand:
            rows = [(f"GROUP {i}", i + 2) for i in range(BRAND_FAMILIES)]
            return self.spark.createDataFrame(rows, "family string, tenths int").select(
                "family", (F.col("tenths") / 10).cast("decimal(4,2)").alias("margin"))
        rows = sorted(TYPE_MARGIN_PCT.items())
        return self.spark.createDataFrame(rows, "family string, pct int").select(
            "family", (F.col("pct") / 100).cast("decimal(4,2)").alias("margin"))

    def holidays_events(self) -> DataFrame:
        """Large orders stand in for the holiday calendar: priority is the type, the amount the scope."""
        total = F.col("o_totalprice")
        kind = F.create_map(*[F.lit(x) for pair in HOLIDAY_TYPE.items() for x in pair])
        return self.raw("orders").select(
            F.to_date("o_orderdate").alias("date"),
            kind[F.col("o_orderpriority")].alias("type"),
            F.when(total >= HOLIDAY_TOTAL, "National").otherwise("Local").alias("locale"),
            F.col("o_orderstatus").alias("locale_name"),
            F.col("o_orderpriority").alias("description"),
            (total >= TRANSFERRED_TOTAL).alias("transferred"),
        )

    def region(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("bigint").alias("region_id"), F.col("r_name").alias("region_name"))

    def state_region(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_name").alias("state"), F.col("n_regionkey").cast("bigint").alias("region_id"))

    def store_profile(self) -> DataFrame:
        """Selling area: a store's yearly space bill read as square metres."""
        if self.by_brand:
            return self.raw("supplier").groupBy((F.col("s_nationkey") + 1).cast("bigint").alias("store_nbr")).agg(
                (F.lit(600) + F.count(F.lit(1))).cast("bigint").alias("selling_area_m2"))
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("store_nbr"),
            (F.lit(600) + F.floor(F.abs("s_acctbal") / 10)).cast("bigint").alias("selling_area_m2"))

    def weather_daily(self) -> DataFrame:
        """city, weather_date, rain_mm, temp_max_c: city-day means over accepted lines; other days have no row."""
        suppliers = self.raw("supplier").select("s_suppkey", "s_nationkey")
        nations = self.raw("nation").select("n_nationkey", F.col("n_name").alias("city"))
        wet = F.round(F.col("l_tax") * 100).cast("bigint")
        warm = F.round(F.col("l_discount") * 100).cast("bigint")
        sums = (
            self.raw("lineitem").filter(F.col("l_returnflag") == "A")
            .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("s_nationkey", F.to_date("l_shipdate").alias("weather_date"))
            .agg(F.sum(wet).alias("wet"), F.sum(warm).alias("warm"), F.count(F.lit(1)).alias("n"))
        )
        return sums.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
            "city", "weather_date",
            F.when(F.col("wet") > 0, ratio(F.col("wet"), F.col("n"))).alias("rain_mm"),
            (F.lit(20.0) + ratio(F.col("warm"), F.col("n"))).alias("temp_max_c"),
        )

    def geo_candidates(self) -> DataFrame:
        """Places a geocoder would return: customers as places of their nation, building firms in the home country."""
        nations = self.raw("nation").select("n_nationkey", F.col("n_name").alias("name"))
        return self.raw("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "name",
            F.col("c_custkey").alias("rank"),
            F.when(F.col("c_mktsegment") == "BUILDING", "EC").otherwise("XX").alias("country_code"),
            F.when(F.col("c_acctbal") >= 0, F.floor("c_acctbal").cast("bigint")).alias("population"),
            (F.col("c_custkey") % 90).cast("double").alias("latitude"),
            (F.col("c_custkey") % 180).cast("double").alias("longitude"),
            F.col("c_mktsegment").alias("admin1"),
        )


def brand_number() -> Column:
    return F.substring_index("p_brand", "#", -1).cast("bigint")
