"""Typed CSV scans. Columns and types are declared; a file that differs from its declaration stops the run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column names and types of the raw files and of the master data files.
RAW_SCHEMAS = {
    "train": "id bigint, date date, store_nbr int, item_nbr int, unit_sales double, onpromotion boolean",
    "transactions": "date date, store_nbr int, transactions int",
    "stores": "store_nbr int, city string, state string, type string, cluster int",
    "items": "item_nbr int, family string, class int, perishable int",
    "holidays_events":
        "date date, type string, locale string, locale_name string, description string, transferred boolean",
}
MASTER_SCHEMAS = {
    "region": "region_id int, region_name string",
    "state_region": "state string, region_id int",
    "store_profile": "store_nbr int, selling_area_m2 int",
    "item_price": "item_nbr int, unit_price decimal(10,2), unit_cost decimal(10,2)",
    "weekday_weight": "store_nbr int, weekday_num tinyint, weight double",
    "sales_target_month": "store_nbr int, month_start date, target_value decimal(14,2)",
    "city_geo": "city string, latitude double, longitude double, admin1 string",
    "weather_daily": "city string, weather_date date, rain_mm double, temp_max_c double",
    "user_access": "user_principal_name string, store_nbr int",
}


def scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file (or folder of them) with a header, read with exactly the declared columns.

    ``enforceSchema=false`` compares the header names, so a renamed, added or missing column fails instead of
    shifting values; FAILFAST stops at a cell that is not of its type. Without column pruning every cell is
    parsed, so the file is held to its declaration even where a query needs few columns. An empty cell is NULL.
    """
    return (
        spark.read.schema(schema)
        .option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
        .option("columnPruning", False)
        .option("nullValue", "").option("emptyValue", "")
        .csv(path)
    )


def scan_sales(spark: SparkSession, folder: str, start_date: date | None = None) -> DataFrame:
    sales = scan(spark, f"{folder}/train.csv", RAW_SCHEMAS["train"])
    return sales if start_date is None else sales.filter(F.col("date") >= F.lit(start_date))


def scan_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan(spark, f"{folder}/{name}.csv", RAW_SCHEMAS[name])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").option("nullValue", "").csv(path)


class RawFiles:
    """The raw files of one folder as build inputs.

    Each file is taken in once, whole, as a typed Parquet table: a cell of the wrong type stops the build even in
    a column that nothing reads, and later steps read columns instead of text.
    """

    def __init__(self, spark: SparkSession, folder: str, bronze: str, start_date: date | None = None):
        self.spark, self.folder, self.bronze, self.start_date = spark, folder, bronze.rstrip("/"), start_date
        self._taken: set[str] = set()

    def _table(self, name: str) -> DataFrame:
        path = f"{self.bronze}/{name}"
        if name not in self._taken:
            scanned = scan_raw(self.spark, self.folder, name)
            if name == "train" and self.start_date is not None:
                scanned = scanned.filter(F.col("date") >= F.lit(self.start_date))
            scanned.write.mode("overwrite").parquet(path)
            self._taken.add(name)
        return self.spark.read.parquet(path)

    def train(self) -> DataFrame:
        return self._table("train")

    def transactions(self) -> DataFrame:
        return self._table("transactions")

    def stores(self) -> DataFrame:
        return self._table("stores")

    def items(self) -> DataFrame:
        return self._table("items")

    def holidays_events(self) -> DataFrame:
        return self._table("holidays_events")
