"""The batch build: raw files to checked gold tables, then Parquet export and publication."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aisleframe.config import BuildConfig
from aisleframe.operators import checks
from aisleframe.plans.warehouse import GOLD_TABLES, Warehouse
from aisleframe.sources import tables


def build(spark: SparkSession, inputs, work: str, dest: str, cfg: BuildConfig) -> dict[str, int]:
    """Build all gold tables, stop on failed checks, then write them below ``dest``. Returns row counts.

    ``inputs`` offers train, transactions, stores, items and holidays_events; ``work`` takes the tables
    that several steps read.
    """
    warehouse = Warehouse(spark, inputs, work, cfg)
    gold = warehouse.tables(*GOLD_TABLES)
    raw = inputs.train().filter(F.col("date") >= F.lit(cfg.start_date))
    checks.gate(checks.gold_checks({
        **gold, "sales": warehouse.table("sales"), "store_day": warehouse.table("store_day"), "train": raw,
        "selected_stores": warehouse.table("selected_stores")}))
    written = tables.write_gold(gold, dest)
    return {row["table"]: row["rows"] for row in tables.row_counts(written).collect()}


def publish(spark: SparkSession, dest: str, target: str) -> dict[str, int]:
    """Publish every written gold table as a new version."""
    return tables.publish({name: spark.read.parquet(f"{dest}/{name}") for name in GOLD_TABLES}, target)
