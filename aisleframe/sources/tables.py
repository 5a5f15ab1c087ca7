"""Writing gold tables, publishing versions of them, reading them by contract."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleframe.sources.commits import CommitLog, swap_folder

# The columns of the deep-dive tables that the report model relies on.
DEEP_DIVE_CONTRACT = {
    "fact_stockout_run": {
        "store_key", "item_key", "start_date_key", "end_date_key", "run_days", "spine_days", "calendar_days",
        "lambda_units", "dispersion", "p_value", "p_poisson", "expected_lost_units", "is_flagged"},
    "stockout_store_week": {"store_key", "city", "week_start", "week_start_key", "item_days", "flagged_days", "rate"},
    "fact_promo_event": {
        "store_key", "item_key", "family", "start_date_key", "end_date_key", "promo_days", "promo_units",
        "baseline_units", "uplift", "post_units", "post_expected_units", "post_dip", "net_lift",
        "touches_payday_or_holiday"},
    "promo_family_summary": {
        "family", "n_events", "uplift_median", "uplift_lo", "uplift_hi", "n_dip_events", "dip_median", "dip_lo",
        "dip_hi", "n_net_events", "net_median", "net_lo", "net_hi"},
    "stockout_bh_summary": {"tested_runs", "flagged_runs", "bh_cutoff", "max_chance_flags", "poisson_flagged_runs"},
}


def write_gold(tables: dict[str, DataFrame], dest: str) -> dict[str, DataFrame]:
    """One Parquet folder per table below ``dest``, which is replaced as a whole. Returns the written tables.

    All tables are written beside ``dest`` first: a failed export leaves what was there, and tables of an earlier export that
    are no longer made do not stay.
    """
    dest = dest.rstrip("/")
    staged = f"{dest}.staged-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{staged}/{name}")
    spark = next(iter(tables.values())).sparkSession
    swap_folder(spark, staged, dest)
    return {name: spark.read.schema(df.schema).parquet(f"{dest}/{name}") for name, df in tables.items()}


def folder_names(spark: SparkSession, dest: str) -> list[str]:
    """The tables that an export folder holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(dest)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def _has_delta(spark: SparkSession) -> bool:
    return "delta" in (spark.conf.get("spark.sql.extensions", "") or "").lower()


def publish(tables: dict[str, DataFrame], target: str, after: dict[str, int] | None = None) -> dict[str, int]:
    """Publish each table as a new version, the schema replaced; returns the version numbers, from 0.

    A Delta table where the session has Delta. Otherwise each version's data has a folder of its own that an entry of the table's commit
    log names. Publishers that meet get different versions and none is lost; ``after`` names versions that must still be the
    latest, else CommitConflict. A failed write changes nothing.
    """
    versions = {}
    for name in sorted(tables):
        df, path = tables[name], f"{target.rstrip('/')}/{name}"
        spark = df.sparkSession
        if _has_delta(spark):
            df.write.format("delta").mode("overwrite").option("overwriteSchema", True).save(path)
            versions[name] = spark.sql(f"DESCRIBE HISTORY delta.`{path}` LIMIT 1").first()["version"]
            continue
        data = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{path}/{data}")
        entry = {"data": data, "schema": df.schema.jsonValue()}
        versions[name] = CommitLog(spark, path).add(entry, None if after is None else after[name])
    return versions


def latest_version(spark: SparkSession, path: str) -> int:
    """The highest version of a published table, -1 where there is none."""
    return CommitLog(spark, path).latest()


def read_published(spark: SparkSession, target: str, name: str, version: int | None = None) -> DataFrame:
    path = f"{target.rstrip('/')}/{name}"
    if _has_delta(spark):
        reader = spark.read.format("delta")
        return (reader if version is None else reader.option("versionAsOf", version)).load(path)
    log = CommitLog(spark, path)
    entry = log.read(log.latest() if version is None else version)
    return spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{path}/{entry['data']}")


def read_contract(spark: SparkSession, folder: str, name: str, columns: list[str], only=None) -> DataFrame:
    """Only the listed columns of a table; ``only`` is a row condition the scan can push down."""
    table = spark.read.parquet(f"{folder}/{name}")
    if only is not None:
        table = table.filter(only)
    return table.select(*columns)


def read_flagged_runs(spark: SparkSession, folder: str) -> DataFrame:
    return read_contract(
        spark, folder, "fact_stockout_run",
        ["start_date_key", "store_key", "item_key", "run_days", "lambda_units", "dispersion", "expected_lost_units"],
        F.col("is_flagged"))
