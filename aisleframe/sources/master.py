"""Loading master data files: in foreign-key order, checked, and then put in place all together."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aisleframe.operators import checks, targets
from aisleframe.sources.commits import CommitLog
from aisleframe.sources.csvfiles import MASTER_SCHEMAS, scan

# parents before children
LOAD_ORDER = tuple(MASTER_SCHEMAS)


def read_master(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: scan(spark, f"{folder}/{name}.csv", schema) for name, schema in MASTER_SCHEMAS.items()}


def _write(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def load_master(spark: SparkSession, folder: str, dest: str) -> dict[str, DataFrame]:
    """Read the nine files, run the checks, write the tables. Nothing is written when a check fails.

    The tables of a load go to a folder of their own and become visible together, by one commit that names them: a load that
    fails halfway leaves the tables of the one before.
    """
    tables = read_master(spark, folder)
    weights = tables["weekday_weight"].withColumnRenamed("store_nbr", "store_key")
    daily = targets.daily_targets(tables["sales_target_month"], weights)
    checks.gate(checks.master_data_checks({**tables, "sales_target_day": daily}))
    load = f"loads/{uuid.uuid4().hex}"
    for name in LOAD_ORDER:
        _write(tables[name], f"{dest.rstrip('/')}/{load}/{name}")
    version = CommitLog(spark, dest).add({"load": load, "schemas": {name: tables[name].schema.jsonValue() for name in LOAD_ORDER}})
    return read_loaded(spark, dest, version)


def read_loaded(spark: SparkSession, dest: str, version: int | None = None) -> dict[str, DataFrame]:
    """The nine tables of the latest complete load, or of an earlier one."""
    log = CommitLog(spark, dest)
    entry = log.read(log.latest() if version is None else version)
    return {
        name: spark.read.schema(T.StructType.fromJson(schema)).parquet(f"{log.folder}/{entry['load']}/{name}")
        for name, schema in entry["schemas"].items()}
