"""All registered queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from queries import figures, layers
from queries.stage import shaped, shaped_sql, stage

ENTRIES: dict[str, tuple] = {**layers.ENTRIES, **figures.ENTRIES}


def _runner(grain, build, spec) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: shaped(build(stage(spark, sf_dir, grain)), spec)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _runner(grain, build, spec) for key, (grain, build, spec, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: shaped_sql(sql, spec) for key, (_, _, spec, sql) in ENTRIES.items() if sql}
