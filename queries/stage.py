"""What the registered queries run on: feeds, written layers and stars, one per session, data folder and grain."""

from __future__ import annotations

import hashlib
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleframe.functions.columns import tasks_for
from aisleframe.plans.star import Star
from aisleframe.plans.warehouse import Warehouse
from aisleframe.session import apply_settings, work_folder
from aisleframe.sources.orderlines import OrderLineFeed, order_line_config

FINE, MID = "supplier_part", "nation_brand"
ACCESS_SINCE = 19980101
DOMAIN = "chain.example"
STAR_TABLES = ("dim_date", "dim_store", "dim_item", "fact_sales", "fact_store_day", "user_access")
RISK_TABLES = ("fact_stockout_risk", "risk_pairs")
DEEP_TABLES = (
    "fact_stockout_run", "stockout_store_week", "stockout_bh_summary", "fact_promo_event", "promo_family_summary")


class Stage:
    def __init__(self, spark: SparkSession, sf_dir: str, grain: str):
        self.spark, self.grain = spark, grain
        self.feed = OrderLineFeed(spark, sf_dir.rstrip("/"), grain)
        self.cfg = order_line_config()
        tag = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:10]
        self.folder = f"{work_folder(spark)}/{tag}/{grain}"
        self.warehouse = Warehouse(
            spark, self.feed, self.folder, self.cfg, DOMAIN, access_since=ACCESS_SINCE)
        self._scratch = 0
        # a task of a grouping holds its groups: with more lines there must be more tasks
        self.partitions = tasks_for(self.feed.raw("lineitem"))

    def t(self, name: str) -> DataFrame:
        return self.warehouse.table(name)

    def scratch(self, name: str) -> str:
        self._scratch += 1
        return f"{self.folder}/scratch/{name}-{self._scratch}"

    @cached_property
    def star(self) -> Star:
        """The star over the written tables; each is built when a query first uses it."""
        names = (*STAR_TABLES, *RISK_TABLES, *DEEP_TABLES)
        return Star.of({name: partial(self.warehouse.stored, name) for name in names})


_stages: dict[tuple, Stage] = {}


def stage(spark: SparkSession, sf_dir: str, grain: str) -> Stage:
    apply_settings(spark)
    key = (spark.sparkContext.applicationId, sf_dir, grain)
    if key not in _stages:
        _stages[key] = Stage(spark, sf_dir, grain)
    apply_settings(spark, _stages[key].partitions)
    return _stages[key]


# --- result columns ------------------------------------------------------------------------------------------
# "name:kind" with kind s(tring), i(nteger), b(oolean), d(ate) or a number of decimals of a double


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.split(":")) for part in spec.split()]


def shaped(df: DataFrame, spec: str) -> DataFrame:
    out = []
    for name, kind in _columns(spec):
        c = F.col(f"`{name}`")
        if kind.isdigit():
            c = F.round(c.cast("double"), int(kind)) + F.lit(0.0)
        else:
            c = c.cast({"s": T.StringType(), "i": T.LongType(), "b": T.BooleanType(), "d": T.DateType()}[kind])
        out.append(c.alias(name))
    return df.select(*out)


def shaped_sql(sql: str, spec: str) -> str:
    """The same shape around a statement."""
    out = []
    for name, kind in _columns(spec):
        if kind.isdigit():
            out.append(f'round("{name}"::DOUBLE, {kind}) + 0.0 AS "{name}"')
        else:
            out.append(f'"{name}"::{dict(s="VARCHAR", i="BIGINT", b="BOOLEAN", d="DATE")[kind]} AS "{name}"')
    return f"SELECT {', '.join(out)} FROM (\n{sql}\n) shaped"


# --- order-free digests of whole tables, the same in both languages ------------------------------------------------


def digest(df: DataFrame, spec: str, table: str) -> DataFrame:
    """One row: a table's rows and the sum of the first 60 bits of each row's MD5."""
    cells = []
    for name, kind in _columns(spec):
        c = F.col(f"`{name}`")
        if kind.isdigit():
            text = F.floor(c.cast("double") * 10 ** int(kind) + 0.5).cast("bigint").cast("string")
        else:
            text = c.cast({"s": "string", "i": "bigint", "b": "boolean", "d": "date"}[kind]).cast("string")
        cells.append(F.coalesce(text, F.lit("~")))
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(bits), F.lit(0)).cast("string").alias("digest")).select(
        F.lit(table).alias("table"), "rows", "digest")


def digest_sql(sql: str, spec: str, table: str) -> str:
    cells = []
    for name, kind in _columns(spec):
        if kind.isdigit():
            text = f'floor("{name}"::DOUBLE * {10 ** int(kind)} + 0.5)::BIGINT::VARCHAR'
        else:
            text = f'"{name}"::{dict(s="VARCHAR", i="BIGINT", b="BOOLEAN", d="DATE")[kind]}::VARCHAR'
        cells.append(f"coalesce({text}, '~')")
    row = " || '|' || ".join(cells)
    return f"""SELECT '{table}' AS "table", count(*) AS "rows", coalesce(sum(('0x' || substr(md5({row}), 1, 15))::BIGINT), 0)::VARCHAR AS digest
FROM ({sql}) t"""
