"""Registered queries of the sources, layers, master data, checks and deep-dive producers."""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleframe.functions.columns import date_key
from aisleframe.operators import checks, conform, deepdive, gold, silver, targets
from aisleframe.plans import warehouse
from aisleframe.sources import csvfiles, master, tables, weather
from aisleframe.session import written
from queries.sql_base import query
from queries.stage import FINE, MID, Stage, digest, digest_sql

# key -> (grain, stage -> DataFrame, column spec, SQL or None)
ENTRIES: dict[str, tuple] = {}


def add(key, grain, build, spec, sql, extra=""):
    ENTRIES[key] = (grain, build, spec, query(grain, sql, extra) if sql else None)


WIDE_IDS = {"store_nbr int": "store_nbr bigint", "item_nbr int": "item_nbr bigint", "class int": "class bigint",
            "cluster int": "cluster bigint", "transactions int": "transactions bigint"}


def _wide(schema: str) -> str:
    for narrow, wide in WIDE_IDS.items():
        schema = schema.replace(narrow, wide)
    return schema


def _csv_round_trip(s: Stage, name: str, df: DataFrame) -> DataFrame:
    path = s.scratch(name)
    schema = _wide(csvfiles.RAW_SCHEMAS[name])
    columns = [c.split()[0] for c in schema.split(", ")]
    csvfiles.write_csv(df.select(*columns), path)
    return csvfiles.scan(s.spark, path, schema)


# --- S: sources and sinks --------------------------------------------------------------------------------------

TRAIN_SPEC = "id:i date:d store_nbr:i item_nbr:i unit_sales:2 onpromotion:b"


def _scan_sales(s: Stage) -> DataFrame:
    lines = s.feed.train()
    from_day = F.lit("1997-01-01").cast("date")
    numbered = s.feed.lines().select(
        F.col("l_orderkey").alias("id"), "date", "store_nbr", "item_nbr", lines_units(), lines_promo())
    return _csv_round_trip(s, "train", numbered).filter(F.col("date") >= from_day)


def lines_units():
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("unit_sales")


def lines_promo():
    return F.when(F.col("l_discount") != 0, F.col("l_discount") >= 0.09).alias("onpromotion")


add("s1_scan_sales_csv", FINE, _scan_sales, TRAIN_SPEC,
    "SELECT l_orderkey AS id, date, store_nbr, item_nbr, unit_sales, onpromotion FROM l WHERE date >= DATE '1997-01-01'")
add("s2_scan_receipts_csv", MID, lambda s: _csv_round_trip(s, "transactions", s.feed.transactions()),
    "date:d store_nbr:i transactions:i", "SELECT date, store_nbr, receipts AS transactions FROM tx")
add("s3_scan_stores_csv", FINE, lambda s: _csv_round_trip(s, "stores", s.feed.stores()),
    "store_nbr:i city:s state:s type:s cluster:i", "SELECT * FROM st")
add("s4_scan_items_csv", FINE, lambda s: _csv_round_trip(s, "items", s.feed.items()),
    "item_nbr:i family:s class:i perishable:i", "SELECT * FROM it")
add("s5_scan_holidays_csv", FINE, lambda s: _csv_round_trip(s, "holidays_events", s.feed.holidays_events()),
    "date:d type:s locale:s locale_name:s description:s transferred:b", "SELECT * FROM raw_holidays")


def _drift(s: Stage) -> DataFrame:
    """Files that drift from the declared columns: does reading them stop?"""
    stores = s.feed.stores()
    variants = {
        "declared": stores,
        "extra column": stores.withColumn("extra", F.lit("x")),
        "missing column": stores.drop("cluster"),
        "renamed column": stores.withColumnRenamed("city", "town"),
    }
    rows = []
    for name, df in variants.items():
        path = s.scratch("drift")
        csvfiles.write_csv(df, path)
        try:
            read = csvfiles.scan(s.spark, path, _wide(csvfiles.RAW_SCHEMAS["stores"])).agg(F.count("city")).first()[0]
            rows.append((name, False, read))
        except Exception:
            rows.append((name, True, 0))
    return s.spark.createDataFrame(rows, "variant string, stopped boolean, stores_read bigint")


add("s6_schema_drift_guard", FINE, _drift, "variant:s stopped:b stores_read:i", """
SELECT variant, variant <> 'declared' AS stopped, CASE WHEN variant = 'declared' THEN (SELECT count(*) FROM st) ELSE 0 END AS stores_read
FROM (VALUES ('declared'), ('extra column'), ('missing column'), ('renamed column')) v(variant)""")

DATE_SPEC = ("date_key:i date:d year:i quarter:i month_num:i month_name:s month_key:i iso_week:i iso_year:i weekday_num:i "
             "weekday_name:s is_weekend:b is_national_holiday:b")
STORE_SPEC = "store_key:i store_nbr:i city:s state:s store_type:s cluster:i opening_date:d"
ITEM_SPEC = "item_key:i item_nbr:i family:s class:i is_perishable:b"
RECEIPT_SPEC = "date_key:i store_key:i receipts:i"
FACT_SPEC = "date_key:i store_key:i item_key:i units:2 return_units:2 on_promo:b post_promo_window:b baseline_units:6"
RISK_SPEC = "date_key:i store_key:i item_key:i expected_units:2"
STORE_SQL = "SELECT *, type AS store_type FROM store"
RECEIPT_SQL = "SELECT strftime(date, '%Y%m%d')::INT AS date_key, store_nbr AS store_key, receipts FROM tx"
FACT_SQL = "SELECT *, post_promo AS post_promo_window, baseline AS baseline_units FROM fs"
GOLD_ROWS = {
    "dim_date": (DATE_SPEC, "SELECT * FROM cal"), "stg_store": (STORE_SPEC, STORE_SQL),
    "stg_item": (ITEM_SPEC, "SELECT * FROM item"), "stg_store_day": (RECEIPT_SPEC, RECEIPT_SQL),
    "fact_sales": (FACT_SPEC, FACT_SQL), "fact_stockout_risk": (RISK_SPEC, "SELECT * FROM risk")}


def _digests(found: dict[str, DataFrame], rows: dict[str, tuple[str, str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [digest(found[name], spec, name) for name, (spec, _) in rows.items()])


def _digests_sql(rows: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(digest_sql(sql, spec, name) for name, (spec, sql) in rows.items())


def _gold(s: Stage) -> dict[str, DataFrame]:
    return s.warehouse.tables(*warehouse.GOLD_TABLES)


def _export_twice(s: Stage) -> DataFrame:
    """The folder holds what the last export made: a table that only the first one had is gone."""
    dest, gold_tables = s.scratch("gold"), _gold(s)
    tables.write_gold({**gold_tables, "of_an_earlier_build": gold_tables["stg_store"]}, dest)
    tables.write_gold(gold_tables, dest)
    here = tables.folder_names(s.spark, dest)
    return _digests({name: s.spark.read.parquet(f"{dest}/{name}") for name in here}, {n: GOLD_ROWS[n] for n in here})


DIGEST_SPEC = "table:s rows:i digest:s"
add("s7_write_gold_parquet", MID, _export_twice, DIGEST_SPEC, _digests_sql(GOLD_ROWS))


def _publish_twice(s: Stage) -> DataFrame:
    """Two publishers that both saw no version yet: the rows of each version as its readers find them."""
    target, gold_tables = s.scratch("published"), _gold(s)
    first = tables.publish(gold_tables, target)
    only_stores = {**gold_tables, "fact_sales": gold_tables["fact_sales"].filter("on_promo")}
    second = tables.publish(only_stores, target)
    versions = [
        _digests({name: tables.read_published(s.spark, target, name, of[name]) for name in of}, GOLD_ROWS)
        .withColumn("version", F.lit(number)) for number, of in enumerate((first, second))]
    return versions[0].unionByName(versions[1])


PROMO_ROWS = {**GOLD_ROWS, "fact_sales": (FACT_SPEC, f"SELECT * FROM ({FACT_SQL}) WHERE on_promo")}
add("s8_publish_tables", MID, _publish_twice, f"{DIGEST_SPEC} version:i",
    f"SELECT *, 0 AS version FROM ({_digests_sql(GOLD_ROWS)}) UNION ALL SELECT *, 1 FROM ({_digests_sql(PROMO_ROWS)})")


def _master_tables(s: Stage) -> dict[str, DataFrame]:
    w = s.warehouse
    weights = w.table("weekday_weight").withColumnRenamed("store_key", "store_nbr")
    access = w.table("user_access").withColumnRenamed("store_key", "store_nbr")
    return {**w.tables("region", "state_region", "store_profile", "item_price", "sales_target_month", "city_geo",
                       "weather_daily"), "weekday_weight": weights, "user_access": access}


def _load_master(s: Stage) -> DataFrame:
    folder = s.scratch("master")
    for name, df in _master_tables(s).items():
        columns = [c.split()[0] for c in csvfiles.MASTER_SCHEMAS[name].split(", ")]
        csvfiles.write_csv(df.select(*columns), f"{folder}/{name}.csv")
    dest = s.scratch("erp")
    master.load_master(s.spark, folder, dest)
    return _digests(master.read_loaded(s.spark, dest), MASTER_ROWS)


ACCESS = """
busy AS (SELECT store_key FROM tx JOIN store ON store_key = tx.store_nbr
         WHERE city = 'NATION_9' AND date >= DATE '1998-01-01' GROUP BY 1 ORDER BY sum(receipts) DESC, store_key LIMIT 1),
access AS (SELECT 'store.manager@chain.example' AS upn, store_key FROM busy UNION ALL
           SELECT 'regional.manager@chain.example', store_key FROM store
           WHERE region = (SELECT region FROM store JOIN busy USING (store_key)))"""

GEO = """
geo AS (
  SELECT city, latitude, longitude, admin1 FROM (
    SELECT n_name AS city, (c_custkey % 90)::DOUBLE AS latitude, (c_custkey % 180)::DOUBLE AS longitude, c_mktsegment AS admin1,
      row_number() OVER (PARTITION BY n_name ORDER BY CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal) ELSE 0 END DESC, c_custkey) AS r
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING')
  WHERE r = 1 AND city IN (SELECT city FROM store))"""

MASTER_ROWS = {
    "region": ("region_id:i region_name:s", "SELECT r_regionkey AS region_id, r_name AS region_name FROM region"),
    "state_region": ("state:s region_id:i", "SELECT n_name AS state, n_regionkey AS region_id FROM nation"),
    "store_profile": ("store_nbr:i selling_area_m2:i",
                      "SELECT store_nbr, selling_area_m2 FROM st WHERE store_nbr IN (SELECT s_nationkey + 1 FROM supplier)"),
    "item_price": ("item_nbr:i unit_price:2 unit_cost:2", "SELECT item_nbr, unit_price, unit_cost FROM item"),
    "weekday_weight": ("store_nbr:i weekday_num:i weight:8", "SELECT store_key AS store_nbr, weekday_num, weight FROM weights"),
    "sales_target_month": ("store_nbr:i month_start:d target_value:2", "SELECT store_key AS store_nbr, month_start, target_value FROM goal"),
    "city_geo": ("city:s latitude:4 longitude:4 admin1:s", "SELECT * FROM geo"),
    "weather_daily": ("city:s weather_date:d rain_mm:6 temp_max_c:6", "SELECT city, date AS weather_date, rain_mm, temp_max_c FROM weather"),
    "user_access": ("user_principal_name:s store_nbr:i", "SELECT upn AS user_principal_name, store_key AS store_nbr FROM access"),
}
add("s9_load_master_csv", MID, _load_master, DIGEST_SPEC, _digests_sql(MASTER_ROWS), ACCESS + "," + GEO)


def _contract(s: Stage) -> DataFrame:
    s.t("fact_sales")
    return tables.read_contract(s.spark, s.folder, "fact_sales", [
        "date_key", "store_key", "item_key", "units", "on_promo", "post_promo_window", "baseline_units"])


add("s10_read_contract_table", MID, _contract,
    "date_key:i store_key:i item_key:i units:2 on_promo:b post_promo_window:b baseline_units:6",
    "SELECT date_key, store_key, item_key, units, on_promo, post_promo AS post_promo_window, baseline AS baseline_units FROM fs")
add("s11_parse_weather_json", FINE, lambda s: weather.parse_replies(weather.as_replies(s.feed.weather_daily())),
    "city:s weather_date:d rain_mm:6 temp_max_c:6", "SELECT city, date AS weather_date, rain_mm, temp_max_c FROM weather")


def _flagged(s: Stage) -> DataFrame:
    s.t("fact_stockout_run")
    return tables.read_flagged_runs(s.spark, s.folder)


add("s12_read_flagged_runs", MID, _flagged,
    "start_date_key:i store_key:i item_key:i run_days:i lambda_units:6 dispersion:6 expected_lost_units:4",
    """SELECT strftime(start_date, '%Y%m%d')::INT AS start_date_key, store_nbr AS store_key, item_nbr AS item_key, run_days,
         lambda_units, dispersion, expected_lost_units FROM flagged WHERE is_flagged""")

# --- P: cleaning -----------------------------------------------------------------------------------------------


def _sample(s: Stage) -> DataFrame:
    from dataclasses import replace

    return silver.select_stores(s.feed.stores(), s.feed.transactions(), replace(s.cfg, sample=True))


add("p1_select_stores", FINE, _sample, "store_nbr:i", """
SELECT store_nbr FROM st LEFT JOIN (SELECT store_nbr, sum(receipts) AS n FROM tx WHERE date >= DATE '1998-01-01' GROUP BY 1)
  USING (store_nbr) WHERE city IN ('NATION_9', 'NATION_11')
QUALIFY row_number() OVER (PARTITION BY city ORDER BY coalesce(n, 0) DESC, store_nbr) < 4""")
SALES_SPEC = "date:d store_nbr:i item_nbr:i units:2 return_units:2 on_promo:b"
for _tag, _grain in (("", FINE), ("_by_brand", MID)):
    add(f"p2_clean_sales{_tag}", _grain,
        lambda s: silver.clean_sales(s.feed.train(), s.t("selected_stores"), s.cfg), SALES_SPEC,
        "SELECT * FROM sales")
add("p3_store_day", FINE,
    lambda s: silver.store_day(s.feed.transactions(), s.t("selected_stores"), s.cfg),
    "date:d store_nbr:i receipts:i", "SELECT * FROM tx")
add("p4_national_holidays", FINE, lambda s: silver.national_holidays(s.feed.holidays_events()), "date:d", "SELECT * FROM hol")
add("p5_stg_item", FINE, lambda s: silver.stg_item(s.feed.items()),
    "item_key:i item_nbr:i family:s class:i is_perishable:b", "SELECT * FROM item")
add("p6_stg_store_day", FINE, lambda s: silver.stg_store_day(s.t("store_day")), RECEIPT_SPEC, RECEIPT_SQL)

# --- G: calendar, stores, baselines, stock-outs ----------------------------------------------------------------

add("g1_dim_date", FINE, lambda s: gold.dim_date(s.t("sales"), s.t("store_day"), s.t("national_holidays")),
    DATE_SPEC, "SELECT * FROM cal")
add("g2_is_national_holiday", FINE,
    lambda s: gold.dim_date(s.t("sales"), s.t("store_day"), s.t("national_holidays")).filter("is_national_holiday")
    .groupBy("year").agg(F.count(F.lit(1)).alias("holidays")), "year:i holidays:i",
    "SELECT year(date) AS year, count(*) AS holidays FROM hol, ends WHERE date BETWEEN lo AND hi GROUP BY 1")
add("g3_stg_store", FINE,
    lambda s: gold.stg_store(s.feed.stores(), s.t("transactions"), s.feed.stores().select("store_nbr"), s.cfg),
    STORE_SPEC, STORE_SQL)
add("g4_trading_days", MID, lambda s: gold.trading_days(s.t("store_day"), s.cfg), "store_nbr:i date:d trading_days:i",
    "SELECT store_nbr, date, trading_days FROM trade")
LOOK_SPEC = "date:d store_nbr:i item_nbr:i base_units_sum:2 promo_days_in_lookback:i promo_days_recent:i first_sale:d"
add("g5_lookback_aggregates", MID, lambda s: gold.sales_lookback(s.t("sales"), s.cfg), LOOK_SPEC,
    """SELECT date, store_nbr, item_nbr, usual_units AS base_units_sum, promos_28 AS promo_days_in_lookback,
         promos_7 AS promo_days_recent, first_sale FROM fact""")
FLAG_KEYS = "date:d store_nbr:i item_nbr:i"
add("g6_post_promo_window", MID, lambda s: gold.sales_lookback(s.t("sales"), s.cfg), f"{FLAG_KEYS} post_promo_window:b",
    "SELECT date, store_nbr, item_nbr, on_promo IS DISTINCT FROM true AND promos_7 > 0 AS post_promo_window FROM look")
add("g7_has_full_history", MID, lambda s: gold.sales_lookback(s.t("sales"), s.cfg), f"{FLAG_KEYS} has_full_history:b",
    "SELECT date, store_nbr, item_nbr, date - first_sale >= 28 AS has_full_history FROM fact")
for _tag, _grain in (("", MID), ("_by_part", FINE)):
    add(f"g8_fact_sales{_tag}", _grain, lambda s: gold.fact_sales(s.t("sales"), s.t("trading"), s.cfg), FACT_SPEC, FACT_SQL)
add("g9_stockout_pairs", MID, lambda s: gold.stockout_pairs(s.t("sales"), s.cfg),
    "store_nbr:i item_nbr:i first_sale:d last_sale:d", "SELECT * FROM pairs")
add("g10_trading_day_spine", MID,
    lambda s: gold.stockout_spine(gold.stockout_pairs(s.t("sales"), s.cfg), s.t("trading"))
    .groupBy("store_nbr", "item_nbr").agg(F.count(F.lit(1)).alias("days"), F.min("date").alias("lo"), F.max("date").alias("hi")),
    "store_nbr:i item_nbr:i days:i lo:d hi:d",
    """SELECT p.store_nbr, item_nbr, count(*) AS days, min(date) AS lo, max(date) AS hi FROM pairs p JOIN tx
         ON tx.store_nbr = p.store_nbr AND date BETWEEN first_sale AND last_sale GROUP BY ALL""")
add("g11_full_days", MID, lambda s: gold.trading_days(s.t("store_day"), s.cfg), "store_nbr:i date:d full_day:b",
    "SELECT store_nbr, date, full_day FROM trade")
add("g12_zero_filled_series", MID,
    lambda s: s.t("series").groupBy("store_nbr", "item_nbr").agg(
        F.count(F.lit(1)).alias("days"), F.sum("units").alias("units"), F.count_if("no_sale_row").alias("no_sale_days")),
    "store_nbr:i item_nbr:i days:i units:2 no_sale_days:i",
    """SELECT store_nbr, item_nbr, count(*) AS days, sum(units) AS units, count(*) FILTER (no_row) AS no_sale_days
         FROM series GROUP BY ALL""")
add("g13_expected_units", MID,
    lambda s: gold.score_series(s.t("series"), s.cfg).filter(F.col("history_days") == s.cfg.lookback_days)
    .groupBy("store_nbr", "item_nbr").agg(
        F.count(F.lit(1)).alias("days"), F.sum("lambda_units").alias("lambda_sum"),
        F.count_if(F.col("future_sales") > 0).alias("days_before_sales")),
    "store_nbr:i item_nbr:i days:i lambda_sum:4 days_before_sales:i",
    """SELECT store_nbr, item_nbr, count(*) AS days, sum(prior_sum) / 28 AS lambda_sum,
         count(*) FILTER (next_sale <= date + 28) AS days_before_sales FROM scored WHERE nth > 28 GROUP BY ALL""")
add("g14_fact_stockout_risk", MID, lambda s: gold.fact_stockout_risk(s.t("series"), s.cfg), RISK_SPEC, "SELECT * FROM risk")


def _risk_from_sales(s: Stage) -> DataFrame:
    spine = gold.stockout_spine(gold.stockout_pairs(s.t("sales"), s.cfg), s.t("trading"))
    return gold.fact_stockout_risk(gold.stockout_series(spine, s.t("sales"), s.cfg), s.cfg)


add("g14_fact_stockout_risk_end_to_end", MID, _risk_from_sales, RISK_SPEC, "SELECT * FROM risk")

# --- D: conforming ----------------------------------------------------------------------------------------------

add("d1_dim_item", FINE, lambda s: conform.dim_item(s.t("stg_item"), s.t("item_price")),
    "item_key:i item_nbr:i family:s class:i is_perishable:b unit_price:2 unit_cost:2", "SELECT * FROM item")
add("d2_dim_store", FINE,
    lambda s: conform.dim_store(s.t("stg_store"), s.t("store_profile"), s.t("state_region"), s.t("region")),
    "store_key:i store_nbr:i city:s state:s store_type:s cluster:i opening_date:d selling_area_m2:i region:s",
    "SELECT *, type AS store_type FROM store")
DAY_SPEC = "date_key:i store_key:i receipts:i target_value:2 rain_mm:6 temp_max_c:6"
DAY_SQL = "SELECT *, strftime(date, '%Y%m%d')::INT AS date_key FROM day"


def _store_day(s: Stage) -> DataFrame:
    return conform.fact_store_day(
        s.t("stg_store_day"), s.t("sales_target_month"), s.t("dim_date"), s.t("stg_store"), s.t("weather_daily"),
        s.t("weekday_weight"))


for _tag, _grain in (("", FINE), ("_by_nation", MID)):
    add(f"d3_fact_store_day{_tag}", _grain, _store_day, DAY_SPEC, DAY_SQL)
add("d4_user_access", FINE, lambda s: conform.scoped_access(s.t("user_access"), s.t("stg_store")),
    "user_principal_name:s store_key:i", "SELECT upn AS user_principal_name, store_key FROM access", ACCESS)


def _labels(s: Stage) -> DataFrame:
    named = conform.store_label(s.t("dim_store")).select(F.lit("store").alias("kind"), F.col("store_name").alias("label"))
    months = conform.month_label(s.t("dim_date")).select(F.lit("month").alias("kind"), F.col("year_month").alias("label"))
    return named.unionByName(months.distinct())


add("d5_labels", FINE, _labels, "kind:s label:s",
    "SELECT 'store' AS kind, store_name AS label FROM store UNION ALL SELECT DISTINCT 'month', year_month FROM cal")
add("d6_city_match", FINE, lambda s: conform.city_match(s.t("stg_store").select("city"), s.feed.geo_candidates()),
    "city:s latitude:4 longitude:4 admin1:s", "SELECT * FROM geo", GEO)

# --- E: master data derivations -----------------------------------------------------------------------------------

add("e1_store_month_value", FINE,
    lambda s: targets.store_month_value(s.t("fact_sales"), s.t("dim_date"), s.t("item_price")),
    "store_key:i month_start:d sales_value:2 active_days:i", "SELECT * FROM months")
add("e2_weekday_weights", FINE,
    lambda s: targets.weekday_weights(s.t("fact_sales"), s.t("dim_date"), s.t("item_price")),
    "store_key:i weekday_num:i weight:8", "SELECT * FROM weights")
add("e3_monthly_targets", FINE, lambda s: targets.monthly_targets(s.t("store_month"), s.cfg),
    "store_nbr:i month_start:d target_value:2", "SELECT store_key AS store_nbr, month_start, target_value FROM goal")
for _tag, _grain in (("", FINE), ("_by_nation", MID)):
    add(f"e4_daily_target_allocation{_tag}", _grain,
        lambda s: targets.daily_targets(s.t("sales_target_month"), s.t("weekday_weight")),
        "store_nbr:i target_date:d target_value:2",
        "SELECT store_key AS store_nbr, date AS target_date, target_value FROM daily")
add("e5_state_region", FINE, lambda s: targets.state_region(s.feed.stores(), s.feed.state_region()),
    "state:s region_id:i", "SELECT DISTINCT state, n_regionkey AS region_id FROM st JOIN nation ON n_name = state")
add("e6_item_price", FINE, lambda s: targets.item_price(s.feed.list_price(), s.feed.family_margin()),
    "item_nbr:i unit_price:2 unit_cost:2", "SELECT * FROM item")
add("e7_busiest_store", FINE, lambda s: targets.busiest_store(s.t("stg_store"), s.t("stg_store_day"), "NATION_9", 19980101),
    "store_key:i", "SELECT store_key FROM busy", ACCESS)


def _access(s: Stage) -> DataFrame:
    busiest = targets.busiest_store(s.t("stg_store"), s.t("stg_store_day"), "NATION_9", 19980101)
    return targets.user_access(s.t("stg_store"), s.t("state_region"), busiest, "chain.example")


add("e8_user_access", FINE, _access, "user_principal_name:s store_key:i",
    "SELECT upn AS user_principal_name, store_key FROM access", ACCESS)

# --- C: checks ----------------------------------------------------------------------------------------------------

CHECK_SPEC = "check:s violations:i"


def _check_tables(s: Stage) -> dict[str, DataFrame]:
    return {**_gold(s), "sales": s.t("sales"), "store_day": s.t("store_day"), "train": s.feed.train(),
            "selected_stores": s.feed.stores().select("store_nbr")}


def _orphan_sql(name: str, fact: str, key: str, dim: str, dim_key: str) -> str:
    return (f"SELECT '{name}' AS \"check\", count(*) AS violations FROM {fact} f "
            f"WHERE NOT EXISTS (FROM {dim} x WHERE x.{dim_key} = f.{key})")


def _unique_sql(name: str, table: str, keys: str) -> str:
    return (f"SELECT '{name}' AS \"check\", coalesce(sum(n - 1), 0) AS violations "
            f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})")


GOLD_CHECK_SQL = [
    _unique_sql("dim_date_unique_key", "cal", "date_key"),
    _unique_sql("stg_store_unique_key", "store", "store_key"),
    _unique_sql("stg_item_unique_key", "it", "item_nbr"),
    "SELECT 'fact_sales_unique_grain' AS \"check\", count(*) FILTER (n > 1) AS violations "
    "FROM (SELECT count(*) AS n FROM fs GROUP BY date_key, store_key, item_key)",
    _orphan_sql("fact_sales_orphan_date", "fs", "date_key", "cal", "date_key"),
    _orphan_sql("fact_sales_orphan_store", "fs", "store_key", "store", "store_key"),
    _orphan_sql("fact_sales_orphan_item", "fs", "item_key", "it", "item_nbr"),
    _orphan_sql("stockout_orphan_date", "risk", "date_key", "cal", "date_key"),
    _orphan_sql("stockout_orphan_store", "risk", "store_key", "store", "store_key"),
    _orphan_sql("stockout_orphan_item", "risk", "item_key", "it", "item_nbr"),
    _orphan_sql("store_day_orphan_date", "tx", "date", "cal", "date"),
    _orphan_sql("store_day_orphan_store", "tx", "store_nbr", "store", "store_key"),
    _unique_sql("stg_store_day_unique_grain", "tx", "date, store_nbr"),
    _unique_sql("stockout_unique_grain", "risk", "date_key, store_key, item_key"),
    "SELECT 'store_days_without_sales' AS \"check\", count(*) AS violations FROM tx "
    "WHERE receipts > 0 AND (store_nbr, date) NOT IN (SELECT (store_nbr, date) FROM sales)",
    "SELECT 'negative_units' AS \"check\", count(*) AS violations FROM fs WHERE least(units, return_units) < 0",
    "SELECT 'store_type_values' AS \"check\", count(*) AS violations FROM store WHERE ascii(type) NOT BETWEEN 65 AND 69",
    """SELECT 'totals_reconcile_by_year' AS "check", count(*) AS violations FROM (
         SELECT year(date) AS y, sum(units - return_units) AS a FROM fs GROUP BY 1) FULL JOIN (
         SELECT year(date) AS y, sum(unit_sales) AS b FROM l GROUP BY 1) USING (y)
       WHERE NOT (abs(coalesce(a, 0) - coalesce(b, 0)) <= 0.000001 * greatest(abs(coalesce(b, 0)), 1))""",
]
for _i, _sql in enumerate(GOLD_CHECK_SQL, 1):
    _name = _sql.split("'")[1]
    add(f"c{_i}_{_name}", MID, lambda s, n=_name: checks.gold_check(n, _check_tables(s)), CHECK_SPEC, _sql)


def _master_for_checks(s: Stage) -> dict[str, DataFrame]:
    return {**_master_tables(s), "sales_target_day": s.t("sales_target_day")}


C19 = """SELECT 'targets_add_up' AS "check", count(*) AS violations FROM goal JOIN (
  SELECT store_key, date_trunc('month', date)::DATE AS month_start, sum(target_value) AS total FROM daily GROUP BY ALL)
  USING (store_key, month_start) WHERE total - target_value <> 0"""
C20 = """SELECT 'no_target_on_closures' AS "check", count(*) AS violations FROM daily
  WHERE (month(date), day(date)) IN ((12, 25), (1, 1))"""
C21 = """SELECT 'targets_have_days' AS "check", count(*) AS violations FROM goal g WHERE NOT EXISTS (
  FROM daily d WHERE d.store_key = g.store_key AND d.date BETWEEN g.month_start AND last_day(g.month_start))"""
C22 = """SELECT 'cities_have_weather' AS "check", count(*) AS violations FROM geo WHERE city NOT IN (SELECT city FROM weather)"""
C23 = """SELECT 'price_above_cost' AS "check", count(*) AS violations FROM item WHERE NOT (unit_cost > 0 AND unit_price > unit_cost)"""
add("c19_targets_add_up", FINE, lambda s: checks.targets_add_up(s.t("sales_target_month"), s.t("sales_target_day")), CHECK_SPEC, C19)
add("c20_no_target_on_closures", FINE, lambda s: checks.no_target_on_closures(s.t("sales_target_day")), CHECK_SPEC, C20)
add("c21_targets_have_days", FINE, lambda s: checks.targets_have_days(s.t("sales_target_month"), s.t("sales_target_day")), CHECK_SPEC, C21)
add("c22_cities_have_weather", FINE, lambda s: checks.cities_have_weather(s.t("city_geo"), s.t("weather_daily")), CHECK_SPEC, C22, GEO)
add("c23_price_above_cost", FINE, lambda s: checks.price_above_cost(s.t("item_price")), CHECK_SPEC, C23)
C24 = """SELECT 'weekday_range' AS "check", count(*) FILTER (weekday_num < 1 OR weekday_num > 7) AS violations FROM weights
UNION ALL SELECT 'weight_positive', count(*) FILTER (weight <= 0) FROM weights
UNION ALL SELECT 'month_starts_on_day_1', count(*) FILTER (day(month_start) > 1) FROM goal
UNION ALL SELECT 'target_positive', count(*) FILTER (target_value <= 0) FROM goal
UNION ALL SELECT 'area_positive', count(*) FILTER (selling_area_m2 <= 0) FROM st"""
add("c24_value_ranges", FINE,
    lambda s: checks.all_results(checks.value_ranges(s.t("weekday_weight"), s.t("sales_target_month"), s.t("store_profile"))),
    CHECK_SPEC, C24)
C25 = """SELECT 'state_region_fk_region' AS "check", (SELECT count(*) FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)) AS violations
UNION ALL SELECT 'weekday_weight_fk_store', (SELECT count(*) FROM weights WHERE store_key NOT IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'sales_target_fk_store', (SELECT count(*) FROM goal WHERE store_key NOT IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'weather_fk_city', (SELECT count(*) FROM weather WHERE city NOT IN (SELECT city FROM geo))
UNION ALL SELECT 'user_access_fk_store', (SELECT count(*) FROM access WHERE store_key NOT IN (SELECT s_suppkey FROM supplier))"""
add("c25_foreign_keys", FINE, lambda s: checks.all_results(checks.foreign_keys(_master_for_checks(s))), CHECK_SPEC, C25,
    ACCESS + "," + GEO)
add("c26_weights_sum_to_one", FINE, lambda s: checks.weights_sum_to_one(s.t("weekday_weight"), "store_key"), CHECK_SPEC,
    """SELECT 'weights_sum_to_one' AS "check", count(*) FILTER (abs(w - 1) > 1e-9) AS violations
       FROM (SELECT sum(weight) AS w FROM weights GROUP BY store_key)""")


def _two_roads(s: Stage) -> tuple[DataFrame, DataFrame]:
    """Units and value per year and nation, from the conformed star and from raw lines; both written."""
    star = s.t("fact_sales").join(s.t("dim_store").select("store_key", "city"), "store_key").join(
        s.t("dim_item").select("item_key", F.col("unit_price").cast("double").alias("p")), "item_key")
    left = star.groupBy(F.expr("date_key div 10000").alias("year"), "city").agg(
        F.sum("units").alias("units"), F.sum(F.col("units") * F.col("p")).alias("sales"))
    parts = s.feed.raw("part").select("p_partkey", "p_retailprice")
    nations = s.feed.raw("supplier").join(s.feed.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("city"))
    sold = F.greatest("unit_sales", F.lit(0.0))
    right = (
        s.feed.train().join(nations, F.col("store_nbr") == F.col("s_suppkey"))
        .join(parts, F.col("item_nbr") == F.col("p_partkey"))
        .groupBy(F.year("date").cast("bigint").alias("year"), "city")
        .agg(F.sum(sold).alias("units"), F.sum(sold * F.col("p_retailprice")).alias("sales"))
    )
    return written(left), written(right)


def _reconcile(s: Stage) -> DataFrame:
    """Cells that differ between the two roads: none as loaded, and the changed ones where one road is changed."""
    left, right = _two_roads(s)
    odd = (F.col("city") == "NATION_3") & (F.col("year") >= 1996)
    changed = right.filter(~(odd & (F.col("year") == 1997))).withColumn("units", F.col("units") + F.when(odd, 1.0).otherwise(0.0))
    found = [checks.reconcile(left, side, ["year", "city"], ["units", "sales"], by=["year"]).withColumn("variant", F.lit(name))
             for name, side in (("as loaded", right), ("changed", changed))]
    return found[0].unionByName(found[1])


add("c27_reconcile_cells", FINE, _reconcile,
    "variant:s year:i city:s units_left:2 units_right:2 sales_left:2 sales_right:2",
    """SELECT 'changed' AS variant, year, city, sum(units) AS units_left, CASE WHEN year <> 1997 THEN sum(units) + 1 END AS units_right,
         sum(value) AS sales_left, CASE WHEN year <> 1997 THEN sum(value) END AS sales_right
       FROM S WHERE city = 'NATION_3' AND year >= 1996 GROUP BY year, city""")


def _gate(s: Stage) -> DataFrame:
    """The gate before an export, with the tables as they are and with a negative amount planted: is the way open, and why not?"""
    found = _check_tables(s)
    planted = {**found, "fact_sales": found["fact_sales"].withColumn("units", F.when(F.col("on_promo"), -F.col("units") - 1).otherwise(F.col("units")))}
    rows = []
    for variant, given in (("as built", found), ("planted", planted)):
        try:
            checks.gate(checks.gold_checks(given))
            rows.append((variant, True, None, 0))
        except checks.GateClosed as closed:
            rows += [(variant, False, check, n) for check, n in closed.table]
    return s.spark.createDataFrame(rows, "variant string, open boolean, check string, violations bigint")


GATE_ROWS = " UNION ALL ".join(GOLD_CHECK_SQL)
add("c29_gate_closes", MID, _gate, "variant:s open:b check:s violations:i", f"""
SELECT 'as built' AS variant, sum(violations) = 0 AS open, NULL AS "check", 0 AS violations FROM ({GATE_ROWS})
HAVING sum(violations) = 0
UNION ALL SELECT 'as built', false, "check", violations FROM ({GATE_ROWS}) WHERE violations > 0
UNION ALL SELECT 'planted', false, "check", violations FROM ({GATE_ROWS}) WHERE violations > 0 AND "check" NOT IN ('negative_units', 'totals_reconcile_by_year')
UNION ALL SELECT 'planted', false, 'negative_units', count(*) FROM fs WHERE on_promo OR units < 0
UNION ALL SELECT 'planted', false, 'totals_reconcile_by_year', count(*) FROM (SELECT year(date) AS y FROM fs GROUP BY 1 HAVING count(*) FILTER (on_promo) > 0)""")
add("c29_gate", MID, lambda s: checks.all_results(checks.gold_checks(_check_tables(s))), CHECK_SPEC,
    " UNION ALL ".join(GOLD_CHECK_SQL))

# --- X: deep-dive producers -----------------------------------------------------------------------------------------

add("x1_zero_sale_runs", MID, lambda s: deepdive.zero_sale_runs(s.t("series"), s.cfg),
    "store_nbr:i item_nbr:i start_date:d end_date:d run_days:i spine_days:i calendar_days:i lambda_units:6 dispersion:6",
    "SELECT * FROM tested")
add("x2_run_p_values", MID, lambda s: s.t("tested_runs"),
    "store_nbr:i item_nbr:i start_date:d run_days:i p_value:9 p_poisson:9", "SELECT * FROM tested")
add("x3_bh_flags", MID, lambda s: deepdive.flag_runs(s.t("tested_runs"), s.cfg),
    "store_nbr:i item_nbr:i start_date:d is_flagged:b", "SELECT * FROM flagged")
add("x3_bh_summary", MID, lambda s: deepdive.test_summary(s.t("tested_runs"), s.cfg),
    "tested_runs:i flagged_runs:i bh_cutoff:9 max_chance_flags:4 poisson_flagged_runs:i",
    """SELECT m AS tested_runs, count(*) FILTER (p_value <= cutoff) AS flagged_runs, cutoff AS bh_cutoff, cutoff * m AS max_chance_flags,
         count(*) FILTER (p_poisson <= poisson_cutoff) AS poisson_flagged_runs FROM tested, cut GROUP BY m, cutoff""")
add("x4_expected_lost_units", MID,
    lambda s: s.t("tested_runs").groupBy("store_nbr").agg(F.sum("expected_lost_units").alias("expected_lost_units")),
    "store_nbr:i expected_lost_units:4",
    "SELECT store_nbr, sum(expected_lost_units) AS expected_lost_units FROM tested GROUP BY 1")
add("x5_stockout_store_week", MID,
    lambda s: deepdive.store_weeks(s.t("series"), s.t("flagged_runs"), s.t("trading"), s.t("stg_store"), s.cfg),
    "store_key:i city:s week_start:d week_start_key:i item_days:i flagged_days:i rate:6",
    """SELECT store_key, city, week_start, strftime(week_start, '%Y%m%d')::INT AS week_start_key, item_days, flagged_days,
         flagged_days / item_days AS rate FROM week JOIN store USING (store_key)""")
EVENT_KEYS = "store_key:i item_key:i family:s start_date_key:i end_date_key:i promo_days:i"
EVENT_SQL = """SELECT store_key, item_key, family, strftime(start_date, '%Y%m%d')::INT AS start_date_key,
  strftime(end_date, '%Y%m%d')::INT AS end_date_key, promo_days, promo_units, baseline_units, uplift, post_units,
  post_expected AS post_expected_units, post_dip, net_lift, special AS touches_payday_or_holiday FROM events_done"""


def _events(s: Stage) -> DataFrame:
    return deepdive.promo_events(s.t("fact_sales"), s.t("dim_date"), s.t("stg_item"), s.cfg)


add("x6_promo_events", MID, _events,
    EVENT_KEYS + " promo_units:2 baseline_units:4 uplift:8 post_units:2 post_expected_units:4 post_dip:8 net_lift:8", EVENT_SQL)
add("x7_payday_holiday_flag", MID, _events, EVENT_KEYS + " touches_payday_or_holiday:b", EVENT_SQL)

# the published constants of the minimal standard generator, and Poisson(1) until 31 bits are used up
_MODULUS, _FACTOR = 2147483647, 48271
_ends = [round(_MODULUS * sum(1 / math.factorial(i) for i in range(k + 1)) / math.e) for k in range(13)]
_steps = list(itertools.accumulate([_FACTOR] * 200, lambda x, f: x * f % _MODULUS))
PAYBACK = f"""
vals AS (
  SELECT family, store_key, item_key, strftime(start_date, '%Y%m%d') AS k, metric, floor(v * 10000 + 0.5 + 1e-6)::BIGINT AS v FROM (
    SELECT family, store_key, item_key, start_date, 'uplift' AS metric, uplift AS v FROM events_done UNION ALL
    SELECT family, store_key, item_key, start_date, 'dip', post_dip FROM events_done UNION ALL
    SELECT family, store_key, item_key, start_date, 'net', net_lift FROM events_done) WHERE v IS NOT NULL),
seeds AS (
  SELECT store_key, item_key, k,
    ('0x' || md5(store_key || ':' || item_key || ':' || k)[:8])::BIGINT % {_MODULUS - 1} + 1 AS seed
  FROM (SELECT DISTINCT store_key, item_key, k FROM vals)),
steps AS (SELECT unnest({_steps}) AS factor, unnest(range(200)) AS replicate),
drawn AS (SELECT store_key, item_key, k, replicate, seed * factor % {_MODULUS} AS word FROM seeds, steps),
weighted AS (
  SELECT family, metric, replicate, v, sum({' + '.join(f'(word > {e})::INT' for e in _ends)}) AS w
  FROM vals JOIN drawn USING (store_key, item_key, k) GROUP BY ALL),
ranked AS (
  SELECT family, metric, replicate, v, sum(w) OVER (PARTITION BY family, metric, replicate ORDER BY v) AS upto,
    sum(w) OVER (PARTITION BY family, metric, replicate) AS n FROM weighted WHERE w > 0),
replica AS (
  SELECT family, metric, replicate,
    (min(v) FILTER (upto >= (n + 1) // 2) + min(v) FILTER (upto >= n // 2 + 1)) / 2 / 10000 AS m
  FROM ranked GROUP BY ALL),
summed AS (
  SELECT family, metric, n, med, lo, hi FROM
    (SELECT family, metric, count(*) AS n, median(v) / 10000 AS med FROM vals GROUP BY ALL) LEFT JOIN
    (SELECT family, metric, quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi FROM replica GROUP BY ALL) USING (family, metric)),
payback AS (
  SELECT family, u.n AS n_events, u.med AS uplift_median, u.lo AS uplift_lo, u.hi AS uplift_hi, coalesce(d.n, 0) AS n_dip_events,
    d.med AS dip_median, d.lo AS dip_lo, d.hi AS dip_hi, coalesce(e.n, 0) AS n_net_events, e.med AS net_median, e.lo AS net_lo, e.hi AS net_hi
  FROM (FROM summed WHERE metric = 'uplift') u LEFT JOIN (FROM summed WHERE metric = 'dip') d USING (family)
  LEFT JOIN (FROM summed WHERE metric = 'net') e USING (family))"""
add("x8_promo_family_summary", MID, lambda s: deepdive.promo_family_summary(s.t("fact_promo_event"), s.cfg),
    "family:s n_events:i uplift_median:8 uplift_lo:8 uplift_hi:8 n_dip_events:i dip_median:8 dip_lo:8 dip_hi:8 "
    "n_net_events:i net_median:8 net_lo:8 net_hi:8", "SELECT * FROM payback", PAYBACK)
