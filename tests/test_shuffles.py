"""What the plans shuffle: days are made after the shuffles, facts are dealt out by month once."""

import re
from datetime import date

import pytest

from aisleframe.functions.columns import tasks_for
from aisleframe.operators import conform, gold, targets
from aisleframe.plans import measures, star
from aisleframe.plans.warehouse import FACT_MONTH, Warehouse


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan(df))


def test_days_of_targets_are_made_after_the_shuffles(spark, tmp_path):
    months = [(s, date(2016, m, 1), 100.01 * s) for s in (1, 2) for m in (1, 2, 12)]
    spark.createDataFrame(months, "store_nbr long, month_start date, target_value double").selectExpr(
        "store_nbr", "month_start", "cast(target_value as decimal(14,2)) target_value").write.parquet(f"{tmp_path}/m")
    shares = [(1, d, w) for d, w in zip(range(1, 8), (0.1, 0.2, 0.3, 0.1, 0.1, 0.1, 0.1))] + [(2, 3, 1.0), (3, 1, 1.0)]
    spark.createDataFrame(shares, "store_key long, weekday_num int, weight double").write.parquet(f"{tmp_path}/w")
    wanted, weights = spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/w")
    daily = targets.daily_targets(wanted, weights)
    assert "Window" not in plan(daily)
    assert not any("target_date" in keys for keys in exchanges(daily))
    rows = {(r["store_nbr"], r["target_date"]): r["target_value"] for r in daily.collect()}
    for store, month, _ in months:
        total = sum(v for (s, d), v in rows.items() if s == store and d.replace(day=1) == month)
        assert float(total) == pytest.approx(100.01 * store)
    days = sorted(d for s, d in rows if s == 1)
    assert len(days) == 31 + 29 + 31 - 2 and date(2016, 12, 25) not in days and date(2016, 1, 1) not in days
    # a store that sells on one weekday only has targets on that day: the last one takes the rest
    assert sorted(d for s, d in rows if s == 2 and d.month == 2) == [date(2016, 2, n) for n in (3, 10, 17, 24)]


def test_a_store_without_value_keeps_its_days_without_targets(spark):
    months = spark.sql("select 1L store_nbr, date'2016-02-01' month_start, cast(10 as decimal(14,2)) target_value")
    weights = spark.sql("select 1L store_key, cast(1 as int) weekday_num, cast(null as double) weight")
    rows = targets.daily_targets(months, weights).collect()
    assert len(rows) == 5 and {r["target_value"] for r in rows} == {None}


def test_store_days_are_dealt_out_once_and_by_month(spark, full):
    days = full.table("stg_store_day")
    planned = spark.sql("""select store_nbr, target_date, cast(1 as decimal(14,2)) target_value from (select explode(array(1, 2, 9)) store_nbr)
        cross join (select explode(sequence(date'2015-12-01', date'2016-05-31')) target_date)""")
    sky = spark.sql("select 'Quito' city, date'2016-01-05' weather_date, 2.5 rain_mm, 20.0 temp_max_c")
    made = conform.fact_store_day(days, planned, full.table("dim_date"), full.table("stg_store"), sky)
    assert sum("store_key" in keys and "date_key" in keys for keys in exchanges(made)) == 0
    assert any("_month" in keys and "_slice" in keys for keys in exchanges(made))
    assert made.count() == made.select("date_key", "store_key").distinct().count()


def test_days_of_monthly_targets_are_made_where_their_month_has_come_to(spark, full):
    wanted = spark.sql("""select store_nbr, month_start, cast(100.01 * store_nbr as decimal(14,2)) target_value from (select explode(array(1L, 2L, 9L)) store_nbr)
        cross join (select explode(sequence(date'2015-12-01', date'2016-05-01', interval 1 month)) month_start)""")
    weights = spark.sql("select store_key, cast(d as int) weekday_num, d / 28D weight from values (1L), (2L), (9L) s(store_key) cross join (select explode(sequence(1, 7)) d)")
    sky = spark.sql("select 'Quito' city, date'2016-01-05' weather_date, 2.5 rain_mm, 20.0 temp_max_c")
    tables = full.table("dim_date"), full.table("stg_store"), sky
    made = conform.fact_store_day(full.table("stg_store_day"), wanted, *tables, weights)
    # both sides are dealt out alike, before the days are made; the grouping takes them as they come
    before, after = plan(made).split("Generate explode(sequence(month_start")
    assert all(side.count("Exchange hashpartitioning(_month") == 1 for side in (before, after))
    assert not any("date_key" in keys and "store_key" in keys for keys in exchanges(made))
    of_days = conform.fact_store_day(full.table("stg_store_day"), targets.daily_targets(wanted, weights), *tables)
    assert sorted(map(str, made.collect())) == sorted(map(str, of_days.collect()))


def test_facts_dealt_out_by_month_are_not_shuffled_again(spark, full, tmp_path):
    class Written(Warehouse):
        def _fact_store_day(self):
            self.made = spark.range(100).selectExpr("cast(20160101 + id % 28 as int) date_key", "id store_key")
            return self.made

    house = Written(spark, full.inputs, str(tmp_path), full.cfg)
    table = house.stored("fact_store_day")
    assert table.count() == 100 and [r[0] for r in table.select(FACT_MONTH).distinct().collect()] == [201601]
    files = list((tmp_path / "fact_store_day").glob("*/*.parquet"))
    assert len(files) == spark.sparkContext.defaultParallelism  # as the tasks were; rebalanced rows would be one file


def test_sales_meet_their_trading_days_where_they_are_dealt_out_by_month(spark, full):
    sales, trading = full.table("sales"), full.table("trading")
    fact = gold.fact_sales(sales, trading, full.cfg)
    dealt = [keys for keys in exchanges(fact) if "date" in keys or "_month" in keys]
    assert len(dealt) == 1 and "_month" in dealt[0] and "Join" not in plan(fact)
    assert "fact_sales" in Warehouse.BY_MONTH and fact.count() == sales.count()
    # a day without trading has no baseline; trading days without sales add no rows
    closed = gold.fact_sales(sales, trading.filter("store_nbr <> 1"), full.cfg)
    assert closed.count() == sales.count()
    baseline = "baseline_units is not null"
    assert fact.filter(baseline).filter("store_key = 1").count() > 0 == closed.filter(baseline).filter("store_key = 1").count()
    assert sorted(map(str, closed.filter("store_key <> 1").collect())) == sorted(map(str, fact.filter("store_key <> 1").collect()))


def test_more_rows_have_more_tasks(spark):
    assert tasks_for(spark.range(10)) == 8
    assert tasks_for(spark.range(5_000_000), spark.range(4_500_001)) == 20


def test_store_months_are_one_grouping(spark, full):
    prices = full.table("stg_item").selectExpr("item_nbr", "cast(2 as decimal(10,2)) unit_price")
    months = targets.store_month_value(full.table("fact_sales"), full.table("dim_date"), prices)
    assert not any("date#" in keys.split(",")[-1] and "trunc" not in keys for keys in exchanges(months) if "store_key" in keys)
    fact = full.table("fact_sales").toPandas()
    fact["month"] = fact["date_key"] // 100
    for r in months.collect():
        own = fact[(fact["store_key"] == r["store_key"]) & (fact["month"] == r["month_start"].year * 100 + r["month_start"].month)]
        assert r["active_days"] == own["date_key"].nunique()
        assert r["sales_value"] == pytest.approx(2 * own["units"].sum())


def test_the_selected_stores_are_a_written_table_of_known_size(full):
    assert "parquet" in plan(full.table("selected_stores")).lower()


def test_months_with_targets_are_found_without_sums_per_day(spark):
    fact = spark.sql("select 20160101 date_key, 1L store_key, 1L item_key, 2D units, cast(3 as decimal(19,4)) target_value, 201601 fact_month")
    dates = spark.sql("select 20160101 date_key, date'2016-01-01' date, 2016 year")
    items = spark.sql("select 1L item_key, cast(5 as decimal(10,2)) unit_price")
    stores = spark.sql("select 1L store_key, 'N' region, 'Quito' city, 1L store_nbr")
    of = star.Star.of({
        "dim_date": lambda: dates, "dim_store": lambda: stores, "dim_item": lambda: items, "fact_sales": lambda: fact.drop("target_value"),
        "fact_store_day": lambda: fact.select("date_key", "store_key", "target_value", "fact_month")})
    group = measures.Grouping.of(["region"])
    figures = measures.target_block(of, group, None, ["covered"])
    assert not any("date_key" in keys for keys in exchanges(figures))
    assert [tuple(r) for r in figures.collect()] == [("N", 10.0, 3.0)]


def test_shuffles_start_with_more_partitions_for_more_lines(spark, tmp_path):
    from aisleframe.session import STARTING_PARTITIONS
    from queries.stage import FINE, stage

    kept = spark.conf.get(STARTING_PARTITIONS, None)
    try:
        for rows, partitions in ((1_000, 8), (6_000_000, 12)):
            spark.range(rows).selectExpr("id l_orderkey").write.parquet(f"{tmp_path}/{rows}/lineitem.parquet")
            stage(spark, f"{tmp_path}/{rows}", FINE)
            assert spark.conf.get(STARTING_PARTITIONS) == str(partitions)
    finally:
        spark.conf.unset(STARTING_PARTITIONS) if kept is None else spark.conf.set(STARTING_PARTITIONS, kept)
