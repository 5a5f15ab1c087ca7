"""What the plans read, shuffle and multiply."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from aisleframe.operators import deepdive, gold
from aisleframe.plans import measures, timecalc
from aisleframe.plans.measures import Grouping, evaluate, evaluate_levels
from aisleframe.plans.reports import drill, sliced
from aisleframe.plans.star import Star


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(full, spark):
    """The hand fixture's facts with plain dimensions."""
    days = full.table("dim_date")
    stores = full.table("stg_store").selectExpr("*", "'North' AS region", "1 AS selling_area_m2")
    items = full.table("stg_item").selectExpr("*", "CAST(2.5 AS DECIMAL(10,2)) AS unit_price", "CAST(1.5 AS DECIMAL(10,2)) AS unit_cost")
    return Star.of({"dim_date": lambda: days, "dim_store": lambda: stores, "dim_item": lambda: items,
                    "fact_sales": lambda: full.stored("fact_sales"), "fact_stockout_risk": lambda: full.stored("fact_stockout_risk")})


def test_windows_over_the_series_need_no_exchange(full):
    series = full.table("series")
    for df in (gold.fact_stockout_risk(series, full.cfg), deepdive.zero_sale_runs(series, full.cfg)):
        assert "Exchange" not in plan_of(df) and "Bucketed: true" in plan_of(df)
    weeks = deepdive.store_weeks(series, full.table("flagged_runs"), full.table("trading"), full.table("stg_store"), full.cfg)
    # of the series only sums per store and week are shuffled
    tested = plan_of(weeks).split("Window")[0]
    below = plan_of(weeks)[len(tested):].split("FileScan")[0]
    assert "Exchange" not in below and "partial_count" in tested


def test_a_day_opens_the_folders_of_its_month(star, full):
    one_day = sliced(star, day=date(2016, 2, 10))
    full.spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = plan_of(evaluate(one_day, ["store_name"], ["sales_value"]))
    full.spark.conf.unset("spark.sql.maxMetadataStringLength")
    fact = next(line for line in plan.splitlines() if "FileScan" in line and "fact_sales" in line)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", fact).group(1)
    assert "fact_month" in filters and "201602" in filters and "GreaterThanOrEqual(date_key,20160210)" in fact
    assert "dynamicpruning" in filters.lower() or filters.count("201602") == 2
    months = [r[0] for r in full.stored("fact_sales").select("fact_month").distinct().collect()]
    assert 201602 in months and len(months) == 15


def test_running_totals_give_each_cell_and_group_one_row(star, monkeypatch):
    joined = []
    real = measures._running
    monkeypatch.setattr(measures, "_running", lambda *a: joined.append(real(*a)) or joined[-1])
    cells = timecalc.side_by_side(star, star.cells(["date"]), [timecalc.ACTUAL, timecalc.MTD, timecalc.YTD, timecalc.PY_YTD])
    found = measures.sales_block(star, Grouping.of(["date", "family"]), cells, ["units", "value"])
    assert [j.count() for j in joined] == [j.select("c_date", "c_show_as", "family").distinct().count() for j in joined] and len(joined) == 3
    monkeypatch.undo()
    # the same figures with every date of each cell joined
    from dataclasses import replace
    plain = measures.sales_block(star, Grouping.of(["date", "family"]), replace(cells, runs=(), plain=None), ["units", "value"])
    key = ["c_date", "c_show_as", "family"]
    gap = found.join(plain.withColumnsRenamed({"units": "u", "value": "v"}), key, "full_outer")
    assert gap.filter("abs(units - u) > 1e-6 OR abs(value - v) > 1e-6 OR units IS NULL OR u IS NULL").count() == 0
    assert found.count() == plain.count() > 1000


@pytest.mark.parametrize("item", [timecalc.MTD, timecalc.YTD, timecalc.PY_YTD])
def test_last_days_of_runs_are_those_of_their_dates(star, item):
    for by in (["date"], ["year", "month_num"], ["weekday_num"]):
        moved = timecalc.apply(star, star.cells(by), item)
        (unit, ends), = moved.runs
        dates = moved.frame.groupBy(*moved.columns).agg(F.min("date").alias("lo"), F.max("date").alias("last"), F.count("*").alias("n"))
        both = {tuple(r) for r in ends.select(*moved.columns, "hi").collect()}
        assert both == {tuple(r) for r in dates.select(*moved.columns, "last").collect()} and both
        # no gap inside, and the first date is the period's first on the calendar
        start = F.greatest(F.trunc("last", unit).cast("date"), F.lit(star.data_start))
        assert dates.filter((F.col("lo") != start) | (F.datediff("last", "lo") + 1 != F.col("n"))).count() == 0


def test_a_hierarchy_reads_its_fact_once(star):
    df = drill(star, ["units", "gross_margin_pct"])
    assert len(re.findall(r"FileScan[^\n]*fact_sales", plan_of(df))) == 1
    levels = ["year", "quarter", "month_num", "date"]
    rows = {tuple(r) for r in df.select(*levels, "depth", F.round("units", 4), F.round("gross_margin_pct", 8)).collect()}
    apart = set()
    for depth in range(1, 5):
        one = evaluate(star, levels[:depth], ["units", "gross_margin_pct"])
        missing = [F.lit(None).alias(c) for c in levels[depth:]]
        apart |= {tuple(r) for r in one.select(*levels[:depth], *missing, F.lit(depth), F.round("units", 4), F.round("gross_margin_pct", 8)).collect()}
    assert rows == apart and {r[4] for r in rows} == {1, 2, 3, 4}


def test_levels_of_figures_that_do_not_add_up_are_evaluated_apart(star):
    found = evaluate_levels(star, ["year", "month_num"], ["lfl_sales"])
    whole = evaluate(star, ["year"], ["lfl_sales"])
    assert {(r.year, r.lfl_sales) for r in found.filter("depth = 1").collect()} == {(r.year, r.lfl_sales) for r in whole.collect()}
