"""Measures, time calculations, reports and access on a small hand-made star."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from aisleframe.functions.calendar import months_before
from aisleframe.operators import checks
from aisleframe.plans import reports, security, timecalc
from aisleframe.plans.measures import evaluate, evaluate_with_total
from aisleframe.plans.star import AccessDenied, Star

LO, HI = date(2015, 1, 1), date(2017, 8, 15)


def key(day: date) -> int:
    return int(day.strftime("%Y%m%d"))


@pytest.fixture(scope="module")
def star(spark):
    cal = spark.sql(f"""
        SELECT int(date_format(d, 'yyyyMMdd')) AS date_key, d AS date, year(d) AS year, quarter(d) AS quarter, month(d) AS month_num,
               date_format(d, 'MMM') AS month_name, year(d) * 100 + month(d) AS month_key, weekday(d) + 1 AS weekday_num,
               date_format(d, 'E') AS weekday_name, false AS is_national_holiday
        FROM (SELECT explode(sequence(date'{LO}', date'{HI}')) AS d)""")
    stores = spark.createDataFrame(
        [(1, 1, "Quito", "Pichincha", "A", 1, None, 900, "North"), (2, 2, "Quito", "Pichincha", "B", 1, date(2016, 3, 1), 800, "North"),
         (3, 3, "Cuenca", "Azuay", "C", 2, None, 700, "South")],
        "store_key int, store_nbr int, city string, state string, store_type string, cluster int, opening_date date, "
        "selling_area_m2 int, region string")
    items = spark.createDataFrame(
        [(10, 10, "DAIRY", 1, True, "2.00", "1.00"), (20, 20, "BOOKS", 2, False, "5.00", "4.00")],
        "item_key int, item_nbr int, family string, class int, is_perishable boolean, p string, c string").select(
        "item_key", "item_nbr", "family", "class", "is_perishable", F.col("p").cast("decimal(10,2)").alias("unit_price"),
        F.col("c").cast("decimal(10,2)").alias("unit_cost"))
    # one unit of each item a day; store 2 from its opening, twice as much for store 1 in 2017
    sales = cal.select("date_key", "date").join(stores.select("store_key", "opening_date")).filter(
        "opening_date IS NULL OR date >= opening_date").join(items.select("item_key")).select(
        "date_key", "store_key", "item_key",
        F.when((F.col("store_key") == 1) & (F.col("date_key") >= 20170101), 2.0).otherwise(1.0).alias("units"),
        F.lit(0.0).alias("return_units"), F.lit(None).cast("boolean").alias("on_promo"), F.lit(False).alias("post_promo_window"),
        F.lit(None).cast("double").alias("baseline_units"))
    day = sales.select("date_key", "store_key").distinct().select(
        "date_key", "store_key", F.lit(10).cast("bigint").alias("receipts"),
        F.when((F.col("store_key") == 1) & (F.col("date_key") >= 20170701), F.lit(7)).cast("decimal(19,4)").alias("target_value"),
        F.when(F.col("store_key") == 3, 4.0).otherwise(1.0).alias("rain_mm"), F.lit(None).cast("double").alias("temp_max_c"))
    risk = spark.createDataFrame(
        [(20170801, 1, 10, 2.5), (20170808, 1, 10, 1.0), (20170809, 1, 10, 1.0), (20170815, 2, 20, 3.0), (20170815, 99, 10, 4.0)],
        "date_key int, store_key int, item_key int, expected_units double")
    access = spark.createDataFrame(
        [("north@x", 1), ("north@x", 2), ("south@x", 3)], "user_principal_name string, store_key int")
    events = spark.createDataFrame(
        [(20170105, 1, 10, 0.5, None), (20170205, 1, 10, 1.5, 0.25), (20170305, 3, 20, 2.5, 0.75)],
        "start_date_key int, store_key int, item_key int, uplift double, net_lift double")
    payback = spark.createDataFrame(
        [("DAIRY", 0.2, 0.1, 0.3, 0.5, -0.1), ("BOOKS", 0.1, -0.1, 0.2, 0.4, -0.2)],
        "family string, net_median double, net_lo double, net_hi double, uplift_median double, dip_median double")
    frames = {"dim_date": cal, "dim_store": stores, "dim_item": items, "fact_sales": sales, "fact_store_day": day,
              "fact_stockout_risk": risk, "user_access": access, "fact_promo_event": events, "promo_family_summary": payback}
    return Star.of({name: (lambda f=frame: f) for name, frame in frames.items()})


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_months_before_clips():
    assert months_before(date(2016, 2, 29), 12) == date(2015, 2, 28)
    assert months_before(date(2015, 1, 31), -1) == date(2015, 2, 28)


def test_value_cost_margin_and_fresh_share(star):
    jan = star.where(dates=F.col("month_key") == 201501, stores=F.col("store_key") == 1)
    row = one(evaluate(jan, [], ["units", "sales_value", "cost_value", "gross_margin_pct", "fresh_share_pct"]))
    assert tuple(row) == (62.0, 217.0, 155.0, pytest.approx(62 / 217), pytest.approx(2 / 7))


def test_blank_groups_vanish_and_empty_total_is_blank(star):
    none = star.where(dates=F.col("year") == 2015, stores=F.col("store_key") == 2)
    assert evaluate(none, ["store_name"], ["sales_value", "gross_margin_pct"]).collect() == []
    assert one(evaluate(none, [], ["sales_value"])).sales_value is None


def test_growth_of_the_comparable_part_capped_at_the_last_day(star):
    """2017 holds 227 days; its prior year is cut at 15 August 2016 although the data ends mid-month."""
    row = one(evaluate(star.where(dates=F.col("year") == 2017, stores=F.col("store_key") == 3), [],
                       ["lfl_sales", "lfl_sales_py", "lfl_growth_pct", "lfl_receipts", "lfl_receipts_py"]))
    assert row.lfl_sales == 227 * 7 and row.lfl_sales_py == 228 * 7  # 2016 has 29 February
    assert row.lfl_growth_pct == pytest.approx(-1 / 228) and (row.lfl_receipts, row.lfl_receipts_py) == (2270, 2280)
    august = star.where(dates=F.col("month_key") == 201708, stores=F.col("store_key") == 3)
    assert one(evaluate(august, [], ["lfl_growth_pct"])).lfl_growth_pct == 0.0


def test_new_store_counts_only_a_year_after_opening_and_unknown_opening_always(star):
    years = {r.year: r for r in evaluate(star.where(stores=F.col("region") == "North"), ["year"], ["lfl_sales"]).collect()}
    assert set(years) == {2016, 2017}  # 2015 has no prior year
    assert years[2016].lfl_sales == 366 * 7 and years[2017].lfl_sales == 227 * 14  # store 2 opened after 2016-01-01
    april = star.where(dates=F.col("month_key") == 201704, stores=F.col("store_key") == 2)
    assert one(evaluate(april, [], ["lfl_sales"])).lfl_sales == 30 * 7


def test_total_growth_is_not_the_sum_of_its_months(star):
    """The year starts before store 2's anniversary, later months do not."""
    north = star.where(stores=F.col("store_key") == 2, dates=F.col("year") == 2017)
    months = evaluate(north, ["month_num"], ["lfl_sales"]).agg(F.sum("lfl_sales")).first()[0]
    assert months > 0 and one(evaluate(north, [], ["lfl_sales"])).lfl_sales is None


def test_basket_growth_splits_sales_growth(star):
    row = one(evaluate(star.where(dates=F.col("month_key") == 201705, stores=F.col("store_key") == 1), [],
                       ["lfl_growth_pct", "lfl_footfall_growth_pct", "lfl_basket_growth_pct"]))
    assert tuple(row) == (1.0, 0.0, 1.0)


def test_sales_against_target_only_where_there_is_a_target(star):
    row = one(evaluate(star, [], ["sales_vs_target_pct", "target", "sales_value"]))
    covered = (31 + 15) * 14
    assert row.target == 46 * 7 and row.sales_vs_target_pct == pytest.approx((covered - 322) / 322) == 1.0
    regions = {r.region: r.sales_vs_target_pct for r in evaluate(star, ["region"], ["sales_vs_target_pct"]).collect()}
    assert regions == {"North": 1.0}


def test_item_selection_does_not_reach_receipts_or_targets(star):
    day = star.where(dates=F.col("date") == F.lit(date(2017, 7, 3)), stores=F.col("store_key") == 1)
    rows = {r.family: r for r in evaluate(day, ["family"], ["sales_value", "receipts", "basket_value", "sales_vs_target_pct"]).collect()}
    assert rows["DAIRY"].receipts == rows["BOOKS"].receipts == 10 and rows["BOOKS"].basket_value == 1.0
    assert rows["DAIRY"].sales_vs_target_pct == pytest.approx((4 - 7) / 7)
    books = one(evaluate(day.where(items=F.col("family") == "BOOKS"), [], ["sales_vs_target_pct", "receipts"]))
    assert books.sales_vs_target_pct == pytest.approx((10 - 7) / 7) and books.receipts == 10
    with pytest.raises(ValueError):
        evaluate(day, ["family"], ["receipts"])


def test_average_weather_weighs_store_days(star):
    day = star.where(dates=F.col("date") == F.lit(date(2017, 7, 3)))
    row = one(evaluate(day, [], ["avg_rain", "avg_max_temp"]))
    assert row.avg_rain == 2.0 and row.avg_max_temp is None


def test_unknown_store_is_the_blank_member(star):
    rows = {r.store_name: r.est_lost_units for r in evaluate(star, ["store_name"], ["est_lost_units"]).collect()}
    assert rows == {"Store 1 (Quito)": 4.5, "Store 2 (Quito)": 3.0, None: 4.0}
    kpi = one(reports.fresh_kpis(star))
    assert kpi.stockout_risk_items == 3 and kpi.est_lost_sales == pytest.approx(4.5 * 2 + 15 + 8)


def test_last_seven_days_end_at_the_last_selected_day(star):
    row = one(evaluate(star.where(stores=F.col("store_key") == 1), [], ["est_lost_sales_7d"]))
    assert row.est_lost_sales_7d == 2.0  # 9 August is in, 8 August is out


def test_medians_skip_blanks_and_interpolate(star):
    row = one(evaluate(star, [], ["promo_events", "median_uplift_pct", "median_net_lift_pct"]))
    assert tuple(row) == (3, 1.5, 0.5)
    assert one(evaluate(star, [], ["families_paying_back"])).families_paying_back == 1


def _show(star, by, items, measure="receipts"):
    return {(r[0], r.show_as): r[measure] for r in reports.show_as(star, by, [measure], items).collect()}


def test_time_calculations_by_month(star):
    third = star.where(stores=F.col("store_key") == 3)
    got = _show(third, ["month_key"], [timecalc.ACTUAL, timecalc.MTD, timecalc.YTD, timecalc.PY, timecalc.PY_YTD, timecalc.YOY_DELTA])
    assert got[201702, "Actual"] == 280 and got[201702, "PY"] == 290 and got[201702, "YoY Δ"] == -10
    assert got[201602, "PY"] == 280 and got[201603, "YTD"] == 910 and got[201703, "PY YTD"] == 910
    assert got[201708, "PY"] == 150 and (201508, "PY") not in got and (201508, "YoY Δ") not in got


def test_time_calculations_by_day(star):
    third = star.where(stores=F.col("store_key") == 3)
    got = _show(third, ["date"], [timecalc.MTD, timecalc.YTD, timecalc.PY])
    assert got[date(2016, 2, 29), "PY"] == 10 and got[date(2017, 2, 28), "PY"] == 10
    assert got[date(2016, 3, 1), "YTD"] == 610 and got[date(2016, 3, 31), "MTD"] == 310


def test_year_on_year_of_a_ratio_is_the_change_of_the_ratio(star):
    rows = reports.show_as(star.where(stores=F.col("store_key") == 1), ["month_key"], ["basket_value"], [timecalc.YOY_PCT]).collect()
    got = {r.month_key: r.basket_value for r in rows}
    assert got[201703] == 1.0 and got[201603] == 0.0 and 201503 not in got


def test_selection_moves_with_the_calculation(star):
    march = star.where(dates=F.col("month_key") == 201603, stores=F.col("store_key") == 3)
    rows = {r.show_as: r.receipts for r in reports.show_as(march, ["region"], ["receipts"], [timecalc.ACTUAL, timecalc.YTD, timecalc.PY]).collect()}
    assert rows == {"Actual": 310, "YTD": 910, "PY": 310}


def test_total_row_is_evaluated_at_the_total(star):
    rows = {(r.region, r.is_total): r for r in evaluate_with_total(star, ["region"], reports.NETWORK).collect()}
    whole = one(evaluate(star, [], reports.NETWORK))
    total = rows[None, True]
    for name in reports.NETWORK:
        assert total[name] == pytest.approx(whole[name])
    assert set(rows) == {("North", False), ("South", False), (None, True)}


def test_drill_levels(star):
    rows = reports.drill(star.where(stores=F.col("store_key") == 3, dates=F.col("year") == 2016), ["units"]).collect()
    depth = {d: [r for r in rows if r.depth == d] for d in (1, 2, 3, 4)}
    assert [len(depth[d]) for d in (1, 2, 3, 4)] == [1, 4, 12, 366] and depth[1][0].units == 732


def test_ties_with_the_last_of_the_top_stay(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([9, 8, 8, 8, 1])], "i int, v double")
    assert reports.top_rows(df, "v", 2).count() == 4 and reports.top_rows(df, "v", 9).count() == 5


ROLES = {security.STORE_OPERATIONS: ["north@x", "south@x", "none@x"], security.COMMERCIAL: ["head@x", "both@x"]}


def test_store_users_see_their_stores_only(star):
    north = security.secure(star, "north@x", ROLES)
    assert {r.store_name for r in evaluate(north, ["store_name"], ["sales_value", "est_lost_units"]).collect()} == {
        "Store 1 (Quito)", "Store 2 (Quito)"}
    assert one(evaluate(north, [], ["est_lost_units"])).est_lost_units == 7.5
    assert north.fact("user_access").count() == 2 and north.fact("promo_family_summary").count() == 0
    assert one(evaluate(security.secure(star, "none@x", ROLES), [], ["sales_value"])).sales_value is None


def test_unit_cost_is_denied_to_store_users(star):
    with pytest.raises(AccessDenied):
        evaluate(security.secure(star, "south@x", ROLES), [], ["gross_margin_pct"])
    head = security.secure(star, "head@x", ROLES)
    assert one(evaluate(head, [], ["cost_value"])).cost_value > 0 and head.fact("user_access").count() == 0


def test_exactly_one_role(star):
    with pytest.raises(security.RoleError):
        security.secure(star, "both@x", {**ROLES, security.STORE_OPERATIONS: ["both@x"]})
    with pytest.raises(security.RoleError):
        security.secure(star, "stranger@x", ROLES)


def test_access_matrix(spark, star):
    members = spark.createDataFrame([(u, r) for r, us in ROLES.items() for u in us], "user string, role string")
    got = {r.user: (r.stores, r.access_rows, r.cost_visible) for r in security.access_matrix(star, members).collect()}
    assert got["north@x"] == (2, 2, False) and got["none@x"] == (0, 0, False) and got["head@x"] == (3, 0, True)


def test_reconcile_reports_differences_and_one_sided_cells(spark):
    a = spark.createDataFrame([(2016, "Q", 10.0, 1e9), (2016, None, 5.0, 50.0), (2018, "Q", 1.0, 1.0)], "y int, r string, u double, v double")
    b = spark.createDataFrame([(2016, "Q", 10.0, 1e9 + 0.01), (2016, None, 5.0, 51.0), (2017, "Q", 1.0, 1.0)], "y int, r string, u double, v double")
    assert {(r.y, r.r) for r in checks.reconcile(a, b, ["y", "r"], ["u", "v"]).collect()} == {(2016, None), (2017, "Q"), (2018, "Q")}
