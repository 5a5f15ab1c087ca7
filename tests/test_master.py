"""Targets, conformed tables, master data files and weather replies."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from aisleframe.config import BuildConfig
from aisleframe.operators import checks, conform, targets
from aisleframe.sources import csvfiles, master, weather

EVEN = [(1, w, 1 / 7) for w in range(1, 8)]


def _weights(spark, rows=EVEN):
    return spark.createDataFrame(rows, "store_key int, weekday_num int, weight double")


def _months(spark, rows):
    return spark.createDataFrame(
        [(s, m, Decimal(v)) for s, m, v in rows], "store_nbr int, month_start date, target_value decimal(14,2)")


def test_days_add_up_to_the_cent_and_skip_closures(spark):
    monthly = _months(spark, [(1, date(2015, 12, 1), "100000.01"), (1, date(2016, 1, 1), "10.00"), (1, date(2016, 2, 1), "0.10")])
    daily = targets.daily_targets(monthly, _weights(spark, [(1, w, w / 28) for w in range(1, 8)]))
    totals = {r.m: (r.total, r.n) for r in daily.groupBy(F.trunc("target_date", "MM").alias("m")).agg(
        F.sum("target_value").alias("total"), F.count("*").alias("n")).collect()}
    assert totals == {date(2015, 12, 1): (Decimal("100000.01"), 30), date(2016, 1, 1): (Decimal("10.00"), 30),
                      date(2016, 2, 1): (Decimal("0.10"), 29)}
    assert checks.targets_add_up(monthly, daily).first().violations == 0
    assert checks.no_target_on_closures(daily).first().violations == 0
    assert checks.targets_have_days(monthly, daily).first().violations == 0


def test_weekday_weight_shapes_the_day(spark):
    daily = targets.daily_targets(_months(spark, [(1, date(2016, 2, 1), "2900.00")]), _weights(spark))
    values = {r.target_date: r.target_value for r in daily.collect()}
    assert values[date(2016, 2, 1)] == Decimal("100.00") and values[date(2016, 2, 29)] == Decimal("100.00")


def test_broken_targets_are_counted(spark):
    monthly = _months(spark, [(1, date(2016, 2, 1), "29.00"), (1, date(2016, 3, 1), "31.00")])
    daily = targets.daily_targets(monthly, _weights(spark)).filter("month(target_date) = 2 AND day(target_date) > 1")
    assert checks.targets_add_up(monthly, daily).first().violations == 1
    assert checks.targets_have_days(monthly, daily).first().violations == 1


def test_targets_need_a_full_prior_month(spark):
    months = spark.createDataFrame(
        [(1, date(2015, 2, 1), 100.50, 25), (1, date(2016, 2, 1), 1.0, 3), (2, date(2015, 2, 1), 100.0, 24), (2, date(2016, 2, 1), 1.0, 29)],
        "store_key int, month_start date, sales_value double, active_days bigint")
    rows = targets.monthly_targets(months, BuildConfig()).collect()
    assert [tuple(r) for r in rows] == [(1, date(2016, 2, 1), Decimal("103.52"))]


def region_of_state(spark):
    return spark.createDataFrame([("Pichincha", 1), ("Guayas", 2), ("Azuay", 2)], "state string, region_id int")


def margin_of_family(spark):
    rows = [("LAMPS", Decimal("0.15")), ("CHAIRS", Decimal("0.40"))]
    return spark.createDataFrame(rows, "family string, margin decimal(4,2)")


def test_targets_of_the_hand_fixture(full, spark):
    prices = spark.createDataFrame([(101, 2.0), (102, 3.0)], "item_nbr int, unit_price double")
    months = targets.store_month_value(full.table("fact_sales"), full.table("dim_date"), prices)
    made = {(r.store_nbr, r.month_start) for r in targets.monthly_targets(months, BuildConfig()).collect()}
    assert (1, date(2016, 1, 1)) in made and all(m.year == 2016 for _, m in made) and not any(s == 3 for s, _ in made)
    weights = targets.weekday_weights(full.table("fact_sales"), full.table("dim_date"), prices)
    assert checks.weights_sum_to_one(weights, "store_key").first().violations == 0


def test_access_of_the_hand_fixture(full, spark):
    stores, days = full.table("stg_store"), full.table("stg_store_day")
    regions = targets.state_region(stores, region_of_state(spark))
    busiest = targets.busiest_store(stores, days, "Quito", 20160101)
    rows = {tuple(r) for r in targets.user_access(stores, regions, busiest, "x").collect()}
    assert rows == {("store.manager@x", 1), ("regional.manager@x", 1), ("regional.manager@x", 2)}


def test_unmapped_state_and_family_are_errors(spark):
    with pytest.raises(targets.UnmappedError, match="Atlantis"):
        targets.state_region(spark.createDataFrame([("Atlantis",)], "state string"), region_of_state(spark))
    prices = spark.createDataFrame([(1, "TOYS", Decimal("2.00"))], "item_nbr int, family string, unit_price decimal(10,2)")
    with pytest.raises(targets.UnmappedError, match="TOYS"):
        targets.item_price(prices, margin_of_family(spark))
    many = spark.createDataFrame([(f"state {i:02}",) for i in range(23)], "state string")
    with pytest.raises(targets.UnmappedError, match="state 19 and 3 more"):
        targets.state_region(many, region_of_state(spark))


def test_cost_from_price_and_margin(spark):
    prices = spark.createDataFrame([(1, "LAMPS", Decimal("1.50"))], "item_nbr int, family string, unit_price decimal(10,2)")
    priced = targets.item_price(prices, margin_of_family(spark))
    assert priced.first().unit_cost == Decimal("1.28") and checks.price_above_cost(priced).first().violations == 0


def test_store_day_keeps_closed_days_and_drops_foreign_keys(spark):
    receipts = spark.createDataFrame([(20160101, 1, 5), (20160102, 1, 6)], "date_key int, store_key int, receipts int")
    planned = spark.createDataFrame(
        [(1, date(2016, 1, 2), Decimal("10.00")), (1, date(2016, 1, 3), Decimal("11.00")), (1, date(2015, 12, 31), Decimal("9.00")),
         (9, date(2016, 1, 2), Decimal("8.00"))], "store_nbr int, target_date date, target_value decimal(14,2)")
    dates = spark.createDataFrame([(20160101,), (20160103,)], "date_key int")
    stores = spark.createDataFrame([(1, "Quito")], "store_key int, city string")
    sky = spark.createDataFrame([("Quito", date(2016, 1, 1), None, 21.0)], "city string, weather_date date, rain_mm double, temp_max_c double")
    rows = {r.date_key: tuple(r)[1:] for r in conform.fact_store_day(receipts, planned, dates, stores, sky).collect()}
    assert rows == {20160101: (1, 5, None, None, 21.0), 20160102: (1, 6, Decimal("10.0000"), None, None),
                    20160103: (1, None, Decimal("11.0000"), None, None)}


def test_unmatched_dimension_values_stay_blank(spark):
    staged = spark.createDataFrame([(1, 1, "c", "Nowhere", "A", 1, None)],
                                   "store_key int, store_nbr int, city string, state string, store_type string, cluster int, opening_date date")
    empty = spark.createDataFrame([], "store_nbr int, selling_area_m2 int")
    regions = spark.createDataFrame([(1, "North"), (2, "South")], "region_id int, region_name string")
    row = conform.dim_store(staged, empty, region_of_state(spark), regions).first()
    assert row.region is None and row.selling_area_m2 is None
    item = spark.createDataFrame([(1, 1, "DAIRY", 1, True)], "item_key int, item_nbr int, family string, class int, is_perishable boolean")
    prices = spark.createDataFrame([], "item_nbr int, unit_price decimal(10,2), unit_cost decimal(10,2)")
    assert conform.dim_item(item, prices).first().unit_price is None


CANDIDATES = "name string, rank int, country_code string, population bigint, latitude double, longitude double, admin1 string"


def test_city_match(spark):
    places = spark.createDataFrame([
        ("Quito", 0, "EC", 1_400_000, -0.2, -78.5, "Pichincha"), ("Quito", 1, "PH", 9_000_000, 1.0, 1.0, "X"),
        ("Quito", 2, "EC", None, 5.0, 5.0, "Y"), ("La Libertad", 0, "EC", None, -2.2, -80.9, None),
        ("La Libertad", 1, "EC", 0, 9.0, 9.0, "Z")], CANDIDATES)
    cities = spark.createDataFrame([("Quito",), ("Libertad",), ("Quito",)], "city string")
    assert {tuple(r) for r in conform.city_match(cities, places).collect()} == {
        ("Quito", -0.2, -78.5, "Pichincha"), ("Libertad", -2.2, -80.9, "")}
    with pytest.raises(conform.UnknownCityError, match="Manta"):
        conform.city_match(spark.createDataFrame([("Manta",)], "city string"), places)


def test_weather_reply_keeps_nulls(spark):
    replies = spark.createDataFrame([
        ("Quito", '{"daily":{"time":["2016-01-01","2016-01-02"],"precipitation_sum":[null,1.5],"temperature_2m_max":[20.0,null]}}')],
        "city string, reply string")
    rows = weather.parse_replies(replies)
    assert [tuple(r) for r in rows.orderBy("weather_date").collect()] == [
        ("Quito", date(2016, 1, 1), None, 20.0), ("Quito", date(2016, 1, 2), 1.5, None)]
    assert weather.parse_replies(weather.as_replies(rows)).exceptAll(rows).count() == 0


MASTER = {
    "region": "region_id,region_name\n1,North\n",
    "state_region": "state,region_id\nPichincha,1\n",
    "store_profile": "store_nbr,selling_area_m2\n1,900\n",
    "item_price": "item_nbr,unit_price,unit_cost\n10,2.00,1.00\n",
    "weekday_weight": "store_nbr,weekday_num,weight\n" + "".join(f"1,{w},{0.1 if w < 7 else 0.4}\n" for w in range(1, 8)),
    "sales_target_month": "store_nbr,month_start,target_value\n1,2016-01-01,100.00\n",
    "city_geo": "city,latitude,longitude,admin1\nQuito,-0.2,-78.5,Pichincha\n",
    "weather_daily": "city,weather_date,rain_mm,temp_max_c\nQuito,2016-01-01,,20.5\n",
    "user_access": "user_principal_name,store_nbr\nm@x,1\n",
}


def _master(tmp_path, **changes):
    for name, text in {**MASTER, **changes}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_master_files_load_with_empty_cells_as_null(spark, tmp_path):
    loaded = master.load_master(spark, _master(tmp_path), str(tmp_path / "out"))
    assert set(loaded) == set(csvfiles.MASTER_SCHEMAS) and loaded["weather_daily"].first().rain_mm is None


@pytest.mark.parametrize("name,text,check", [
    ("item_price", "item_nbr,unit_price,unit_cost\n10,2.00,2.00\n", "price_above_cost"),
    ("item_price", "item_nbr,unit_price,unit_cost\n10,2.00,\n", "price_above_cost"),
    ("weather_daily", "city,weather_date,rain_mm,temp_max_c\nLoja,2016-01-01,1,2\n", "cities_have_weather"),
    ("user_access", "user_principal_name,store_nbr\nm@x,2\n", "user_access_fk_store"),
    ("sales_target_month", "store_nbr,month_start,target_value\n1,2016-01-02,100.00\n", "month_starts_on_day_1"),
    ("sales_target_month", "store_nbr,month_start,target_value\n1,2016-01-01,0.00\n", "target_positive"),
])
def test_bad_master_file_is_not_written(spark, tmp_path, name, text, check):
    with pytest.raises(checks.GateClosed, match=check):
        master.load_master(spark, _master(tmp_path, **{name: text}), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
