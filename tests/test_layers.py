from datetime import date

import pytest
from pyspark.sql import functions as F

from aisleframe.operators import checks, silver
from aisleframe.operators.silver import national_holidays
from aisleframe.plans.build import build, publish
from aisleframe.plans.warehouse import GOLD_TABLES
from aisleframe.config import BuildConfig, sample_config
from aisleframe.sources import csvfiles, tables
from aisleframe.sources.csvfiles import RawFiles
from tests.conftest import STORES, write_raw


def test_unknown_promotion_flags_stay_null(spark, raw_folder):
    rows = csvfiles.scan_sales(spark, raw_folder)
    assert dict(rows.dtypes)["onpromotion"] == "boolean"
    assert rows.filter("store_nbr = 2 AND onpromotion IS NULL").count() == 91


@pytest.mark.parametrize("change", [
    lambda s: s.assign(extra="x"), lambda s: s.drop(columns="cluster"), lambda s: s.rename(columns={"city": "town"})])
def test_drifting_file_stops_even_a_narrow_query(spark, tmp_path, change):
    folder = write_raw(tmp_path / "raw", change(STORES))
    with pytest.raises(Exception):
        csvfiles.scan_raw(spark, folder, "stores").select("store_nbr").collect()


def test_cell_of_the_wrong_type_stops_the_intake(spark, tmp_path):
    folder = write_raw(tmp_path / "raw", STORES.assign(cluster=["1", "2", "many", "4", "5"]))
    with pytest.raises(Exception):
        RawFiles(spark, folder, str(tmp_path / "bronze")).stores()


def test_sample_keeps_the_busiest_stores_of_two_cities(sample):
    assert {r[0] for r in sample.table("selected_stores").collect()} == {1, 2, 3, 4}
    assert sample.table("sales").agg(F.min("date")).first()[0] == date(2016, 1, 1)


def test_sample_takes_three_per_city_with_ties_by_number(spark):
    stores = spark.createDataFrame([(n, "Quito") for n in range(1, 6)], "store_nbr int, city string")
    visits = spark.createDataFrame(
        [(date(2016, 2, 1), 5, 9), (date(2016, 2, 1), 4, 7), (date(2015, 2, 1), 3, 99)],
        "date date, store_nbr int, transactions int")
    picked = silver.select_stores(stores, visits, sample_config())
    assert {r[0] for r in picked.collect()} == {5, 4, 1}


def test_returns_are_split_from_units(full):
    row = full.table("sales").filter("store_nbr = 2 AND item_nbr = 101 AND date = '2016-01-05'").first()
    assert (row.units, row.return_units, row.on_promo) == (0.0, 1.0, None)


def test_sales_of_unknown_stores_are_left_out(spark):
    lines = spark.createDataFrame([(date(2016, 1, 1), s, 1, 1.0, None) for s in (1, 999)],
                                  "date date, store_nbr int, item_nbr int, unit_sales double, onpromotion boolean")
    known = spark.createDataFrame([(1,)], "store_nbr int")
    assert [r.store_nbr for r in silver.clean_sales(lines, known, BuildConfig()).collect()] == [1]


def test_national_holidays_skip_moved_and_local_days(spark, raw_folder):
    events = csvfiles.scan_raw(spark, raw_folder, "holidays_events")
    assert {r[0] for r in national_holidays(events).collect()} == {date(2016, 1, 1), date(2016, 2, 9)}


def test_calendar_has_no_gaps_and_iso_weeks(full):
    cal = full.table("dim_date")
    lo, hi, n = cal.agg(F.min("date"), F.max("date"), F.count("date")).first()
    assert (lo, hi, n) == (date(2015, 1, 1), date(2016, 3, 31), (hi - lo).days + 1)
    new_year = cal.filter("date_key = 20160101").first()
    assert (new_year.iso_year, new_year.iso_week, new_year.is_national_holiday) == (2015, 53, True)
    saturday = cal.filter("date_key = 20160102").first()
    assert (saturday.weekday_num, saturday.weekday_name, saturday.is_weekend, saturday.month_name) == (6, "Sat", True, "Jan")


def test_opening_date_is_unknown_for_stores_trading_from_the_start(sample):
    opened = {r.store_key: r.opening_date for r in sample.table("stg_store").collect()}
    assert opened[1] is None and opened[2] == date(2015, 6, 1)


def test_store_without_receipts_disappears(spark):
    from aisleframe.operators.gold import stg_store

    stores = spark.createDataFrame([(1, "a", "s", "A", 1), (2, "b", "s", "A", 1)],
                                   "store_nbr int, city string, state string, type string, cluster int")
    visits = spark.createDataFrame([(date(2016, 1, 1), 1, 5)], "date date, store_nbr int, transactions int")
    assert stg_store(stores, visits, stores.select("store_nbr"), BuildConfig()).count() == 1


def _baselines(w, store, item):
    return {r.date_key: r for r in w.table("fact_sales").filter(f"store_key = {store} AND item_key = {item}").collect()}


def test_promotion_baselines(full):
    rows = _baselines(full, 1, 102)
    assert rows[20160110].baseline_units == pytest.approx(52 / 27)
    assert rows[20160111].baseline_units == pytest.approx(50 / 26)
    assert rows[20160113].baseline_units == pytest.approx(46 / 24) and rows[20160113].post_promo_window
    assert rows[20160119].post_promo_window and not rows[20160120].post_promo_window
    assert rows[20160120].baseline_units is None


def test_no_baseline_without_history_or_known_promotion(full):
    assert all(r.baseline_units is None for r in _baselines(full, 3, 101).values())
    unknown = [r for k, r in _baselines(full, 2, 101).items() if k >= 20160101]
    assert len(unknown) == 91 and all(r.on_promo is None and not r.post_promo_window for r in unknown)


def test_stockout_flags(full):
    assert sorted(tuple(r) for r in full.table("fact_stockout_risk").collect()) == [
        (20160101, 1, 101, 4.82), (20160210, 1, 101, 5.0)]


def _check_tables(w):
    return {**w.tables(*GOLD_TABLES), "sales": w.table("sales"), "store_day": w.table("store_day"),
            "train": w.inputs.train(), "selected_stores": w.table("selected_stores")}


def test_checks_pass_on_clean_data(full):
    assert checks.all_results(checks.gold_checks(_check_tables(full))).filter("violations > 0").collect() == []


def test_orphan_and_duplicate_are_counted(full):
    t = _check_tables(full)
    row = t["fact_sales"].limit(1)
    t["fact_sales"] = t["fact_sales"].unionByName(row).unionByName(row.withColumn("store_key", F.lit(999)))
    found = {r.check: r.violations for r in checks.all_results(checks.gold_checks(t)).filter("violations > 0").collect()}
    assert found["fact_sales_orphan_store"] == 1 and found["fact_sales_unique_grain"] == 1
    with pytest.raises(checks.GateClosed, match="fact_sales_orphan_store: 1 violation"):
        checks.gate(checks.gold_checks(t))


def test_null_keys_are_violations(spark):
    keys = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    assert checks.unique_key("k", keys, "k").first().violations == 2
    pairs = spark.createDataFrame([(1, None), (1, None), (2, None)], "a int, b int")
    assert checks.unique_key("ab", pairs, "a", "b").first().violations == 1


def test_failed_check_blocks_export(spark, tmp_path):
    folder = write_raw(tmp_path / "raw", STORES.assign(type=["A", "B", "Z", "D", "C"]))
    dest = tmp_path / "gold"
    with pytest.raises(checks.GateClosed, match="store_type_values: 1 violation"):
        build(spark, RawFiles(spark, folder, str(tmp_path / "bronze")), str(tmp_path / "work"), str(dest), BuildConfig())
    assert not dest.exists()


def test_sample_build_and_two_publications(spark, raw_folder, tmp_path):
    dest, target = str(tmp_path / "gold"), str(tmp_path / "lake")
    counts = build(spark, RawFiles(spark, raw_folder, str(tmp_path / "bronze")), str(tmp_path / "work"), dest, sample_config())
    assert counts["stg_store"] == 4 and set(counts) == set(GOLD_TABLES)
    assert set(publish(spark, dest, target).values()) == {0}
    assert set(publish(spark, dest, target).values()) == {1}
    assert tables.read_published(spark, target, "stg_store").count() == 4
    assert tables.read_published(spark, target, "stg_store", 0).count() == 4


def test_deep_dive_tables_keep_their_contract(full):
    built = {name: full.table(name) for name in tables.DEEP_DIVE_CONTRACT}
    assert checks.missing_columns(built, tables.DEEP_DIVE_CONTRACT) == {}
    assert checks.missing_columns({}, {"x": {"a"}}) == {"x": {"a"}}


def test_contract_read_pushes_filter_and_columns(spark, full):
    full.table("fact_stockout_run")
    plan = tables.read_flagged_runs(spark, full.folder)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_flagged), EqualTo(is_flagged,true)]" in plan
    assert "p_value" not in plan.split("ReadSchema")[1]


def test_configuration_defaults():
    full, sample = BuildConfig(), sample_config()
    assert (full.start_date, full.stockout_from, full.lookback_days) == (date(1900, 1, 1), date(2016, 1, 1), 28)
    assert (full.min_expected_units, full.min_receipts_share, full.post_promo_days) == (3.0, 0.5, 7)
    assert not full.sample and sample.sample and sample.start_date == date(2016, 1, 1)
