"""Order statistics, run tests, promotion events and their summary against brute force."""

import hashlib
import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from aisleframe.config import BuildConfig
from aisleframe.functions.ranks import exact_median, step_up_cut
from aisleframe.operators import deepdive, gold


@pytest.mark.parametrize("hot", [False, True])
def test_exact_median_matches_sorting(spark, hot):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), 5_000 if hot and rng.random() < 0.4 else rng.randint(-90_000, 90_000), rng.randint(0, 3))
            for _ in range(3_000)] + [("odd", 3, 1), ("pair", 1, 1), ("pair", 4, 1), ("none", None, 1)]
    df = spark.createDataFrame(rows, "g string, v bigint, w int")
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m").collect()}
    weighted = {r.g: r.m for r in exact_median(df, ["g"], "v", "m", weight="w").collect()}
    for group in {g for g, _, _ in rows} - {"none"}:
        values = [v for g, v, _ in rows if g == group]
        repeated = [v for g, v, w in rows if g == group for _ in range(w)]
        assert got[group] == np.median(values) / 10_000
        assert weighted[group] == np.median(repeated) / 10_000
    assert "none" not in got
    overall = [v for _, v, _ in rows if v is not None]
    assert exact_median(df, [], "v", "m").first().m == np.median(overall) / 10_000


def _step_up(ps, rate):
    ordered = sorted(ps)
    passed = [k for k, p in enumerate(ordered, 1) if p <= rate * k / len(ordered)]
    return (max(passed), ordered[max(passed) - 1]) if passed else (0, None)


@pytest.mark.parametrize("seed,power", [(1, 1), (2, 3), (3, 6), (4, 0.3)])
def test_step_up_cut_matches_sorting(spark, seed, power):
    rng = random.Random(seed)
    ps = [round(rng.random() ** power, 4) for _ in range(701)]
    cut = step_up_cut(spark.createDataFrame([(p,) for p in ps] + [(None,)], "p double"), "p", 0.05)
    flagged, top = _step_up(ps, 0.05)
    assert (cut["tested"], cut["flagged"], cut["cutoff"]) == (701, flagged, top)


def test_step_up_cut_of_nothing(spark):
    none = spark.createDataFrame([], "p double")
    assert step_up_cut(none, "p", 0.05) == {"tested": 0, "flagged": 0, "cutoff": None}


def _run_series(spark, units_by_day, partial=()):
    start = date(2016, 1, 1)
    rows = [(1, 7, start + timedelta(i), i not in partial, float(u or 0), u is None) for i, u in enumerate(units_by_day)]
    return spark.createDataFrame(
        rows, "store_nbr int, item_nbr int, date date, full_day boolean, units double, no_sale_row boolean")


def test_runs_count_full_days_and_test_against_the_history(spark):
    history = [4, 6] * 14
    series = _run_series(spark, history + [5, None, None, None, 5, None, 0, 5], partial={30})
    runs = {r.start_date: r for r in deepdive.run_tests(deepdive.zero_sale_runs(series, BuildConfig())).collect()}
    first, second = date(2016, 1, 1) + timedelta(29), date(2016, 1, 1) + timedelta(33)
    assert set(runs) == {first, second}
    run = runs[first]
    assert (run.run_days, run.spine_days, run.calendar_days) == (2, 3, 3)
    before = history[1:] + [5]
    mean, var = np.mean(before), np.var(before, ddof=1)
    assert run.lambda_units == pytest.approx(mean) and run.dispersion == max((var - mean) / mean**2, 0) == 0
    assert run.p_value == run.p_poisson == pytest.approx(math.exp(-2 * mean)) and run.expected_lost_units == pytest.approx(2 * mean)
    # the first run's zeros belong to the second one's history: 12 sixes, 11 fours, two fives, three zeros
    assert runs[second].run_days == 1 and runs[second].lambda_units == 126 / 28


def test_overdispersed_runs_are_less_surprising(spark):
    series = _run_series(spark, [1, 30] * 14 + [None, 5])
    run = deepdive.run_tests(deepdive.zero_sale_runs(series, BuildConfig())).first()
    before = [1, 30] * 14
    mean, a = np.mean(before), (np.var(before, ddof=1) - np.mean(before)) / np.mean(before) ** 2
    assert run.p_value == pytest.approx((1 + a * mean) ** (-1 / a)) and run.p_value > run.p_poisson


def test_no_run_without_history(spark):
    assert deepdive.zero_sale_runs(_run_series(spark, [5] * 27 + [None, 5]), BuildConfig()).count() == 0


def test_store_weeks_count_tested_and_flagged_days(spark):
    series = _run_series(spark, [9] * 28 + [None] * 5 + [9], partial={30})
    cfg = BuildConfig()
    flagged = deepdive.flag_runs(deepdive.run_tests(deepdive.zero_sale_runs(series, cfg)), cfg)
    trading = series.select("store_nbr", "date", "full_day")
    stores = spark.createDataFrame([(1, "Quito")], "store_key int, city string")
    weeks = {r.week_start: (r.item_days, r.flagged_days) for r in deepdive.store_weeks(series, flagged, trading, stores, cfg).collect()}
    # days 28..33 are 29 January (a Friday) to 3 February
    assert weeks == {date(2016, 1, 25): (2, 2), date(2016, 2, 1): (3, 2)}


def _fact(spark, rows):
    return spark.createDataFrame(
        [(int(d.strftime("%Y%m%d")), 1, 7, u, p, w, b) for d, u, p, w, b in rows],
        "date_key int, store_key int, item_key int, units double, on_promo boolean, post_promo_window boolean, baseline_units double")


def test_promotion_events(spark):
    d = [date(2016, 3, 10) + timedelta(i) for i in range(40)]
    fact = _fact(spark, [
        (d[0], 9.0, True, False, 2.0), (d[1], 7.0, True, False, 2.0), (d[3], 1.0, False, True, 2.0), (d[4], 3.0, None, True, 2.0),
        (d[20], 5.0, True, False, None), (d[21], 5.0, True, False, 4.0), (d[25], 4.0, True, False, 2.0), (d[26], 1.0, False, True, 2.0)])
    dates = spark.createDataFrame([(int(x.strftime("%Y%m%d")), x, x == date(2016, 4, 4)) for x in d], "date_key int, date date, is_national_holiday boolean")
    items = spark.createDataFrame([(7, "DAIRY")], "item_key int, family string")
    events = {r.start_date_key: r for r in deepdive.promo_events(fact, dates, items, BuildConfig()).collect()}
    assert set(events) == {20160310, 20160330, 20160404}
    first = events[20160310]
    assert (first.promo_days, first.promo_units, first.uplift, first.post_dip, first.net_lift) == (2, 16.0, 3.0, 0.0, 1.5)
    assert not first.touches_payday_or_holiday
    crossed = events[20160330]  # holds 31 March; another promotion falls into its week after
    assert (crossed.uplift, crossed.post_dip, crossed.net_lift, crossed.touches_payday_or_holiday) == (0.25, None, None, True)
    assert events[20160404].post_dip == -0.5 and events[20160404].touches_payday_or_holiday


def test_family_summary_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [("F%d" % (i % 2) if i % 11 else None, i % 5, i, 20160101 + i % 28, round(rng.uniform(-1, 4), 4),
             None if i % 3 else round(rng.uniform(-1, 1), 4), None) for i in range(160)]
    events = spark.createDataFrame(
        rows, "family string, store_key int, item_key int, start_date_key int, uplift double, post_dip double, net_lift double")
    cfg = BuildConfig(bootstrap_replicates=40)
    got = {r.family: r for r in deepdive.promo_family_summary(events, cfg).collect()}
    assert set(got) == {"F0", "F1", None}
    modulus, steps, ends = 2**31 - 1, deepdive.generator_steps(40), deepdive.poisson_steps()
    for family, row in got.items():
        mine = [r for r in rows if r[0] == family]
        for column, prefix in ((4, "uplift"), (5, "dip")):
            known = [r for r in mine if r[column] is not None]
            medians = []
            for step in steps:
                sample = []
                for r in known:
                    seed = int(hashlib.md5(f"{r[1]}:{r[2]}:{r[3]}".encode()).hexdigest()[:8], 16) % (modulus - 1) + 1
                    sample += [r[column]] * sum(seed * step % modulus > end for end in ends)
                if sample:
                    medians.append(np.median(sample))
            assert row[f"{prefix}_median"] == pytest.approx(np.median([r[column] for r in known]))
            assert row[f"{prefix}_lo"] == pytest.approx(np.percentile(medians, 2.5))
            assert row[f"{prefix}_hi"] == pytest.approx(np.percentile(medians, 97.5))
        assert (row.n_events, row.n_net_events, row.net_median) == (len(mine), 0, None)


def test_bootstrap_weights_are_poisson_and_repeatable(spark):
    events = spark.createDataFrame([(i, 1, 20160101) for i in range(400)], "store_key int, item_key int, start_date_key int")
    draw = [deepdive.replicate_weights(events.withColumn("i", F.col("store_key")), 50).groupBy("weight").count().collect() for _ in range(2)]
    assert sorted(draw[0]) == sorted(draw[1])
    counts = {r.weight: r["count"] / 20_000 for r in draw[0]}
    assert counts[1] == pytest.approx(math.exp(-1), abs=0.02) and counts[2] == pytest.approx(math.exp(-1) / 2, abs=0.02)


def test_lookback_against_brute_force(spark):
    rng = random.Random(5)
    start = date(2016, 1, 1)
    sold = [(start + timedelta(i), s, it, float(rng.randint(0, 9)), 0.0, rng.choice([True, False, None]))
            for s in (1, 2) for it in (1, 2, 3) for i in range(120) if rng.random() < 0.6]
    open_days = [(start + timedelta(i), s, rng.choice([0, 40, 100])) for s in (1, 2) for i in range(120) if rng.random() < 0.9]
    cfg = BuildConfig()
    sales = spark.createDataFrame(sold, "date date, store_nbr int, item_nbr int, units double, return_units double, on_promo boolean")
    days = spark.createDataFrame(open_days, "date date, store_nbr int, receipts int")
    got = {(r.date_key, r.store_key, r.item_key): r for r in gold.fact_sales(sales, gold.trading_days(days, cfg), cfg).collect()}
    assert len(got) == len(sold)
    trading = {(d, s) for d, s, n in open_days if n > 0}
    for d, s, it, units, _, promo in sold:
        mine = [r for r in sold if r[1:3] == (s, it)]
        prior = [r for r in mine if 1 <= (d - r[0]).days <= 28]
        recent = [r for r in mine if 1 <= (d - r[0]).days <= 7]
        post = promo is not True and any(r[5] for r in recent)
        expected = None
        if (promo or post) and (d - min(r[0] for r in mine)).days >= 28 and (d, s) in trading:
            base = sum(1 for n in range(1, 29) if (d - timedelta(n), s) in trading) - sum(r[5] is True for r in prior)
            expected = sum(r[3] for r in prior if r[5] is not True) / base if base else None
        row = got[int(d.strftime("%Y%m%d")), s, it]
        assert row.post_promo_window == post
        assert row.baseline_units == (None if expected is None else pytest.approx(expected))
