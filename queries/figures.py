"""Registered queries of the measures, time calculations, reports and access rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleframe.plans import reports, security, timecalc
from aisleframe.plans.measures import evaluate, evaluate_levels
from aisleframe.plans.star import AccessDenied
from queries.layers import ACCESS, PAYBACK
from queries.sql_base import query
from queries.stage import FINE, MID, Stage

ENTRIES: dict[str, tuple] = {}
KINDS = {
    "year": "i", "quarter": "i", "month_num": "i", "date": "d", "weekday_num": "i", "weekday_name": "s", "region": "s",
    "city": "s", "state": "s", "store_name": "s", "store_key": "i", "item_nbr": "i", "family": "s", "show_as": "s",
    "is_total": "b", "depth": "i", "is_perishable": "b", "store_type": "s",
}
DIGITS = {
    "units": "2", "sales_value": "2", "cost_value": "2", "lfl_sales": "2", "lfl_sales_py": "2", "target": "2",
    "basket_value": "4", "est_lost_units": "2", "est_lost_sales": "4", "est_lost_sales_7d": "4", "lost_units_runs": "2",
    "receipts": "i", "lfl_receipts": "i", "lfl_receipts_py": "i", "stockout_risk_items": "i", "flagged_runs": "i",
    "promo_events": "i", "families_paying_back": "i", "median_run_days": "1", "baseline_units": "3",
    "promo_extra_units": "3", "max_chance_flags": "4", "median_uplift_pct": "6", "median_net_lift_pct": "6",
    "family_net_lift_pct": "8", "family_net_lift_low_pct": "8", "family_net_lift_high_pct": "8", "family_uplift_pct": "8",
    "family_dip_pct": "8",
}
DAY = date(2001, 6, 29)


def spec(*columns: str) -> str:
    return " ".join(f"{c}:{KINDS.get(c) or DIGITS.get(c, '6')}" for c in columns)


def add(key, grain, build, columns, sql, extra="", kinds=None):
    ENTRIES[key] = (grain, build, kinds or spec(*columns), query(grain, sql, extra) if sql else None)


def comma(*names: str) -> str:
    return "".join(f"{n}, " for n in names)


def grouped(by: list[str]) -> str:
    return f"GROUP BY {', '.join(by)}" if by else ""


# --- SQL texts of the harder figures ---------------------------------------------------------------------------


def py_cells(name: str, source: str, keys: list[str]) -> str:
    """The prior-year dates of the cells in ``source``: clipped shift, 29 February taken along, capped."""
    return f"""
{name} AS (SELECT DISTINCT {comma(*keys)}d AS date FROM (
  SELECT {comma(*keys)}(date - INTERVAL 1 YEAR)::DATE AS d FROM {source} UNION ALL
  SELECT {comma(*keys)}make_date((year(date) - 1)::INT, 2, 29) FROM {source}
  WHERE month(date) = 2 AND day(date) IN (27, 28) AND day(last_day(date - INTERVAL 1 YEAR)) = 29
  GROUP BY {comma(*keys)}year(date) HAVING count(DISTINCT date) = 2)
  WHERE d >= (SELECT lo FROM ends) AND d <= (SELECT (hi - INTERVAL 1 YEAR)::DATE FROM ends))"""


def lfl(name: str, rows: str, amount: str, by_dates: list[str], by_rest: list[str], cells: str = "cal") -> str:
    """now, py per group for like-for-like stores; ``rows`` has date, opening_date and the group columns."""
    keys = [f"k_{c}" for c in by_dates]
    picked = "".join(f"{c} AS k_{c}, " for c in by_dates)
    both = f"USING ({', '.join(keys)})" if keys else "ON true"
    out = comma(*(f"k_{c} AS {c}" for c in by_dates), *by_rest)
    return f"""
{name}_now AS (SELECT {picked}date FROM {cells} WHERE date >= (SELECT (lo + INTERVAL 1 YEAR)::DATE FROM ends)),
{py_cells(f'{name}_py', f'{name}_now', keys)},
{name}_limit AS (SELECT {comma(*keys)}(min(date) - INTERVAL 1 YEAR)::DATE AS opened_by FROM {name}_now {grouped(keys)}),
{name}_dates AS (SELECT * FROM (SELECT {comma(*keys)}date, false AS past FROM {name}_now UNION ALL
  SELECT {comma(*keys)}date, true FROM {name}_py) JOIN {name}_limit {both}),
{name} AS (SELECT {out}sum(x.{amount}) FILTER (NOT past) AS now, sum(x.{amount}) FILTER (past) AS py
  FROM {rows} x JOIN {name}_dates y ON y.date = x.date WHERE opening_date IS NULL OR opening_date <= opened_by
  {grouped([*keys, *by_rest])})"""


def versus_target(name: str, by: list[str], where: str = "true", sales: str = "S", days: str = "D") -> str:
    keys = ", ".join([*by, "store_key", "month_key"])
    return f"""
{name}_plan AS (SELECT {keys}, sum(target_value) AS goal FROM {days} WHERE {where} GROUP BY {keys} HAVING count(target_value) > 0),
{name}_sold AS (SELECT {keys}, sum(value) AS got FROM {sales} WHERE {where} GROUP BY {keys}),
{name} AS (SELECT {comma(*by)}(coalesce(sum(got), 0) - sum(goal)) / sum(goal) AS sales_vs_target_pct
  FROM {name}_plan LEFT JOIN {name}_sold USING ({keys}) {grouped(by)})"""


def network_sql(by: list[str], tag: str = "") -> tuple[str, str]:
    """(select, expressions): value, target, like-for-like, footfall and basket figures per store grouping."""
    ls, lr, vt, sv = (f"{tag}{name}" for name in ("ls", "lr", "vt", "sv"))
    extra = ",".join([
        lfl(ls, "S", "value", [], by), lfl(lr, "D", "receipts", [], by), versus_target(vt, by),
        f"{sv} AS (SELECT {comma(*by)}sum(value) AS sales_value FROM S {grouped(by)})"])
    join = f"USING ({', '.join(by)})" if by else "ON true"
    growth = (f"(coalesce({ls}.now, 0) - coalesce({ls}.py, 0)) / {ls}.py AS g, "
              f"(coalesce({lr}.now, 0) - coalesce({lr}.py, 0)) / {lr}.py AS f")
    select = f"""SELECT {comma(*by)}sales_value, sales_vs_target_pct, g AS lfl_growth_pct, f AS lfl_footfall_growth_pct,
  (g - f) / nullif(1 + f, 0) AS lfl_basket_growth_pct FROM (SELECT {comma(*by)}sales_value, sales_vs_target_pct, {growth}
  FROM {sv} FULL JOIN {ls} {join} FULL JOIN {lr} {join} FULL JOIN {vt} {join})"""
    return select, extra


# --- M: measures -------------------------------------------------------------------------------------------------


def measure(number, name, grain, by, sql, extra=""):
    add(f"m{number}_{name}", grain, lambda s: evaluate(s.star, by, [name]), [*by, name], sql, extra)


def simple(number, name, grain, by, expression, source, extra=""):
    measure(number, name, grain, by,
            f"SELECT * FROM (SELECT {comma(*by)}{expression} AS {name} FROM {source} {grouped(by)}) WHERE {name} IS NOT NULL"
            if by else f"SELECT {expression} AS {name} FROM {source}", extra)


UPLIFT = "sum(units - baseline) FILTER (on_promo AND baseline > 0) / sum(baseline) FILTER (on_promo AND baseline > 0)"
DIP = "sum(units - baseline) FILTER (post_promo AND baseline > 0) / sum(baseline) FILTER (post_promo AND baseline > 0)"
MARGIN = "sum(value - cost) / nullif(sum(value), 0)"

simple(1, "units", FINE, ["year", "region"], "sum(units)", "S")
simple(2, "sales_value", FINE, ["item_nbr", "family"], "sum(value)", "S")
simple(3, "cost_value", FINE, ["store_name", "family"], "sum(cost)", "S")
simple(4, "gross_margin_pct", FINE, ["region", "year"], MARGIN, "S")
simple(5, "fresh_share_pct", FINE, ["store_name"], "sum(value) FILTER (is_perishable) / nullif(sum(value), 0)", "S")
simple(6, "baseline_units", MID, ["family", "year"], "sum(baseline)", "P")
simple(7, "promo_uplift_pct", MID, ["family", "region"], UPLIFT, "P")
simple(8, "promo_extra_units", MID, ["item_nbr"], "sum(units - baseline) FILTER (on_promo AND baseline > 0)", "P")
simple(9, "post_promo_dip_pct", MID, ["family", "region"], DIP, "P")
LFL_BY = ["year", "region"]
_lfl_s, _lfl_r = lfl("ls", "S", "value", ["year"], ["region"]), lfl("lr", "D", "receipts", ["year"], ["region"])
_growth = "(coalesce(now, 0) - coalesce(py, 0)) / py"
for _n, _name, _col, _table, _text in (
        (10, "lfl_sales", "now", "ls", _lfl_s), (11, "lfl_sales_py", "py", "ls", _lfl_s),
        (12, "lfl_growth_pct", _growth, "ls", _lfl_s), (17, "lfl_receipts", "now", "lr", _lfl_r),
        (18, "lfl_receipts_py", "py", "lr", _lfl_r), (19, "lfl_footfall_growth_pct", _growth, "lr", _lfl_r)):
    measure(_n, _name, FINE, LFL_BY, f"SELECT * FROM (SELECT year, region, {_col} AS {_name} FROM {_table}) WHERE {_name} IS NOT NULL", _text)
simple(13, "receipts", FINE, ["city"], "sum(receipts)", "D")
measure(14, "basket_value", FINE, ["region", "year"],
        """SELECT region, year, v / n AS basket_value FROM (SELECT region, year, sum(value) AS v FROM S GROUP BY ALL)
           JOIN (SELECT region, year, sum(receipts) AS n FROM D GROUP BY ALL) USING (region, year)""")
simple(15, "target", FINE, ["year", "store_name"], "sum(target_value)", "D")
measure(16, "sales_vs_target_pct", FINE, ["store_name", "year"], "FROM vt", versus_target("vt", ["store_name", "year"]))
measure(20, "lfl_basket_growth_pct", FINE, LFL_BY,
        """SELECT year, region, (a - b) / nullif(1 + b, 0) AS lfl_basket_growth_pct FROM (
             SELECT year, region, (coalesce(ls.now, 0) - coalesce(ls.py, 0)) / ls.py AS a, (coalesce(lr.now, 0) - coalesce(lr.py, 0)) / lr.py AS b
             FROM ls JOIN lr USING (year, region)) WHERE a IS NOT NULL AND b IS NOT NULL""", _lfl_s + "," + _lfl_r)
simple(21, "avg_rain", FINE, ["region", "year"], "avg(rain_mm)", "D")
simple(22, "avg_max_temp", FINE, ["city"], "avg(temp_max_c)", "D")
simple(23, "stockout_risk_items", MID, ["family", "year"], "count(DISTINCT (store_key, item_key))", "R")
_risk_levels = ["region", "family", "year"]
add("m23_stockout_risk_items_by_level", MID,
    lambda s: evaluate_levels(s.star, _risk_levels, ["stockout_risk_items", "est_lost_units"]),
    [*_risk_levels, "depth", "stockout_risk_items", "est_lost_units"],
    " UNION ALL ".join(
        f"SELECT {', '.join(c if i < d else f'NULL AS {c}' for i, c in enumerate(_risk_levels))}, {d} AS depth, "
        f"count(DISTINCT (store_key, item_key)) AS stockout_risk_items, sum(expected_units) AS est_lost_units FROM R GROUP BY {', '.join(_risk_levels[:d])}"
        for d in (1, 2, 3)))
simple(24, "est_lost_units", MID, ["store_name", "family"], "sum(expected_units)", "R")
simple(25, "est_lost_sales", MID, ["item_nbr"], "sum(lost)", "R")
measure(26, "est_lost_sales_7d", MID, ["year", "month_num", "region"],
        """SELECT k.year, k.month_num, region, sum(lost) AS est_lost_sales_7d
           FROM (SELECT year, month_num, max(date) AS last FROM cal GROUP BY ALL) k JOIN R ON R.date > last - 7 AND R.date <= last
           GROUP BY ALL""", "")
FLAGGED = """
FR AS (SELECT f.*, store_name, region, family, item.item_nbr AS item, year FROM flagged f JOIN store ON store.store_key = f.store_nbr
       JOIN item ON item.item_nbr = f.item_nbr JOIN cal ON cal.date = f.start_date WHERE is_flagged)"""
simple(27, "flagged_runs", MID, ["store_name", "year"], "count(*)", "FR", FLAGGED)
simple(28, "lost_units_runs", MID, ["family"], "sum(expected_lost_units)", "FR", FLAGGED)
simple(29, "median_run_days", MID, ["family", "region"], "median(run_days)", "FR", FLAGGED)
simple(30, "stockout_rate_pct", MID, ["region"], "sum(flagged_days) / sum(item_days)", "week JOIN store USING (store_key)")
EVENTS = """
E AS (SELECT e.*, region, store_name, year, floor(uplift * 10000 + 0.5 + 1e-6) / 10000 AS u4, floor(net_lift * 10000 + 0.5 + 1e-6) / 10000 AS n4 FROM events_done e
      JOIN store USING (store_key) JOIN cal ON cal.date = e.start_date)"""
simple(31, "promo_events", MID, ["family", "year"], "count(*)", "E", EVENTS)
simple(32, "median_uplift_pct", MID, ["family", "region"], "median(u4)", "E", EVENTS)
simple(33, "median_net_lift_pct", MID, ["store_name"], "median(n4)", "E", EVENTS)
PAYBACK_COLUMNS = {
    34: ("family_net_lift_pct", "net_median"), 35: ("family_net_lift_low_pct", "net_lo"),
    36: ("family_net_lift_high_pct", "net_hi"), 37: ("family_uplift_pct", "uplift_median"), 38: ("family_dip_pct", "dip_median")}
for _n, (_name, _col) in PAYBACK_COLUMNS.items():
    measure(_n, _name, MID, ["family"], f"SELECT family, {_col} AS {_name} FROM payback WHERE {_col} IS NOT NULL", PAYBACK)
measure(39, "families_paying_back", MID, [], "SELECT nullif(count(*) FILTER (net_lo > 0), 0) AS families_paying_back FROM payback",
        PAYBACK)
measure(40, "nb_flag_rate_pct", MID, [], "SELECT count(*) FILTER (p_value <= cutoff) / count(*) AS nb_flag_rate_pct FROM tested, cut",
        "")
measure(41, "poisson_flag_rate_pct", MID, [],
        "SELECT count(*) FILTER (p_poisson <= poisson_cutoff) / count(*) AS poisson_flag_rate_pct FROM tested, cut", "")
measure(42, "max_chance_flags", MID, [], "SELECT cutoff * m AS max_chance_flags FROM cut", "")


# --- T: time calculations ------------------------------------------------------------------------------------------

MONTH_CELLS = "mc AS (SELECT year AS ky, month_num AS km, date FROM cal)"


def to_date_cells(name: str, source: str, keys: list[str], unit: str) -> str:
    return f"""
{name} AS (SELECT {comma(*(f'z.{k}' for k in keys))}cal.date FROM (SELECT {comma(*keys)}max(date) AS last FROM {source} {grouped(keys)}) z
  JOIN cal ON cal.date <= last AND cal.date >= date_trunc('{unit}', last))"""


KM = ["ky", "km"]
CELL_SETS = ",".join([
    MONTH_CELLS, to_date_cells("mtd", "mc", KM, "month"), to_date_cells("ytd", "mc", KM, "year"),
    py_cells("py", "mc", KM), py_cells("pyytd", "ytd", KM)])


def over_cells(cells: str, label: str, figure: str = "sum(value)", name: str = "sales_value", rows: str = "S", more=()) -> str:
    return f"""SELECT ky AS year, km AS month_num, {comma(*more)}'{label}' AS show_as, {figure} AS {name}
      FROM {cells} c JOIN {rows} USING (date) GROUP BY ky, km{''.join(f', {m}' for m in more)}"""


def timed(key, items, sql, name="sales_value", by=("year", "month_num"), grain=FINE):
    add(key, grain, lambda s: reports.show_as(s.star, list(by), [name], items), [*by, "show_as", name], sql, CELL_SETS)


timed("t1_actual", [timecalc.ACTUAL], over_cells("mc", "Actual"))
timed("t2_mtd", [timecalc.MTD], over_cells("mtd", "MTD", more=["region"]), by=("year", "month_num", "region"))
timed("t3_ytd", [timecalc.YTD], over_cells("ytd", "YTD", more=["region"]), by=("year", "month_num", "region"))
timed("t4_py", [timecalc.PY], over_cells("py", "PY"))
timed("t5_py_ytd", [timecalc.PY_YTD], over_cells("pyytd", "PY YTD"))
PAIR = f"""
this_year AS ({over_cells('mc', 'Actual', MARGIN, 'a', more=['region'])}),
last_year AS ({over_cells('py', 'PY', MARGIN, 'b', more=['region'])})"""
add("t6_yoy_delta", FINE,
    lambda s: reports.show_as(s.star, ["year", "month_num", "region"], ["gross_margin_pct"], [timecalc.YOY_DELTA]),
    ["year", "month_num", "region", "show_as", "gross_margin_pct"],
    "SELECT year, month_num, region, 'YoY Δ' AS show_as, a - b AS gross_margin_pct FROM this_year JOIN last_year USING (year, month_num, region)",
    CELL_SETS + "," + PAIR)
add("t7_yoy_pct", FINE,
    lambda s: reports.show_as(s.star, ["year", "month_num", "region"], ["gross_margin_pct"], [timecalc.YOY_PCT]),
    ["year", "month_num", "region", "show_as", "gross_margin_pct"],
    "SELECT year, month_num, region, 'YoY %' AS show_as, (a - b) / b AS gross_margin_pct FROM this_year JOIN last_year USING (year, month_num, region)",
    CELL_SETS + "," + PAIR)
timed("t8_show_as_pivot", [timecalc.ACTUAL, timecalc.MTD, timecalc.YTD, timecalc.PY, timecalc.PY_YTD],
      " UNION ALL ".join(over_cells(c, l) for c, l in
                         (("mc", "Actual"), ("mtd", "MTD"), ("ytd", "YTD"), ("py", "PY"), ("pyytd", "PY YTD"))))
add("t8_receipts_by_day_ytd", FINE,
    lambda s: reports.show_as(s.star, ["date"], ["receipts"], [timecalc.ACTUAL, timecalc.MTD, timecalc.YTD, timecalc.PY]),
    ["date", "show_as", "receipts"], """
SELECT date, 'Actual' AS show_as, n AS receipts FROM daysum WHERE n IS NOT NULL
UNION ALL SELECT date, 'MTD', sum(n) OVER (PARTITION BY year(date), month(date) ORDER BY date) FROM daysum
QUALIFY sum(n) OVER (PARTITION BY year(date), month(date) ORDER BY date) IS NOT NULL
UNION ALL SELECT date, 'YTD', sum(n) OVER (PARTITION BY year(date) ORDER BY date) FROM daysum
QUALIFY sum(n) OVER (PARTITION BY year(date) ORDER BY date) IS NOT NULL
UNION ALL SELECT cal.date, 'PY', n FROM cal JOIN daysum ON daysum.date = (cal.date - INTERVAL 1 YEAR)::DATE
  WHERE n IS NOT NULL AND daysum.date <= (SELECT (hi - INTERVAL 1 YEAR)::DATE FROM ends)""",
    "daysum AS (SELECT cal.date, sum(receipts) AS n FROM cal LEFT JOIN D USING (date) GROUP BY ALL)")
add("t9_last_n_days", MID,
    lambda s: evaluate(s.star, ["year", "month_num", "family"], ["est_lost_sales_7d"]),
    ["year", "month_num", "family", "est_lost_sales_7d"],
    """SELECT k.year, k.month_num, family, sum(lost) AS est_lost_sales_7d
       FROM (SELECT year, month_num, max(date) AS last FROM cal GROUP BY ALL) k JOIN R ON R.date > last - 7 AND R.date <= last
       GROUP BY ALL""")
LEVELS = ["year", "quarter", "month_num", "date"]
add("t10_calendar_hierarchy", FINE, lambda s: reports.drill(s.star, ["units", "gross_margin_pct"]),
    [*LEVELS, "depth", "units", "gross_margin_pct"],
    " UNION ALL ".join(
        f"SELECT {', '.join(c if i < d else f'NULL AS {c}' for i, c in enumerate(LEVELS))}, {d} AS depth, sum(units) AS units, "
        f"{MARGIN} AS gross_margin_pct FROM S GROUP BY {', '.join(LEVELS[:d])}" for d in range(1, 5)))

# --- Q: reports --------------------------------------------------------------------------------------------------------


def report(key, grain, build, columns, sql, extra=""):
    add(key, grain, lambda s: build(s.star), columns, sql, extra)


_select, _extra = network_sql([])
report("q1_network_kpis", FINE, reports.network_kpis, reports.NETWORK, _select, _extra)
_select_r, _extra_r = network_sql(["region"])
_select_t, _extra_t = network_sql([], "t")
_q2 = f"SELECT *, false AS is_total FROM ({_select_r}) UNION ALL SELECT NULL AS region, *, true FROM ({_select_t})"
_q2_extra = _extra_r + "," + _extra_t
report("q2_region_table", FINE, reports.region_table, ["region", *reports.NETWORK, "is_total"], _q2, _q2_extra)
report("q3_region_vs_target", FINE, reports.region_vs_target, ["region", "sales_vs_target_pct"], "FROM vt", versus_target("vt", ["region"]))
TREND = " UNION ALL ".join(over_cells(c, l) for c, l in (("mc", "Actual"), ("py", "PY")))
report("q4_sales_trend", FINE, reports.sales_trend, ["year", "month_num", "show_as", "sales_value"], TREND, CELL_SETS)
_store_lfl = lfl("ls", "S", "value", [], ["store_name"])
report("q5_store_lfl_ranking", FINE, reports.store_lfl_ranking, ["store_name", "lfl_growth_pct"],
       f"SELECT * FROM (SELECT store_name, {_growth} AS lfl_growth_pct FROM ls) WHERE lfl_growth_pct IS NOT NULL", _store_lfl)
_q6, _q6_extra = network_sql(["store_name"])
report("q6_footfall_vs_basket", FINE, reports.footfall_vs_basket,
       ["store_name", "lfl_growth_pct", "lfl_footfall_growth_pct", "lfl_basket_growth_pct"],
       f"SELECT * FROM ({_q6}) WHERE lfl_growth_pct IS NOT NULL OR lfl_footfall_growth_pct IS NOT NULL", _q6_extra)
report("q7_weekday_pattern", FINE, reports.weekday_sales, ["weekday_num", "weekday_name", "show_as", "sales_value"],
       """SELECT k AS weekday_num, w AS weekday_name, 'Actual' AS show_as, sum(value) AS sales_value FROM wc JOIN S USING (date) GROUP BY k, w
          UNION ALL SELECT k, w, 'PY', sum(value) FROM wpy JOIN S USING (date) GROUP BY k, w""",
       "wc AS (SELECT weekday_num AS k, weekday_name AS w, date FROM cal)," + py_cells("wpy", "wc", ["k", "w"]))
report("q8_rain_vs_receipts", FINE, reports.rain_vs_receipts, ["date", "avg_rain", "receipts"],
       """SELECT date, avg(rain_mm) AS avg_rain, sum(receipts) AS receipts FROM D GROUP BY date
          HAVING count(rain_mm) + count(receipts) > 0""")
report("q9_store_detail_kpis", FINE, reports.store_detail_kpis,
       ["store_name", "sales_value", "sales_vs_target_pct", "receipts", "basket_value"],
       """SELECT store_name, sales_value, sales_vs_target_pct, receipts, sales_value / receipts AS basket_value
          FROM (SELECT store_name, sum(value) AS sales_value FROM S GROUP BY 1) FULL JOIN vt USING (store_name)
          FULL JOIN (SELECT store_name, sum(receipts) AS receipts FROM D GROUP BY 1) USING (store_name)""",
       versus_target("vt", ["store_name"]))
report("q10_daily_vs_target", FINE, reports.daily_vs_target, ["year", "month_num", "date", "sales_value", "target"],
       """SELECT year, month_num, date, sales_value, target FROM cal LEFT JOIN (SELECT date, sum(value) AS sales_value FROM S GROUP BY 1) USING (date)
          LEFT JOIN (SELECT date, sum(target_value) AS target FROM D GROUP BY 1) USING (date)
          WHERE sales_value IS NOT NULL OR target IS NOT NULL""")
LOST = "sum(expected_units) AS est_lost_units, sum(lost) AS est_lost_sales"
report("q11_fresh_at_risk", MID, reports.fresh_at_risk, ["item_nbr", "family", "est_lost_units", "est_lost_sales"],
       f"SELECT item_nbr, family, {LOST} FROM R WHERE is_perishable GROUP BY ALL")
report("q12_fresh_kpis", MID, reports.fresh_kpis,
       ["fresh_share_pct", "stockout_risk_items", "est_lost_units", "est_lost_sales"],
       f"""SELECT (SELECT sum(value) FILTER (is_perishable) / sum(value) FROM S) AS fresh_share_pct,
             count(DISTINCT (store_key, item_key)) AS stockout_risk_items, {LOST} FROM R""")
report("q13_items_at_risk", MID, reports.items_at_risk, ["store_name", "item_nbr", "family", "est_lost_units", "est_lost_sales"],
       f"""SELECT * FROM (SELECT store_name, item_nbr, family, {LOST} FROM R WHERE is_perishable GROUP BY ALL)
           QUALIFY rank() OVER (ORDER BY est_lost_sales DESC) <= 50""")
report("q14_lost_sales_by_family", MID, reports.lost_sales_by_family, ["family", "est_lost_sales"],
       "SELECT family, sum(lost) AS est_lost_sales FROM R WHERE is_perishable GROUP BY 1")
report("q15_lost_sales_trend", MID, reports.lost_sales_trend, ["year", "month_num", "date", "show_as", "est_lost_sales"],
       """SELECT year, month_num, date, 'Actual' AS show_as, v AS est_lost_sales FROM cal JOIN lost_day USING (date)
          UNION ALL SELECT year, month_num, cal.date, 'PY', v FROM cal JOIN lost_day x ON x.date = (cal.date - INTERVAL 1 YEAR)::DATE
          WHERE x.date <= (SELECT (hi - INTERVAL 1 YEAR)::DATE FROM ends)""",
       "lost_day AS (SELECT date, sum(lost) AS v FROM R WHERE is_perishable GROUP BY 1)")
report("q16_promotion_kpis", MID, reports.promotion_kpis, ["promo_uplift_pct", "post_promo_dip_pct", "units", "gross_margin_pct"],
       f"SELECT {UPLIFT} AS promo_uplift_pct, {DIP} AS post_promo_dip_pct, sum(units) AS units, {MARGIN} AS gross_margin_pct FROM P")
report("q17_promotions_by_family", MID, reports.promotions_by_family, ["family", "promo_uplift_pct", "post_promo_dip_pct", "gross_margin_pct"],
       f"SELECT family, {UPLIFT} AS promo_uplift_pct, {DIP} AS post_promo_dip_pct, {MARGIN} AS gross_margin_pct FROM P GROUP BY family")
report("q18_uplift_by_family", MID, reports.uplift_by_family, ["family", "promo_extra_units", "promo_uplift_pct"],
       f"""SELECT family, sum(units - baseline) FILTER (on_promo AND baseline > 0) AS promo_extra_units, {UPLIFT} AS promo_uplift_pct
           FROM P GROUP BY family""")
report("q19_dip_by_family", MID, reports.dip_by_family, ["family", "post_promo_dip_pct"],
       f"SELECT family, {DIP} AS post_promo_dip_pct FROM P GROUP BY family")
report("q20_lift_vs_shift", MID, reports.lift_vs_shift, ["family", "promo_uplift_pct", "post_promo_dip_pct"],
       f"SELECT family, {UPLIFT} AS promo_uplift_pct, {DIP} AS post_promo_dip_pct FROM P GROUP BY family")
report("q21_margin_by_family", FINE, reports.margin_by_family, ["family", "gross_margin_pct"],
       f"SELECT family, {MARGIN} AS gross_margin_pct FROM S GROUP BY family")
_on_day = f"date = DATE '{DAY}'"
report("q22_store_today", FINE, lambda star: reports.store_today(star, DAY),
       ["store_name", "sales_value", "target", "sales_vs_target_pct"],
       f"""SELECT store_name, sales_value, target, sales_vs_target_pct
           FROM (SELECT store_name, sum(value) AS sales_value FROM S WHERE {_on_day} GROUP BY 1)
           FULL JOIN (SELECT store_name, sum(target_value) AS target FROM D WHERE {_on_day} GROUP BY 1) USING (store_name)
           FULL JOIN vt USING (store_name) WHERE sales_value IS NOT NULL OR target IS NOT NULL""",
       versus_target("vt", ["store_name"], _on_day))
report("q23_store_today_yoy", MID, lambda star: reports.store_today_yoy(star, DAY),
       ["store_name", "show_as", "receipts", "basket_value"],
       """SELECT store_name, 'Actual' AS show_as, n AS receipts, v / n AS basket_value FROM fig WHERE d = 0 AND n IS NOT NULL
          UNION ALL SELECT store_name, 'YoY %', (a.n - b.n) / b.n, (a.v / a.n - b.v / b.n) / nullif(b.v / b.n, 0)
          FROM (FROM fig WHERE d = 0) a JOIN (FROM fig WHERE d = 1) b USING (store_name) WHERE a.n IS NOT NULL AND b.n IS NOT NULL""",
       f"""fig AS (SELECT store_name, d, n, v FROM
             (SELECT store_name, (date < DATE '{DAY}')::INT AS d, sum(receipts) AS n FROM D
              WHERE date IN (DATE '{DAY}', DATE '{DAY.replace(year=DAY.year - 1)}') GROUP BY ALL)
             LEFT JOIN (SELECT store_name, (date < DATE '{DAY}')::INT AS d, sum(value) AS v FROM S
              WHERE date IN (DATE '{DAY}', DATE '{DAY.replace(year=DAY.year - 1)}') GROUP BY ALL) USING (store_name, d))""")
ENTRIES["q23_store_today_yoy"] = (
    *ENTRIES["q23_store_today_yoy"][:2], "store_name:s show_as:s receipts:6 basket_value:4", ENTRIES["q23_store_today_yoy"][3])
report("q24_fresh_last_7_days", MID, lambda star: reports.fresh_last_7_days(star, DAY), ["item_nbr", "family", "est_lost_sales_7d"],
       f"""SELECT item_nbr, family, sum(lost) AS est_lost_sales_7d FROM R
           WHERE is_perishable AND date > DATE '{DAY}' - 7 AND date <= DATE '{DAY}' GROUP BY ALL""")
report("q25_payback_by_family", MID, reports.payback_by_family,
       ["family", *(n for n, _ in PAYBACK_COLUMNS.values())],
       f"SELECT family, {', '.join(f'{c} AS {n}' for n, c in PAYBACK_COLUMNS.values())} FROM payback", PAYBACK)
report("q26_stockout_rate_by_store", MID, reports.stockout_rate_by_store,
       ["store_name", "stockout_rate_pct", "flagged_runs", "median_run_days"],
       """SELECT store_name, stockout_rate_pct, flagged_runs, median_run_days
          FROM (SELECT store_name, sum(flagged_days) / sum(item_days) AS stockout_rate_pct FROM week JOIN store USING (store_key) GROUP BY 1)
          LEFT JOIN (SELECT store_name, count(*) AS flagged_runs, median(run_days) AS median_run_days FROM FR GROUP BY 1) USING (store_name)""",
       FLAGGED)
report("q27_stockout_rate_trend", MID, reports.stockout_rate_trend, ["year", "month_num", "date", "stockout_rate_pct"],
       """SELECT year, month_num, date, sum(flagged_days) / sum(item_days) AS stockout_rate_pct
          FROM week JOIN cal ON date = week_start GROUP BY ALL""")
report("q28_deep_dive_kpis", MID, reports.deep_dive_kpis,
       ["stockout_rate_pct", "lost_units_runs", "median_net_lift_pct", "families_paying_back"],
       """SELECT (SELECT sum(flagged_days) / sum(item_days) FROM week) AS stockout_rate_pct,
            (SELECT sum(expected_lost_units) FROM flagged WHERE is_flagged) AS lost_units_runs,
            (SELECT median(floor(net_lift * 10000 + 0.5 + 1e-6) / 10000) FROM events_done) AS median_net_lift_pct,
            (SELECT nullif(count(*) FILTER (net_lo > 0), 0) FROM payback) AS families_paying_back""", PAYBACK)
_slice = "year IN (1999, 2000) AND region IN ('ASIA', 'EUROPE') AND type IN ('A', 'C')"
add("q29_slicer_filters", FINE,
    lambda s: evaluate(
        reports.sliced(s.star, years=[1999, 2000], regions=["ASIA", "EUROPE"], store_types=["A", "C"], families=["PROMO", "SMALL"]),
        ["year", "region"], ["sales_value", "receipts", "basket_value", "sales_vs_target_pct"]),
    ["year", "region", "sales_value", "receipts", "basket_value", "sales_vs_target_pct"],
    f"""SELECT year, region, sales_value, receipts, sales_value / receipts AS basket_value, sales_vs_target_pct
        FROM (SELECT year, region, sum(value) AS sales_value FROM S WHERE {_slice} AND family IN ('PROMO', 'SMALL') GROUP BY ALL)
        FULL JOIN (SELECT year, region, sum(receipts) AS receipts FROM D WHERE {_slice} GROUP BY ALL) USING (year, region)
        FULL JOIN vt USING (year, region)""",
    "SF AS (SELECT * FROM S WHERE family IN ('PROMO', 'SMALL'))," + versus_target("vt", ["year", "region"], _slice, "SF"))
report("q30_totals_year_region", FINE, reports.totals_by_year_region, ["year", "region", "units", "sales_value"],
       "SELECT year, region, sum(units) AS units, sum(value) AS sales_value FROM S GROUP BY ALL")

# --- A: access -------------------------------------------------------------------------------------------------------------

REGIONAL, MANAGER, HEAD = "regional.manager@chain.example", "store.manager@chain.example", "head.office@chain.example"
ROLES = {security.STORE_OPERATIONS: [REGIONAL, MANAGER], security.COMMERCIAL: [HEAD]}
SEEN = f"seen AS (SELECT store_key FROM access WHERE upn = '{REGIONAL}')"


def _seen(s: Stage, user: str = REGIONAL):
    return security.secure(s.star, user, ROLES)


add("a1_dynamic_row_filter", FINE,
    lambda s: evaluate(_seen(s), ["store_name", "year"], ["sales_value", "receipts", "target"]),
    ["store_name", "year", "sales_value", "receipts", "target"],
    """SELECT store_name, year, sales_value, receipts, target
       FROM (SELECT store_name, year, sum(receipts) AS receipts, sum(target_value) AS target FROM D WHERE store_key IN (FROM seen) GROUP BY ALL)
       LEFT JOIN (SELECT store_name, year, sum(value) AS sales_value FROM S WHERE store_key IN (FROM seen) GROUP BY ALL) USING (store_name, year)""",
    ACCESS + "," + SEEN)
add("a2_own_access_rows", FINE, lambda s: _seen(s).fact("user_access"), [],
    "SELECT upn AS user_principal_name, store_key FROM access WHERE upn = 'regional.manager@chain.example'", ACCESS,
    kinds="user_principal_name:s store_key:i")


def _denied(s: Stage) -> DataFrame:
    star = s.star
    rows = []
    for user in (REGIONAL, HEAD):
        seen = security.secure(star, user, ROLES)
        for table in ("promo_family_summary", "stockout_bh_summary", "user_access"):
            rows.append(seen.fact(table).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(user).alias("user"), F.lit(table).alias("table"), "rows"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


add("a3_table_denied", MID, _denied, [], f"""
SELECT '{REGIONAL}' AS "user", 'promo_family_summary' AS "table", 0 AS "rows" UNION ALL SELECT '{REGIONAL}', 'stockout_bh_summary', 0
UNION ALL SELECT '{REGIONAL}', 'user_access', (SELECT count(*) FROM access WHERE upn = '{REGIONAL}')
UNION ALL SELECT '{HEAD}', 'promo_family_summary', (SELECT count(DISTINCT family) FROM events_done WHERE uplift IS NOT NULL OR post_dip IS NOT NULL)
UNION ALL SELECT '{HEAD}', 'stockout_bh_summary', 1 UNION ALL SELECT '{HEAD}', 'user_access', 0""", ACCESS,
    kinds="user:s table:s rows:i")


def _column_denied(s: Stage) -> DataFrame:
    """Cost figures per user: a value, or blank where the role may not see unit cost."""
    parts = []
    for user in (MANAGER, HEAD):
        star = _seen(s, user)
        for name in ("sales_value", "cost_value"):
            try:
                figure = evaluate(star, [], [name]).withColumnRenamed(name, "figure").withColumn("denied", F.lit(False))
            except AccessDenied:
                figure = evaluate(star, [], ["units"]).select(F.lit(None).cast("double").alias("figure"), F.lit(True).alias("denied"))
            parts.append(figure.select(F.lit(user).alias("user"), F.lit(name).alias("measure"), "figure", "denied"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


add("a4_column_denied", FINE, _column_denied, [], f"""
SELECT '{MANAGER}' AS "user", 'sales_value' AS measure, (SELECT sum(value) FROM S WHERE store_key IN (FROM busy)) AS figure, false AS denied
UNION ALL SELECT '{MANAGER}', 'cost_value', NULL, true UNION ALL SELECT '{HEAD}', 'sales_value', (SELECT sum(value) FROM S), false
UNION ALL SELECT '{HEAD}', 'cost_value', (SELECT sum(cost) FROM S), false""", ACCESS, kinds="user:s measure:s figure:2 denied:b")


def _matrix(s: Stage) -> DataFrame:
    members = s.spark.createDataFrame(
        [(user, role) for role, users in ROLES.items() for user in users], "user string, role string")
    return security.access_matrix(s.star, members)


add("a6_access_matrix", FINE, _matrix, [], f"""
SELECT u AS "user", CASE WHEN u = '{HEAD}' THEN 'Commercial' ELSE 'Store operations' END AS "role",
  CASE WHEN u = '{HEAD}' THEN (SELECT count(*) FROM store) ELSE (SELECT count(*) FROM access WHERE upn = u) END AS stores,
  (SELECT count(*) FROM access WHERE upn = u) AS access_rows, u = '{HEAD}' AS cost_visible
FROM (VALUES ('{REGIONAL}'), ('{MANAGER}'), ('{HEAD}')) v(u)""", ACCESS,
    kinds="user:s role:s stores:i access_rows:i cost_visible:b")
