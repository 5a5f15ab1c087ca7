"""DuckDB text of the tables the checks start from: common table expressions per grain, from the order-line tables."""

from __future__ import annotations

from aisleframe.sources.orderlines import (
    BRAND_FAMILIES, HOLIDAY_TOTAL, HOLIDAY_TYPE, TRANSFERRED_TOTAL, TYPE_MARGIN_PCT)

LINES = {
    "supplier_part": """
l AS (SELECT l_shipdate::DATE AS date, l_suppkey AS store_nbr, l_partkey AS item_nbr, l_orderkey,
        l_quantity * CASE WHEN l_returnflag || l_linestatus = 'RF' THEN -1 ELSE 1 END AS unit_sales,
        CASE WHEN l_discount = 0 THEN NULL ELSE l_discount >= 0.09 END AS onpromotion
      FROM lineitem)""",
    "nation_brand": """
l AS (SELECT l_shipdate::DATE AS date, (s_nationkey + 1)::BIGINT AS store_nbr,
        replace(p_brand, 'Brand#', '')::BIGINT AS item_nbr, l_orderkey,
        l_quantity * CASE WHEN l_returnflag || l_linestatus = 'RF' THEN -1 ELSE 1 END AS unit_sales,
        CASE WHEN l_discount = 0 THEN NULL ELSE l_discount >= 0.09 END AS onpromotion
      FROM lineitem, supplier, part WHERE l_suppkey = s_suppkey AND l_partkey = p_partkey)""",
}
STORES = {
    "supplier_part": """
st AS (SELECT s_suppkey AS store_nbr, n_name AS city, n_name AS state, chr((65 + s_suppkey % 5)::INT) AS type,
         n_regionkey::BIGINT AS cluster, (600 + floor(abs(s_acctbal) / 10))::BIGINT AS selling_area_m2
       FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
    "nation_brand": """
st AS (SELECT (n_nationkey + 1)::BIGINT AS store_nbr, n_name AS city, n_name AS state,
         chr((65 + (n_nationkey + 1) % 5)::INT) AS type, n_regionkey::BIGINT AS cluster,
         (SELECT 600 + count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS selling_area_m2
       FROM nation)""",
}
_margins = ", ".join(f"('{family}', {pct})" for family, pct in TYPE_MARGIN_PCT.items())
ITEMS = {
    "supplier_part": f"""
margins AS (SELECT family, (pct / 100.0)::DECIMAL(4,2) AS margin FROM (VALUES {_margins}) m(family, pct)),
it AS (SELECT p_partkey AS item_nbr, p_type AS family, p_size::BIGINT AS class, (p_size % 2)::BIGINT AS perishable,
         p_retailprice::DECIMAL(10,2) AS unit_price FROM part)""",
    "nation_brand": f"""
margins AS (SELECT 'GROUP ' || i AS family, ((i + 2) / 10.0)::DECIMAL(4,2) AS margin FROM range({BRAND_FAMILIES}) r(i)),
it AS (SELECT b AS item_nbr, 'GROUP ' || (b % {BRAND_FAMILIES}) AS family, b AS class, b % 2 AS perishable,
         ((cents // n) / 100.0)::DECIMAL(10,2) AS unit_price
       FROM (SELECT replace(p_brand, 'Brand#', '')::BIGINT AS b, sum(round(p_retailprice * 100)::BIGINT)::BIGINT AS cents,
               count(*) AS n FROM part GROUP BY 1))""",
}
_kinds = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in HOLIDAY_TYPE.items())
SHARED = f"""
raw_holidays AS (
  SELECT o_orderdate::DATE AS date, CASE o_orderpriority {_kinds} END AS type,
    CASE WHEN o_totalprice >= {HOLIDAY_TOTAL} THEN 'National' ELSE 'Local' END AS locale, o_orderstatus AS locale_name,
    o_orderpriority AS description, o_totalprice >= {TRANSFERRED_TOTAL} AS transferred
  FROM orders),
hol AS (SELECT date FROM raw_holidays WHERE locale = 'National' AND type <> 'Work Day' AND transferred = false GROUP BY date),
tx AS (SELECT date, store_nbr, count(DISTINCT l_orderkey) AS receipts FROM l GROUP BY ALL),
sales AS (
  SELECT date, store_nbr, item_nbr, sum(CASE WHEN unit_sales > 0 THEN unit_sales ELSE 0 END) AS units,
    sum(CASE WHEN unit_sales < 0 THEN -unit_sales ELSE 0 END) AS return_units,
    CASE WHEN count(onpromotion) > 0 THEN max(onpromotion::INT) = 1 END AS on_promo
  FROM l GROUP BY ALL),
ends AS (SELECT min(date) AS lo, max(date) AS hi FROM (FROM sales SELECT date UNION ALL FROM tx SELECT date)),
cal AS (
  SELECT date, strftime(date, '%Y%m%d')::INT AS date_key, year(date) AS year, quarter(date) AS quarter,
    month(date) AS month_num, strftime(date, '%b') AS month_name, (strftime(date, '%Y%m'))::INT AS month_key,
    weekofyear(date) AS iso_week, isoyear(date) AS iso_year, isodow(date) AS weekday_num, strftime(date, '%a') AS weekday_name,
    isodow(date) > 5 AS is_weekend, date IN (FROM hol) AS is_national_holiday, strftime(date, '%b %Y') AS year_month
  FROM (SELECT lo + unnest(range(hi - lo + 1))::INT AS date FROM ends)),
store AS (
  SELECT st.store_nbr AS store_key, st.*, r_name AS region, 'Store ' || st.store_nbr || ' (' || city || ')' AS store_name,
    CASE WHEN first_day > (SELECT min(date) FROM tx) + 7 THEN first_day END AS opening_date
  FROM st JOIN (SELECT store_nbr, min(date) AS first_day FROM tx GROUP BY 1) USING (store_nbr)
  JOIN nation ON n_name = state JOIN region ON r_regionkey = n_regionkey),
item AS (
  SELECT item_nbr AS item_key, item_nbr, family, class, perishable = 1 AS is_perishable, unit_price,
    round(unit_price * (1 - margin), 2)::DECIMAL(10,2) AS unit_cost
  FROM it JOIN margins USING (family)),
trade AS (
  SELECT a.store_nbr, a.date, a.receipts, count(b.date) AS trading_days, a.receipts >= 0.5 * avg(b.receipts) AS full_day
  FROM tx a LEFT JOIN tx b ON b.store_nbr = a.store_nbr AND b.date < a.date AND b.date >= a.date - 28
  GROUP BY a.store_nbr, a.date, a.receipts),
look AS (
  SELECT a.store_nbr, a.item_nbr, a.date, a.units, a.return_units, a.on_promo,
    sum(CASE WHEN b.on_promo THEN 0 ELSE b.units END) AS usual_units, count(*) FILTER (b.on_promo) AS promos_28,
    count(*) FILTER (b.on_promo AND b.date >= a.date - 7) AS promos_7
  FROM sales a LEFT JOIN sales b
    ON b.store_nbr = a.store_nbr AND b.item_nbr = a.item_nbr AND b.date < a.date AND b.date >= a.date - 28
  GROUP BY ALL),
fact AS (
  SELECT look.*, first_sale, trading_days, coalesce(on_promo, false) = false AND promos_7 > 0 AS post_promo,
    CASE WHEN (on_promo OR promos_7 > 0) AND look.date - first_sale >= 28 AND trading_days <> promos_28
      THEN coalesce(usual_units, 0) / (trading_days - promos_28) END AS baseline
  FROM look JOIN (SELECT store_nbr, item_nbr, min(date) AS first_sale FROM sales GROUP BY ALL) USING (store_nbr, item_nbr)
  LEFT JOIN trade ON trade.store_nbr = look.store_nbr AND trade.date = look.date),
pairs AS (
  SELECT store_nbr, item_nbr, min(date) AS first_sale, max(date) AS last_sale FROM sales
  WHERE date >= DATE '1998-01-01' - 56 GROUP BY ALL HAVING sum(units) >= 84),
series AS (
  SELECT t.store_nbr, p.item_nbr, t.date, full_day, coalesce(s.units, 0) AS units, s.date IS NULL AS no_row
  FROM pairs p JOIN trade t ON t.store_nbr = p.store_nbr AND t.date >= first_sale AND t.date <= last_sale
  LEFT JOIN sales s ON s.store_nbr = p.store_nbr AND s.item_nbr = p.item_nbr AND s.date = t.date),
running AS (
  SELECT *, row_number() OVER days AS nth, sum(units) OVER days - units AS before,
    sum(units * units) OVER days - units * units AS squares_before, sum((NOT no_row)::INT) OVER days AS run_id,
    min(CASE WHEN units > 0 THEN date END) OVER (PARTITION BY store_nbr, item_nbr ORDER BY date DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS next_sale
  FROM series WINDOW days AS (PARTITION BY store_nbr, item_nbr ORDER BY date ROWS UNBOUNDED PRECEDING)),
scored AS (
  SELECT *, before - lag(before, 28) OVER days AS prior_sum, squares_before - lag(squares_before, 28) OVER days AS prior_squares
  FROM running WINDOW days AS (PARTITION BY store_nbr, item_nbr ORDER BY date)),
risk AS (
  SELECT strftime(date, '%Y%m%d')::INT AS date_key, date, store_nbr AS store_key, item_nbr AS item_key,
    round(prior_sum / 28, 2) AS expected_units
  FROM scored WHERE date >= DATE '1998-01-01' AND full_day AND no_row AND nth > 28 AND prior_sum >= 84 AND next_sale <= date + 28),
fs AS (
  SELECT strftime(date, '%Y%m%d')::INT AS date_key, date, store_nbr AS store_key, item_nbr AS item_key, units,
    return_units, on_promo, post_promo, baseline FROM fact),
plain AS (
  SELECT strftime(date, '%Y%m%d')::INT AS date_key, date, store_nbr AS store_key, item_nbr AS item_key, units, return_units
  FROM sales),
months AS (
  SELECT store_key, date_trunc('month', date)::DATE AS month_start, sum(units * unit_price::DOUBLE) AS sales_value,
    count(DISTINCT date) AS active_days
  FROM plain JOIN item USING (item_key) GROUP BY ALL),
weights AS (
  SELECT store_key, weekday_num, v / sum(v) OVER (PARTITION BY store_key) AS weight
  FROM (SELECT store_key, isodow(date) AS weekday_num, sum(units * unit_price::DOUBLE) AS v
        FROM plain JOIN item USING (item_key) GROUP BY ALL)),
goal AS (
  SELECT m.store_key, m.month_start, round(p.sales_value::DECIMAL(18,2) * 1.03::DECIMAL(5,4), 2)::DECIMAL(14,2) AS target_value
  FROM months m JOIN months p ON p.store_key = m.store_key AND p.month_start = m.month_start - INTERVAL 1 YEAR
  WHERE p.active_days >= 5),
goal_days AS (
  SELECT store_key, month_start, target_value, month_start + i::INT AS date, weight
  FROM goal JOIN range(31) r(i) ON i < day(last_day(month_start))
  JOIN weights USING (store_key)
  WHERE weekday_num = isodow(month_start + i::INT) AND strftime(month_start + i::INT, '%d.%m.') NOT IN ('25.12.', '01.01.')),
shares AS (
  SELECT store_key, month_start, target_value, date,
    round(target_value::DOUBLE * weight / sum(weight) OVER m, 2)::DECIMAL(14,2) AS share, date = max(date) OVER m AS is_last
  FROM goal_days WINDOW m AS (PARTITION BY store_key, month_start)),
daily AS (
  SELECT store_key, month_start, date,
    CASE WHEN is_last THEN target_value - (sum(share) OVER m - share) ELSE share END AS target_value
  FROM shares WINDOW m AS (PARTITION BY store_key, month_start)),
weather AS (
  SELECT n_name AS city, l_shipdate::DATE AS date,
    CASE WHEN sum(round(l_tax * 100)::BIGINT) > 0 THEN sum(round(l_tax * 100)::BIGINT) / count(*) END AS rain_mm,
    20 + sum(round(l_discount * 100)::BIGINT) / count(*) AS temp_max_c
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  WHERE l_returnflag = 'A' GROUP BY ALL),
day AS (
  SELECT coalesce(x.date, g.date) AS date, coalesce(x.store_nbr, g.store_key) AS store_key, receipts,
    g.target_value::DOUBLE AS target_value, rain_mm, temp_max_c
  FROM tx x FULL JOIN daily g ON g.store_key = x.store_nbr AND g.date = x.date
  JOIN store ON store.store_key = coalesce(x.store_nbr, g.store_key)
  LEFT JOIN weather w ON w.city = store.city AND w.date = coalesce(x.date, g.date)
  WHERE coalesce(x.date, g.date) <= (SELECT hi FROM ends)),
S AS (
  SELECT plain.*, cal.* EXCLUDE (date, date_key), store.* EXCLUDE (store_key), item.* EXCLUDE (item_key),
    units * unit_price::DOUBLE AS value, units * unit_cost::DOUBLE AS cost
  FROM plain JOIN cal USING (date) JOIN store USING (store_key) JOIN item USING (item_key)),
P AS (
  SELECT fs.*, cal.* EXCLUDE (date, date_key), store.* EXCLUDE (store_key), item.* EXCLUDE (item_key),
    units * unit_price::DOUBLE AS value, units * unit_cost::DOUBLE AS cost
  FROM fs JOIN cal USING (date) JOIN store USING (store_key) JOIN item USING (item_key)),
D AS (
  SELECT day.*, cal.* EXCLUDE (date), store.* EXCLUDE (store_key)
  FROM day JOIN cal USING (date) JOIN store USING (store_key)),
R AS (
  SELECT risk.*, cal.* EXCLUDE (date, date_key), store.* EXCLUDE (store_key), item.* EXCLUDE (item_key),
    expected_units * unit_price::DOUBLE AS lost
  FROM risk JOIN cal USING (date) JOIN store USING (store_key) JOIN item USING (item_key)),
runs AS (
  SELECT store_nbr, item_nbr, run_id, min(date) FILTER (full_day) AS start_date, max(date) FILTER (full_day) AS end_date,
    count(*) FILTER (full_day) AS run_days, count(*) AS spine_days, arg_min(nth, date) AS nth,
    arg_min(prior_sum, date) AS prior_sum, arg_min(prior_squares, date) AS prior_squares
  FROM scored WHERE no_row GROUP BY ALL
  HAVING count(*) FILTER (full_day) > 0 AND start_date >= DATE '1998-01-01' AND nth > 28 AND prior_sum > 0),
spread AS (
  SELECT *, prior_sum / 28 AS lam,
    greatest(((prior_squares - prior_sum * prior_sum / 28) / 27 - prior_sum / 28) / (prior_sum / 28 * (prior_sum / 28)), 0) AS a
  FROM runs),
tested AS (
  SELECT store_nbr, item_nbr, start_date, end_date, run_days, spine_days, end_date - start_date + 1 AS calendar_days,
    lam AS lambda_units, a AS dispersion,
    CASE WHEN a > 0 THEN exp(-run_days / a * ln(1 + a * lam)) ELSE exp(-lam * run_days) END AS p_value,
    exp(-lam * run_days) AS p_poisson, lam * run_days AS expected_lost_units
  FROM spread),
cut AS (
  SELECT (SELECT count(*) FROM tested) AS m,
    (SELECT max(p_value) FROM (SELECT p_value, rank() OVER (ORDER BY p_value) + count(*) OVER (PARTITION BY p_value) - 1 AS k
       FROM tested) WHERE p_value <= 0.05 * k / (SELECT count(*) FROM tested)) AS cutoff,
    (SELECT max(p_poisson) FROM (SELECT p_poisson, rank() OVER (ORDER BY p_poisson) + count(*) OVER (PARTITION BY p_poisson) - 1 AS k
       FROM tested) WHERE p_poisson <= 0.05 * k / (SELECT count(*) FROM tested)) AS poisson_cutoff),
flagged AS (SELECT tested.*, coalesce(p_value <= cutoff, false) AS is_flagged FROM tested, cut),
week_days AS (
  SELECT store_nbr AS store_key, date_trunc('week', date)::DATE AS week_start, count(*) AS item_days
  FROM scored WHERE nth > 28 AND full_day AND date >= DATE '1998-01-01' GROUP BY ALL),
week_hits AS (
  SELECT f.store_nbr AS store_key, date_trunc('week', t.date)::DATE AS week_start, count(*) AS flagged_days
  FROM flagged f JOIN trade t ON t.store_nbr = f.store_nbr AND t.full_day AND t.date BETWEEN f.start_date AND f.end_date
  WHERE is_flagged GROUP BY ALL),
week AS (
  SELECT store_key, week_start, item_days, coalesce(flagged_days, 0) AS flagged_days
  FROM week_days LEFT JOIN week_hits USING (store_key, week_start)),
promo_rows AS (
  SELECT fs.*, CASE WHEN baseline > 0 THEN baseline END AS usual, CASE WHEN baseline > 0 THEN units END AS sold,
    day(date) = 15 OR day(date + 1) = 1 OR date IN (FROM hol) AS special,
    date - row_number() OVER (PARTITION BY store_key, item_key ORDER BY date)::INT AS island
  FROM fs WHERE on_promo),
bouts AS (
  SELECT store_key, item_key, island, min(date) AS start_date, max(date) AS end_date, count(*) AS promo_days,
    sum(sold) AS promo_units, sum(usual) AS baseline_units, max(special::INT) = 1 AS special
  FROM promo_rows GROUP BY ALL),
ev AS (
  SELECT b.*, family,
    CASE WHEN n.promos = 0 THEN n.units END AS post_units, CASE WHEN n.promos = 0 THEN n.expected END AS post_expected
  FROM bouts b JOIN item USING (item_key)
  JOIN (SELECT b.store_key, b.item_key, b.island, count(*) FILTER (f.on_promo) AS promos,
          sum(f.units) FILTER (f.post_promo AND f.baseline > 0) AS units, sum(f.baseline) FILTER (f.post_promo AND f.baseline > 0) AS expected
        FROM bouts b LEFT JOIN fs f ON f.store_key = b.store_key AND f.item_key = b.item_key
          AND f.date > b.end_date AND f.date <= b.end_date + 7
        GROUP BY ALL) n USING (store_key, item_key, island)),
events_done AS (
  SELECT *, CASE WHEN baseline_units <> 0 THEN (promo_units - baseline_units) / baseline_units END AS uplift,
    CASE WHEN post_expected <> 0 THEN (post_units - post_expected) / post_expected END AS post_dip,
    CASE WHEN baseline_units + post_expected <> 0 THEN (promo_units + post_units) / (baseline_units + post_expected) - 1 END AS net_lift
  FROM ev)"""


def base(grain: str) -> str:
    return ",".join([LINES[grain], STORES[grain], ITEMS[grain], SHARED])


def query(grain: str, body: str, extra: str = "") -> str:
    """A full statement: the grain's tables, own expressions in ``extra``, then the select."""
    own = f",\n{extra}" if extra else ""
    return f"WITH {base(grain)}{own}\n{body}"
