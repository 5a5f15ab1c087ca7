"""The measures: business figures evaluated for any grouping, selection and set of date cells.

A measure is an expression over *parts*. A part is an aggregate that one block computes; a block reads its
fact once for all parts a report asks for. Totals are the same evaluation with a coarser grouping, never a sum
of rows, because ratios, medians and like-for-like figures do not add up.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aisleframe.functions.calendar import months_before
from aisleframe.functions.columns import all_blank, growth, is_true, join_null_safe, key_date, ratio, stitch
from aisleframe.functions.ranks import exact_median, fixed4
from aisleframe.plans import timecalc
from aisleframe.plans.star import DATE_COLS, ITEM_COLS, STORE_COLS, AccessDenied, Cells, Star
from aisleframe.plans.warehouse import FACT_MONTH

C = F.col


def _value() -> Column:
    return C("units") * C("unit_price").cast("double")


def _with_baseline(flag: str, amount: str) -> Column:
    return F.sum(F.when(is_true(C(flag)) & (C("baseline_units") > 0), C(amount)))


SALES_PARTS: dict[str, Callable[[], Column]] = {
    "units": lambda: F.sum("units"),
    "value": lambda: F.sum(_value()),
    "cost": lambda: F.sum(C("units") * C("unit_cost").cast("double")),
    "fresh_value": lambda: F.sum(F.when(is_true(C("is_perishable")), _value())),
    "baseline": lambda: F.sum("baseline_units"),
    "promo_units": lambda: _with_baseline("on_promo", "units"),
    "promo_baseline": lambda: _with_baseline("on_promo", "baseline_units"),
    "post_units": lambda: _with_baseline("post_promo_window", "units"),
    "post_baseline": lambda: _with_baseline("post_promo_window", "baseline_units"),
}
DAY_PARTS: dict[str, Callable[[], Column]] = {
    "receipts": lambda: F.sum("receipts"),
    "target": lambda: F.sum("target_value"),
    "rain_sum": lambda: F.sum("rain_mm"),
    "rain_days": lambda: F.count("rain_mm"),
    "temp_sum": lambda: F.sum("temp_max_c"),
    "temp_days": lambda: F.count("temp_max_c"),
}
RISK_PARTS: dict[str, Callable[[], Column]] = {
    "lost_units": lambda: F.sum("expected_units"),
    "lost_value": lambda: F.sum(C("expected_units") * C("unit_price").cast("double")),
}
PART_COLUMNS = {
    "units": {"units"}, "value": {"units", "unit_price"}, "cost": {"units", "unit_cost"},
    "fresh_value": {"units", "unit_price", "is_perishable"}, "baseline": {"baseline_units"},
    "promo_units": {"units", "on_promo", "baseline_units"}, "promo_baseline": {"on_promo", "baseline_units"},
    "post_units": {"units", "post_promo_window", "baseline_units"},
    "post_baseline": {"post_promo_window", "baseline_units"},
    "receipts": {"receipts"}, "target": {"target_value"}, "rain_sum": {"rain_mm"}, "rain_days": {"rain_mm"},
    "temp_sum": {"temp_max_c"}, "temp_days": {"temp_max_c"},
    "lost_units": {"expected_units"}, "lost_value": {"expected_units", "unit_price"},
}
ITEM_VALUES = {"unit_price", "unit_cost", "is_perishable"}


@dataclass(frozen=True)
class Grouping:
    """The group columns split by dimension; date columns carry the cell prefix while a block works."""

    date: tuple[str, ...]
    store: tuple[str, ...]
    item: tuple[str, ...]

    @classmethod
    def of(cls, by: list[str]) -> "Grouping":
        unknown = set(by) - set(DATE_COLS) - set(STORE_COLS) - set(ITEM_COLS)
        if unknown:
            raise ValueError(f"Not a column of a dimension: {sorted(unknown)}")
        return cls(
            tuple(c for c in by if c in DATE_COLS), tuple(c for c in by if c in STORE_COLS),
            tuple(c for c in by if c in ITEM_COLS))


# --- rows of a fact under a selection ---------------------------------------------------------------------------


def _join_cells(rows: DataFrame, cells: Cells | None, key: str, *extra: str) -> DataFrame:
    return rows if cells is None else cells.joined(rows, key, *extra)


def _join_stores(rows: DataFrame, star: Star, columns: tuple[str, ...]) -> DataFrame:
    """Store columns; without a selection a fact row of an unknown store stays, under the blank store."""
    wanted = [c for c in columns if c != "store_key"]
    if star.store_filter is not None:
        return rows.join(star.stores.select("store_key", *wanted), "store_key")
    if not columns:
        return rows
    known = star.stores.select("store_key", C("store_key").alias("_store"), *wanted)
    joined = rows.join(known, "store_key", "left")
    if "store_key" in columns:
        return joined.drop("store_key").withColumnRenamed("_store", "store_key")
    return joined.drop("_store")


def _join_items(rows: DataFrame, star: Star, columns: tuple[str, ...]) -> DataFrame:
    denied = star.denied_columns & set(columns)
    if denied:
        raise AccessDenied(f"This role may not see {', '.join(sorted(denied))}")
    wanted = [c for c in dict.fromkeys(columns) if c != "item_key"]
    if star.item_filter is not None:
        return rows.join(star.items.select("item_key", *wanted), "item_key")
    if not columns:
        return rows
    return rows.join(star.items.select("item_key", *wanted), "item_key", "left")


def _fact_rows(star: Star, fact: str, group: Grouping, cells: Cells | None, columns: set[str],
               key: str = "date_key", item: bool = True, copies: dict[str, str] | None = None) -> DataFrame:
    """Fact rows with cell, store and item columns. ``copies`` keeps fact keys under another name, because
    a group column ``store_key`` is blank for unknown stores."""
    table = star.fact(fact)
    own = [c for c in table.columns if c in columns and c not in ITEM_VALUES]
    keys = dict.fromkeys([key, "store_key", *(["item_key"] if item else []), *own, *({FACT_MONTH} & set(table.columns))])
    rows = table.select(*keys, *[C(source).alias(name) for name, source in (copies or {}).items()])
    rows = _join_cells(rows, cells, key)
    rows = _join_stores(rows, star, tuple(dict.fromkeys([*group.store, *sorted(columns & {"opening_date"})])))
    if item:
        rows = _join_items(rows, star, tuple([*group.item, *sorted(columns & ITEM_VALUES)]))
    return rows


def _additive(star: Star, fact: str, library: dict, group: Grouping, cells: Cells | None, parts: list[str],
              item: bool = True) -> DataFrame:
    columns = set().union(*(PART_COLUMNS[p] for p in parts))
    dims = [*group.store, *(group.item if item else ())]
    sums = [library[p]().alias(p) for p in parts]
    if cells is not None and (cells.per_date > 1 or cells.runs):
        # a date lies in many cells: add up per date before the dates are repeated
        rows = _fact_rows(star, fact, group, None, columns, item=item)
        daily = cells.narrowed(rows, "date_key").groupBy("date_key", *dims).agg(*sums)
        if not cells.runs:
            return _per_cell(daily, cells, dims, parts)
        found = [_running(daily, unit, ends, cells.columns, dims, parts) for unit, ends in cells.runs]
        if cells.plain is not None:
            found.append(_per_cell(daily, replace(cells, frame=cells.plain, runs=(), plain=None), dims, parts))
        return reduce(DataFrame.unionByName, found)
    rows = _fact_rows(star, fact, group, cells, columns, item=item)
    return rows.groupBy(*(cells.columns if cells else []), *dims).agg(*sums)


def _per_cell(daily: DataFrame, cells: Cells, dims: list[str], parts: list[str]) -> DataFrame:
    return _join_cells(daily, cells, "date_key").groupBy(*cells.columns, *dims).agg(*[F.sum(p).alias(p) for p in parts])


def _running(daily: DataFrame, unit: str, ends: DataFrame, cell_cols: list[str], dims: list[str], parts: list[str]) -> DataFrame:
    """Sums from the start of each period up to the cells' last days, from one running total per group and period.

    A day's total holds until the group's next day; each last day takes the one that holds then. Windows see the days of one
    period, and every cell and group meets one row.
    """
    rows = daily.withColumn("_day", key_date("date_key")).withColumn("_period", F.trunc("_day", unit))
    by_day = W.partitionBy(*dims, "_period").orderBy("_day")
    so_far = by_day.rowsBetween(W.unboundedPreceding, 0)
    totals = rows.select(*dims, "_period", "_day", F.lead("_day").over(by_day).alias("_next"), *[F.sum(p).over(so_far).alias(p) for p in parts])
    # at most one last day per calendar day of the period
    stops = ends.groupBy(F.trunc("hi", unit).alias("_period")).agg(F.collect_set("hi").alias("_stops"))
    held = F.filter("_stops", lambda day: (day >= C("_day")) & (C("_next").isNull() | (day < C("_next"))))
    return totals.join(stops, "_period").select(*dims, *parts, F.explode(held).alias("hi")).join(ends, "hi").select(*cell_cols, *dims, *parts)


# --- blocks -------------------------------------------------------------------------------------------------


def sales_block(star, group, cells, parts):
    return _additive(star, "fact_sales", SALES_PARTS, group, cells, parts)


def day_block(star, group, cells, parts):
    return _additive(star, "fact_store_day", DAY_PARTS, group, cells, parts, item=False)


def risk_block(star, group, cells, parts):
    return _additive(star, "fact_stockout_risk", RISK_PARTS, group, cells, parts)


#: Groups by one of these have few pairs each: counting them is cheaper than a bitmap per group.
PAIR_LEVEL = {"store_key", "store_nbr", "store_name", "item_key", "item_nbr"}


def _as_bitmaps(star: Star, group: Grouping) -> bool:
    return "risk_pairs" in star.sources and not PAIR_LEVEL & {*group.store, *group.item}


def risk_items_states(star: Star, group: Grouping, cells: Cells | None) -> DataFrame:
    """Per group and range of pair numbers, the pairs as a bitmap of 32,768 bits: states that merge over groups and dates."""
    rows = _fact_rows(star, "fact_stockout_risk", group, None, set(), copies={"p_store": "store_key", "p_item": "item_key"})
    numbered = star.table("risk_pairs").select(C("store_key").alias("p_store"), C("item_key").alias("p_item"), "pair_no")
    dims = [*group.store, *group.item]
    rows = rows.select("date_key", *({FACT_MONTH} & set(rows.columns)), "p_store", "p_item", *[C(d).alias(f"_{d}") for d in dims])
    if cells is None or cells.per_date == 1:
        rows, days = _join_cells(rows, cells, "date_key"), cells.columns if cells else []
    else:
        rows, days = cells.narrowed(rows, "date_key"), ["date_key"]
    rows = rows.join(numbered, ["p_store", "p_item"]).select(*days, *[C(f"_{d}").alias(d) for d in dims], "pair_no")
    states = rows.groupBy(*days, *dims, F.bitmap_bucket_number("pair_no").alias("_range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("pair_no")).alias("_pairs"))
    if cells is None or cells.per_date == 1:
        return states
    return _join_cells(states, cells, "date_key").groupBy(*cells.columns, *dims, "_range").agg(F.bitmap_or_agg("_pairs").alias("_pairs"))


def _count_pairs(states: DataFrame, by: list[str]) -> DataFrame:
    return states.groupBy(*by).agg(F.sum(F.bitmap_count("_pairs")).alias("risk_items"))


def risk_items_block(star, group, cells, parts):
    dims = [*(cells.columns if cells else []), *group.store, *group.item]
    if _as_bitmaps(star, group):
        return _count_pairs(risk_items_states(star, group, cells), dims)
    rows = _fact_rows(star, "fact_stockout_risk", group, cells, set(), copies={"p_store": "store_key", "p_item": "item_key"})
    # one row per pair first: the distinct count then only counts
    return rows.groupBy(*dims, "p_store", "p_item").agg(F.lit(1).alias("one")).groupBy(*dims).agg(
        F.count(F.lit(1)).alias("risk_items"))


def last7_block(star, group, cells, parts):
    week = timecalc.last_days(star, cells if cells is not None else star.all_cells(), 7)
    return risk_block(star, group, week, ["lost_value"]).withColumnRenamed("lost_value", "lost_value_7")


def lfl_cells(star: Star, cells: Cells) -> Cells:
    """Comparable dates of each cell (now = 0) and the same dates a year before (now = 1).

    Comparable dates have a prior year in the data. ``opened_by`` is the latest opening date a store may have
    to count in the cell: twelve months before the cell's first comparable calendar date.
    """
    first = months_before(star.data_start, -12)
    now = replace(cells, frame=cells.frame.filter(C("date") >= F.lit(first)), runs=(), plain=None)
    before = timecalc.prior_year(star, now)
    both = now.frame.select("date", *cells.columns, F.lit(0).alias("shift")).unionByName(
        before.frame.select("date", *cells.columns, F.lit(1).alias("shift")))
    of_cell = W.partitionBy(*(cells.columns or [F.lit(0)]))
    start = F.min(F.when(C("shift") == 0, C("date"))).over(of_cell)
    frame = both.withColumn("opened_by", F.add_months(start, -12))
    return Cells(frame, cells.names, now.rows + before.rows, cells.per_date * 2, timecalc.joint_span(now, before))


def _lfl(star: Star, group: Grouping, cells: Cells | None, fact: str, amount: Column, needs: set[str],
         prefix: str, item: bool) -> DataFrame:
    moved = lfl_cells(star, cells if cells is not None else star.all_cells())
    # added up per day and opening date first: a date lies in many cells, and both in a year and in the next one's past
    rows = _fact_rows(star, fact, group, None, needs | {"opening_date"}, item=item)
    dims = [*group.store, *(group.item if item else ())]
    daily = moved.narrowed(rows, "date_key").groupBy("date_key", "opening_date", *dims).agg(F.sum(amount).alias("_amount"))
    # an unknown opening date counts as open all along
    kept = _join_cells(daily, moved, "date_key", "shift", "opened_by").filter(
        C("opening_date").isNull() | (C("opening_date") <= C("opened_by")))
    return kept.groupBy(*moved.columns, *dims).agg(
        F.sum(F.when(C("shift") == 0, C("_amount"))).alias(prefix),
        F.sum(F.when(C("shift") == 1, C("_amount"))).alias(f"{prefix}_py"))


def lfl_sales_block(star, group, cells, parts):
    return _lfl(star, group, cells, "fact_sales", _value(), {"units", "unit_price"}, "lfl_sales", True)


def lfl_receipts_block(star, group, cells, parts):
    return _lfl(star, group, cells, "fact_store_day", C("receipts"), {"receipts"}, "lfl_receipts", False)


def target_block(star, group, cells, parts):
    """Sales and targets over the store-months that have a target.

    Both facts are stacked and added up per cell, store and month in one shuffle; months without a target
    then drop out with their sales. Selections on items only reach the sales.
    """
    month = F.expr("date_key div 100").alias("month")
    cell_cols = cells.columns if cells else []
    dims = [*cell_cols, *group.store]
    plain = Grouping(group.date, group.store, ())

    def daily(fact, of, columns, item, amount, name):
        """Amounts of stores by month. Where a day may be in many date cells, sums per store and day; only these meet the cells."""
        if cells is None or (cells.per_date == 1 and not cells.runs):
            rows = _fact_rows(star, fact, of, cells, columns, item=item, copies={"s_key": "store_key"})
            return rows.select(*dims, *of.item, "s_key", month, amount.alias(name))
        rows = _fact_rows(star, fact, of, None, columns, item=item, copies={"s_key": "store_key"})
        rows = cells.narrowed(rows, "date_key")
        days = rows.groupBy("date_key", "s_key", *of.store, *of.item).agg(F.sum(amount).alias(name))
        return _join_cells(days, cells, "date_key").select(*dims, *of.item, "s_key", month, name)

    planned = daily("fact_store_day", plain, {"target_value"}, False, C("target_value").cast("double"), "target_value")
    sold = daily("fact_sales", group, {"units", "unit_price"}, True, _value(), "value")
    key = [*dims, "s_key", "month"]
    if not group.item:
        covered = (
            planned.unionByName(sold, allowMissingColumns=True).groupBy(*key)
            .agg(F.sum("target_value").alias("target_value"), F.sum("value").alias("value"))
            .filter(C("target_value").isNotNull())
        )
        return covered.groupBy(*dims).agg(
            F.sum("value").alias("covered_value"), F.sum("target_value").alias("covered_target"))
    covered = planned.groupBy(*key).agg(F.sum("target_value").alias("target_value")).filter(
        C("target_value").isNotNull())
    per_item = sold.groupBy(*key, *group.item).agg(F.sum("value").alias("value")).join(
        covered.select(*key), key, "left_semi")
    values = per_item.groupBy(*dims, *group.item).agg(F.sum("value").alias("covered_value"))
    whole = covered.groupBy(*dims).agg(F.sum("target_value").alias("covered_target"))
    return attach(values, whole, dims)


def run_block(star, group, cells, parts):
    rows = _fact_rows(star, "fact_stockout_run", group, cells, {"expected_lost_units", "run_days", "is_flagged"},
                      key="start_date_key").filter("is_flagged")
    # run lengths are whole days: a median buffer holds at most one count per length
    return rows.groupBy(*(cells.columns if cells else []), *group.store, *group.item).agg(
        F.count(F.lit(1)).alias("flagged_runs"), F.sum("expected_lost_units").alias("run_lost_units"),
        F.median("run_days").alias("median_run_days"))


def store_week_block(star, group, cells, parts):
    rows = _fact_rows(star, "stockout_store_week", group, cells, {"item_days", "flagged_days"},
                      key="week_start_key", item=False)
    return rows.groupBy(*(cells.columns if cells else []), *group.store).agg(
        F.sum("flagged_days").alias("flagged_days"), F.sum("item_days").alias("item_days"))


def event_count_block(star, group, cells, parts):
    rows = _fact_rows(star, "fact_promo_event", group, cells, set(), key="start_date_key")
    return rows.groupBy(*(cells.columns if cells else []), *group.store, *group.item).agg(
        F.count(F.lit(1)).alias("promo_events"))


def _event_median(star, group, cells, column, alias):
    rows = _fact_rows(star, "fact_promo_event", group, cells, {column}, key="start_date_key")
    dims = [*(cells.columns if cells else []), *group.store, *group.item]
    return exact_median(rows.select(*dims, fixed4(C(column)).alias("_v")), dims, "_v", alias)


def uplift_median_block(star, group, cells, parts):
    return _event_median(star, group, cells, "uplift", "median_uplift")


def net_median_block(star, group, cells, parts):
    return _event_median(star, group, cells, "net_lift", "median_net_lift")


def payback_block(star, group, cells, parts):
    """Family summaries stand alone: selections do not reach them, and only a grouping by family splits them."""
    by = [c for c in group.item if c == "family"]
    columns = {"family_net": "net_median", "family_net_lo": "net_lo", "family_net_hi": "net_hi",
               "family_uplift": "uplift_median", "family_dip": "dip_median"}
    rows = star.fact("promo_family_summary")
    paying = F.count_if(C("net_lo") > 0)
    return rows.groupBy(*by).agg(
        *[F.max(source).alias(name) for name, source in columns.items()],
        F.when(paying > 0, paying).alias("paying_back"))


def test_block(star, group, cells, parts):
    return star.fact("stockout_bh_summary").agg(
        F.sum("tested_runs").alias("tested_runs"), F.sum("flagged_runs").alias("nb_flagged"),
        F.sum("poisson_flagged_runs").alias("poisson_flagged"), F.sum("max_chance_flags").alias("chance_flags"))


BLOCKS = {
    "sales": sales_block, "day": day_block, "risk": risk_block, "risk_items": risk_items_block,
    "last7": last7_block, "lfl_sales": lfl_sales_block, "lfl_receipts": lfl_receipts_block, "target": target_block,
    "run": run_block, "store_week": store_week_block, "event_count": event_count_block,
    "uplift_median": uplift_median_block, "net_median": net_median_block, "payback": payback_block, "test": test_block,
}
# blocks whose fact has no item: an item grouping repeats their figures on every item row
WITHOUT_ITEM = {"day", "lfl_receipts", "store_week", "test"}


# --- measures -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Measure:
    number: int
    name: str
    needs: dict[str, tuple[str, ...]]
    value: Callable[[], Column]


def _plain(part: str) -> Callable[[], Column]:
    return lambda: C(part)


def _lfl_growth() -> Column:
    return growth(C("lfl_sales"), C("lfl_sales_py"))


def _footfall_growth() -> Column:
    return growth(C("lfl_receipts"), C("lfl_receipts_py"))


def _basket_growth() -> Column:
    return F.try_divide(_lfl_growth() - _footfall_growth(), F.lit(1.0) + _footfall_growth())


LFL_S, LFL_R = {"lfl_sales": ("lfl_sales",)}, {"lfl_receipts": ("lfl_receipts",)}

_ALL = [
    Measure(1, "units", {"sales": ("units",)}, _plain("units")),
    Measure(2, "sales_value", {"sales": ("value",)}, _plain("value")),
    Measure(3, "cost_value", {"sales": ("cost",)}, _plain("cost")),
    Measure(4, "gross_margin_pct", {"sales": ("value", "cost")}, lambda: growth_of_whole("cost", "value")),
    Measure(5, "fresh_share_pct", {"sales": ("fresh_value", "value")}, lambda: part_of("fresh_value", "value")),
    Measure(6, "baseline_units", {"sales": ("baseline",)}, _plain("baseline")),
    Measure(7, "promo_uplift_pct", {"sales": ("promo_units", "promo_baseline")},
            lambda: growth(C("promo_units"), C("promo_baseline"))),
    Measure(8, "promo_extra_units", {"sales": ("promo_units", "promo_baseline")},
            lambda: C("promo_units") - C("promo_baseline")),
    Measure(9, "post_promo_dip_pct", {"sales": ("post_units", "post_baseline")},
            lambda: growth(C("post_units"), C("post_baseline"))),
    Measure(10, "lfl_sales", LFL_S, _plain("lfl_sales")),
    Measure(11, "lfl_sales_py", LFL_S, _plain("lfl_sales_py")),
    Measure(12, "lfl_growth_pct", LFL_S, _lfl_growth),
    Measure(13, "receipts", {"day": ("receipts",)}, _plain("receipts")),
    Measure(14, "basket_value", {"sales": ("value",), "day": ("receipts",)}, lambda: part_of("value", "receipts")),
    Measure(15, "target", {"day": ("target",)}, lambda: C("target").cast("double")),
    Measure(16, "sales_vs_target_pct", {"target": ("covered",)},
            lambda: growth(C("covered_value"), C("covered_target"))),
    Measure(17, "lfl_receipts", LFL_R, _plain("lfl_receipts")),
    Measure(18, "lfl_receipts_py", LFL_R, _plain("lfl_receipts_py")),
    Measure(19, "lfl_footfall_growth_pct", LFL_R, _footfall_growth),
    Measure(20, "lfl_basket_growth_pct", {**LFL_S, **LFL_R}, _basket_growth),
    Measure(21, "avg_rain", {"day": ("rain_sum", "rain_days")}, lambda: F.try_divide("rain_sum", "rain_days")),
    Measure(22, "avg_max_temp", {"day": ("temp_sum", "temp_days")}, lambda: F.try_divide("temp_sum", "temp_days")),
    Measure(23, "stockout_risk_items", {"risk_items": ("risk_items",)}, _plain("risk_items")),
    Measure(24, "est_lost_units", {"risk": ("lost_units",)}, _plain("lost_units")),
    Measure(25, "est_lost_sales", {"risk": ("lost_value",)}, _plain("lost_value")),
    Measure(26, "est_lost_sales_7d", {"last7": ("lost_value_7",)}, _plain("lost_value_7")),
    Measure(27, "flagged_runs", {"run": ("flagged_runs",)}, _plain("flagged_runs")),
    Measure(28, "lost_units_runs", {"run": ("run_lost_units",)}, _plain("run_lost_units")),
    Measure(29, "median_run_days", {"run": ("median_run_days",)}, _plain("median_run_days")),
    Measure(30, "stockout_rate_pct", {"store_week": ("flagged_days", "item_days")},
            lambda: part_of("flagged_days", "item_days")),
    Measure(31, "promo_events", {"event_count": ("promo_events",)}, _plain("promo_events")),
    Measure(32, "median_uplift_pct", {"uplift_median": ("median_uplift",)}, _plain("median_uplift")),
    Measure(33, "median_net_lift_pct", {"net_median": ("median_net_lift",)}, _plain("median_net_lift")),
    Measure(34, "family_net_lift_pct", {"payback": ("family_net",)}, _plain("family_net")),
    Measure(35, "family_net_lift_low_pct", {"payback": ("family_net_lo",)}, _plain("family_net_lo")),
    Measure(36, "family_net_lift_high_pct", {"payback": ("family_net_hi",)}, _plain("family_net_hi")),
    Measure(37, "family_uplift_pct", {"payback": ("family_uplift",)}, _plain("family_uplift")),
    Measure(38, "family_dip_pct", {"payback": ("family_dip",)}, _plain("family_dip")),
    Measure(39, "families_paying_back", {"payback": ("paying_back",)}, _plain("paying_back")),
    Measure(40, "nb_flag_rate_pct", {"test": ("nb_flagged", "tested_runs")}, lambda: part_of("nb_flagged", "tested_runs")),
    Measure(41, "poisson_flag_rate_pct", {"test": ("poisson_flagged", "tested_runs")},
            lambda: part_of("poisson_flagged", "tested_runs")),
    Measure(42, "max_chance_flags", {"test": ("chance_flags",)}, _plain("chance_flags")),
]
MEASURES: dict[str, Measure] = {m.name: m for m in _ALL}


def part_of(part: str, whole: str) -> Column:
    """part / whole; blank if either is missing."""
    return F.try_divide(C(part).cast("double"), C(whole).cast("double"))


def growth_of_whole(cost: str, whole: str) -> Column:
    return ratio(C(whole) - F.coalesce(C(cost), F.lit(0.0)), C(whole))


def attach(rows: DataFrame, figures: DataFrame, on: list[str]) -> DataFrame:
    """Put coarser figures next to every finer row; a NULL in a group column meets itself."""
    values = [c for c in figures.columns if c not in on]
    if not on:
        return rows.select("*", *[figures.select(v).scalar().alias(v) for v in values])
    return join_null_safe(rows, figures, on, "left")


def _parts(star: Star, group: Grouping, cells: Cells | None, measures: list[str]) -> DataFrame:
    """The parts the measures need, side by side for each group."""
    return _parts_of(star, group, cells, [MEASURES[name].needs for name in measures])


def _parts_of(star: Star, group: Grouping, cells: Cells | None, wanted: list[dict[str, tuple[str, ...]]]) -> DataFrame:
    needs: dict[str, list[str]] = {}
    for of_measure in wanted:
        for block, parts in of_measure.items():
            have = needs.setdefault(block, [])
            have.extend(p for p in parts if p not in have)
    cell_cols = cells.columns if cells else []
    full = [*cell_cols, *group.store, *group.item]
    coarse = [*cell_cols, *group.store]
    fine_parts, coarse_parts = [], []
    for block, parts in needs.items():
        frame = BLOCKS[block](star, group, cells, parts)
        (coarse_parts if group.item and block in WITHOUT_ITEM else fine_parts).append(frame)
    if fine_parts:
        result = stitch(fine_parts, full)
        for frame in coarse_parts:
            result = attach(result, frame, coarse)
    elif group.item:
        raise ValueError("None of these measures has items; add one that has, or group without items")
    else:
        result = stitch(coarse_parts, coarse)
    return result


def evaluate(star: Star, by: list[str], measures: list[str], cells: Cells | None = None) -> DataFrame:
    """The measures for each group: ``by`` columns + one column per measure, rows with all blank left out.

    ``cells`` replaces the date cells that follow from ``by`` and the selection, as a time calculation does.
    """
    group = Grouping.of(by)
    if cells is None:
        cells = star.cells(by)
    result = _parts(star, group, cells, measures)
    return _finished(result, measures, cells, group, by)


def _finished(result: DataFrame, measures: list[str], cells: Cells | None, group: Grouping, by: list[str],
              *more: str) -> DataFrame:
    renamed = [C(f"c_{n}").alias(n) for n in cells.names] if cells else []
    values = [MEASURES[m].value().alias(m) for m in measures]
    out = result.select(*renamed, *group.store, *group.item, *values, *more)
    return out.filter(~all_blank(measures)) if by or renamed else out


# blocks whose parts are sums over fact rows: the parts of a coarser group are the sums of the finer ones
ADDITIVE = {"sales", "day", "risk", "lfl_sales", "lfl_receipts", "target", "store_week", "event_count"}


def evaluate_with_total(star: Star, by: list[str], measures: list[str]) -> DataFrame:
    """Group rows and the total row (``is_total``), the measures evaluated at each.

    Where every part is a sum and all rows look at the same dates, the total's parts are added up from the group
    rows and only the measures' expressions are evaluated again; otherwise the total is evaluated on its own.
    """
    group = Grouping.of(by)
    blocks = {block for name in measures for block in MEASURES[name].needs}
    if group.date or group.item or not blocks <= ADDITIVE:
        rows = evaluate(star, by, measures).withColumn("is_total", F.lit(False))
        total = evaluate(star, [], measures).withColumn("is_total", F.lit(True))
        return rows.unionByName(total, allowMissingColumns=True)
    cells = star.cells(by)
    result = _parts(star, group, cells, measures)
    figures = [c for c in result.columns if c not in by]
    levels = result.groupingSets([[C(c) for c in by], []], *by).agg(
        *[F.sum(c).alias(c) for c in figures], F.grouping_id().alias("level"))
    return _finished(levels.withColumn("is_total", C("level") > 0), measures, cells, group, by, "is_total")


#: Blocks whose parts also add up over dates; like-for-like and target parts depend on the whole date cell.
OVER_DATES = {"sales", "day", "risk", "store_week", "event_count"}


def evaluate_levels(star: Star, levels: list[str], measures: list[str]) -> DataFrame:
    """The measures at each level of a hierarchy, with its ``depth``: by the first column, by the first two, and so on.

    Where all parts add up or merge, each fact is read once, at the finest level; the coarser levels merge its states as grouping
    sets and only the measures' expressions are evaluated again. Other measures are evaluated level by level.
    """
    group = Grouping.of(levels)
    blocks = {block for name in measures for block in MEASURES[name].needs}
    summed = OVER_DATES if group.date else ADDITIVE
    mergeable = summed | ({"risk_items"} if _as_bitmaps(star, group) else set())
    if not blocks <= mergeable or (group.item and blocks & WITHOUT_ITEM):
        parts = [evaluate(star, levels[:depth], measures).withColumn("depth", F.lit(depth)) for depth in range(1, len(levels) + 1)]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cells = star.cells(levels)
    keys = [f"c_{c}" if c in group.date else c for c in levels]
    sets = [[C(k) for k in keys[:depth]] for depth in range(1, len(levels) + 1)]
    rolled = []
    adding = {m: {b: p for b, p in MEASURES[m].needs.items() if b in summed} for m in measures}
    if any(adding.values()):
        finest = _parts_of(star, group, cells, list(adding.values()))
        figures = [c for c in finest.columns if c not in keys]
        rolled.append(finest.groupingSets(sets, *[C(k) for k in keys]).agg(
            *[F.sum(c).alias(c) for c in figures], F.grouping_id().alias("_above")))
    if "risk_items" in blocks:
        states = risk_items_states(star, group, cells)
        merged = states.groupingSets([[*s, C("_range")] for s in sets], *[C(k) for k in keys], C("_range")).agg(
            F.bitmap_or_agg("_pairs").alias("_pairs"), F.expr("grouping_id() div 2").alias("_above"))
        rolled.append(_count_pairs(merged, [*keys, "_above"]))
    result = stitch(rolled, [*keys, "_above"]).withColumn("depth", F.lit(len(levels)) - F.bit_count("_above"))
    return _finished(result, measures, cells, group, levels, "depth")
