"""The report queries: grouping, measures, selection and order of every data visual."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisleframe.functions.columns import all_blank
from aisleframe.plans import timecalc
from aisleframe.plans.measures import evaluate, evaluate_levels, evaluate_with_total
from aisleframe.plans.star import Star
from aisleframe.session import written

NETWORK = ["sales_value", "sales_vs_target_pct", "lfl_growth_pct", "lfl_footfall_growth_pct", "lfl_basket_growth_pct"]
MONTHS = ["year", "month_num"]
DAYS = ["year", "month_num", "date"]


def show_as(star: Star, by: list[str], measures: list[str], items: list[str]) -> DataFrame:
    """The measures under several time calculations, one row per group and calculation.

    Moved-date calculations share one pass over the fact; the year-on-year ones compare two of its rows.
    """
    compare = [i for i in items if i in (timecalc.YOY_DELTA, timecalc.YOY_PCT)]
    moved = [i for i in items if i not in compare]
    base = list(dict.fromkeys([*moved, *([timecalc.ACTUAL, timecalc.PY] if compare else [])]))
    cells = timecalc.side_by_side(star, star.cells(by) or star.all_cells(), base)
    rows = evaluate(star, [*by, "show_as"], measures, cells)
    if not compare:
        return rows
    rows_by = [c for c in rows.columns if c not in measures and c != "show_as"]
    tags = {item: f"i{i}" for i, item in enumerate(base)}
    wide = rows.groupBy(*rows_by).agg(*[
        F.max(F.when(F.col("show_as") == item, F.col(m))).alias(f"{tag}_{m}") for m in measures for item, tag in tags.items()])

    def line(item: str) -> Column:
        values = [
            _compare(f"{tags[timecalc.ACTUAL]}_{m}", f"{tags[timecalc.PY]}_{m}", item) if item in compare
            else F.col(f"{tags[item]}_{m}").cast("double") for m in measures]
        return F.struct(F.lit(item).alias("show_as"), *[v.alias(m) for v, m in zip(values, measures)])

    return wide.select(*rows_by, F.inline(F.array(*[line(item) for item in items]))).filter(~all_blank(measures))


def _compare(now_name: str, before_name: str, item: str) -> Column:
    now, before = F.col(now_name).cast("double"), F.col(before_name).cast("double")
    if item == timecalc.YOY_DELTA:
        return now - before
    # a missing prior period leaves the quotient blank; a missing current one too
    return F.try_divide(now - before, before)


def top_rows(df: DataFrame, measure: str, n: int) -> DataFrame:
    """The n largest by a measure; rows tied with the last one stay, as the report language keeps them.

    The n-th value comes from a per-task top-n and a merge, so the ranking never gathers all rows in one task. The rows
    are written first: computed twice, sums of doubles could differ in the last bit and lose the n-th row.
    """
    df = written(df)
    nth = df.select(measure).filter(F.col(measure).isNotNull()).orderBy(F.desc(measure)).limit(n).agg(
        F.min(measure).alias("floor")).scalar()
    return df.filter(F.col(measure) >= nth)


def fresh(star: Star) -> Star:
    return star.where(items=F.col("is_perishable"))


def sliced(star: Star, years: list[int] | None = None, months: list[int] | None = None, regions: list[str] | None = None,
           families: list[str] | None = None, store_types: list[str] | None = None,
           stores: list[int] | None = None, day: date | None = None) -> Star:
    """Slicers: each one a list of members, all of them must hold."""
    if years:
        star = star.where(dates=F.col("year").isin(*years))
    if months:
        star = star.where(dates=F.col("month_num").isin(*months))
    if day:
        star = star.where(dates=F.col("date") == F.lit(day))
    if regions:
        star = star.where(stores=F.col("region").isin(*regions))
    if store_types:
        star = star.where(stores=F.col("store_type").isin(*store_types))
    if stores:
        star = star.where(stores=F.col("store_key").isin(*stores))
    if families:
        star = star.where(items=F.col("family").isin(*families))
    return star


# --- one function per visual ----------------------------------------------------------------------------------


def network_kpis(star: Star) -> DataFrame:
    return evaluate(star, [], NETWORK)


def region_table(star: Star) -> DataFrame:
    return evaluate_with_total(star, ["region"], NETWORK).orderBy("is_total", F.desc("sales_value"))


def region_vs_target(star: Star) -> DataFrame:
    return evaluate(star, ["region"], ["sales_vs_target_pct"]).orderBy(F.desc("sales_vs_target_pct"))


def sales_trend(star: Star, by: list[str] = MONTHS) -> DataFrame:
    return show_as(star, by, ["sales_value"], [timecalc.ACTUAL, timecalc.PY])


def store_lfl_ranking(star: Star) -> DataFrame:
    return evaluate(star, ["store_name"], ["lfl_growth_pct"]).orderBy(F.desc("lfl_growth_pct"))


def footfall_vs_basket(star: Star) -> DataFrame:
    measures = ["lfl_growth_pct", "lfl_footfall_growth_pct", "lfl_basket_growth_pct"]
    return evaluate(star, ["store_name"], measures).orderBy("lfl_growth_pct")


def weekday_sales(star: Star) -> DataFrame:
    return show_as(star, ["weekday_num", "weekday_name"], ["sales_value"], [timecalc.ACTUAL, timecalc.PY])


def rain_vs_receipts(star: Star) -> DataFrame:
    return evaluate(star, ["date"], ["avg_rain", "receipts"])


def store_detail_kpis(star: Star, by: list[str] = ["store_name"]) -> DataFrame:
    return evaluate(star, by, ["sales_value", "sales_vs_target_pct", "receipts", "basket_value"])


def daily_vs_target(star: Star) -> DataFrame:
    return evaluate(star, DAYS, ["sales_value", "target"])


def fresh_at_risk(star: Star) -> DataFrame:
    return evaluate(fresh(star), ["item_nbr", "family"], ["est_lost_units", "est_lost_sales"]).orderBy(F.desc("est_lost_sales"))


def fresh_kpis(star: Star) -> DataFrame:
    return evaluate(star, [], ["fresh_share_pct", "stockout_risk_items", "est_lost_units", "est_lost_sales"])


def items_at_risk(star: Star, n: int = 50) -> DataFrame:
    rows = evaluate(fresh(star), ["store_name", "item_nbr", "family"], ["est_lost_units", "est_lost_sales"])
    return top_rows(rows, "est_lost_sales", n)


def lost_sales_by_family(star: Star) -> DataFrame:
    return evaluate(fresh(star), ["family"], ["est_lost_sales"]).orderBy(F.desc("est_lost_sales"))


def lost_sales_trend(star: Star) -> DataFrame:
    return show_as(fresh(star), DAYS, ["est_lost_sales"], [timecalc.ACTUAL, timecalc.PY])


def promotion_kpis(star: Star) -> DataFrame:
    return evaluate(star, [], ["promo_uplift_pct", "post_promo_dip_pct", "units", "gross_margin_pct"])


def promotions_by_family(star: Star) -> DataFrame:
    return evaluate(star, ["family"], ["promo_uplift_pct", "post_promo_dip_pct", "gross_margin_pct"])


def uplift_by_family(star: Star) -> DataFrame:
    return evaluate(star, ["family"], ["promo_extra_units", "promo_uplift_pct"]).orderBy(F.desc("promo_extra_units"))


def dip_by_family(star: Star) -> DataFrame:
    return evaluate(star, ["family"], ["post_promo_dip_pct"]).orderBy("post_promo_dip_pct")


def lift_vs_shift(star: Star) -> DataFrame:
    return evaluate(star, ["family"], ["promo_uplift_pct", "post_promo_dip_pct"])


def margin_by_family(star: Star) -> DataFrame:
    return evaluate(star, ["family"], ["gross_margin_pct"]).orderBy(F.desc("gross_margin_pct"))


def store_today(star: Star, day: date) -> DataFrame:
    return evaluate(sliced(star, day=day), ["store_name"], ["sales_value", "target", "sales_vs_target_pct"])


def store_today_yoy(star: Star, day: date) -> DataFrame:
    return show_as(
        sliced(star, day=day), ["store_name"], ["receipts", "basket_value"], [timecalc.ACTUAL, timecalc.YOY_PCT])


def fresh_last_7_days(star: Star, until: date) -> DataFrame:
    chosen = fresh(star).where(dates=F.col("date") <= F.lit(until))
    return evaluate(chosen, ["item_nbr", "family"], ["est_lost_sales_7d"]).orderBy(F.desc("est_lost_sales_7d"))


def payback_by_family(star: Star) -> DataFrame:
    measures = ["family_net_lift_pct", "family_net_lift_low_pct", "family_net_lift_high_pct", "family_uplift_pct",
                "family_dip_pct"]
    return evaluate(star, ["family"], measures).orderBy(F.desc("family_net_lift_pct"))


def stockout_rate_by_store(star: Star) -> DataFrame:
    rows = evaluate(star, ["store_name"], ["stockout_rate_pct", "flagged_runs", "median_run_days"])
    return rows.filter(F.col("store_name").isNotNull()).orderBy(F.desc("stockout_rate_pct"))


def stockout_rate_trend(star: Star) -> DataFrame:
    return evaluate(star, DAYS, ["stockout_rate_pct"])


def deep_dive_kpis(star: Star) -> DataFrame:
    return evaluate(star, [], ["stockout_rate_pct", "lost_units_runs", "median_net_lift_pct", "families_paying_back"])


def totals_by_year_region(star: Star) -> DataFrame:
    return evaluate(star, ["year", "region"], ["units", "sales_value"])


def drill(star: Star, measures: list[str], levels: list[str] = ("year", "quarter", "month_num", "date")) -> DataFrame:
    """Every level of the calendar hierarchy, with the depth as a column."""
    return evaluate_levels(star, list(levels), measures)
