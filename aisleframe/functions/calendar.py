"""Calendar cells: which dates each cell of a report looks at.

A *cell frame* has one row per (cell, date): the cell's columns (year, month, weekday, a show-as label ...) plus
``date``. Time calculations turn one cell frame into another; a measure then joins its fact to the frame once.
Cell frames are bounded by the calendar table, never by the facts.
"""

from __future__ import annotations

from calendar import monthrange
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def months_before(day: date, months: int) -> date:
    """The same day some months earlier, clipped to the month's length."""
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    return date(year, month + 1, min(day.day, monthrange(year, month + 1)[1]))


def month_end(day: date) -> date:
    return day.replace(day=monthrange(day.year, day.month)[1])


def to_date(cells: DataFrame, cell_cols: list[str], dates: DataFrame, trunc_to: str) -> DataFrame:
    """Month-to-date ('MM') or year-to-date ('YEAR'): the period's start up to each cell's last date."""
    last = cells.groupBy(*cell_cols).agg(F.max("date").alias("last"))
    grown = last.select(
        *cell_cols, F.explode(F.sequence(F.trunc("last", trunc_to), F.col("last"))).alias("date"))
    return _on_calendar(grown, dates)


def prior_year(cells: DataFrame, cell_cols: list[str], dates: DataFrame, data_end: date) -> DataFrame:
    """The same dates one year earlier, never past the last data date minus a year.

    A cell that holds the last two calendar days of a month takes the earlier month to its end, so February
    of the year after a leap year is compared with all 29 days.
    """
    cap = months_before(data_end, 12)
    shifted = cells.select(*cell_cols, F.add_months("date", -12).alias("date"))
    month_ends = dates.groupBy(F.trunc("date", "MM").alias("_month")).agg(F.max("date").alias("_month_end"))
    tails = (
        cells.join(month_ends, F.trunc(cells["date"], "MM") == F.col("_month"))
        .groupBy(*cell_cols, "_month_end")
        .agg(F.count_if(F.col("date") >= F.date_sub("_month_end", 1)).alias("_last_two"))
        .filter(F.col("_last_two") == 2)
        .withColumn("_from", F.add_months("_month_end", -12))
        .select(*cell_cols, F.explode(F.sequence("_from", F.last_day("_from"))).alias("date"))
    )
    # a date can be reached twice (29 and 28 February both shift to the 28th)
    both = shifted.unionByName(tails).filter(F.col("date") <= F.lit(cap)).distinct()
    return _on_calendar(both, dates)


def prior_year_ends(ends: DataFrame, dates: DataFrame, data_end: date) -> DataFrame:
    """The last days ``hi`` of cells that run from the start of a month or year, moved as ``prior_year`` moves their dates."""
    cap = months_before(data_end, 12)
    months = dates.groupBy(F.trunc("date", "MM").alias("_month")).agg(F.max("date").alias("_month_end"))
    shifted = F.add_months("hi", -12)
    # a run that ends with its month holds the last two days of it
    moved = F.least(F.when(F.col("hi") == F.col("_month_end"), F.last_day(shifted)).otherwise(shifted), F.lit(cap))
    others = [c for c in ends.columns if c != "hi"]
    on_month = ends.join(months, F.trunc("hi", "MM") == F.col("_month"))
    found = on_month.select(*others, moved.alias("hi"))
    return found.join(dates.select(F.col("date").alias("hi")), "hi", "left_semi").select(*ends.columns)


def last_days(cells: DataFrame, cell_cols: list[str], dates: DataFrame, days: int) -> DataFrame:
    """The window of ``days`` days that ends at each cell's last date."""
    last = cells.groupBy(*cell_cols).agg(F.max("date").alias("last"))
    grown = last.select(
        *cell_cols, F.explode(F.sequence(F.date_sub("last", days - 1), F.col("last"))).alias("date"))
    return _on_calendar(grown, dates)


def _on_calendar(cells: DataFrame, dates: DataFrame) -> DataFrame:
    return cells.join(dates.select("date"), "date", "left_semi").select(*cells.columns)
