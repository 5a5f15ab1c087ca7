"""Time calculations: each turns the date cells of a report into other date cells, for any measure."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import functions as F

from aisleframe.functions import calendar
from aisleframe.plans.star import Cells, Star

ACTUAL, MTD, YTD, PY, PY_YTD, YOY_DELTA, YOY_PCT = (
    "Actual", "MTD", "YTD", "PY", "PY YTD", "YoY Δ", "YoY %")
ITEMS = (ACTUAL, MTD, YTD, PY, PY_YTD, YOY_DELTA, YOY_PCT)
PERIODS = {"MM": 31, "YEAR": 366}


def to_date(star: Star, cells: Cells, unit: str) -> Cells:
    frame = calendar.to_date(cells.frame, cells.columns, star.calendar, unit)
    finest = 1 if not cells.names else PERIODS[unit]
    span = cells.span and (cells.span[0].replace(day=1, **({"month": 1} if unit == "YEAR" else {})), cells.span[1])
    ends = cells.frame.groupBy(*cells.columns).agg(F.max("date").alias("hi"))
    return replace(cells, frame=frame, rows=cells.rows * finest, per_date=cells.per_date * finest, span=span, runs=((unit, ends),))


def prior_year(star: Star, cells: Cells) -> Cells:
    frame = calendar.prior_year(cells.frame, cells.columns, star.calendar, star.data_end)
    # 28 February takes the 29th along
    span = cells.span and (
        calendar.months_before(cells.span[0], 12), calendar.month_end(calendar.months_before(cells.span[1], 12)))
    runs = tuple((unit, calendar.prior_year_ends(ends, star.calendar, star.data_end)) for unit, ends in cells.runs)
    return replace(cells, frame=frame, rows=cells.rows + cells.rows // 28 + 31, span=span, runs=runs)


def last_days(star: Star, cells: Cells, days: int) -> Cells:
    frame = calendar.last_days(cells.frame, cells.columns, star.calendar, days)
    span = cells.span and (cells.span[0] - timedelta(days=days - 1), cells.span[1])
    return replace(cells, frame=frame, rows=cells.rows * days, per_date=cells.per_date * days, span=span, runs=(), plain=None)


def joint_span(*cells: Cells):
    spans = [c.span for c in cells]
    return None if None in spans else (min(s[0] for s in spans), max(s[1] for s in spans))


def apply(star: Star, cells: Cells, item: str) -> Cells:
    """One time calculation that only moves dates."""
    if item == ACTUAL:
        return cells
    if item == MTD:
        return to_date(star, cells, "MM")
    if item == YTD:
        return to_date(star, cells, "YEAR")
    if item == PY:
        return prior_year(star, cells)
    if item == PY_YTD:
        return prior_year(star, to_date(star, cells, "YEAR"))
    raise ValueError(f"{item!r} compares two periods; evaluate it through a report")


def side_by_side(star: Star, cells: Cells, items: list[str]) -> Cells:
    """Several calculations as one set of cells with a show-as column: the fact is read once for all of them."""
    moved = [apply(star, cells, item) for item in items]
    labels = [F.lit(item).alias("c_show_as") for item in items]
    frames = [m.frame.select("date", *cells.columns, label) for m, label in zip(moved, labels)]
    plain = [frame for frame, m in zip(frames, moved) if not m.runs]
    runs = tuple((unit, ends.select(*cells.columns, label, "hi")) for m, label in zip(moved, labels) for unit, ends in m.runs)
    return Cells(
        reduce(lambda a, b: a.unionByName(b), frames), (*cells.names, "show_as"),
        sum(m.rows for m in moved), sum(m.per_date for m in moved), joint_span(*moved), runs,
        reduce(lambda a, b: a.unionByName(b), plain) if plain and runs else None)
