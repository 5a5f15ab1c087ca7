"""The star schema under a selection: what a report sees."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisleframe.functions.columns import date_key
from aisleframe.operators import conform
from aisleframe.plans.warehouse import FACT_MONTH

DATE_COLS = (
    "date", "year", "quarter", "month_num", "month_name", "month_key", "year_month", "iso_week", "weekday_num",
    "weekday_name", "is_weekend", "is_national_holiday", "show_as")
STORE_COLS = ("store_key", "store_nbr", "store_name", "city", "state", "region", "store_type", "cluster")
ITEM_COLS = ("item_key", "item_nbr", "family", "class", "is_perishable")


class AccessDenied(PermissionError):
    """The role may not see a column that a measure needs."""


@dataclass(frozen=True)
class Cells:
    """Which dates each date cell of a report looks at: one row per cell and date.

    ``names`` are the cell's columns, kept with the prefix ``c_`` in ``frame`` so that a cell named by date and
    the dates it looks at stay apart. ``per_date`` is an upper bound of the cells one date can belong to, and
    ``span`` holds the first and last date looked at where a selection narrows them.

    Cells that each run from the start of a month or year up to a day are also given by that last day alone: ``runs`` has
    (unit, one row per cell with its last day ``hi``), ``plain`` the dates of all other cells. Sums then need one running
    total per cell instead of every date of it.
    """

    frame: DataFrame
    names: tuple[str, ...]
    rows: int
    per_date: int = 1
    span: tuple[date, date] | None = None
    runs: tuple[tuple[str, DataFrame], ...] = ()
    plain: DataFrame | None = None

    @property
    def columns(self) -> list[str]:
        return [f"c_{n}" for n in self.names]

    def keyed(self, *extra: str) -> DataFrame:
        """The frame for a join on date_key; Spark decides by its size how to join."""
        return self.frame.select(*self.columns, date_key("date").alias("date_key"), *extra)

    def joined(self, rows: DataFrame, key: str, *extra: str) -> DataFrame:
        """Fact rows with the cells of their day. Under a selection a fact in months is also joined by month, so that the
        months of the selected dates prune its folders when the query runs."""
        frame, on = self.keyed(*extra).withColumnRenamed("date_key", key), [key]
        if self.span is not None and FACT_MONTH in rows.columns:
            frame, on = frame.withColumn(FACT_MONTH, F.expr(f"cast({key} div 100 as int)")), [key, FACT_MONTH]
        return self.narrowed(rows, key).join(frame, on)

    def narrowed(self, rows: DataFrame, key: str) -> DataFrame:
        """Fact rows inside the span, as constant ranges that the scan uses to skip months and row groups."""
        if self.span is None:
            return rows
        lo, hi = (int(day.strftime("%Y%m%d")) for day in self.span)
        if FACT_MONTH in rows.columns:
            rows = rows.filter(F.col(FACT_MONTH).between(lo // 100, hi // 100))
        return rows.filter(F.col(key).between(lo, hi))


@dataclass(frozen=True)
class Star:
    """Conformed tables plus the selection on the three dimensions.

    ``sources`` maps a table's name to what opens it, so a report only builds and reads the tables it uses.
    """

    sources: dict[str, Callable[[], DataFrame]]
    data_start: date
    data_end: date
    date_filter: Column | None = None
    store_filter: Column | None = None
    item_filter: Column | None = None
    denied_tables: frozenset[str] = field(default_factory=frozenset)
    denied_columns: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def of(cls, sources: dict[str, Callable[[], DataFrame]]) -> "Star":
        named = {
            **sources,
            "dim_store": lambda: conform.store_label(sources["dim_store"]()),
            "dim_date": lambda: conform.month_label(sources["dim_date"]()),
        }
        ends = sources["dim_date"]().agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
        return cls(named, ends["lo"], ends["hi"])

    def with_tables(self, **sources: Callable[[], DataFrame]) -> "Star":
        return replace(self, sources={**self.sources, **sources})

    def table(self, name: str) -> DataFrame:
        """A table as the role sees it: a denied one has its columns and no rows."""
        opened = self.sources[name]()
        return opened.filter(F.lit(False)) if name in self.denied_tables else opened

    # --- selection (slicers: conditions on one dimension each, all must hold) ---

    def where(self, dates: Column | None = None, stores: Column | None = None, items: Column | None = None) -> "Star":
        def both(a, b):
            return b if a is None else a if b is None else a & b

        return replace(
            self, date_filter=both(self.date_filter, dates), store_filter=both(self.store_filter, stores),
            item_filter=both(self.item_filter, items))

    # --- tables under the selection ---

    @property
    def calendar(self) -> DataFrame:
        return self.table("dim_date")

    @property
    def dates(self) -> DataFrame:
        return self.calendar if self.date_filter is None else self.calendar.filter(self.date_filter)

    @property
    def stores(self) -> DataFrame:
        stores = self.table("dim_store")
        return stores if self.store_filter is None else stores.filter(self.store_filter)

    @property
    def items(self) -> DataFrame:
        items = self.table("dim_item")
        return items if self.item_filter is None else items.filter(self.item_filter)

    def fact(self, name: str) -> DataFrame:
        return self.table(name)

    @property
    def day_count(self) -> int:
        return (self.data_end - self.data_start).days + 1

    def cells(self, by: list[str]) -> Cells | None:
        """The date cells of a grouping, or None when neither grouping nor selection touches dates."""
        names = tuple(c for c in by if c in DATE_COLS)
        if not names and self.date_filter is None:
            return None
        return self.all_cells(names)

    def all_cells(self, names: tuple[str, ...] = ()) -> Cells:
        frame = self.dates.select("date", *[F.col(n).alias(f"c_{n}") for n in names])
        return Cells(frame, names, self.day_count, span=self._span())

    def _span(self) -> tuple[date, date] | None:
        if self.date_filter is None:
            return None
        ends = self.dates.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
        return (ends["lo"], ends["hi"]) if ends["lo"] else None
