"""Column helpers shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_key(day: Column | str) -> Column:
    """2016-02-10 -> 20160210."""
    return (F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


ROWS_OF_A_TASK = 500_000


def tasks_for(*tables: DataFrame, more: int = 0) -> int:
    """How many tasks the rows of written tables are dealt out to: more with more rows, so that a task's rows stay few.

    ``more`` rows are made inside the tasks.
    """
    rows = more + sum(t.count() for t in tables)  # from the footers of the files
    return max(int(tables[0].sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_OF_A_TASK))


def by_month(rows: DataFrame, month: Column, keys: list[str], tasks: int) -> DataFrame:
    """Rows dealt out by month and slice of their keys, with both as columns ``_month`` and ``_slice``.

    The rows of a key and month meet in one task and a task has few months, so a fact can be written by month as it comes.
    """
    slices = -(-tasks // 16)
    part = F.pmod(F.hash(*keys), F.lit(slices))
    return rows.withColumns({"_month": month.cast("int"), "_slice": part}).repartition(tasks, "_month", "_slice")


def listed(df: DataFrame, column: str, most: int = 20) -> str:
    """The distinct values of a column for a message: the first ones by name, and how many more there are."""
    values = df.select(F.col(column).cast("string").alias("v")).distinct()
    shown = [str(r[0]) for r in values.orderBy("v").limit(most).collect()]
    more = values.count() - len(shown) if len(shown) == most else 0
    return ", ".join(shown) + (f" and {more} more" if more > 0 else "")


def key_date(key: Column | str) -> Column:
    """20160210 -> 2016-02-10."""
    return F.to_date(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), "yyyyMMdd")


def day_number(day: Column | str) -> Column:
    """Days since the epoch: the order column of calendar (RANGE) frames."""
    return F.unix_date(day)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, blank for a missing or zero denominator; a missing part counts as 0."""
    return F.try_divide(F.coalesce(part, F.lit(0.0)).cast("double"), whole.cast("double"))


def growth(now: Column, before: Column) -> Column:
    """(now - before) / before with blanks read as 0 in the difference."""
    diff = F.coalesce(now, F.lit(0.0)).cast("double") - F.coalesce(before, F.lit(0.0)).cast("double")
    return F.try_divide(diff, before.cast("double"))


def is_true(flag: Column) -> Column:
    """IS TRUE for a three-valued flag."""
    return F.coalesce(flag, F.lit(False))


def all_blank(columns: list[str]) -> Column:
    blank = F.lit(True)
    for name in columns:
        blank = blank & F.col(name).isNull()
    return blank


def stitch(parts: list[DataFrame], by: list[str]) -> DataFrame:
    """Put result columns of several small aggregates side by side.

    A full outer join on nullable group columns, written as union + one grouping so that the blank
    member (NULL) of a dimension meets itself and any number of parts costs one shuffle of result rows.
    """
    if len(parts) == 1:
        return parts[0]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in by]
    return stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in values])


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", *extra: Column) -> DataFrame:
    """Equi-join in which NULL meets NULL. The result has the left side's keys; ``extra`` conditions must hold too."""
    other = right.withColumnsRenamed({c: f"_{c}" for c in on})
    can_be_null = {f.name for f in left.schema if f.nullable}
    match = [
        F.col(c).eqNullSafe(F.col(f"_{c}")) if c in can_be_null else F.col(c) == F.col(f"_{c}") for c in on]
    joined = left.join(other, [*match, *extra], how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_{c}" for c in on])
