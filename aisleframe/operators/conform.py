"""Conformed dimensions and facts: staged tables joined with master data and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleframe.functions.columns import by_month, date_key, listed, tasks_for
from aisleframe.operators.targets import days_of, month_shares


def dim_item(staged: DataFrame, prices: DataFrame) -> DataFrame:
    return staged.join(prices.select("item_nbr", "unit_price", "unit_cost"), "item_nbr", "left").select(
        "item_key", "item_nbr", "family", "class", "is_perishable", "unit_price", "unit_cost")


def dim_store(staged: DataFrame, profiles: DataFrame, regions_of_state: DataFrame, regions: DataFrame) -> DataFrame:
    region = regions_of_state.join(regions, "region_id", "left").select("state", F.col("region_name").alias("region"))
    return (
        staged.join(profiles, "store_nbr", "left").join(region, "state", "left")
        .select("store_key", "store_nbr", "city", "state", "store_type", "cluster", "opening_date",
                "selling_area_m2", "region")
    )


def fact_store_day(receipts: DataFrame, targets: DataFrame, dates: DataFrame, stores: DataFrame,
                   weather: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Receipts and targets by store and day, whichever side has the day, with the city's weather.

    Days outside the calendar and stores outside this build drop out; the full outer join is written as a
    union with one grouping. Its shuffle deals out the months in slices of stores: a store's days of a month stay side
    by side, where they take little room, and the rows come out by month, as facts are stored. With weekday ``weights`` the
    targets are monthly ones: both sides are dealt out alike and the days are made where their month has come to.
    """
    month, rows = F.expr("date_key div 100"), _on_calendar(receipts.select("date_key", "store_key", "receipts"), dates)
    if weights is None:
        planned = _on_calendar(_target_days(targets), dates)
        both = by_month(
            rows.unionByName(planned, allowMissingColumns=True), month, ["store_key"], tasks_for(receipts, targets))
    else:
        tasks = tasks_for(receipts, more=31 * targets.count())
        months = by_month(
            month_shares(targets, weights), F.expr("year(month_start) * 100 + month(month_start)"), ["store_nbr"], tasks)
        planned = _on_calendar(_target_days(days_of(months, "_month", "_slice"), "_month", "_slice"), dates)
        both = by_month(rows, month, ["store_key"], tasks).unionByName(planned, allowMissingColumns=True)
    days = (
        both.groupBy("_month", "_slice", "date_key", "store_key")
        .agg(F.sum("receipts").alias("receipts"), F.sum("target_value").alias("target_value"))
    )
    sky = weather.select("city", date_key("weather_date").alias("date_key"), "rain_mm", "temp_max_c")
    return (
        days.join(stores.select("store_key", "city"), "store_key")
        .join(sky, ["city", "date_key"], "left")
        .select(
            "date_key", "store_key", F.col("receipts").cast("bigint").alias("receipts"),
            F.col("target_value").cast("decimal(19,4)").alias("target_value"),
            F.col("rain_mm").cast("double").alias("rain_mm"), F.col("temp_max_c").cast("double").alias("temp_max_c"))
    )


def _target_days(targets: DataFrame, *kept: str) -> DataFrame:
    return targets.select(
        date_key("target_date").alias("date_key"), F.col("store_nbr").alias("store_key"), "target_value", *kept)


def _on_calendar(rows: DataFrame, dates: DataFrame) -> DataFrame:
    lo, hi = (dates.agg(f("date_key").alias("k")).scalar() for f in (F.min, F.max))
    return rows.filter(F.col("date_key").between(lo, hi))


def scoped_access(access: DataFrame, stores: DataFrame) -> DataFrame:
    """Access rows of this build's stores."""
    return access.join(stores.select("store_key"), "store_key", "left_semi").select(
        "user_principal_name", "store_key")


def store_label(stores: DataFrame) -> DataFrame:
    """Adds "Store 7 (Quito)"."""
    return stores.withColumn("store_name", F.format_string("Store %d (%s)", "store_nbr", "city"))


def month_label(dates: DataFrame) -> DataFrame:
    """Adds "Feb 2016"."""
    return dates.withColumn("year_month", F.date_format("date", "MMM yyyy"))


# City names the gazetteer spells differently.
CITY_ALIASES = {"Libertad": "La Libertad"}


class UnknownCityError(ValueError):
    """A store city without a place in the home country."""


def city_match(cities: DataFrame, candidates: DataFrame, country: str = "EC",
               aliases: dict[str, str] = CITY_ALIASES) -> DataFrame:
    """The most populous place of the home country for each city; the city keeps its own name.

    Candidates: name, rank (order of the answer, for ties), country_code, population, latitude, longitude, admin1.
    """
    lookup = F.col("city")
    for ours, theirs in aliases.items():
        lookup = F.when(F.col("city") == ours, theirs).otherwise(lookup)
    wanted = cities.select("city").distinct().withColumn("name", lookup)
    # the best place per name is found before the join: many candidates of one name combine on the map side
    best = (
        candidates.filter(F.col("country_code") == country).groupBy("name")
        .agg(F.max_by(
            F.struct("latitude", "longitude", "admin1"),
            F.struct(F.coalesce("population", F.lit(0)).alias("p"), (-F.col("rank")).alias("r"))).alias("place"))
    )
    unknown = listed(wanted.join(best, "name", "left_anti"), "city")
    if unknown:
        raise UnknownCityError(f"No match in {country} for: {unknown}")
    return wanted.join(best, "name").select(
        "city", "place.latitude", "place.longitude", F.coalesce("place.admin1", F.lit("")).alias("admin1"))
