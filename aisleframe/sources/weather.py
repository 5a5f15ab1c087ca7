"""Weather service replies: one JSON document per city with parallel arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Field names of the weather service's daily reply.
REPLY = "daily struct<time: array<date>, precipitation_sum: array<double>, temperature_2m_max: array<double>>"


def parse_replies(replies: DataFrame) -> DataFrame:
    """city, reply (JSON text) -> one row per city and day; a null in an array stays NULL."""
    daily = F.from_json("reply", REPLY, {"mode": "FAILFAST"})["daily"]
    return (
        replies.select("city", daily.alias("daily"))
        .select("city", F.inline(F.arrays_zip("daily.time", "daily.precipitation_sum", "daily.temperature_2m_max")))
        .toDF("city", "weather_date", "rain_mm", "temp_max_c")
    )


def as_replies(weather: DataFrame) -> DataFrame:
    """The inverse: daily rows as one reply per city. A city has at most one row per calendar day."""
    days = F.array_sort(F.collect_list(F.struct("weather_date", "rain_mm", "temp_max_c")))
    reply = F.to_json(
        F.struct(F.struct(
            F.col("days.weather_date").alias("time"), F.col("days.rain_mm").alias("precipitation_sum"),
            F.col("days.temp_max_c").alias("temperature_2m_max")).alias("daily")),
        {"ignoreNullFields": "false"})
    return weather.groupBy("city").agg(days.alias("days")).select("city", reply.alias("reply"))
