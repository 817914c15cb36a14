"""Enrichment with the dimensions and the two marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isohour.functions.keys import surrogate_key
from isohour.functions.measures import mean, total
from isohour.functions.times import instant

GEOGRAPHY = ("city", "longitude", "latitude", "country")


def with_geography(observations: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    """Left joins fact -> city -> country; an unknown city leaves NULLs.

    No broadcast hint: Spark broadcasts a dimension when its size is known to be under
    ``autoBroadcastJoinThreshold``; beyond it adaptive execution splits a skewed city. The joins
    are chained, since a join of both dimensions first would be estimated at the product of
    their sizes, and the fact table shuffled for it.
    """
    cities = city.select(
        "city_id", F.col("city_name").alias("city"), "longitude", "latitude", "country_id"
    )
    countries = country.select("country_id", F.col("country_name").alias("country"))
    placed = observations.join(cities, "city_id", "left")
    return placed.join(countries, "country_id", "left").drop("country_id")


def hourly_mart(
    observations: DataFrame, city: DataFrame, country: DataFrame, as_of: str | Column
) -> DataFrame:
    return with_geography(observations, city, country).select(
        F.col("timestamp").alias("observation_timestamp"),
        *GEOGRAPHY,
        "temperature",
        "precipitation",
        "wind_speed",
        "wind_gusts",
        "humidity",
        "pressure",
        surrogate_key(F.col("city"), F.col("timestamp")).alias("tech_key"),
        instant(as_of).alias("update_ts"),
    )


def daily_mart(
    observations: DataFrame,
    city: DataFrame,
    country: DataFrame,
    as_of: str | Column,
    scale: int | None = None,
) -> DataFrame:
    """Daily aggregates per city. ``scale``: digits of the measures, for order-free sums."""
    t, rain = F.col("temperature"), F.col("precipitation")
    return (
        with_geography(observations, city, country)
        .groupBy(F.to_date("timestamp").alias("observation_date"), *GEOGRAPHY)
        .agg(
            mean(t, scale).alias("avg_temperature"),
            F.min(t).alias("min_temperature"),
            F.max(t).alias("max_temperature"),
            (F.max(t) - F.min(t)).alias("thermal_range"),
            total(rain, scale).alias("total_precipitation"),
            F.count_if(rain > 0).alias("rainy_hours"),
            F.max("wind_speed").alias("max_wind_speed"),
            mean(F.col("wind_speed"), scale).alias("avg_wind_speed"),
            F.max("wind_gusts").alias("max_wind_gusts"),
            mean(F.col("humidity"), scale).alias("avg_humidity"),
            mean(F.col("pressure"), scale).alias("avg_pressure"),
        )
        .withColumn("tech_key", surrogate_key(F.col("city"), F.col("observation_date")))
        .withColumn("update_ts", instant(as_of))
    )
