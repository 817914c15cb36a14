"""Seed rows of the two dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isohour import schemas

# The seeded country and cities.
COUNTRIES = [(1, "Spain")]
CITIES = [
    (1, "Madrid", 40.4168, -3.7038, 1),
    (2, "Barcelona", 41.3874, 2.1686, 1),
    (3, "Alicante", 38.3452, -0.4810, 1),
    (4, "Valladolid", 41.6523, -4.7245, 1),
]


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRIES, schemas.DIM_COUNTRY)


def cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITIES, schemas.DIM_CITY)
