"""Key figures: areas by geodesic measure, in the unit asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.units import area_in, as_decimal

KPI_SCHEMA = "area_of_interest_id string, value decimal(18,3), kpi_name string"


def areas_of(areas: DataFrame, unit: str | None, srid: int = 4326) -> DataFrame:
    """(id, area) of areas of interest that have a geometry."""
    rows = areas.where(geo.has_positions(F.col("geom")))
    return rows.select("id", area_in(geo.geodesic_area(F.col("geom"), srid), unit).alias("area"))


def in_unit(measured: DataFrame, unit: str | None) -> DataFrame:
    """(id, area) of (id, m2)."""
    return measured.select("id", area_in(F.col("m2"), unit).alias("area"))


def changed_areas(business: DataFrame, measured: DataFrame) -> DataFrame:
    """(id, area) of the rows of business whose measured area isn't what they have."""
    old = F.col("area").cast("decimal(18,3)") if "area" in business.columns else F.lit(None).cast("decimal(18,3)")
    rows = business.select("id", old.alias("old"), F.trim(F.col("id").cast("string")).alias("nid"))
    return rows.join(measured.select(F.col("id").alias("nid"), F.col("area")), "nid").where(~F.col("area").eqNullSafe(F.col("old"))).select("id", "area")


def with_areas(business: DataFrame, measured: DataFrame) -> DataFrame:
    """business with the measured areas; rows that weren't measured keep theirs."""
    found = measured.select(F.col("id").alias("__id"), F.col("area").alias("__area"))
    old = F.col("area").cast("decimal(18,3)") if "area" in business.columns else F.lit(None).cast("decimal(18,3)")
    met = business.join(found, business["id"].cast("string") == found["__id"].cast("string"), "left")
    return met.withColumn("area", F.coalesce("__area", old)).drop("__id", "__area")


def summed(measured: DataFrame, name: str, unit: str | None) -> DataFrame:
    """A theme's rows from (area_of_interest_id, m2). Sums are exact decimals, so no order of rows shows in them, and partial before the shuffle."""
    total = measured.where(F.col("area_of_interest_id").isNotNull()).groupBy("area_of_interest_id").agg(F.sum(as_decimal(F.col("m2"))).alias("m2"))
    return total.select(F.col("area_of_interest_id").cast("string").alias("area_of_interest_id"), area_in(F.col("m2"), unit).alias("value"), F.lit(name).alias("kpi_name"))


def theme(features: DataFrame, name: str, unit: str | None, srid: int = 4326) -> DataFrame:
    """The area of a layer's features in each area of interest."""
    rows = features.where(F.col("area_of_interest_id").isNotNull() & geo.has_positions(F.col("geom")))
    return summed(rows.select("area_of_interest_id", geo.geodesic_area(F.col("geom"), srid).alias("m2")), name, unit)
