"""Points as plain structs: x is the longitude, y the latitude."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from signalmill.schemas import DEFAULT_BBOX


def point(longitude: Column, latitude: Column) -> Column:
    """Null unless both coordinates are known."""
    return F.when(
        longitude.isNotNull() & latitude.isNotNull(),
        F.struct(longitude.alias("longitude"), latitude.alias("latitude")),
    )


def point_x(geo: Column) -> Column:
    return geo["longitude"]


def point_y(geo: Column) -> Column:
    return geo["latitude"]


def point_wkb(longitude: Column, latitude: Column) -> Column:
    """Well-known binary of the point, for stores that have a geometry type.

    Big-endian order mark, geometry type 1, then the two coordinates as IEEE doubles.
    """

    def bits(value: Column) -> Column:
        as_long = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value)
        return F.lpad(F.hex(as_long.cast("bigint")), 16, "0")

    return F.when(
        longitude.isNotNull() & latitude.isNotNull(),
        F.unhex(F.concat(F.lit("0000000001"), bits(longitude), bits(latitude))),
    )


def in_bbox(
    latitude: Column,
    longitude: Column,
    bbox: tuple[float, float, float, float] = DEFAULT_BBOX,
) -> Column:
    """Inside south, west, north, east; the border counts."""
    south, west, north, east = bbox
    return latitude.between(south, north) & longitude.between(west, east)
