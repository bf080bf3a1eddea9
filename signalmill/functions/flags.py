"""The severe-bottleneck flag, for DataFrame and SQL users."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from signalmill.schemas import SEVERE_SPEED_KMH, SEVERE_STOP_SECONDS


def severe_bottleneck(
    stop: Column,
    speed: Column,
    min_stop: float = SEVERE_STOP_SECONDS,
    max_speed: float = SEVERE_SPEED_KMH,
) -> Column:
    """Long stops at low speed. Both bounds are strict; nulls follow SQL's three values."""
    return (stop > F.lit(min_stop)) & (speed < F.lit(max_speed))


def register_functions(spark: SparkSession) -> None:
    """Make ``is_severe_bottleneck(stop, speed)`` callable from SQL."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION is_severe_bottleneck(stop DOUBLE, speed DOUBLE) "
        f"RETURNS BOOLEAN RETURN stop > {SEVERE_STOP_SECONDS}D AND speed < {SEVERE_SPEED_KMH}D"
    )
