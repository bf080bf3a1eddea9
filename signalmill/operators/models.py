"""Staging, core and the orphan report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from signalmill.functions.flags import severe_bottleneck
from signalmill.functions.geo import point
from signalmill.schemas import CORE, SEVERE_SPEED_KMH, SEVERE_STOP_SECONDS


def staging(landing: DataFrame) -> DataFrame:
    """Landing with real timestamps and states in upper case.

    The two times may arrive as text, with or without ``Z``.
    """
    return landing.select(
        "intersection_id",
        F.col("window_end").cast("timestamp").alias("window_end"),
        F.upper("signal_state").alias("signal_state"),
        "avg_stop_duration_seconds",
        "avg_vehicle_speed_kmh",
        "event_count",
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
    )


def build_core(
    staged: DataFrame,
    inventory: DataFrame,
    *,
    on_missing: str = "keep",
    min_stop: float = SEVERE_STOP_SECONDS,
    max_speed: float = SEVERE_SPEED_KMH,
) -> DataFrame:
    """Staging rows with name, place and severe flag. Works on a stream as well.

    Rows without an inventory entry stay, with nulls; ``on_missing="drop"`` leaves them out.
    The join carries no broadcast hint: Spark broadcasts the inventory while its measured size
    is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond that, where the
    adaptive skew join splits an intersection that holds much of the data.
    """
    if on_missing not in ("keep", "drop"):
        raise ValueError(f"on_missing is 'keep' or 'drop', not {on_missing!r}")
    places = inventory.select("intersection_id", "display_name", "latitude", "longitude")
    joined = staged.join(places, "intersection_id", "left" if on_missing == "keep" else "inner")
    return (
        joined.withColumn(
            "is_severe_bottleneck",
            severe_bottleneck(
                F.col("avg_stop_duration_seconds"),
                F.col("avg_vehicle_speed_kmh"),
                min_stop,
                max_speed,
            ),
        )
        .withColumn("spatial_geography_point", point(F.col("longitude"), F.col("latitude")))
        .select(*CORE.fieldNames())
    )


def orphan_report(staged: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rows and first and last window of every id the inventory does not know.

    Aggregated first, so the anti join meets one row per id and not one per window.
    """
    per_id = staged.groupBy("intersection_id").agg(
        F.count(F.lit(1)).alias("orphan_row_count"),
        F.min("window_end").alias("first_seen_window"),
        F.max("window_end").alias("last_seen_window"),
    )
    return per_id.join(inventory.select("intersection_id"), "intersection_id", "left_anti")


def core_counts(core: DataFrame) -> DataFrame:
    """Rows of the core table, its ids being counted by the listing, and the newest window."""
    return core.agg(
        F.count(F.lit(1)).alias("core_rows"),
        F.max("window_end").alias("newest_window"),
        F.count_if(F.col("is_severe_bottleneck")).alias("severe_rows"),
        F.count_if(F.col("spatial_geography_point").isNull()).alias("rows_without_place"),
    )
