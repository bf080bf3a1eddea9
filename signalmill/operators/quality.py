"""Data-quality checks: each returns the violations, and an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from signalmill.functions.geo import in_bbox
from signalmill.functions.times import as_instant, lag_seconds
from signalmill.schemas import (
    DEFAULT_BBOX,
    LANDING_KEY,
    MAX_EMISSION_GAP_SECONDS,
    P95_EVENT_TO_STATUS_SECONDS,
    P95_WINDOW_TO_CORE_SECONDS,
    SOURCE_ERROR_SECONDS,
    SOURCE_WARN_SECONDS,
)

ID = "intersection_id"


def null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in one of ``columns``, and the names of those columns."""
    failed = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("null_columns", failed).filter(F.size("null_columns") > 0)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, all counted in one pass."""
    counts = [
        F.struct(
            F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("null_count")
        )
        for c in columns
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def column_checks(
    df: DataFrame,
    name: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Failures per check and column of one table, all counted in one pass."""
    failures = [("not_null", c, F.col(c).isNull()) for c in not_null]
    for c, values in (accepted or {}).items():
        failures.append(("accepted_values", c, ~F.col(c).isin(*values)))
    counts = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.lit(c).alias("column_name"),
            F.count_if(failed).alias("failures"),
        )
        for check, c, failed in failures
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def key_check(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """The number of repeated keys, in the shape of :func:`column_checks`."""
    return repeated_keys(df, keys).agg(
        F.lit(name).alias("table_name"),
        F.lit("unique").alias("check_name"),
        F.lit(",".join(keys)).alias("column_name"),
        F.count(F.lit(1)).alias("failures"),
    )


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the list with their number of rows; null is not judged here."""
    value = F.col(column)
    return (
        df.filter(value.isNotNull() & ~value.isin(*accepted))
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(column).alias("column_name"), "value", "row_count")
    )


def repeated_keys(df: DataFrame, keys: Sequence[str] = LANDING_KEY) -> DataFrame:
    """Keys that occur more than once; null keys are left to the null checks."""
    return (
        df.na.drop(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def source_freshness(
    landing: DataFrame,
    *,
    as_of=None,
    warn: float = SOURCE_WARN_SECONDS,
    error: float = SOURCE_ERROR_SECONDS,
) -> DataFrame:
    """pass, warn or error by the age of the newest load among the last day's windows.

    No load at all is an error. Of a table stored by day, given with its ``window_date``, only
    the folders of the last day and the one before are read.
    """
    now = as_instant(as_of)
    if "window_date" in landing.columns:
        landing = landing.filter(F.col("window_date") >= F.to_date(now) - F.lit(1))
    age = lag_seconds(now, F.col("newest_load"))
    return (
        landing.filter(F.col("window_end") >= now - F.expr("INTERVAL 1 DAY"))
        .agg(F.max("ingested_at").alias("newest_load"))
        .select(
            "newest_load",
            age.alias("age_seconds"),
            F.when(age.isNull() | (age > F.lit(float(error))), F.lit("error"))
            .when(age > F.lit(float(warn)), F.lit("warn"))
            .otherwise(F.lit("pass"))
            .alias("verdict"),
        )
    )


def outside_bbox(
    inventory: DataFrame, bbox: tuple[float, float, float, float] = DEFAULT_BBOX
) -> DataFrame:
    inside = in_bbox(F.col("latitude"), F.col("longitude"), bbox)
    return inventory.filter(~F.coalesce(inside, F.lit(False)))


def inside_bbox(
    inventory: DataFrame, bbox: tuple[float, float, float, float] = DEFAULT_BBOX
) -> DataFrame:
    return inventory.filter(in_bbox(F.col("latitude"), F.col("longitude"), bbox))


def misplaced_points(
    core: DataFrame, inventory: DataFrame, tolerance: float = 1e-6
) -> DataFrame:
    """Intersections whose stored point is off its inventory place.

    Points repeat with every window, so they are collapsed per id before the join.
    """
    lon, lat = F.col("spatial_geography_point.longitude"), F.col("spatial_geography_point.latitude")
    stored = core.groupBy(ID).agg(
        F.min(lon).alias("min_x"),
        F.max(lon).alias("max_x"),
        F.min(lat).alias("min_y"),
        F.max(lat).alias("max_y"),
        F.count_if(F.col("spatial_geography_point").isNull()).alias("missing"),
    )
    x, y = F.col("longitude"), F.col("latitude")
    error = F.greatest(
        F.abs(F.col("min_x") - x),
        F.abs(F.col("max_x") - x),
        F.abs(F.col("min_y") - y),
        F.abs(F.col("max_y") - y),
    )
    return (
        stored.join(inventory.select(ID, "latitude", "longitude"), ID)
        .withColumn("point_error", error)
        .filter((F.col("missing") > 0) | (F.col("point_error") > F.lit(tolerance)))
        .select(ID, "missing", "point_error")
    )


def silent_ids(inventory: DataFrame, events: DataFrame) -> DataFrame:
    """Inventory entries that never sent an event. Ids are made distinct before the join."""
    return inventory.select(ID).join(events.select(ID).distinct(), ID, "left_anti")


def emission_gaps(
    events: DataFrame, max_gap_seconds: int = MAX_EMISSION_GAP_SECONDS
) -> DataFrame:
    """Silences of an id that are longer than allowed, with their two ends.

    Time is cut in slots of the allowed length. Two events in one slot are never too far
    apart, so only the first and last event of each slot matter: those come from a hash
    aggregate that collapses a busy id before the shuffle. The slots of an id are then sorted
    day by day, each day for itself, and only the first and last slot of a day meet those of the
    days before and after; so no task holds more than a day's slots of an id, or a row for each
    of its days.
    """
    at = F.unix_micros("event_timestamp")
    width = max_gap_seconds * 1_000_000
    slots = events.groupBy(ID, F.floor(at / width).alias("slot")).agg(
        F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last")
    )
    day = F.floor(F.unix_micros("first") / F.lit(86_400_000_000))
    slots = slots.withColumn("day", day)
    by_slot = Window.partitionBy(ID, "day").orderBy("slot")
    within = slots.withColumn("gap_start", F.lag("last").over(by_slot))
    by_day = Window.partitionBy(ID).orderBy("day")
    across = (
        slots.groupBy(ID, "day")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .withColumn("gap_start", F.lag("last").over(by_day))
    )
    columns = [ID, "gap_start", "first"]
    gap = F.unix_micros("first") - F.unix_micros("gap_start")
    return (
        within.select(*columns)
        .unionByName(across.select(*columns))
        .filter(gap > F.lit(width))
        .select(
            ID,
            "gap_start",
            F.col("first").alias("gap_end"),
            (gap / F.lit(1e6)).alias("gap_seconds"),
        )
    )


def _p95(lags: DataFrame, limit: float, share: float = 0.95) -> DataFrame:
    """Exact percentile of ``lag_micros``, interpolated between its two neighbours in rank.

    Two passes. The first counts rows per second, of which there are no more than the longest lag
    has; their running sum finds the seconds that hold the two ranks. The second counts the
    distinct lags of those seconds alone, at most a million each. So no task gets more than that,
    whatever the number of rows.
    """
    second = F.floor(F.col("lag_micros") / F.lit(1_000_000)).alias("second")
    rows = lags.select(second, "lag_micros")
    seconds = rows.groupBy("second").agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    place = F.lit(share) * (F.sum("n").over(every) - 1)
    up_to = F.sum("n").over(every.orderBy("second"))
    holding = (
        seconds.withColumns({"place": place, "row_count": F.sum("n").over(every), "stop": up_to})
        .withColumn("ahead", F.col("stop") - F.col("n"))
        .filter((F.col("stop") > F.floor("place")) & (F.col("ahead") <= F.ceil("place")))
        .select("second", "place", "row_count", "ahead")
    )
    in_second = Window.partitionBy("second").orderBy("lag_micros")
    near = (
        rows.join(F.broadcast(holding), "second")
        .groupBy("second", "lag_micros", "place", "row_count", "ahead")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("stop", F.col("ahead") + F.sum("n").over(in_second))
        .withColumn("start", F.col("stop") - F.col("n"))
    )

    def at(rank):
        return F.max(
            F.when((F.col("start") <= rank) & (F.col("stop") > rank), F.col("lag_micros"))
        )

    low, high = at(F.floor("place")), at(F.ceil("place"))
    between = F.max(F.col("place") - F.floor("place"))
    p95 = (low + (high - low) * between) / F.lit(1e6)
    return near.agg(
        F.max("row_count").cast("bigint").alias("row_count"),
        p95.alias("p95_seconds"),
        (p95 <= F.lit(float(limit))).alias("within_limit"),
    )


def window_lag_p95(landing: DataFrame, limit: float = P95_WINDOW_TO_CORE_SECONDS) -> DataFrame:
    """95th percentile of the seconds from the end of a window to its load."""
    lag = F.unix_micros("ingested_at") - F.unix_micros("window_end")
    loaded = landing.filter(F.col("ingested_at").isNotNull())
    return _p95(loaded.select(lag.alias("lag_micros")), limit)


def event_lag_p95(
    events: DataFrame,
    landing: DataFrame,
    limit: float = P95_EVENT_TO_STATUS_SECONDS,
    length: str = "1 minute",
) -> DataFrame:
    """95th percentile of the seconds from an event to the load of its window.

    Three narrow columns of the events meet the landing rows in one shuffle, which both passes
    of the percentile share; a busy window is split by the adaptive skew join, and only counts go
    on from there.
    """
    sent = events.select(
        ID,
        F.window("event_timestamp", length)["end"].alias("window_end"),
        F.unix_micros("event_timestamp").alias("sent"),
    )
    loads = landing.filter(F.col("ingested_at").isNotNull()).select(
        ID, "window_end", F.unix_micros("ingested_at").alias("loaded")
    )
    lag = F.col("loaded") - F.col("sent")
    return _p95(sent.join(loads, [ID, "window_end"]).select(lag.alias("lag_micros")), limit)
