"""Current status per intersection: the list, single lookups, health and map labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalmill.functions import labels as L
from signalmill.functions.times import as_instant, iso_seconds, lag_seconds
from signalmill.operators.merge import latest_per_key
from signalmill.schemas import FRESH_SECONDS, NO_TELEMETRY_WINDOW, STATUS

ID = "intersection_id"


def latest_status(core: DataFrame) -> DataFrame:
    """Newest window of every intersection. Works on landing, staging and core rows alike.

    Of rows with equal ``window_end`` the one written last counts.
    """
    return latest_per_key(core, [ID], F.desc("window_end"), F.desc("ingested_at"))


def advance_latest(latest: DataFrame, changes: DataFrame) -> DataFrame:
    """Latest rows after ``changes`` to core, without reading the rest of it again.

    ``changes`` are rows that are new or written anew, such as the days a refresh rebuilt. A
    row of theirs replaces the one before of the same window.
    """
    marked = latest.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    order = (F.desc("window_end"), F.desc("_new"), F.desc("ingested_at"))
    return latest_per_key(marked, [ID], *order).drop("_new")


def _location(latitude: Column, longitude: Column) -> Column:
    return F.when(
        latitude.isNotNull() & longitude.isNotNull(),
        F.struct(latitude.alias("latitude"), longitude.alias("longitude")),
    )


def status_rows(latest: DataFrame) -> DataFrame:
    """Latest core rows in the shape of the status contract."""
    return latest.select(
        ID,
        "display_name",
        "signal_state",
        "avg_stop_duration_seconds",
        "avg_vehicle_speed_kmh",
        F.coalesce("is_severe_bottleneck", F.lit(False)).alias("is_severe_bottleneck"),
        iso_seconds(F.col("window_end")).alias("window_end"),
        _location(F.col("latitude"), F.col("longitude")).alias("location"),
    )


def status_list(
    latest: DataFrame,
    inventory: DataFrame | None = None,
    *,
    bottleneck_only: bool = False,
    include_orphans: bool = False,
) -> DataFrame:
    """One row per inventory entry, with its latest status or a no-telemetry stand-in.

    Ids outside the inventory vanish unless ``include_orphans``. Without an inventory the
    latest rows are the list. The name shown is the one stored with the core row; a missing
    place is taken from the inventory.
    """
    rows = status_rows(latest)
    if inventory is not None:
        places = inventory.select(
            ID,
            F.col("display_name").alias("_name"),
            _location(F.col("latitude"), F.col("longitude")).alias("_place"),
            F.lit(True).alias("_listed"),
        )
        seen = F.col("_seen").isNotNull()
        rows = places.join(
            rows.withColumn("_seen", F.lit(True)), ID, "full" if include_orphans else "left"
        ).select(
            ID,
            F.when(seen, F.col("display_name")).otherwise(F.col("_name")).alias("display_name"),
            F.when(seen, F.col("signal_state"))
            .otherwise(F.lit("UNKNOWN"))
            .alias("signal_state"),
            "avg_stop_duration_seconds",
            "avg_vehicle_speed_kmh",
            F.coalesce("is_severe_bottleneck", F.lit(False)).alias("is_severe_bottleneck"),
            F.when(seen, F.col("window_end"))
            .otherwise(F.lit(NO_TELEMETRY_WINDOW))
            .alias("window_end"),
            F.coalesce("location", "_place").alias("location"),
        )
    if bottleneck_only:
        rows = rows.filter("is_severe_bottleneck")
    return rows.select(*STATUS.fieldNames())


def list_counts(items: DataFrame) -> DataFrame:
    """How many intersections are listed, report, and are severe bottlenecks; one row."""
    reporting = F.col("window_end") != NO_TELEMETRY_WINDOW
    return items.agg(
        F.count(F.lit(1)).alias("listed"),
        F.count_if(reporting).alias("reporting"),
        F.count_if(F.col("is_severe_bottleneck")).alias("bottlenecks"),
    )


def status_by_id(
    core: DataFrame, intersection_id: str, inventory: DataFrame | None = None
) -> DataFrame:
    """Status of one intersection; no row when it is unknown.

    The id is filtered before anything is ranked, so the filter reaches the scan.
    """
    wanted = F.col(ID) == intersection_id
    return status_list(
        latest_status(core.filter(wanted)),
        None if inventory is None else inventory.filter(wanted),
    )


def lookup_status(items: DataFrame, requests: DataFrame) -> DataFrame:
    """Each requested id with its status, or with the error ``code`` and ``message``."""
    found = items.withColumn("_found", F.lit(True))
    unknown = F.col("_found").isNull()
    return (
        requests.select(ID)
        .join(found, ID, "left")
        .withColumn("code", F.when(unknown, F.lit("NOT_FOUND")))
        .withColumn(
            "message",
            F.when(unknown, F.concat(F.lit("Unknown intersection: "), F.col(ID))),
        )
        .drop("_found")
    )


def status_json(items: DataFrame) -> DataFrame:
    """One JSON text per row, null fields left out.

    The list stays a set of rows: a single document of all items would pass through one task.
    """
    return items.select(ID, F.to_json(F.struct(*items.columns)).alias("value"))


def health(
    core: DataFrame,
    inventory: DataFrame | None = None,
    *,
    as_of=None,
    threshold: float = FRESH_SECONDS,
    contract: bool = False,
) -> DataFrame:
    """One row: status, freshness, lag in seconds and number of listed intersections.

    By default the lag is that of the newest window anywhere and old data is ``UNKNOWN``.
    ``contract=True`` reports the worst listed intersection and calls old data ``STALE``.

    Core and inventory meet in one aggregate by id, not in a join, so one shuffle of partial
    sums serves every figure. The latest rows give the same result as the whole of core. An
    empty inventory counts as none.
    """
    seen = core.select(ID, "window_end", F.lit(1).alias("row"), F.lit(0).alias("listed"))
    if inventory is not None:
        entries = inventory.select(
            ID,
            F.lit(None).cast("timestamp").alias("window_end"),
            F.lit(0).alias("row"),
            F.lit(1).alias("listed"),
        )
        seen = seen.unionByName(entries)
    per_id = seen.groupBy(ID).agg(
        F.sum("row").alias("rows"),
        F.max("window_end").alias("newest"),
        F.sum("listed").alias("listed"),
    )
    has_rows = F.col("rows") > 0
    reported = has_rows & ~F.col("newest").eqNullSafe(F.lit(NO_TELEMETRY_WINDOW).cast("timestamp"))
    totals = per_id.agg(
        F.sum("rows").alias("rows"),
        F.max("newest").alias("newest"),
        F.min("newest").alias("oldest"),
        F.min(F.when(F.col("listed") > 0, F.col("newest"))).alias("oldest_listed"),
        F.coalesce(F.sum("listed"), F.lit(0)).alias("listed"),
        F.coalesce(F.sum(F.when(reported, F.col("listed"))), F.lit(0)).alias("listed_reporting"),
        F.count_if(has_rows).alias("ids"),
        F.count_if(reported).alias("ids_reporting"),
    )
    no_inventory = F.col("listed") == 0
    reporting = F.when(no_inventory, F.col("ids_reporting")).otherwise(F.col("listed_reporting"))
    known = F.col("newest").isNotNull() & (reporting > 0)
    worst = F.when(no_inventory, F.col("oldest")).otherwise(F.col("oldest_listed"))
    lag = lag_seconds(as_instant(as_of), worst if contract else F.col("newest"))
    fresh = known & (lag <= F.lit(float(threshold)))
    old = F.lit("STALE" if contract else "UNKNOWN")
    return totals.select(
        F.when(fresh, F.lit("ok")).otherwise(F.lit("degraded")).alias("status"),
        F.when(fresh, F.lit("FRESH"))
        .when(known, old)
        .otherwise(F.lit("UNKNOWN"))
        .alias("freshness_status"),
        F.when(known, lag).otherwise(F.lit(0.0)).alias("max_lag_seconds"),
        F.when(no_inventory, F.col("ids"))
        .otherwise(F.col("listed"))
        .cast("bigint")
        .alias("intersection_count"),
    )


def landing_lag(landing: DataFrame, *, as_of=None) -> DataFrame:
    """Seconds since the newest landed window; null while there is none."""
    return landing.agg(F.max("window_end").alias("newest_window")).select(
        "newest_window",
        lag_seconds(as_instant(as_of), F.col("newest_window")).alias("max_landing_lag_seconds"),
    )


def extent(items: DataFrame) -> DataFrame:
    """Corners of the listed places, and how many of them there are."""
    lat, lon = F.col("location.latitude"), F.col("location.longitude")
    return items.agg(
        F.min(lat).alias("south"),
        F.min(lon).alias("west"),
        F.max(lat).alias("north"),
        F.max(lon).alias("east"),
        F.count("location").alias("placed_items"),
    )


def status_labels(items: DataFrame) -> DataFrame:
    """Texts and marker style of every listed intersection."""
    severe = F.col("is_severe_bottleneck")
    silent = F.col("window_end") == NO_TELEMETRY_WINDOW
    state = L.state_label(F.col("signal_state"))

    def by_flag(if_severe, otherwise) -> Column:
        return F.when(severe, F.lit(if_severe)).otherwise(F.lit(otherwise))

    return items.select(
        ID,
        F.coalesce(F.when(F.col("display_name") != "", F.col("display_name")), F.col(ID)).alias(
            "title"
        ),
        F.when(silent, F.lit(L.NO_TELEMETRY_STATE)).otherwise(state).alias("state_label"),
        L.whole_number(F.col("avg_stop_duration_seconds"), "s parada").alias("stop_label"),
        L.whole_number(F.col("avg_vehicle_speed_kmh"), " km/h").alias("speed_label"),
        F.when(severe, F.lit(L.SEVERE_TAG)).alias("tag"),
        F.when(silent, F.lit(L.NO_TELEMETRY_POPUP))
        .when(severe, F.lit(L.SEVERE_POPUP))
        .alias("notice"),
        L.state_color(F.col("signal_state")).alias("fill_color"),
        by_flag(L.SEVERE_STROKE, L.NORMAL_STROKE).alias("stroke_color"),
        by_flag(L.SEVERE_RADIUS, L.NORMAL_RADIUS).alias("radius"),
        by_flag(L.SEVERE_WEIGHT, L.NORMAL_WEIGHT).alias("stroke_weight"),
        F.lit(L.FILL_OPACITY).alias("fill_opacity"),
        by_flag(L.SEVERE_CLASS, L.NORMAL_CLASS).alias("marker_class"),
    ).withColumn("summary", F.concat_ws(" · ", "state_label", "stop_label", "speed_label"))


def popup_measures(items: DataFrame) -> DataFrame:
    """Stop and speed with one decimal, as the detail bubble of the map shows them."""
    return items.select(
        ID,
        L.one_decimal(F.col("avg_stop_duration_seconds")).alias("popup_stop"),
        L.one_decimal(F.col("avg_vehicle_speed_kmh")).alias("popup_speed"),
    )


def health_labels(health_row: DataFrame) -> DataFrame:
    """The health row with its badge text, delay text and count text."""
    return health_row.select(
        "*",
        L.freshness_label(F.col("freshness_status")).alias("freshness_label"),
        F.concat(F.lit(L.BADGE_CLASS), F.lower("freshness_status")).alias("badge_class"),
        L.lag_title(F.col("freshness_status"), F.col("max_lag_seconds")).alias("lag_title"),
        L.count_label(F.col("intersection_count")).alias("count_label"),
    )
