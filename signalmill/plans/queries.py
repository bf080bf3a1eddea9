"""The registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from signalmill.functions import severe_bottleneck
from signalmill.functions.times import as_instant
from signalmill.operators import events as ev
from signalmill.operators import inventory as inv
from signalmill.operators import models, quality, status, validation, windows
from signalmill.operators.merge import snapshot_diff
from signalmill.plans import driver_tables as d
from signalmill.plans.jobs import current_status, quality_report
from signalmill.schemas import (
    CORE,
    INVENTORY_REQUIRED,
    INVENTORY_SOURCES,
    LANDING_REQUIRED,
    SIGNAL_STATES,
)
from signalmill.session import configure, shared_folder
from signalmill.sources import core as core_table
from signalmill.sources import files, partials, snapshots
from signalmill.sources import landing as landing_table
from signalmill.sources import latest as latest_table
from signalmill.sources.events import read_text
from signalmill.sources.inventory import publish_inventory, read_inventory, read_map_extract
from signalmill.streaming import pipelines as streams

Query = Callable[[SparkSession, str], DataFrame]
CUT = "2024-01-01 00:15:30"
CUT_WINDOW = "2024-01-01 00:15:00"
EARLY_LOAD = "2024-01-01 00:15:35"
LATE_LOAD = "2024-01-01 00:30:05"


def plain(df: DataFrame) -> DataFrame:
    """Flat columns for comparison: zone-less times, averages to six decimals."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif field.name in ("location", "spatial_geography_point"):
            prefix = "location" if field.name == "location" else "point"
            columns += [
                F.round(column[axis], 6).alias(f"{prefix}_{axis}")
                for axis in ("longitude", "latitude")
            ]
            continue
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- Events --------------------------------------------------------------------------------


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate_events(d.raw_events(spark, sf_dir))


def event_verdicts(spark, sf_dir):
    reasons = F.concat_ws(",", "reasons").alias("reasons")
    return _validated(spark, sf_dir).select("seq", reasons)


def event_valid(spark, sf_dir):
    routed = validation.route_events(_validated(spark, sf_dir))
    return routed.filter("topic = 'traffic-events'").select("topic", "key", "value")


def event_dlq(spark, sf_dir):
    routed = validation.route_events(_validated(spark, sf_dir))
    return routed.filter("topic = 'traffic-events-dlq'").select("topic", "key", "value")


def event_lines(spark, sf_dir):
    return validation.json_lines(validation.route_events(_validated(spark, sf_dir)))


def invalid_rate(spark, sf_dir):
    return plain(validation.invalid_rate(_validated(spark, sf_dir)))


def flatten_events(spark, sf_dir):
    valid = _validated(spark, sf_dir).filter(validation.is_valid())
    return plain(ev.flatten_documents(valid, "seq"))


def dedup_events(spark, sf_dir):
    """Every event delivered twice, the second time later; the aggregate must not notice."""
    once = d.flat_events(spark, sf_dir).withColumn("event_id", F.col("seq"))
    again = once.withColumn("seq", F.col("seq") + 1_000_000_000_000).withColumn(
        "signal_state", F.lit("UNKNOWN")
    )
    events = ev.drop_repeats(once.unionByName(again))
    return plain(windows.window_aggregate(events, seq_col="seq", states=SIGNAL_STATES))


def dedup_null_ids(spark, sf_dir):
    """One event in ten without an id, which is no copy of another; the others come twice."""
    events = d.flat_events(spark, sf_dir)
    named = F.when(F.col("seq") % 10 != 0, F.col("seq"))
    once = events.withColumn("event_id", named)
    again = once.filter("event_id IS NOT NULL").withColumn("seq", F.col("seq") + 1_000_000_000_000)
    kept = ev.drop_repeats(once.unionByName(again))
    return plain(windows.window_aggregate(kept, seq_col="seq", states=SIGNAL_STATES))


# --- Windows and landing -------------------------------------------------------------------


def window_aggregate(spark, sf_dir):
    return plain(d.windows(spark, sf_dir))


def last_state(spark, sf_dir):
    """The form for states that are not listed beforehand."""
    rows = windows.window_aggregate(d.flat_events(spark, sf_dir), seq_col="seq", with_start=True)
    return plain(rows.select("intersection_id", "window_start", "window_end", "signal_state"))


def landing_rows(spark, sf_dir):
    return plain(windows.landing_rows(d.windows(spark, sf_dir), LATE_LOAD + ".987"))


def landing_scan(spark, sf_dir):
    path = shared_folder(configure(spark), "landing")
    landing_table.upsert_landing(d.landing(spark, sf_dir), path, unique=True)
    return plain(landing_table.in_order(landing_table.read_landing(spark, path)))


def landing_upsert(spark, sf_dir):
    """A first load that ends within a minute, then a second one that repeats that minute."""
    path = shared_folder(configure(spark), "landing")
    events = d.flat_events(spark, sf_dir)
    at = F.col("event_timestamp")

    def load(rows: DataFrame, when: str) -> None:
        aggregated = windows.window_aggregate(rows, seq_col="seq", states=SIGNAL_STATES)
        landing_table.upsert_landing(windows.landing_rows(aggregated, when), path, unique=True)

    load(events.filter(at < as_instant(CUT)), EARLY_LOAD)
    load(events.filter(at >= as_instant(CUT_WINDOW)), LATE_LOAD)
    return plain(landing_table.read_landing(spark, path))


def landing_snapshot(spark, sf_dir):
    """The two loads into a table of snapshots; between them a writer dies ahead of its swap."""
    path = shared_folder(configure(spark), "snapshots")
    events = d.flat_events(spark, sf_dir)
    at = F.col("event_timestamp")

    def rows(some: DataFrame, when: str) -> DataFrame:
        aggregated = windows.window_aggregate(some, seq_col="seq", states=SIGNAL_STATES)
        return windows.landing_rows(aggregated, when)

    early = rows(events.filter(at < as_instant(CUT)), EARLY_LOAD)
    snapshots.upsert_snapshot(early, path, unique=True)
    lost = early.withColumn("event_count", F.lit(0).cast("long"))
    landing_table.with_date(lost).write.partitionBy("window_date").parquet(f"{path}/load=lost")
    late = rows(events.filter(at >= as_instant(CUT_WINDOW)), LATE_LOAD)
    snapshots.upsert_snapshot(late, path, unique=True)
    return plain(snapshots.read_snapshot(spark, path))


# --- Streams -------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream of files; the pattern fits one file and a folder of files."""
    schema = d.table(spark, sf_dir, "events").schema
    return d.as_events(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*"))


def stream_window_aggregate(spark, sf_dir):
    """The window aggregate as a drained stream into the version log."""
    folder = shared_folder(configure(spark), "stream")
    rows = streams.stream_windows(_event_stream(spark, sf_dir), states=SIGNAL_STATES)
    query = streams.start_landing(
        rows, f"{folder}/log", f"{folder}/checkpoint", ingested_at=LATE_LOAD
    )
    query.awaitTermination()
    return plain(landing_table.read_versions(spark, f"{folder}/log"))


def log_reused_checkpoint(spark, sf_dir):
    """A stream whose checkpoint is deleted and begun anew, with other minutes of the same day."""
    folder = shared_folder(configure(spark), "stream")
    log, table, checkpoint = (f"{folder}/{x}" for x in ("log", "landing", "checkpoint"))
    events = _event_stream(spark, sf_dir)
    for odd in (0, 1):
        files.delete(spark, checkpoint)
        some = events.filter(F.minute("event_timestamp") % 2 == odd)
        rows = streams.stream_windows(some, states=SIGNAL_STATES)
        streams.start_landing(rows, log, checkpoint, ingested_at=LATE_LOAD).awaitTermination()
        landing_table.fold_versions(spark, log, table)
    return plain(landing_table.read_live(spark, table, log))


PARTS = 4


def _in_parts(spark: SparkSession, sf_dir: str, folder: str, part: Column):
    """Events that reach a folder in PARTS loads, by number, and the folder as a stream.

    For each load: the stream of flat events. A stream is started anew after each, from its
    checkpoint, so every load is a micro-batch at least.
    """
    events = d.flat_events(spark, sf_dir).withColumn("event_id", F.col("seq"))
    for number in range(PARTS):
        events.filter(part == number).write.mode("append").parquet(f"{folder}/in")
        yield spark.readStream.schema(events.schema).parquet(f"{folder}/in")


def _quarter() -> Column:
    """Which eight minutes of the half hour an event is of."""
    return F.floor(F.minute("event_timestamp") / 8).cast("int")


def stream_restarts(spark, sf_dir):
    """Every window spread over four loads and three restarts of the stream."""
    folder = shared_folder(configure(spark), "stream")
    for events in _in_parts(spark, sf_dir, folder, F.col("seq") % PARTS):
        rows = streams.stream_windows(events, states=SIGNAL_STATES, watermark="1 hour")
        streams.start_landing(
            rows, f"{folder}/log", f"{folder}/checkpoint", ingested_at=LATE_LOAD
        ).awaitTermination()
    return plain(landing_table.read_versions(spark, f"{folder}/log"))


def stream_dedup(spark, sf_dir):
    """Every event delivered twice, in different loads; the stream must count it once."""
    folder = shared_folder(configure(spark), "stream")
    loads = _in_parts(spark, sf_dir, folder, F.col("seq") % PARTS)
    for number, events in enumerate(loads):
        again = d.flat_events(spark, sf_dir).withColumn("event_id", F.col("seq"))
        again = again.filter(F.col("seq") % PARTS == (number - 1) % PARTS)
        again.write.mode("append").parquet(f"{folder}/in")
        rows = streams.stream_windows(events, states=SIGNAL_STATES, watermark="1 hour", dedup=True)
        streams.start_landing(
            rows, f"{folder}/log", f"{folder}/checkpoint", ingested_at=LATE_LOAD
        ).awaitTermination()
    return plain(landing_table.read_versions(spark, f"{folder}/log"))


def _late_stream(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The newest minutes first, so that all others are late; folded half way and at the end."""
    for number, events in enumerate(_in_parts(spark, sf_dir, folder, 3 - _quarter())):
        streams.start_partials(
            events, f"{folder}/log", f"{folder}/checkpoint", ingested_at=LATE_LOAD
        ).awaitTermination()
        if number % 2:
            partials.fold_partials(spark, f"{folder}/log", f"{folder}/store", f"{folder}/landing")


def stream_late(spark, sf_dir):
    """Landing corrected by late events: as if all had come in time."""
    folder = shared_folder(configure(spark), "stream")
    _late_stream(spark, sf_dir, folder)
    return plain(landing_table.read_landing(spark, f"{folder}/landing"))


def stream_late_events(spark, sf_dir):
    """The events that were behind the watermark of their micro-batch."""
    folder = shared_folder(configure(spark), "stream")
    _late_stream(spark, sf_dir, folder)
    late = spark.read.parquet(f"{folder}/log_late")
    return plain(late.select("seq", "intersection_id", "event_timestamp", "signal_state"))


def stream_latest(spark, sf_dir):
    """The latest row of each intersection, kept by a stream over four loads."""
    folder = shared_folder(configure(spark), "stream")
    for events in _in_parts(spark, sf_dir, folder, F.col("seq") % PARTS):
        windows = streams.stream_windows(events, states=SIGNAL_STATES, watermark="1 hour")
        live = streams.stream_core(windows, d.inventory(spark, sf_dir), LATE_LOAD)
        streams.start_latest(live, f"{folder}/latest", f"{folder}/checkpoint").awaitTermination()
    return plain(latest_table.read_latest(spark, f"{folder}/latest"))


def stream_core(spark, sf_dir):
    """Live windows joined to the inventory on the stream, into a version log of core rows."""
    folder = shared_folder(configure(spark), "stream")
    live = streams.stream_core(
        streams.stream_windows(_event_stream(spark, sf_dir), states=SIGNAL_STATES),
        d.inventory(spark, sf_dir),
        LATE_LOAD,
    )
    streams.start_core(live, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return plain(landing_table.read_versions(spark, f"{folder}/log", shape=CORE))


def stream_core_versions(spark, sf_dir):
    """Live windows with the inventory of their time: another version is published half way."""
    folder = shared_folder(configure(spark), "stream")
    places = d.inventory(spark, sf_dir)
    later = places.filter("osm_node_id % 3 <> 0").withColumn(
        "display_name", F.concat(F.lit("new "), F.col("display_name"))
    )
    for number, events in enumerate(_in_parts(spark, sf_dir, folder, _quarter())):
        if number in (0, 2):
            publish_inventory(later if number else places, f"{folder}/inventory")
        windows = streams.stream_windows(events, states=SIGNAL_STATES)
        streams.start_core_versions(
            windows, f"{folder}/inventory", f"{folder}/log", f"{folder}/checkpoint",
            ingested_at=LATE_LOAD,
        ).awaitTermination()
    return plain(landing_table.read_versions(spark, f"{folder}/log", shape=CORE))


def stream_routing(spark, sf_dir):
    """Raw events as a stream of text files, routed to one folder per topic."""
    folder = shared_folder(configure(spark), "stream")
    d.raw_events(spark, sf_dir).select("value").write.text(f"{folder}/in")
    raw = spark.readStream.text(f"{folder}/in")
    query = streams.start_routing(raw, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    schema = "key string, value string, reasons array<string>, topic string"
    return spark.read.schema(schema).json(f"{folder}/out").select("topic", "key", "value")


def ties_from_text(spark, sf_dir):
    """Every event three times at one instant: twice in a row, and again in a later load.

    The first line to arrive tells the state; the others say something else.
    """
    folder = shared_folder(configure(spark), "text")
    events = d.flat_events(spark, sf_dir)

    def line(state: Column) -> Column:
        time = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        return F.to_json(
            F.struct(
                "intersection_id",
                F.struct(time.alias("timestamp")).alias("environment"),
                F.struct(
                    state.alias("current_signal_state"),
                    "avg_stop_duration_seconds",
                    "avg_vehicle_speed_kmh",
                ).alias("telemetry"),
            )
        )

    first = F.explode(F.array(line(F.col("signal_state")), line(F.lit("UNKNOWN"))))
    for lines in (first, line(F.lit("RED"))):
        events.select(lines.alias("value")).write.mode("append").text(f"{folder}/in")
    raw = read_text(spark, f"{folder}/in", ordered=True)
    flat = streams.flat_events(raw)
    return plain(windows.window_aggregate(flat, seq_col="seq", states=SIGNAL_STATES))


# --- Models --------------------------------------------------------------------------------


def staging(spark, sf_dir):
    return plain(models.staging(d.text_landing(spark, sf_dir)))


def core(spark, sf_dir):
    return plain(d.core(spark, sf_dir))


def core_points(spark, sf_dir):
    rows = d.core(spark, sf_dir)
    return plain(rows.select("intersection_id", "window_end", "spatial_geography_point"))


def core_inner(spark, sf_dir):
    rows = models.build_core(
        models.staging(d.landing(spark, sf_dir)), d.inventory(spark, sf_dir), on_missing="drop"
    )
    return plain(rows)


def core_merge(spark, sf_dir):
    """Core from a landing table that is loaded in two steps, refreshed after each."""
    folder = shared_folder(configure(spark), "core")
    places = d.inventory(spark, sf_dir)
    rows = d.landing(spark, sf_dir)
    early = F.col("window_end") < as_instant(CUT_WINDOW)
    for part in (rows.filter(early), rows.filter(~early)):
        landing_table.upsert_landing(part, f"{folder}/landing", unique=True)
        core_table.merge_core(spark, f"{folder}/landing", places, f"{folder}/core")
    return plain(core_table.read_core(spark, f"{folder}/core"))


def core_rebuild_then_merge(spark, sf_dir):
    """Merged with one inventory, rebuilt with another, merged with the first again."""
    folder = shared_folder(configure(spark), "core")
    places = d.inventory(spark, sf_dir)
    other = places.withColumn("display_name", F.concat("display_name", F.lit(" (old)")))
    landing_table.upsert_landing(d.landing(spark, sf_dir), f"{folder}/landing", unique=True)
    core_table.merge_core(spark, f"{folder}/landing", places, f"{folder}/core")
    core_table.rebuild_core(spark, f"{folder}/landing", other, f"{folder}/core")
    core_table.merge_core(spark, f"{folder}/landing", places, f"{folder}/core")
    return plain(core_table.read_core(spark, f"{folder}/core"))


def core_merge_late(spark, sf_dir):
    """Thirty days that reach landing out of order, with an inventory that changes in between."""
    folder = shared_folder(configure(spark), "core")
    places = d.inventory(spark, sf_dir)
    before = places.withColumn("latitude", F.col("latitude") + (F.col("osm_node_id") % 3 == 0).cast("int"))
    rows = d.daily_landing(spark, sf_dir)
    turn = F.dayofmonth("window_end") % 3
    for part, known in ((rows.filter(turn == 2), before), (rows.filter(turn != 2), before),
                        (rows.limit(0), places)):
        landing_table.upsert_landing(part, f"{folder}/landing", unique=True)
        core_table.merge_core(spark, f"{folder}/landing", known, f"{folder}/core")
    return plain(core_table.read_core(spark, f"{folder}/core"))


def landing_corrected(spark, sf_dir):
    """A folded log, a correction of the table, and one more fold, which must not undo it."""
    folder = shared_folder(configure(spark), "log")
    table, log = f"{folder}/landing", f"{folder}/log"
    rows = d.landing(spark, sf_dir)
    landing_table.append_versions(rows.withColumn("signal_state", F.lit("UNKNOWN")), 0, log)
    landing_table.fold_versions(spark, log, table)
    landing_table.upsert_landing(rows, table, unique=True)
    landing_table.fold_versions(spark, log, table)
    return plain(landing_table.read_live(spark, table, log))


def log_two_runs(spark, sf_dir):
    """Two streams with checkpoints of their own, each with a micro-batch 0, in one log."""
    log = shared_folder(configure(spark), "log")
    rows = d.landing(spark, sf_dir)
    odd = F.minute("window_end") % 2 == 1
    for run, part in (("one", rows.filter(odd)), ("two", rows.filter(~odd))):
        landing_table.append_versions(part, 0, log, run=run)
    return plain(landing_table.read_versions(spark, log))


def severe_bottlenecks(spark, sf_dir):
    rows = d.core(spark, sf_dir).filter("is_severe_bottleneck")
    return plain(
        rows.select(
            "intersection_id", "window_end", "avg_stop_duration_seconds", "avg_vehicle_speed_kmh"
        )
    )


def orphan_report(spark, sf_dir):
    staged = models.staging(d.landing(spark, sf_dir))
    return plain(models.orphan_report(staged, d.inventory(spark, sf_dir)))


def core_counts(spark, sf_dir):
    return plain(models.core_counts(d.core(spark, sf_dir)))


# --- Status --------------------------------------------------------------------------------


def _latest(spark: SparkSession, sf_dir: str, **thresholds: float) -> DataFrame:
    """Latest core rows. The window rows are reduced before the join: one row per id meets it."""
    staged = models.staging(d.landing(spark, sf_dir))
    return models.build_core(
        status.latest_status(staged), d.inventory(spark, sf_dir), **thresholds
    )


def _items(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return status.status_list(_latest(spark, sf_dir), d.inventory(spark, sf_dir), **options)


def latest_status(spark, sf_dir):
    return plain(status.latest_status(d.core(spark, sf_dir)))


def latest_advanced(spark, sf_dir):
    """Latest rows of the first half, stored, then moved on by the second half alone."""
    folder = shared_folder(configure(spark), "latest")
    rows = d.core(spark, sf_dir)
    early = F.col("window_end") < as_instant(CUT_WINDOW)
    status.latest_status(rows.filter(early)).write.parquet(folder)
    known = spark.read.parquet(folder)
    return plain(status.advance_latest(known, rows.filter(~early)))


def status_rows(spark, sf_dir):
    return plain(status.status_rows(_latest(spark, sf_dir)))


def status_list(spark, sf_dir):
    return plain(_items(spark, sf_dir))


def status_list_orphans(spark, sf_dir):
    return plain(_items(spark, sf_dir, include_orphans=True))


def status_list_plain(spark, sf_dir):
    """Without an inventory the latest rows are the list."""
    return plain(current_status(d.core(spark, sf_dir)))


def status_bottlenecks(spark, sf_dir):
    """With milder thresholds than the default, which few latest windows exceed."""
    latest = _latest(spark, sf_dir, min_stop=20.0, max_speed=30.0)
    return plain(status.status_list(latest, d.inventory(spark, sf_dir), bottleneck_only=True))


def status_by_id(spark, sf_dir):
    """Every customer number asked for as an intersection: a status row or NOT_FOUND."""
    asked = d.table(spark, sf_dir, "customer").select(
        d.device(F.col("c_custkey")).alias("intersection_id")
    )
    return plain(status.lookup_status(_items(spark, sf_dir), asked))


def status_of_one(spark, sf_dir):
    """One intersection, whose id is filtered ahead of all else."""
    return plain(status.status_by_id(d.core(spark, sf_dir), "osm-4", d.inventory(spark, sf_dir)))


def list_counts(spark, sf_dir):
    return status.list_counts(_items(spark, sf_dir))


def popup_measures(spark, sf_dir):
    return status.popup_measures(_items(spark, sf_dir))


def status_json(spark, sf_dir):
    """Texts are parsed back, so that the check is on fields and on which of them are left out."""
    value = F.col("value")
    return status.status_json(_items(spark, sf_dir)).select(
        "intersection_id",
        F.json_object_keys(value).cast("string").alias("fields"),
        F.get_json_object(value, "$.signal_state").alias("signal_state"),
        F.get_json_object(value, "$.window_end").alias("window_end"),
        F.round(F.get_json_object(value, "$.location.latitude").cast("double"), 6).alias(
            "latitude"
        ),
    )


def status_labels(spark, sf_dir):
    return status.status_labels(_items(spark, sf_dir))


def extent(spark, sf_dir):
    return plain(status.extent(_items(spark, sf_dir)))


def landing_lag(spark, sf_dir):
    return plain(status.landing_lag(d.landing(spark, sf_dir), as_of=d.FRESH_AS_OF))


def _health(spark, sf_dir, as_of, **options):
    """From staging, whose ids and windows are those of core; so the join is not needed."""
    staged = models.staging(d.landing(spark, sf_dir))
    return status.health(staged, d.inventory(spark, sf_dir), as_of=as_of, **options)


def health(spark, sf_dir):
    return plain(_health(spark, sf_dir, d.FRESH_AS_OF))


def health_stale(spark, sf_dir):
    return plain(_health(spark, sf_dir, d.STALE_AS_OF))


def health_contract(spark, sf_dir):
    return plain(_health(spark, sf_dir, d.STALE_AS_OF, contract=True))


def health_labels(spark, sf_dir):
    row = status.health_labels(_health(spark, sf_dir, d.FRESH_AS_OF))
    return plain(row.drop("status", "max_lag_seconds"))


def _bottlenecks(landing: DataFrame) -> DataFrame:
    """Ids whose latest window is a bottleneck by milder thresholds than the default."""
    stop, speed = F.col("avg_stop_duration_seconds"), F.col("avg_vehicle_speed_kmh")
    severe = severe_bottleneck(stop, speed, 20.0, 30.0)
    latest = status.latest_status(landing).filter(severe)
    return latest.select("intersection_id", "signal_state", "window_end")


def snapshot_diff_query(spark, sf_dir):
    """The list of bottlenecks as it was half way, against the list at the end."""
    rows = d.landing(spark, sf_dir)
    before = rows.filter(F.col("window_end") <= as_instant(CUT_WINDOW))
    diff = snapshot_diff(
        _bottlenecks(before), _bottlenecks(rows), "intersection_id", "signal_state", "window_end"
    )
    return plain(diff)


# --- Inventory -----------------------------------------------------------------------------


def inventory_from_extract(spark, sf_dir):
    """The signals of a map dump inside a box; the files are split at their elements."""
    path = shared_folder(configure(spark), "extract")
    d.map_document(spark, sf_dir).write.text(path)
    nodes = inv.elements(read_map_extract(spark, path))
    return plain(inv.inventory_from_elements(nodes, (-27.12, -52.1, -27.0, -52.0)))


def inventory_csv(spark, sf_dir):
    """The inventory as a file with its columns in another order."""
    path = shared_folder(configure(spark), "inventory")
    rows = d.inventory(spark, sf_dir)
    rows.select(*reversed(rows.columns)).write.option("header", True).csv(path)
    return plain(read_inventory(spark, path))


def inventory_in_bbox(spark, sf_dir):
    return plain(quality.inside_bbox(d.inventory(spark, sf_dir)))


def inventory_violations(spark, sf_dir):
    rows = validation.inventory_violations(d.faulty_inventory(spark, sf_dir))
    return rows.select(
        "intersection_id", "osm_node_id", F.concat_ws(",", "reasons").alias("reasons")
    )


# --- Quality -------------------------------------------------------------------------------


def dq_not_null(spark, sf_dir):
    return quality.null_counts(d.faulty_landing(spark, sf_dir), LANDING_REQUIRED)


def dq_report(spark, sf_dir):
    """All declared checks over tables with planted faults."""
    return quality_report(d.faulty_landing(spark, sf_dir), d.faulty_inventory(spark, sf_dir))


def dq_null_rows(spark, sf_dir):
    rows = quality.null_rows(d.faulty_inventory(spark, sf_dir), INVENTORY_REQUIRED)
    return rows.select(
        "intersection_id", "osm_node_id", F.concat_ws(",", "null_columns").alias("null_columns")
    )


def dq_accepted_values(spark, sf_dir):
    landing = d.faulty_landing(spark, sf_dir)
    places = d.faulty_inventory(spark, sf_dir)
    return (
        quality.unaccepted_values(landing, "signal_state", SIGNAL_STATES)
        .unionByName(quality.unaccepted_values(places, "source", INVENTORY_SOURCES))
    )


def dq_unique_grain(spark, sf_dir):
    return plain(quality.repeated_keys(d.faulty_landing(spark, sf_dir)))


def dq_unique_inventory(spark, sf_dir):
    return quality.repeated_keys(d.faulty_inventory(spark, sf_dir), ["intersection_id"])


def dq_freshness(spark, sf_dir):
    """By a clock four minutes after the newest load, which is a warning."""
    return plain(
        quality.source_freshness(d.landing(spark, sf_dir), as_of="2024-01-01 00:34:11")
    )


def dq_outside_bbox(spark, sf_dir):
    return plain(quality.outside_bbox(d.inventory(spark, sf_dir)))


def dq_point_roundtrip(spark, sf_dir):
    """Core points against an inventory with some latitudes spoiled."""
    spoiled = d.faulty_inventory(spark, sf_dir)
    return plain(quality.misplaced_points(d.core(spark, sf_dir), spoiled))


def silent_ids(spark, sf_dir):
    return quality.silent_ids(d.inventory(spark, sf_dir), d.flat_events(spark, sf_dir))


def rate_gaps(spark, sf_dir):
    return plain(quality.emission_gaps(d.flat_events(spark, sf_dir)))


def lag_p95(spark, sf_dir):
    """Loads with fractions of a second, by id."""
    number = F.substring_index("intersection_id", "-", -1).cast("bigint")
    micros = F.unix_micros("ingested_at") + number % 1000 * 1001
    landing = d.landing(spark, sf_dir).withColumn("ingested_at", F.timestamp_micros(micros))
    return plain(quality.window_lag_p95(landing))


def event_lag_p95(spark, sf_dir):
    return plain(
        quality.event_lag_p95(d.flat_events(spark, sf_dir), d.landing(spark, sf_dir))
    )


QUERIES: dict[str, Query] = {
    "event_verdicts": event_verdicts,
    "event_valid": event_valid,
    "event_dlq": event_dlq,
    "event_lines": event_lines,
    "invalid_rate": invalid_rate,
    "flatten_events": flatten_events,
    "dedup_events": dedup_events,
    "window_aggregate": window_aggregate,
    "last_state": last_state,
    "landing_rows": landing_rows,
    "landing_scan": landing_scan,
    "landing_upsert": landing_upsert,
    "landing_snapshot": landing_snapshot,
    "stream_window_aggregate": stream_window_aggregate,
    "log_reused_checkpoint": log_reused_checkpoint,
    "stream_restarts": stream_restarts,
    "stream_dedup": stream_dedup,
    "stream_late": stream_late,
    "stream_late_events": stream_late_events,
    "stream_latest": stream_latest,
    "stream_core": stream_core,
    "stream_core_versions": stream_core_versions,
    "stream_routing": stream_routing,
    "ties_from_text": ties_from_text,
    "staging": staging,
    "core": core,
    "core_points": core_points,
    "core_inner": core_inner,
    "core_merge": core_merge,
    "core_merge_late": core_merge_late,
    "core_rebuild_then_merge": core_rebuild_then_merge,
    "landing_corrected": landing_corrected,
    "log_two_runs": log_two_runs,
    "dedup_null_ids": dedup_null_ids,
    "inventory_csv": inventory_csv,
    "severe_bottlenecks": severe_bottlenecks,
    "orphan_report": orphan_report,
    "core_counts": core_counts,
    "latest_status": latest_status,
    "latest_advanced": latest_advanced,
    "status_rows": status_rows,
    "status_list": status_list,
    "status_list_orphans": status_list_orphans,
    "status_list_plain": status_list_plain,
    "status_bottlenecks": status_bottlenecks,
    "status_by_id": status_by_id,
    "status_of_one": status_of_one,
    "list_counts": list_counts,
    "popup_measures": popup_measures,
    "status_json": status_json,
    "status_labels": status_labels,
    "extent": extent,
    "landing_lag": landing_lag,
    "health": health,
    "health_stale": health_stale,
    "health_contract": health_contract,
    "health_labels": health_labels,
    "snapshot_diff": snapshot_diff_query,
    "inventory_from_extract": inventory_from_extract,
    "inventory_in_bbox": inventory_in_bbox,
    "inventory_violations": inventory_violations,
    "dq_not_null": dq_not_null,
    "dq_report": dq_report,
    "dq_null_rows": dq_null_rows,
    "dq_accepted_values": dq_accepted_values,
    "dq_unique_grain": dq_unique_grain,
    "dq_unique_inventory": dq_unique_inventory,
    "dq_freshness": dq_freshness,
    "dq_outside_bbox": dq_outside_bbox,
    "dq_point_roundtrip": dq_point_roundtrip,
    "silent_ids": silent_ids,
    "rate_gaps": rate_gaps,
    "lag_p95": lag_p95,
    "event_lag_p95": event_lag_p95,
}
