"""The batch jobs: ingest, events to landing, landing to core, core to status feed."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from signalmill.operators.models import build_core, orphan_report, staging
from signalmill.operators.quality import column_checks, key_check
from signalmill.operators.status import (
    advance_latest,
    latest_status,
    status_json,
    status_list,
)
from signalmill.operators.validation import route_events, validate_events
from signalmill.operators.windows import landing_rows, window_aggregate
from signalmill.schemas import (
    CORE,
    INVENTORY_REQUIRED,
    INVENTORY_SOURCES,
    LANDING_KEY,
    LANDING_REQUIRED,
    SIGNAL_STATES,
    require_shape,
)
from signalmill.sources.core import read_core, rebuild_core
from signalmill.sources.events import observe_ingest, write_routed
from signalmill.sources.landing import read_landing, upsert_landing
from signalmill.streaming.pipelines import flat_events


def ingest(raw: DataFrame, path: str, load: str = "all") -> dict[str, int]:
    """Validate and route raw events to files; returns the event and reject counts.

    The files belong to the ``load``, and another run of it replaces them.
    """
    counts = Observation("ingest")
    write_routed(route_events(observe_ingest(validate_events(raw), counts)), path, load)
    return dict(counts.get)


def events_to_landing(
    events: DataFrame, path: str, ingested_at=None, *, states: Sequence[str] | None = None
) -> int:
    """Aggregate flat events and merge them into the landing table; returns rows written.

    ``states`` lists the possible states where that is known, for the faster aggregate.
    """
    seq_col = "seq" if "seq" in events.columns else None
    windows = window_aggregate(events, seq_col=seq_col, states=states)
    return upsert_landing(landing_rows(windows, ingested_at), path, unique=True)


def payloads_to_landing(
    raw: DataFrame,
    path: str,
    ingested_at=None,
    *,
    strict: bool = False,
    observe: Observation | str = "ingest",
) -> int:
    """The same from JSON text rows; ``strict`` leaves out events that break the contract.

    ``observe`` counts the events, and those left out, on the way.
    """
    states = SIGNAL_STATES if strict else None
    events = flat_events(raw, strict=strict, observe=observe)
    return events_to_landing(events, path, ingested_at, states=states)


def build_warehouse(
    spark: SparkSession, landing_path: str, inventory: DataFrame, core_path: str
) -> DataFrame:
    """Rebuild the core table and return the orphan report as a lazy view."""
    staged = staging(read_landing(spark, landing_path))
    rebuild_core(spark, landing_path, inventory, core_path)
    report = orphan_report(staged, inventory)
    staged.createOrReplaceTempView("stg_traffic_signals")
    report.createOrReplaceTempView("rpt_orphan_intersections")
    return report


def refresh_latest(
    spark: SparkSession,
    core_path: str,
    out_path: str,
    *,
    previous: str | None = None,
    since: dt.date | None = None,
) -> None:
    """Store the latest row of every intersection in a new folder.

    With the ``previous`` folder only the days of core from ``since`` on are read, which a
    refresh of core returns as the first day it rebuilt.
    """
    if previous is None or since is None:
        rows = latest_status(read_core(spark, core_path))
    else:
        known = spark.read.schema(CORE).parquet(previous)
        rows = advance_latest(known, read_core(spark, core_path, since=since))
    require_shape(rows, CORE).write.mode("errorifexists").parquet(out_path)


def current_status(
    core: DataFrame, inventory: DataFrame | None = None, *, bottleneck_only: bool = False
) -> DataFrame:
    """The status list; an inventory without rows counts as none."""
    if inventory is not None and inventory.isEmpty():
        inventory = None
    return status_list(latest_status(core), inventory, bottleneck_only=bottleneck_only)


def quality_report(
    landing: DataFrame, inventory: DataFrame, core: DataFrame | None = None
) -> DataFrame:
    """Every declared check of the tables with its number of failures.

    One pass and one grouping per table; ``core`` is derived where it is not given.
    """
    staged = staging(landing)
    if core is None:
        core = build_core(staged, inventory)
    states = {"signal_state": SIGNAL_STATES}
    staged_columns = ("intersection_id", "window_end", "signal_state")
    reports = [
        column_checks(landing, "landing", LANDING_REQUIRED, states),
        key_check(landing, "landing", LANDING_KEY),
        column_checks(staged, "staging", staged_columns, states),
        column_checks(core, "core", ("is_severe_bottleneck",)),
        column_checks(inventory, "inventory", INVENTORY_REQUIRED, {"source": INVENTORY_SOURCES}),
        key_check(inventory, "inventory", ("intersection_id",)),
    ]
    return functools.reduce(DataFrame.unionByName, reports)


def write_status_feed(items: DataFrame, path: str) -> None:
    """The list as JSON lines in id order."""
    lines = status_json(items).orderBy("intersection_id").select("value")
    lines.write.mode("overwrite").text(path)
