"""Tables by day whose days are replaced all at once: readers see them before a write or after it.

A write puts the days that it changes beside the old ones, in a folder of its own, and then swaps
the manifest, one small file that names the folder of each day. A writer that dies ahead of the
swap has changed nothing; what it left is removed by the next write. Folders that a swap replaces
stay until the next one, for readers that hold the manifest before. One writer at a time; that no
other came between is checked at the swap.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from typing import TypedDict

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from signalmill.operators.merge import latest_per_key, merge_rows
from signalmill.schemas import LANDING, LANDING_KEY, require_shape
from signalmill.sources import files
from signalmill.sources.landing import clustered, with_date


class Manifest(TypedDict):
    """version, the folder of each day, and the folder of each day one version before."""

    version: int
    days: dict[str, str]
    before: dict[str, str]


def _manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest.json"


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    text = files.read_small(spark, _manifest_path(path))
    return json.loads(text) if text else {"version": 0, "days": {}, "before": {}}


def _day_folder(path: str, day: str, load: str) -> str:
    return f"{path.rstrip('/')}/load={load}/window_date={day}"


def _read_days(
    spark: SparkSession, path: str, days: dict[str, str], shape: T.StructType
) -> DataFrame:
    if not days:
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).parquet(
        *(_day_folder(path, day, load) for day, load in sorted(days.items()))
    )


def read_snapshot(
    spark: SparkSession,
    path: str,
    *,
    since: dt.date | None = None,
    shape: T.StructType = LANDING,
) -> DataFrame:
    """The rows of the current version, from day ``since`` on; no other folder is listed.

    A table that was never written has no rows. The frame stays readable over one later write.
    """
    days = read_manifest(spark, path)["days"]
    if since is not None:
        days = {day: load for day, load in days.items() if dt.date.fromisoformat(day) >= since}
    return _read_days(spark, path, days, shape)


def snapshot_days(spark: SparkSession, path: str) -> list[dt.date]:
    """The days of the table, from its manifest alone."""
    return sorted(map(dt.date.fromisoformat, read_manifest(spark, path)["days"]))


def _write_load(rows: DataFrame, path: str) -> dict[str, str]:
    """Write rows with their ``window_date`` beside the table; the folder of each day written."""
    load = uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/load={load}"
    clustered(rows).write.partitionBy("window_date").parquet(folder)
    return {day: load for (day,) in files.partitions(rows.sparkSession, folder, ["window_date"])}


def _swap(spark: SparkSession, path: str, old: Manifest, days: dict[str, str]) -> int:
    """Make ``days`` the table, and remove what neither it nor the version before names."""
    if read_manifest(spark, path)["version"] != old["version"]:
        raise RuntimeError(f"another writer changed {path}; nothing was written, repeat the load")
    new: Manifest = {"version": old["version"] + 1, "days": days, "before": old["days"]}
    files.replace_small(spark, _manifest_path(path), json.dumps(new))
    named = {(load, day) for named in (days, old["days"]) for day, load in named.items()}
    loads = {load for load, _ in named}
    for (load,) in files.partitions(spark, path, ["load"]):
        if load not in loads:
            files.delete(spark, f"{path.rstrip('/')}/load={load}")
    for load, day in files.partitions(spark, path, ["load", "window_date"]):
        if (load, day) not in named:
            files.delete(spark, _day_folder(path, day, load))
    return new["version"]


def replace_snapshot(rows: DataFrame, path: str, *, shape: T.StructType = LANDING) -> int:
    """Replace the whole table; returns its version. Days that ``rows`` lacks are gone."""
    spark = rows.sparkSession
    old = read_manifest(spark, path)
    return _swap(spark, path, old, _write_load(with_date(require_shape(rows, shape)), path))


def upsert_snapshot(
    updates: DataFrame, path: str, *, unique: bool = False, shape: T.StructType = LANDING
) -> int:
    """Insert or replace rows by key; returns the version of the table, the old one without rows.

    Only the days of ``updates`` are read and written. The same rows again change nothing but the
    version. Of several rows with one key the last ingested counts; ``unique`` says there are none.
    """
    spark = updates.sparkSession
    updates = require_shape(updates, shape)
    if not unique:
        updates = latest_per_key(updates, LANDING_KEY, F.desc("ingested_at"))
    updates = with_date(updates).persist()
    try:
        old = read_manifest(spark, path)
        # No more days than the manifest will list.
        touched = {str(r.window_date) for r in updates.select("window_date").distinct().collect()}
        if not touched:
            return old["version"]
        held = {day: load for day, load in old["days"].items() if day in touched}
        rows = updates
        if held:
            rows = merge_rows(with_date(_read_days(spark, path, held, shape)), updates)
        return _swap(spark, path, old, old["days"] | _write_load(rows, path))
    finally:
        updates.unpersist()
