"""Partial windows of streams that keep late events, and the fold that corrects landing by them.

A stream appends the partial windows of each micro-batch to a log. Sums may be added once only, so
the store of merged partials is kept by days in generations, and a manifest, replaced in one step,
names the generation of each day together with the micro-batches that are in it.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from signalmill.operators.windows import finished_windows, merge_partials
from signalmill.schemas import LANDING_KEY, PARTIAL
from signalmill.sources import files
from signalmill.sources.landing import (
    LOG_FOLDERS,
    clustered,
    folder_of,
    read_folders,
    upsert_landing,
    with_date,
)

STORED = T.StructType(PARTIAL.fields + [T.StructField("window_date", T.DateType())])


def _manifest_path(store: str) -> str:
    return f"{store.rstrip('/')}/_manifest.json"


def read_manifest(spark: SparkSession, store: str) -> dict:
    """generation, the generation of each day, and per day and run the last micro-batch in it."""
    text = files.read_small(spark, _manifest_path(store))
    return json.loads(text) if text else {"generation": 0, "days": {}, "marks": []}


def _day_folder(store: str, day: str, generation: int) -> str:
    return f"{store.rstrip('/')}/generation={generation}/window_date={day}"


def _stored(spark: SparkSession, store: str, days: dict[str, int]) -> DataFrame:
    if not days:
        return spark.createDataFrame([], PARTIAL)
    folders = [_day_folder(store, day, generation) for day, generation in days.items()]
    return spark.read.schema(PARTIAL).parquet(*folders)


def _new_versions(spark: SparkSession, log: str, manifest: dict, before: dt.date | None):
    marks = {(day, run): batch for day, run, batch in manifest["marks"]}
    found = [(d, r, int(b)) for d, r, b in files.partitions(spark, log, LOG_FOLDERS)]
    return sorted(
        (day, run, batch)
        for day, run, batch in found
        if batch > marks.get((day, run), -1)
        and (before is None or dt.date.fromisoformat(day) < before)
    )


def read_windows(spark: SparkSession, log: str, store: str) -> DataFrame:
    """All windows, late events included: what is folded and what is not yet, as one table.

    Only the days that the log still holds are merged; those that are folded whole are read as
    they are.
    """
    manifest = read_manifest(spark, store)
    versions = _new_versions(spark, log, manifest, None)
    open_days = {day for day, _, _ in versions}
    split = {True: {}, False: {}}
    for day, generation in manifest["days"].items():
        split[day in open_days][day] = generation
    logged = read_folders(spark, log, PARTIAL, versions).select(*PARTIAL.fieldNames())
    merged = merge_partials(_stored(spark, store, split[True]).unionByName(logged))
    return finished_windows(_stored(spark, store, split[False]).unionByName(merged))


def late_counts(spark: SparkSession, log: str, store: str) -> DataFrame:
    """Windows with late events and how many they have."""
    manifest = read_manifest(spark, store)
    logged = read_folders(spark, log, PARTIAL, _new_versions(spark, log, manifest, None))
    rows = _stored(spark, store, manifest["days"]).unionByName(logged.select(*PARTIAL.fieldNames()))
    late = rows.groupBy(*LANDING_KEY).agg(F.sum("late_count").alias("late_count"))
    return late.filter("late_count > 0")


def fold_partials(
    spark: SparkSession, log: str, store: str, landing: str, *, before: dt.date | None = None
) -> int:
    """Merge the log into the store and correct landing by each window it has; returns those.

    Only the days that the log holds are read and written, as a new generation. The manifest takes
    up generation and micro-batches at once, after landing has the rows: a fold that dies before
    is repeated from the same store, and adds nothing twice. Then folders that are merged or
    replaced are removed. One fold at a time; streams may go on writing.
    """
    manifest = read_manifest(spark, store)
    versions = _new_versions(spark, log, manifest, before)
    if versions:
        days = {day for day, _, _ in versions}
        known = {d: g for d, g in manifest["days"].items() if d in days}
        logged = read_folders(spark, log, PARTIAL, versions).select(*PARTIAL.fieldNames())
        generation = manifest["generation"] + 1
        path = f"{store.rstrip('/')}/generation={generation}"
        merged = with_date(merge_partials(_stored(spark, store, known).unionByName(logged)))
        clustered(merged).write.mode("overwrite").partitionBy("window_date").parquet(path)
        changed = _stored(spark, store, dict.fromkeys(days, generation)).join(
            logged.select(*LANDING_KEY).distinct(), list(LANDING_KEY), "left_semi"
        )
        rows = upsert_landing(finished_windows(changed), landing, unique=True)
        marks = {(day, run): batch for day, run, batch in manifest["marks"]}
        for day, run, batch in versions:
            marks[day, run] = max(batch, marks.get((day, run), -1))
        manifest = {
            "generation": generation,
            "days": manifest["days"] | dict.fromkeys(sorted(days), generation),
            "marks": [[day, run, batch] for (day, run), batch in sorted(marks.items())],
        }
        files.replace_small(spark, _manifest_path(store), json.dumps(manifest))
    else:
        rows = 0
    _remove_merged(spark, log, store, manifest)
    return rows


def _remove_merged(spark: SparkSession, log: str, store: str, manifest: dict) -> None:
    """Folders of the log that are merged, and of the store that the manifest does not name."""
    marks = {(day, run): batch for day, run, batch in manifest["marks"]}
    for day, run, batch in files.partitions(spark, log, LOG_FOLDERS):
        if int(batch) <= marks.get((day, run), -1):
            files.delete(spark, folder_of(log, (day, run, int(batch))))
    for generation, day in files.partitions(spark, store, ["generation", "window_date"]):
        if manifest["days"].get(day) != int(generation):
            files.delete(spark, _day_folder(store, day, int(generation)))
