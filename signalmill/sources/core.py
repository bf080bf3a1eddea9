"""The core table, stored by day."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from signalmill.operators.models import build_core, staging
from signalmill.schemas import CORE, INVENTORY, require_shape
from signalmill.sources.landing import (
    CHANGES,
    STORED as LANDING_STORED,
    clustered,
    on_days,
    read_changes,
    replace_days,
    with_date,
)

STORED = T.StructType(CORE.fields + [T.StructField("window_date", T.DateType())])
# What a merge that found nothing to do returns as its first day: no day is as late.
NO_DAY = dt.date.max
PLACE = ("intersection_id", "display_name", "latitude", "longitude")


def replace_core(core: DataFrame, path: str) -> None:
    """Full replace. The table is derived, so an aborted replace is repaired by another."""
    rows = clustered(with_date(require_shape(core, CORE)))
    rows.write.mode("overwrite").partitionBy("window_date").parquet(path)


def save_core_table(core: DataFrame, table: str) -> None:
    """Full replace of a catalog table."""
    rows = clustered(with_date(require_shape(core, CORE)))
    rows.write.mode("overwrite").partitionBy("window_date").saveAsTable(table)


def read_core(spark: SparkSession, path: str, *, since: dt.date | None = None) -> DataFrame:
    rows = spark.read.schema(STORED).parquet(path)
    if since is not None:
        rows = rows.filter(F.col("window_date") >= F.lit(since))
    return rows.select(*CORE.fieldNames())


def _known(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _moved(inventory: DataFrame, before: DataFrame) -> DataFrame:
    """Ids whose entry is new, gone or another than before in what core takes from it."""
    now, then = inventory.select(*PLACE), before.select(*PLACE)
    changed = now.exceptAll(then).unionByName(then.exceptAll(now))
    return changed.select("intersection_id").distinct()


def rebuild_core(
    spark: SparkSession, landing_path: str, inventory: DataFrame, path: str
) -> None:
    """Replace the table by core of all landing rows, and note loads and inventory as merged.

    The notes are what :func:`merge_core` goes by, so a merge after a rebuild starts from it. A
    load that is noted while the rebuild runs is merged by the next one.
    """
    base = path.rstrip("/")
    changes = read_changes(spark, landing_path).persist()
    inventory = inventory.select(*INVENTORY.fieldNames()).persist()
    try:
        changes.count()
        landing = spark.read.schema(LANDING_STORED).parquet(landing_path).drop("window_date")
        replace_core(build_core(staging(landing), inventory), path)
        changes.coalesce(1).write.mode("overwrite").parquet(f"{base}_merged")
        inventory.coalesce(1).write.mode("overwrite").parquet(f"{base}_places")
    finally:
        changes.unpersist()
        inventory.unpersist()


def merge_core(
    spark: SparkSession,
    landing_path: str,
    inventory: DataFrame,
    path: str,
    *,
    since: dt.date | None = None,
) -> dt.date | None:
    """Rebuild the days of the core table that changed and return the first of them.

    A core row depends on one landing row and one inventory entry. So the days to rebuild are
    those that loads of the landing table noted since the last merge into ``path``, however late,
    and those that hold an intersection whose inventory entry changed since then. Rebuilding a day
    whole equals merging its rows by key, and doing it twice changes nothing. ``since`` adds all
    days from it on. Without a core table everything is built and None returned; with nothing
    changed ``NO_DAY`` is.

    Beside the table lie the loads merged and the inventory used; they are written last, so a
    merge that dies is repeated.
    """
    base = path.rstrip("/")
    merged_path, places_path = f"{base}_merged", f"{base}_places"
    landing = spark.read.schema(LANDING_STORED).parquet(landing_path)
    inventory = inventory.select(*INVENTORY.fieldNames()).persist()
    changes = read_changes(spark, landing_path)
    done = _known(spark, merged_path, CHANGES)
    if done is not None:
        changes = changes.join(done.select("change").distinct(), "change", "left_anti")
    changes = changes.select(*CHANGES.fieldNames()).persist()
    try:
        changes.count()  # what is merged and what is marked must be the same loads
        places = _known(spark, places_path, INVENTORY)
        first = None
        if _known(spark, path, STORED) is not None:
            days = changes.select("window_date")
            if places is not None:
                moved = _moved(inventory, places)
                if not moved.isEmpty():
                    held = landing.join(moved, "intersection_id", "left_semi")
                    days = days.unionByName(held.select("window_date"))
            if since is not None:
                late = landing.filter(F.col("window_date") >= F.lit(since))
                days = days.unionByName(late.select("window_date"))
            days = days.distinct().persist()
            first, last = days.agg(F.min("window_date"), F.max("window_date")).first()
            if first is None:
                return NO_DAY
            landing = on_days(landing, days, first, last)
        rows = build_core(staging(landing.drop("window_date")), inventory)
        replace_days(with_date(require_shape(rows, CORE)), path)
        changes.coalesce(1).write.mode("append").parquet(merged_path)
        inventory.coalesce(1).write.mode("overwrite").parquet(places_path)
        return first
    finally:
        changes.unpersist()
        inventory.unpersist()
