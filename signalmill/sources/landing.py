"""The landing table: window rows by (id, window_end), stored by day.

Two ways to write it. A bounded batch is merged straight into the days it touches. A stream
must not rewrite a day every few seconds, so it appends versions to a log, and closed days are
folded into the table once. ``read_live`` shows both as one table.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from signalmill.operators.merge import latest_per_key, merge_rows
from signalmill.schemas import LANDING, LANDING_KEY, require_shape
from signalmill.sources import files

STORED = T.StructType(LANDING.fields + [T.StructField("window_date", T.DateType())])
# ``run`` names the stream that wrote a version, ``batch_id`` numbers its micro-batches.
LOG_KEYS = [
    T.StructField("window_date", T.DateType()),
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
]
LOG_FOLDERS = [field.name for field in LOG_KEYS]


def with_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("window_date", F.to_date("window_end"))


def ensure_table(spark: SparkSession, path: str, schema=STORED, by=("window_date",)) -> None:
    """Create the table if it is absent; an existing one is left alone."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*by).parquet(path)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Let SQL users read the table under a name; run again to show new days."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORED.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY (window_date) LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(name)


def read_landing(
    spark: SparkSession,
    path: str,
    *,
    intersection_id: str | None = None,
    since: dt.date | None = None,
) -> DataFrame:
    """Landing rows; ``since`` prunes days, the id reaches the scan. Sort on delivery only."""
    rows = spark.read.schema(STORED).parquet(path)
    if since is not None:
        rows = rows.filter(F.col("window_date") >= F.lit(since))
    if intersection_id is not None:
        rows = rows.filter(F.col("intersection_id") == intersection_id)
    return rows.select(*LANDING.fieldNames())


def newest_day(spark: SparkSession, path: str) -> dt.date | None:
    """The last day of the table, from the names of its folders; no file is opened."""
    days = files.partitions(spark, path, ["window_date"])
    return max((dt.date.fromisoformat(day) for (day,) in days), default=None)


def in_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(*LANDING_KEY)


def clustered(rows: DataFrame, by: Sequence[str] = ("window_date",)) -> DataFrame:
    """Rows laid out for a write partitioned by ``by``.

    The rebalance hint lets the adaptive planner split a big day over several tasks and join
    small ones, so neither one task per day nor a file per task and day results. Inside a file
    the rows are in key order, which makes the file statistics useful for lookups by id. A
    partitioned write sorts by its partitions anyhow, so the order costs no second sort.
    """
    return rows.hint("rebalance", *by).sortWithinPartitions(*by, *LANDING_KEY)


def replace_days(rows: DataFrame, path: str, by: Sequence[str] = ("window_date",)) -> None:
    """Overwrite exactly the partitions that ``rows`` holds."""
    (
        clustered(rows, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def on_days(rows: DataFrame, days: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows of a table by day on the given days.

    The first and last day prune the partitions; the days in between meet in a semi join, so that
    no list of days passes through the driver, however many a faulty clock makes.
    """
    day = F.col("window_date")
    near = rows.filter((day >= F.lit(first)) & (day <= F.lit(last)))
    return near.join(days.select("window_date"), "window_date", "left_semi").select(*rows.columns)


def changes_path(path: str) -> str:
    return f"{path.rstrip('/')}_changes"


CHANGES = T.StructType(
    [T.StructField("window_date", T.DateType()), T.StructField("change", T.StringType())]
)


def _note_changes(days: DataFrame, path: str) -> None:
    """Append the days that a load is about to change to the table's list of changes."""
    change = F.lit(uuid.uuid4().hex).alias("change")
    days.select("window_date", change).coalesce(1).write.mode("append").parquet(changes_path(path))


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """Every day that a load of the table changed, with the load; no rows if none is noted."""
    try:
        return spark.read.schema(CHANGES).parquet(changes_path(path))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CHANGES)


def upsert_landing(updates: DataFrame, path: str, *, unique: bool = False) -> int:
    """Insert or replace rows by key and return how many were written.

    Reads and rewrites only the days that occur in ``updates``, and notes them as changed. Running it again with the same
    rows changes nothing. Of several rows with one key the last ingested counts; ``unique``
    says there are none and saves that step. One writer at a time.
    """
    spark = updates.sparkSession
    updates = require_shape(updates, LANDING)
    if not unique:
        updates = latest_per_key(updates, LANDING_KEY, F.desc("ingested_at"))
    updates = with_date(updates).persist()
    try:
        days = updates.groupBy("window_date").agg(F.count(F.lit(1)).alias("rows"))
        first, last, rows = days.agg(F.min("window_date"), F.max("window_date"), F.sum("rows")).first()
        ensure_table(spark, path)
        if first is not None:
            # Noted ahead of the write: a day noted in vain is rebuilt in vain, none is missed.
            _note_changes(days, path)
            current = on_days(spark.read.schema(STORED).parquet(path), days, first, last)
            replace_days(merge_rows(current, updates, [*LANDING_KEY, "window_date"]), path)
        return rows or 0
    finally:
        updates.unpersist()


def merge_into(updates: DataFrame, table: str) -> None:
    """The same upsert on a catalog table whose format has row-level MERGE."""
    updates = require_shape(updates, LANDING)
    updates.createOrReplaceTempView("landing_updates")
    matches = " AND ".join(f"t.{k} = u.{k}" for k in LANDING_KEY)
    updates.sparkSession.sql(
        f"MERGE INTO {table} t USING landing_updates u ON {matches} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def append_versions(
    rows: DataFrame,
    batch_id: int,
    path: str,
    *,
    run: str = "0",
    shape: T.StructType = LANDING,
) -> None:
    """Write the rows of one micro-batch to the log.

    A repeated micro-batch replaces its own files, so a restart adds no rows twice; ``run`` keeps
    streams with different checkpoints apart. Nothing is read and no other file is touched.
    ``shape`` may be that of the core table.
    """
    versions = (
        with_date(require_shape(rows, shape))
        .withColumn("run", F.lit(run))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    )
    replace_days(versions, path, ("window_date", "run", "batch_id"))


def _log(spark: SparkSession, path: str, shape: T.StructType, *folders: str) -> DataFrame:
    schema = T.StructType(shape.fields + LOG_KEYS)
    return spark.read.schema(schema).option("basePath", path).parquet(*(folders or [path]))


def _marks_path(log_path: str) -> str:
    return f"{log_path.rstrip('/')}_folded.json"


def folded_marks(spark: SparkSession, log_path: str) -> dict[tuple[str, str], int]:
    """Per day and run the last micro-batch that a fold has merged."""
    text = files.read_small(spark, _marks_path(log_path))
    return {(day, run): batch for day, run, batch in json.loads(text or "[]")}


Version = tuple[str, str, int]


def folder_of(log_path: str, version: Version) -> str:
    day, run, batch = version
    return f"{log_path.rstrip('/')}/window_date={day}/run={run}/batch_id={batch}"


def unfolded_versions(
    spark: SparkSession, log_path: str, *, before: dt.date | None = None
) -> list[Version]:
    """Day, run and micro-batch of the log's folders that no fold has merged, by their names."""
    marks = folded_marks(spark, log_path)
    found = [(d, r, int(b)) for d, r, b in files.partitions(spark, log_path, LOG_FOLDERS)]
    return sorted(
        (day, run, batch)
        for day, run, batch in found
        if batch > marks.get((day, run), -1)
        and (before is None or dt.date.fromisoformat(day) < before)
    )


def unfolded(
    spark: SparkSession,
    log_path: str,
    shape: T.StructType = LANDING,
    *,
    before: dt.date | None = None,
) -> DataFrame:
    """The versions of the log that no fold has merged into the table; other folders are not listed."""
    return read_folders(spark, log_path, shape, unfolded_versions(spark, log_path, before=before))


def read_folders(
    spark: SparkSession, log_path: str, shape: T.StructType, versions: list[Version]
) -> DataFrame:
    """The rows of these versions of a log; no other folder is listed."""
    if not versions:
        return spark.createDataFrame([], T.StructType(shape.fields + LOG_KEYS))
    return _log(spark, log_path, shape, *(folder_of(log_path, v) for v in versions))


def _newest(log: DataFrame, shape: T.StructType) -> DataFrame:
    """The newest version of each key: by load time, then by number and run."""
    order = [F.desc_nulls_last("ingested_at"), F.desc("batch_id"), F.desc("run")]
    newest = latest_per_key(log, [*LANDING_KEY, "window_date"], *order)
    return newest.select(*shape.fieldNames())


def read_versions(
    spark: SparkSession,
    path: str,
    *,
    before: dt.date | None = None,
    shape: T.StructType = LANDING,
) -> DataFrame:
    """The newest version of every key in the log."""
    log = _log(spark, path, shape)
    if before is not None:
        log = log.filter(F.col("window_date") < F.lit(before))
    return _newest(log, shape)


def read_live(spark: SparkSession, path: str, log_path: str) -> DataFrame:
    """Table and log as one: a logged row hides the stored one of the same key.

    A version that is already folded is not read: what the table holds since then counts. Only
    the days between the first and the last one logged are merged.
    """
    stored = spark.read.schema(STORED).parquet(path)
    columns = LANDING.fieldNames()
    log = unfolded(spark, log_path)
    first, last = log.agg(F.min("window_date"), F.max("window_date")).first()
    if first is None:
        return stored.select(*columns)
    day = F.col("window_date")
    logged = (day >= F.lit(first)) & (day <= F.lit(last))
    merged = merge_rows(stored.filter(logged).select(*columns), _newest(log, LANDING))
    return stored.filter(~logged).select(*columns).unionByName(merged)


def fold_versions(
    spark: SparkSession, log_path: str, path: str, *, before: dt.date | None = None
) -> int:
    """Merge the log into the table, only the days ahead of ``before`` if it is given.

    A file beside the log, replaced in one step, marks for each day and run the last micro-batch
    that is merged; what it marks is not read again, so a later correction of the table stays and
    a repeated fold changes nothing. A fold that dies before its mark is repeated without harm.
    Folders of marked versions are removed, also those that a fold which died left behind. One
    fold at a time; streams may go on writing.
    """
    versions = unfolded_versions(spark, log_path, before=before)
    rows = 0
    if versions:
        log = read_folders(spark, log_path, LANDING, versions)
        rows = upsert_landing(_newest(log, LANDING), path, unique=True)
    mark_folded(spark, log_path, versions)
    return rows


def mark_folded(spark: SparkSession, log_path: str, versions: list[Version]) -> None:
    """Note that these versions are merged, and remove their folders.

    Micro-batches of a run end in turn, so only its last one may be written once more. Marks are
    kept for the last one of each run, the earlier ones go with their folders.
    """
    marks = folded_marks(spark, log_path)
    for day, run, batch in versions:
        marks[day, run] = max(batch, marks.get((day, run), -1))
    if versions:
        text = json.dumps([[day, run, batch] for (day, run), batch in sorted(marks.items())])
        files.replace_small(spark, _marks_path(log_path), text)
    for day, run, batch in files.partitions(spark, log_path, LOG_FOLDERS):
        if int(batch) <= marks.get((day, run), -1):
            files.delete(spark, folder_of(log_path, (day, run, int(batch))))
    found = files.partitions(spark, log_path, LOG_FOLDERS)
    last: dict[str, int] = {}
    for run, batch in [(r, int(b)) for _, r, b in found] + [(r, b) for (_, r), b in marks.items()]:
        last[run] = max(batch, last.get(run, -1))
    there = {(day, run) for day, run, _ in found}
    kept = [
        [*key, batch]
        for key, batch in sorted(marks.items())
        if batch == last[key[1]] or key in there
    ]
    if len(kept) < len(marks):
        files.replace_small(spark, _marks_path(log_path), json.dumps(kept))
