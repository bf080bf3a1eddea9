"""Streams from raw events to the landing log, to routed files and to topics.

The default output mode is *update*: a drained stream shows every window, open ones included,
and a window that changes is written again as a newer version. *append* writes a window once,
when the watermark has passed it, and never an open one.
"""

from __future__ import annotations

import functools
import json
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from signalmill.operators.events import drop_repeats, flatten_documents, usable
from signalmill.operators.models import build_core, staging
from signalmill.operators.validation import (
    is_valid,
    parse_documents,
    route_events,
    validate_events,
)
from signalmill.operators.windows import landing_rows, window_aggregate, window_partials
from signalmill.schemas import CORE, FLAT_EVENT, PARTIAL, TRIGGER, WATERMARK, WINDOW_LENGTH
from signalmill.sources import files
from signalmill.sources.events import observe_ingest
from signalmill.sources.inventory import current_version, read_inventory_version
from signalmill.sources.landing import append_versions, upsert_landing
from signalmill.sources.latest import upsert_latest


def flat_events(
    raw: DataFrame, *, strict: bool = False, observe: Observation | str = "ingest"
) -> DataFrame:
    """Flat events of raw text rows, for streams and batches.

    Text that is no usable event is left out instead of failing the job; the routing stream
    keeps it. ``strict`` also leaves out events that break the contract. What is left out is
    counted on the way under ``observe``, as ``event_count`` and ``invalid_count``.
    """
    keep = [c for c in ("seq",) if c in raw.columns]
    if strict:
        checked = observe_ingest(validate_events(raw), observe)
        return usable(flatten_documents(checked.filter(is_valid()), *keep))
    flat = flatten_documents(parse_documents(raw), *keep)
    missing = functools.reduce(operator.or_, (F.col(c).isNull() for c in FLAT_EVENT.fieldNames()))
    seen = flat.observe(
        observe,
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(missing).alias("invalid_count"),
    )
    return usable(seen)


def stream_windows(
    events: DataFrame,
    *,
    watermark: str = WATERMARK,
    length: str = WINDOW_LENGTH,
    states: Sequence[str] | None = None,
    dedup: bool = False,
) -> DataFrame:
    """Window rows of a stream of flat events; ``dedup`` drops repeated event ids first."""
    seq_col = "seq" if "seq" in events.columns else None
    if dedup:
        events = drop_repeats(events.withWatermark("event_timestamp", watermark))
        watermark = None
    return window_aggregate(
        events, length=length, seq_col=seq_col, states=states, watermark=watermark
    )


def stream_core(windows: DataFrame, inventory: DataFrame, ingested_at=None) -> DataFrame:
    """Live window rows joined to the inventory, in the shape of the core table."""
    return build_core(staging(landing_rows(windows, ingested_at)), inventory)


def _trigger(writer, continuous: bool, every: str):
    return writer.trigger(processingTime=every) if continuous else writer.trigger(availableNow=True)


def _start(
    rows: DataFrame, write, checkpoint: str, output_mode: str, continuous: bool, every: str
) -> StreamingQuery:
    writer = (
        rows.writeStream.outputMode(output_mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, continuous, every).start()


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to.

    It stays over restarts; a checkpoint that is deleted and begun anew gets another one, though
    its micro-batches are numbered from zero again.
    """
    text = files.read_small(spark, f"{checkpoint.rstrip('/')}/metadata")
    return json.loads(text)["id"]


def start_landing(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    sink: str = "log",
    output_mode: str = "update",
    ingested_at=None,
    continuous: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Write window rows to ``path``.

    ``sink="log"`` appends versions and suits any size; ``sink="table"`` merges each
    micro-batch into the landing table and suits a small one. Both may run a micro-batch twice
    without harm. Versions are filed under the query's id, whose micro-batches they are numbered by,
    so other streams may write the same log, also later ones with the same checkpoint folder. By default the stream drains what there is and ends;
    ``continuous`` keeps it running until it is stopped.
    """
    if sink not in ("log", "table"):
        raise ValueError(f"sink is 'log' or 'table', not {sink!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = landing_rows(batch, ingested_at)
        if sink == "log":
            append_versions(rows, batch_id, path, run=run_name(batch.sparkSession, checkpoint))
        else:
            upsert_landing(rows, path, unique=True)

    return _start(windows, write, checkpoint, output_mode, continuous, every)


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark, in milliseconds, by which a micro-batch tells late events.

    It is logged before the micro-batch runs and stays when that is repeated.
    """
    text = files.read_small(spark, f"{checkpoint.rstrip('/')}/offsets/{batch_id}")
    return int(json.loads(text.splitlines()[1])["batchWatermarkMs"])


def late_path(path: str) -> str:
    return f"{path.rstrip('/')}_late"


def start_partials(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    watermark: str = WATERMARK,
    length: str = WINDOW_LENGTH,
    ingested_at=None,
    continuous: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Write the partial windows of each micro-batch to a log, late events included.

    Nothing is dropped: windows add up over micro-batches in ``sources.partials``, which needs no
    state in the stream. The watermark only tells which events are late. Those, of windows that
    end at or before it, are kept apart as well, under ``late_path(path)``. A micro-batch that is
    repeated replaces its own files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_name(spark, checkpoint)
        behind = F.timestamp_millis(F.lit(batch_watermark(spark, checkpoint, batch_id)))
        batch = batch.persist()
        try:
            rows = window_partials(batch, behind=behind, length=length, ingested_at=ingested_at)
            append_versions(rows, batch_id, path, run=run, shape=PARTIAL)
            late = batch.filter(F.window("event_timestamp", length)["end"] <= behind)
            late = late.select([F.col(c) for c in batch.columns])
            folder = f"{late_path(path)}/run={run}/batch_id={batch_id}"
            late.write.mode("overwrite").parquet(folder)
        finally:
            batch.unpersist()

    marked = events.withWatermark("event_timestamp", watermark)
    return _start(marked, write, checkpoint, "append", continuous, every)


def start_latest(
    core: DataFrame,
    path: str,
    checkpoint: str,
    *,
    output_mode: str = "update",
    continuous: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Keep the latest row of every intersection from live core rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_latest(batch, path)

    return _start(core, write, checkpoint, output_mode, continuous, every)


def start_core(
    core: DataFrame,
    path: str,
    checkpoint: str,
    *,
    output_mode: str = "update",
    continuous: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Write live core rows to a version log, to be read with the shape of core."""

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_name(batch.sparkSession, checkpoint)
        append_versions(batch, batch_id, path, run=run, shape=CORE)

    return _start(core, write, checkpoint, output_mode, continuous, every)


def batch_inventory(spark: SparkSession, inventory: str, path: str, run: str, batch_id: int) -> DataFrame:
    """The version of the inventory that a micro-batch goes by: the current one when it first runs.

    It is noted beside the log ahead of the work, so a micro-batch that is repeated, which only
    the last one of a run can be, takes the same version again.
    """
    note = f"{path.rstrip('/')}_inventory/{run}.json"
    noted = json.loads(files.read_small(spark, note) or "{}")
    if noted.get("batch_id") != batch_id:
        noted = {"batch_id": batch_id, "version": current_version(spark, inventory)}
        files.replace_small(spark, note, json.dumps(noted))
    return read_inventory_version(spark, inventory, noted["version"])


def start_core_versions(
    windows: DataFrame,
    inventory: str,
    path: str,
    checkpoint: str,
    *,
    ingested_at=None,
    output_mode: str = "update",
    continuous: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Live core rows with an inventory that changes while the stream runs, to a version log.

    ``inventory`` is a folder of published versions; each micro-batch reads the current one, so a
    new version counts for the windows that are written after it, without a restart. Rows that
    were written before keep theirs until their window changes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_name(spark, checkpoint)
        places = batch_inventory(spark, inventory, path, run, batch_id)
        rows = build_core(staging(landing_rows(batch, ingested_at)), places)
        append_versions(rows, batch_id, path, run=run, shape=CORE)

    return _start(windows, write, checkpoint, output_mode, continuous, every)


def start_routing(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    *,
    servers: str | None = None,
    topic: str = "traffic-events",
    dead_letter_topic: str = "traffic-events-dlq",
    continuous: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Validate raw events and send each to its topic, or to a folder per topic.

    A bad event never ends the stream. The counts are in the query progress under ``ingest``.
    """
    checked = observe_ingest(validate_events(raw), "ingest")
    routed = route_events(checked, topic, dead_letter_topic)
    if servers:
        writer = (
            routed.select("topic", "key", "value")
            .writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
        )
    else:
        writer = routed.writeStream.format("json").partitionBy("topic").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(writer, continuous, every).start()


METRICS = "query_id string, batch_id long, consumed long, invalid long, late long"


class RunMetrics(StreamingQueryListener):
    """Rows read, rejected and dropped as late by each stream of a session, over its whole run.

    Every micro-batch is added as it ends, so that long runs lose none. ``late`` counts rows after
    the partial aggregate of their task; with a watermark that is too short it is above zero. With
    a ``path`` each micro-batch is filed there under its query and number as well, and a repeated
    one replaces its file: :func:`read_metrics` sums them over restarts.
    """

    def __init__(self, path: str | None = None):
        self._totals: dict[str, dict[str, int]] = {}
        self._path = path

    @classmethod
    def listen(cls, spark: SparkSession, path: str | None = None) -> RunMetrics:
        """Start before the streams whose metrics are wanted."""
        metrics = cls(path)
        spark.streams.addListener(metrics)
        return metrics

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = progress.observedMetrics.get("ingest")
        counts = {
            "consumed": progress.numInputRows,
            "invalid": 0 if observed is None else observed["invalid_count"],
            "late": sum(o.numRowsDroppedByWatermark for o in progress.stateOperators),
        }
        totals = self._totals.setdefault(str(progress.runId), _no_rows())
        for name, n in counts.items():
            totals[name] += n
        if self._path and any(counts.values()):
            row = {"query_id": str(progress.id), "batch_id": progress.batchId} | counts
            files.replace_small(
                SparkSession.getActiveSession() or SparkSession.builder.getOrCreate(),
                f"{self._path.rstrip('/')}/{progress.id}-{progress.batchId}.json",
                json.dumps(row),
            )

    def of(self, query: StreamingQuery) -> dict[str, int]:
        """Totals of a stream; those of an ended one are complete."""
        spark = SparkSession.getActiveSession()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return dict(self._totals.get(str(query.runId), _no_rows()))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Totals of each query that filed its metrics at ``path``, over all its runs."""
    rows = spark.read.schema(METRICS).json(path)
    counts = ("consumed", "invalid", "late")
    return rows.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in counts]
    )


def _no_rows() -> dict[str, int]:
    return {"consumed": 0, "invalid": 0, "late": 0}
