import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import DROP, at, event, events, inventory, texts, tuples
from signalmill.operators.events import drop_repeats
from signalmill.operators.windows import landing_rows, window_aggregate
from signalmill.schemas import CORE, SIGNAL_STATES, same_shape
from signalmill.sources import events as source
from signalmill.sources import landing as table
from signalmill.streaming import pipelines as s

LOAD = "2026-06-05T19:00:00Z"


def reading(key, when, state="RED", stop=10.0, **more):
    return json.dumps(
        event(
            intersection_id=key,
            environment__timestamp=f"2026-06-05T{when}Z",
            telemetry__current_signal_state=state,
            telemetry__avg_stop_duration_seconds=stop,
            **more,
        )
    )


class Feed:
    """A folder of one-file micro-batches."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root, self.count = spark, tmp_path, 0
        (tmp_path / "in").mkdir()

    def add(self, *lines):
        path = self.root / "in" / f"{self.count:03d}.json"
        path.write_text("\n".join(lines) + "\n")
        # The file source takes files in order of their times.
        stamp = time.time() - 1000 + self.count
        import os

        os.utime(path, (stamp, stamp))
        self.count += 1
        return self

    def raw(self):
        return source.stream_text(self.spark, str(self.root / "in"), files_per_trigger=1)

    def drain(self, name="log", wait=True, **options):
        stream = {k: options.pop(k) for k in ("dedup", "states", "watermark") if k in options}
        query = s.start_landing(
            s.stream_windows(s.flat_events(self.raw()), **stream),
            str(self.root / name),
            str(self.root / f"{name}-checkpoint"),
            ingested_at=LOAD,
            **options,
        )
        if wait:
            query.awaitTermination()
        return query

    def versions(self, name="log"):
        return table.read_versions(self.spark, str(self.root / name))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def fill(feed):
    feed.add(reading("a", "18:00:10"), reading("b", "18:00:59", "GREEN"))
    feed.add(reading("a", "18:00:50", "GREEN", 30.0), "{broken")
    feed.add(reading("a", "18:01:00", "YELLOW"), reading("c", "18:01:30", "FLASHING_YELLOW"))


@pytest.mark.parametrize("states", [None, SIGNAL_STATES])
def test_drained_stream_equals_the_batch(spark, feed, states):
    fill(feed)
    feed.drain(states=states)
    raw = source.read_text(spark, str(feed.root / "in"))
    batch = landing_rows(window_aggregate(s.flat_events(raw), states=states), LOAD)
    assert tuples(feed.versions()) == tuples(batch)
    assert len(tuples(batch)) == 4


def test_restart_adds_nothing_and_new_files_replace_open_windows(spark, feed):
    fill(feed)
    feed.drain()
    before = tuples(feed.versions())
    logged = spark.read.parquet(str(feed.root / "log")).count()
    metrics = s.RunMetrics.listen(spark)
    assert metrics.of(feed.drain())["consumed"] == 0
    assert spark.read.parquet(str(feed.root / "log")).count() == logged
    feed.add(reading("a", "18:01:40", "RED", 30.0))
    feed.drain()
    after = tuples(feed.versions())
    changed = [r for r in after if r not in before]
    assert changed == [("a", at("18:02:00"), "RED", 20.0, 26.75, 2, at("19:00:00"))]
    assert len(after) == len(before)


def test_both_sinks_hold_the_same_rows(spark, feed):
    fill(feed)
    feed.drain()
    feed.drain("table", sink="table")
    want = tuples(feed.versions())
    assert tuples(table.read_landing(spark, str(feed.root / "table"))) == want
    table.fold_versions(spark, str(feed.root / "log"), str(feed.root / "folded"))
    assert tuples(table.read_landing(spark, str(feed.root / "folded"))) == want
    assert tuples(feed.versions()) == []  # a fold removes what it has merged
    with pytest.raises(ValueError):
        feed.drain("x", sink="other")


def test_append_mode_leaves_open_windows_out(spark, feed):
    fill(feed)
    feed.drain("once", output_mode="append")
    got = tuples(feed.versions("once"), "intersection_id", "window_end", "event_count")
    assert got == [("a", at("18:01:00"), 2), ("b", at("18:01:00"), 1)]


def test_late_rows_are_dropped_after_the_watermark(spark, feed):
    """The rows of a batch meet the watermark of the batch before, hence five files."""
    feed.add(reading("a", "18:00:10"))
    feed.add(reading("a", "18:10:00"))
    feed.add(reading("a", "18:10:01"))
    feed.add(reading("a", "18:00:20", "GREEN"))
    feed.add(reading("a", "18:10:02", "GREEN"))
    run = s.RunMetrics.listen(spark)
    query = feed.drain()
    got = tuples(feed.versions(), "window_end", "signal_state", "event_count")
    assert got == [(at("18:01:00"), "RED", 1), (at("18:11:00"), "GREEN", 3)]
    metrics = run.of(query)
    assert metrics["consumed"] == 5 and metrics["late"] == 1
    feed.drain("patient", watermark="1 hour")
    assert ("RED", 1) not in tuples(feed.versions("patient"), "signal_state", "event_count")


def test_repeated_event_ids_count_once_on_request(spark, feed):
    one = "7c1d52ab-03f6-4e18-9b7a-5d20c6e4f811"
    two = "7c1d52ab-03f6-4e18-9b7a-5d20c6e4f812"
    feed.add(reading("a", "18:00:10", event_id=one), reading("a", "18:00:10", event_id=one))
    feed.add(reading("a", "18:00:10", event_id=one), reading("a", "18:00:20", event_id=two))
    feed.drain("all")
    feed.drain("distinct", dedup=True)
    assert tuples(feed.versions("all"), "event_count") == [(4,)]
    assert tuples(feed.versions("distinct"), "event_count") == [(2,)]


def test_events_without_id_are_no_repeats(spark, feed):
    rows = [reading(k, "18:00:10", event_id=DROP) for k in "abcde"]
    feed.add(*rows)
    feed.drain("distinct", dedup=True)
    assert tuples(feed.versions("distinct"), "event_count") == [(1,)] * 5
    flat = s.flat_events(texts(spark, *[json.loads(x) if isinstance(x, str) else x for x in rows]))
    assert drop_repeats(flat).count() == 5
    assert drop_repeats(flat.drop("seq")).count() == 5


def test_running_stream_can_be_stopped(spark, feed):
    fill(feed)
    query = feed.drain(wait=False, continuous=True, every="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert len(tuples(feed.versions())) == 4


def test_routing_stream(spark, feed):
    feed.add(reading("a", "18:00:10"), "{broken")
    feed.add(reading("b c", "18:00:10"), reading("d", "18:00:10"))
    root = str(feed.root)
    metrics = s.RunMetrics.listen(spark)
    query = s.start_routing(feed.raw(), root + "/out", root + "/out-checkpoint")
    query.awaitTermination()
    out = spark.read.json(root + "/out")
    assert tuples(out, "topic", "key") == [
        ("traffic-events", "a"),
        ("traffic-events", "d"),
        ("traffic-events-dlq", "b c"),
        ("traffic-events-dlq", "unknown"),
    ]
    assert metrics.of(query) == {"consumed": 4, "invalid": 2, "late": 0}


def test_strict_events_leave_out_what_breaks_the_contract(spark):
    rows = texts(spark, event(), event(event_id="x"), event(telemetry={}), "{")
    assert s.flat_events(rows).count() == 2
    assert s.flat_events(rows, strict=True).count() == 1


def test_live_core(spark, feed):
    fill(feed)
    live = s.stream_core(
        s.stream_windows(s.flat_events(feed.raw())), inventory(spark, "a", "c"), LOAD
    )
    assert same_shape(live.schema, CORE) == []
    root = str(feed.root)
    s.start_core(live, root + "/core", root + "/core-checkpoint").awaitTermination()
    got = table.read_versions(spark, root + "/core", shape=CORE)
    assert tuples(got, "intersection_id", "display_name", "window_end", "event_count") == [
        ("a", "Crossing a", at("18:01:00"), 2),
        ("a", "Crossing a", at("18:02:00"), 1),
        ("b", None, at("18:01:00"), 1),
        ("c", "Crossing c", at("18:02:00"), 1),
    ]


def test_bounded_reads_and_topic_options(spark, feed, tmp_path):
    fill(feed)
    assert source.read_text(spark, str(feed.root / "in")).count() == 6
    options = source.topic_options("h:1", "t")
    assert options["startingOffsets"] == "latest" and options["subscribe"] == "t"
    assert source.topic_options("h:1", earliest=True)["startingOffsets"] == "earliest"
    busy = source.topic_options("h:1", min_partitions=400, max_per_trigger=1000)
    assert (busy["minPartitions"], busy["maxOffsetsPerTrigger"]) == ("400", "1000")
    records = spark.createDataFrame(
        [(bytearray(b"k"), bytearray("é".encode()), 7)], "key binary, value binary, offset bigint"
    )
    assert tuples(source.topic_rows(records)) == [("k", "é", 7)]
    source.write_lines(records.select(F.lit("x").alias("value")), str(tmp_path / "lines"))
    assert Path(tmp_path / "lines").exists()


def test_arrival_order_decides_ties_in_a_stream(spark):
    rows = events(spark, ("a", "18:00:10", "RED", 1.0, 1.0), ("a", "18:00:10", "GREEN", 1.0, 1.0))
    assert tuples(s.stream_windows(rows), "signal_state") == [("RED",)]
