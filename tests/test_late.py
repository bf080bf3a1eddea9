"""Late events, reused checkpoints and folds that die, over files in several micro-batches."""

import datetime as dt
import re
import shutil

import pytest
from helpers import at, inventory, landing, tuples
from test_streams import Feed, fill, reading

from signalmill.operators import models, status
from signalmill.operators.windows import landing_rows, window_aggregate
from signalmill.plans import jobs
from signalmill.sources import core as core_table
from signalmill.sources import events as source
from signalmill.sources import files
from signalmill.sources import landing as table
from signalmill.sources import latest as latest_table
from signalmill.sources import partials
from signalmill.streaming import pipelines as s

LOAD = "2026-06-05T19:00:00Z"
DAYS = ("2026-06-05 18:01:00", "2026-06-06 18:01:00")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def row(key, end, state="RED"):
    return (key, end, state, 10.0, 20.0, 2, "18:05:00")


def out_of_order(feed):
    feed.add(reading("a", "18:00:10"), reading("b", "18:30:00", "GREEN"))
    feed.add(reading("a", "18:31:00"))
    feed.add(reading("a", "18:00:50", "GREEN", 30.0), reading("c", "18:31:10"))
    feed.add(reading("a", "18:00:05", "YELLOW", 50.0))
    feed.add(reading("b", "17:00:00"), reading("b", "18:30:40", "RED"))


def drain(feed):
    events = s.flat_events(feed.raw())
    root = str(feed.root)
    query = s.start_partials(events, f"{root}/log", f"{root}/ck", ingested_at=LOAD)
    query.awaitTermination()
    return f"{root}/log", f"{root}/store", f"{root}/landing"


def as_batch(feed):
    raw = source.read_text(feed.spark, str(feed.root / "in"))
    return tuples(landing_rows(window_aggregate(s.flat_events(raw)), LOAD))


def test_late_events_are_kept_and_correct_landing(spark, feed):
    out_of_order(feed)
    log, store, path = drain(feed)
    want = as_batch(feed)
    assert tuples(partials.read_windows(spark, log, store)) == want
    late = spark.read.parquet(s.late_path(log))
    assert tuples(late, "intersection_id", "event_timestamp") == [
        ("a", at("18:00:05")), ("a", at("18:00:50")), ("b", at("17:00:00")), ("b", at("18:30:40")),
    ]
    counted = tuples(partials.late_counts(spark, log, store), "intersection_id", "late_count")
    assert counted == [("a", 2), ("b", 1), ("b", 1)]
    assert partials.fold_partials(spark, log, store, path) == len(want)
    assert tuples(table.read_landing(spark, path)) == want
    assert tuples(partials.read_windows(spark, log, store)) == want
    again = partials.late_counts(spark, log, store)
    assert tuples(again, "intersection_id", "late_count") == counted


def test_folds_between_loads_add_nothing_twice(spark, feed):
    for lines in ([reading("a", "18:00:10")], [reading("a", "18:00:20", "GREEN", 20.0)],
                  [reading("a", "18:40:00")], [reading("a", "18:00:01", "RED", 60.0)]):
        feed.add(*lines)
        log, store, path = drain(feed)
        drain(feed)
        partials.fold_partials(spark, log, store, path)
        assert partials.fold_partials(spark, log, store, path) == 0
        assert tuples(table.read_landing(spark, path)) == as_batch(feed)
        assert files.partitions(spark, log, table.LOG_FOLDERS) == []
    generations = files.partitions(spark, store, ["generation", "window_date"])
    assert generations == [("4", "2026-06-05")]


def test_a_fold_that_dies_is_repeated(spark, feed, monkeypatch):
    out_of_order(feed)
    log, store, path = drain(feed)
    replace = files.replace_small

    def die(*args):
        raise OSError("gone")

    monkeypatch.setattr(files, "replace_small", die)
    with pytest.raises(OSError):
        partials.fold_partials(spark, log, store, path)
    assert tuples(partials.read_windows(spark, log, store)) == as_batch(feed)
    monkeypatch.setattr(files, "replace_small", replace)
    partials.fold_partials(spark, log, store, path)
    assert tuples(table.read_landing(spark, path)) == as_batch(feed)
    feed.add(reading("a", "18:00:59", "UNKNOWN"))
    drain(feed)
    partials.fold_partials(spark, log, store, path, before=dt.date(2026, 6, 5))
    assert tuples(partials.read_windows(spark, log, store)) == as_batch(feed)


def test_a_checkpoint_begun_anew_is_another_run(spark, feed):
    root = str(feed.root)
    fill(feed)
    feed.drain()
    first = s.run_name(spark, f"{root}/log-checkpoint")
    table.fold_versions(spark, f"{root}/log", f"{root}/l")
    feed.drain()
    assert s.run_name(spark, f"{root}/log-checkpoint") == first
    shutil.rmtree(f"{root}/log-checkpoint")
    feed.add(reading("a", "18:07:00"))
    feed.drain()
    assert s.run_name(spark, f"{root}/log-checkpoint") != first
    want = as_batch(feed)
    assert tuples(table.read_live(spark, f"{root}/l", f"{root}/log")) == want
    table.fold_versions(spark, f"{root}/log", f"{root}/l")
    assert tuples(table.read_landing(spark, f"{root}/l")) == want


def test_only_unfolded_folders_are_listed_and_folded_ones_go(spark, folder, monkeypatch):
    path, log = folder + "/l", folder + "/log"
    table.append_versions(landing(spark, row("a", DAYS[0])), 0, log, run="r")
    table.append_versions(landing(spark, row("a", DAYS[1])), 1, log, run="r")
    with monkeypatch.context() as m:
        m.setattr(files, "delete", lambda *_: None)  # dies ahead of the removal
        assert table.fold_versions(spark, log, path, before=dt.date(2026, 6, 6)) == 1
    assert len(files.partitions(spark, log, table.LOG_FOLDERS)) == 2
    rest = table.unfolded(spark, log)
    assert {re.search(r"batch_id=\d", f)[0] for f in rest.inputFiles()} == {"batch_id=1"}
    assert tuples(rest, "intersection_id", "window_date") == [("a", dt.date(2026, 6, 6))]
    assert table.fold_versions(spark, log, path) == 1
    assert files.partitions(spark, log, table.LOG_FOLDERS) == []
    # The mark of a micro-batch that is not the run's last is not needed any more.
    assert table.folded_marks(spark, log) == {("2026-06-06", "r"): 1}
    table.append_versions(landing(spark, row("a", DAYS[1], "GREEN")), 1, log, run="r")
    assert table.fold_versions(spark, log, path) == 0


def test_newest_day_reads_names_alone(spark, folder):
    assert table.newest_day(spark, folder + "/none") is None
    table.upsert_landing(landing(spark, row("a", DAYS[1]), row("a", DAYS[0])), folder + "/l")
    before = len(list(spark.sparkContext.statusTracker().getJobIdsForGroup(None)))
    assert table.newest_day(spark, folder + "/l") == dt.date(2026, 6, 6)
    assert len(list(spark.sparkContext.statusTracker().getJobIdsForGroup(None))) == before


def test_small_files_are_replaced(spark, folder):
    path = folder + "/deep/state.json"
    assert files.read_small(spark, path) is None
    for text in ("one", "zwei über", ""):
        files.replace_small(spark, path, text)
        assert files.read_small(spark, path) == text
    files.delete(spark, path)
    assert not files.exists(spark, path)


def test_rebuild_then_merge(spark, folder):
    path, core = folder + "/l", folder + "/c"
    table.upsert_landing(landing(spark, row("a", DAYS[0])), path)
    one, two = inventory(spark, "a"), inventory(spark, "x", "a")
    core_table.merge_core(spark, path, one, core)
    jobs.build_warehouse(spark, path, two, core)
    assert core_table.merge_core(spark, path, two, core) == core_table.NO_DAY
    assert core_table.merge_core(spark, path, one, core) == dt.date(2026, 6, 5)
    assert tuples(core_table.read_core(spark, core), "latitude") == tuples(one, "latitude")


def test_a_load_that_is_repeated_replaces_its_files(spark, folder):
    rows = spark.createDataFrame([("{broken",), ("{",)], "value string")
    for load in ("one", "two", "one"):
        jobs.ingest(rows, folder + "/out", load)
    out = spark.read.json(folder + "/out")
    assert tuples(out.groupBy("load").count()) == [("one", 2), ("two", 2)]


def test_latest_rows_follow_a_stream(spark, feed):
    root = str(feed.root)
    for lines in ([reading("a", "18:00:10"), reading("b", "18:00:20")],
                  [reading("a", "18:02:00", "GREEN")], [reading("a", "18:02:30", "YELLOW")]):
        feed.add(*lines)
        live = s.stream_core(s.stream_windows(s.flat_events(feed.raw())), inventory(spark, "a"), LOAD)
        s.start_latest(live, root + "/latest", root + "/ck").awaitTermination()
    got = latest_table.read_latest(spark, root + "/latest")
    assert tuples(got, "intersection_id", "signal_state", "event_count") == [
        ("a", "YELLOW", 2), ("b", "RED", 1)]
    assert status.health(got, inventory(spark, "a"), as_of=LOAD).first().intersection_count == 1
    latest_table.upsert_latest(got.limit(0), root + "/latest")
    older = got.filter("intersection_id = 'a'").withColumn("window_end", got.window_end - status.F.expr("INTERVAL 1 DAY"))
    latest_table.upsert_latest(older, root + "/latest")
    assert tuples(latest_table.read_latest(spark, root + "/latest"), "signal_state") == [("RED",), ("YELLOW",)]


def test_lines_of_text_arrive_in_order(spark, feed):
    """Ties within a file and between files, whose times and not whose names decide."""
    feed.add(reading("b", "18:00:10", "YELLOW"))
    feed.add(reading("a", "18:00:10", "GREEN"), reading("a", "18:00:10", "RED"), reading("b", "18:00:10"))
    (feed.root / "in" / "000.json").rename(feed.root / "in" / "zzz.json")
    raw = source.read_text(spark, str(feed.root / "in"), ordered=True)
    for states in (None, ("RED", "GREEN", "YELLOW")):
        got = window_aggregate(s.flat_events(raw), seq_col="seq", states=states)
        assert tuples(got, "intersection_id", "signal_state") == [("a", "GREEN"), ("b", "YELLOW")]
    root = str(feed.root)
    assert jobs.payloads_to_landing(raw, root + "/l", LOAD) == 2
    assert tuples(table.read_landing(spark, root + "/l"), "signal_state") == [("GREEN",), ("YELLOW",)]


def test_metrics_outlast_the_run(spark, feed):
    root = str(feed.root)
    for lines in ([reading("a", "18:00:10"), "{broken"], [reading("a", "18:10:00")], ["{"]):
        feed.add(*lines)
        metrics = s.RunMetrics.listen(spark, root + "/metrics")
        metrics.of(feed.drain())
        spark.streams.removeListener(metrics)
    total = s.read_metrics(spark, root + "/metrics").first()
    assert (total.batches, total.consumed, total.invalid) == (3, 4, 2)
    assert total.query_id == s.run_name(spark, root + "/log-checkpoint")


def test_counts_of_the_list(spark):
    rows = landing(spark, ("a", DAYS[0], "RED", 80.0, 3.0, 1, None), ("x", DAYS[0], "RED", 1.0, 1.0, 1, None))
    core = models.build_core(models.staging(rows), inventory(spark, "a", "b"))
    items = status.status_list(status.latest_status(core), inventory(spark, "a", "b"))
    assert tuple(status.list_counts(items).first()) == (2, 1, 1)
    severe = status.status_list(status.latest_status(core), inventory(spark, "a", "b"), bottleneck_only=True)
    assert tuple(status.list_counts(severe).first()) == (1, 1, 1)
