import datetime as dt
import random
from types import SimpleNamespace

import pytest

from helpers import at, event, events, inventory, landing, plan, texts, tuples
from signalmill.operators import models, status
from signalmill.plans import jobs
from signalmill.schemas import CORE, LANDING, SIGNAL_STATES, require_shape
from signalmill.session import shared_folder
from signalmill.sources import core as core_table
from signalmill.sources import landing as table

DAYS = ("2026-06-04 23:59:00", "2026-06-05 00:01:00", "2026-06-06 10:00:00")


def row(key, end, state="RED", ingested="18:01:05"):
    return (key, end, state, 1.0, 50.0, 1, ingested)


def files(folder, day):
    return sorted(p.name for p in (folder / f"window_date={day}").glob("*.parquet"))


def test_upsert_replaces_only_its_keys_and_days(spark, tmp_path):
    path = tmp_path / "landing"
    first = landing(spark, *[row(k, d) for k in "ab" for d in DAYS])
    assert table.upsert_landing(first, str(path)) == 6
    untouched = files(path, "2026-06-04"), files(path, "2026-06-06")
    change = landing(spark, row("a", DAYS[1], "GREEN"), row("c", DAYS[1]))
    for _ in range(2):
        assert table.upsert_landing(change, str(path)) == 2
        got = table.read_landing(spark, str(path))
        assert tuples(got, "intersection_id", "window_end", "signal_state") == [
            ("a", at(DAYS[0]), "RED"),
            ("a", at(DAYS[1]), "GREEN"),
            ("a", at(DAYS[2]), "RED"),
            ("b", at(DAYS[0]), "RED"),
            ("b", at(DAYS[1]), "RED"),
            ("b", at(DAYS[2]), "RED"),
            ("c", at(DAYS[1]), "RED"),
        ]
    assert (files(path, "2026-06-04"), files(path, "2026-06-06")) == untouched


def test_nothing_to_write_creates_the_table(spark, folder):
    assert table.upsert_landing(landing(spark).limit(0), folder + "/l") == 0
    assert table.read_landing(spark, folder + "/l").count() == 0
    table.ensure_table(spark, folder + "/l")


def test_the_last_ingested_of_one_key_counts(spark, folder):
    rows = landing(
        spark,
        row("a", DAYS[0], "RED", "18:00:00"),
        row("a", DAYS[0], "GREEN", "18:00:09"),
        row("a", DAYS[0], "YELLOW", "18:00:03"),
    )
    assert table.upsert_landing(rows, folder + "/l") == 1
    assert tuples(table.read_landing(spark, folder + "/l"), "signal_state") == [("GREEN",)]


def test_reads_prune_days_and_push_the_id_down(spark, folder):
    rows = landing(spark, *[row(k, d) for k in "ab" for d in DAYS])
    table.upsert_landing(rows, folder + "/l")
    got = table.read_landing(spark, folder + "/l", intersection_id="a", since=dt.date(2026, 6, 5))
    assert tuples(got, "intersection_id", "window_end") == [("a", at(DAYS[1])), ("a", at(DAYS[2]))]
    text = plan(got)
    assert "window_date" in text.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "EqualTo(intersection_id,a)" in text
    ordered = table.in_order(table.read_landing(spark, folder + "/l")).collect()
    keys = [(r.intersection_id, r.window_end) for r in ordered]
    assert keys == sorted(keys) and len(keys) == 6


def test_sql_users_read_it_by_name(spark, folder):
    table.upsert_landing(landing(spark, row("a", DAYS[0])), folder + "/l")
    table.register_table(spark, "landing_test", folder + "/l")
    table.upsert_landing(landing(spark, row("a", DAYS[1])), folder + "/l")
    table.register_table(spark, "landing_test", folder + "/l")
    got = spark.sql("SELECT intersection_id, window_end FROM landing_test")
    assert tuples(got) == [("a", at(DAYS[0])), ("a", at(DAYS[1]))]
    spark.sql("DROP TABLE landing_test")


def test_random_upserts_and_versions_against_a_dict(spark, folder):
    """Days, keys and repeated loads at random, into the table and into the log."""
    rng = random.Random(11)
    path, log, want = folder + "/l", folder + "/log", {}
    for batch_id in range(6):
        keys = {(rng.choice("abcd"), rng.choice(DAYS)) for _ in range(rng.randint(0, 6))}
        rows = [row(k, end, rng.choice(SIGNAL_STATES), f"18:0{batch_id}:00") for k, end in keys]
        want.update({(r[0], at(r[1])): r[2] for r in rows})
        change = landing(spark, *rows)
        for _ in range(rng.choice([1, 2])):
            assert table.upsert_landing(change, path) == len(rows)
            table.append_versions(change, batch_id, log)
    for got in (table.read_landing(spark, path), table.read_versions(spark, log),
                table.read_live(spark, path, log)):
        assert {(r.intersection_id, r.window_end): r.signal_state for r in got.collect()} == want
        assert got.count() == len(want)


def test_wrong_shape_is_refused(spark, folder):
    rows = landing(spark, row("a", DAYS[0]))
    for bad in (rows.drop("event_count"), rows.select(*reversed(LANDING.fieldNames())),
                rows.withColumn("event_count", rows.event_count.cast("int"))):
        with pytest.raises(ValueError):
            table.upsert_landing(bad, folder + "/l")


def test_version_log_folds_into_the_table(spark, folder):
    path, log = folder + "/l", folder + "/log"
    old = ("a", "2026-05-01 00:00:00", "RED", 1.0, 50.0, 1, None)
    table.upsert_landing(landing(spark, row("a", DAYS[0]), row("b", DAYS[0]), old), path)
    batches = [
        landing(spark, row("a", DAYS[0], "GREEN"), row("c", DAYS[1])),
        landing(spark, row("c", DAYS[1], "YELLOW"), row("c", DAYS[2])),
    ]
    for batch_id in (0, 1, 1, 0):
        table.append_versions(batches[batch_id], batch_id, log)
    columns = ("intersection_id", "window_end", "signal_state")
    want = [
        ("a", at("2026-05-01 00:00:00"), "RED"),
        ("a", at(DAYS[0]), "GREEN"),
        ("b", at(DAYS[0]), "RED"),
        ("c", at(DAYS[1]), "YELLOW"),
        ("c", at(DAYS[2]), "RED"),
    ]
    assert tuples(table.read_live(spark, path, log), *columns) == want
    assert table.fold_versions(spark, log, path, before=dt.date(2026, 6, 6)) == 2
    assert tuples(table.read_landing(spark, path), *columns) == want[:4]
    assert tuples(table.read_live(spark, path, log), *columns) == want
    assert table.fold_versions(spark, log, path) == 1
    assert tuples(table.read_landing(spark, path), *columns) == want
    assert table.fold_versions(spark, log, path) == 0


def test_payloads_to_landing(spark, folder):
    """Three events of one minute, one of the next, one broken; ids need not be valid uuids."""
    docs = [
        event(event_id="e1", environment__timestamp="2026-06-05T18:00:00Z"),
        event(
            event_id="e2",
            environment__timestamp="2026-06-05T18:00:30Z",
            telemetry__current_signal_state="GREEN",
        ),
        event(event_id="e3", environment__timestamp="2026-06-05T18:00:50Z"),
        event(
            event_id="e4",
            environment__timestamp="2026-06-05T18:01:05Z",
            telemetry__current_signal_state="YELLOW",
        ),
        "{broken",
    ]
    written = jobs.payloads_to_landing(texts(spark, *docs), folder + "/l", "2026-06-05T18:02:00Z")
    assert written == 2
    got = table.read_landing(spark, folder + "/l")
    assert tuples(got, "window_end", "signal_state", "event_count") == [
        (at("18:01:00"), "RED", 3),
        (at("18:02:00"), "YELLOW", 1),
    ]


def test_strict_payloads(spark, folder):
    docs = [event(), event(telemetry__current_signal_state="BLUE", intersection_id="b")]
    assert jobs.payloads_to_landing(texts(spark, *docs), folder + "/all") == 2
    assert jobs.payloads_to_landing(texts(spark, *docs), folder + "/valid", strict=True) == 1


def test_ingest_job_routes_to_folders(spark, folder):
    rows = texts(spark, event(), "{broken", event(event_id="x"))
    assert jobs.ingest(rows, folder + "/out") == {"event_count": 3, "invalid_count": 2}
    out = spark.read.json(folder + "/out")
    assert tuples(out.groupBy("topic").count()) == [
        ("traffic-events", 1),
        ("traffic-events-dlq", 2),
    ]


def test_warehouse_replaces_core_and_merge_equals_it(spark, folder):
    rows = events(
        spark,
        ("a", "2026-06-01 18:00:10", "RED", 80.0, 3.0),
        ("a", "2026-06-04 18:00:10", "RED", 80.0, 3.0),
        ("lost", "2026-06-05 18:00:10", "GREEN", 1.0, 30.0),
    )
    places, path, built, merged = inventory(spark, "a"), *(folder + x for x in ("/l", "/b", "/m"))
    jobs.events_to_landing(rows, path, "18:00:00")
    assert core_table.merge_core(spark, path, places, merged) is None
    more = events(
        spark,
        ("a", "2026-06-04 18:00:50", "GREEN", 20.0, 30.0),
        ("a", "2026-06-06 18:00:10", "YELLOW", 20.0, 30.0),
    )
    jobs.events_to_landing(more, path, "18:00:00")
    report = jobs.build_warehouse(spark, path, places, built)
    want = tuples(core_table.read_core(spark, built))
    assert len(want) == 4 and [r[0] for r in tuples(report)] == ["lost"]
    since = core_table.merge_core(spark, path, places, merged)
    assert since == dt.date(2026, 6, 4)
    assert tuples(core_table.read_core(spark, merged)) == want
    assert core_table.merge_core(spark, path, places, merged) == core_table.NO_DAY
    assert tuples(core_table.read_core(spark, merged)) == want
    jobs.refresh_latest(spark, merged, folder + "/one")
    jobs.refresh_latest(spark, merged, folder + "/two", previous=folder + "/one", since=since)
    latest = tuples(status.latest_status(core_table.read_core(spark, built)))
    assert len(latest) == 2
    for stored in ("/one", "/two"):
        assert tuples(spark.read.schema(CORE).parquet(folder + stored)) == latest
    recent = core_table.read_core(spark, merged, since=dt.date(2026, 6, 6))
    assert require_shape(recent, CORE).count() == 1
    assert spark.table("stg_traffic_signals").count() == 4
    assert spark.table("rpt_orphan_intersections").count() == 1


def test_late_days_and_changed_places_reach_core(spark, folder):
    path, core = folder + "/l", folder + "/c"
    table.upsert_landing(landing(spark, row("a", "2026-06-10 18:01:00"), row("b", "2026-06-10 18:01:00")), path)
    places = inventory(spark, "a", "b")
    core_table.merge_core(spark, path, places, core)
    table.upsert_landing(landing(spark, row("a", "2025-01-05 18:01:00")), path)
    assert core_table.merge_core(spark, path, places, core) == dt.date(2025, 1, 5)
    moved = places.withColumn("latitude", places.latitude + 1).filter("intersection_id = 'b'")
    places = places.filter("intersection_id = 'a'").unionByName(moved)
    assert core_table.merge_core(spark, path, places, core) == dt.date(2026, 6, 10)
    want = models.build_core(models.staging(table.read_landing(spark, path)), places)
    assert tuples(core_table.read_core(spark, core)) == tuples(want)
    assert core_table.merge_core(spark, path, places, core) == core_table.NO_DAY


def test_a_correction_after_a_fold_stays(spark, folder):
    path, log = folder + "/l", folder + "/log"
    table.append_versions(landing(spark, row("a", DAYS[0], "RED")), 0, log)
    assert table.fold_versions(spark, log, path) == 1
    table.upsert_landing(landing(spark, row("a", DAYS[0], "GREEN")), path)
    for _ in range(2):
        assert tuples(table.read_live(spark, path, log), "signal_state") == [("GREEN",)]
        assert table.fold_versions(spark, log, path) == 0
    table.append_versions(landing(spark, row("a", DAYS[0], "YELLOW")), 1, log)
    assert tuples(table.read_live(spark, path, log), "signal_state") == [("YELLOW",)]
    assert table.fold_versions(spark, log, path) == 1
    assert tuples(table.read_landing(spark, path), "signal_state") == [("YELLOW",)]


def test_two_runs_share_a_log(spark, folder):
    log = folder + "/log"
    table.append_versions(landing(spark, row("a", DAYS[0], "RED")), 0, log, run="one")
    table.append_versions(landing(spark, row("b", DAYS[0], "GREEN")), 0, log, run="two")
    assert tuples(table.read_versions(spark, log), "intersection_id") == [("a",), ("b",)]


def test_core_as_a_catalog_table(spark):
    rows = landing(spark, row("a", DAYS[0]), row("a", DAYS[1]))
    core = models.build_core(models.staging(rows), inventory(spark, "a"))
    for part in (core, core.limit(1)):
        core_table.save_core_table(part, "core_test")
    assert spark.table("core_test").count() == 1
    spark.sql("DROP TABLE core_test")


def session(master, setting):
    """As much of a session as choosing a folder needs."""
    conf = SimpleNamespace(get=lambda key, default: setting)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_follows_the_setting():
    one, two = (shared_folder(session("yarn", "hdfs://x/shared/"), "core") for _ in range(2))
    assert one.startswith("hdfs://x/shared/core-") and one != two
    assert "signalmill-" in shared_folder(session("local[2]", None), "core")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn", None), "core")
