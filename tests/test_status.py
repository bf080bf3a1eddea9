import json

import pytest
from pyspark.sql import functions as F

from helpers import inventory, landing, plan, stored, tuples
from signalmill.operators import models, status
from signalmill.plans.jobs import current_status, write_status_feed
from signalmill.schemas import HEALTH, STATUS, same_shape

SET = [
    ("a", "18:00:00", "RED", 1.0, 1.0, 1, "18:00:05"),
    ("a", "18:01:00", "GREEN", 22.0, 28.5, 1, "18:01:05"),
    ("b", "18:01:00", "RED", 80.0, 3.0, 1, "18:01:05"),
    ("c", "18:01:00", "YELLOW", 35.5, 15.0, 1, "18:01:05"),
    ("lost", "18:00:30", "GREEN", 10.0, 40.0, 1, "18:01:05"),
]
EPOCH = "1970-01-01T00:00:00Z"


def core(spark, rows=SET, places=("a", "b", "c", "silent")):
    return models.build_core(models.staging(landing(spark, *rows)), inventory(spark, *places))


def test_latest_row_and_its_tie_break(spark, folder):
    rows = SET + [("a", "18:01:00", "YELLOW", 1.0, 1.0, 1, "18:02:00")]
    got = status.latest_status(stored(core(spark, rows), folder + "/core"))
    assert tuples(got, "intersection_id", "signal_state")[0] == ("a", "YELLOW")
    assert got.count() == 4
    assert plan(got).count("WindowGroupLimit") == 2


def test_reducing_before_or_after_the_join_is_the_same(spark):
    staged, places = models.staging(landing(spark, *SET)), inventory(spark, "a", "b", "x")
    before = models.build_core(status.latest_status(staged), places)
    assert tuples(before) == tuples(status.latest_status(models.build_core(staged, places)))


def test_latest_rows_advance_with_changes(spark):
    changes = [
        ("a", "18:01:00", "RED", 5.0, 5.0, 2, "18:01:05"),
        ("b", "18:00:00", "GREEN", 1.0, 1.0, 1, "18:09:00"),
        ("new", "18:02:00", "GREEN", 1.0, 1.0, 1, "18:02:05"),
    ]
    got = status.advance_latest(status.latest_status(core(spark)), core(spark, changes))
    assert tuples(got, "intersection_id", "signal_state", "event_count") == [
        ("a", "RED", 2),
        ("b", "RED", 1),
        ("c", "YELLOW", 1),
        ("lost", "GREEN", 1),
        ("new", "GREEN", 1),
    ]


def test_health_of_latest_rows_is_that_of_core(spark):
    rows, places = core(spark), inventory(spark, "a", "b", "silent")
    for contract in (False, True):
        options = {"as_of": LIVE, "contract": contract, "threshold": 20}
        whole = status.health(rows, places, **options).first()
        assert status.health(status.latest_status(rows), places, **options).first() == whole


def test_list_follows_the_inventory(spark):
    latest = status.latest_status(core(spark))
    items = status.status_list(latest, inventory(spark, "a", "b", "c", "silent"))
    assert same_shape(items.schema, STATUS) == []
    got = {r.intersection_id: r for r in items.collect()}
    assert set(got) == {"a", "b", "c", "silent"}
    assert all(r.location is not None for r in got.values())
    assert got["a"].window_end == "2026-06-05T18:01:00Z"
    silent = got["silent"]
    assert (silent.signal_state, silent.window_end) == ("UNKNOWN", EPOCH)
    assert silent.avg_stop_duration_seconds is None and silent.is_severe_bottleneck is False
    assert silent.display_name == "Crossing silent"
    severe = status.status_list(latest, inventory(spark, "a", "b"), bottleneck_only=True)
    assert tuples(severe, "intersection_id") == [("b",)]
    kept = status.status_list(latest, inventory(spark, "a"), include_orphans=True)
    assert tuples(kept, "intersection_id") == [("a",), ("b",), ("c",), ("lost",)]


def test_name_is_the_stored_one_and_place_is_filled_in(spark):
    rows = core(spark, places=("b",)).withColumn("display_name", F.lit("stored"))
    items = status.status_list(status.latest_status(rows), inventory(spark, "a", "b"))
    got = {r.intersection_id: r for r in items.collect()}
    assert got["a"].display_name == "stored" and got["a"].location.latitude == -27.1


def test_no_inventory_and_an_empty_one(spark):
    rows = core(spark)
    ids = [("a",), ("b",), ("c",), ("lost",)]
    assert tuples(current_status(rows), "intersection_id") == ids
    empty = inventory(spark, "a").filter("false")
    assert tuples(current_status(rows, empty), "intersection_id") == ids
    assert current_status(rows, inventory(spark, "a")).count() == 1


def test_lookup(spark, folder):
    rows, places = stored(core(spark), folder + "/core"), inventory(spark, "a", "silent")
    one = status.status_by_id(rows, "a", places)
    assert tuples(one, "intersection_id", "signal_state") == [("a", "GREEN")]
    assert "EqualTo(intersection_id,a)" in plan(one)
    assert status.status_by_id(rows, "silent", places).first().window_end == EPOCH
    assert status.status_by_id(rows, "nonexistent-id", places).count() == 0
    asked = spark.createDataFrame([("a",), ("nonexistent-id",)], "intersection_id string")
    items = status.status_list(status.latest_status(rows), places)
    answers = {r.intersection_id: r for r in status.lookup_status(items, asked).collect()}
    assert answers["a"].code is None and answers["a"].signal_state == "GREEN"
    missing = answers["nonexistent-id"]
    assert missing.code == "NOT_FOUND" and missing.signal_state is None
    assert missing.message == "Unknown intersection: nonexistent-id"


def test_feed_leaves_nulls_out(spark, folder):
    items = current_status(core(spark), inventory(spark, "silent", "b"))
    write_status_feed(items, folder + "/feed")
    docs = [json.loads(r.value) for r in spark.read.text(folder + "/feed").collect()]
    by_id = {d["intersection_id"]: d for d in docs}
    assert "avg_stop_duration_seconds" not in by_id["silent"]
    assert by_id["b"]["location"] == {"latitude": -27.099, "longitude": -52.601}
    assert list(by_id["b"]) == STATUS.fieldNames()


def health(spark, rows, places, as_of, **options):
    found = models.build_core(models.staging(landing(spark, *rows)), inventory(spark, *(places or ["a"])))
    row = status.health(found, places and inventory(spark, *places), as_of=as_of, **options)
    assert same_shape(row.schema, HEALTH) == []
    return tuple(row.first())


LIVE = "2026-06-05T18:01:30Z"


@pytest.mark.parametrize(
    "rows, places, as_of, options, expected",
    [
        ([], ["a", "b"], LIVE, {}, ("degraded", "UNKNOWN", 0.0, 2)),
        ([], None, LIVE, {}, ("degraded", "UNKNOWN", 0.0, 0)),
        (SET, ["x", "y"], LIVE, {}, ("degraded", "UNKNOWN", 0.0, 2)),
        (SET, ["a", "b", "x"], LIVE, {}, ("ok", "FRESH", 30.0, 3)),
        (SET, ["a"], "2026-06-05T18:03:00Z", {}, ("ok", "FRESH", 120.0, 1)),
        (SET, ["a"], "2026-06-05T18:03:00.5Z", {}, ("degraded", "UNKNOWN", 120.5, 1)),
        (SET, ["a"], "2026-06-05T18:00:00Z", {}, ("ok", "FRESH", 0.0, 1)),
        (SET, None, LIVE, {}, ("ok", "FRESH", 30.0, 4)),
        (SET, None, LIVE, {"contract": True}, ("ok", "FRESH", 60.0, 4)),
        (SET, ["a", "lost"], LIVE, {"contract": True}, ("ok", "FRESH", 60.0, 2)),
        (SET, ["a"], LIVE, {"contract": True, "threshold": 20}, ("degraded", "STALE", 30.0, 1)),
        (SET, ["x"], LIVE, {"contract": True}, ("degraded", "UNKNOWN", 0.0, 1)),
        # The newest window counts, even that of an id which is not listed.
        (SET + [("new", "18:05:00", "RED", 1.0, 1.0, 1, None)], ["a"], "2026-06-05T18:06:00Z", {},
         ("ok", "FRESH", 60.0, 1)),
        ([("a", "1970-01-01 00:00:00", "RED", 1.0, 1.0, 1, None)], ["a"], LIVE, {},
         ("degraded", "UNKNOWN", 0.0, 1)),
    ],
)
def test_health(spark, rows, places, as_of, options, expected):
    assert health(spark, rows, places, as_of, **options) == expected


def test_health_by_the_real_clock_and_an_empty_inventory(spark, folder):
    rows = stored(core(spark), folder + "/core")
    assert status.health(rows).first().max_lag_seconds >= 0
    empty = inventory(spark, "a").filter("false")
    assert tuple(status.health(rows, empty, as_of=LIVE).first()) == ("ok", "FRESH", 30.0, 4)
    assert plan(status.health(rows, empty)).count("hashpartitioning") == 1


def test_landing_lag(spark):
    rows = landing(spark, *SET)
    assert status.landing_lag(rows, as_of=LIVE).first().max_landing_lag_seconds == 30.0
    early = status.landing_lag(rows, as_of="2026-06-05T10:00:00Z").first()
    assert early.max_landing_lag_seconds == 0.0
    none = status.landing_lag(rows.filter("false"), as_of=LIVE).first()
    assert none.max_landing_lag_seconds is None


def test_extent_ignores_unplaced_items(spark):
    items = current_status(core(spark, places=("a", "b")))
    assert tuple(status.extent(items).first()) == (-27.1, -52.601, -27.099, -52.6, 2)


def test_labels(spark):
    places = inventory(spark, "a", "b", "c", "silent").withColumn(
        "display_name", F.when(F.col("intersection_id") != "c", F.col("display_name"))
    )
    rows = models.build_core(models.staging(landing(spark, *SET)), places)
    items = current_status(rows, places)
    got = {r.intersection_id: r for r in status.status_labels(items).collect()}
    assert got["a"].state_label == "Verde" and got["a"].stop_label == "22s parada"
    assert got["a"].speed_label == "29 km/h" and got["a"].radius == 8 and got["a"].tag is None
    b = got["b"]
    assert (b.tag, b.radius, b.stroke_color, b.stroke_weight) == ("Gargalo", 11, "#dc2626", 3)
    assert b.fill_color == "#ef4444" and b.notice == "⚠ Gargalo severo"
    assert got["c"].title == "c" and got["c"].stop_label == "36s parada"
    silent = got["silent"]
    assert silent.state_label == "Sem telemetria" and silent.stop_label == "—"
    assert silent.notice == "Sem telemetria recente" and silent.fill_color == "#94a3b8"
    popup = {r.intersection_id: r for r in status.popup_measures(items).collect()}
    assert popup["a"].popup_speed == "28.5" and popup["silent"].popup_stop == "—"
    row = status.health_labels(status.health(rows, places, as_of=LIVE)).first()
    assert row.freshness_label == "Dados atualizados" and row.count_label == "4 cruzamentos"
    assert row.lag_title == "Atraso máximo: 30s"
    one = status.health_labels(status.health(rows, inventory(spark, "x"), as_of=LIVE)).first()
    assert one.count_label == "1 cruzamento" and one.lag_title is None
    assert one.freshness_label == "Sem dados"
