import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import at, events, inventory, landing, plan, tuples
from signalmill.sources.landing import with_date
from signalmill.operators import models, quality as q
from signalmill.schemas import DEFAULT_BBOX, INVENTORY_SOURCES, LANDING_REQUIRED, SIGNAL_STATES


def rows(spark):
    return landing(
        spark,
        ("a", "18:01:00", "RED", 1.0, 1.0, 1, "18:01:05"),
        ("a", "18:01:00", "BLUE", None, 1.0, 1, "18:01:06"),
        ("b", None, None, 1.0, 1.0, 1, None),
        (None, None, "BLUE", 1.0, 1.0, 1, None),
    )


def test_nulls(spark):
    assert tuples(q.null_counts(rows(spark), LANDING_REQUIRED)) == [
        ("avg_stop_duration_seconds", 1),
        ("avg_vehicle_speed_kmh", 0),
        ("event_count", 0),
        ("intersection_id", 1),
        ("signal_state", 1),
        ("window_end", 2),
    ]
    found = q.null_rows(rows(spark), ["signal_state", "window_end"])
    assert sorted(tuple(r.null_columns) for r in found.collect()) == [
        ("signal_state", "window_end"),
        ("window_end",),
    ]


def test_accepted_values_and_keys(spark):
    assert tuples(q.unaccepted_values(rows(spark), "signal_state", SIGNAL_STATES)) == [
        ("signal_state", "BLUE", 2)
    ]
    places = inventory(spark, "a", "a", "b")
    assert q.unaccepted_values(places, "source", INVENTORY_SOURCES).count() == 0
    assert tuples(q.repeated_keys(rows(spark))) == [("a", at("18:01:00"), 2)]
    assert tuples(q.repeated_keys(places, ["intersection_id"])) == [("a", 2)]


@pytest.mark.parametrize(
    "as_of, verdict, age",
    [
        ("2026-06-05T18:03:06Z", "pass", 120.0),
        ("2026-06-05T18:04:06Z", "pass", 180.0),
        ("2026-06-05T18:04:07Z", "warn", 181.0),
        ("2026-06-05T18:11:06Z", "warn", 600.0),
        ("2026-06-05T18:11:07Z", "error", 601.0),
        ("2026-06-07T18:00:00Z", "error", None),
    ],
)
def test_source_freshness(spark, as_of, verdict, age):
    row = q.source_freshness(rows(spark), as_of=as_of).first()
    assert (row.verdict, row.age_seconds) == (verdict, age)


def test_freshness_reads_one_day(spark, folder):
    rows(spark).write.parquet(folder + "/l")
    text = plan(q.source_freshness(spark.read.parquet(folder + "/l"), as_of="2026-06-05T18:00:00Z"))
    assert "GreaterThanOrEqual(window_end,2026-06-04 18:00:00.0)" in text
    with_date(rows(spark)).write.partitionBy("window_date").parquet(folder + "/days")
    days = spark.read.parquet(folder + "/days")
    text = plan(q.source_freshness(days, as_of="2026-06-05T18:00:00Z"))
    pruned = text.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "window_date" in pruned and "2026-06-04" in pruned


def test_bounding_box(spark):
    south, west, north, east = DEFAULT_BBOX
    places = spark.createDataFrame(
        [("corner", south, west), ("other", north, east), ("out", north + 0.001, east), ("null", None, east)],
        "intersection_id string, latitude double, longitude double",
    )
    assert tuples(q.inside_bbox(places), "intersection_id") == [("corner",), ("other",)]
    assert tuples(q.outside_bbox(places), "intersection_id") == [("null",), ("out",)]


def test_points_return_to_their_place(spark):
    staged = models.staging(rows(spark).filter("window_end is not null"))
    places = inventory(spark, "a", "b")
    core = models.build_core(staged, places)
    assert q.misplaced_points(core, places).count() == 0
    moved = places.withColumn("latitude", F.col("latitude") + 2e-6)
    assert tuples(q.misplaced_points(core, moved), "intersection_id") == [("a",)]
    unplaced = models.build_core(staged, places.withColumn("latitude", F.lit(None).cast("double")))
    assert tuples(q.misplaced_points(unplaced, places), "missing") == [(2,)]


def test_silent_ids(spark):
    sent = events(spark, *[("a", "18:00:00", "RED", 1.0, 1.0)] * 3)
    assert tuples(q.silent_ids(inventory(spark, "a", "b"), sent)) == [("b",)]
    assert q.silent_ids(inventory(spark, "a"), sent).count() == 0


def test_gaps_against_a_plain_loop(spark):
    rng = random.Random(3)
    start, sent, want = dt.datetime(2026, 6, 5), [], []
    for key in ("a", "b", "c"):
        now = start
        sent.append((key, now, "RED", 1.0, 1.0, 0))
        for _ in range(300):
            micros = rng.choice([0, 1, 9_999_999, 10_000_000, 10_000_001, 35_000_000])
            step = dt.timedelta(microseconds=micros)
            if step > dt.timedelta(seconds=10):
                want.append((key, now, now + step, step.total_seconds()))
            now += step
            sent.append((key, now, "RED", 1.0, 1.0, 0))
    rng.shuffle(sent)
    df = spark.createDataFrame(sent, events(spark, ("a", "18:00:00", "RED", 1.0, 1.0)).schema)
    got = q.emission_gaps(df)
    assert tuples(got) == sorted(want, key=repr)
    assert len(want) > 200
    text = plan(got)
    assert "SortAggregate" not in text and text.index("Window") < text.index("HashAggregate")


def test_percentiles_are_exact(spark):
    lags = list(range(100)) + [500]
    landed = landing(
        spark,
        *[
            (f"i{n}", "18:01:00", "RED", 1.0, 1.0, 1, str(at("18:01:00") + dt.timedelta(seconds=n)))
            for n in lags
        ],
        ("x", "18:01:00", "RED", 1.0, 1.0, 1, None),
    )
    assert tuple(q.window_lag_p95(landed).first()) == (101, 95.0, True)
    assert not q.window_lag_p95(landed, limit=94).first().within_limit
    sent = events(spark, ("i0", "2026-06-05 18:00:10.5", "RED", 1.0, 1.0), ("i0", "18:00:40", "RED", 1.0, 1.0))
    row = q.event_lag_p95(sent, landed).first()
    assert row.row_count == 2 and row.p95_seconds == pytest.approx(20 + 29.5 * 0.95)
