import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import at, events, plan, tuples
from signalmill.operators.windows import landing_rows, window_aggregate
from signalmill.schemas import LANDING, SIGNAL_STATES, same_shape


@pytest.fixture(params=["any text", "listed states"])
def aggregate(request):
    states = None if request.param == "any text" else SIGNAL_STATES
    return lambda rows, **kw: window_aggregate(rows, seq_col="seq", states=states, **kw)


def test_two_windows_have_distinct_ends(spark, aggregate):
    rows = events(
        spark,
        ("a", "18:00:10", "GREEN", 10.0, 20.0),
        ("a", "18:00:40", "RED", 20.0, 10.0),
        ("a", "18:01:10", "GREEN", 30.0, 30.0),
    )
    assert tuples(aggregate(rows)) == [
        ("a", at("18:01:00"), "RED", 15.0, 15.0, 2),
        ("a", at("18:02:00"), "GREEN", 30.0, 30.0, 1),
    ]


def test_last_state_is_by_time_not_by_name(spark, aggregate):
    rows = events(
        spark,
        ("a", "18:00:30", "GREEN", 1.0, 1.0),
        ("a", "18:00:50", "GREEN", 1.0, 1.0),
        ("a", "18:00:00", "RED", 1.0, 1.0),
        ("b", "18:00:30", "YELLOW", 1.0, 1.0),
        ("b", "18:00:50", "GREEN", 1.0, 1.0),
    )
    assert tuples(aggregate(rows), "intersection_id", "signal_state", "event_count") == [
        ("a", "GREEN", 3),
        ("b", "GREEN", 2),
    ]


def test_of_equal_times_the_first_arrival_wins(spark, aggregate):
    rows = events(
        spark,
        ("a", "18:00:50", "RED", 1.0, 1.0),
        ("a", "18:00:50", "YELLOW", 1.0, 1.0),
        ("a", "18:00:50", "GREEN", 1.0, 1.0),
    ).repartition(3)
    assert tuples(aggregate(rows), "signal_state") == [("RED",)]


def test_midnight_and_the_full_minute(spark, aggregate):
    rows = events(
        spark,
        ("a", "23:59:30", "RED", 1.0, 1.0),
        ("b", "18:01:00", "RED", 1.0, 1.0),
    )
    assert tuples(aggregate(rows), "intersection_id", "window_end") == [
        ("a", dt.datetime(2026, 6, 6)),
        ("b", at("18:02:00")),
    ]


def test_null_measures_count_but_do_not_average(spark, aggregate):
    rows = events(
        spark,
        ("a", "18:00:10", "RED", None, 4.0),
        ("a", "18:00:20", None, 6.0, None),
    )
    got = tuples(aggregate(rows))
    assert got == [("a", at("18:01:00"), None, 6.0, 4.0, 2)]


def test_times_before_1970_and_no_events(spark, aggregate):
    rows = events(spark, ("a", "1969-12-31 23:59:59.5", "RED", 1.0, 1.0))
    assert tuples(aggregate(rows), "window_end") == [(dt.datetime(1970, 1, 1),)]
    assert aggregate(rows.filter("false")).count() == 0


def test_window_start_and_other_lengths(spark, aggregate):
    rows = events(spark, ("a", "18:07:10", "RED", 1.0, 1.0))
    got = aggregate(rows, with_start=True, length="5 minutes")
    assert tuples(got, "window_start", "window_end") == [(at("18:05:00"), at("18:10:00"))]


def test_an_unlisted_state_fails_where_states_are_listed(spark):
    rows = events(spark, ("a", "18:00:10", "BLUE", 1.0, 1.0))
    assert tuples(window_aggregate(rows, seq_col="seq"), "signal_state") == [("BLUE",)]
    with pytest.raises(Exception, match="outside the declared list"):
        window_aggregate(rows, seq_col="seq", states=SIGNAL_STATES).collect()


def test_both_forms_agree_with_a_plain_loop(spark):
    """Many ties, several tasks, and the greatest and least sequence numbers there are."""
    raw = spark.range(5000).select(
        F.concat(F.lit("i"), (F.col("id") % 7).cast("string")).alias("intersection_id"),
        F.timestamp_seconds(F.lit(1_780_000_000) + F.hash("id") % 200).alias("event_timestamp"),
        F.element_at(
            F.array(*[F.lit(s) for s in SIGNAL_STATES]),
            (F.pmod(F.xxhash64("id"), F.lit(5)) + 1).cast("int"),
        ).alias("signal_state"),
        (F.col("id") % 90).cast("double").alias("avg_stop_duration_seconds"),
        (F.col("id") % 45).cast("double").alias("avg_vehicle_speed_kmh"),
        F.when(F.col("id") == 0, F.lit(2**63 - 1))
        .otherwise(F.xxhash64(F.col("id") + 1) % 1000 + F.lit(2**62))
        .alias("seq"),
    )
    rows = raw.persist()
    expected = {}
    for r in rows.collect():
        end = r.event_timestamp.replace(second=0) + dt.timedelta(minutes=1)
        expected.setdefault((r.intersection_id, end), []).append(r)
    want = sorted(
        (*key, min(g, key=lambda r: (-r.event_timestamp.timestamp(), r.seq)).event_timestamp, len(g))
        for key, g in expected.items()
    )
    for states in (None, SIGNAL_STATES):
        got = window_aggregate(rows, seq_col="seq", states=states)
        by_key = {(r.intersection_id, r.window_end): r for r in got.collect()}
        assert len(by_key) == len(want)
        for key, group in expected.items():
            best = min((-r.event_timestamp.timestamp(), r.seq) for r in group)
            allowed = {
                r.signal_state for r in group if (-r.event_timestamp.timestamp(), r.seq) == best
            }
            assert by_key[key].signal_state in allowed
            assert by_key[key].event_count == len(group)
    rows.unpersist()


def test_landing_rows_keep_the_contract(spark):
    rows = window_aggregate(events(spark, ("a", "18:00:10", "RED", 1.0, 2.0)), seq_col="seq")
    landed = landing_rows(rows, "2026-06-05T18:01:04.987Z")
    assert same_shape(landed.schema, LANDING) == []
    assert tuples(landed) == [("a", at("18:01:00"), "RED", 1.0, 2.0, 1, at("18:01:04"))]
    assert landing_rows(rows).first().ingested_at.microsecond == 0


def test_listed_states_keep_the_hash_aggregate(spark):
    rows = events(spark, ("a", "18:00:10", "RED", 1.0, 2.0))
    text = plan(window_aggregate(rows, seq_col="seq", states=SIGNAL_STATES))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2
    assert text.count("Exchange") == 1
