import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import Observation, functions as F

from helpers import DROP, event, inventory, texts, tuples
from signalmill.operators import validation as v
from signalmill.operators.events import flatten_documents, usable
from signalmill.schemas import EVENT_SOURCES, INVENTORY, SIGNAL_STATES
from signalmill.sources.events import observe_ingest

GOOD = json.dumps(event())


def reasons(spark, *docs):
    rows = v.validate_events(texts(spark, *docs)).select("seq", "reasons").collect()
    return [tuple(r.reasons) for r in sorted(rows)]


CASES = [
    (event(), ()),
    (event(metadata={"lane_count": 2, "deep": {"a": [1, {"b": 2}]}}), ()),
    (event(metadata={"tags": [{"a": 1}]}), ()),
    (event(metadata=None), ()),
    (event(metadata={}), ()),
    (event(telemetry__avg_vehicle_speed_kmh=0), ()),
    (event(telemetry__avg_vehicle_speed_kmh=1e3), ()),
    (event(environment__timestamp="2026-06-05T09:17:40-03:00"), ()),
    (event(environment__timestamp="2026-06-05T09:17:40.123456"), ()),
    (event(telemetry=DROP), ("missing_field",)),
    (event(environment__source=DROP), ("missing_field",)),
    (event(event_id=DROP, intersection_id=DROP), ("missing_field",)),
    (event(telemetry={}, environment={}), ("missing_field",)),
    (event(telemetry="x"), ("missing_field",)),
    ({}, ("missing_field",)),
    (event(extra=1), ("extra_key",)),
    (event(environment__zone="x"), ("extra_key",)),
    (event(telemetry__zone="x"), ("extra_key",)),
    (event(metadata={"x": {"y": 1}}, extra={"a": {}}), ("extra_key",)),
    (event(event_id="not-a-uuid"), ("bad_event_id",)),
    (event(event_id=5), ("bad_event_id",)),
    (event(event_id=None), ("bad_event_id",)),
    (event(event_id="7c1d52ab03f64e189b7a5d20c6e4f811"), ("bad_event_id",)),
    (event(intersection_id="a b"), ("bad_intersection_id",)),
    (event(intersection_id="a\n"), ("bad_intersection_id",)),
    (event(intersection_id=""), ("bad_intersection_id",)),
    (event(environment__timestamp="14:30"), ("bad_timestamp",)),
    (event(environment__timestamp="2026-06-05"), ("bad_timestamp",)),
    (event(environment__timestamp="2026-13-05T09:17:40Z"), ("bad_timestamp",)),
    (event(environment__timestamp=1780000000), ("bad_timestamp",)),
    (event(environment__source="other"), ("bad_source",)),
    (event(telemetry__current_signal_state="BLUE"), ("bad_state",)),
    (event(telemetry__current_signal_state="red"), ("bad_state",)),
    (event(telemetry__avg_stop_duration_seconds="31.25"), ("bad_stop_duration",)),
    (event(telemetry__avg_stop_duration_seconds=-0.1), ("bad_stop_duration",)),
    (event(telemetry__avg_vehicle_speed_kmh=True), ("bad_speed",)),
    (event(telemetry__avg_vehicle_speed_kmh=None), ("bad_speed",)),
    (event(metadata=[1]), ("bad_metadata",)),
    (event(event_id="x", telemetry__avg_vehicle_speed_kmh=-1), ("bad_event_id", "bad_speed")),
    (GOOD[:20], ("malformed",)),
    ("", ("malformed",)),
    ("null", ("malformed",)),
    ("[]", ("malformed",)),
    (f"[{GOOD}]", ("malformed",)),
    ('"text"', ("malformed",)),
    (GOOD + " trailing", ("malformed",)),
    (GOOD + GOOD, ("malformed",)),
    (GOOD + "," + GOOD, ("malformed",)),
    (GOOD + "] [", ("malformed",)),
    (GOOD + "] [{}", ("malformed",)),
    (GOOD[:-1] + ',"event_id":"twice"}', ("malformed",)),
    ("  " + GOOD + "\t ", ()),
]


def test_each_rule(spark):
    got = reasons(spark, *[doc for doc, _ in CASES])
    wrong = [(doc, g, w) for (doc, w), g in zip(CASES, got) if g != w]
    assert not wrong


def sound(doc):
    """The contract once more, in plain Python."""
    try:
        if set(doc) - {"metadata"} != {"event_id", "intersection_id", "environment", "telemetry"}:
            return False
        env, tel = doc["environment"], doc["telemetry"]
        if set(env) != {"timestamp", "source"} or len(tel) != 3:
            return False
        numbers = [tel["avg_stop_duration_seconds"], tel["avg_vehicle_speed_kmh"]]
        dt.datetime.fromisoformat(env["timestamp"])
        return (
            bool(re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", doc["event_id"]))
            and bool(re.fullmatch(r"[A-Za-z0-9_-]+", doc["intersection_id"]))
            and "T" in env["timestamp"]
            and env["source"] in EVENT_SOURCES
            and tel["current_signal_state"] in SIGNAL_STATES
            and all(type(n) in (int, float) and n >= 0 for n in numbers)
            and (doc.get("metadata") is None or isinstance(doc["metadata"], dict))
        )
    except (TypeError, KeyError, ValueError, AttributeError):
        return False


def test_random_documents_against_plain_python(spark):
    rng = random.Random(7)
    values = [None, 1, -1, 2.5, "x", "", "RED", "simulator", True, [], {}, {"a": 1}, DROP,
              "2026-06-05T09:17:40Z", "osm-1", "7c1d52ab-03f6-4e18-9b7a-5d20c6e4f811"]
    paths = ["event_id", "intersection_id", "environment", "telemetry", "metadata",
             "environment__timestamp", "environment__source", "environment__x",
             "telemetry__current_signal_state", "telemetry__avg_stop_duration_seconds",
             "telemetry__avg_vehicle_speed_kmh", "telemetry__x", "x"]
    docs = []
    for _ in range(600):
        doc = event()
        for path in rng.sample(paths, rng.choice([0, 1, 1, 2])):
            *parents, last = path.split("__")
            target = doc
            for name in parents:
                target = target.get(name) if isinstance(target, dict) else None
            if isinstance(target, dict):
                value = rng.choice(values)
                if value is DROP:
                    target.pop(last, None)
                else:
                    target[last] = value
        docs.append(doc)
    got = [not r for r in reasons(spark, *docs)]
    want = [sound(d) for d in docs]
    assert [d for d, g, w in zip(docs, got, want) if g != w] == []
    assert 50 < sum(want) < 500


def test_routing_keeps_bad_payloads_as_they_came(spark):
    bad = event(telemetry=DROP)
    rows = texts(
        spark,
        event(
            event_id="7C1D52AB-03F6-4E18-9B7A-5D20C6E4F811",
            environment__timestamp="2026-06-05T06:17:40.5-03:00",
            telemetry__avg_vehicle_speed_kmh=18,
            metadata=None,
        ),
        event(metadata={"osm": 5}),
        bad,
        "{broken",
    )
    routed = {r.value: (r.topic, r.key) for r in v.route_events(v.validate_events(rows)).collect()}
    first, second = (
        '{"event_id":"7c1d52ab-03f6-4e18-9b7a-5d20c6e4f811","intersection_id":"osm-1",'
        '"environment":{"timestamp":"%s","source":"simulator"},'
        '"telemetry":{"current_signal_state":"RED","avg_stop_duration_seconds":31.25,'
        '"avg_vehicle_speed_kmh":%s}%s}' % parts
        for parts in (
            ("2026-06-05T09:17:40.500000Z", "18.0", ""),
            ("2026-06-05T09:17:40Z", "26.75", ',"metadata":{"osm":5}'),
        )
    )
    assert routed == {
        first: ("traffic-events", "osm-1"),
        second: ("traffic-events", "osm-1"),
        json.dumps(bad): ("traffic-events-dlq", "osm-1"),
        "{broken": ("traffic-events-dlq", "unknown"),
    }


def test_normalised_events_are_valid_again(spark):
    routed = v.route_events(v.validate_events(texts(spark, *[d for d, r in CASES if not r])))
    again = v.validate_events(routed.select("value"))
    assert again.filter(~v.is_valid()).count() == 0


def test_lines_wrap_rejects(spark):
    lines = v.json_lines(v.route_events(v.validate_events(texts(spark, {"a": 1}, "{x", event()))))
    parsed = [json.loads(r.value) for r in lines.collect()]
    assert {"dlq": {"a": 1}} in parsed and {"dlq": "{x"} in parsed
    assert sum("dlq" not in p for p in parsed) == 1


def test_rate_and_counts(spark):
    rows = texts(spark, *[event()] * 3, "{x")
    checked = v.validate_events(rows)
    assert tuples(v.invalid_rate(checked)) == [(4, 1, 0.25, False)]
    assert v.invalid_rate(checked, limit=0.25).first().within_limit
    seen = Observation("ingest")
    observe_ingest(checked, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"event_count": 4, "invalid_count": 1}


def test_flatten_is_lax_where_validation_is_strict(spark):
    rows = texts(
        spark,
        event(event_id="e1", telemetry__avg_stop_duration_seconds="12.5"),
        event(environment__timestamp="2026-06-05T09:17:40-03:00"),
        event(telemetry=DROP),
        "{x",
    )
    flat = flatten_documents(v.parse_documents(rows), "seq")
    assert flat.count() == 4
    got = tuples(usable(flat), "seq", "event_timestamp", "avg_stop_duration_seconds", "event_id")
    assert got == [
        (0, dt.datetime(2026, 6, 5, 9, 17, 40), 12.5, "e1"),
        (1, dt.datetime(2026, 6, 5, 12, 17, 40), 31.25, "7c1d52ab-03f6-4e18-9b7a-5d20c6e4f811"),
    ]


def test_a_row_is_parsed_once_whatever_is_filtered(spark):
    checked = v.validate_events(texts(spark, event()))
    strict = usable(flatten_documents(checked.filter(v.is_valid())))
    text = strict._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("try_parse_json") + text.count("parseJson") <= 2


@pytest.mark.parametrize(
    "column, value, reason",
    [
        ("display_name", None, "missing_field"),
        ("source", None, "missing_field"),
        ("intersection_id", "a b", "bad_intersection_id"),
        ("latitude", 90.5, "bad_latitude"),
        ("longitude", -180.5, "bad_longitude"),
        ("source", "survey", "bad_source"),
    ],
)
def test_inventory_rules(spark, column, value, reason):
    good = inventory(spark, "a")
    assert v.inventory_violations(good.withColumn("osm_node_id", F.lit(None))).count() == 0
    bad = good.withColumn(column, F.lit(value).cast(INVENTORY[column].dataType))
    assert [tuple(r.reasons) for r in v.inventory_violations(bad).collect()] == [(reason,)]
