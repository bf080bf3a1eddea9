"""Literal rows for the tests."""

import datetime as dt
import json

from signalmill.schemas import CORE, FLAT_EVENT, INVENTORY, LANDING
from pyspark.sql import types as T

DAY = dt.datetime(2026, 6, 5)
EVENT = T.StructType(FLAT_EVENT.fields + [T.StructField("seq", T.LongType())])


def at(text):
    """A time of the test day, or a whole ISO text."""
    if len(text) > 8:
        return dt.datetime.fromisoformat(text)
    return dt.datetime.combine(DAY.date(), dt.time.fromisoformat(text))


def events(spark, *rows):
    """Rows of (id, time, state, stop, speed), arriving in this order."""
    full = [(r[0], at(r[1]), *r[2:], i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, EVENT)


def landing(spark, *rows):
    """Rows of (id, window end, state, stop, speed, count, ingested)."""
    full = [
        (r[0], None if r[1] is None else at(r[1]), *r[2:6], None if r[6] is None else at(r[6]))
        for r in rows
    ]
    return spark.createDataFrame(full, LANDING)


def inventory(spark, *ids):
    rows = [
        (i, f"Crossing {i}", -27.1 + n / 1000, -52.6 - n / 1000, n, "osm")
        for n, i in enumerate(ids)
    ]
    return spark.createDataFrame(rows, INVENTORY)


def event(**changes):
    """A valid event document; keyword paths like ``telemetry__x`` change one field."""
    doc = {
        "event_id": "7c1d52ab-03f6-4e18-9b7a-5d20c6e4f811",
        "intersection_id": "osm-1",
        "environment": {"timestamp": "2026-06-05T09:17:40Z", "source": "simulator"},
        "telemetry": {
            "current_signal_state": "RED",
            "avg_stop_duration_seconds": 31.25,
            "avg_vehicle_speed_kmh": 26.75,
        },
    }
    for path, value in changes.items():
        *parents, last = path.split("__")
        target = doc
        for name in parents:
            target = target[name]
        if value is DROP:
            target.pop(last)
        else:
            target[last] = value
    return doc


DROP = object()


def texts(spark, *docs):
    rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "seq bigint, value string")


def tuples(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(df, path):
    """The frame read back from files, so that Spark knows its size."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = [n for n in dir() if not n.startswith("_")] + ["CORE"]
