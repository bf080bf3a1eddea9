import struct

import pytest
from pyspark.sql import functions as F

from helpers import CORE, at, inventory, landing, plan, stored, tuples
from signalmill.functions import point_wkb, point_x, point_y, register_functions
from signalmill.operators import models
from signalmill.operators.merge import merge_rows, snapshot_diff
from signalmill.schemas import LANDING, same_shape


def row(key, end="18:01:00", state="RED", stop=1.0, speed=50.0, ingested="18:01:05"):
    return (key, end, state, stop, speed, 1, ingested)


@pytest.mark.parametrize(
    "stop, speed, severe",
    [(80.0, 3.0, True), (90.0, 15.0, False), (30.0, 2.0, False), (75.0, 5.0, False),
     (75.0, 3.0, False), (80.0, 5.0, False), (None, 3.0, None), (None, 9.0, False),
     (80.0, None, None), (30.0, None, False)],
)
def test_severe_flag(spark, stop, speed, severe):
    rows = landing(spark, row("a", stop=stop, speed=speed))
    core = models.build_core(models.staging(rows), inventory(spark, "a"))
    assert core.first().is_severe_bottleneck is severe
    register_functions(spark)
    core.createOrReplaceTempView("c")
    sql = "SELECT is_severe_bottleneck(avg_stop_duration_seconds, avg_vehicle_speed_kmh) AS x FROM c"
    assert spark.sql(sql).first().x is severe


def test_staging_reads_text_times(spark):
    rows = spark.createDataFrame(
        [("a", "2026-06-05T18:01:00Z", "red", 1.0, 2.0, 3, "2026-06-05T18:01:05"),
         ("a", "2026-06-05T18:02:00", "Flashing_Yellow", 1.0, 2.0, 3, None)],
        "intersection_id string, window_end string, signal_state string, "
        "avg_stop_duration_seconds double, avg_vehicle_speed_kmh double, event_count bigint, "
        "ingested_at string",
    )
    staged = models.staging(rows)
    assert same_shape(staged.schema, LANDING) == []
    assert tuples(staged, "window_end", "signal_state", "ingested_at") == [
        (at("18:01:00"), "RED", at("18:01:05")),
        (at("18:02:00"), "FLASHING_YELLOW", None),
    ]


def test_core_keeps_unknown_ids_and_reports_them(spark):
    rows = landing(
        spark, row("a"), row("unknown-999"), row("unknown-999", "18:02:00"), row("b", "18:03:00")
    )
    places = inventory(spark, "a", "b", "silent")
    staged = models.staging(rows)
    core = models.build_core(staged, places)
    assert same_shape(core.schema, CORE) == []
    assert core.count() == 4
    orphan = core.filter("intersection_id = 'unknown-999'").first()
    assert orphan.display_name is None and orphan.spatial_geography_point is None
    assert tuples(models.orphan_report(staged, places)) == [
        ("unknown-999", 2, at("18:01:00"), at("18:02:00"))
    ]
    assert models.build_core(staged, places, on_missing="drop").count() == 2
    assert models.orphan_report(staged, places.filter("false")).count() == 3
    with pytest.raises(ValueError):
        models.build_core(staged, places, on_missing="ignore")


def test_points(spark):
    places = inventory(spark, "a").union(inventory(spark, "b").withColumn("latitude", F.lit(None)))
    core = models.build_core(models.staging(landing(spark, row("a"), row("b"))), places)
    point = F.col("spatial_geography_point")
    got = core.orderBy("intersection_id").select(
        point_x(point).alias("x"),
        point_y(point).alias("y"),
        point_wkb(F.col("longitude"), F.col("latitude")).alias("wkb"),
    )
    first, second = got.collect()
    assert (first.x, first.y) == (-52.6, -27.1)
    assert bytes(first.wkb) == struct.pack(">BIdd", 0, 1, -52.6, -27.1)
    assert (second.x, second.y, second.wkb) == (None, None, None)


def test_merge_rows_replaces_by_key(spark):
    old = landing(spark, row("a"), row("b"))
    new = landing(spark, row("a", state="GREEN"), row("a", "18:02:00"))
    merged = merge_rows(old, new)
    assert tuples(merged, "intersection_id", "window_end", "signal_state") == [
        ("a", at("18:01:00"), "GREEN"),
        ("a", at("18:02:00"), "RED"),
        ("b", at("18:01:00"), "RED"),
    ]
    assert tuples(merge_rows(merged, new)) == tuples(merged)


def test_snapshot_diff(spark):
    old = landing(spark, row("same"), row("gone"), row("moved"), row("null", state=None))
    new = landing(
        spark, row("same"), row("moved", state="GREEN"), row("fresh"), row("null", state=None)
    )
    diff = snapshot_diff(old, new, "intersection_id", "signal_state")
    assert tuples(diff) == [
        ("fresh", "added", None, "RED"),
        ("gone", "removed", "RED", None),
        ("moved", "changed", "RED", "GREEN"),
        ("null", "unchanged", None, None),
        ("same", "unchanged", "RED", "RED"),
    ]


def test_the_inventory_is_broadcast_by_size_only(spark, folder):
    staged = models.staging(stored(landing(spark, row("a")), folder + "/landing"))
    places = stored(inventory(spark, "a"), folder + "/inventory")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        assert "BroadcastHashJoin" in plan(models.build_core(staged, places))
        spark.conf.set(limit, "-1")
        assert "SortMergeJoin" in plan(models.build_core(staged, places))
    finally:
        spark.conf.set(limit, before)


def test_a_hot_intersection_is_split_in_the_large_join(spark):
    """With an inventory too big to broadcast, the adaptive join splits the hot id's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, x in settings.items():
            spark.conf.set(k, x)
        n = F.col("id")
        key = F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("i"), n.cast("string")))
        staged = spark.range(0, 60000, 1, 8).select(
            key.alias("intersection_id"),
            F.timestamp_seconds(n * 60).alias("window_end"),
            F.lit("RED").alias("signal_state"),
            F.rand(1).alias("avg_stop_duration_seconds"),
            F.rand(2).alias("avg_vehicle_speed_kmh"),
            n.alias("event_count"),
            F.timestamp_seconds(n * 60).alias("ingested_at"),
        )
        places = spark.range(30000).select(
            F.when(n == 0, F.lit("hot"))
            .otherwise(F.concat(F.lit("i"), n.cast("string")))
            .alias("intersection_id"),
            F.lit("x").alias("display_name"),
            F.lit(1.0).alias("latitude"),
            F.lit(2.0).alias("longitude"),
        )
        core = models.build_core(staged, places)
        rows = core.collect()
        assert len(rows) == 60000
        assert sum(r.display_name is not None for r in rows) == 20000 + 29999 - 9999
        assert "skew=true" in plan(core)
    finally:
        for k, x in before.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)
