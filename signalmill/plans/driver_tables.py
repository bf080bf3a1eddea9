"""The given tables read as telemetry.

``events`` supplies the events and ``supplier`` the inventory. Event ids 0, 1, 2 … of users and
even numbers for inventory entries make every case occur at every scale: half of the sending
ids are unknown to the inventory, and a quarter of the inventory never sends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from signalmill.functions.times import iso_seconds
from signalmill.operators.models import build_core, staging
from signalmill.operators.windows import landing_rows, window_aggregate
from signalmill.schemas import INVENTORY, SIGNAL_STATES
from signalmill.session import configure

# 2024-01-01 00:00:00 UTC. Raw events are four minutes apart; 1440 turns their 30 days into 30
# minutes, so that minutes hold several events of one id.
BASE_MICROS = 1_704_067_200_000_000
SPEED_UP = 1440
FRESH_AS_OF = "2024-01-01 00:31:00"
STALE_AS_OF = "2024-01-01 00:40:00"

STATE_OF_TYPE = {
    "click": "GREEN",
    "error": "RED",
    "purchase": "YELLOW",
    "signup": "FLASHING_YELLOW",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def device(number: Column) -> Column:
    return F.concat(F.lit("osm-"), number.cast("string"))


def as_events(rows: DataFrame, speed_up: int = SPEED_UP) -> DataFrame:
    """Rows of ``events``, in a batch or a stream, as flat events.

    With a ``speed_up`` of 1 they keep their 30 days.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    state = F.lit(None).cast("string")
    for kind, name in STATE_OF_TYPE.items():
        state = F.when(F.col("event_type") == kind, F.lit(name)).otherwise(state)
    return rows.select(
        device(F.col("user_id")).alias("intersection_id"),
        F.timestamp_micros(
            F.lit(BASE_MICROS) + F.floor((micros - F.lit(BASE_MICROS)) / F.lit(speed_up))
        ).alias("event_timestamp"),
        F.coalesce(state, F.lit("UNKNOWN")).alias("signal_state"),
        F.col("value").alias("avg_stop_duration_seconds"),
        (F.get_json_object("props", "$.k").cast("int") / F.lit(2.0)).alias(
            "avg_vehicle_speed_kmh"
        ),
        F.col("event_id").alias("seq"),
    )


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(table(spark, sf_dir, "events"))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .select(
            device(key * 2).alias("intersection_id"),
            F.col("s_name").alias("display_name"),
            (F.lit(-27.13) + (key * 37 % 1000) * F.lit(0.0001)).alias("latitude"),
            (F.lit(-52.68) + (key * 91 % 1000) * F.lit(0.0002)).alias("longitude"),
            key.alias("osm_node_id"),
            F.lit("osm").alias("source"),
        )
        .select(*INVENTORY.fieldNames())
    )


def _copies(doubled: Column) -> Column:
    return F.when(doubled, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))


def faulty_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory with a contract fault in one of five entries, and one in twenty doubled."""
    rows = inventory(spark, sf_dir)
    kind = F.col("osm_node_id") % 20

    def broken(name: str, when: int, value: Column) -> Column:
        return F.when(kind == when, value).otherwise(F.col(name)).alias(name)

    return rows.withColumn("copy", F.explode(_copies(kind == 4))).select(
        broken("intersection_id", 1, F.concat("intersection_id", F.lit(" x"))),
        broken("display_name", 2, F.lit(None).cast("string")),
        broken("latitude", 5, F.lit(95.0)),
        broken("longitude", 6, F.lit(-181.0)),
        "osm_node_id",
        broken("source", 7, F.lit("survey")),
    )


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_aggregate(flat_events(spark, sf_dir), seq_col="seq", states=SIGNAL_STATES)


def daily_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing of the events as they are, over 30 days."""
    events = as_events(table(spark, sf_dir, "events"), speed_up=1)
    rows = window_aggregate(events, seq_col="seq", states=SIGNAL_STATES)
    return landing_rows(rows, load_time(F.col("window_end")))


def load_time(window_end: Column) -> Column:
    """Five to eleven seconds after the window, by id, so that lags differ."""
    number = F.substring_index("intersection_id", "-", -1).cast("bigint")
    return F.timestamp_micros(F.unix_micros(window_end) + (number % 7 + 5) * 1_000_000)


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_rows(windows(spark, sf_dir), load_time(F.col("window_end")))


def text_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing as an older store holds it: times as text, some with ``Z``, states in lower case."""
    zulu = iso_seconds(F.col("window_end"))
    bare = F.date_format("window_end", "yyyy-MM-dd'T'HH:mm:ss")
    return landing(spark, sf_dir).select(
        "intersection_id",
        F.when(F.col("event_count") % 2 == 0, zulu).otherwise(bare).alias("window_end"),
        F.lower("signal_state").alias("signal_state"),
        "avg_stop_duration_seconds",
        "avg_vehicle_speed_kmh",
        "event_count",
        F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
    )


def faulty_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing with nulls, foreign states and repeated rows planted by id and minute."""
    rows = landing(spark, sf_dir)
    number = F.substring_index("intersection_id", "-", -1).cast("bigint") % 50
    tenth = F.minute("window_end") % 10 == 0
    state = (
        F.when((number == 1) & tenth, F.lit(None).cast("string"))
        .when((number == 2) & tenth, F.lit("BLUE"))
        .otherwise(F.col("signal_state"))
    )
    copies = F.explode(_copies((number == 3) & tenth))
    return rows.withColumn("signal_state", state).withColumn("copy", copies).drop("copy")


def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_core(staging(landing(spark, sf_dir)), inventory(spark, sf_dir))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as JSON text, one in ten with a fault."""
    flat = flat_events(spark, sf_dir)
    fault = F.col("seq") % 100

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    def unless(when: int, broken: Column, sound: Column) -> Column:
        return F.when(fault == when, broken).otherwise(sound)

    quoted = lambda value: F.concat(F.lit('"'), value, F.lit('"'))
    event_id = F.concat(
        F.lit("00000000-0000-4000-8000-"), F.lpad(F.lower(F.hex("seq")), 12, "0")
    )
    stop = text("avg_stop_duration_seconds")
    telemetry = F.concat(
        F.lit(',"telemetry":{"current_signal_state":"'),
        unless(53, F.lit("BLUE"), F.col("signal_state")),
        F.lit('","avg_stop_duration_seconds":'),
        unless(73, quoted(stop), stop),
        F.lit(',"avg_vehicle_speed_kmh":'),
        unless(63, F.lit("-1"), text("avg_vehicle_speed_kmh")),
        F.lit("}"),
    )
    document = F.concat(
        F.lit('{"event_id":"'),
        unless(23, F.lit("not-a-uuid"), event_id),
        F.lit('","intersection_id":"'),
        unless(33, F.concat("intersection_id", F.lit(" x")), F.col("intersection_id")),
        F.lit('","environment":{"timestamp":"'),
        unless(
            93,
            F.lit("14:30"),
            F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        ),
        F.lit('","source":"'),
        unless(43, F.lit("other"), F.lit("simulator")),
        F.lit('"}'),
        unless(3, F.lit(""), telemetry),
        unless(13, F.lit(',"extra":1'), F.lit("")),
        F.lit("}"),
    )
    return flat.select(
        "seq", unless(83, F.substring(document, 1, 20), document).alias("value")
    )


def map_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a JSON map element with some of the name tags, a hundred a document."""
    key, kind = F.col("s_suppkey"), F.col("s_suppkey") % 6
    name = F.col("s_name")
    tags = F.map_filter(
        F.create_map(
            F.lit("name"), F.when(kind == 0, name).when(kind == 1, F.lit("")),
            F.lit("name:pt"), F.when(kind == 1, F.concat(F.lit("pt "), name)),
            F.lit("ref"), F.when(kind == 2, F.concat(F.lit("R"), key.cast("string"))),
            F.lit("crossing:ref"), F.when(kind == 3, F.concat(F.lit("C"), key.cast("string"))),
            F.lit("direction"), F.when(kind == 4, F.lit("forward")),
            F.lit("highway"), F.when(key % 7 == 6, F.lit("crossing"))
            .when(key % 7 != 5, F.lit("traffic_signals")),
        ),
        lambda _, value: value.isNotNull(),
    )
    element = F.struct(
        F.when(F.col("s_nationkey") == 3, F.lit("way")).otherwise(F.lit("node")).alias("type"),
        key.alias("id"),
        (F.lit(-27.0) - key % 1000 / F.lit(30000.0)).alias("lat"),
        (F.lit(-52.0) - key % 1000 / F.lit(7000.0)).alias("lon"),
        tags.alias("tags"),
    )
    head = F.struct(F.lit("a {brace} and [").alias("note"))
    document = F.struct(head.alias("head"), F.collect_list(element).alias("elements"))
    number = F.floor(key / 100)
    rows = table(spark, sf_dir, "supplier").groupBy(number)
    return rows.agg(F.to_json(document).alias("value")).select("value")
