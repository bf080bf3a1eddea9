"""Strict checks of raw JSON events, as one list of reasons per row.

The text is parsed once into a variant, for its shape, and read once for the fields of an event.
Every rule looks at those two, so a row costs the same however many rules there are, and nothing
leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalmill.functions.times import iso_seconds, parse_instant
from signalmill.schemas import (
    ENVIRONMENT_KEYS,
    EVENT_SOURCES,
    EVENT_TEXT,
    ID_PATTERN,
    INVENTORY_SOURCES,
    MAX_INVALID_SHARE,
    OPTIONAL_ROOT_KEYS,
    ROOT_KEYS,
    SIGNAL_STATES,
    TELEMETRY_KEYS,
    UUID_PATTERN,
)

UNKNOWN_KEY = "unknown"


# What ``schema_of_variant`` says about an event with the right keys and kinds of value. Odd
# key names come back in backquotes, so they cannot pass for other keys. Metadata that nests
# further objects is left to the detailed rules.
_NUMBER = r"(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"
REGULAR_SHAPE = (
    r"^ARRAY<OBJECT<environment: OBJECT<source: STRING, timestamp: STRING>, "
    r"event_id: STRING, intersection_id: STRING, (metadata: (VOID|OBJECT<[^<>]*>), )?"
    rf"telemetry: OBJECT<avg_stop_duration_seconds: {_NUMBER}, "
    rf"avg_vehicle_speed_kmh: {_NUMBER}, current_signal_state: STRING>>>\z"
)


def _at(doc: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(doc, path, kind)


def _keys(doc: Column, path: str) -> Column:
    """Keys of the object at ``path``; null when there is no object."""
    return F.map_keys(_at(doc, path, "map<string,variant>"))


def _with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` behind a generator of one row.

    A filter on anything derived from the column then stays above. Below a plain projection it
    would be inlined, and the value computed again for every use. The value itself is computed
    in a projection, as a generator is not compiled.
    """
    held = f"_{name}"
    rows = df.withColumn(held, value)
    return rows.withColumn(name, F.explode(F.array(held))).drop(held)


def parse_documents(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``doc``, the parsed JSON text, and ``fields``, its event fields as far as readable.

    The parser stops after the first complete value, so the text goes in as the only element of
    an array: anything behind the object then breaks the syntax or adds an element. A text that
    closes that array by itself has ``}`` before ``]``; only such texts are parsed a second
    time, as a member of an object, where the same trick fails. ``doc`` is that array, for
    taking the element out would copy it, and null when the text is not exactly one object.

    The fields come out of a second reader that takes each as text: with seven fields that is
    quicker than as many lookups in the variant, every one of which builds a cast.
    """
    value = F.col(value_col)
    as_element = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    as_member = F.try_parse_json(F.concat(F.lit('{"e":'), value, F.lit("}")))
    closes_array = value.rlike(r"\}\s*\]") & as_member.isNull()
    array, read = F.col("_array"), F.col("_read")
    # Elements that are no numbers become null, which leaves their count.
    elements = F.size(_at(array, "$", "array<int>"))
    whole = (elements == 1) & value.rlike(r"^[ \t\r\n]*\{") & ~closes_array
    fields = F.struct(
        read["event_id"].alias("event_id"),
        read["intersection_id"].alias("intersection_id"),
        parse_instant(read["environment"]["timestamp"]).alias("event_timestamp"),
        read["environment"]["source"].alias("source"),
        read["telemetry"]["current_signal_state"].alias("signal_state"),
        *[
            read["telemetry"][measure].try_cast("double").alias(measure)
            for measure in ("avg_stop_duration_seconds", "avg_vehicle_speed_kmh")
        ],
    )
    parsed = df.withColumn("_array", as_element)
    parsed = _with_once(parsed, "doc", F.when(whole, array)).drop("_array")
    as_text = F.when(F.col("doc").isNotNull(), F.from_json(value, EVENT_TEXT))
    return _with_once(parsed.withColumn("_read", as_text), "fields", fields).drop("_read")


def _parts(doc: Column) -> Column:
    """Members of the object and of its two inner objects, each null where there is no object."""
    members = "map<string,variant>"
    return F.struct(
        _at(doc, "$[0]", members).alias("root"),
        _at(doc, "$[0].environment", members).alias("environment"),
        _at(doc, "$[0].telemetry", members).alias("telemetry"),
    )


def _broken_rules(parts: Column) -> Column:
    """Every rule on its own, for documents that are known or feared to break one."""
    root, env, tel = parts["root"], parts["environment"], parts["telemetry"]
    fields = F.col("fields")

    def names(values) -> Column:
        return F.array(*[F.lit(v) for v in values])

    def lacks(members: Column, required) -> Column:
        missing = F.size(F.array_except(names(required), F.map_keys(members))) > 0
        return F.coalesce(missing, F.lit(True))

    def has_more(members: Column, allowed) -> Column:
        more = F.size(F.array_except(F.map_keys(members), names(allowed))) > 0
        return F.coalesce(more, F.lit(False))

    def bad(members: Column, name: str, kind: str, ok: Column) -> Column:
        """The field is there, and is of another kind or breaks its rule."""
        found = F.schema_of_variant(members[name])
        of_kind = found.rlike(rf"^{kind}\z")
        return F.when(of_kind, ~F.coalesce(ok, F.lit(False))).otherwise(members[name].isNotNull())

    metadata = F.schema_of_variant(root["metadata"])
    rules = [
        (
            "missing_field",
            lacks(root, ROOT_KEYS) | lacks(env, ENVIRONMENT_KEYS) | lacks(tel, TELEMETRY_KEYS),
        ),
        (
            "extra_key",
            has_more(root, ROOT_KEYS + OPTIONAL_ROOT_KEYS)
            | has_more(env, ENVIRONMENT_KEYS)
            | has_more(tel, TELEMETRY_KEYS),
        ),
        ("bad_event_id", bad(root, "event_id", "STRING", fields["event_id"].rlike(UUID_PATTERN))),
        (
            "bad_intersection_id",
            bad(root, "intersection_id", "STRING", fields["intersection_id"].rlike(ID_PATTERN)),
        ),
        ("bad_timestamp", bad(env, "timestamp", "STRING", fields["event_timestamp"].isNotNull())),
        ("bad_source", bad(env, "source", "STRING", fields["source"].isin(*EVENT_SOURCES))),
        (
            "bad_state",
            bad(tel, "current_signal_state", "STRING", fields["signal_state"].isin(*SIGNAL_STATES)),
        ),
        *[
            (reason, bad(tel, measure, _NUMBER, fields[measure] >= 0))
            for reason, measure in (
                ("bad_stop_duration", "avg_stop_duration_seconds"),
                ("bad_speed", "avg_vehicle_speed_kmh"),
            )
        ],
        ("bad_metadata", ~metadata.rlike("^(VOID|OBJECT<)")),
    ]
    # As text first: a filter of an array is not compiled, nor is anything inside of it.
    broken = F.concat_ws(",", *[F.when(rule, F.lit(name)) for name, rule in rules])
    return F.when(broken != "", F.split(broken, ",")).otherwise(F.array().cast("array<string>"))


def _sound() -> Column:
    """Whether a parsed row breaks no rule, by one look at its shape and the rules for its values."""
    fields = F.col("fields")
    return F.coalesce(
        F.schema_of_variant("doc").rlike(REGULAR_SHAPE)
        & fields["event_timestamp"].isNotNull()
        & fields["source"].isin(*EVENT_SOURCES)
        & fields["signal_state"].isin(*SIGNAL_STATES)
        & (fields["avg_stop_duration_seconds"] >= 0)
        & (fields["avg_vehicle_speed_kmh"] >= 0)
        & fields["intersection_id"].rlike(ID_PATTERN)
        & fields["event_id"].rlike(UUID_PATTERN),
        F.lit(False),
    )


def validate_events(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``doc``, ``fields`` and ``reasons`` to raw events; aggregation does not need it.

    ``reasons`` says why a row is not a valid event and is empty when it is one. Most events are
    sound, so that is asked first; only the others are taken apart, once, and go through the rules
    one by one.
    """
    doc, parts = F.col("doc"), F.col("_parts")
    taken_apart = F.when(doc.isNotNull() & ~_sound(), _parts(doc))
    rows = _with_once(parse_documents(df, value_col), "_parts", taken_apart)
    reasons = (
        F.when(doc.isNull(), F.array(F.lit("malformed")))
        .when(parts.isNull(), F.array().cast("array<string>"))
        .otherwise(_broken_rules(parts))
    )
    return _with_once(rows, "reasons", reasons).drop("_parts")


def is_valid() -> Column:
    return F.size("reasons") == 0


def event_key() -> Column:
    return F.coalesce(F.col("fields.intersection_id"), F.lit(UNKNOWN_KEY))


def normalised_event() -> Column:
    """The event as JSON text in contract order, without null fields, time in UTC."""
    doc, fields = F.col("doc"), F.col("fields")
    # Asking for a path that is not there is slow, so the keys are asked first.
    has_metadata = F.array_contains(_keys(doc, "$[0]"), "metadata") & ~F.is_variant_null(
        _at(doc, "$[0].metadata")
    )
    return F.to_json(
        F.struct(
            F.lower(fields["event_id"]).alias("event_id"),
            fields["intersection_id"].alias("intersection_id"),
            F.struct(
                iso_seconds(fields["event_timestamp"]).alias("timestamp"),
                fields["source"].alias("source"),
            ).alias("environment"),
            F.struct(
                fields["signal_state"].alias("current_signal_state"),
                fields["avg_stop_duration_seconds"].alias("avg_stop_duration_seconds"),
                fields["avg_vehicle_speed_kmh"].alias("avg_vehicle_speed_kmh"),
            ).alias("telemetry"),
            F.when(has_metadata, _at(doc, "$[0].metadata")).alias("metadata"),
        )
    )


def route_events(
    validated: DataFrame,
    topic: str = "traffic-events",
    dead_letter_topic: str = "traffic-events-dlq",
    value_col: str = "value",
) -> DataFrame:
    """One row per event with its ``topic``, ``key`` and ``value``.

    Valid and invalid rows leave in the same pass: a Kafka sink reads the topic from the
    column, a file sink partitions by it. So nothing is cached and no row is parsed twice.
    """
    return validated.select(
        F.when(is_valid(), F.lit(topic)).otherwise(F.lit(dead_letter_topic)).alias("topic"),
        event_key().alias("key"),
        F.when(is_valid(), normalised_event()).otherwise(F.col(value_col)).alias("value"),
        "reasons",
    )


def json_lines(routed: DataFrame, dead_letter_topic: str = "traffic-events-dlq") -> DataFrame:
    """Routed rows as text lines; a rejected payload is wrapped as ``{"dlq": …}``."""
    parsed = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]")))
    wrapped = F.when(
        parsed.isNotNull(), F.concat(F.lit('{"dlq":'), F.col("value"), F.lit("}"))
    ).otherwise(F.to_json(F.struct(F.col("value").alias("dlq"))))
    return routed.select(
        F.when(F.col("topic") == dead_letter_topic, wrapped)
        .otherwise(F.col("value"))
        .alias("value")
    )


def invalid_rate(validated: DataFrame, limit: float = MAX_INVALID_SHARE) -> DataFrame:
    """One row: events, rejected events, their share, and whether the share is acceptable."""
    invalid = (~is_valid()).cast("double")
    return validated.agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(~is_valid()).alias("invalid_count"),
        F.avg(invalid).alias("invalid_share"),
        (F.avg(invalid) <= F.lit(limit)).alias("within_limit"),
    )


def inventory_reasons() -> Column:
    """Why an inventory row breaks its contract; the map node id is optional."""
    lat, lon = F.col("latitude"), F.col("longitude")
    required = ("intersection_id", "display_name", "latitude", "longitude", "source")
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    rules = [
        ("missing_field", missing),
        ("bad_intersection_id", ~F.col("intersection_id").rlike(ID_PATTERN)),
        ("bad_latitude", ~lat.between(-90, 90)),
        ("bad_longitude", ~lon.between(-180, 180)),
        ("bad_source", ~F.col("source").isin(*INVENTORY_SOURCES)),
    ]
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))


def inventory_violations(inventory: DataFrame) -> DataFrame:
    """Inventory rows that break the contract, each with its reasons."""
    return inventory.withColumn("reasons", inventory_reasons()).filter(F.size("reasons") > 0)
