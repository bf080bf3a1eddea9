"""Raw events from text files or a topic, and the sinks for routed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from signalmill.operators.validation import is_valid


def topic_options(
    servers: str,
    topic: str = "traffic-events",
    *,
    earliest: bool = False,
    min_partitions: int | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source; a stream starts at new messages unless ``earliest``.

    ``min_partitions`` above the number of topic partitions lets several tasks share one of
    them, as a topic needs where one intersection sends much of the data.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if earliest else "latest",
        "failOnDataLoss": "true",
    }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def topic_rows(records: DataFrame) -> DataFrame:
    """Kafka records as key, text value and ``seq``.

    Events of one intersection share a key, hence a topic partition, so the offset is their
    order of arrival.
    """
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("offset").alias("seq"),
    )


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str = "traffic-events",
    *,
    until: str | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Everything in the topic now, or up to the end offsets ``until``.

    ``until`` is JSON of the Kafka source, such as ``{"topic": {"0": 500}}``: it bounds a read
    where it starts, and the same offsets give the same events again.
    """
    options = topic_options(servers, topic, earliest=True, min_partitions=min_partitions)
    if until is not None:
        options["endingOffsets"] = until
    return topic_rows(spark.read.format("kafka").options(**options).load())


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str = "traffic-events",
    **options,
) -> DataFrame:
    """The topic as a stream; ``options`` are those of :func:`topic_options`."""
    chosen = topic_options(servers, topic, **options)
    return topic_rows(spark.readStream.format("kafka").options(**chosen).load())


def arrival() -> Column:
    """Order of arrival of lines of text: by time and name of the file, block, and place in it.

    A block is read by one task from its start on, so the running number of its rows is their
    order there. It is a struct, which sorts; numbering all lines would take a pass of its own.
    """
    return F.struct(
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_text(spark: SparkSession, path: str, *, ordered: bool = False) -> DataFrame:
    """One JSON event per line; ``ordered`` adds their arrival as ``seq``, which decides ties."""
    lines = spark.read.text(path)
    return lines.select("value", arrival().alias("seq")) if ordered else lines


def stream_text(
    spark: SparkSession, path: str, *, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def observe_ingest(validated: DataFrame, observation: Observation | str) -> DataFrame:
    """Count events and rejects on the way through, without a second pass."""
    return validated.observe(
        observation,
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(~is_valid()).alias("invalid_count"),
    )


def write_routed(routed: DataFrame, path: str, load: str = "all") -> None:
    """Files with one folder per topic, below that of the load, which is replaced whole."""
    routed.write.mode("overwrite").partitionBy("topic").json(f"{path.rstrip('/')}/load={load}")


def write_topics(routed: DataFrame, servers: str) -> None:
    """Each row to the topic its column names, keyed by intersection."""
    (
        routed.select("topic", "key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )


def write_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    lines.select("value").write.mode(mode).text(path)
