"""The latest row of every intersection as a table of its own, kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from signalmill.operators.status import advance_latest, latest_status
from signalmill.schemas import CORE, require_shape
from signalmill.sources.landing import ensure_table, replace_days

STORED = T.StructType(CORE.fields + [T.StructField("bucket", T.IntegerType())])
# A bucket is what one change of an intersection rewrites; fixed for a table.
BUCKETS = 64


def upsert_latest(rows: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Move the table on by rows of core; only the buckets of their intersections are rewritten.

    The rows are reduced to one per intersection first. Rows that are older than what the table
    holds change nothing, and the same rows twice neither.
    """
    spark = rows.sparkSession
    by_id = F.pmod(F.xxhash64("intersection_id"), F.lit(buckets)).cast("int")
    new = latest_status(require_shape(rows, CORE)).withColumn("bucket", by_id).persist()
    try:
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]
        if touched:
            ensure_table(spark, path, STORED, ("bucket",))
            held = spark.read.schema(STORED).parquet(path).filter(F.col("bucket").isin(touched))
            replace_days(advance_latest(held, new), path, ("bucket",))
    finally:
        new.unpersist()


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The latest rows; they answer list, lookup and health without the history."""
    return spark.read.schema(STORED).parquet(path).select(*CORE.fieldNames())
