"""Key-wise merging as plain DataFrame algebra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from signalmill.schemas import LANDING_KEY


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order.

    Spark plans the rank filter as a group limit on both sides of the shuffle, so a map task
    sends one row per key, also for a key that holds much of the data.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
    )


def merge_rows(
    current: DataFrame, updates: DataFrame, keys: Sequence[str] = LANDING_KEY
) -> DataFrame:
    """``updates`` plus the rows of ``current`` whose key they do not carry."""
    kept = current.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(*updates.columns).unionByName(updates)


def snapshot_diff(
    old: DataFrame, new: DataFrame, key: str = "intersection_id", *compare: str
) -> DataFrame:
    """One row per key of either snapshot: added, removed, changed or unchanged.

    Both snapshots hold one row per key, so the outer join is one shuffle of each.
    """
    compare = compare or tuple(c for c in new.columns if c != key)
    same = F.lit(True)
    for name in compare:
        same = same & F.col(f"o.{name}").eqNullSafe(F.col(f"n.{name}"))
    joined = (
        old.select(key, *compare, F.lit(True).alias("_in"))
        .alias("o")
        .join(
            new.select(key, *compare, F.lit(True).alias("_in")).alias("n"),
            F.col(f"o.{key}") == F.col(f"n.{key}"),
            "full_outer",
        )
    )
    change = (
        F.when(F.col("o._in").isNull(), "added")
        .when(F.col("n._in").isNull(), "removed")
        .when(same, "unchanged")
        .otherwise("changed")
    )
    return joined.select(
        F.coalesce(f"n.{key}", f"o.{key}").alias(key),
        change.alias("change"),
        *[F.col(f"o.{name}").alias(f"old_{name}") for name in compare],
        *[F.col(f"n.{name}").alias(f"new_{name}") for name in compare],
    )
