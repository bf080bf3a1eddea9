"""From parsed documents to flat event rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from signalmill.schemas import FLAT_EVENT


def flatten_documents(parsed: DataFrame, *keep: str) -> DataFrame:
    """The five event fields and the event id of parsed rows; unreadable fields are null.

    Numbers in quotes are accepted here. Strictness is the business of validation, which a
    caller puts in front where it is wanted.
    """
    names = [*FLAT_EVENT.fieldNames(), "event_id"]
    return parsed.select(*[f"fields.{name}" for name in names], *keep)


def usable(flat: DataFrame) -> DataFrame:
    """Rows the window aggregate can count: all five fields were readable."""
    return flat.na.drop(subset=FLAT_EVENT.fieldNames())


def drop_repeats(events: DataFrame, *, id_col: str = "event_id") -> DataFrame:
    """Each event id once. A stream needs a watermark on ``events`` to bound its memory.

    Events without an id are no copies of each other and all stay: in a stream each gets a key
    of its own, in a batch they pass by. In a batch the earliest copy by ``seq`` stays where there
    is such a column. Ids hardly repeat, so nothing is gained by collapsing them before the
    shuffle: the rows are dealt by id first, and one sort finds the earliest.
    """
    if events.isStreaming:
        keyed = events.withColumn("_repeat_key", F.coalesce(F.col(id_col).cast("string"), F.uuid()))
        return keyed.dropDuplicatesWithinWatermark(["_repeat_key"]).drop("_repeat_key")
    named = events.filter(F.col(id_col).isNotNull())
    if "seq" not in events.columns:
        once = named.dropDuplicates([id_col])
    else:
        first = Window.partitionBy(id_col).orderBy("seq")
        once = named.withColumn("_place", F.row_number().over(first))
        once = once.filter("_place = 1").drop("_place")
    return once.unionByName(events.filter(F.col(id_col).isNull()))
