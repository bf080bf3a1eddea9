"""Map extract to inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalmill.functions.geo import in_bbox
from signalmill.schemas import INVENTORY

# The tag of a signal, tags that may hold a name, best first, and the generated name.
SIGNAL_TAG = ("highway", "traffic_signals")
NAME_TAGS = ("name", "name:pt", "ref", "crossing:ref")
GENERATED_NAME = "Semáforo"


def _tag(key: str) -> Column:
    value = F.try_element_at("tags", F.lit(key))
    return F.when(value != "", value)


def elements(extract: DataFrame) -> DataFrame:
    """The rows inside the ``elements`` array of map documents."""
    return extract.select(F.inline("elements"))


def signal_nodes(
    nodes: DataFrame, bbox: tuple[float, float, float, float] | None = None
) -> DataFrame:
    """The map nodes that are traffic signals, inside ``bbox`` (south, west, north, east)."""
    signals = nodes.filter((F.col("type") == "node") & (_tag(SIGNAL_TAG[0]) == SIGNAL_TAG[1]))
    return signals if bbox is None else signals.filter(in_bbox(F.col("lat"), F.col("lon"), bbox))


def inventory_from_elements(
    nodes: DataFrame, bbox: tuple[float, float, float, float] | None = None
) -> DataFrame:
    """Signal nodes of a map as inventory rows, all others are left out. Not sorted.

    The name is the first name tag that is not empty, else one made from the node id and, if
    known, the direction.
    """
    node = F.col("id").cast("string")
    direction = F.concat(F.lit(" ("), _tag("direction"), F.lit(")"))
    generated = F.concat(
        F.lit(f"{GENERATED_NAME} "), node, F.coalesce(direction, F.lit(""))
    )
    return (
        signal_nodes(nodes, bbox)
        .select(
            F.concat(F.lit("osm-"), node).alias("intersection_id"),
            F.coalesce(*[_tag(key) for key in NAME_TAGS], generated).alias("display_name"),
            F.round("lat", 6).alias("latitude"),
            F.round("lon", 6).alias("longitude"),
            F.col("id").alias("osm_node_id"),
            F.lit("osm").alias("source"),
        )
        .select(*INVENTORY.fieldNames())
    )
