"""Inventory files and map extracts."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from signalmill.schemas import INVENTORY, MAP_ELEMENT, require_shape
from signalmill.sources import files


def read_inventory(spark: SparkSession, path: str, *, required: bool = True) -> DataFrame:
    """Typed inventory rows from CSV with a header; columns are found by their names.

    A column that the file lacks is null, a number that cannot be read as well, which the
    inventory rules report. ``required`` decides what an inventory without rows means: an error for a job that needs
    one, an empty frame for a reader that can do without, also when the file is missing.
    """
    try:
        text = spark.read.option("header", True).csv(path)
    except AnalysisException as missing:
        if required or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], INVENTORY)
    rows = text.select(
        *(
            (F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})")
             if f.name in text.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in INVENTORY.fields
        )
    )
    if required and rows.isEmpty():
        raise ValueError(f"no intersections in {path}")
    return rows


def write_inventory(rows: DataFrame, path: str) -> bool:
    """Replace the inventory, sorted by id. An empty extract leaves the old one alone."""
    rows = require_shape(rows, INVENTORY)
    if rows.isEmpty():
        return False
    rows.orderBy("intersection_id").write.mode("overwrite").option("header", True).csv(path)
    return True


def _current_path(path: str) -> str:
    return f"{path.rstrip('/')}/_current.json"


def _version_folder(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version}"


def publish_inventory(rows: DataFrame, path: str) -> int | None:
    """Write the next version of the inventory below ``path``, make it the current one, return it.

    The versions before stay, and a reader that holds one is not disturbed. An empty inventory is
    not published. One publisher at a time; one that dies before the switch leaves the old current.
    """
    spark = rows.sparkSession
    version = (current_version(spark, path) or 0) + 1
    if not write_inventory(rows, _version_folder(path, version)):
        return None
    files.replace_small(spark, _current_path(path), json.dumps(version))
    return version


def current_version(spark: SparkSession, path: str) -> int | None:
    """The version that was published last, or None ahead of the first."""
    text = files.read_small(spark, _current_path(path))
    return None if text is None else json.loads(text)


def read_inventory_version(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    """One published version; no rows for None."""
    if version is None:
        return spark.createDataFrame([], INVENTORY)
    return read_inventory(spark, _version_folder(path, version))


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark)))


def _sums_before(rows: DataFrame, *names: str) -> DataFrame:
    """The sums of these columns over all earlier rows of the file, as ``<name>_before``.

    Sums run inside a block, which is bounded by ``spark.sql.files.maxPartitionBytes``; what lies
    ahead of a block comes from a row per block.
    """
    block = ["path", "block"]
    inside = Window.partitionBy(*block).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*block).agg(*[F.sum(n).alias(n) for n in names])
    ahead = totals.select(
        *block, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_ahead") for n in names]
    )
    sums = [
        (F.coalesce(F.sum(n).over(inside), F.lit(0)) + F.col(f"{n}_ahead")).alias(f"{n}_before")
        for n in names
    ]
    return rows.join(ahead, block).select(*[rows[c] for c in rows.columns], *sums)


def read_map_extract(spark: SparkSession, path: str) -> DataFrame:
    """Map documents, each an object with an ``elements`` array: a row for each element.

    A document may be laid out over lines in any way, and a file may hold several one after
    another. Files are cut at every closing brace, so one large file is read by many tasks, and
    the pieces of an element are put together again by running counts: of quotes, which tell text
    from structure, of open braces and brackets, and of elements that ended. Objects count as
    elements that lie in an array just below the root. One that its file ends in, or that cannot
    be read, is left out.
    """
    cut = spark.read.option("lineSep", "}").text(path)
    pieces = cut.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    pieces = _sums_before(pieces.withColumn("quotes", _count(bare, '"')), "quotes")
    starts_in_text = F.col("quotes_before") % 2 == 1
    closes = (F.col("quotes_before") + F.col("quotes")) % 2 == 0
    quoted = F.concat(
        F.when(starts_in_text, F.lit('"')).otherwise(""),
        bare,
        F.when(closes, F.lit("")).otherwise('"'),
    )
    structure = F.regexp_replace(quoted, '"[^"]*"', "")
    pieces = pieces.withColumns(
        {
            "closes": closes,
            "braces": _count(structure, "{") - closes.cast("int"),
            "brackets": _count(structure, "[") - _count(structure, "]"),
        }
    )
    pieces = _sums_before(pieces, "braces", "brackets")
    in_array = F.col("brackets_before") + F.col("brackets")
    ends = F.col("closes") & (F.col("braces_before") + F.col("braces") == 1) & (in_array == 1)
    pieces = _sums_before(pieces.withColumn("ended", ends.cast("int")), "ended")
    head = F.regexp_replace("value", r'(?s)^.*?"elements"\s*:\s*\[', "")
    text = F.when(F.col("brackets_before") == 0, head).otherwise(F.col("value"))
    whole = (
        pieces.filter(in_array >= 1)
        .groupBy("path", "ended_before")
        .agg(
            F.array_sort(F.collect_list(F.struct("block", "place", text.alias("text")))).alias("parts"),
            F.max("ended").alias("ended"),
        )
        .filter("ended = 1")
    )
    joined = F.concat(F.array_join("parts.text", "}"), F.lit("}"))
    element = F.from_json(F.regexp_replace(joined, "^[^{]*", ""), MAP_ELEMENT)
    return whole.select(element.alias("element")).filter(F.col("element").isNotNull()).select(
        F.array("element").alias("elements")
    )
