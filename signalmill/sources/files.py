"""Folders and small files of a table, by the file system that Spark reads the table from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _at(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all in it; nothing if there is none."""
    place, system = _at(spark, path)
    system.delete(place, True)


def partitions(spark: SparkSession, path: str, keys: Sequence[str]) -> list[tuple[str, ...]]:
    """Values of the partition folders of a table, from their names alone; no file is opened."""
    place, system = _at(spark, path)
    pattern = "/".join(f"{key}=*" for key in keys)
    jvm = spark._jvm
    found = system.globStatus(jvm.org.apache.hadoop.fs.Path(place, pattern)) or []
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    out = []
    for status in found:
        parts = status.getPath().toString().split("/")[-len(keys) :]
        out.append(tuple(unescape(p.split("=", 1)[1]) for p in parts))
    return out


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    place, system = _at(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_small(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of another in one step, so that readers see either."""
    place, system = _at(spark, path)
    beside, _ = _at(spark, f"{path}.new")
    system.mkdirs(place.getParent())
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    context.rename(system.makeQualified(beside), system.makeQualified(place), options)
