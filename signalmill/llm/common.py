"""What the operators share: reading tables, storing intermediate results, Arrow batches, offsets."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmill.session import shared_folder

# Rows of a batch handed to Python. Texts can be long, so the number is small.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read again.

    Later jobs start from the files: an executor that is lost costs its tasks and no more.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies; imported late, as only the token operators need it."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings of a column, one behind the other, and offsets (n + 1).

    A null counts as empty.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[first[0] : first[-1]], first - first[0]


def spans(lengths: np.ndarray) -> np.ndarray:
    """Offsets (n + 1) of parts with these lengths."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


@functools.cache
def _malloc_trim():
    """The C library's call that returns freed memory to the system, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system; a worker keeps it otherwise, from one task to the next."""
    pa.default_memory_pool().release_unused()
    if trim := _malloc_trim():
        trim(0)


def batches_of(
    batches: Iterator[pa.RecordBatch],
    max_bytes: int = 1 << 20,
    text: str = "text",
    tidy: bool = False,
):
    """The same rows in batches of about max_bytes of text; one long text makes a batch alone.

    If ``tidy``, what the task's batches took is given back after the last one.
    """
    for batch in batches:
        size = np.diff(string_bytes(batch.column(text))[1])
        cut = np.cumsum(size) // max_bytes
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
    if tidy:
        batch = size = cut = None
        give_back()


def id_hash(column: str = "doc_id"):
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def separated(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As string_bytes, with one zero byte behind every string."""
    data, offsets = string_bytes(column)
    return np.insert(data, offsets[1:], 0), offsets + np.arange(len(offsets))


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each part of the first axis; empty parts give zero."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    full = np.diff(offsets) > 0
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0)
    return out
