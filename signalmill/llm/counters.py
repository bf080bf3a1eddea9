"""Large arrays of counters, summed over all tasks without a task that gets them all."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pieces of an array, and tasks whose pieces are summed first.
PARTS = 64
FEW = 64


def counter_columns(total: np.ndarray) -> list[pa.Array]:
    """part, task and counts of a task's counters, whose number PARTS divides."""
    blobs = [zlib.compress(x.tobytes(), 1) for x in total.reshape(PARTS, -1)]
    task = TaskContext.get().partitionId()
    return [
        pa.array(range(PARTS), pa.int32()),
        pa.array([task] * PARTS, pa.int32()),
        pa.array(blobs, pa.binary()),
    ]


def summed(counters: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' counters (part, task, counts), as one array of a fixed size."""

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size // PARTS, np.int64)
        for blob in group["counts"]:
            total += np.frombuffer(zlib.decompress(blob), np.int64)
        return pd.DataFrame({"part": group["part"][:1], "counts": [zlib.compress(total, 1)]})

    schema = "part int, counts binary"
    some = counters.groupBy("part", F.pmod("task", F.lit(FEW)).alias("few"))
    rows = some.applyInPandas(added, schema).groupBy("part").applyInPandas(added, schema).collect()
    total = np.zeros((PARTS, size // PARTS), np.int64)
    for row in rows:
        total[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return total.ravel()
