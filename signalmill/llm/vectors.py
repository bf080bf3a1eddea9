"""What the vector searches share: usable rows, Arrow to numpy, merging of partial results."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Partial results that one group merges, about.
MERGED_TOGETHER = 50_000


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )


def of_main_length(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has the most frequent length (of equals the least), at least one."""
    rows = rows.where(F.size(vector) > 0)
    lengths = rows.groupBy(F.size(vector).alias("length")).count()
    main = lengths.orderBy(F.desc("count"), "length").first()
    return rows.where(F.size(vector) == (main["length"] if main else -1))


def best_first(query: np.ndarray, score: np.ndarray, id_: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best, greatest score first, ties to the smaller id; no repeats."""
    order = np.lexsort((id_, -score, query))
    query, id_ = query[order], id_[order]
    again = np.zeros(len(order), bool)
    again[1:] = (query[1:] == query[:-1]) & (id_[1:] == id_[:-1])
    order, query = order[~again], query[~again]
    first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else []
    rank = np.arange(len(query)) - np.repeat(first, np.diff([*first, len(query)]))
    return order[rank < k]


def no_parts() -> pd.DataFrame:
    """No partial results (q, ids, scores)."""
    empty = pd.DataFrame({"q": [], "ids": [], "scores": []}, dtype=object)
    return empty.astype({"q": "int64"})


def merged(parts: DataFrame, k: int, score_type: str) -> DataFrame:
    """The k best over partial results (q, ids, scores): q, id, score, rank from 1.

    Each partial result holds k at most, so a query's lists grow with the parts of the table; the
    queries are spread over groups by number of lists.
    """
    groups = max(1, -(-parts.count() // MERGED_TOGETHER))

    def best(group: pd.DataFrame) -> pd.DataFrame:
        sizes = group["ids"].map(len).to_numpy()
        query = np.repeat(group["q"].to_numpy(), sizes)
        ids = np.concatenate([np.zeros(0, np.int64), *group["ids"]])
        scores = np.concatenate([np.zeros(0, np.dtype(score_type)), *group["scores"]])
        at = best_first(query, scores, ids, k)
        query = query[at]
        first = np.searchsorted(query, query)
        rank = (np.arange(len(at)) - first + 1).astype(np.int32)
        return pd.DataFrame({"q": query, "id": ids[at], "score": scores[at], "rank": rank})

    kind = {"int64": "long", "float64": "double"}[score_type]
    return (
        parts.withColumn("group", F.pmod(F.xxhash64("q"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(best, f"q long, id long, score {kind}, rank int")
    )
