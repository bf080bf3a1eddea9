"""Exact top-k inner products by the threshold algorithm.

The rows are dealt in blocks. Within a block there is a sorted list for each dimension. A query
walks all lists from its favourable end at once, scores each row it meets in full, and stops when
the bound, the score of a row made of the values reached, cannot beat its k-th result. Some queries
walk together: they score all rows that any of them meets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import spans, stored
from signalmill.llm.vectors import best_first, finite, merged, no_parts

BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048
# Queries of a block that walk its lists together; bounds the scores held at a time.
QUERIES_TOGETHER = 256
# Rows of each list that a query reads at first; the step doubles.
FIRST_STEP = 16
LONG = 2**63 - 1


class SortedLists:
    """Rows (n x d, whole numbers) with a list of rows for each dimension, in order of value."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable").T  # dimension x place
        self.value = np.take_along_axis(rows, self.order.T, axis=0).T

    def top(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best, and of all that tie with the last."""
        _, found, scores = self.tops(query[None, :], k)
        return found, scores

    def tops(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each query (m x d) its k best and all that tie with the last: query, row, score.

        The queries walk the lists together. A row that one of them meets is scored for all that
        still walk, by one product of matrices; each leaves when its own bound is below its k-th.
        """
        n = len(self.rows)
        walking = np.arange(len(queries))
        seen = np.zeros(n, bool)
        bar = np.full(len(queries), -np.inf, queries.dtype)
        best = np.zeros((len(queries), 0), queries.dtype)
        found = [(walking[:0], walking[:0], bar[:0])]
        read, step = 0, FIRST_STEP
        while read < n and len(walking):
            q = queries[walking]
            stop = min(n, read + step)
            up, down = (q < 0).any(axis=0), (q > 0).any(axis=0)
            met = np.zeros(n, bool)
            met[self.order[up, read:stop]] = True
            met[self.order[down, n - stop : n - read]] = True
            if not (up | down).any():
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            read, step = stop, 2 * step
            scores = q @ self.rows[new].T
            best = np.concatenate([best, scores], axis=1)
            if best.shape[1] >= k:
                best = np.partition(best, -k, axis=1)[:, -k:]
                bar[walking] = best[:, 0]
            at, row = np.nonzero(scores >= bar[walking, None])
            found.append((walking[at], new[row], scores[at, row]))
            if seen.all():
                break
            next_up, next_down = self.value[:, min(read, n - 1)], self.value[:, max(n - 1 - read, 0)]
            bound = np.where(q > 0, q * next_down, q * next_up).sum(axis=1)
            on = bound >= bar[walking]
            walking, best = walking[on], best[on]
        query, row, score = map(np.concatenate, zip(*found, strict=True))
        keep = score >= bar[query]
        return query[keep], row[keep], score[keep]


def whole_numbers(vectors) -> np.ndarray:
    """Vectors of whole doubles, in the smallest type in which a score of any two is exact.

    That is floats, doubles or Python's own integers.
    """
    x = np.stack([np.frombuffer(v) for v in vectors])
    most = np.abs(x).max() ** 2 * x.shape[1] if x.size else 0
    if most >= 2.0**53:
        return np.array([[int(c) for c in row] for row in x], object)
    return x.astype(np.float32) if most < 2.0**24 else x


def as_longs(scores: np.ndarray) -> np.ndarray:
    """Whole scores as longs; one beyond a long as the nearest."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([max(-LONG - 1, min(LONG, int(s))) for s in scores], np.int64)


def threshold_top_k(
    vectors: DataFrame, queries, k: int = 20, id_: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k greatest integer inner products of each query: query_id, rank, vec_id, score.

    Every component x counts as floor(64 * x), x as double. ``queries`` is a condition on the
    rows; candidates are all rows but the query's own, by id. Ties go to the smaller id. Vectors
    that are null, empty, or that hold null or non-finite components take no part, nor do rows
    without id. Vectors of different lengths have no inner product: each length is searched among
    its own. A repeated id is answered and named once, with its best score. Zero vectors take
    part. A score beyond a long is given as the nearest long.

    The queries meet the rows block by block, both dealt by hashed id, so equal vectors do not
    meet in one task; blocks give k results each, which are merged. The queries are a stated
    share of the rows, so the work grows with the square of the table.
    """
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: 64 * x)
    rows = vectors.select(
        F.col(id_).cast("long").alias("id"),
        scaled.alias("v"),
        queries.alias("asked"),
    ).where(F.col("id").isNotNull() & finite(F.col("v")) & (F.size("v") > 0))

    def floored(batches):
        for batch in batches:
            whole = np.floor(batch.column("v").flatten().to_numpy())
            edges = spans(pc.list_value_length(batch.column("v")).to_numpy())
            v = [whole[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(v, pa.binary()), batch.column("asked")],
                ["id", "v", "asked"],
            )

    rows = stored(
        rows.distinct().mapInArrow(floored, "id long, v binary, asked boolean"), "top-k-rows"
    )
    total, asked = rows.agg(F.count("*"), F.count_if("asked")).first()
    n_rows, n_asked = max(1, -(-total // BLOCK_ROWS)), max(1, -(-asked // BLOCK_QUERIES))
    row_block = F.pmod(F.xxhash64("id"), F.lit(n_rows)).cast("int")
    query_block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_asked)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    grid = (
        rows.select("id", "v", F.lit(False).alias("is_query"), row_block.alias("r"))
        .withColumn("q", every(n_asked))
        .unionByName(
            rows.where("asked")
            .select("id", "v", F.lit(True).alias("is_query"), query_block.alias("q"))
            .withColumn("r", every(n_rows))
        )
    )

    def searched(group: pd.DataFrame) -> pd.DataFrame:
        is_query = group["is_query"].to_numpy(bool)
        asking, here = group[is_query], group[~is_query]
        if not len(asking) or not len(here):
            return no_parts()
        x = whole_numbers([*here["v"], *asking["v"]])
        lists, ids = SortedLists(x[: len(here)]), here["id"].to_numpy()
        names, out = asking["id"].to_numpy(), []
        # One more than k, as the query's own row is no result; repeats of it may be more.
        own = int(here["id"].isin(names).groupby(ids).sum().max())
        for a in range(0, len(names), QUERIES_TOGETHER):
            asked_now = names[a : a + QUERIES_TOGETHER]
            query, row, score = lists.tops(x[len(here) + a :][: len(asked_now)], k + own)
            other = ids[row] != asked_now[query]
            query, found, score = query[other], ids[row[other]], as_longs(score[other])
            at = best_first(query, score, found, k)
            edge = np.searchsorted(query[at], np.arange(1, len(asked_now)))
            out.append(
                pd.DataFrame(
                    {"q": asked_now, "ids": np.split(found[at], edge), "scores": np.split(score[at], edge)}
                )
            )
        return pd.concat(out)

    parts = stored(
        grid.groupBy(F.length("v").alias("length"), "r", "q").applyInPandas(searched, "q long, ids array<long>, scores array<long>"),
        "top-k-parts",
    )
    return merged(parts, k, "int64").select(
        F.col("q").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )
