"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree splits by a random direction a level, at the median of a bounded sample of the vectors.
A query goes down all trees with one shared priority queue: the next leaf is the one whose
splits it violates least, whichever tree it is in. The candidates in the visited leaves are then
ranked by exact inner products. To make large inner products near, a vector gets one more
component that lifts it to the greatest norm, and a query gets zero there.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalmill.llm.common import stored
from signalmill.llm.vectors import best_first, finite, merged, no_parts, of_main_length

TREES = 16
LEAF = 256
# Leaves that a query visits in all trees together: LEAVES in a forest of up to FOREST leaves, and
# in a larger one more, by the power GROWTH of its leaves.
LEAVES = 208
FOREST = 4096
GROWTH = 0.75
# Rows of queries that meet one group of leaves, about; where there are more, the leaves are copied.
QUERIES_TOGETHER = 1 << 15
# Vectors on which the splits are fitted, about; every vector is indexed.
SAMPLE = 1 << 16
# Least sample vectors for a split of a node's own; below, all nodes of a level split alike.
OWN_SPLIT = 8
# Levels of a tree that one task searches together.
TOGETHER = 4


@dataclass
class Forest:
    directions: np.ndarray  # tree x level x component
    splits: list[list[np.ndarray]]  # by tree and level: of each node, or one for all
    depth: int

    def _split(self, tree: int, level: int, node):
        at = self.splits[tree][level]
        return at[node if len(at) > 1 else 0 * node]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.zeros((len(x), len(self.directions)), np.int64)
        for tree, directions in enumerate(self.directions):
            height = x @ directions.T
            for level in range(self.depth):
                node = out[:, tree]
                out[:, tree] = 2 * node + (height[:, level] >= self._split(tree, level, node))
        return out

    def visit(self, query: np.ndarray, n: int) -> list[tuple[int, int]]:
        """The n leaves (tree, leaf) whose splits the query violates least in sum of squares."""
        height = self.directions @ query
        queue = [(0.0, tree, 0, 0) for tree in range(len(height))]
        found: list[tuple[int, int]] = []
        while queue and len(found) < n:
            cost, tree, level, node = heapq.heappop(queue)
            while level < self.depth:
                off = float(height[tree, level] - self._split(tree, level, node))
                side = int(off >= 0)
                level += 1
                heapq.heappush(queue, (cost + off * off, tree, level, 2 * node + 1 - side))
                node = 2 * node + side
            found.append((tree, node))
        return found


def fit_forest(sample: np.ndarray, depth: int, trees: int = TREES, seed: int = 11) -> Forest:
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((trees, depth, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    splits = []
    for tree in range(trees):
        height = sample @ directions[tree].T
        node = np.zeros(len(sample), np.int64)
        of_tree = []
        for level in range(depth):
            middle = np.median(height[:, level])
            if len(sample) >> level >= OWN_SPLIT:
                own = pd.Series(height[:, level]).groupby(node).median()
                split = np.full(1 << level, middle)
                split[own.index] = own
            else:
                split = np.array([middle])
            of_tree.append(split)
            node = 2 * node + (height[:, level] >= split[node if len(split) > 1 else 0 * node])
        splits.append(of_tree)
    return Forest(directions, splits, depth)


def leaves_visited(in_forest: int) -> int:
    """How many leaves a query visits in a forest of so many."""
    return math.ceil(LEAVES * max(1.0, in_forest / FOREST) ** GROWTH)


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a list column of vectors of one length."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def forest_search(
    vectors: DataFrame,
    queries,
    k: int = 20,
    id_: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    leaf: int = LEAF,
    leaves: int | None = None,
) -> DataFrame:
    """About the k greatest inner products of each query: query_id, rank, vec_id, score.

    ``queries`` is a condition on the rows; candidates are all rows but the query's own. Ties go
    to the smaller id. Vectors that are null, empty, zero, of another than the most frequent
    length, or that hold null or non-finite components take no part, nor do rows without id; a
    repeated id is one candidate for each vector it has, and is answered once.

    Equal vectors are one in the index and keep their k + 1 smallest ids, more than which no query
    can name, so a frequent vector is no hot leaf. Splits come from a bounded sample, their number
    from the number of vectors; the forest that is broadcast is bounded by the sample. A query visits
    ``leaves`` leaves, or by default a number that grows with the forest. Each vector is shuffled
    once a tree and block of queries, and each query once a visited leaf.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")
    ).where(F.col("id").isNotNull())
    rows = rows.where(finite(F.col("v"))).where(F.exists("v", lambda x: x != 0))
    rows = of_main_length(rows, "v")
    by_id = Window.partitionBy("v").orderBy("id")
    classes = stored(
        rows.distinct()
        .withColumn("place", F.row_number().over(by_id))
        .where(F.col("place") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("c", F.xxhash64("v"))
        .withColumn("norm", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)),
        "vector-classes",
    )
    total, most = classes.agg(F.count("*"), F.max("norm")).first()
    asked = vectors.where(queries).select(
        F.col(id_).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("q_v")
    )
    out = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], out)
    # By hash, about SAMPLE of the vectors, or all where there are fewer.
    drawn = F.pmod(F.col("c"), F.lit(1 << 30)) < min(1.0, SAMPLE / total) * (1 << 30)
    sample = classes.where(drawn).select("v", "norm").toArrow()
    lift = np.sqrt(np.maximum(0, most - sample["norm"].to_numpy()))
    depth = max(0, int(np.ceil(np.log2(total / leaf))))
    if len(sample):
        fitted = sample["v"].combine_chunks().flatten().to_numpy().reshape(len(sample), -1)
        forest = fit_forest(np.column_stack([fitted, lift]), depth, trees)
    else:
        forest = Forest(np.zeros((1, 0, 1)), [[]], 0)
    shared = spark.sparkContext.broadcast(forest)
    below = min(TOGETHER, forest.depth)
    member = (
        "tree int, part long, block int, leaf long, is_query boolean, c long, v binary, "
        "ids array<long>"
    )

    def rows_of(tree, leaf_, block, c, v, ids, is_query):
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(),
                 pa.binary(), pa.list_(pa.int64())]
        leaf_ = np.asarray(leaf_, np.int64)
        n = len(leaf_)
        columns = [tree, leaf_ >> below, [block] * n, leaf_, [is_query] * n, c, v, ids]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)],
            [m.split()[0] for m in member.split(", ")],
        )

    def indexed(batches):
        for batch in batches:
            x = _matrix(batch.column("v"))
            lifted = np.sqrt(np.maximum(0, most - np.asarray(batch.column("norm"))))
            at = shared.value.leaves(np.column_stack([x, lifted]))
            c, v = batch.column("c").to_pylist(), [row.tobytes() for row in x]
            ids = batch.column("ids").to_pylist()
            for tree in range(at.shape[1]):
                for block in range(blocks):
                    yield rows_of([tree] * len(c), at[:, tree], block, c, v, ids, False)

    def sought(batches):
        for batch in batches:
            x = _matrix(batch.column("v"))
            for c, row in zip(batch.column("c").to_pylist(), x, strict=True):
                at = shared.value.visit(np.append(row, 0.0), visited)
                n = len(at)
                tree, leaf_ = [t for t, _ in at], [f for _, f in at]
                yield rows_of(
                    tree, leaf_, c % blocks, [c] * n, [row.tobytes()] * n, [None] * n, True
                )

    asked_classes = (
        asked.where(F.col("query_id").isNotNull())
        .distinct()
        .join(classes.select("v", "c"), F.col("q_v") == F.col("v"))
        .select("query_id", "c")
    )
    asked_classes = stored(asked_classes, "vector-queries")
    wanted = classes.join(asked_classes.select("c").distinct(), "c", "left_semi")
    in_forest = len(forest.directions) << forest.depth
    visited = leaves_visited(in_forest) if leaves is None else leaves
    of_part = min(1.0, (visited << below) / in_forest) * asked_classes.count()
    blocks = max(1, math.ceil(of_part / QUERIES_TOGETHER))

    def ranked(group: pd.DataFrame) -> pd.DataFrame:
        is_query = group["is_query"].to_numpy(bool)
        queries_, members = group[is_query], group[~is_query]
        query, score, ids = [], [], []
        for leaf_, mine in members.groupby("leaf"):
            asking = queries_[queries_["leaf"] == leaf_]
            if not len(asking):
                continue
            x = np.stack([np.frombuffer(b) for b in mine["v"]])
            q = np.stack([np.frombuffer(b) for b in asking["v"]])
            # Sums in one order wherever a pair meets, so that its score is the same.
            product = np.einsum("qd,xd->qx", q, x)
            near = min(k + 1, product.shape[1])
            bar = np.partition(product, -near, axis=1)[:, -near]
            a, b = np.nonzero(product >= bar[:, None])
            names = mine["ids"].to_numpy()[b]
            times = np.fromiter(map(len, names), np.int64, len(names))
            query.append(np.repeat(asking["c"].to_numpy()[a], times))
            score.append(np.repeat(product[a, b], times))
            ids.append(np.concatenate(names))
        if not query:
            return no_parts()
        query, score, ids = map(np.concatenate, (query, score, ids))
        at = best_first(query, score, ids, k + 1)
        query, score, ids = query[at], score[at], ids[at]
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        return pd.DataFrame(
            {"q": query[first], "ids": np.split(ids, first[1:]), "scores": np.split(score, first[1:])}
        )

    parts = stored(
        classes.select("v", "norm", "c", "ids")
        .mapInArrow(indexed, member)
        .unionByName(wanted.select("v", "c").mapInArrow(sought, member))
        .groupBy("tree", "part", "block")
        .applyInPandas(ranked, "q long, ids array<long>, scores array<double>"),
        "vector-candidates",
    )
    best = merged(parts, k + 1, "float64")
    after = Window.partitionBy("query_id").orderBy("rank")
    return (
        asked_classes.join(best, F.col("c") == F.col("q"))
        .where("id <> query_id")
        .withColumn("rank", F.row_number().over(after))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
