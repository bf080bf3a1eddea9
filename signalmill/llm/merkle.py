"""A Merkle manifest of a table as a postorder append log, with proofs read from it by position.

Leaves of a tree lie in order; of every level each two consecutive nodes, or a last one alone,
become the hash of their hex digests. Aligned builders, each over 2 ** BLOCK_LEVELS consecutive
nodes, append their nodes in the order in which they are completed: a node follows its children at
once. So the place of a node follows from sizes of subtrees alone, and a proof is read by places,
without an index. The roots of the builders are the leaves of the next builders, and the roots of
the trees, one for each language, those of the last tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmill.llm.common import stored

# A builder's segment has at most 2 ** (BLOCK_LEVELS + 1) - 1 nodes of 32 bytes.
BLOCK_LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# monotonically_increasing_id counts a partition's rows in the lower bits.
ROW_BITS = 33
NONE, LEFT, RIGHT = b"\0", b"\1", b"\2"
SEGMENT = "tree string, block long, first long, leaves long, nodes binary, root binary"


def field(value: Column) -> Column:
    """A value with its length in bytes ahead of it, so that fields cannot run into each other."""
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")
    )


def leaf_hash(*values: Column) -> Column:
    """sha256 of the fields, as binary."""
    return F.unhex(F.sha2(F.concat(*(field(v) for v in values)).cast("binary"), 256))


def tree_name(key: Column) -> Column:
    """A name per key that sorts as the key, null first."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def parent(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def levels_above(leaves: int) -> int:
    """Levels over the leaves of a tree: 0 for a lone leaf."""
    return max(0, int(leaves) - 1).bit_length()


def place(level, index, leaves: int):
    """Where in its postorder the node of a level and index lies, in a tree of so many leaves.

    It is completed by its last leaf e. Ahead of that leaf lie e leaves and their e - bits(e)
    completed parents, and between leaf and node one node for each level.
    """
    last = np.minimum((np.asarray(index) + 1) << level, leaves) - 1
    return 2 * last - np.bitwise_count(last) + level


def segment(digests: list[str], levels: int) -> list[str]:
    """All nodes over these digests up to ``levels``, in postorder."""
    waiting: list[list[str]] = [[] for _ in range(levels + 1)]
    log = []
    for i, digest in enumerate(digests):
        level, last = 0, i + 1 == len(digests)
        while True:
            log.append(digest)
            if level == levels:
                break
            waiting[level].append(digest)
            if len(waiting[level]) < 2 and not last:
                break
            digest = parent(*waiting[level])
            waiting[level] = []
            level += 1
    return log


def sibling_places(leaves: int, levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level: the place of the sibling on each leaf's way up, -1 for none; and if it is left."""
    index = np.arange(leaves)
    out = []
    for level in range(levels):
        other = (index >> level) ^ 1
        exists = other <= (leaves - 1) >> level
        at = np.where(exists, place(level, other, leaves), -1)
        out.append((at, other < index >> level))
    return out


def paths(nodes: bytes, leaves: int, levels: int) -> Iterator[bytes]:
    """Of each leaf of a segment the siblings on its way up: a side, and 32 bytes if there is one."""
    siblings = [(at.tolist(), left.tolist()) for at, left in sibling_places(leaves, levels)]
    for i in range(leaves):
        way = []
        for at, left in siblings:
            p = at[i]
            way.append(
                NONE if p < 0 else (LEFT if left[i] else RIGHT) + nodes[32 * p : 32 * p + 32]
            )
        yield b"".join(way)


def steps(path: bytes) -> list[tuple[bytes, str]]:
    """The path taken apart: side and digest, level by level."""
    out, at = [], 0
    while at < len(path):
        side = path[at : at + 1]
        at += 1
        out.append((side, "" if side == NONE else path[at : at + 32].hex()))
        at += 0 if side == NONE else 32
    return out


def folded(leaf: str, way: list[tuple[bytes, str]]) -> str:
    """The root that a leaf and the siblings on its way up give."""
    for side, digest in way:
        leaf = parent(digest, leaf) if side == LEFT else parent(leaf, digest)
    return leaf


def ordered(leaves: DataFrame, *order: str) -> DataFrame:
    """The leaves (tree, ...) with their place (rank) within their tree, and its number of leaves.

    A sort by ranges splits also a tree that has most rows. A tree's rows of each range are counted
    and the counts added up, so that nothing is ranked in one task.
    """
    spark = leaves.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["tree", *order]
    rows = leaves.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()), "merkle-ordered")
    rows = rows.withColumn("range", F.shiftright("at", ROW_BITS))
    runs = rows.groupBy("tree", "range").agg(
        F.count(F.lit(1)).alias("rows"), F.min("at").alias("first")
    )
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns(
        {
            "ahead": F.coalesce(F.sum("rows").over(before), F.lit(0)),
            "leaves": F.sum("rows").over(of_tree),
        }
    )
    # A run's first row and what is ahead of it make a rank of each row.
    ranked = rows.join(
        runs.select("tree", "range", "leaves", (F.col("first") - F.col("ahead")).alias("shift")),
        ["tree", "range"],
    )
    return ranked.withColumn("rank", F.col("at") - F.col("shift")).drop("at", "range", "shift")


def with_block(rows: DataFrame) -> DataFrame:
    return rows.withColumn("block", F.shiftright("rank", BLOCK_LEVELS))


def append_log(leaves: DataFrame) -> list[DataFrame]:
    """The log of all trees of ``leaves`` (tree, rank, leaves, digest): its segments, by round.

    A segment holds the nodes of one builder in postorder, 32 bytes each; ``first`` is the place
    of its first node in the order of its round, ``leaves`` counts the tree's leaves in that
    round. Round r starts from the roots of the segments of round r - 1; a round holds the trees
    that are not finished. ``root`` is the last node of a segment.
    """

    def built(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank")
        leaves = int(block["leaves"].iloc[0])
        levels = min(BLOCK_LEVELS, levels_above(leaves))
        log = segment([d.hex() for d in block["digest"]], levels)
        start = int(block["rank"].iloc[0])
        return pd.DataFrame(
            {
                "tree": [block["tree"].iloc[0]],
                "block": [int(block["block"].iloc[0])],
                "first": [int(place(0, start, leaves))],
                "leaves": [leaves],
                "nodes": [bytes.fromhex("".join(log))],
                "root": [bytes.fromhex(log[-1])],
            }
        )

    rounds = []
    nodes = leaves.select("tree", "rank", "leaves", "digest")
    while True:
        log = stored(
            with_block(nodes).groupBy("tree", "block").applyInPandas(built, SEGMENT), "merkle-log"
        )
        rounds.append(log)
        up = log.where(F.col("leaves") > 1 << BLOCK_LEVELS)
        if up.isEmpty():
            return rounds
        nodes = up.select(
            "tree",
            F.col("block").alias("rank"),
            F.ceil(F.col("leaves") / (1 << BLOCK_LEVELS)).alias("leaves"),
            F.col("root").alias("digest"),
        )


def roots(rounds: list[DataFrame]) -> DataFrame:
    """The root of each tree: tree, subroot."""
    last = [log.where(F.col("leaves") <= 1 << BLOCK_LEVELS) for log in rounds]
    out = last[0]
    for log in last[1:]:
        out = out.unionByName(log)
    return out.select("tree", F.col("root").alias("subroot"))


def _ways_up(rounds: list[DataFrame], top: DataFrame | None) -> DataFrame:
    """Of each segment of the first round the siblings above its root: tree, block, up, leaves.

    ``top`` (tree, up) are those above the trees' own roots. Each later round's segments name the
    siblings of their leaves, which are the segments of the round ahead.
    """

    def extended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                first = int(row.block) << BLOCK_LEVELS
                leaves = min(int(row.leaves) - first, 1 << BLOCK_LEVELS)
                levels = min(BLOCK_LEVELS, levels_above(row.leaves))
                ways = [way + row.up for way in paths(row.nodes, leaves, levels)]
                yield pd.DataFrame(
                    {"tree": row.tree, "block": range(first, first + leaves), "up": ways}
                )

    ups = None
    for log in reversed(rounds):
        finished = log.where(F.col("leaves") <= 1 << BLOCK_LEVELS).select("tree", "block")
        if top is None:
            done = finished.withColumn("up", F.lit(b""))
        else:
            done = finished.join(top, "tree")
        ups = done if ups is None else done.unionByName(ups)
        if log is not rounds[0]:
            ups = log.select("tree", "block", "leaves", "nodes").join(ups, ["tree", "block"])
            ups = stored(
                ups.mapInPandas(extended, "tree string, block long, up binary"), "merkle-up"
            )
    return ups


def merkle_manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaf, roots and proof of each row of ``docs``, and what a tampered row makes of the root.

    Gives doc_id, lang, leaf, subroot, root, proof, proof_sha256, folded_root, verified. A tree
    per ``lang`` (null is one too), its leaves by doc_id; rows of one doc_id, and those without
    any, which come first, by their hash, so that reruns agree. ``proof`` holds the siblings up to
    the root: per level 0 for none, or 1 (left) or 2 (right) and the digest. ``tampered`` says of
    which rows the leaf is folded with n_chars + 1; where it or n_chars is null the row's own leaf
    is. Null values are told apart from empty ones; empty and long texts are like others; repeated
    rows are leaves each; an empty table gives no rows. Other columns take no part.
    """
    own = [F.col(c) for c in FIELDS]
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    forged = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    leaves = docs.select(
        tree_name(F.col("lang")).alias("tree"),
        "doc_id",
        leaf_hash(*own).alias("digest"),
        F.when(changed & F.col("n_chars").isNotNull(), leaf_hash(*forged)).alias("forged"),
        # Splits a range of equal rows; they are stored with it, so that it stays.
        F.monotonically_increasing_id().alias("copy"),
    )
    ranked = stored(
        ordered(stored(leaves, "merkle-leaves"), "doc_id", "digest", "copy").drop("copy"),
        "merkle-ranked",
    )
    rounds = append_log(ranked)
    subroots = stored(roots(rounds), "merkle-subroots")
    trees = stored(
        ordered(
            subroots.select(
                F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("subroot").alias("digest")
            ),
            "of",
        ),
        "merkle-trees",
    )
    top = append_log(trees)
    above = proofs(trees, top, None, ["of"]).select(F.col("of").alias("tree"), F.col("proof").alias("up"))
    root = roots(top).select(F.col("subroot").alias("root"))
    # One row, or none for an empty table.
    first = root.first()
    root_digest = F.lit(bytes(first[0]) if first else None).cast("binary")
    found = proofs(ranked, rounds, above, ["doc_id", "digest", "forged"]).join(subroots, "tree")
    return found.select(
        "doc_id",
        F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("lang"),
        F.lower(F.hex("digest")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        F.lower(F.hex(root_digest)).alias("root"),
        "proof",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.lower(F.hex(root_digest))).alias("verified"),
    )


def proofs(
    ranked: DataFrame, rounds: list[DataFrame], above: DataFrame | None, keep: list[str]
) -> DataFrame:
    """The siblings of each leaf, their hash, and the root that the leaf, or its forgery, gives.

    A task has one segment of the log and its leaves; it reads siblings by their places.
    """
    kinds = {f.name: f.dataType.simpleString() for f in ranked.schema.fields}
    kept = ["tree", *keep]
    forged = "forged" if "forged" in keep else None
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept)
    ups = _ways_up(rounds, above)
    segments = rounds[0].select("tree", "block", "leaves", "nodes").join(ups, ["tree", "block"])

    def proven(rows: pd.DataFrame, log: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        entry = log.iloc[0]
        levels = min(BLOCK_LEVELS, levels_above(entry["leaves"]))
        upper = steps(entry["up"])
        ways, hashes, folds = [], [], []
        leaves = rows["digest"]
        if forged is not None:
            leaves = rows[forged].where(rows[forged].notna(), leaves)
        for leaf, way in zip(leaves, paths(entry["nodes"], len(rows), levels), strict=True):
            ways.append(way + entry["up"])
            way = steps(way) + upper
            hashes.append(parent(*(digest for _, digest in way)))
            folds.append(folded(leaf.hex(), way))
        return rows[kept].assign(proof=ways, proof_sha256=hashes, folded_root=folds)

    return (
        with_block(ranked)
        .groupBy("tree", "block")
        .cogroup(segments.groupBy("tree", "block"))
        .applyInPandas(
            proven, f"{schema}, proof binary, proof_sha256 string, folded_root string"
        )
    )
