"""Packing documents into sequences: dominance reduction, then best fit.

Only the lengths decide, and there are no more lengths than a sequence has places. So the plan is
made from the number of pieces of each length, at any size of the corpus: first document sets that
provably dominate every alternative are fixed (after Martello and Toth), which shrinks the
instance, then the rest goes best fit decreasing. Spark counts the lengths, ranks the pieces of a
length, and gives each rank its place in the plan.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalmill.llm.byte_tokens import byte_tokens
from signalmill.llm.common import batches_of, stored

CAPACITY = 2048
END_ID = 0
# Pieces that one task ranks.
RANKED_TOGETHER = 200_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids and an end id, cut from the end into pieces of at most ``capacity``.

    A null or empty text is its end id alone. The first piece of a long document may be shorter.
    """
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches):
        model = byte_tokens(tokenizer_path)
        for batch in batches_of(batches, tidy=True):
            doc, number, start, length, crc = [], [], [], [], []
            ids_of = model.encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of, strict=True):
                ids += end
                n = len(ids) // 4
                edges = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    doc.append(doc_id)
                    number.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * b]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(number, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(cut, PIECE)


# A sequence's content: (length, times) from its start on.
Pattern = tuple[tuple[int, int], ...]


def dominating_set(left: np.ndarray, j: int) -> tuple[int, ...] | None:
    """The set with a piece of length j that dominates every other such set, if one is proven to.

    A set dominates if the others' pieces, beside j, can be put in its pieces' places. With a the
    longest piece that fits beside j, that is {j}, if there is none; {j, a}, if a fills the
    sequence, or no two pieces fit beside j, or no two that fit are longer than a together; and
    {j, a, b}, if no three pieces fit, b is the longest beside j and a, and no two that are both
    longer than b fit: then of any two the longer fits into a's place and the other into b's.
    """
    room = len(left) - 1 - j
    others = left[: room + 1].copy()
    if j <= room:
        others[j] -= 1
    sizes = np.flatnonzero(others)
    if not len(sizes):
        return (j,)
    a = int(sizes[-1])
    least = np.repeat(sizes[:3], np.minimum(others[sizes[:3]], 3))[:3]
    if a == room or len(least) < 2 or least[0] + least[1] > room:
        return (j, a)
    if len(least) == 3 and least.sum() <= room:
        return None
    # The longest piece up to each length; 0 for none.
    longest = np.maximum.accumulate(np.where(others > 0, np.arange(room + 1), 0))
    beside = longest[room - sizes]
    itself = (beside == sizes) & (others[sizes] < 2)
    beside = np.where(itself, longest[sizes - 1], beside)
    if np.where(beside > 0, sizes + beside, 0).max() <= a:
        return (j, a)
    b = int(beside[-1])
    longer = sizes[sizes > b][:2]
    longer = np.repeat(longer, np.minimum(others[longer], 2))[:2]
    if b and (len(longer) < 2 or longer.sum() > room):
        return (j, a, b)
    return None


def dominating_sets(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Fix the dominating sets, longest pieces first, out of ``counts``, until there are none.

    With fewer pieces left more sets may dominate, so all lengths are gone through again. A set is
    taken as often as its pieces last, as what dominates once does so with fewer pieces, too.
    """
    fixed: list[tuple[Pattern, int]] = []
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    changed = True
    while changed:
        changed = False
        for j in np.flatnonzero(left)[::-1].tolist():
            while left[j] and (chosen := dominating_set(left, j)):
                times = int(min(left[x] // chosen.count(x) for x in chosen))
                for x in chosen:
                    left[x] -= times
                fixed.append((tuple((x, 1) for x in chosen), times))
                changed = True
    for length in list(counts):
        counts[length] = int(left[length])
        if not left[length]:
            del counts[length]
    return fixed


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit decreasing; sequences of equal content are filled together."""
    groups: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, n: int) -> None:
        if n:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, pattern, n = capacity, (), left
            each = room // length
            full = min(n, left // each)
            put(room - each * length, (*pattern, (length, each)), full)
            left -= full * each
            if full < n and left:
                put(room - left * length, (*pattern, (length, left)), 1)
                put(room, pattern, n - full - 1 if pattern else 0)
                left = 0
            elif pattern:
                put(room, pattern, n - full)
    return [group for same in groups.values() for group in same]


def packing_plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Where the pieces of each length go: (length, from_rank, to_rank, each, sequence, offset).

    Piece number r of a length, r in [from_rank, to_rank), goes to sequence
    ``sequence + (r - from_rank) // each`` as its ``(r - from_rank) % each``-th from ``offset`` on.
    """
    rest = {k: n for k, n in counts.items() if n}
    content = dominating_sets(rest, capacity) + best_fit(rest, capacity)
    used = dict.fromkeys(counts, 0)
    plan, sequence = [], 0
    for pattern, n in content:
        offset = 0
        for length, each in pattern:
            a = used[length]
            used[length] = a + n * each
            plan.append((length, a, used[length], each, sequence, offset))
            offset += length * each
        sequence += n
    return plan


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents in sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts take one place, their end id. Repeated rows are packed each. Ties between
    pieces of a length go by doc_id, piece and checksum. Other columns of ``docs`` take no part.

    Texts are encoded once and the pieces stored. The driver sees only the counts of lengths, at
    most ``capacity`` of them, and the plan is bounded by ``capacity`` as well; it is broadcast. A
    common length is ranked in salted parts of about RANKED_TOGETHER pieces.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer_path, capacity), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    plan = spark.createDataFrame(
        packing_plan(counts, capacity),
        "of long, from_rank long, to_rank long, each long, first long, place long",
    )
    salts = spark.createDataFrame(
        [(k, -(-n // RANKED_TOGETHER)) for k, n in counts.items()], "of long, salts long"
    )
    salted = (
        cut.join(F.broadcast(salts), cut["length"] == salts["of"])
        .drop("of")
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), "salts"))
    )
    per_salt = salted.groupBy(F.col("length").alias("of"), F.col("salt").alias("in_salt")).count()
    before = Window.partitionBy("of").orderBy("in_salt")
    per_salt = per_salt.withColumn("before", F.sum("count").over(before) - F.col("count"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("rank", F.row_number().over(order) - 1)
        .join(per_salt, (F.col("length") == F.col("of")) & (F.col("salt") == F.col("in_salt")))
        .withColumn("rank", F.col("rank") + F.col("before"))
        .drop("of")
    )
    turn = F.col("rank") - F.col("from_rank")
    return ranked.join(
        F.broadcast(plan),
        (F.col("length") == F.col("of"))
        & (F.col("rank") >= F.col("from_rank"))
        & (F.col("rank") < F.col("to_rank")),
    ).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(turn / F.col("each"))).alias("sequence_id"),
        (F.col("place") + turn % F.col("each") * F.col("length")).alias("offset"),
    )
