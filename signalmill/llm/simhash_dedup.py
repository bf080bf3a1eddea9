"""Near-duplicates by SimHash: fingerprints searched through an inverted index of their bytes.

Two fingerprints of 8 bytes that differ in at most d bits share at least 8 - d bytes at their
positions. The index lists fingerprints under positional bytes; the shared bytes of each pair that
meets in a list are tallied, pairs that reach the minimum are verified bit by bit. Lists under one
byte hold a 256th of all fingerprints, so with more of them a list is the intersection of several:
sets of positions are chosen so that any 8 - d positions hold one of the sets, and no pair is lost.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import batches_of, spans, stored
from signalmill.llm.components import components

SEED = 42
BYTES = 8
DISTANCE = 4
# Shingles hashed at a time: bounds what a very long text takes.
CHUNK = 1 << 16
# Members that a list may have on average before its key gets another byte.
LIST_MEMBERS = 64
# Members of a list that are compared in one group; longer lists are compared part by part.
PART_MEMBERS = 4096
# Members of the many short lists that make a group together.
GROUP_MEMBERS = 1 << 16
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_OFFSET = (np.arange(BYTES) * 256).astype(np.int64)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(
    np.int64
)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)


def fingerprint(text: bytes, width: int = 4) -> int:
    """Bit b is set if over half of the shingles' hashes have it; no words give zero."""
    # Splitting bytes at blanks splits at 32 and 9 to 13, and at nothing else.
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    edge = spans(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    count = len(words) - width + 1
    seen = np.zeros(256 * BYTES, np.int64)
    for a in range(0, count, CHUNK):
        b = min(count, a + CHUNK)
        cuts = zip(edge[a:b].tolist(), (edge[a + width : b + width] - 1).tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[x:y], SEED) for x, y in cuts], "<u8")
        value = hashes.view(np.uint8).reshape(-1, BYTES) + _OFFSET
        seen += np.bincount(value.ravel(), minlength=len(seen))
    ones = seen.reshape(BYTES, 256) @ _BITS
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row."""

    def made(batches):
        for batch in batches_of(batches):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            found = np.array([fingerprint(t or b"", width) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(made, "doc_id long, fp long")


def position_sets(size: int) -> list[tuple[int, ...]]:
    """Sets of ``size`` of the 8 positions such that any 4 positions hold one of them."""
    thirds = [range(0, 3), range(3, 6), range(6, 8)]
    if size == 1:
        return [(p,) for p in range(BYTES - DISTANCE + 1)]
    if size == 2:  # of four positions two are in the same third
        return [c for t in thirds for c in itertools.combinations(t, 2)]
    if size == 3:  # a third whole, or two of a third and one of the next
        mixed = [
            (*two, one)
            for t, after in zip(thirds, [*thirds[1:], thirds[0]], strict=True)
            for two in itertools.combinations(t, 2)
            for one in after
        ]
        return [*(tuple(t) for t in thirds if len(t) == 3), *mixed]
    return list(itertools.combinations(range(BYTES), 4))


def key_mask(positions: tuple[int, ...]) -> int:
    """A signed 64-bit mask of the bytes at these positions."""
    mask = sum(0xFF << 8 * p for p in positions)
    return mask - (mask >> 63 << 64)


def shared_bytes(difference: np.ndarray) -> np.ndarray:
    """How many bytes of each 64-bit difference are zero."""
    filled = ((difference & _LOW7) + _LOW7) | difference | _LOW7
    return np.bitwise_count(~filled)


def list_links(lists: np.ndarray, fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all linked members of each list; ``lists`` names the list of each.

    Every pair of a list is tallied and verified, by its distance in the list. Pairs that links
    found ahead connect are left out, so there are fewer links than members.
    """
    order = np.argsort(lists, kind="stable")
    lists, fps = lists[order], fps[order]
    fps = fps.view(np.uint64)
    root = np.arange(len(fps))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    first = np.arange(len(fps))
    for step in itertools.count(1):
        first = first[first + step < len(fps)]
        first = first[lists[first] == lists[first + step]]
        if not len(first):
            return links
        difference = fps[first] ^ fps[first + step]
        tallied = shared_bytes(difference) >= BYTES - DISTANCE
        near = first[tallied & (np.bitwise_count(difference) <= DISTANCE)]
        near = near[root[near] != root[near + step]]
        for x in near.tolist():
            a, b = find(x), find(x + step)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(fps[x]), int(fps[x + step])))


def positional_lists(fps: DataFrame, size: int) -> DataFrame:
    """The index: (list, value, fp) for each set of positions; value is the bytes there."""
    keys = [
        F.struct(
            F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(key_mask(c))).alias("value")
        )
        for i, c in enumerate(position_sets(size))
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key")).select("key.*", "fp")


def near_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) of different fingerprints that connect all which are near; ``fps`` has fp.

    A list of more than PART_MEMBERS is dealt to parts, and each two parts make a group of their
    own; the short lists go many to a group. A group gives fewer links than it has members.
    """
    count = fps.count()
    size = next((s for s in (1, 2, 3) if count <= LIST_MEMBERS * 256**s), 4)
    index = stored(positional_lists(fps, size), "simhash-lists")
    lengths = index.groupBy("list", "value").agg(F.count(F.lit(1)).alias("members"))
    groups = max(1, count * len(position_sets(size)) // GROUP_MEMBERS)
    parts = F.ceil(F.col("members") / PART_MEMBERS).cast("int")
    of_list = F.xxhash64("list", "value")
    dealt = (
        index.join(lengths.where("members > 1"), ["list", "value"])
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    )
    short = dealt.where("parts = 1").select(
        F.pmod(of_list, F.lit(groups)).alias("group"), of_list.alias("in_list"), "fp"
    )
    met = F.explode(F.expr("filter(sequence(0, parts - 1), p -> p <> part)"))
    long = dealt.where("parts > 1").withColumn("other", met)
    pair = F.xxhash64("list", "value", F.least("part", "other"), F.greatest("part", "other"))
    long = long.select(pair.alias("group"), pair.alias("in_list"), "fp")

    def linked(group: pd.DataFrame) -> pd.DataFrame:
        lists = group["in_list"].to_numpy(np.int64)
        found = np.array(list_links(lists, group["fp"].to_numpy(np.int64)), np.uint64)
        found = found.reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return short.unionByName(long).groupBy("group").applyInPandas(linked, "a long, b long")


def simhash_dedup(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Words are runs without blanks, A-Z as a-z; shingles have ``width`` words, repeats count, and a
    text of fewer words is one. Fingerprints link at DISTANCE or fewer differing bits;
    ``component_id`` is the smallest doc_id reachable. Null, empty and blank texts have
    fingerprint zero and link like others. Equal fingerprints are one in the search, so copies and
    repeated rows cost nothing there; each row is answered. Rows without doc_id link as others
    do; a component of such rows alone has no id. Other columns take no part.
    """
    facts = stored(fingerprints(docs, width), "simhash-facts")
    fps = stored(facts.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    found = components(near_links(fps.select("fp")))
    rooted = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "fp")), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return facts.join(placed, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
