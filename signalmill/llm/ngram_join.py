"""N-gram Jaccard join by T-occurrence search, with inverted lists divided as in DivideSkip.

A document is its set of word shingles. Those that link with it hold at least T of its shingles,
T being 0.8 times its size, so they hold one of its n - T + 1 rarest. Across the cluster only the
lists of these rare shingles are made. Documents that meet in a list form a block, named after the
list's least member; those whose parity bits rule out any link in their block leave it. In a
block the lists are searched with DivideSkip: short lists are merged and counted, long lists are
probed by binary search for the documents that can still reach T.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalmill.llm.common import batches_of, spans, stored
from signalmill.llm.components import components
from signalmill.llm.counters import PARTS, counter_columns, summed
from signalmill.llm.words import shingle_sets

# Counters by which frequent shingles are known; their number does not grow with the corpus.
SKETCH = 1 << 21
# Members of a part of a block whose parities one task compares.
NEAR_MEMBERS = 4096
# Shingles of a part of a block: bounds what one task searches.
BLOCK_SHINGLES = 1 << 19
PERCENT = 80
# The weight of the longest list's length in DivideSkip's choice of long lists.
MU = 0.1
BATCH_BYTES = 1 << 20


def least_overlap(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The overlap with any linked set that a set of n shingles needs: ceil(percent / 100 * n)."""
    return -(-percent * n // 100)


def class_key(shingles: np.ndarray) -> int:
    """64 bits that name a set; documents of equal sets form a class."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def parity(shingles: np.ndarray) -> np.ndarray:
    """A bit for each of a power of two of hash buckets, at least one a shingle: odd or even."""
    bits = 1 << max(6, int(max(1, len(shingles)) - 1).bit_length())
    bucket = (shingles >> np.uint64(24) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(bucket, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def may_link(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int):
    """Whether sets of sizes n and m can link, by their parities of equal length.

    Each bucket of unlike parity holds a shingle of one set alone, and linked sets have at most
    (100 - percent) / (100 + percent) * (n + m) of those. Never wrong about a set that links.
    """
    unlike = np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)
    close = (unlike * (100 + percent) <= (100 - percent) * (n + m))
    return close & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def folded(x: np.ndarray, length: int) -> np.ndarray:
    """Parities of fewer buckets."""
    while x.shape[-1] > length:
        half = x.shape[-1] // 2
        x = x[..., :half] ^ x[..., half:]
    return x


def shingle_statistics(docs: DataFrame, width: int) -> DataFrame:
    """A row (doc_id, n, k, parity) per document, and (part, task, counts) with task counters."""

    def counted(batches):
        total = np.zeros(SKETCH, np.int64)
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("k", pa.int64()),
                            ("parity", pa.binary()), ("part", pa.int32()), ("task", pa.int32()),
                            ("counts", pa.binary())])
        for batch in batches_of(batches, BATCH_BYTES, tidy=True):
            sets = shingle_sets(batch.column("text"), width)
            every = np.concatenate([np.zeros(0, np.uint64), *sets])
            total += np.bincount((every & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            none = pa.nulls(len(sets), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([class_key(s) for s in sets], pa.int64()),
                 pa.array([parity(s).tobytes() for s in sets], pa.binary()), none, none,
                 pa.nulls(len(sets), pa.binary())],
                schema=schema,
            )
        if total.any():
            none = pa.nulls(PARTS, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, pa.nulls(PARTS, pa.binary()), *counter_columns(total)],
                schema=schema,
            )

    return docs.select("doc_id", "text").mapInArrow(
        counted, "doc_id long, n long, k long, parity binary, part int, task int, counts binary"
    )


def rarity(counters: DataFrame) -> np.ndarray:
    """Of each counter the logarithm of its sum over all tasks, in steps: 0 for the rarest."""
    total = summed(counters, SKETCH)
    noise = max(1.0, total.mean())
    return np.clip(np.log2(np.maximum(total, 1) / noise) - 1, 0, 60).astype(np.uint8)


def rare_postings(docs: DataFrame, level: np.ndarray, width: int, percent: int) -> DataFrame:
    """The rarest n - T + 1 shingles of each set: shingle, k. Copies in a batch count once."""
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def rare(batches):
        for batch in batches_of(batches, BATCH_BYTES, tidy=True):
            sets = {class_key(s): s for s in shingle_sets(batch.column("text"), width) if len(s)}
            chosen = []
            for s in sets.values():
                rank = shared.value[(s & np.uint64(SKETCH - 1)).astype(np.int64)]
                order = s >> np.uint64(8) | rank.astype(np.uint64) << np.uint64(56)
                short = len(s) - least_overlap(len(s), percent) + 1
                chosen.append(s[np.argpartition(order, short - 1)[:short]])
            sizes = [len(c) for c in chosen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.uint64), *chosen]).view(np.int64)),
                 pa.array(np.repeat(np.array(list(sets), np.int64), sizes))],
                ["shingle", "k"],
            )

    return docs.select("text").mapInArrow(rare, "shingle long, k long")


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    """k and the set itself, as little-endian 64-bit hashes."""

    def made(batches):
        for batch in batches_of(batches, BATCH_BYTES, tidy=True):
            sets = {class_key(s): s for s in shingle_sets(batch.column("text"), width) if len(s)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sets), pa.int64()),
                 pa.array([s.tobytes() for s in sets.values()], pa.binary())],
                ["k", "shingles"],
            )

    return docs.select("text").mapInArrow(made, "k long, shingles binary")


class Forest:
    """Union-find over numbers; label is always the least member."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: int, others: np.ndarray) -> None:
        labels = np.unique(np.append(self.label[others], self.label[a]))
        self.label[np.isin(self.label, labels)] = labels[0]


def divide_skip(sets: list[np.ndarray], percent: int, query: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is connected among the sets, each with a queried one in it.

    Sets are taken by size; each is searched among the smaller ones of at least percent of its
    size, and among larger ones for a query. Links inside of what is already connected are left
    out, so there are fewer links than sets.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    queried = query[order]
    count = len(sets)
    flat = np.concatenate([sets[i] for i in order])
    doc = np.repeat(np.arange(count), sizes)
    _, shingle = np.unique(flat, return_inverse=True)
    key = np.sort(shingle.astype(np.int64) * count + doc)
    listed = key % count
    edge = spans(sizes)
    forest = Forest(count)
    links = []
    for x in range(1, count):
        n = int(sizes[x])
        least = int(least_overlap(n, percent))
        low = int(np.searchsorted(sizes, least))
        if low >= x or not (queried[x] or queried[low:x].any()):
            continue
        mine = shingle[edge[x] : edge[x + 1]].astype(np.int64) * count
        first, stop = np.searchsorted(key, mine + low), np.searchsorted(key, mine + x)
        size = stop - first
        by_size = np.argsort(size)
        # As many long lists as DivideSkip sets aside, so that the short ones stay selective.
        n_long = min(least - 1, int(least / (MU * np.log2(max(2, int(size.max()))) + 1)))
        short, long = by_size[: n - n_long], by_size[n - n_long :]
        total = size[short].sum()
        at = np.arange(total) - np.repeat(spans(size[short])[:-1], size[short])
        merged = listed[at + np.repeat(first[short], size[short])]
        found = np.bincount(merged - low, minlength=x - low)
        near = np.flatnonzero(found >= least - n_long)
        near = near[forest.label[near + low] != forest.label[x]]
        if not queried[x]:
            near = near[queried[near + low]]
        if not len(near):
            continue
        overlap = found[near]
        for i in long[size[long] > 0]:
            here = listed[first[i] : stop[i]]
            place = np.minimum(np.searchsorted(here, near + low), len(here) - 1)
            overlap = overlap + (here[place] == near + low)
        union = n + sizes[near + low] - overlap
        linked = near[100 * overlap >= percent * union] + low
        if len(linked):
            new = np.unique(forest.label[linked], return_index=True)[1]
            links += [(int(order[x]), int(order[y])) for y in linked[new]]
            forest.join(x, linked)
    return links


def _overlap_links(pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, shingles, others) that link."""

    def probed(batches):
        for batch in batches_of(batches, text="shingles", tidy=True):
            keep = []
            for x, y in zip(batch.column("shingles"), batch.column("others"), strict=True):
                a = np.frombuffer(x.as_py(), np.uint64)
                b = np.frombuffer(y.as_py(), np.uint64)
                both = (b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "shingles", "others").mapInArrow(probed, "a long, b long")


def _grid(members: DataFrame, weight: str, bound: int) -> DataFrame:
    """Members (hub, k, loose, ...) dealt to groups (bucket, i, j) in which to search blocks.

    Only pairs with a loose member matter. A block of more than ``bound`` weight is cut in parts:
    parts with loose members meet every part, so each pair of parts is one group. The other blocks
    go whole, many to a bucket.
    """
    of_hub = Window.partitionBy("hub")
    sized = (
        members.withColumn("parts", F.ceil(F.sum(weight).over(of_hub) / bound).cast("int"))
        .withColumn("any_loose", F.max("loose").over(of_hub))
        .where("any_loose")
        .withColumn("part", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
    )
    with_loose = F.when(F.col("loose"), F.col("part"))
    meets = F.when(F.col("loose"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
        F.collect_set(with_loose).over(of_hub)
    )
    small = F.when(F.col("parts") <= 1, F.array(F.lit(0))).otherwise(meets)
    total = members.agg(F.sum(weight)).first()[0] or 0
    buckets = max(1, int(2 * total // bound))
    return (
        sized.withColumn("meets", small)
        .withColumn("other", F.explode("meets"))
        .withColumn("i", F.least("part", "other"))
        .withColumn("j", F.greatest("part", "other"))
        .withColumn(
            "bucket",
            F.when(F.col("parts") <= 1, F.pmod(F.xxhash64("hub"), F.lit(buckets))).otherwise(
                F.col("hub")
            ),
        )
    )


def near_members(blocks: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The members (hub, k, n) of blocks (hub, k) that can link with another of their block.

    First each is held against its hub by their parities, which keeps groups of near copies
    without further ado; the others are held against all members.
    """
    facts = rows.groupBy("k").agg(F.first("n").alias("n"), F.first("parity").alias("parity"))
    facts = stored(facts.join(blocks.select("k").distinct(), "k", "left_semi"), "ngram-facts")
    of_hub = facts.select(
        F.col("k").alias("hub"), F.col("n").alias("hub_n"), F.col("parity").alias("hub_parity")
    )
    members = (
        blocks.withColumn("size", F.count("*").over(Window.partitionBy("hub")))
        .join(facts, "k")
        .join(of_hub, "hub")
    )

    def against_hub(batches):
        for batch in batches_of(batches, text="parity", tidy=True):
            near = []
            for n, m, x, y in zip(
                batch.column("n").to_pylist(), batch.column("hub_n").to_pylist(),
                batch.column("parity").to_pylist(), batch.column("hub_parity").to_pylist(),
                strict=True,
            ):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                short = min(len(a), len(b))
                fits = 100 * min(n, m) >= percent * max(n, m)
                near.append(
                    fits and bool(may_link(folded(a, short), folded(b, short), n, m, percent))
                )
            names = ["hub", "k", "n", "size", "parity"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in names), pa.array(near, pa.bool_())], [*names, "near"]
            )

    star = stored(
        members.select("hub", "k", "n", "size", "parity", "hub_n", "hub_parity").mapInArrow(
            against_hub, "hub long, k long, n long, size long, parity binary, near boolean"
        ),
        "ngram-star",
    )
    tied = star.where("near AND k <> hub").select("hub", "k", "n")
    hubs = star.where("k = hub").join(tied.select("hub").distinct(), "hub", "left_semi")
    rest = star.where("size > 2 AND k <> hub").withColumn("loose", ~F.col("near"))

    def searched(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in group.groupby("hub", sort=False):
            if len(block) > 1:
                out.append(block[near_others(block, percent)][["hub", "k", "n"]])
        return pd.concat([group.iloc[:0][["hub", "k", "n"]], *out])

    found = (
        _grid(rest.withColumn("one", F.lit(1)), "one", NEAR_MEMBERS)
        .select("bucket", "i", "j", "hub", "k", "n", "parity")
        .groupBy("bucket", "i", "j")
        .applyInPandas(searched, "hub long, k long, n long")
    )
    return (
        tied.unionByName(hubs.select("hub", "k", "n")).unionByName(found).distinct()
    )


def near_others(block: pd.DataFrame, percent: int) -> np.ndarray:
    """Of each member whether another one's parity allows a link."""
    n = block["n"].to_numpy()
    bits = [np.frombuffer(b, np.uint64) for b in block["parity"]]
    length = np.array([len(b) for b in bits])
    near = np.zeros(len(bits), bool)
    for size in np.unique(length):
        # Sets that can link differ in size by less than two, so their parities by one folding.
        here = np.flatnonzero((length == size) | (length == 2 * size))
        own = length[here] == size
        x = np.stack([folded(bits[i], size) for i in here])
        for a in np.flatnonzero(own):
            hit = may_link(x, x[a], n[here], n[here[a]], percent)
            hit[a] = False
            if hit.any():
                near[here[a]] = True
                near[here[hit]] = True
    return near


def block_links(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all linked members of each block (hub, k, n).

    Members of a block of more than BLOCK_SHINGLES are first probed against its hub, to which a
    group of near copies mostly links; only those that do not link are searched for in its parts.
    """
    of_hub = Window.partitionBy("hub")
    sized = stored(
        blocks.withColumn("large", F.sum("n").over(of_hub) > BLOCK_SHINGLES), "ngram-sized"
    )
    others = sets.select(F.col("k").alias("hub"), F.col("shingles").alias("others"))
    star = stored(
        _overlap_links(
            sized.where("large AND k <> hub")
            .join(sets, "k")
            .join(others, "hub")
            .select(F.col("hub").alias("a"), F.col("k").alias("b"), "shingles", "others"),
            percent,
        ),
        "ngram-tied",
    )
    tied = star.select(F.col("a").alias("hub"), F.col("b").alias("k"), F.lit(True).alias("tied"))
    members = sized.join(tied, ["hub", "k"], "left").withColumn("loose", F.col("tied").isNull())

    def searched(group: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, block in group.groupby("hub", sort=False):
            sets = [np.frombuffer(b, np.uint64) for b in block["shingles"]]
            k = block["k"].to_numpy()
            found = divide_skip(sets, percent, block["loose"].to_numpy(bool))
            links += [(k[x], k[y]) for x, y in found]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    found = (
        _grid(members, "n", BLOCK_SHINGLES)
        .select("bucket", "i", "j", "hub", "k", "loose")
        .join(sets, "k")
        .groupBy("bucket", "i", "j")
        .applyInPandas(searched, "a long, b long")
    )
    return star.unionByName(found)


def ngram_join(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """Classes and components of similar documents.

    Gives doc_id, n_shingles, class_key, component_id, component_key.

    Two documents link when 100 * |intersection| >= percent * |union| of their sets of shingles of
    ``width`` words; a text of fewer words is one shingle. ``component_id`` is the smallest doc_id
    reachable. Null, empty and blank texts have no shingles and link with nothing. Repeated rows
    and copies are answered each; they are one class in the search. Among rows without doc_id a
    component has none; ``component_key`` tells such ones apart, null where there are no shingles. Other columns of ``docs`` take no part.

    Every link between different sets is found or implied by others found. Shuffled are a fifth
    of the shingles, as 64-bit hashes, and the sets of those documents that share a rare one.
    """
    facts = stored(shingle_statistics(docs, width), "shingle-facts")
    counters = facts.where("part IS NOT NULL").select("part", "task", "counts")
    rows = facts.where("part IS NULL").select("doc_id", "n", "k")
    postings = rare_postings(docs, rarity(counters), width, percent)
    of_shingle = Window.partitionBy("shingle")
    blocks = stored(
        postings.withColumn("hub", F.min("k").over(of_shingle))
        .withColumn("last", F.max("k").over(of_shingle))
        .where("hub < last")
        .select("hub", "k")
        .distinct(),
        "ngram-blocks",
    )
    parities = facts.where("part IS NULL").select("n", "k", "parity")
    blocks = stored(near_members(blocks, parities, percent), "ngram-near")
    wanted = rows.join(blocks.select("k").distinct(), "k", "left_semi")
    wanted = stored(wanted.groupBy("k").agg(F.min("doc_id").alias("doc_id")), "ngram-wanted")
    ids = wanted.where("doc_id IS NOT NULL").select("doc_id").distinct()
    # Classes that only rows without id have are found among those by their key.
    nameless = wanted.where("doc_id IS NULL").select("k")
    unnamed = sets_of(docs.where("doc_id IS NULL"), width).join(nameless, "k", "left_semi")
    sets = sets_of(docs.join(ids, "doc_id", "left_semi"), width)
    sets = sets.unionByName(unnamed).dropDuplicates(["k"])
    found = components(block_links(blocks, stored(sets, "ngram-sets"), percent))
    placed = rows.join(found.withColumnRenamed("node", "k"), "k", "left")
    key = F.when(F.col("n") > 0, F.coalesce("root", "k"))
    least = (
        placed.where("n > 0")
        .groupBy(key.alias("in_root"))
        .agg(F.min("doc_id").alias("least_id"))
    )
    return (
        placed.withColumn("in_root", key)
        .join(least, "in_root", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.col("k").alias("class_key"),
            F.when(F.col("n") > 0, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.col("in_root").alias("component_key"),
        )
    )


def one_of_each_group(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the smallest doc_id stays.

    Of rows that repeat both doc_id and set of shingles one stays. Rows without doc_id go if a row
    with one is in their component; of a component without any doc_id one row stays.
    """
    # Names of its own, as docs may have any.
    names = ["__near_id", "__near_key", "__near_class", "__near_place"]
    id_, key, class_, place = names
    schema = T.StructType([*docs.schema.fields, T.StructField(class_, T.LongType())])

    def classed(batches):
        for batch in batches_of(batches, BATCH_BYTES, tidy=True):
            keys = [class_key(s) for s in shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, class_]
            )

    facts = ngram_join(docs, width, percent).groupBy(
        "doc_id", "class_key", "component_id", "component_key"
    )
    facts = stored(facts.agg(F.count("*").alias("times")), "ngram-facts")
    named = [F.col("doc_id").alias(id_), F.col("class_key").alias(key)]
    nameless = facts.where("component_id IS NULL AND component_key IS NOT NULL")
    least = nameless.groupBy("component_key").agg(F.min("class_key").alias("least"))
    nameless = nameless.join(least, "component_key")
    dropped = facts.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(*named)
    dropped = dropped.unionByName(nameless.where("class_key <> least").select(*named))
    repeated = facts.where("times > 1 AND doc_id = component_id").select(*named)
    repeated = repeated.unionByName(
        nameless.where("times > 1 AND class_key = least").select(*named)
    )
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(class_) == F.col(key))
    kept = docs.mapInArrow(classed, schema).join(dropped, same, "left_anti")
    if not repeated.isEmpty():
        of_row = Window.partitionBy("doc_id", class_).orderBy("text")
        once = kept.join(repeated, same, "left_semi").withColumn(place, F.row_number().over(of_row))
        kept = kept.join(repeated, same, "left_anti").unionByName(
            once.where(F.col(place) == 1).drop(place)
        )
    return kept.drop(class_)
