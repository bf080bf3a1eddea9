"""What each of five filters removes, in every order, kept up to date by a stream of files.

A row's mask has a bit for each filter that it fails. Four bits follow from its text; the fifth,
a smaller doc_id with the same text, may be set later. So the files are read as micro-batches, a
state keyed by text holds the smallest doc_id so far with its rows, and counters of masks are kept
by part: when a smaller doc_id arrives, the rows that held the place are taken off the counter of
their mask and added to that with the fifth bit. All orders are answered from the counters.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from signalmill.llm.common import batches_of
from signalmill.session import shared_folder

# Fixed values of the filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
CAPITALS = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"
FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
MASKS = 1 << len(FILTERS)

# Micro-batches of a run. Each rewrites the state of the texts that it meets, so few are cheap.
MICRO_BATCHES = 4
# Texts whose state is kept under one key.
BUCKET_TEXTS = 1024
# Rows of a task that are combined ahead of the shuffle at a time.
COMBINED_ROWS = 1 << 16

FACTS = "doc_id long, part string, mask int, h1 long, h2 long"
COUNTS = "part string, mask int, good boolean, toxic boolean, n long"
# Rows of one text and part with equal labels: n_least of them have the smallest id, n_other not.
COMBINED = (
    "bucket long, h1 long, h2 long, mask int, part string, good boolean, toxic boolean, "
    "least long, n_least long, n_other long"
)
TEXT = ["h1", "h2", "mask"]
GROUP = [*TEXT, "part", "good", "toxic"]
MEASURES = "kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long"


def failed(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # at 32 and 9 to 13, as bytes
    points = len(text.decode("utf-8", "replace"))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    tests = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * capitals > MAX_CAPITALS_PERCENT * points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, test in enumerate(tests) if test)


def text_facts(docs: DataFrame) -> DataFrame:
    """A row's part, the mask of its text alone, and 128 bits that stand for the text."""

    def made(batches):
        for batch in batches_of(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            marks = b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts)
            marks = np.frombuffer(marks, "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"),
                 pa.array([failed(t) for t in texts], pa.int32()),
                 pa.array(marks[:, 0]), pa.array(marks[:, 1])],
                ["doc_id", "part", "mask", "h1", "h2"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("part"), "text"
    )
    return rows.mapInArrow(made, FACTS)


def combined(labelled: DataFrame, buckets: int) -> DataFrame:
    """Rows of equal text, part and labels of a task as one; so a hot text is few rows."""

    def reduced(rows: pd.DataFrame) -> pd.DataFrame:
        least = rows.groupby(GROUP, sort=False)["doc_id"].transform("min")
        # A row without doc_id is no smaller than any, and none is smaller than it: n_least of 0
        # ids. It is counted with its own least, which is null.
        at = (rows["doc_id"] == least) | least.isna()
        rows = rows.assign(least=least, n_least=at.astype("int64"), n_other=(~at).astype("int64"))
        out = rows.groupby([*GROUP, "least"], sort=False, dropna=False, as_index=False)
        out = out[["n_least", "n_other"]].sum()
        return out.assign(bucket=out["h1"] % buckets)[[c.split()[0] for c in COMBINED.split(", ")]]

    def made(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= COMBINED_ROWS:
                yield from flushed(held)
                held, size = [], 0
        if size:
            yield from flushed(held)

    def flushed(held):
        rows = pa.Table.from_batches(held).to_pandas(types_mapper=_nullable)
        # Rows without an id apart, as they never compare.
        nameless = rows["doc_id"].isna()
        out = pd.concat([reduced(r) for r in (rows[~nameless], rows[nameless]) if len(r)])
        yield from pa.Table.from_pandas(out, pa_schema(), preserve_index=False).to_batches()

    return labelled.mapInArrow(made, COMBINED)


def _nullable(kind: pa.DataType):
    return pd.Int64Dtype() if kind == pa.int64() else None


def pa_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(c, kinds[k]) for c, k in (x.split() for x in COMBINED.split(", "))])


def changes(held: pd.DataFrame, new: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The next state, and what is added to the counters, of texts held and rows that arrive.

    ``held`` has the rows of each text's smallest id so far, already counted without the fifth
    bit. Where a smaller one arrives, they are taken off there and counted with it.
    """
    old = held.assign(old=True, n_other=np.int64(0))
    rows = pd.concat([old, new[[*GROUP, "least", "n_least", "n_other"]].assign(old=False)])
    smallest = rows.groupby(["h1", "h2"], sort=False)["least"].transform("min")
    holds = (rows["least"] == smallest) | rows["least"].isna()
    first, was_old = rows["n_least"], rows["old"].astype(bool)
    # A row counted anew adds to its mask; one that loses its place is taken off.
    plain = np.where(was_old, np.where(holds, 0, -first), np.where(holds, first, 0))
    repeated = rows["n_other"] + np.where(holds, 0, first)
    counts = pd.concat(
        [rows.assign(n=plain), rows.assign(n=repeated, mask=rows["mask"] | REPEATED)]
    )
    counts = counts.groupby(["part", "mask", "good", "toxic"], as_index=False)["n"].sum()
    kept = rows[holds & rows["least"].notna()]
    state = kept.groupby([*GROUP, "least"], sort=False, as_index=False)["n_least"].sum()
    return state, counts[counts["n"] != 0]


def _pack(state: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(state, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(state: GroupState) -> pd.DataFrame:
    if not state.exists:
        kinds = dict.fromkeys(["h1", "h2", "least", "n_least"], "int64")
        kinds |= {"mask": "int32", "part": "object", "good": "bool", "toxic": "bool"}
        return pd.DataFrame({c: pd.Series(dtype=k) for c, k in kinds.items()})
    with pa.ipc.open_stream(state.get[0]) as reader:
        return reader.read_pandas()


def _advance(key, groups: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = _unpack(state)
    for new in groups:
        held, counts = changes(held, new)
        yield counts
    state.update((_pack(held),))


def label_flags(labels: DataFrame) -> DataFrame:
    """good and toxic of each doc_id: whether any of its rows says so."""
    flags = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    return (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(*(F.coalesce(F.max(f), F.lit(False)).alias(c) for c, f in flags.items()))
    )


def mask_counters(
    docs: DataFrame, labels: DataFrame, folder: str, buckets: int
) -> DataFrame:
    """Run the stream ``docs`` to its end; the counters of masks: part, mask, good, toxic, n.

    ``folder`` keeps checkpoint, state and the changes of each micro-batch. A run that died is
    taken up there; files that came since then are added by another run, with the same ``buckets``.
    """
    spark = docs.sparkSession
    path = f"{folder}/changes"
    spark.createDataFrame([], COUNTS).write.mode("ignore").parquet(f"{path}/batch=-1")
    labelled = (
        text_facts(docs)
        .join(label_flags(labels), "doc_id", "left")
        .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    )
    moved = (
        combined(labelled, buckets)
        .groupBy("bucket")
        .applyInPandasWithState(
            _advance, COUNTS, "held binary", "append", GroupStateTimeout.NoTimeout
        )
    )

    def write(batch: DataFrame, number: int) -> None:
        # A repeated micro-batch replaces its own changes.
        added = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        added.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        moved.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    total = spark.read.schema(COUNTS).parquet(path).groupBy("part", "mask", "good", "toxic")
    return total.agg(F.sum("n").alias("n")).where("n <> 0")


def orders() -> pd.DataFrame:
    """Every order of the filters with its steps: the filter's bit and those ahead of it."""
    rows = []
    for order in itertools.permutations(FILTERS):
        ahead = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            rows.append(("".join(order), step, bit, ahead))
            ahead |= bit
    return pd.DataFrame(rows, columns=["filter_order", "step", "bit", "ahead"])


def order_report(counters: DataFrame) -> DataFrame:
    """A row per part, order and step from the counters of masks, of which a part has 128."""

    def reported(rows: pd.DataFrame) -> pd.DataFrame:
        out = orders()
        mask, n = rows["mask"].to_numpy(), rows["n"].to_numpy()
        by_mask = {
            "all": np.bincount(mask, n, MASKS),
            "good": np.bincount(mask, n * rows["good"], MASKS),
            "toxic": np.bincount(mask, n * rows["toxic"], MASKS),
        }
        by_mask = {k: v.astype(np.int64) for k, v in by_mask.items()}
        bit, ahead = out.pop("bit").to_numpy(), out.pop("ahead").to_numpy()
        masks = np.arange(MASKS)
        fails = (masks & bit[:, None]) != 0
        passed = (masks & ahead[:, None]) == 0
        every = by_mask["all"]
        out["kept"] = (~fails & passed) @ every
        out["removed"] = (fails & passed) @ every
        out["redundant"] = (fails & ~passed) @ every
        out["unique_fails"] = every[bit]
        out["good_lost"] = (fails & passed) @ by_mask["good"]
        out["toxic_lost"] = (fails & passed) @ by_mask["toxic"]
        out["shapley"] = out.groupby(bit)["removed"].transform("sum")
        out.insert(0, "part", rows["part"].iloc[0])
        return out

    return counters.groupBy("part").applyInPandas(
        reported, f"part string, filter_order string, step int, {MEASURES}, shapley long"
    )


def filter_audit(
    spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES
) -> DataFrame:
    """The report of all orders over the documents in the Parquet files at ``path``.

    A row per part (the source; null counts as empty), filter_order and step. Null texts count as
    empty and equal each other and empty ones. Texts are told apart by 128 bits of a hash. Rows
    that repeat the smallest doc_id of a text do not fail E; a row without doc_id neither fails it
    nor makes others fail. A doc_id with several labels is good, or toxic, if one says so.
    Very long texts count whole; without documents there are no rows; other columns take no part.
    Files are read in at most ``micro_batches`` micro-batches; the result does not depend on them.
    """
    docs = spark.read.parquet(path).select("doc_id", "source", "text")
    files = len(docs.inputFiles())
    buckets = max(1, docs.count() // BUCKET_TEXTS)
    # As a pattern the path may also name a single file, which a stream takes for no folder.
    pattern = f"{path[:-1]}[{path[-1]}]" if path[-1].isalnum() else path
    stream = (
        spark.readStream.schema(docs.schema)
        .option("maxFilesPerTrigger", max(1, -(-files // micro_batches)))
        .parquet(pattern)
    )
    counters = mask_counters(stream, labels, shared_folder(spark, "filter-audit"), buckets)
    return order_report(counters)
