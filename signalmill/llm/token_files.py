"""Token-ID files coded by a static range asymmetric numeral system.

One frequency table, counted over all documents, serves every block. A block holds whole documents
and can be read alone: its ids are dealt in turn to LANES interleaved coders. Every SEGMENT steps
the coders' states and places in the words are kept as a checkpoint, so that segments decode side
by side, and a checksum over the ids guards the block.

The files are Parquet, so they go where Spark writes and are committed as a whole:
``blocks`` with the columns of BLOCK, in ascending order of doc_id over parts and blocks, and
``frequencies`` with id and freq. ``words`` and ``cursors`` are little-endian unsigned 32-bit,
``states`` 64-bit; words lie lane by lane in decoding order.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalmill.llm.byte_tokens import byte_tokens
from signalmill.llm.common import batches_of, spans, stored

LANES = 64
SEGMENT = 512
BLOCK_TOKENS = 65536
# Ids coded at a time by a task; a longer document is coded alone.
TASK_TOKENS = 1 << 21
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
BLOCK = (
    "part int, block int, part_start long, doc_ids array<long>, lengths array<long>, "
    "n_tokens long, checksum long, states binary, cursors binary, words binary"
)


@dataclass
class Frequencies:
    """Frequencies of the ids, of sum 2 ** bits; each id that occurs has one at least."""

    freq: np.ndarray
    bits: int

    def __post_init__(self):
        self.cum = np.concatenate([[0], np.cumsum(self.freq)])[:-1].astype(np.uint64)
        self.id_of_slot = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq)
        self.freq = self.freq.astype(np.uint64)


def quantized(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Frequencies by id for these counts, of sum 2 ** bits for the least useful number of bits."""
    size = int(ids.max(initial=-1)) + 1
    bits = frequency_bits(size)
    freq = np.zeros(size, np.int64)
    freq[ids] = np.maximum(1, counts * float(1 << bits) / max(1, counts.sum())).astype(np.int64)
    excess = int(freq.sum()) - (1 << bits)
    for i in np.argsort(-freq, kind="stable"):
        if not len(ids) or not excess:
            break
        less = min(excess, int(freq[i]) - 1) if excess > 0 else excess
        freq[i] -= less
        excess -= less
    return freq


def frequency_bits(size: int) -> int:
    return max(12, int(size).bit_length() + 3)


def _lanes(n_tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First id and number of ids of every lane of every block (blocks x LANES)."""
    lane = np.arange(LANES)
    return spans(n_tokens)[:-1, None] + lane, (n_tokens[:, None] - lane + LANES - 1) // LANES


def encode_blocks(ids: np.ndarray, n_tokens: np.ndarray, table: Frequencies) -> list[tuple]:
    """States, cursors and words of each block; ``ids`` holds the blocks one behind the other."""
    first, count = (x.ravel() for x in _lanes(n_tokens))
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    n_steps = int(count.max(initial=0))
    active = np.searchsorted(-count, -np.arange(n_steps), side="left")
    state = np.full(len(first), LOW, np.uint64)
    sent = np.zeros(len(first), np.int64)
    kept = {}
    lanes, words = [], []
    shift = np.uint64(63 - table.bits)
    for step in range(n_steps - 1, -1, -1):
        m = active[step]
        symbol = ids[first[:m] + step * LANES]
        freq, x = table.freq[symbol], state[:m]
        out = np.flatnonzero(x >= freq << shift)
        if len(out):
            lanes.append(out)
            words.append((x[out] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x[out] >>= WORD
            sent[out] += 1
        whole = x // freq
        state[:m] = (whole << np.uint64(table.bits)) + (x - whole * freq) + table.cum[symbol]
        if step % SEGMENT == 0:
            kept[step] = state.copy(), sent.copy()
    back = np.argsort(order)
    lane = order[np.concatenate([*lanes, np.zeros(0, np.int64)])][::-1]
    word = np.concatenate([*words, np.zeros(0, "<u4")])[::-1]
    word = word[np.argsort(lane, kind="stable")]
    total = sent[back].reshape(-1, LANES)
    edge = spans(total.sum(axis=1))
    out = []
    for b, n in enumerate(n_tokens):
        mine = slice(b * LANES, (b + 1) * LANES)
        steps = range(0, -(-int(n) // LANES), SEGMENT)
        base = spans(total[b])[:-1]
        states = [kept[s][0][back[mine]] for s in steps]
        cursors = [base + total[b] - kept[s][1][back[mine]] for s in steps]
        out.append(
            (
                np.array(states, "<u8").tobytes(),
                np.array(cursors, "<u4").tobytes(),
                word[edge[b] : edge[b + 1]].astype("<u4").tobytes(),
            )
        )
    return out


def decode_blocks(
    n_tokens: np.ndarray, coded: list[tuple[bytes, bytes, bytes]], table: Frequencies
) -> np.ndarray:
    """The ids of all blocks, one behind the other; every lane of every segment runs by itself."""
    segments = -(-n_tokens // (LANES * SEGMENT))
    block = np.repeat(np.arange(len(n_tokens)), segments)
    number = np.arange(len(block)) - spans(segments)[block]
    first, count = _lanes(n_tokens)
    first = (first[block] + (number * SEGMENT * LANES)[:, None]).ravel()
    count = np.clip(count[block] - (number * SEGMENT)[:, None], 0, SEGMENT).ravel()
    words = np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(c[2], "<u4") for c in coded)])
    edge = spans(np.array([len(c[2]) // 4 for c in coded], np.int64))
    cursor = np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(c[1], "<u4") for c in coded)])
    cursor = cursor.astype(np.int64) + np.repeat(edge[block], LANES)
    state = np.concatenate([np.zeros(0, "<u8"), *(np.frombuffer(c[0], "<u8") for c in coded)])
    order = np.argsort(-count, kind="stable")
    first, count, cursor, state = (x[order] for x in (first, count, cursor, state))
    state = state.astype(np.uint64)
    ids = np.zeros(int(n_tokens.sum()), np.uint32)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    n_steps = int(count.max(initial=0))
    active = np.searchsorted(-count, -np.arange(n_steps), side="left")
    for step in range(n_steps):
        m = active[step]
        x = state[:m]
        slot = x & mask
        symbol = table.id_of_slot[slot]
        ids[first[:m] + step * LANES] = symbol
        x = table.freq[symbol] * (x >> bits) + slot - table.cum[symbol]
        short = np.flatnonzero(x < LOW)
        x[short] = x[short] << WORD | words[cursor[short]]
        cursor[short] += 1
        state[:m] = x
    return ids


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int, width: int) -> DataFrame:
    """doc_id and ids (little-endian, of ``width`` bytes) of every text, the end id behind it."""
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches):
        model = byte_tokens(tokenizer_path)
        for batch in batches_of(batches):
            ids = [
                np.frombuffer(x + end, "<u4").astype(f"<u{width}").tobytes()
                for x in model.encode(batch.column("text").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"]
            )

    return docs.select("doc_id", "text").mapInArrow(encoded, "doc_id long, ids binary")


def id_counts(ids: DataFrame, width: int) -> DataFrame:
    """How often each id occurs: id, n. Tasks sum before the shuffle."""

    def counted(batches):
        total = np.zeros(0, np.int64)
        for batch in batches_of(batches, text="ids"):
            data = b"".join(batch.column("ids").to_pylist())
            n = np.bincount(np.frombuffer(data, f"<u{width}"), minlength=len(total))
            n[: len(total)] += total
            total = n
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    return (
        ids.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    )


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Code all texts into files below ``path``, which must be new and shared by all executors.

    A null or empty text is its end id alone. Repeated rows are documents of their own; equal
    doc_ids are ordered by their ids, a null doc_id comes first. Other columns take no part.
    """
    spark = docs.sparkSession
    width = byte_tokens(tokenizer_path).width
    ids = stored(token_ids(docs, tokenizer_path, end_id, width), "ids")
    counts = id_counts(ids, width).toArrow()  # one row an id of the vocabulary at most
    freq = quantized(
        counts["id"].to_numpy().astype(np.int64), counts["n"].to_numpy().astype(np.int64)
    )
    used = np.flatnonzero(freq)
    spark.createDataFrame(
        list(zip(used.tolist(), freq[used].tolist(), strict=True)), "id long, freq long"
    ).coalesce(1).write.parquet(f"{path}/frequencies")
    shared = spark.sparkContext.broadcast(Frequencies(freq, frequency_bits(len(freq))))

    def coded(batches):
        part, start, number = TaskContext.get().partitionId(), 0, 0
        group: list[tuple[list, list, bytes]] = []

        def flush():
            nonlocal start, number, group
            sizes = np.array([len(data) // width for _, _, data in group], np.int64)
            flat = np.frombuffer(b"".join(data for _, _, data in group), f"<u{width}")
            rows = []
            for (doc_ids, lengths, data), n, parts in zip(
                group, sizes.tolist(), encode_blocks(flat, sizes, shared.value), strict=True
            ):
                full = np.frombuffer(data, f"<u{width}").astype("<u4").tobytes()
                rows.append((part, number, start, doc_ids, lengths, n, zlib.crc32(full), *parts))
                start += n
                number += 1
            group = []
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.int64()), pa.int64(), pa.int64(), *[pa.binary()] * 3]
            names = [c.split()[0] for c in BLOCK.split(", ")]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        doc_ids, lengths, data, waiting = [], [], [], 0
        for batch in batches_of(batches, text="ids"):
            for doc_id, one in zip(
                batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True
            ):
                doc_ids.append(doc_id)
                lengths.append(len(one) // width)
                data.append(one)
                waiting += len(one) // width
                if waiting >= BLOCK_TOKENS:
                    group.append((doc_ids, lengths, b"".join(data)))
                    doc_ids, lengths, data, waiting = [], [], [], 0
                    if sum(len(x[2]) for x in group) >= width * TASK_TOKENS:
                        yield flush()
        if doc_ids:
            group.append((doc_ids, lengths, b"".join(data)))
        if group:
            yield flush()

    tie = F.xxhash64("ids")
    (
        ids.repartitionByRange("doc_id", tie)
        .sortWithinPartitions("doc_id", tie, "ids")
        .mapInArrow(coded, BLOCK)
        .write.option("compression", "uncompressed")
        .parquet(f"{path}/blocks")
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files: doc_id, start (ids of all documents before it), ids.

    A block whose ids do not give its checksum raises an error.
    """
    table = spark.read.schema("id long, freq long").parquet(f"{path}/frequencies").toArrow()
    ids = table["id"].to_numpy().astype(np.int64)
    size = int(ids.max(initial=-1)) + 1
    freq = np.zeros(size, np.int64)
    freq[ids] = table["freq"].to_numpy()
    shared = spark.sparkContext.broadcast(Frequencies(freq, frequency_bits(size)))
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    # A row for each shuffle partition of the writer at most.
    parts = parts.select(F.col("part").alias("of"), before.alias("before"))

    def decoded(batches):
        for batch in batches_of(batches, 1 << 23, "words"):
            rows = batch.to_pylist()
            sizes = np.array([r["n_tokens"] for r in rows], np.int64)
            coded = [(r["states"], r["cursors"], r["words"]) for r in rows]
            ids = decode_blocks(sizes, coded, shared.value).astype("<u4")
            doc, starts, parts_ = [], [], []
            for r, a in zip(rows, spans(sizes).tolist(), strict=False):
                data = ids[a : a + r["n_tokens"]].tobytes()
                if zlib.crc32(data) != r["checksum"]:
                    raise ValueError(f"part {r['part']}, block {r['block']}: wrong checksum")
                edge = spans(np.array(r["lengths"], np.int64)).tolist()
                doc += r["doc_ids"]
                starts += [r["before"] + r["part_start"] + x for x in edge[:-1]]
                parts_ += [data[4 * x : 4 * y] for x, y in zip(edge, edge[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(parts_, pa.binary())],
                ["doc_id", "start", "ids"],
            )

    return (
        blocks.join(F.broadcast(parts), F.col("part") == F.col("of"))
        .drop("of")
        .mapInArrow(decoded, "doc_id long, start long, ids binary")
    )


def token_digest(files: DataFrame) -> DataFrame:
    """Number and checksum of each document's ids."""
    return files.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
