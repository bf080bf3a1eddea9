"""Language-model scores by online logistic context mixing.

A token is coded as the CODE_BITS bits of its class, a part of its hash, and then as a word of the
class by how often it occurs. Each bit is predicted in several contexts: none, the word before,
the two words before, and the shortest of the last words, which is mostly one of the language's
function words. Hashed tables hold for each context and bit prefix how the bit fell in all training
texts. A gated mixer adds the predictions in the logistic domain, with a set of weights chosen by
how well the longer contexts are known, and an adaptive map refines the result. Weights and map
learn from each bit as it comes, anew in each segment of a text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import batches_of, id_hash, spans, stored
from signalmill.llm.counters import counter_columns, summed
from signalmill.llm.words import mixed, words_of

CODE_BITS = 10
# Slots of each hashed table: the size of the model, at any size of the corpus.
SLOT_BITS = 20
HASHED = 3
SLOTS = 1 << SLOT_BITS
NODES = 1 << CODE_BITS
COUNTERS = 2 * (NODES + HASHED * SLOTS)
# Words whose counts are sent to every task, the most frequent ones; others are joined.
HEAD_WORDS = 1 << 20
# Tokens after which weights and map start anew, so that long texts are scored side by side.
SEGMENT = 256
RECENT = 4
BATCH_BYTES = 1 << 22
# Texts taken apart at once, so that their bytes' hashes stay in the cache.
TEXTS = 256
# Counting takes more memory a token than scoring.
COUNTED_BYTES = 1 << 21
RATE = np.float32(0.02)
MAP_RATE = np.float32(0.02)
MAP_CELLS = 24
LIMIT = np.float32(11.9)
FIRST_WEIGHTS = (0.30, 0.35, 0.45, 0.35)
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and length of each token of all texts, an end behind each, and the texts' offsets."""
    some = range(0, max(1, len(column)), TEXTS)
    parts = [words_of(column.slice(a, TEXTS)) for a in some]
    words, length, texts = zip(*parts, strict=True)
    words, length = np.concatenate(words), np.concatenate(length)
    texts = spans(np.concatenate([np.diff(x) for x in texts]))
    return (
        np.insert(words, texts[1:], END),
        np.insert(length, texts[1:], 0),
        texts + np.arange(len(texts)),
    )


def contexts_of(tokens: np.ndarray, length: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Hashed contexts (HASHED x tokens) of each token: one word, two words, shortest of RECENT."""
    place = np.arange(len(tokens)) - np.repeat(texts[:-1], np.diff(texts))
    shortest, least = np.full(len(tokens), START), np.full(len(tokens), 1 << 62)
    before = []
    for back in range(1, RECENT + 1):
        there = place >= back
        word = np.where(there, np.roll(tokens, back), START)
        size = np.where(there, np.roll(length, back), 1 << 62)
        shorter = size < least
        shortest, least = np.where(shorter, word, shortest), np.where(shorter, size, least)
        before.append(word)
    one = mixed(before[0] * _MIX[0])
    two = mixed(before[0] * _MIX[1] + before[1] * _MIX[0])
    short = mixed(shortest * _MIX[2] + np.uint64(1))
    return np.stack([one, two, short]).astype(np.uint32)


def codes_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CODE_BITS)).astype(np.uint32)


def slots(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    mix = node * np.uint32(0x9E3779B1)
    mix ^= context
    mix *= np.uint32(0x85EBCA6B)
    mix ^= mix >> np.uint32(15)
    mix >>= np.uint32(32 - SLOT_BITS)
    return mix


def nodes_of(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit prefixes (CODE_BITS x tokens) of each code, a one before them, and the bit behind each."""
    level = np.arange(CODE_BITS, dtype=np.uint32)[:, None]
    node = np.uint32(1) << level | code >> np.uint32(CODE_BITS) - level
    return node, code >> np.uint32(CODE_BITS - 1) - level & np.uint32(1)


def add_bit_counts(
    total: np.ndarray, tokens: np.ndarray, length: np.ndarray, texts: np.ndarray
) -> None:
    """Add how often each bit was 0 and 1 at each node without context, and in each hashed slot."""
    code, context = codes_of(tokens), contexts_of(tokens, length, texts)
    node, bit = nodes_of(code)
    total[: 2 * NODES] += np.bincount((node * 2 + bit).ravel(), minlength=2 * NODES)
    for k, one in enumerate(context):
        at = slots(one, node) * np.uint32(2) + bit
        first = 2 * (NODES + k * SLOTS)
        total[first : first + 2 * SLOTS] += np.bincount(at.ravel(), minlength=2 * SLOTS)


@dataclass
class MixingModel:
    """Per slot a stretched probability in sixteenths, and in the low two bits how sure it is."""

    tables: list[np.ndarray]
    class_log: np.ndarray  # of each class log10 of what a word's count is divided by

    @staticmethod
    def of(counts: np.ndarray, class_size: np.ndarray, class_words: np.ndarray) -> MixingModel:
        zero, one = counts[::2].astype(np.float64), counts[1::2].astype(np.float64)
        stretched = np.log((one + 0.4) / (zero + 0.4))
        seen = zero + one
        sure = (seen > 0).astype(np.int16) + (seen >= 4) + (seen >= 64)
        value = np.clip(np.rint(stretched * 16), -128, 127).astype(np.int16) * 4 + sure
        edges = [0, *(NODES + SLOTS * i for i in range(HASHED + 1))]
        return MixingModel(
            [value[a:b].astype(np.int16) for a, b in zip(edges, edges[1:], strict=False)],
            np.log10(class_size + 0.5 * (class_words + 1)),
        )

    def code_logs(self, tokens: np.ndarray, length: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """log2 of the probability of each text's class bits, in the order of the tokens."""
        code, context = codes_of(tokens), contexts_of(tokens, length, texts)
        n = np.diff(texts)
        lanes_of = -(-n // SEGMENT)
        text = np.repeat(np.arange(len(n)), lanes_of)
        number = np.arange(len(text)) - np.repeat(np.cumsum(lanes_of) - lanes_of, lanes_of)
        first = texts[text] + number * SEGMENT
        size = np.minimum(SEGMENT, texts[text + 1] - first)
        order = np.argsort(-size, kind="stable")
        first, size, text = first[order], size[order], text[order]
        lanes = len(first)
        active = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), side="left")
        weights = np.empty((lanes * 16, HASHED + 1), np.float32)
        weights[:] = FIRST_WEIGHTS
        # The same as items of 16 bytes: numpy sets these several times as fast as rows.
        items = weights.view(np.complex128).reshape(-1)
        cells = np.linspace(-12, 12, MAP_CELLS, dtype=np.float32)
        refined = np.tile(1 / (1 + np.exp(-cells)), lanes * CODE_BITS).astype(np.float32)
        gate_base = np.arange(lanes) * 16
        cell_base = np.arange(lanes * CODE_BITS).reshape(CODE_BITS, lanes) * MAP_CELLS
        total = np.zeros(lanes)
        for step, m in enumerate(active):
            # A token's code is known, so all its predictors are looked up before any is mixed.
            at = first[:m] + step
            node, bit = nodes_of(code.take(at))
            value = np.empty((CODE_BITS, m, HASHED + 1), np.int16)
            value[..., 0] = self.tables[0].take(node, mode="clip")
            for k in range(HASHED):
                found = slots(context[k].take(at), node)
                value[..., k + 1] = self.tables[k + 1].take(found, mode="clip")
            gate = (value[..., 2] & 3) * 4 + (value[..., 1] & 3) + gate_base[:m]
            # With a minus, as it is the sum's negative whose exponential is taken.
            x = (value >> 2).astype(np.float32)
            x *= np.float32(-1 / 16)
            was_one = bit == 1
            bit = bit.astype(np.float32)
            dot, p = np.empty((2, CODE_BITS, m), np.float32)
            for level in range(CODE_BITS):
                w = weights.take(gate[level], axis=0, mode="clip")
                part = w * x[level]
                here = np.add(part[:, 0], part[:, 1], out=dot[level])
                here += part[:, 2]
                here += part[:, 3]
                here.clip(-LIMIT, LIMIT, out=here)
                error = np.exp(here, out=p[level])
                error += 1
                np.divide(1, error, out=error)
                error = bit[level] - error
                error *= RATE
                part = error.repeat(HASHED + 1).reshape(m, HASHED + 1)
                part *= x[level]
                w -= part
                items[gate[level]] = w.view(np.complex128)[:, 0]
            # Each level has a map of its own, so all are read and learn at once.
            np.subtract(12, dot, out=dot)
            dot *= (MAP_CELLS - 1) / 24
            cell = np.rint(dot, out=dot).astype(np.int64)
            cell += cell_base[:, :m]
            map_p = refined.take(cell, mode="clip")
            change = bit.astype(np.float64)
            change -= map_p
            change *= MAP_RATE
            change += map_p
            refined[cell] = change.astype(np.float32)
            # The map's cells are coarse, so it moves the mixer's answer by a quarter.
            p *= np.float32(0.75)
            map_p *= np.float32(0.25)
            p += map_p
            p.clip(1e-5, 1 - 1e-5, out=p)
            likely = np.multiply.reduce(np.where(was_one, p, 1 - p), axis=0)
            total[:m] += np.log2(likely.astype(np.float64))
        return np.bincount(text, total, len(n))


def training():
    """Whether a document is learned from."""
    return id_hash() % 5 != 1


def learn_words(docs: DataFrame) -> DataFrame:
    """How often each token, by hash, occurs in the texts: h, n. Tasks sum before the shuffle."""

    def counted(batches):
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def added():
            h, place = np.unique(np.concatenate([x for x, _ in waiting]), return_inverse=True)
            n = np.bincount(place, np.concatenate([y for _, y in waiting])).astype(np.int64)
            return h, n

        for batch in batches_of(batches, BATCH_BYTES):
            waiting.append(np.unique(tokens_of(batch.column("text"))[0], return_counts=True))
            if sum(len(h) for h, _ in waiting) > 1 << 21:
                h, n = added()
                yield _columns(h=h.view(np.int64), n=n)
                waiting = []
        if waiting:
            h, n = added()
            yield _columns(h=h.view(np.int64), n=n)

    found = docs.select("text").mapInArrow(counted, "h long, n long")
    return found.groupBy("h").agg(F.sum("n").alias("n"))


def _columns(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], list(columns))


def learn_bits(docs: DataFrame) -> np.ndarray:
    """The counts of all texts' bits; what the driver gets is of a fixed size."""

    def counted(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches_of(batches, COUNTED_BYTES):
            add_bit_counts(total, *tokens_of(batch.column("text")))
        if total.any():
            yield pa.RecordBatch.from_arrays(counter_columns(total), ["part", "task", "counts"])

    rows = docs.select("text").mapInArrow(counted, "part int, task int, counts binary")
    return summed(rows, COUNTERS)


def context_mixing_scores(docs: DataFrame, train, head_words: int = HEAD_WORDS) -> DataFrame:
    """Scores of every text by a model learned from those where ``train`` holds.

    Gives doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte. A text's
    tokens are its words in lower case A-Z and an end, so a null or empty text is its end alone;
    ``bits_per_byte`` is null there. Without any training text every token has a base probability
    of 1 and each class bit one of a half. Repeated rows are learned from and scored each; other
    columns of ``docs`` take no part. A null doc_id is hashed as an empty text.

    Counts are kept by 64-bit hash. Those of the ``head_words`` most frequent words go to every
    task, 16 bytes a word; the rare words of a text are joined to the rest of the counts.
    """
    spark = docs.sparkSession
    learned = docs.where(train)
    words = stored(learn_words(learned), "words")
    code = F.shiftrightunsigned("h", 64 - CODE_BITS)
    classes = words.groupBy(code.alias("code")).agg(
        F.sum("n").alias("size"), F.count("*").alias("words")
    )
    classes = classes.toArrow()
    class_size, class_words, at = np.zeros(NODES), np.zeros(NODES), classes["code"].to_numpy()
    class_size[at], class_words[at] = classes["size"].to_numpy(), classes["words"].to_numpy()
    all_tokens, all_words = int(class_size.sum()), int(class_words.sum())
    # The least count in the head: counts in steps of an eighth of a doubling.
    step = F.floor(8 * F.log2(F.col("n").cast("double")))
    steps = words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    least, held = 1 << 62, 0
    for row in steps:
        held += row["count"]
        if held > head_words:
            break
        least = row["step"]
    head = words.where(step >= least).toArrow()
    head_h = head["h"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(head_h)
    head_h, head_n = head_h[order], head["n"].to_numpy().astype(np.float64)[order]
    model = MixingModel.of(learn_bits(learned), class_size, class_words)
    shared = spark.sparkContext.broadcast((head_h, head_n, model))

    def scored(batches):
        head_h, head_n, model = shared.value
        for batch in batches_of(batches, BATCH_BYTES):
            tokens, length, texts = tokens_of(batch.column("text"))
            code_log = model.code_logs(tokens, length, texts) * np.log10(2)
            different, place = np.unique(tokens, return_inverse=True)
            at = np.searchsorted(head_h, different)
            at[at == len(head_h)] = 0
            found = head_h[at] == different if len(head_h) else np.zeros(len(different), bool)
            log_c = np.where(found, np.log10(head_n[at] + 0.5), 0.0) if len(head_h) else 0.0 * found
            known = found[place]
            starts = texts[:-1]
            tail = tokens[~known].view(np.int64)
            edge = np.concatenate([[0], np.cumsum(np.add.reduceat(~known, starts, dtype=np.int64))])
            class_log = np.add.reduceat(model.class_log[codes_of(tokens)], starts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(texts)),
                    pa.array(np.add.reduceat(known, starts, dtype=np.int64)),
                    pa.array(np.add.reduceat(log_c[place], starts)),
                    pa.array(code_log - class_log),
                    pa.LargeListArray.from_arrays(edge, tail).cast(pa.list_(pa.int64())),
                    pa.array([len(t) if t else 0 for t in
                              batch.column("text").cast(pa.binary()).to_pylist()], pa.int64()),
                ],
                ["doc_id", "n_tokens", "known", "count_log", "model_log", "tail", "n_bytes"],
            )

    schema = (
        "doc_id long, n_tokens long, known long, count_log double, model_log double, "
        "tail array<long>, n_bytes long"
    )
    rows = docs.select("doc_id", "text").mapInArrow(scored, schema)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = words.where(step < least)
    tail = (
        rows.select("row", F.explode("tail").alias("h"))
        .groupBy("row", "h")
        .agg(F.count("*").alias("times"))
        .join(rare, "h", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail_log"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
        )
    )
    count_log = F.col("count_log") + F.coalesce("tail_log", F.lit(0.0))
    all_log = float(np.log10(all_tokens + 0.5 * (all_words + 1)))
    score = count_log + F.col("model_log")
    return rows.join(tail, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (count_log - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        score.alias("score"),
        F.when(
            F.col("n_bytes") > 0, -score / F.lit(float(np.log10(2))) / F.col("n_bytes")
        ).alias("bits_per_byte"),
    )
