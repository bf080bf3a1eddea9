"""Token counts of a byte-fallback BPE piece model by rank-synchronous array merging.

The pre-tokens of a batch lie one behind the other in flat arrays. In each round every sequence
finds its pair of lowest rank, and all sequences merge theirs at the same time; what is left when
no pair has a rank are the tokens. Frequent pre-tokens are counted once and remembered.
"""

from __future__ import annotations

import functools
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from signalmill.llm.common import batches_of

NO_RANK = np.int32(2**31 - 1)
LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
# Remembered pre-tokens of a worker; beyond that it starts anew. Bounds memory, not results.
REMEMBERED = 500_000
# Slots of the hashed merge table: a few per pair, so that hardly any pair shares one.
SLOT_BITS = 20


class PieceMerger:
    """The merge table of a sentencepiece BPE model with byte fallback and a space prefix."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        score = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(n)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        ranks = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        symbols = {p: i for i, p in enumerate(dict.fromkeys([*score, *"".join(score)]))}
        self.unknown = len(symbols)
        left, right, merged, rank = [], [], [], []
        for piece, s in score.items():
            for cut in range(1, len(piece)):
                a, b = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(symbols[piece])
                    rank.append(ranks[s])
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.merged = np.array(merged, np.int32)[order]
        self.rank = np.array(rank, np.int32)[order]
        slot = self._slots(self.keys)
        self.slot = np.full(1 << SLOT_BITS, -1, np.int32)
        self.slot[slot] = np.arange(len(slot))
        self.crowded = np.bincount(slot, minlength=len(self.slot)) > 1
        chars = sorted((ord(p), i) for p, i in symbols.items() if len(p) == 1)
        self.chars = np.array([c for c, _ in chars], np.uint32)
        self.char_symbol = np.array([i for _, i in chars], np.int32)
        self.is_piece = np.array([p in score for p in symbols] + [False])
        inner = set("".join(p for p in score if len(p) > 1))
        # A line end that no piece holds parts a text for certain, as does the start of spaces
        # if pieces hold spaces only in front.
        if any("▁" in p.lstrip("▁") for p in score):
            raise ValueError("pieces with inner spaces need another split")
        end = "" if "\n" in inner else "\n"
        # Likewise where no piece holds a letter before a mark: words part from what follows.
        after = set("".join(re.findall(f"(?<={LETTER}).", "".join(f"{p} " for p in score))))
        marks = re.escape("".join(sorted(set(string.punctuation) - after)))
        word = f"▁*{LETTER}+(?=[▁{end}{marks}]|\\Z)|" if marks else ""
        self.split = re.compile(f"{word}▁+[^▁{end}]*|[^▁{end}]+|{end or '(?!)'}").findall
        self.known: dict[str, int] = {}

    @staticmethod
    def _slots(key: np.ndarray) -> np.ndarray:
        mixed = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NO_RANK where it is no piece."""
        key = left.astype(np.int64) << 32 | right
        slot = self._slots(key)
        at = self.slot[slot]
        more = np.flatnonzero(self.crowded[slot])
        at[more] = np.minimum(np.searchsorted(self.keys, key[more]), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.rank[at], NO_RANK), self.merged[at]

    def count(self, sequences: list[str]) -> np.ndarray:
        """Tokens of each non-empty pre-token."""
        n = len(sequences)
        code = np.frombuffer("".join(sequences).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, sequences), np.int64, n)
        seq = np.repeat(np.arange(n), lengths)
        at = np.minimum(np.searchsorted(self.chars, code), len(self.chars) - 1)
        sym = np.where(self.chars[at] == code, self.char_symbol[at], self.unknown).astype(np.int32)
        n_bytes = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        cost = np.where(self.is_piece[sym], 1, n_bytes)
        total = np.zeros(n, np.int64)
        rank = np.full(len(sym), NO_RANK, np.int32)
        into = np.zeros(len(sym), np.int32)
        inside = np.flatnonzero(seq[:-1] == seq[1:])
        rank[inside], into[inside] = self.pairs(sym[inside], sym[inside + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            size = np.diff(np.append(first, len(seq)))
            best = np.minimum.reduceat(rank, first)
            done = best == NO_RANK
            if done.any():
                ended = np.repeat(done, size)
                total += np.bincount(seq[ended], cost[ended], n).astype(np.int64)
                keep = ~ended
                sym, seq, cost, rank, into = (x[keep] for x in (sym, seq, cost, rank, into))
                continue
            hit = np.flatnonzero(rank == np.repeat(best, size))
            hit = self._safe(hit, sym, seq, rank, into)
            sym[hit] = into[hit]
            cost[hit] = 1
            gone = np.zeros(len(sym), bool)
            gone[hit + 1] = True
            moved = np.cumsum(~gone) - 1
            sym, seq, cost, rank, into = (x[~gone] for x in (sym, seq, cost, rank, into))
            hit = moved[hit]
            new = np.concatenate([hit, hit - 1])
            new = new[(new >= 0) & (new < len(sym) - 1)]
            same = seq[new] == seq[new + 1]
            rank[hit] = NO_RANK
            new = new[same]
            rank[new], into[new] = self.pairs(sym[new], sym[new + 1])
        return total

    def _safe(self, hit, sym, seq, rank, into) -> np.ndarray:
        """Of the equal lowest pairs those that may merge at once.

        Overlapping ones give way to the one on their left. Where a merge would make a pair of no
        higher rank than its own, that sequence merges its leftmost pair only, as one by one.
        """
        run = np.concatenate([[True], np.diff(hit) != 1])
        start = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - start) % 2 == 0]
        made, mine, last = into[hit], rank[hit], len(sym) - 1
        follows = np.concatenate([[False], (np.diff(hit) == 2) & (np.diff(seq[hit]) == 0)])
        left, right = np.maximum(hit - 1, 0), np.minimum(hit + 2, last)
        has_left = (hit > 0) & (seq[left] == seq[hit])
        has_right = (hit + 2 <= last) & (seq[right] == seq[hit])
        low = has_left & (self.pairs(sym[left], made)[0] <= mine)
        low |= has_right & (self.pairs(made, sym[right])[0] <= mine)
        low |= follows & (self.pairs(made, made)[0] <= mine)
        if not low.any():
            return hit
        first = np.concatenate([[True], seq[hit][1:] != seq[hit][:-1]])
        return hit[first | ~np.isin(seq[hit], seq[hit][low])]

    def text_counts(self, texts: list[str]) -> list[int]:
        split, known = self.split, self.known
        words = [split("▁" + t.replace(" ", "▁")) if t else [] for t in texts]
        new = list({w for ws in words for w in ws} - known.keys())
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list({w for ws in words for w in ws})
        if new:
            known.update(zip(new, self.count(new).tolist(), strict=True))
        of = known.__getitem__
        return [sum(map(of, ws)) for ws in words]


@functools.cache
def merger(path: str) -> PieceMerger:
    return PieceMerger(path)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """Bytes and tokens of every text: doc_id, n_bytes, n_tokens, over_limit.

    A null or empty text has none. Repeated rows are counted each, a null doc_id stays null, and
    other columns of ``docs`` take no part. A map over the rows: no shuffle, memory bounded by
    a batch of texts, or one long text, and the remembered pre-tokens.
    """

    def counted(batches):
        model = merger(model_path)
        for batch in batches_of(batches):
            texts = batch.column("text")
            tokens = np.array(model.text_counts([t or "" for t in texts.to_pylist()]), np.int64)
            size = [len(t) if t else 0 for t in texts.cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(tokens),
                 pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
