"""Token ids of byte-level BPE tokenizer files, as the tokenizers library gives them.

The library's own pre-tokens are independent of each other, so each is encoded by the library once
per worker and remembered. They are split for a whole batch at once, in arrays: each distinct one of
the batch is looked up, and ids are gathered by its number. Texts with special strings, or
characters beyond the pattern below, go through the library whole. Pre-tokens are told apart by 64
bits of a hash within a batch, and by 128 beyond it.
"""

from __future__ import annotations

import functools
import json
import os
import re
import sys

import numpy as np

# The pre-token pattern of byte-level tokenizer files, a fixed value, with letters and numbers
# spelled out up to U+024F.
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBER = "0-9²³¹¼½¾"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+|"
    rf" ?[^\s{LETTER}{NUMBER}]+|\s+(?!\S)|\s+"
)
# Pre-tokens, and ids of them, that a worker remembers before it starts anew. Bounds memory, not
# results.
REMEMBERED = 1 << 20
REMEMBERED_IDS = 1 << 23
# Characters of a text that are split at a time.
PART_CHARS = 1 << 21
SPACE, LETTERS, NUMBERS, OTHER, UNSURE = range(5)
_CUT = re.compile(r"[^ \t-\r](?=[ \t-\r])")
_STEP = 0x9E3779B97F4A7C15


def _classes() -> np.ndarray:
    """The class of each 16-bit code; unsure ones are left to the library."""
    out = np.full(1 << 16, UNSURE, np.uint8)
    sure = re.compile("[\x00-\x1b\x20-\x84\x86-\x9f\xa1-ɏ]")
    kinds = ((LETTERS, LETTER), (NUMBERS, NUMBER), (SPACE, " \t-\r"))
    kinds = [(kind, re.compile(f"[{chars}]")) for kind, chars in kinds]
    for code in range(0x250):
        if sure.match(chr(code)):
            out[code] = next((k for k, known in kinds if known.match(chr(code))), OTHER)
    return out


CLASS = _classes()
_VALUE = np.random.default_rng(20250301).integers(0, 2**64, (2, 0x250), np.uint64)


def pre_tokens(codes: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pre-tokens start, as the pattern finds them; ``first`` marks starts of texts.

    A run of letters, of numbers or of others takes one space ahead of it along. Of white space
    ahead of a run the last character stands apart. An apostrophe alone that no space precedes
    takes the letters of a contraction.
    """
    new = first.copy()
    new[1:] |= kinds[1:] != kinds[:-1]
    word = kinds != SPACE
    spaced = np.zeros(len(codes), bool)
    spaced[1:] = codes[:-1] == 32
    spaced &= ~first
    start = new & ~(word & spaced)
    start[:-1] |= ~word[:-1] & word[1:] & ~first[1:]
    quote = np.flatnonzero((codes[:-1] == 39) & start[:-1] & new[:-1])
    quote = quote[(kinds[quote + 1] == LETTERS) & ~first[quote + 1]]
    one = codes[quote + 1]
    after = np.minimum(quote + 2, len(codes) - 1)
    two = np.where((quote + 2 < len(codes)) & ~first[after], codes[after], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
    long = np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])
    for taken, length in ((quote[short], 2), (quote[long], 3)):
        start[taken + 1] = False
        stop = taken + length
        stop = stop[stop < len(codes)]
        # What is left of the run of letters stands alone.
        start[stop[(kinds[stop] == LETTERS) & ~first[stop]]] = True
    return np.flatnonzero(start)


def byte_alphabet() -> dict[int, str]:
    """The letter that stands for each byte: itself if it prints, else the next from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class ByteTokens:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if sys.byteorder != "little":
            raise RuntimeError("codes and ids are kept as little-endian integers")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        step = spec.get("pre_tokenizer") or {}
        plain = (
            spec.get("normalizer") is None
            and step.get("type") == "ByteLevel"
            and step.get("use_regex", True)
            and not step.get("add_prefix_space")
        )
        self.plain = plain
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.letters = byte_alphabet()
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.power = self.inverse = np.ones(1, np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.marks = np.zeros((0, 2), np.uint64)  # of the known pre-tokens, sorted by the first
        self.number = np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u2" if self.width == 2 else "<u4")
        self.edge = np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Append the ids of pre-tokens that are not known."""
        tokenize, ids, sizes = self.library.model.tokenize, [], []
        # U+001C is in no pre-token that is split here.
        joined = "\x1c".join(words).encode().decode("latin-1").translate(self.letters)
        for spelled in joined.split(self.letters[0x1C]):
            got = [t.id for t in tokenize(spelled)]
            ids += got
            sizes.append(len(got))
        self.ids = np.concatenate([self.ids, np.array(ids, self.ids.dtype)])
        self.edge = np.concatenate([self.edge, self.edge[-1] + np.cumsum(sizes, dtype=np.int64)])

    def _numbers(self, marks: np.ndarray, words) -> np.ndarray:
        """The number of each pre-token, given by 128-bit marks that ascend; unknown ones are learned."""
        at = np.searchsorted(self.marks[:, 0], marks[:, 0])
        here = np.minimum(at, len(self.marks) - 1)
        known = np.zeros(len(marks), bool)
        out = np.zeros(len(marks), np.int64)
        if len(self.marks):
            known = (self.marks[here] == marks).all(axis=1)
            out[known] = self.number[here[known]]
        new = np.flatnonzero(~known)
        if len(new):
            out[new] = np.arange(len(new)) + len(self.edge) - 1
            self._learn(words(new))
            # Of pre-tokens with the same first half one is remembered; the others are learned again.
            taken = (self.marks[here[new], 0] == marks[new, 0]) if len(self.marks) else new < 0
            kept = new[~taken]
            self.marks = np.insert(self.marks, at[kept], marks[kept], axis=0)
            self.number = np.insert(self.number, at[kept], out[kept])
        return out

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            inverse = pow(_STEP, -1, 1 << 64)
            for name, step in (("power", _STEP), ("inverse", inverse)):
                out = np.full(n, step, np.uint64)
                out[0] = 1
                setattr(self, name, np.cumprod(out, dtype=np.uint64))

    def _marks(self, codes, start, stop) -> np.ndarray:
        """128 bits of each pre-token: two rolling hashes."""
        self._powers(len(codes))
        out = np.empty((len(start), 2), np.uint64)
        total = np.zeros(len(codes) + 1, np.uint64)
        length = (stop - start).astype(np.uint64)
        for half in range(2):
            np.cumsum(_VALUE[half][codes] * self.power[: len(codes)], out=total[1:])
            mark = (total[stop] - total[start]) * self.inverse[start]
            out[:, half] = (mark ^ mark >> np.uint64(29)) * np.uint64(_STEP) + length
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        out: list[list[bytes]] = [[] for _ in texts]
        whole, parts = [], []
        for i, text in enumerate(texts):
            if text and (not self.plain or any(x in text for x in self.special)):
                whole.append(i)
            elif text:
                parts.append((i, text.encode("utf-16-le", "surrogatepass")))
        if parts:
            whole += self._encode_parts(texts, parts, out)
        if whole:
            got = self.library.encode_batch([texts[i] for i in whole], add_special_tokens=False)
            for i, x in zip(whole, got, strict=True):
                out[i] = [np.array(x.ids, "<u4").tobytes()]
        return [b"".join(x) for x in out]

    def _encode_parts(self, texts, parts, out) -> list[int]:
        """Fill in the ids of the texts that need no library; the numbers of the others."""
        unsure = [i for i, x in parts if CLASS[np.frombuffer(x, "<u2")].max() == UNSURE]
        left = set(unsure)
        group, size = [], 0
        for i, encoded in parts:
            if i in left:
                continue
            pieces = [encoded] if len(encoded) <= 2 * PART_CHARS else [
                p.encode("utf-16-le") for p in cut(texts[i])
            ]
            for piece in pieces:
                if size and size + len(piece) > 2 * PART_CHARS:
                    self._encode_group(group, out)
                    group, size = [], 0
                group.append((i, piece))
                size += len(piece)
        if group:
            self._encode_group(group, out)
        return unsure

    def _encode_group(self, group: list[tuple[int, bytes]], out: list[list[bytes]]) -> None:
        codes = np.frombuffer(b"".join(x for _, x in group), "<u2")
        edges = np.concatenate([[0], np.cumsum([len(x) // 2 for _, x in group])])
        first = np.zeros(len(codes), bool)
        first[edges[:-1]] = True
        start = pre_tokens(codes, CLASS[codes], first)
        stop = np.append(start[1:], len(codes))
        marks = self._marks(codes, start, stop)
        _, example, which = np.unique(marks[:, 0], return_index=True, return_inverse=True)

        def words(chosen: np.ndarray) -> list[str]:
            text = codes.tobytes().decode("utf-16-le")
            cuts = zip(start[example[chosen]].tolist(), stop[example[chosen]].tolist(), strict=True)
            return [text[a:b] for a, b in cuts]

        if len(self.marks) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self._forget()
        number = self._numbers(marks[example], words)
        begin, count = self.edge[number], np.diff(self.edge)[number]
        count = count[which]
        ahead = np.concatenate([[0], np.cumsum(count)])
        shift = begin[which] - ahead[:-1]
        flat = self.ids[np.arange(ahead[-1]) + np.repeat(shift, count)].astype("<u4")
        places = ahead[np.searchsorted(start, edges)].tolist()
        for (i, _), a, b in zip(group, places, places[1:], strict=False):
            out[i].append(flat[a:b].tobytes())


def cut(text: str) -> list[str]:
    """Parts of about PART_CHARS of a text, cut ahead of white space, where pre-tokens end."""
    out, at = [], 0
    while len(text) - at > PART_CHARS:
        found = _CUT.search(text, at + PART_CHARS)
        if found is None:
            break
        out.append(text[at : found.end()])
        at = found.end()
    return [*out, text[at:]]


@functools.cache
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)
