"""Fingerprints and their links against brute force over all pairs."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from llm_rows import make, prose
from pyspark.sql import functions as F

from signalmill.llm import simhash_dedup
from signalmill.llm.simhash_dedup import (
    fingerprint,
    list_links,
    near_links,
    position_sets,
    shared_bytes,
    simhash_dedup as dedup,
)


def plain(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    width = min(width, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42)
        for i in range(len(words) - width + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def joined(numbers, near):
    """The least number that each reaches over pairs that are near."""
    root = {x: x for x in numbers}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(root), 2):
        if near(a, b):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def close(a, b):
    return (a ^ b).bit_count() <= 4


def test_simhash_dedup(docs, doc_rows):
    want = [(r[0], plain(r[1])) for r in doc_rows]
    root = joined({f for _, f in want}, close)
    least = {}
    for i, f in want:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted(((i, f"{f:016x}", least.get(root[f])) for i, f in want), key=repr)
    found = dedup(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == want
    copies = [r for r in want if r[0] is not None and 300 <= r[0] < 305]
    assert {r[2] for r in copies} == {3}
    assert {r[1:] for r in want if r[0] in (400, 401, 402)} == {("0" * 16, 400)}


def test_simhash_of_nothing_and_without_ids(spark, no_docs):
    assert dedup(no_docs).collect() == []
    found = dedup(make(spark, [(None, "a b c d e", None, None, None)] * 2)).collect()
    assert [(r["doc_id"], r["component_id"]) for r in found] == [(None, None)] * 2


def test_long_texts_are_read_in_chunks(monkeypatch):
    text = prose(random.Random(3), "fr", 3000)
    whole = fingerprint(text.encode())
    monkeypatch.setattr(simhash_dedup, "CHUNK", 7)
    assert fingerprint(text.encode()) == whole == plain(text)


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_any_four_positions_hold_a_set(size):
    sets = position_sets(size)
    assert all(len(set(s)) == size for s in sets) and len(set(map(frozenset, sets))) == len(sets)
    for four in itertools.combinations(range(8), 4):
        assert any(set(s) <= set(four) for s in sets)


def test_shared_bytes():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**64, 500, np.uint64) & rng.choice(
        np.array([0xFF00FF01FF8000FF, 0x7F, 0, 2**64 - 1], np.uint64), 500
    )
    want = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    assert shared_bytes(x).tolist() == want.tolist()


def chains(seed=2):
    """Fingerprints at random, chains of ones a few bits apart, and some just too far."""
    rng = random.Random(seed)
    out = {0, 2**64 - 1, 2**63}
    for _ in range(150):
        x = rng.getrandbits(64)
        out.add(x)
        for _ in range(rng.choice([0, 0, 1, 6])):
            for bit in rng.sample(range(64), rng.choice([1, 3, 4, 4, 5, 6])):
                x ^= 1 << bit
            out.add(x)
    # A group of near copies: lists that many share.
    hub = rng.getrandbits(64)
    out |= {hub ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(200)}
    return sorted(out)


@pytest.mark.parametrize("members, part", [(64, 4096), (0.001, 20), (1e-6, 50), (1e-9, 7)])
def test_links_join_what_is_near(spark, monkeypatch, members, part):
    monkeypatch.setattr(simhash_dedup, "LIST_MEMBERS", members)
    monkeypatch.setattr(simhash_dedup, "PART_MEMBERS", part)
    numbers = chains()
    signed = [x - (x >> 63 << 64) for x in numbers]
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = {(r["a"] % 2**64, r["b"] % 2**64) for r in near_links(fps).collect()}
    assert all(close(a, b) for a, b in links)
    assert joined(numbers, lambda a, b: (a, b) in links or (b, a) in links) == joined(numbers, close)


def test_a_list_gives_fewer_links_than_members():
    fps = np.arange(32, dtype=np.int64)
    lists = np.repeat([3, 9], 16)
    links = list_links(lists, fps)
    assert len(links) == 30 and all((a < 16) == (b < 16) for a, b in links)


def test_other_columns_take_no_part(spark):
    df = make(spark, [(1, "one two three four five", "en", "s", 1)]).withColumn("fp", F.lit("x"))
    assert dedup(df).first()["fingerprint"] == f"{plain('one two three four five'):016x}"
