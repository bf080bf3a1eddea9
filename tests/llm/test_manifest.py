"""The Merkle manifest against trees built plainly in one place."""

import hashlib
import itertools
import zlib

import pytest
from llm_rows import SCHEMA, make
from pyspark.sql import functions as F

from signalmill.llm import merkle
from signalmill.llm.merkle import levels_above, merkle_manifest, paths, place, segment, steps


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, text, lang, source, n_chars = row
    n_chars = None if n_chars is None else n_chars + more
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*pair) for pair in itertools.batched(out[-1], 2)])
    return out


def way_up(tree, i):
    for level in tree[:-1]:
        other = i ^ 1
        yield ("left" if other < i else "right", level[other]) if other < len(level) else (None, "")
        i >>= 1


def brute(rows, changed):
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = levels([leaf_of(r) for r in langs[lang]])
    top = levels([trees[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for i, row in enumerate(langs[lang]):
            way = [*way_up(trees[lang], i), *way_up(top, k)]
            node = leaf_of(row, 1) if changed(row) else leaf_of(row)
            for side, digest in way:
                node = h(digest, node) if side == "left" else h(node, digest)
            out.append((row[0], lang, leaf_of(row), trees[lang][-1][0], top[-1][0],
                        h(*(d for _, d in way)), node, node == top[-1][0]))
    return sorted(out, key=repr)


def seven(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0


def forged():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


COLUMNS = ["doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("block_levels", [2, 12])
def test_manifest(docs, doc_rows, monkeypatch, block_levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    # Every other row has a length, so that a forged one can differ.
    numbered = F.when(F.col("doc_id") % 2 == 0, F.length("text")).cast("long")
    rows = [(*r[:4], None if r[0] is None or r[0] % 2 or r[1] is None else len(r[1])) for r in doc_rows]
    found = merkle_manifest(docs.withColumn("n_chars", numbered), forged()).select(*COLUMNS)
    want = brute(rows, seven)
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert {r[-1] for r in want} == {True, False}


def test_manifest_of_nothing_and_of_one(spark, no_docs):
    assert merkle_manifest(no_docs).collect() == []
    row = (7, "a text", None, "s", 6)
    found = merkle_manifest(make(spark, [row]), forged()).first()
    assert found["leaf"] == found["subroot"] == found["root"] == leaf_of(row)
    assert found["proof_sha256"] == h() and bytes(found["proof"]) == b"" and found["lang"] is None


def test_a_third_of_all_rows_alike(spark):
    rows = [(1, "the same", "en", "s", None)] * 40 + [(i, f"text {i}", "en", "s", i) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = merkle_manifest(df, forged()).select(*COLUMNS)
    got, want = sorted(map(tuple, found.collect()), key=repr), brute(rows, seven)
    # Rows that are alike in all have places of their own.
    assert got == want and len({r[5] for r in got}) > 10


@pytest.mark.parametrize("leaves", [1, 2, 3, 5, 8, 13, 64, 100])
def test_places_follow_from_sizes(leaves):
    tree = levels([h(str(i)) for i in range(leaves)])
    log = segment(tree[0], levels_above(leaves))
    assert len(log) == sum(map(len, tree))
    for level, nodes in enumerate(tree):
        assert [log[place(level, i, leaves)] for i in range(len(nodes))] == nodes
    children = {}
    for at, node in enumerate(log):
        children[node] = at
    for level in range(1, len(tree)):
        for i, node in enumerate(tree[level]):
            assert children[tree[level - 1][2 * i]] < children[node]
    nodes = bytes.fromhex("".join(log))
    for i, path in enumerate(paths(nodes, leaves, levels_above(leaves))):
        assert [d for _, d in steps(path)] == [d for _, d in way_up(tree, i)]
