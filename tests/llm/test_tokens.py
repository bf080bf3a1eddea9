"""Token counts, token files and packing against the tokenizer libraries."""

import random
import zlib

import numpy as np
import pytest

from signalmill.llm import byte_tokens, packing, token_files
from signalmill.llm.byte_tokens import ByteTokens
from signalmill.llm.common import tokenizer_path
from signalmill.llm.token_counts import PieceMerger, token_counts

PARTS = ["abab", " ", "  ", "\n", "the", "ing", "é", "日本", "▁", "<|endoftext|>", "<s>", "<unk>",
         "<0x0A>", "\t", "😀", "aaa", "0", "00", "-", "==", "'s", "’", "\x00", "\x1c", "\xa0", "\x85",
         "²", "ß", "I'll", "...", "\r\n", "Ａ", "ﷺ"]


def odd_texts(n=3000):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    long = ["a" * 3000, "ab" * 2000, "=" * 4001, "日" * 500, " " * 300, "aehil" * 700]
    return [*texts, *long, "", None]


def test_piece_counts_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t or "" for t in odd_texts()]
    assert PieceMerger(path).text_counts(texts) == [len(x) for x in library.encode(texts)]


def test_equal_lowest_pairs_merge_as_one_by_one():
    merger = PieceMerger(tokenizer_path("piece_bpe_32k.model"))
    texts = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 40)]
    together = merger.count(texts).tolist()
    assert together == [int(merger.count([t])[0]) for t in texts]


def test_token_counts(spark, docs, doc_rows, no_docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted(map(repr, map(tuple, token_counts(docs, path, limit=100).collect())))
    want = []
    for doc_id, text, *_ in doc_rows:
        n = len(library.encode(text or ""))
        want.append(repr((doc_id, len((text or "").encode()), n, n > 100)))
    assert got == sorted(want)
    assert token_counts(no_docs, path).collect() == []


def test_byte_ids_equal_the_library(bpe):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe)
    texts = odd_texts()
    want = [np.array(x.ids, "<u4").tobytes()
            for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert ByteTokens(bpe).encode(texts) == want


@pytest.mark.parametrize("part_chars", [1 << 21, 9])
def test_pre_tokens_at_random(bpe, monkeypatch, part_chars):
    """Blanks, apostrophes and classes in any order; parts, and a worker that forgets."""
    monkeypatch.setattr(byte_tokens, "PART_CHARS", part_chars)
    monkeypatch.setattr(byte_tokens, "REMEMBERED", 500)
    rng = random.Random(4)
    alphabet = [*"ab s'tlvedrm'  \n\t\r12.,!-é ßñ²\x0b\x00\x1b'", "'ll", "'s ", "  ", " '", "\n\n"]
    alphabet += ["don't", "we've", "<|endoftext|>", "\xa0", "\x1c", "日", "😀"] * (part_chars > 9)
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(4000)]
    model = ByteTokens(bpe)
    want = [np.array(x.ids, "<u4").tobytes()
            for x in model.library.encode_batch(texts, add_special_tokens=False)]
    got = [x for a in range(0, len(texts), 300) for x in model.encode(texts[a : a + 300])]
    assert got == want


def test_other_tokenizer_files_go_through_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    text = "Some Words, and more"
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ByteTokens(path).encode([text])[0], "<u4").tolist() == want


@pytest.mark.parametrize("vocabulary, sizes", [
    (5, [1, 2, 63, 64, 65, 40000, 70000]), (50257, [100, 3]), (1, [500]), (300, [32768, 32769])
])
def test_blocks_decode_to_the_same_ids(vocabulary, sizes):
    rng = np.random.default_rng(1)
    sizes = np.array(sizes)
    part = rng.dirichlet(np.full(vocabulary, 0.3))
    ids = rng.choice(vocabulary, size=sizes.sum(), p=part).astype(np.uint32)
    found, counts = np.unique(ids, return_counts=True)
    freq = token_files.quantized(found.astype(np.int64), counts)
    table = token_files.Frequencies(freq, token_files.frequency_bits(len(freq)))
    assert freq.sum() == 1 << table.bits and (freq[found] > 0).all()
    coded = token_files.encode_blocks(ids, sizes, table)
    assert (token_files.decode_blocks(sizes, coded, table) == ids).all()
    # Blocks and segments are independent: each block decodes alone.
    for b, (a, n) in enumerate(zip(np.cumsum(sizes) - sizes, sizes, strict=True)):
        assert (token_files.decode_blocks(sizes[b : b + 1], coded[b : b + 1], table) == ids[a : a + n]).all()
    entropy = -(counts / sizes.sum() * np.log2(counts / sizes.sum())).sum()
    assert sum(len(c[2]) for c in coded) * 8 <= 1.02 * entropy * sizes.sum() + 64


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_token_files(spark, docs, doc_rows, no_docs, bpe, folder):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe)
    token_files.write_token_files(docs, f"{folder}/a", bpe)
    got = token_files.read_token_files(spark, f"{folder}/a")
    rows = sorted(got.collect(), key=lambda r: r["start"])
    want = [(i, ids_of(library, t)) for i, t, *_ in doc_rows]
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in want), key=lambda i: -1 if i is None else i)
    assert [r["start"] for r in rows] == np.cumsum([0, *(len(r["ids"]) // 4 for r in rows)])[:-1].tolist()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], bytes(r["ids"])) for r in rows) == sorted(
        (-1 if i is None else i, ids.tobytes()) for i, ids in want
    )
    digest = token_files.token_digest(got).where("doc_id = 406").first()
    ids = next(ids for i, ids in want if i == 406)
    assert (digest["n_tokens"], digest["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
    token_files.write_token_files(no_docs, f"{folder}/b", bpe)
    assert token_files.read_token_files(spark, f"{folder}/b").collect() == []


def test_damaged_blocks_are_noticed(spark, docs, bpe, folder):
    token_files.write_token_files(docs, f"{folder}/a", bpe)
    blocks = spark.read.parquet(f"{folder}/a/blocks")
    spark.read.parquet(f"{folder}/a/frequencies").write.parquet(f"{folder}/b/frequencies")
    blocks.selectExpr("*").withColumn("checksum", blocks["checksum"] + 1).write.parquet(f"{folder}/b/blocks")
    with pytest.raises(Exception, match="wrong checksum"):
        token_files.read_token_files(spark, f"{folder}/b").collect()


def least_sequences(items, capacity):
    items = sorted(items, reverse=True)
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for used in sorted(set(rooms)):
            if used + items[i] <= capacity:
                k = rooms.index(used)
                place(i + 1, rooms[:k] + [used + items[i]] + rooms[k + 1 :])
        place(i + 1, [*rooms, items[i]])

    place(0, [])
    return best


def sequences(plan):
    content = {}
    for length, a, b, each, sequence, offset in plan:
        for r in range(b - a):
            place = (offset + r % each * length, length)
            content.setdefault(sequence + r // each, []).append(place)
    return content


def check_plan(counts, capacity):
    content = sequences(packing.packing_plan(counts, capacity))
    placed = {}
    for items in content.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
            placed[length] = placed.get(length, 0) + 1
        assert at <= capacity
    assert placed == {k: n for k, n in counts.items() if n}
    return len(content)


def test_plans_against_all_packings():
    rng = random.Random(3)
    optimal = 0
    for _ in range(200):
        capacity = rng.randint(5, 30)
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 8))]
        n = check_plan({x: items.count(x) for x in items}, capacity)
        best = least_sequences(items, capacity)
        assert n <= best + 1
        optimal += n == best
    assert optimal >= 198


def test_dominating_sets_keep_the_optimum():
    rng = random.Random(8)
    for _ in range(200):
        capacity = rng.randint(5, 25)
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        counts = {x: items.count(x) for x in items}
        fixed = packing.dominating_sets(counts, capacity)
        rest = [x for x, n in counts.items() for _ in range(n)]
        total = sum(n for _, n in fixed) + (least_sequences(rest, capacity) if rest else 0)
        assert total == least_sequences(items, capacity)


def test_dominating_sets_of_three():
    # Beside 10 of 20 no three pieces fit, and 6 and 4 take the places of any two that do.
    assert packing.dominating_set(np.bincount([10, 6, 4, 4, 9, 9, 9], minlength=21), 10) is None
    assert packing.dominating_set(np.bincount([10, 6, 3, 4, 11], minlength=21), 10) == (10, 6, 4)
    # A piece as long as any two others that fit.
    assert packing.dominating_set(np.bincount([10, 8, 4, 4], minlength=20), 10) == (10, 8)


def test_packed(docs, doc_rows, no_docs, bpe):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe)
    rows = packing.packed(docs, bpe, capacity=64).toPandas()
    pieces = []
    for doc_id, text, *_ in doc_rows:
        ids = ids_of(library, text)
        first = (len(ids) - 1) % 64 + 1
        for piece, a in enumerate([0, *range(first, len(ids), 64)]):
            part = ids[a : first if not piece else a + 64]
            pieces.append((-1 if doc_id is None else doc_id, piece, a, len(part), zlib.crc32(part.tobytes())))
    got = rows[["doc_id", "piece", "start", "length", "ids_crc32"]].fillna(-1).astype("int64")
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(pieces)
    total = 0
    for _, items in rows.sort_values("offset").groupby("sequence_id"):
        assert items["offset"].tolist() == np.cumsum([0, *items["length"]])[:-1].tolist()
        assert items["length"].sum() <= 64
        total += 1
    assert total <= -(-sum(p[3] for p in pieces) // 64) * 1.03 + 1
    assert packing.packed(no_docs, bpe).collect() == []


def test_hot_lengths_are_ranked_in_parts(spark, docs, bpe, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 3)
    rows = packing.packed(docs, bpe, capacity=64).toPandas()
    assert not rows.duplicated(["sequence_id", "offset"]).any()
    for _, items in rows.sort_values("offset").groupby("sequence_id"):
        assert items["offset"].tolist() == np.cumsum([0, *items["length"]])[:-1].tolist()
