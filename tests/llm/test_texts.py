"""Near-duplicates, language ID, mixing, scoring and the pipeline against brute force."""

import collections
import math
import random
import re
import time
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from llm_rows import document_rows, make, prose

import corpus_pipeline
from signalmill.llm import context_mixing, language_id, ngram_join, source_mix
from signalmill.llm.components import components
from signalmill.llm.oracles import SOURCE_MIX

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width=5):
    words = words_of(text)
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = label[a], label[b]
                label = [x if z == y else z for z in label]
    least = {}
    for r, x in zip(rows, label, strict=True):
        if r[0] is not None:
            least[x] = min(least.get(x, r[0]), r[0])
    return [(r[0], len(s), least.get(x) if s else r[0]) for r, s, x in zip(rows, sets, label, strict=True)]


def near_rows(seed):
    """Chains and groups of near copies at about the threshold, and a passage that all share."""
    rng = random.Random(seed)
    rows = []
    passage = [f"shared{i}" for i in range(30)]
    for g in range(6):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(20, 150))]
        for _ in range(8):
            words = list(words)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"w{rng.randint(0, 400)}"
            rows.append((len(rows), " ".join(words + passage * (g % 2)), "en", "s", None))
    return rows


@pytest.mark.parametrize("bounds", [(1 << 20, 4096), (300, 3)])
@pytest.mark.parametrize("rows", [document_rows(), near_rows(2), near_rows(3)])
def test_ngram_join(spark, rows, bounds, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", bounds[0])
    monkeypatch.setattr(ngram_join, "NEAR_MEMBERS", bounds[1])
    got = ngram_join.ngram_join(make(spark, rows)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute_components(rows)))


def test_ngram_join_of_nothing(no_docs):
    assert ngram_join.ngram_join(no_docs).collect() == []


def test_parities_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a = rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64)
        b = a.copy()
        change = rng.random(len(b)) < 0.12
        b[change] = rng.integers(0, 2**63, change.sum()).astype(np.uint64)
        b = b[: max(1, int(len(b) * rng.uniform(0.8, 1)))]
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            x, y = ngram_join.parity(a), ngram_join.parity(b)
            n = min(len(x), len(y))
            assert ngram_join.may_link(
                ngram_join.folded(x, n), ngram_join.folded(y, n), len(a), len(b), 80
            )


def test_divide_skip_finds_every_component():
    rng = np.random.default_rng(5)
    for _ in range(60):
        base = rng.integers(0, 60, 30)
        sets = []
        for _ in range(rng.integers(2, 25)):
            keep = base[rng.random(30) < rng.uniform(0.6, 1)]
            sets.append(np.unique(np.append(keep, rng.integers(0, 60, rng.integers(1, 5)))).astype(np.uint64))
        label = list(range(len(sets)))
        found = list(range(len(sets)))
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    label = [label[a] if z == label[b] else z for z in label]
        for a, b in ngram_join.divide_skip(sets, 80, np.ones(len(sets), bool)):
            found = [found[a] if z == found[b] else z for z in found]
        same = lambda x: [[i == j for j in x] for i in x]
        assert same(found) == same(label)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (130, 129)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 131), 100)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group(spark):
    rows = document_rows()
    got = ngram_join.one_of_each_group(make(spark, rows))
    assert got.columns == make(spark, rows).columns
    want = []
    for row, (doc_id, _, component) in zip(rows, brute_components(rows), strict=True):
        if doc_id == component and (doc_id, row[1]) not in want:
            want.append((doc_id, row[1]))
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in got.collect()))) == sorted(map(repr, want))


def test_near_copies_without_id(spark):
    words = [f"w{i}" for i in range(100)]
    bridge = [*words[:97], "x", "y", "z"]
    far = ["a", "b", "c", "d", *bridge[4:]]
    alone = [f"v{i}" for i in range(60)]
    texts = [(1, words), (None, bridge), (2, far), (None, alone), (None, alone), (None, [*alone[:59], "u"])]
    rows = [(i, " ".join(t), "en", "s", None) for i, t in texts] + [(None, "", "en", "s", None)]
    sets = [shingles(r[1]) for r in rows[:3]]
    assert 100 * len(sets[0] & sets[2]) < 88 * len(sets[0] | sets[2])
    docs = make(spark, rows)
    got = ngram_join.ngram_join(docs, percent=88).select("doc_id", "component_id").collect()
    named = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert named == {1: 1, 2: 1}
    kept = [(r["doc_id"], r["text"]) for r in ngram_join.one_of_each_group(docs, percent=88).collect()]
    assert len(kept) == 3 and (1, rows[0][1]) in kept and (None, "") in kept
    assert sum(text.startswith("v0 ") for _, text in kept) == 1


def test_language_id(spark, docs, doc_rows, no_docs):
    rows = {r["doc_id"]: r for r in language_id.language_id(docs).collect()}
    assert len(language_id.language_id(docs).collect()) == len(doc_rows)
    for doc_id in (400, 401, 402, 403, 408):
        assert (rows[doc_id]["lang_pred"], rows[doc_id]["score"]) == ("und", 0.0)
    assert rows[404]["lang_pred"] in ("de", "en", "fr")
    held = [(rows[i]["lang_pred"], lang) for i, text, lang, *_ in doc_rows
            if i is not None and i < 60 and len(text.split()) > 8 and zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all(a == b for a, b in held)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
               for i, r in rows.items() if i is not None)
    assert language_id.language_id(no_docs).collect() == []
    unlabelled = language_id.language_id(docs.withColumn("lang", docs["lang"].substr(9, 1)).where("false"))
    assert unlabelled.collect() == []
    kept = language_id.documents_with_language(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["lang_pred"] != "und" for r in language_id.language_id(docs).collect())


def test_mixed_texts_show_both_languages(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, lang, 80), lang, "s", None) for i, lang in enumerate(["en", "de", "fr"] * 15)]
    both = prose(rng, "en", 120) + " " + prose(rng, "fr", 60)
    model = language_id.learn_languages(make(spark, rows))
    (langs,) = language_id.language_sets(pa.array([both]), model)
    assert [x for x, _ in langs] == ["en", "fr"] and abs(langs[0][1] - 2 / 3) < 0.1
    (one,) = language_id.language_sets(pa.array([prose(rng, "de", 100)]), model)
    assert [x for x, _ in one] == ["de"]


def test_one_very_long_word_does_not_undo_a_text(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, lang, 80), lang, "s", None) for i, lang in enumerate(["en", "de", "fr"] * 15)]
    model = language_id.learn_languages(make(spark, rows))
    run = "".join(rng.choice(["wasser", "nicht", "fluss"]) for _ in range(6000))[:30000]
    words = prose(rng, "en", 400).split()
    text = " ".join([*words[:200], run, *words[200:]])
    (langs,) = language_id.language_sets(pa.array([text]), model)
    assert [x for x, _ in langs] == ["en"] and langs[0][1] == pytest.approx(1)


def water_filling(sizes, share=Fraction(3, 2)):
    """Targets by sharing again and again, as the words of the rule say."""
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target = dict.fromkeys(sizes, Fraction(0))
    left, open_ = share * sum(sizes.values()), set(sizes)
    while left and open_:
        total = sum(weight[s] for s in open_)
        target = {s: target[s] + (left * weight[s] / total if s in open_ else 0) for s in sizes}
        left = sum(max(0, target[s] - 2 * sizes[s]) for s in sizes)
        target = {s: min(target[s], 2 * sizes[s]) for s in sizes}
        open_ = {s for s in open_ if target[s] < 2 * sizes[s]}
    return target


def check_mix(rows, got, block):
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    sizes = collections.Counter()
    for r, n in zip(rows, size, strict=True):
        sizes[r[3]] += n
    target = water_filling(sizes)
    assert sorted((str(r[0]), n, sizes[r[3]]) for r, n in zip(rows, size, strict=True)) == sorted(
        (str(r["doc_id"]), r["size"], r["source_size"]) for r in got
    )
    source = {(str(r[0]), n): r[3] for r, n in zip(rows, size, strict=True)}
    taken = collections.Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        name = source[str(r["doc_id"]), r["size"]]
        taken[name] += r["taken"]
        assert r["target"] == pytest.approx(float(target[name]), rel=1e-12)
    return {s: (taken[s], float(target[s])) for s in sizes}


@pytest.mark.parametrize("shard_words", [1 << 19, 500])
def test_source_mix(spark, docs, doc_rows, shard_words):
    got = source_mix.source_mix(docs, shard_words=shard_words).collect()
    for taken, target in check_mix(doc_rows, got, source_mix.BLOCK).values():
        assert abs(taken - target) <= source_mix.BLOCK
    again = source_mix.source_mix(docs.repartition(3), shard_words=shard_words).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_source_mix_equals_its_sql(spark, docs, doc_rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", doc_rows)
    want = con.execute(SOURCE_MIX).fetchall()
    got = source_mix.source_mix(docs).select("doc_id", "size", "source_size", "target", "taken")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_rows_without_id_spread_over_shards(spark):
    rows = [(None, f"w{i} " * (20 + i % 7), "en", "s", None) for i in range(600)]
    whole = [r for r in source_mix.source_mix(make(spark, rows), block=4, shard_words=400).collect()]
    assert len(whole) == 600 and {r.doc_id for r in whole} == {None}
    # A shard is one run of words: with all rows in one shard, at most two would be taken in part.
    assert sum(r.first is not None and r.taken % r.size != 0 for r in whole) > 10
    again = source_mix.source_mix(make(spark, rows), block=4, shard_words=400).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, again))


def test_source_mix_of_nothing(spark, no_docs):
    assert source_mix.source_mix(no_docs).collect() == []
    blank = make(spark, [(1, None, "en", "a", 0), (2, "", "en", None, 0)])
    rows = source_mix.source_mix(blank).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 2


def test_sainte_lague_against_seat_by_seat(spark):
    rng = random.Random(6)
    parties, want = [], {}
    for g in range(8):
        votes = [rng.randint(0, 10 ** rng.randint(1, 4)) for _ in range(rng.randint(1, 12))]
        seats = rng.randint(0, 300) if sum(votes) else 0
        given = [0] * len(votes)
        for _ in range(seats):
            best = max(range(len(votes)), key=lambda i: (Fraction(votes[i], 2 * given[i] + 1), -i))
            given[best] += 1
        for i, v in enumerate(votes):
            parties.append((g, i, float(v), seats))
            want[g, i] = given[i]
    df = spark.createDataFrame(parties, "g long, party long, votes double, seats long")
    got = source_mix.sainte_lague(df, ["g"], "party").collect()
    assert {(r["g"], r["party"]): r["given"] for r in got} == want


def test_mixed_documents(spark, docs, doc_rows):
    mix = source_mix.source_mix(docs).collect()
    out = source_mix.mixed_documents(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    words = collections.Counter()
    for r in rows:
        assert r["n_chars"] == len(r["text"])
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    taken = collections.Counter()
    for r in mix:
        taken[r["doc_id"]] += r["taken"]
    assert +words == +taken


@pytest.mark.parametrize("head_words", [1 << 21, 20])
def test_base_scores(docs, doc_rows, head_words):
    got = context_mixing.context_mixing_scores(docs, context_mixing.training(), head_words).collect()
    learned = collections.Counter()
    for doc_id, text, *_ in doc_rows:
        if zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 != 1:
            learned.update([*words_of(text), None])
    total = sum(learned.values())
    bottom = math.log10(total + 0.5 * (len(learned) + 1))
    want = []
    for doc_id, text, *_ in doc_rows:
        tokens = [*words_of(text), None]
        base = sum(math.log10(learned[t] + 0.5) - bottom for t in tokens)
        want.append(repr((doc_id, len(tokens), sum(t in learned for t in tokens), total, round(base, 6))))
    rows = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got]
    assert sorted(map(repr, rows)) == sorted(want)
    assert all(r["score"] < 0 and (r["bits_per_byte"] is None or r["bits_per_byte"] > 0) for r in got)


def test_held_out_prose_scores_above_the_base(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, sorted(WORDS_BY)[i % 3], 150), "x", "s", None) for i in range(120)]
    got = context_mixing.context_mixing_scores(make(spark, rows), context_mixing.training()).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1]
    assert held and sum(r["score"] > r["base_score"] for r in held) >= 0.95 * len(held)


WORDS_BY = {"en", "de", "fr"}


def test_bits_are_probabilities():
    """Over all codes of a class the probabilities sum to one, whatever the context."""
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 2**63, 400).astype(np.uint64)
    texts = np.array([0, 400])
    counts = np.zeros(context_mixing.COUNTERS, np.int64)
    context_mixing.add_bit_counts(counts, tokens, np.ones(400, np.int64), texts)
    model = context_mixing.MixingModel.of(
        counts, np.ones(context_mixing.NODES), np.ones(context_mixing.NODES)
    )
    codes = np.arange(context_mixing.NODES, dtype=np.uint64) << np.uint64(64 - context_mixing.CODE_BITS)
    many = np.stack([np.full(len(codes), tokens[0]), codes], axis=1)
    flat, edge = many.ravel(), np.arange(0, 2 * len(codes) + 1, 2)
    both = model.code_logs(flat, np.ones(len(flat), np.int64), edge)
    first = model.code_logs(tokens[:1], np.ones(1, np.int64), np.array([0, 1]))
    assert (2.0 ** (both - first)).sum() == pytest.approx(1, abs=1e-3)


def plain_code_logs(model, tokens, length, texts):
    """As MixingModel.code_logs, each predictor looked up where its bit is mixed."""
    cm = context_mixing
    code, context = cm.codes_of(tokens), cm.contexts_of(tokens, length, texts)
    lanes = [
        (t, a, min(cm.SEGMENT, texts[t + 1] - a))
        for t in range(len(texts) - 1)
        for a in range(texts[t], texts[t + 1], cm.SEGMENT)
    ]
    lanes.sort(key=lambda x: -x[2])
    text, first, size = np.array(lanes).T
    weights = np.empty((len(lanes) * 16, cm.HASHED + 1), np.float32)
    weights[:] = cm.FIRST_WEIGHTS
    cells = np.linspace(-12, 12, cm.MAP_CELLS, dtype=np.float32)
    refined = np.tile(1 / (1 + np.exp(-cells)), len(lanes) * cm.CODE_BITS).astype(np.float32)
    total = np.zeros(len(lanes))
    for step in range(size[0]):
        m = np.searchsorted(-size, -step, side="left")
        at, lane = first[:m] + step, np.arange(m)
        node, likely = np.ones(m, np.uint32), np.ones(m, np.float32)
        for level in range(cm.CODE_BITS):
            bit = code[at] >> np.uint32(cm.CODE_BITS - 1 - level) & np.uint32(1)
            places = [node, *(cm.slots(one, node) for one in context[:, at])]
            value = np.stack([t[x] for t, x in zip(model.tables, places, strict=True)])
            gate = lane * 16 + (value[2] & 3) * 4 + (value[1] & 3)
            x = (value >> 2).astype(np.float32) * np.float32(1 / 16)
            w = weights[gate]
            dot = np.clip(np.einsum("mk,km->m", w, x), -11.9, 11.9)
            p = 1 / (1 + np.exp(-dot))
            weights[gate] = w + (cm.RATE * (bit - p).astype(np.float32) * x).T
            cell = (lane * cm.CODE_BITS + level) * cm.MAP_CELLS
            cell += np.rint((dot + 12) * ((cm.MAP_CELLS - 1) / 24)).astype(np.int64)
            map_p = refined[cell]
            refined[cell] = map_p + cm.MAP_RATE * (bit - map_p)
            p = np.clip(0.75 * p + 0.25 * map_p, 1e-5, 1 - 1e-5)
            likely *= np.where(bit == 1, p, 1 - p)
            node = node * 2 + bit
        total[:m] += np.log2(likely.astype(np.float64))
    return np.bincount(text, total, len(texts) - 1)


def some_tokens(rng, sizes, words=3000):
    """Tokens of texts with these sizes, and a model learned from them."""
    known = rng.integers(0, 2**63, words).astype(np.uint64) * np.uint64(2)
    which = np.minimum(rng.zipf(1.3, sum(sizes)), words) - 1
    tokens, length, texts = known[which], which % 11 + 1, np.cumsum([0, *sizes])
    counts = np.zeros(context_mixing.COUNTERS, np.int64)
    context_mixing.add_bit_counts(counts, tokens, length, texts)
    ones = np.ones(context_mixing.NODES)
    return context_mixing.MixingModel.of(counts, ones, ones), (tokens, length, texts)


def test_code_logs_against_bit_by_bit():
    rng = np.random.default_rng(2)
    model, tokens = some_tokens(rng, [1, 1, 255, 256, 257, 700, *rng.integers(1, 400, 60)])
    np.testing.assert_allclose(
        model.code_logs(*tokens), plain_code_logs(model, *tokens), rtol=1e-6
    )


def test_code_logs_cost():
    """Scoring takes well under the time of the plain walk; most of the operator's time goes there."""
    model, tokens = some_tokens(np.random.default_rng(3), [128] * 2000)

    def seconds(call):
        start = time.process_time()
        call()
        return time.process_time() - start

    plain = min(seconds(lambda: plain_code_logs(model, *tokens)) for _ in range(3))
    assert min(seconds(lambda: model.code_logs(*tokens)) for _ in range(3)) < 0.75 * plain


def test_tokens_of_many_texts():
    texts = [None, "", " One two\tTWO ", "x" * 300] * (context_mixing.TEXTS // 2) + ["end"]
    whole = context_mixing.tokens_of(pa.array(texts))
    one = {t: context_mixing.tokens_of(pa.array([t])) for t in set(texts)}
    for k in range(2):
        assert np.array_equal(whole[k], np.concatenate([one[t][k] for t in texts]))
    assert np.diff(whole[2]).tolist() == [len(one[t][0]) for t in texts]
    assert [x.tolist() for x in context_mixing.tokens_of(pa.array([], pa.string()))] == [[], [], [0]]


def test_scores_of_nothing(spark, no_docs, docs):
    assert context_mixing.context_mixing_scores(no_docs, context_mixing.training()).collect() == []
    from pyspark.sql import functions as F

    untrained = context_mixing.context_mixing_scores(docs, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and abs(r["base_score"]) < 1e-6 and r["n_known"] == 0 for r in untrained)


def test_pipeline(spark, small_dir, docs, doc_rows):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "source_mix", "packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None
    first, second, third, last = (f for _, f in corpus_pipeline.STAGES)
    kept = first(spark, docs, small_dir)
    assert kept.columns == docs.columns
    kept = second(spark, kept, small_dir)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert not ids & {400, 401, 402, 403, 408} and not ids & set(range(300, 305))
    mixed = third(spark, kept, small_dir)
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.select("doc_id").collect()} <= ids
    packed = last(spark, mixed, small_dir)
    assert packed.where("piece = 0").count() == mixed.count()
