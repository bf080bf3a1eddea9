"""Language ID by multilingual mixture inference.

Each language is a distribution over byte trigrams of words, counted over all labelled training
texts. A document is a mixture of languages: expectation-maximisation estimates what share of its
words each language wrote, and a penalty of half the logarithm of the words per language takes out
those that do not pay for themselves. What is left is the document's language set.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import batches_of, id_hash, separated, spans, sums

# Hashed trigrams: the size of a language's table, at any size of the corpus.
GRAM_BITS = 17
ROUNDS = 30
UNDETERMINED = "und"
# Bytes of text for which a task holds trigrams and likelihoods at a time.
BATCH_BYTES = 1 << 19
# Least sum of a word's likelihoods, relative to its best language, that is taken in floats.
LEAST_TOTAL = 1e-25

_LETTER = np.zeros(256, np.uint8)
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def word_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigrams of all words, offsets of the words in them, offsets of the texts in the words.

    Words are runs of letters, any byte beyond ASCII counting as one; each has a trigram per byte
    and one for its end.
    """
    data, offsets = separated(column)
    byte = _LETTER[data]
    upper = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)) + 1
    byte[upper] += 0x20
    letter = byte > 0
    before = np.concatenate([[False], letter[:-1]])
    at = np.flatnonzero(letter | before)
    first = np.flatnonzero((letter & ~before)[at])
    one = np.where(at > 0, byte[at - 1], 0).astype(np.uint32)
    two = np.where((at > 1) & (one > 0), byte[at - 2], 0).astype(np.uint32)
    gram = (two << np.uint32(16) | one << np.uint32(8) | byte[at]) * np.uint32(0x9E3779B1)
    words = np.append(first, len(at))
    texts = np.searchsorted(at[first], offsets)
    return (gram >> np.uint32(32 - GRAM_BITS)).astype(np.int64), words, texts


@dataclass
class LanguageModel:
    names: list[str]  # in order
    log_p: np.ndarray  # language x trigram


def learn_languages(labelled: DataFrame) -> LanguageModel:
    """Trigram distributions of every language of (text, lang), over all rows.

    Rows without text or language take no part. Tasks sum their counts before the shuffle; the
    driver gets a table of at most 2 ** GRAM_BITS counts a language.
    """

    def counted(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches_of(batches, BATCH_BYTES, tidy=True):
            langs = batch.column("lang").to_pylist()
            grams, words, texts = word_grams(batch.column("text"))
            edge = words[texts]
            codes = {name: i for i, name in enumerate(dict.fromkeys(langs))}
            code = np.repeat([codes[x] for x in langs], np.diff(edge))
            for name, i in codes.items():
                mine = np.bincount(grams[code == i], minlength=1 << GRAM_BITS)
                counts[name] = counts.get(name, 0) + mine
        for name, n in counts.items():
            slot = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(slot), pa.string()), pa.array(slot, pa.int32()),
                 pa.array(n[slot])],
                ["lang", "slot", "n"],
            )

    got = (
        labelled.select("text", "lang")
        .where("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(counted, "lang string, slot int, n long")
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    lang = got["lang"].combine_chunks().dictionary_encode()
    names = sorted(lang.dictionary.to_pylist())
    n = np.full((len(names), 1 << GRAM_BITS), 0.5)
    place = np.array([names.index(x) for x in lang.dictionary.to_pylist()], int)
    n[place[lang.indices.to_numpy()], got["slot"].to_numpy()] += got["n"].to_numpy()
    return LanguageModel(names, np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32))


def mixture_shares(likelihood: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Share of each language in each text, from the words' log-likelihoods (words x languages).

    A language whose words fall to the penalty or below leaves the text's set. Texts without words
    get zeros. A word that only languages no longer in the set would write is shared by those that
    are.
    """
    n = np.diff(texts)
    doc = np.repeat(np.arange(len(n)), n)
    p = np.exp(likelihood - likelihood.max(axis=1, keepdims=True, initial=-np.inf))
    p = p.astype(np.float32)
    share = np.full((len(n), likelihood.shape[1]), 1 / max(1, likelihood.shape[1]))
    share[n == 0] = 0
    penalty = 0.5 * np.log(np.maximum(n, 1))[:, None]
    active = np.flatnonzero(n > 0)
    for _ in range(ROUNDS):
        if not len(active):
            break
        mine = np.flatnonzero(np.isin(doc, active)) if len(active) < len(n) else np.arange(len(doc))
        weight = p[mine] * share[doc[mine]].astype(np.float32)
        total = weight.sum(axis=1, keepdims=True)
        # What the floats lose, relative to the best language still in the set.
        lost = np.flatnonzero(total[:, 0] < LEAST_TOTAL)
        if len(lost):
            with np.errstate(divide="ignore"):
                log = likelihood[mine[lost]].astype(np.float64) + np.log(share[doc[mine[lost]]])
            weight[lost] = np.exp(log - log.max(axis=1, keepdims=True))
            total[lost] = weight[lost].sum(axis=1, keepdims=True)
        weight /= total
        count = sums(weight.astype(np.float64), spans(n[active]))
        kept = np.maximum(count - penalty[active], 0)
        none = kept.sum(axis=1) == 0
        kept[none] = count[none] == count[none].max(axis=1, keepdims=True)
        new = kept / kept.sum(axis=1, keepdims=True)
        moved = np.abs(new - share[active]).max(axis=1) > 1e-3
        share[active] = new
        active = active[moved]
    return share


def language_sets(column: pa.Array, model: LanguageModel) -> list[list[tuple[str, float]]]:
    """The selected languages of each text with their shares, greatest first, ties by name."""
    names = model.names
    if not names:
        return [[] for _ in range(len(column))]
    grams, words, texts = word_grams(column)
    found = np.zeros((len(words) - 1, len(names)))
    for i in range(len(names)):
        if len(words) > 1:
            found[:, i] = np.add.reduceat(model.log_p[i][grams], words[:-1], dtype=np.float64)
    out = []
    for row, text in zip(mixture_shares(found, texts).tolist(), column, strict=True):
        # Bytes beyond ASCII pass for letters above; a text of signs alone has no language.
        lettered = any(row) and any(map(str.isalpha, text.as_py()))
        chosen = sorted((-x, name) for x, name in zip(row, names, strict=True) if x)
        out.append([(name, -x) for x, name in chosen] if lettered else [])
    return out


def language_mixtures(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Languages of every text: doc_id, lang_pred, score, langs (array of lang and share).

    ``langs`` is the selected set, greatest share first, ties by name; ``lang_pred`` and ``score``
    are its first. A text that is null or has no letter, and any text where nothing was learned,
    gets `und`, 0 and no languages. Repeated rows are answered each; other columns of ``docs``
    take no part. A map over the rows with a model of fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def answered(batches):
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches_of(batches, BATCH_BYTES, tidy=True):
            langs = language_sets(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x[0][0] if x else UNDETERMINED for x in langs], pa.string()),
                    pa.array([min(1.0, x[0][1]) if x else 0.0 for x in langs], pa.float64()),
                    pa.array([[{"lang": a, "share": b} for a, b in x] for x in langs], kind),
                ],
                ["doc_id", "lang_pred", "score", "langs"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        answered,
        "doc_id long, lang_pred string, score double, langs array<struct<lang string, share double>>",
    )


def documents_with_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` for which a language is found, learned from its labelled rows.

    Those with a null text or one without letters go; all go where nothing can be learned.
    """
    model = learn_languages(docs.where(~held_out()))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches):
        for batch in batches_of(batches, BATCH_BYTES, tidy=True):
            langs = language_sets(batch.column("text"), shared.value)
            yield batch.filter(pa.array([bool(x) for x in langs], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def held_out():
    """Whether a document is kept from learning."""
    return id_hash() % 5 == 0


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out, answer all."""
    model = learn_languages(docs.where(~held_out()))
    return language_mixtures(docs, model).withColumn("held_out", held_out())
