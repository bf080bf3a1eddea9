"""Invented documents with every awkward case."""

import random

from pyspark.sql import functions as F

WORDS = {
    "en": "the of and to in that with which water river stone light morning house garden".split(),
    "de": "der die das und mit nicht auch wasser fluss stein licht morgen haus garten über".split(),
    "fr": "le la les des et avec pas aussi eau rivière pierre lumière matin maison jardin".split(),
}
CLASHING = ["n", "k", "size", "part", "ids", "row", "taken", "class_key", "component_id", "near_class",
            "kept_text", "of", "rank", "score", "langs", "h"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def document_rows(seed=1, n=60):
    """Documents with nulls, empty and very long texts, repeated rows, copies and near copies."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        rows.append((i, prose(rng, lang, rng.randint(1, 120)), lang, f"s{i % 4}", None))
    base = prose(rng, "en", 200).split()
    for i in range(12):
        words = list(base)
        words[17 * i % 200] = f"changed{i}"
        rows.append((200 + i, " ".join(words), "en", "s0", None))
    rows += [(300 + i, rows[3][1], "en", "s1", None) for i in range(5)]
    rows += [rows[5], rows[5], rows[7]]
    rows += [
        (400, None, "en", "s1", None), (401, "", None, None, 0), (402, " \t\n ", "en", None, None),
        (403, "12 34 --- !!", "en", "s2", None), (404, "Ωμέγα 日本語 😀 ñ", None, "s2", None),
        (405, "x" * 30000, "en", "s2", None), (406, prose(rng, "de", 9000), "de", "s3", None),
        (None, "a row without an id", "en", "s3", None), (407, "one", None, None, None),
        (408, "— … ¿", "fr", "s2", None), (409, "<|endoftext|> in\x00 a text", "en", "s2", None),
        (410, "a b c d", "en", "", None), (411, "a b c d", "en", "", None),
    ]
    return rows


def make(spark, rows, clashing=True):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHING))) if clashing else df
