"""The filter audit over files in several micro-batches against a plain count of every order."""

import itertools
import os
import random
import re

import pytest
from llm_rows import SCHEMA, prose
from pyspark.sql import functions as F

from signalmill.llm import filter_audit as audit
from signalmill.llm.filter_audit import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def audit_rows(doc_rows):
    rng = random.Random(9)
    rows = [r[:4] for r in doc_rows]
    for i in range(60):
        text = prose(rng, "en", rng.randint(150, 260))
        text = " ".join(w + rng.choice(["", f"{rng.randrange(999)}"]) for w in text.split())
        text = text.upper() if i % 9 == 0 else text + (" 5 & 6" if i % 7 == 0 else "")
        rows.append((1000 - 3 * i, text, "en", f"s{i % 3}"))
        # Copies with smaller and larger ids, in all files.
        rows += [(2000 + rng.randrange(-1500, 900), text, "en", f"s{j % 3}") for j in range(i % 4)]
    rows += [(5000 - i, "the same short text", "en", None if i % 2 else "") for i in range(40)]
    rows += [(None, "the same short text", "en", "s1"), (None, "", "en", "s1")]
    return rows


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = []
    for i, text, _, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > least[text],
        }
        docs.append((part or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                kept = [d for d in left if f not in d[1]]
                failing = [d for d in here if f in d[1]]
                shapley[f] += len(gone)
                out.append([
                    part, "".join(order), step, len(kept), len(gone), len(failing) - len(gone),
                    sum(d[1] == {f} for d in here), sum(d[2] for d in gone), sum(d[3] for d in gone),
                ])
                left = kept
        for row in out:
            if row[0] == part and len(row) == 9:
                row.append(shapley[row[1][row[2] - 1]])
    return sorted(map(tuple, out))


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 3 % 2, int(i % 5 == 0)) for i in range(0, 3000, 2)]
    rows += [(0, 1, None), (None, 1, 1), (2, None, 1), (2, None, 0)]
    return rows, spark.createDataFrame(rows, LABELS)


@pytest.mark.parametrize("buckets, files", [(1, 1), (50, 7)])
def test_filter_audit(spark, doc_rows, labels, folder, buckets, files, monkeypatch):
    rows = audit_rows(doc_rows)
    monkeypatch.setattr(audit, "BUCKET_TEXTS", max(1, len(rows) // buckets))
    path = f"{folder}/documents.parquet"
    df = spark.createDataFrame(rows, SCHEMA.rsplit(",", 1)[0])
    df.withColumn("mask", F.lit("x")).repartition(files).write.parquet(path)
    found = filter_audit(spark, path, labels[1])
    assert sorted(map(tuple, found.collect())) == brute(rows, labels[0])


def test_smaller_ids_that_come_later_retract(spark, labels, folder):
    path = f"{folder}/documents.parquet"
    os.makedirs(path)
    schema = SCHEMA.rsplit(",", 1)[0]
    stream = spark.readStream.schema(schema).parquet(path)
    rows = []
    for later in range(3):
        new = [(100 - later, "one text", "en", f"s{later % 2}"), (7, f"text {later}", "en", "s0")]
        new += [(100, "one text", "en", "s0")] * (later % 2)
        rows += new
        spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(path)
        # The same folder: each run takes up the state of the one ahead.
        counters = audit.mask_counters(stream, labels[1], f"{folder}/run", buckets=2)
        found = audit.order_report(counters).collect()
        assert sorted(map(tuple, found)) == brute(rows, labels[0])
    changes = spark.read.parquet(f"{folder}/run/changes")
    assert changes.where("n < 0").count() > 0


def test_audit_of_nothing(spark, labels, folder):
    path = f"{folder}/documents.parquet"
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert filter_audit(spark, path, labels[1]).collect() == []


def test_a_hot_text_is_few_rows_after_combining(spark):
    rows = [(i, "s", 1, 5, 6, False, False) for i in range(5000)]
    df = spark.createDataFrame(
        rows, "doc_id long, part string, mask int, h1 long, h2 long, good boolean, toxic boolean"
    )
    out = audit.combined(df.coalesce(2), 4).collect()
    assert len(out) <= 2 and sum(r["n_least"] + r["n_other"] for r in out) == 5000
