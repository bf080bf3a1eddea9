"""Every registered query against its SQL twin, on the smallest tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from helpers import plan
from signalmill.plans.queries import QUERIES


@pytest.fixture(scope="module")
def twin(small_dir):
    con = duckdb.connect()
    for name in os.listdir(small_dir):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{small_dir}/{name}'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small_dir, twin, name):
    df = entry.queries()[name](spark, small_dir)
    got = comparable(df.columns, [tuple(r) for r in df.collect()])
    cursor = twin.execute(entry.oracle_sql()[name])
    want = comparable([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want
    assert want[1], "the comparison should not be one of two empty results"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 17 and "is_severe_bottleneck" in df.columns


@pytest.mark.parametrize(
    "name, columns",
    [
        ("silent_ids", {"user_id", "s_suppkey"}),
        ("rate_gaps", {"ts", "user_id"}),
        ("dq_unique_inventory", {"s_suppkey"}),
        ("landing_lag", {"ts"}),
    ],
)
def test_scans_read_only_what_is_used(spark, small_dir, name, columns):
    text = plan(entry.queries()[name](spark, small_dir))
    read = set(re.findall(r"(\w+):\w+", " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", text))))
    assert read <= columns | {"user_id"}


@pytest.mark.parametrize(
    "name", sorted(set(QUERIES) - {q for q in QUERIES if q.startswith("stream")})
)
def test_no_plan_multiplies_rows(spark, small_dir, name):
    text = plan(entry.queries()[name](spark, small_dir))
    for wrong in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEval"):
        assert wrong not in text
