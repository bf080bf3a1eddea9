import datetime as dt

import pytest

from helpers import at, landing, tuples
from signalmill.schemas import LANDING
from signalmill.sources import files, snapshots as snap

COLUMNS = ("intersection_id", "window_end", "event_count")


def row(key, when, count, loaded="2026-06-05 12:00:00"):
    return (key, when, "RED", 1.0, 2.0, count, loaded)


def shown(spark, path, **options):
    return tuples(snap.read_snapshot(spark, path, **options), *COLUMNS)


def test_days_are_swapped_at_once(spark, folder):
    path = folder + "/table"
    assert shown(spark, path) == [] and snap.snapshot_days(spark, path) == []
    first = [row("a", "2026-06-01 10:00:00", 1), row("a", "2026-06-02 10:00:00", 1)]
    assert snap.upsert_snapshot(landing(spark, *first), path) == 1
    reader = snap.read_snapshot(spark, path)
    second = [
        row("a", "2026-06-02 10:00:00", 9, "2026-06-05 13:00:00"),
        row("a", "2026-06-02 10:00:00", 5),
        row("b", "2026-06-03 10:00:00", 2),
    ]
    assert snap.upsert_snapshot(landing(spark, *second), path) == 2
    want = [
        ("a", at("2026-06-01 10:00:00"), 1),
        ("a", at("2026-06-02 10:00:00"), 9),
        ("b", at("2026-06-03 10:00:00"), 2),
    ]
    assert shown(spark, path) == want
    # A frame from before the write still shows its version.
    assert tuples(reader, *COLUMNS) == [want[0], ("a", at("2026-06-02 10:00:00"), 1)]
    assert shown(spark, path, since=dt.date(2026, 6, 3)) == want[2:]
    assert snap.snapshot_days(spark, path) == [dt.date(2026, 6, n) for n in (1, 2, 3)]
    # The same load again, and one without rows.
    assert snap.upsert_snapshot(landing(spark, *second), path) == 3
    assert snap.upsert_snapshot(landing(spark, *second).limit(0), path) == 3
    assert shown(spark, path) == want


def test_a_writer_that_dies_ahead_of_the_swap_changes_nothing(spark, folder, monkeypatch):
    path = folder + "/table"
    snap.upsert_snapshot(landing(spark, row("a", "2026-06-01 10:00:00", 1)), path)

    def die(*_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(files, "replace_small", die)
        with pytest.raises(OSError, match="gone"):
            snap.upsert_snapshot(landing(spark, row("a", "2026-06-01 10:00:00", 7)), path)
    assert len(files.partitions(spark, path, ["load"])) == 2
    assert shown(spark, path) == [("a", at("2026-06-01 10:00:00"), 1)]
    snap.upsert_snapshot(landing(spark, row("a", "2026-06-01 10:00:00", 8)), path)
    assert shown(spark, path) == [("a", at("2026-06-01 10:00:00"), 8)]
    assert len(files.partitions(spark, path, ["load"])) == 2  # the current and the one before


def test_two_writers_are_noticed(spark, folder, monkeypatch):
    path = folder + "/table"
    mine = landing(spark, row("a", "2026-06-01 10:00:00", 1))
    write = snap._write_load

    def slow(rows, where):
        with monkeypatch.context() as patch:
            patch.setattr(snap, "_write_load", write)
            snap.upsert_snapshot(landing(spark, row("b", "2026-06-01 10:00:00", 2)), path)
        return write(rows, where)

    with monkeypatch.context() as patch:
        patch.setattr(snap, "_write_load", slow)
        with pytest.raises(RuntimeError, match="another writer"):
            snap.upsert_snapshot(mine, path)
    assert shown(spark, path) == [("b", at("2026-06-01 10:00:00"), 2)]


def test_a_whole_table_is_replaced(spark, folder):
    path = folder + "/table"
    days = [row("a", f"2026-06-0{n} 10:00:00", n) for n in (1, 2)]
    assert snap.replace_snapshot(landing(spark, *days), path) == 1
    assert snap.replace_snapshot(landing(spark, *days[1:]), path) == 2
    assert shown(spark, path) == [("a", at("2026-06-02 10:00:00"), 2)]
    assert snap.replace_snapshot(landing(spark, *days).limit(0), path) == 3
    assert shown(spark, path) == []
    with pytest.raises(ValueError, match="columns"):
        snap.replace_snapshot(landing(spark, *days).drop("event_count"), path)
    assert snap.read_snapshot(spark, path).schema.fieldNames() == LANDING.fieldNames()
