import json
from pathlib import Path

import pytest

from helpers import event, tuples
from signalmill.__main__ import parser, run
from signalmill.sources.landing import read_landing, upsert_landing


@pytest.fixture
def job(spark):
    return lambda *words: run(spark, parser().parse_args([str(w) for w in words]))


def test_from_events_to_status(spark, tmp_path, job, capsys):
    """Every command in turn, as an operator of the pipeline would run them."""
    (tmp_path / "in").mkdir()
    extract = {"elements": [{"type": "node", "id": n, "lat": 1.0, "lon": 2.0, "tags": {"highway": "traffic_signals"}} for n in (1, 2)]}
    (tmp_path / "map.json").write_text(json.dumps(extract))
    lines = [
        event(intersection_id=i, environment__timestamp=f"2026-06-05T18:00:{s}Z")
        for i, s in (("osm-1", "10"), ("osm-1", "50"), ("lost", "20"))
    ]
    text = "\n".join(json.dumps(x) for x in lines) + "\n{broken\n"
    (tmp_path / "in" / "events.json").write_text(text)
    at = {n: tmp_path / n for n in ("in", "out", "landing", "log", "ck", "core", "inv", "feed", "latest", "map.json")}

    assert job("inventory", "--extract", at["map.json"], "--out", at["inv"]) == 1
    box = ["--bbox", 0, 0, 2, 3]
    assert job("inventory", "--extract", at["map.json"], "--out", at["inv"], *box) == 0
    assert job("ingest", "--events", at["in"], "--out", at["out"]) == 0
    assert "'invalid_count': 1" in capsys.readouterr().out
    assert job("stream", "--events", at["in"], "--log", at["log"], "--checkpoint", at["ck"]) == 0
    assert job("fold", "--log", at["log"], "--landing", at["landing"]) == 0
    assert "folded_rows=2" in capsys.readouterr().out
    streamed = tuples(read_landing(spark, str(at["landing"])).drop("ingested_at"))
    stamp = "2026-06-05T18:01:10Z"
    assert job("aggregate", "--events", at["in"], "--landing", at["landing"], "--ingested-at", stamp) == 0
    assert tuples(read_landing(spark, str(at["landing"])).drop("ingested_at")) == streamed
    tables = ["--landing", at["landing"], "--inventory", at["inv"], "--core", at["core"]]
    assert job("warehouse", *tables) == 0
    assert "core_rows=2\norphan_ids=1" in capsys.readouterr().out
    # A rebuild has merged all loads, so a refresh finds nothing to do.
    assert job("refresh", *tables) == 0
    assert "since=none" in capsys.readouterr().out
    latest = ["--latest", at["latest"]]
    assert job("refresh", *tables, *latest, "--since", "2026-06-05") == 0
    assert "since=2026-06-05" in capsys.readouterr().out
    assert job("health", *latest, "--inventory", at["inv"], "--as-of", stamp) == 0
    stored = capsys.readouterr().out
    assert job("health", "--core", at["core"], "--inventory", at["inv"], "--as-of", stamp) == 0
    assert capsys.readouterr().out == stored

    assert job("checks", *tables) == 0
    assert job("checks", *tables[:4]) == 0
    assert "landing unique intersection_id,window_end failures=0" in capsys.readouterr().out
    bad = read_landing(spark, str(at["landing"])).selectExpr(
        "intersection_id", "window_end", "'BLUE' AS signal_state", "avg_stop_duration_seconds",
        "avg_vehicle_speed_kmh", "event_count", "ingested_at",
    )
    upsert_landing(bad.limit(1), str(tmp_path / "bad"))
    assert job("checks", "--landing", tmp_path / "bad", "--inventory", at["inv"]) == 1
    assert "landing accepted_values signal_state failures=1" in capsys.readouterr().out

    core = ["--core", at["core"], "--inventory", at["inv"]]
    assert job("status", *core, "--out", at["feed"]) == 0
    feed = [json.loads(r.value) for r in spark.read.text(str(at["feed"])).collect()]
    assert [d["signal_state"] for d in feed] == ["RED", "UNKNOWN"]
    capsys.readouterr()
    assert job("status", *core, "--id", "osm-2") == 0
    assert '"window_end":"1970-01-01T00:00:00Z"' in capsys.readouterr().out
    assert job("status", *core, "--id", "lost") == 1
    assert "NOT_FOUND" in capsys.readouterr().out
    assert job("status", "--core", at["core"], "--id", "lost") == 0
    assert job("status", *core) == 2
    assert job("health", *core, "--as-of", "2026-06-05T18:02:00Z") == 0
    out = capsys.readouterr().out
    assert '"freshness_status":"FRESH","max_lag_seconds":60.0,"intersection_count":2' in out
    assert job("freshness", "--landing", at["landing"], "--as-of", "2026-06-05T18:02:00Z") == 0
    assert "max_landing_lag_seconds=60.0" in capsys.readouterr().out


def test_commands_that_find_nothing(spark, tmp_path, job):
    Path(tmp_path, "map.json").write_text('{"elements": []}')
    assert job("inventory", "--extract", tmp_path / "map.json", "--out", tmp_path / "i") == 1
    Path(tmp_path, "e.json").write_text("{broken\n")
    assert job("aggregate", "--events", tmp_path / "e.json", "--landing", tmp_path / "l") == 0
    assert job("freshness", "--landing", tmp_path / "l") == 1
    assert job("ingest", "--events", tmp_path / "e.json", "--out", tmp_path / "o") == 0
