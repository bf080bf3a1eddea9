import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from helpers import inventory, tuples
from signalmill.operators.inventory import elements, inventory_from_elements
from signalmill.schemas import INVENTORY, same_shape
from signalmill.sources.inventory import (
    current_version,
    publish_inventory,
    read_inventory,
    read_inventory_version,
    read_map_extract,
    write_inventory,
)

SIGNAL = {"highway": "traffic_signals"}
EXTRACT = {
    "version": 0.6,
    "elements": [
        {"type": "node", "id": 9, "lat": -27.12345678, "lon": -52.1, "tags": {**SIGNAL, "name": "A"}},
        {"type": "node", "id": 10, "lat": 1, "lon": 2, "tags": {**SIGNAL, "name": "", "name:pt": "B"}},
        {"type": "node", "id": 7, "lat": 1.0, "lon": 2.0, "tags": {**SIGNAL, "crossing:ref": "C", "direction": "x"}},
        {"type": "node", "id": 8, "lat": 1.0, "lon": 2.0, "tags": {**SIGNAL, "ref": "R", "crossing:ref": "C"}},
        {"type": "node", "id": 11, "lat": 1.0, "lon": 2.0, "tags": {**SIGNAL, "direction": "forward"}},
        {"type": "node", "id": 5000000000, "lat": 1.0, "lon": 2.0, "tags": SIGNAL},
        {"type": "node", "id": 12, "lat": 1.0, "lon": 2.0, "tags": {"highway": "bus_stop"}},
        {"type": "node", "id": 13, "lat": 1.0, "lon": 2.0},
        {"type": "way", "id": 1, "nodes": [1, 2]},
    ],
}


def extract(spark, folder, doc=EXTRACT, name="map.json"):
    Path(folder, name).write_text(json.dumps(doc, indent=2))
    return inventory_from_elements(elements(read_map_extract(spark, f"{folder}/{name}")))


def test_nodes_become_entries(spark, folder):
    rows = extract(spark, folder)
    assert same_shape(rows.schema, INVENTORY) == []
    names = dict(tuples(rows, "intersection_id", "display_name"))
    assert names == {
        "osm-9": "A",
        "osm-10": "B",
        "osm-7": "C",
        "osm-8": "R",
        "osm-11": "Semáforo 11 (forward)",
        "osm-5000000000": "Semáforo 5000000000",
    }
    assert tuples(rows.filter("osm_node_id = 9"), "latitude", "longitude", "source") == [
        (-27.123457, -52.1, "osm")
    ]


def test_csv_there_and_back_in_id_order(spark, folder):
    rows = extract(spark, folder)
    path = folder + "/inventory"
    assert write_inventory(rows, path)
    assert tuples(read_inventory(spark, path)) == tuples(rows)
    lines = [
        line
        for part in sorted(Path(path).glob("part-*"))
        for line in part.read_text(encoding="utf-8").splitlines()
    ]
    assert lines[0] == "intersection_id,display_name,latitude,longitude,osm_node_id,source"
    ids = [x.split(",")[0] for x in lines if not x.startswith("intersection_id")]
    assert ids == sorted(ids) and len(ids) == 6


def test_an_empty_extract_keeps_the_old_file(spark, folder):
    path = folder + "/inventory"
    assert write_inventory(inventory(spark, "a"), path)
    assert not write_inventory(extract(spark, folder, {"elements": []}), path)
    assert read_inventory(spark, path).count() == 1


def test_missing_and_empty_files(spark, folder):
    with pytest.raises(AnalysisException):
        read_inventory(spark, folder + "/none")
    assert read_inventory(spark, folder + "/none", required=False).count() == 0
    Path(folder, "empty.csv").write_text("intersection_id,display_name,latitude,longitude\n")
    with pytest.raises(ValueError, match="no intersections"):
        read_inventory(spark, folder + "/empty.csv")
    assert read_inventory(spark, folder + "/empty.csv", required=False).isEmpty()


def test_wrong_columns_are_refused(spark, folder):
    with pytest.raises(ValueError, match="columns"):
        write_inventory(inventory(spark, "a").drop("source"), folder + "/x")


def test_only_signals_inside_the_box(spark, folder):
    Path(folder, "map.json").write_text(json.dumps(EXTRACT))
    nodes = elements(read_map_extract(spark, f"{folder}/map.json"))
    inside = inventory_from_elements(nodes, (0.0, 0.0, 2.0, 3.0))
    assert tuples(inside, "osm_node_id") == [(10,), (11,), (5000000000,), (7,), (8,)]


def test_columns_are_found_by_name(spark, folder):
    lines = "longitude,latitude,source,intersection_id,extra,display_name\n-52.6,-27.1,osm,osm-1,x,A\n"
    Path(folder, "swapped.csv").write_text(lines + "east,-27.1,osm,osm-2,x,B\n")
    assert tuples(read_inventory(spark, f"{folder}/swapped.csv")) == [
        ("osm-1", "A", -27.1, -52.6, None, "osm"),
        ("osm-2", "B", -27.1, None, None, "osm"),
    ]


ODD_NAMES = [
    "}", "{", '"}', "\\", '\\"', "a}b{c", "[{", "]}", '{"type": "node"}', '"elements": [', "é}ü", "",
]


def odd_extract(n):
    """Names full of marks, members in objects, an array in a head, ways between the nodes."""
    rows = []
    for i in range(n):
        tags = {**SIGNAL, "name": f"{ODD_NAMES[i % len(ODD_NAMES)]}{i}", "note": ODD_NAMES[i % 5]}
        rows.append({"type": "node", "id": i, "lat": 1.0, "lon": 2.0, "tags": tags})
        if i % 3 == 0:
            members = [{"type": "node", "ref": 1, "role": "}"}, {"type": "way", "ref": 2}]
            rows.append({"type": "relation", "id": i, "members": members, "tags": SIGNAL})
    return {"head": {"text": 'x "elements": [ {'}, "elements": rows, "tail": {"a": [1, 2]}}


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("size", ["1000", "128MB"])
def test_one_large_file_is_read_by_many_tasks(spark, folder, indent, size):
    docs = odd_extract(200), {"elements": []}, odd_extract(3)
    text = "\n".join(json.dumps(doc, indent=indent, ensure_ascii=False) for doc in docs)
    Path(folder, "map.json").write_text(text, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = read_map_extract(spark, f"{folder}/map.json")
        tasks = spark.read.option("lineSep", "}").text(f"{folder}/map.json").rdd.getNumPartitions()
        found = elements(read).select("type", "id", "tags").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert tasks > 1 or size == "128MB"
    want = [(e["type"], e["id"], e["tags"]) for doc in docs for e in doc["elements"]]
    by_id = lambda row: (row[0], row[1], str(sorted(row[2].items())))
    assert sorted(map(tuple, found), key=by_id) == sorted(want, key=by_id)


def test_a_cut_off_extract_gives_its_whole_elements(spark, folder):
    text = json.dumps(odd_extract(10))
    Path(folder, "map.json").write_text(text[: text.index('"id": 9')])
    nodes = elements(read_map_extract(spark, f"{folder}/map.json")).filter("type = 'node'")
    assert sorted(r.id for r in nodes.collect()) == list(range(9))
    Path(folder, "none.json").write_text("")
    assert elements(read_map_extract(spark, f"{folder}/none.json")).isEmpty()


def test_versions_of_the_inventory(spark, folder):
    path = folder + "/versions"
    assert current_version(spark, path) is None
    assert read_inventory_version(spark, path, None).isEmpty()
    assert publish_inventory(inventory(spark, "a"), path) == 1
    assert publish_inventory(inventory(spark, "a", "b"), path) == 2
    assert publish_inventory(inventory(spark, "a").limit(0), path) is None
    assert current_version(spark, path) == 2
    assert read_inventory_version(spark, path, 1).count() == 1
    assert read_inventory_version(spark, path, 2).count() == 2
