import json
import os
import random

import pytest
from pyspark.sql import functions as F

from gapwise.sources.splitbundles import _segments, split_entries, unsplit_objects


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def _entry(rng, i):
    note = rng.choice(["plain", 'a } b', 'quote " and } {', "back\\slash }", "ends with \\", "é } 日本 { [", "", "]},{"])
    return {"fullUrl": f"urn:uuid:{i}", "resource": {
        "resourceType": "Patient", "id": str(i), "note": note, "name": [{"given": ["a", note], "x": {}}] * rng.randint(0, 2),
        "entry": [{"resource": {"n": i}}], "deep": [[{"a": [1, {"b": note}]}], []]}, "request": {"method": "PUT", "url": note}}


def _bundles(rng):
    out = {}
    for k in range(12):
        entries = [_entry(rng, i) for i in range(rng.choice([0, 1, 2, 40]))]
        parts = [("resourceType", "Bundle"), ("type", "batch"), ("title", 'top } "level" {'), ("total", 5), ("ok", True),
                 ("tags", ["a", "} b", "[", "{"]), ("meta", {"tag": [{"a": {}}, {"b": 1}], "entry": [{"not": "this"}]}),
                 ("link", [{"relation": "self"}, {"entry": [{"nor": "this"}]}]), ("entry", entries), ("nothing", None), ("empty", [])]
        rng.shuffle(parts)
        style = rng.choice([{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}])
        out[f"b{k}.json"] = json.dumps(dict(parts), **style) + rng.choice(["", "\n", " \n\n"])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_entries_equal_the_whole_read(spark, tmp_dir, small_splits, seed):
    bundles = _bundles(random.Random(seed))
    for name, text in bundles.items():
        _write(tmp_dir, name, text)
    got = {}
    for r in split_entries(spark, tmp_dir).collect():
        got[os.path.basename(r.object_name), r.pos] = json.loads(r.body)
    want = {(n, i): e for n, text in bundles.items() for i, e in enumerate(json.loads(text)["entry"])}
    assert got == want
    assert unsplit_objects(spark, tmp_dir).count() == 0
    assert _segments(spark, tmp_dir).rdd.getNumPartitions() > len(bundles)


def test_malformed_objects_are_named(spark, tmp_dir, small_splits):
    whole = json.dumps({"resourceType": "Bundle", "entry": [_entry(random.Random(1), i) for i in range(20)]})
    _write(tmp_dir, "good.json", whole)
    _write(tmp_dir, "cut.json", whole[:len(whole) // 2])
    _write(tmp_dir, "more.json", whole + "}")
    _write(tmp_dir, "much.json", whole + "\n}")
    _write(tmp_dir, "open.json", whole.replace('"urn:uuid:3"', '"urn:uuid:3'))
    _write(tmp_dir, "bad.json", whole.replace('"urn:uuid:3"', "urn"))
    _write(tmp_dir, "empty.json", "")
    names = {os.path.basename(r.object_name) for r in unsplit_objects(spark, tmp_dir).collect()}
    assert names == {"cut.json", "more.json", "much.json", "open.json", "bad.json"}


def test_a_large_object_is_many_tasks_work(spark, tmp_dir, small_splits):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 10))
    entries = [{"resource": {"resourceType": "Patient", "id": str(i), "text": "x} " * 20}} for i in range(40_000)]
    _write(tmp_dir, "large.json", json.dumps({"resourceType": "Bundle", "type": "batch", "entry": entries}))
    size = os.path.getsize(os.path.join(tmp_dir, "large.json"))
    seg = _segments(spark, tmp_dir)
    per_task = seg.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert len(per_task) >= size // (256 << 10) and max(r.n for r in per_task) < 2 * (256 << 10)
    got = split_entries(spark, tmp_dir).agg(F.count("*").alias("n"), F.max("pos").alias("p"), F.count_if(
        F.get_json_object("body", "$.resource.id") == F.col("pos").cast("string")).alias("same")).first()
    assert (got.n, got.p, got.same) == (40_000, 39_999, 40_000)
