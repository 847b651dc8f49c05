"""Current rows batch by batch, replays across batches, rewritten documents, commits of writers that died."""
import datetime as dt
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from gapwise.operators import ingest as I
from gapwise.operators import replays
from gapwise.operators.current import CurrentRows, newest_of
from gapwise.operators.versions import latest
from gapwise.plans.gap_queries import NOW1
from gapwise.operators import gaps
from gapwise.sources.store import ConcurrentCommit, TableStore

DDL = "id STRING, meta STRUCT<lastUpdated: TIMESTAMP, versionId: STRING>, v INT"
DAY = dt.datetime(2001, 1, 1)


def test_current_rows_equal_the_ranked_history(spark, tmp_dir):
    rng = random.Random(1)
    rows = [(f"i{rng.randint(0, 25)}", (DAY + dt.timedelta(days=rng.randint(0, 9)) if rng.random() < .95 else None,
                                        f"{n:05d}" if rng.random() < .95 else None), n) for n in range(300)]
    history = spark.createDataFrame(rows, DDL)
    current = CurrentRows(TableStore(spark, tmp_dir), "rows")
    order = list(range(300))
    rng.shuffle(order)
    batches = [spark.createDataFrame([rows[i] for i in order[k::4]], DDL) for k in range(4)]
    for b in [*batches, batches[0], batches[2], spark.createDataFrame([], DDL)]:
        current.apply(b)
    want = {r.id: r.meta for r in latest(history).collect()}
    got = current.read(history.schema)
    assert {r.id: r.meta for r in got.collect()} == want and got.count() == len(want)


def test_the_history_is_not_read(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/store")
    current = CurrentRows(store, "rows")
    for k in range(3):
        path = f"{tmp_dir}/versions/batch={k}"
        spark.createDataFrame([("a", (DAY, str(k)), k), (f"b{k}", (DAY, "1"), k)], DDL).write.parquet(path)
        batch = spark.read.schema(DDL).parquet(path)
        files = newest_of(store.read("rows", batch.schema), batch).inputFiles()
        assert not any(f"batch={j}" in f for f in files for j in range(k))
        current.apply(batch)
    assert sorted((r.id, r.v) for r in current.read(batch.schema).collect()) == [("a", 2), ("b0", 0), ("b1", 1), ("b2", 2)]


VERSION = ("resource_type STRING, id STRING, meta STRUCT<lastUpdated: TIMESTAMP, versionId: STRING>, "
           "doc STRING, object_name STRING, pos INT")


def _versions(spark, rows):
    return spark.createDataFrame([("T", i, (DAY + dt.timedelta(days=d), f"{o}:{p}"), doc, o, p)
                                  for i, d, doc, o, p in rows], VERSION).withColumn("resource", F.parse_json("doc")).drop("doc")


def _stored(log):
    return sorted((r.batch, r.id, r.object_name, r.pos, r.r) for r in log.read().withColumn(
        "r", F.to_json("resource")).collect())


@pytest.mark.parametrize("bits", [0.01, 12])
def test_replays(spark, tmp_dir, bits):
    """With a filter of a few bits for many keys, nearly every key is a false hit and nothing changes."""
    log = replays.VersionLog(spark, tmp_dir, bits)
    log.append(_versions(spark, [("a", 0, '{"x":1,"y":2}', "o1", 0), ("b", 0, "{}", "o1", 1), ("r", 0, '{"k":1}', "o1", 2),
                                 ("r", 0, '{"k":1}', "o1", 2)] + [(f"n{k}", 0, "{}", "o1", 10 + k) for k in range(3000)]), "1")
    log.append(_versions(spark, [
        ("a", 1, '{"y":2,"x":1}', "o1", 0),   # again, fields in another order
        ("b", 1, '{"z":1}', "o1", 1),         # changed
        ("c", 1, "{}", "o1", 3),              # new id, known content
        ("a", 1, '{"x":1,"y":2}', "o2", 0),   # the same from another object
        *[(f"n{k}", 1, "{}", "o1", 10 + k) for k in range(2999)]]), "2")
    log.append(_versions(spark, [("b", 2, "{}", "o1", 1), ("b", 3, "{}", "o1", 1)]), "3")  # back to what it was
    for _ in range(2):  # the same batch again replaces itself
        log.append(_versions(spark, [("a", 5, '{"x":1,"y":2}', "o1", 0), ("d", 5, "{}", "o9", 0)]), "4")
    got = [r for r in _stored(log) if not r[1].startswith("n")]
    assert got == [("1", "a", "o1", 0, '{"x":1,"y":2}'), ("1", "b", "o1", 1, "{}"), ("1", "r", "o1", 2, '{"k":1}'),
                   ("1", "r", "o1", 2, '{"k":1}'), ("2", "a", "o2", 0, '{"x":1,"y":2}'), ("2", "b", "o1", 1, '{"z":1}'),
                   ("2", "c", "o1", 3, "{}"), ("3", "b", "o1", 1, "{}"), ("4", "d", "o9", 0, "{}")]
    assert len(_stored(log)) - len(got) == 3000


def test_a_batch_is_compared_without_telling_its_repeats_apart_first(spark, tmp_dir):
    """Rows that come several times in a batch are stored or left out together, and no step takes out repeats."""
    log = replays.VersionLog(spark, tmp_dir)
    log.append(_versions(spark, [("a", 0, '{"x":1}', "o1", 0), ("b", 0, '{"x":1}', "o1", 1)]), "1")
    twice = _versions(spark, [("a", 1, '{"x":1}', "o1", 0), ("b", 1, '{"x":2}', "o1", 1), ("b", 2, '{"x":1}', "o1", 1),
                             ("b", 3, '{"x":1}', "o1", 1)] * 2)
    new = replays.with_keys(twice)
    found = log.replays(new, "2")
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 2 and found.distinct().count() == 2
    log.append(twice, "2")
    assert [r for r in _stored(log) if r[0] == "2"] == [("2", "b", "o1", 1, f'{{"x":{k}}}') for k in (1, 1, 2, 2)]


def test_the_filter_never_misses_and_seldom_lies(spark):
    keys = spark.range(20_000).select(F.lit("T").alias("resource_type"), F.col("id").cast("string").alias("id"),
                                      F.lit("c").alias("content"))
    shards = -(-20_000 * 12 // (64 * replays.SHARD_WORDS))
    bloom = replays.bloom_filter(keys, shards)
    others = keys.withColumn("content", F.lit("d"))
    assert replays.maybe_stored(keys, bloom, shards).where("NOT maybe").count() == 0
    assert replays.maybe_stored(others, bloom, shards).where("maybe").count() < 20_000 * 0.06
    both = replays.merged(bloom.unionByName(replays.bloom_filter(others, shards)))
    assert replays.maybe_stored(keys.unionByName(others), both, shards).where("NOT maybe").count() == 0


def _bundle(entries):
    return json.dumps({"resourceType": "Bundle", "type": "transaction", "entry": entries})


def test_ten_thousand_references_in_one_resource(spark, tmp_dir):
    n = 10_000
    people = [{"fullUrl": f"urn:uuid:{k}", "resource": {"resourceType": "Patient"}, "request": {"method": "POST", "url": "Patient"}}
              for k in range(0, n, 2)]
    group = {"resourceType": "Group", "id": "g", "text": {"div": 'a "reference":"urn:uuid:0" in text'},
             "member": [{"entity": {"reference": f"urn:uuid:{k}"}} for k in range(n)] + [{"entity": {"reference": "urn:uuid:0"}}]}
    raw = spark.createDataFrame([("o", DAY, _bundle([*people, {
        "resource": group, "request": {"method": "PUT", "url": "Group/g"}}]))], "object_name STRING, object_time TIMESTAMP, body STRING")
    staged = I.stage(raw, f"{tmp_dir}/entries")
    begin = time.perf_counter()
    doc = json.loads(I.resolve_documents(staged.entries).where("resource_type = 'Group'")
                     .select(F.to_json("resource")).first()[0])
    assert time.perf_counter() - begin < 20
    assert [m["entity"]["reference"] for m in doc["member"]] == [
        f"urn:uuid:{k}" if k % 2 else f"Patient/{k}" for k in range(n)] + ["Patient/0"]
    assert doc["text"]["div"] == 'a "reference":"urn:uuid:0" in text'


def _claim(store, name, v, attempt=0):
    fs, p = store._fs(store._claim(name, v, attempt))
    return fs, p


def test_a_writer_that_died_does_not_block(spark, tmp_dir):
    df = spark.range(3)
    store = TableStore(spark, tmp_dir)
    assert store.commit("t", df) == 1
    fs, p = _claim(store, "t", 2)
    fs.create(p, False).close()           # claimed, never filled
    store.read("t", df.schema)
    assert store.commit("t", spark.range(4)) == 2
    assert store.current_version("t") == 2 and store.read("t", df.schema).count() == 4
    assert store.commit("t", spark.range(5)) == 3
    late = TableStore(spark, tmp_dir)
    late._base["t"] = 1
    with pytest.raises(ConcurrentCommit):
        late.commit("t", spark.range(9))
    assert store.read("t", df.schema).count() == 5
    assert store.vacuum("t", keep=1) == 2 and store.current_version("t") == 3
    assert sorted(f for f in os.listdir(f"{tmp_dir}/t/_manifest") if not f.startswith(".")) == ["v=3.json"]


def test_a_slow_writer_loses_to_the_one_that_took_over(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    row = {"version": 1, "path": f"{tmp_dir}/t/slow", "note": None, "committed_at": "", "stats": {}}
    fs, p = _claim(store, "t", 1)
    slow = fs.create(p, False)
    other = TableStore(spark, tmp_dir)
    assert other.commit("t", spark.range(4)) == 1
    slow.write(bytearray((json.dumps({**row, "attempt": 0}) + "\n").encode()))
    slow.close()
    assert store.read("t", spark.range(1).schema).count() == 4  # the later attempt counts
    with pytest.raises(ConcurrentCommit):
        store._base["t"] = 0
        store.commit("t", spark.range(7))


def test_ids_go_on_after_a_commit_without_statistics(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    evals = "measure_id STRING, patient_id STRING, in_numerator BOOLEAN, last_evidence_date DATE"
    for k in range(3):
        state = store.read("care_gap", gaps.CARE_GAP_SCHEMA)
        new = gaps.upsert_gaps(state, spark.createDataFrame([("M", f"p{k}", True, None)], evals), NOW1,
                               max_id=store.stats("care_gap").get("max_id"))
        store.commit("care_gap", new, stats=gaps.state_stats() if k != 1 else None)
    ids = [r.id for r in store.read("care_gap", gaps.CARE_GAP_SCHEMA).collect()]
    assert sorted(ids) == [1, 2, 3]
