"""One measure run end to end with the snapshot store."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from gapwise.plans.measures import CATALOG, Evidence, MeasureSpec, MeasureTables
from gapwise.operators.issues import read_issues
from gapwise.plans.run import current_run_log, current_state, run_measures
from gapwise.plans.sqlfiles import load_measures, register_dataset
from gapwise.sources.fixtures import star_clinical_tables
from gapwise.sources.store import ConcurrentCommit, TableStore


def test_two_runs_then_a_failed_run(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/store")
    t = MeasureTables.of(star_clinical_tables(spark, SF0001))
    r1 = run_measures(spark, t, "2000-08-01", store, now=dt.datetime(2000, 8, 1, 6), run_id="r1",
                      issues_path=f"{tmp_dir}/issues")
    r2 = run_measures(spark, t, "2001-08-01", store, now=dt.datetime(2001, 8, 1, 6), run_id="r2",
                      issues_path=f"{tmp_dir}/issues")
    assert r2["measures_evaluated"] == 3
    assert r2["gaps_open"] + r2["gaps_closed"] == 46 + 94 + 101  # FIXTURES.md sf0.001
    state = current_state(store)
    assert state.count() >= r2["gaps_open"] + r2["gaps_closed"]
    assert state.select("id").distinct().count() == state.count()
    # every gap ever evaluated keeps its issue, also those of patients absent from the second run
    assert read_issues(spark, f"{tmp_dir}/issues").count() == state.count()
    before = state.count()
    bad = CATALOG + (MeasureSpec("NOT_SEEDED", "x", 0, 200, (Evidence("Observation", ("c",), 1),)),)
    with pytest.raises(ValueError):
        run_measures(spark, t, "2001-09-01", store, now=dt.datetime(2001, 9, 1), run_id="r3",
                     catalog=bad)
    assert current_state(store).count() == before  # nothing committed
    runs = {r.id: r for r in current_run_log(store).collect()}
    assert runs["r1"].status == "SUCCEEDED" and runs["r2"].status == "SUCCEEDED"
    assert runs["r3"].status == "FAILED" and "measure" in runs["r3"].error
    assert runs["r1"].gaps_open == r1["gaps_open"]


def test_sql_measures_and_failed_contracts(spark, tmp_dir):
    clinical = star_clinical_tables(spark, SF0001)
    a, b = TableStore(spark, f"{tmp_dir}/a"), TableStore(spark, f"{tmp_dir}/b")
    now = dt.datetime(2001, 8, 1, 6)
    run_measures(spark, MeasureTables.of(clinical), "2001-08-01", a, now=now)
    run_measures(spark, register_dataset(clinical), "2001-08-01", b, now=now, catalog=load_measures())
    x, y = current_state(a), current_state(b)
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0
    twice = [m for m in load_measures() for _ in range(2)]
    with pytest.raises(Exception, match="duplicate evaluation"):
        run_measures(spark, register_dataset(clinical), "2001-08-01", b, now=now, catalog=twice)
    assert b.current_version("care_gap") == 1
    assert {r.status for r in current_run_log(b).collect()} == {"SUCCEEDED", "FAILED"}


def test_of_two_writers_one_commits(spark, tmp_dir):
    first, second = TableStore(spark, tmp_dir), TableStore(spark, tmp_dir)
    rows = spark.createDataFrame([(1,)], "id bigint")
    for s in (first, second):
        s.read("t", rows.schema)
    assert first.commit("t", rows, stats={"max_id": F.max("id")}) == 1
    with pytest.raises(ConcurrentCommit):
        second.commit("t", rows)
    second.read("t", rows.schema)
    assert second.stats("t") == {"max_id": 1}
    assert second.commit("t", rows.union(rows)) == 2
    assert second.commit("t", rows) == 3
    assert first.vacuum("t", keep=1) == 2
    assert [x.version for x in first.snapshots("t")] == [3] and first.read("t", rows.schema).count() == 1
