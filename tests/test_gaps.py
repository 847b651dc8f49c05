"""Gap upsert, counts, run log, checks, store."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from gapwise.operators import checks, gaps, runs
from gapwise.operators.ids import dense_index, index_within_group
from gapwise.sources.measure_dim import measure_dim
from gapwise.sources.store import TableStore

EV = "measure_id string, patient_id string, in_numerator boolean, last_evidence_date date"
T1 = dt.datetime(2024, 1, 1, 2, 0)
T2 = dt.datetime(2024, 1, 2, 2, 0)


def ev(spark, rows):
    return spark.createDataFrame(rows, EV)


def by_key(df):
    return {(r.measure_id, r.patient_id): r for r in df.collect()}


def test_insert_then_update_in_place(spark):
    s1 = gaps.upsert_gaps(gaps.empty_state(spark), ev(spark, [
        ("M", "a", False, None), ("M", "b", True, dt.date(2023, 5, 1)), ("N", "a", False, None)]), T1)
    k1 = by_key(s1)
    assert sorted(r.id for r in k1.values()) == [1, 2, 3]
    assert k1[("M", "a")].id == 1 and k1[("N", "a")].id == 3  # ordered by key
    assert all(r.first_identified_at == T1 == r.last_evaluated_at for r in k1.values())
    # run 2: a closes, b reopens (evidence becomes NULL), N/a absent → untouched, c new
    s2 = gaps.upsert_gaps(s1, ev(spark, [
        ("M", "a", True, dt.date(2023, 12, 1)), ("M", "b", False, None), ("M", "c", False, None)]), T2)
    k2 = by_key(s2)
    assert k2[("M", "a")].status == "CLOSED" and k2[("M", "a")].id == 1
    assert k2[("M", "a")].first_identified_at == T1 and k2[("M", "a")].last_evaluated_at == T2
    assert k2[("M", "b")].status == "OPEN" and k2[("M", "b")].last_evidence_date is None
    assert k2[("N", "a")].last_evaluated_at == T1 and k2[("N", "a")].status == "OPEN"
    assert k2[("M", "c")].id == 4 and k2[("M", "c")].first_identified_at == T2
    # replay of the same batch changes nothing but the evaluation time
    s3 = gaps.upsert_gaps(s2, ev(spark, [("M", "c", False, None)]), T2)
    assert by_key(s3) == k2


def test_batch_duplicates_last_wins(spark):
    b = ev(spark, [("M", "a", False, None), ("M", "a", True, dt.date(2023, 1, 1))]) \
        .withColumn("seq", F.monotonically_increasing_id())
    assert gaps.duplicate_keys(b.drop("seq")).count() == 1
    s = gaps.upsert_gaps(gaps.empty_state(spark), b, T1, seq="seq")
    assert [r.status for r in s.collect()] == ["CLOSED"]


def test_counts_and_summary(spark):
    e = ev(spark, [("M", "a", False, None), ("M", "b", True, None), ("N", "a", True, None)])
    c = {r.measure_id: (r.gaps_open, r.gaps_closed) for r in gaps.gap_counts(e).collect()}
    assert c == {"M": (1, 1), "N": (0, 1)}
    r = gaps.run_summary(e, 3).first()
    assert (r.measures_evaluated, r.gaps_open, r.gaps_closed) == (3, 1, 2)


def test_dense_index_is_global_and_ordered(spark):
    df = spark.range(0, 5000, 1, numPartitions=7).select((F.col("id") * 7 % 5000).alias("k"))
    out = dense_index(df, ["k"], "i", start=10).collect()
    assert sorted((r.k, r.i) for r in out) == [(k, k + 10) for k in range(5000)]
    g = spark.createDataFrame([("a", 3), ("a", 1), ("b", 9), ("a", 2)], "g string, v int")
    got = sorted((r.g, r.v, r.group_index) for r in index_within_group(g, "g", ["v"]).collect())
    assert got == [("a", 1, 0), ("a", 2, 1), ("a", 3, 2), ("b", 9, 0)]


def test_run_log_lifecycle(spark):
    e = ev(spark, [("M", "a", False, None)])
    log = (runs.run_started(spark, "r1", dt.date(2024, 1, 1), T1)
           .unionByName(runs.run_completed(gaps.run_summary(e, 1), "r1", dt.date(2024, 1, 1), T1, T2))
           .unionByName(runs.run_started(spark, "r2", dt.date(2024, 1, 2), T2))
           .unionByName(runs.run_failed(spark, "r2", dt.date(2024, 1, 2), T2, T2, "boom" * 1000))
           .unionByName(runs.run_started(spark, "r3", dt.date(2024, 1, 3), T2)))
    cur = {r.id: r for r in runs.current_runs(log).collect()}
    assert cur["r1"].status == "SUCCEEDED" and cur["r1"].gaps_open == 1
    assert cur["r2"].status == "FAILED" and len(cur["r2"].error) == 2000
    assert cur["r3"].status == "RUNNING"


def test_constraint_checks_find_violations(spark):
    g = spark.createDataFrame([
        (1, "M", "a", "OPEN", None, T1, T1), (1, "M", "a", "BAD", None, T1, T1),
        (2, "ZZZ", "b", None, None, T1, T1)], gaps.CARE_GAP_SCHEMA.simpleString().replace(
        "struct<", "").rstrip(">").replace(":", " "))
    dim = spark.createDataFrame([("M", "m")], "id string, display_name string")
    assert checks.check_fk(g, "measure_id", dim).count() == 1
    assert checks.check_domain(g, "status", checks.GAP_STATUSES).count() == 1  # NULL passes
    assert checks.check_unique(g, ["measure_id", "patient_id"]).count() == 1
    nn = {r.column: r.nulls for r in checks.check_not_null(g, ["status", "id"]).collect()}
    assert nn == {"status": 1, "id": 0}
    log = runs.run_started(spark, "r", dt.date(2024, 1, 1), T1)
    rep = {r.check_name: r.violations for r in
           checks.constraint_report(g, runs.current_runs(log), dim).collect()}
    assert rep["care_gap.fk_measure"] == 1 and rep["care_gap.unique_id"] == 1
    assert rep["measure_run.status_domain"] == 0


def test_store_snapshot_swap(spark, tmp_dir):
    st = TableStore(spark, tmp_dir)
    assert st.current_version("care_gap") is None
    assert st.read("care_gap", gaps.CARE_GAP_SCHEMA).count() == 0
    s1 = gaps.upsert_gaps(gaps.empty_state(spark), ev(spark, [("M", "a", False, None)]), T1)
    assert st.commit("care_gap", s1) == 1
    s2 = gaps.upsert_gaps(st.read("care_gap", gaps.CARE_GAP_SCHEMA),
                          ev(spark, [("M", "b", True, None)]), T2)
    assert st.commit("care_gap", s2) == 2
    assert st.read("care_gap", gaps.CARE_GAP_SCHEMA).count() == 2
    st.append("measure_run", runs.run_started(spark, "r", dt.date(2024, 1, 1), T1))
    assert st.read_log("measure_run", runs.LOG_SCHEMA).count() == 1
