"""Measures over the star-derived tables and over small literal frames (M1–M6, Q1)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from gapwise.operators.versions import latest
from gapwise.plans.measures import (CATALOG, Evidence, MeasureSpec, MeasureTables, assert_contract,
                                    build_measure, catalog_by_id, evaluate_all, evaluate_each, rank_tables)
from gapwise.plans.sqlfiles import (bind_dataset, evaluate_sql_catalog, load_measures,
                                    register_dataset)
from gapwise.sources.fixtures import RUN_DATE, star_clinical_tables

# Counts published in FIXTURES.md for sf0.001: (denominator, numerator).
EXPECTED = {"BCS_MAMMOGRAPHY": (46, 7), "CDC_A1C": (94, 13), "COL_SCREENING": (101, 80)}


@pytest.fixture(scope="module")
def clinical(spark):
    return star_clinical_tables(spark, SF0001)


def test_fixture_counts(spark, clinical):
    t = MeasureTables.of(clinical)
    for m in CATALOG:
        rows = build_measure(m, t, RUN_DATE).collect()
        assert (len(rows), sum(r.in_numerator for r in rows)) == EXPECTED[m.id]


def test_fused_equals_each_and_sql_files(spark, clinical):
    t = MeasureTables.of(clinical)
    a = evaluate_all(t, RUN_DATE)
    b = evaluate_each(t, RUN_DATE)
    c = evaluate_sql_catalog(spark, register_dataset(clinical), RUN_DATE)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_fused_plan_ranks_each_table_once(spark, clinical):
    plan = evaluate_all(MeasureTables.of(clinical), RUN_DATE)._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("WindowGroupLimit") <= 8  # partial + final for 4 tables


def test_contract(spark, clinical):
    df = build_measure(CATALOG[0], MeasureTables.of(clinical), RUN_DATE)
    assert assert_contract(df) is df
    with pytest.raises(ValueError):
        assert_contract(df.withColumn("in_numerator", F.lit("x")))
    with pytest.raises(ValueError):
        assert_contract(df.drop("last_evidence_date"))


def test_sql_catalog_loading_and_binding(tmp_dir):
    ms = load_measures()
    assert [m.id for m in ms] == ["BCS_MAMMOGRAPHY", "CDC_A1C", "COL_SCREENING"]
    with pytest.raises(FileNotFoundError):
        load_measures(tmp_dir)
    assert bind_dataset("proj-1.ds_2") == "`proj-1`.`ds_2`"
    for bad in ["a;drop", "a b", "x`y", "", "a..b"]:
        with pytest.raises(ValueError):
            bind_dataset(bad)


def _tables(spark, patients, procedures=(), observations=(), conditions=()):
    meta = "struct<lastUpdated:timestamp,versionId:string>"
    coding = "struct<coding:array<struct<system:string,code:string>>>"
    p = spark.createDataFrame(patients, f"id string, meta {meta}, gender string, birthDate string")
    pr = spark.createDataFrame(list(procedures), f"id string, meta {meta}, subject struct<patientId:string>, "
                               f"code {coding}, performed struct<dateTime:string>")
    ob = spark.createDataFrame(list(observations), f"id string, meta {meta}, subject struct<patientId:string>, "
                               f"code {coding}, effective struct<dateTime:string>")
    co = spark.createDataFrame(list(conditions), f"id string, meta {meta}, subject struct<patientId:string>, "
                               f"code {coding}")
    return MeasureTables({"Patient": p, "Procedure": pr, "Observation": ob, "Condition": co})


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_latest_version_semantics(spark):
    rows = [("a", (ts("2020-01-01"), "1"), "old"), ("a", (ts("2020-01-02"), "1"), "new"),
            ("b", (ts("2020-01-01"), "1"), "tie-low"), ("b", (ts("2020-01-01"), "2"), "tie-high"),
            ("c", (None, "9"), "null-ts"), ("c", (ts("1999-01-01"), "1"), "dated")]
    df = spark.createDataFrame(rows, "id string, meta struct<lastUpdated:timestamp,versionId:string>, v string")
    got = {r.id: r.v for r in latest(df).collect()}
    assert got == {"a": "new", "b": "tie-high", "c": "dated"}


def test_measure_edge_cases(spark):
    meta = (ts("2020-01-01"), "1")
    mammo = ("http://snomed.info/sct", "71651007")
    t = _tables(
        spark,
        patients=[("p1", meta, "female", "1950-06-01"),   # age 51 at 2001
                  ("p2", meta, "female", "1950"),         # partial date: excluded
                  ("p3", meta, "male", "1950-06-01"),     # wrong gender
                  ("p4", meta, "female", "1951-12-31"),   # year diff 50, completed years 49
                  ("p5", (ts("2020-01-01"), "1"), "male", "1950-01-01"),
                  ("p5", (ts("2021-01-01"), "2"), "female", "1950-01-01")],  # latest wins
        procedures=[
            ("x1", meta, ("p1",), ([mammo],), ("1999-05-01",)),            # window start: in
            ("x2", meta, ("p1",), ([mammo],), ("2001-08-02",)),            # after run date: out
            ("x3", meta, ("p4",), (None,), ("2001-01-01",)),              # null coding
            ("x4", meta, ("p4",), ([],), ("2001-01-01",)),                # empty coding
            ("x5", meta, ("p5",), ([("s", "x"), mammo],), ("2001-07-31T23:30:00-05:00",)),  # UTC next day
            ("x6", meta, (None,), ([mammo],), ("2001-01-01",)),           # null patient
        ])
    m = catalog_by_id()["BCS_MAMMOGRAPHY"]
    got = {r.patient_id: (r.in_numerator, r.last_evidence_date)
           for r in build_measure(m, t, RUN_DATE).collect()}
    assert got == {"p1": (True, dt.date(1999, 5, 1)), "p4": (False, None),
                   "p5": (True, dt.date(2001, 8, 1))}
    fused = {r.patient_id: (r.in_numerator, r.last_evidence_date)
             for r in evaluate_all(t, RUN_DATE, [m]).collect()}
    assert fused == got


def test_custom_spec_is_data(spark):
    meta = (ts("2020-01-01"), "1")
    spec = MeasureSpec("X_TEST", "Test", 0, 200, (Evidence("Observation", ("c1",), 1, "sys"),))
    t = _tables(spark, [("p1", meta, "male", "2000-01-01"), ("p2", meta, "male", "2000-01-01")],
                observations=[("o1", meta, ("p1",), ([("sys", "c1")],), ("2001-07-15",)),
                              ("o2", meta, ("p2",), ([("other", "c1")],), ("2001-07-15",))])
    got = {r.patient_id: r.in_numerator for r in build_measure(spec, t, RUN_DATE).collect()}
    assert got == {"p1": True, "p2": False}
    with pytest.raises(ValueError):
        MeasureSpec("BAD", "x", 10, 5, (Evidence("Observation", ("c",), 1),))
    with pytest.raises(ValueError):
        Evidence("Encounter", ("c",), 1)


def test_tables_ranked_once_serve_every_run_date(spark, tmp_dir):
    old, new = (ts("2020-01-01"), "1"), (ts("2021-01-01"), "2")
    hit, a1c = [("s", "73761001")], [("http://loinc.org", "2335-8")]
    t = _tables(spark, [(f"p{i}", old, "female", "1940-01-01") for i in range(1, 6)],
                procedures=[("x1", old, ("p1",), (hit,), ("1995-03-01",)),
                            ("x2", old, ("p2",), (hit,), ("1995-03-01",)),
                            ("x2", new, ("p2",), ([("s", "x")],), ("1995-03-01",)),  # the newest has no such code
                            ("x3", old, ("p3",), ([("s", "x")],), ("1995-03-01",)),
                            ("x3", new, ("p3",), (hit,), ("1990-08-01",)),           # in reach of the first date only
                            ("x4", old, ("p4",), (hit,), (None,))],
                observations=[("o1", old, ("p4",), (a1c,), ("2001-07-15",)), ("o2", old, ("p5",), (a1c,), (None,))])
    ranked = rank_tables(t).kept(f"{tmp_dir}/ranked")
    for day in ("2000-08-01", "2001-08-01"):
        got, want = evaluate_all(ranked, day), evaluate_each(t, day)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    closed = {r.patient_id for r in got.where("measure_id = 'COL_SCREENING' AND in_numerator").collect()}
    assert closed == {"p1", "p4"}
    with pytest.raises(ValueError):
        evaluate_all(ranked, "2001-08-01", CATALOG[:1])


def test_versions_without_a_code_are_ranked_without_their_patient(spark):
    meta = (ts("2020-01-01"), "1")
    t = _tables(spark, [("p1", meta, "female", "1950-01-01")],
                procedures=[("x1", meta, ("p1",), ([("s", "x")],), ("2001-01-01",))])
    plan = rank_tables(t).evidence._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "_row" in plan.split("Window")[-1]


def test_two_runs_rank_their_tables_once(spark):
    from gapwise.plans.gap_queries import TwoRuns
    r = TwoRuns(spark, SF0001)
    for evals in (r.evals1, r.evals2):
        plan = evals._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "l_orderkey" not in plan
