"""A catalog as value-set indexes, and many run dates in one pass, against measure-by-measure evaluation."""
import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conftest import SF0001
from gapwise.operators import gaps
from gapwise.plans.backfill import calendar, evaluate_dates
from gapwise.plans.measures import CATALOG, Evidence, MeasureSpec, MeasureTables, evaluate_all, evaluate_each
from gapwise.plans.queries import generated_catalog
from gapwise.plans.run import current_run_log, current_state, run_backfill, run_measures
from gapwise.plans.valuesets import evaluate_catalog, signed
from gapwise.sources.fixtures import RUN_DATE, star_clinical_tables
from gapwise.sources.store import TableStore


@pytest.fixture(scope="module")
def tables(spark):
    return MeasureTables.of(star_clinical_tables(spark, SF0001))


def _rows(df):
    return sorted(map(tuple, df.select("measure_id", "patient_id", "in_numerator", "last_evidence_date").collect()),
                  key=repr)


def test_generated_catalog_equals_measure_by_measure(spark, tables):
    catalog = generated_catalog(200)[::5] + generated_catalog(200)[64:67]
    catalog = list({m.id: m for m in catalog}.values())
    assert _rows(evaluate_catalog(tables, RUN_DATE, catalog, spark)) == _rows(evaluate_each(tables, RUN_DATE, catalog))
    assert _rows(evaluate_catalog(tables, RUN_DATE, CATALOG, spark)) == _rows(evaluate_all(tables, RUN_DATE))


def _nodes(df):
    plan = df._jdf.queryExecution().optimizedPlan()
    return plan.toString().count("\n"), max(len(line) for line in plan.toString().split("\n"))


def test_plan_does_not_grow_with_the_catalog(spark, tables):
    few, many = (evaluate_catalog(tables, RUN_DATE, generated_catalog(n), spark) for n in (8, 200))
    assert _nodes(few) == _nodes(many)


def test_words_at_their_edges(spark, tables):
    assert signed((1 << 64) - 1) == -1 and signed(1 << 63) == -(1 << 63) and signed(5) == 5
    one = MeasureSpec("M", "m", 0, 130, (Evidence("Procedure", ("x",), 1200),))
    catalog = [MeasureSpec(f"M{i:03d}", "m", 0, 130, one.evidence) for i in range(130)]
    got = evaluate_catalog(tables, RUN_DATE, catalog, spark)
    want = _rows(evaluate_each(tables, RUN_DATE, [one]))
    assert got.groupBy("measure_id").count().select("count").distinct().collect()[0][0] == len(want)
    for name in ("M000", "M063", "M064", "M127", "M129"):
        assert [r[1:] for r in _rows(got.where(F.col("measure_id") == name))] == [r[1:] for r in want]
    with pytest.raises(ValueError):
        evaluate_catalog(tables, RUN_DATE, [one, one], spark)


def test_many_dates_equal_date_by_date(spark, tables):
    dates = [dt.date(1996, 2, 29), dt.date(1997, 2, 28), dt.date(1999, 8, 31), dt.date(2000, 2, 29),
             dt.date(2000, 3, 31), dt.date(2001, 8, 1)]
    got = evaluate_dates(tables, [*reversed(dates), "2000-02-29"], spark).cache()
    assert {r[0] for r in got.select("run_date").distinct().collect()} == set(dates)
    for d in dates:
        assert _rows(got.where(F.col("run_date") == F.lit(d))) == _rows(evaluate_all(tables, d))
    with pytest.raises(ValueError):
        evaluate_dates(tables, [], spark)


def test_tables_are_ranked_once_for_many_dates(spark, tables):
    dates = [dt.date(1995, 1, 1) + dt.timedelta(days=30 * k) for k in range(80)]
    few, many = (evaluate_dates(tables, d, spark) for d in (dates[:2], dates))
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (few, many)]
    assert plans[0].count("\n") == plans[1].count("\n")
    assert plans[1].count("WindowGroupLimit") == 4


def test_calendar_against_direct_intervals(spark):
    dates = [dt.date(2000, 1, 31), dt.date(2000, 2, 29), dt.date(2000, 3, 31), dt.date(2001, 2, 28)]
    rows = {(r["day"], r["months"]): (r["first"], r["last"]) for r in calendar(spark, dates, [1, 12]).collect()}
    lows = spark.createDataFrame([(d,) for d in dates], "d DATE").select(
        "d", F.add_months("d", -1).alias("l1"), F.add_months("d", -12).alias("l12")).collect()
    for k in range(800):
        day = dates[0] - dt.timedelta(days=380) + dt.timedelta(days=k)
        for months, low in ((1, "l1"), (12, "l12")):
            inside = [n for n, r in enumerate(sorted(lows)) if r[low] <= day <= r["d"]]
            want = (inside[0], inside[-1]) if inside else None
            assert rows.get((day, months)) == want


def test_backfill_equals_runs_one_after_the_other(spark, tables, tmp_dir):
    now = dt.datetime(2002, 1, 1)
    days = [dt.date(2000, 8, 1), dt.date(2001, 8, 1), dt.date(1999, 8, 1), dt.date(2000, 8, 1)]
    one, all_at_once = TableStore(spark, f"{tmp_dir}/a"), TableStore(spark, f"{tmp_dir}/b")
    for k, d in enumerate(days):
        run_measures(spark, tables, d, one, now=now + dt.timedelta(hours=k), run_id=f"r{k}")
    for part in (slice(0, 1), slice(1, 4)):
        run_backfill(spark, tables, [(f"r{k}", d, now + dt.timedelta(hours=k)) for k, d in enumerate(days)][part], all_at_once)
    assert sorted(current_state(one).collect()) == sorted(current_state(all_at_once).collect())
    assert sorted(current_run_log(one).collect()) == sorted(current_run_log(all_at_once).collect())


def test_backfill_failure_publishes_nothing(spark, tables, tmp_dir):
    store = TableStore(spark, tmp_dir)
    broken = [MeasureSpec("M", "m", 0, 130, (Evidence("Procedure", ("x",), 12),))]
    bad = MeasureTables({"Procedure": tables.latest("Procedure").drop("performed"), "Patient": tables.latest("Patient")})
    with pytest.raises(Exception):
        run_backfill(spark, bad, [("r1", dt.date(2000, 1, 1), dt.datetime(2000, 1, 1))], store, broken)
    assert store.current_version("care_gap") is None
    assert [(r.id, r.status, r.error is not None) for r in current_run_log(store).collect()] == [("r1", "FAILED", True)]


def test_runs_in_one_upsert_keep_gaps_of_no_run(spark):
    at = dt.datetime(2000, 1, 1)
    state = spark.createDataFrame([(7, "M", "old", "OPEN", None, at, at), (9, "M", "both", "OPEN", None, at, at)],
                                  gaps.CARE_GAP_SCHEMA)
    later = [at + dt.timedelta(days=k) for k in (1, 2)]
    evals = [spark.createDataFrame(rows, "measure_id STRING, patient_id STRING, in_numerator BOOLEAN, last_evidence_date DATE")
             .withColumns({"seq": F.lit(k), "at": F.lit(later[k])})
             for k, rows in enumerate(([("M", "both", True, dt.date(1999, 1, 1)), ("M", "z", False, None)],
                                       [("M", "a", True, None), ("M", "both", False, None)]))]
    got = {r.patient_id: (r.id, r.status, r.first_identified_at, r.last_evaluated_at)
           for r in gaps.upsert_runs(state, reduce(DataFrame.unionByName, evals)).collect()}
    assert got == {"old": (7, "OPEN", at, at), "both": (9, "OPEN", at, later[1]),
                   "z": (10, "OPEN", later[0], later[0]), "a": (11, "CLOSED", later[1], later[1])}
