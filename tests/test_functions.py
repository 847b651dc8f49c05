"""Scalar expressions: safe casts, dates, code tests, ids."""
import datetime as dt

from pyspark.sql import functions as F

from gapwise.functions.expr import (gap_status, has_code, in_lookback, is_valid_fhir_id, issue_id,
                                    months_before, safe_date, safe_ts, utc_date, year_diff)


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_safe_date_rejects_partial_dates(spark):
    out = one(spark, safe_date(F.col("s")), [("1970",), ("1970-05",), ("1970-05-01",),
                                              ("1970-5-1",), ("junk",), (None,),
                                              ("1970-05-01T10:00:00Z",), ("1970-02-30",)], "s string")
    assert out == [None, None, dt.date(1970, 5, 1), dt.date(1970, 5, 1), None, None, None, None]


def test_safe_ts_and_utc_date(spark):
    out = one(spark, utc_date(safe_ts(F.col("s"))),
              [("2020-01-01T23:30:00-05:00",), ("2020-01-01",), ("T10:00:00",), ("2020",),
               ("2020-01-01T10:00:00Z",), ("2020-01-01 10:00:00",), ("2020-01-01T10:00",)],
              "s string")
    assert out == [dt.date(2020, 1, 2), dt.date(2020, 1, 1), None, None, dt.date(2020, 1, 1),
                   dt.date(2020, 1, 1), None]


def test_year_diff_counts_year_boundaries(spark):
    out = one(spark, year_diff(F.col("e"), F.col("s")),
              [(dt.date(2026, 1, 1), dt.date(1976, 12, 31))], "e date, s date")
    assert out == [50]


def test_months_before_clamps_to_month_end(spark):
    out = one(spark, months_before(F.col("d"), 1), [(dt.date(2001, 3, 31),)], "d date")
    assert out == [dt.date(2001, 2, 28)]


def test_lookback_is_closed_at_both_ends(spark):
    rd = dt.date(2001, 8, 1)
    data = [(dt.date(1999, 5, 1),), (dt.date(1999, 4, 30),), (rd,), (dt.date(2001, 8, 2),), (None,)]
    assert one(spark, in_lookback(F.col("d"), rd, 27), data, "d date") == [True, False, True, False, None]


def test_has_code_null_and_empty_are_false(spark):
    schema = "c array<struct<system:string,code:string>>"
    data = [(None,), ([],), ([("s", None)],), ([("http://loinc.org", "4548-4")],),
            ([("http://other", "4548-4")],), ([("a", "x"), ("http://loinc.org", "4548-4")],)]
    assert one(spark, has_code(F.col("c"), ["4548-4"], "http://loinc.org"), data, schema) == \
        [False, False, False, True, False, True]
    assert one(spark, has_code(F.col("c"), ["4548-4"]), data, schema) == \
        [False, False, False, True, True, True]


def test_gap_status_and_issue_ids(spark):
    assert one(spark, gap_status(F.col("b")), [(True,), (False,)], "b boolean") == ["CLOSED", "OPEN"]
    ids = one(spark, issue_id(F.col("m"), F.col("p")), [("BCS_MAMMOGRAPHY", "p-1")], "m string, p string")
    assert ids == ["caregap-bcs-mammography-p-1"]
    ok = one(spark, is_valid_fhir_id(F.col("i")),
             [("caregap-a-b",), ("caregap-a-b c",), ("x" * 64,), ("x" * 65,), (None,)], "i string")
    assert ok == [True, False, True, False, False]
