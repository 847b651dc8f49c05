"""Many run dates in one ranked pass (M4 and G8 for a backfill).

Evaluating a catalog date by date reads and ranks every table once per date.
Here the tables are ranked once. An evidence day counts for the run dates from
the first one on or after it to the last one whose look-back still holds it, an
interval of the sorted run dates. A calendar of the days that matter, a few
thousand rows however long the tables are, gives that interval for every day and
look-back length by an equi-join.

Of the days that begin to count at the same run date only the newest can matter,
so (patient, measure, look-back, first date) keeps one row. A later row hides the
ones before it (running maximum), which makes the intervals of one patient,
measure and look-back disjoint; only the dates in them are expanded, no more rows
than the result has for each look-back.

A population is an interval of run dates too: those in whose year the patient has
an age of the measure.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapwise.functions.expr import safe_date, safe_ts, utc_date
from gapwise.plans.measures import CATALOG, DATE_FIELD, MeasureSpec, MeasureTables, run_date_of

MAX_BROADCAST_ROWS = 200_000
_DAYS_A_MONTH = 31


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= MAX_BROADCAST_ROWS else table


def _dates(run_dates: Sequence[dt.date]) -> Column:
    """The run dates as one array; a literal whose plan does not grow with them."""
    return F.split(F.lit(",".join(d.isoformat() for d in run_dates)), ",").cast("array<date>")


def calendar(spark: SparkSession, run_dates: Sequence[dt.date], months: Sequence[int]) -> DataFrame:
    """(day, months, first, last): the run dates, by number, for which a day is in the look-back."""
    start = run_dates[0] - dt.timedelta(days=_DAYS_A_MONTH * max(months))
    days = (run_dates[-1] - start).days + 1
    runs, day = _dates(run_dates), F.col("day")
    look_back = F.explode(F.array(*[F.lit(m) for m in sorted(set(months))])).alias("months")
    table = (spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"), look_back)
             .select("day", "months", F.size(F.filter(runs, lambda r: r < day)).alias("first"),
                     (F.size(F.filter(runs, lambda r: F.add_months(r, -F.col("months")) <= day)) - 1).alias("last"))
             .where("first <= last"))
    return _small(table, days * len(set(months)))


def _catalog_rows(spark: SparkSession, catalog: Sequence[MeasureSpec]) -> DataFrame:
    rows = [(m.id, ev.resource, code, ev.system, ev.months) for m in catalog for ev in m.evidence for code in ev.codes]
    table = spark.createDataFrame(rows, "measure_id STRING, resource STRING, code STRING, system STRING, months INT")
    return _small(table, len(rows))


def evidence_intervals(tables: MeasureTables, spark: SparkSession, run_dates: Sequence[dt.date],
                       catalog: Sequence[MeasureSpec]) -> DataFrame:
    """(measure_id, patient_id, months, first, until, day), disjoint per patient, measure and look-back."""
    rows = None
    for resource in sorted({ev.resource for m in catalog for ev in m.evidence}):
        day = utc_date(safe_ts(F.col(DATE_FIELD[resource]))).alias("day")
        own = (tables.latest(resource, F.col("subject.patientId").alias("patient_id"), day,
                             F.col("code.coding").alias("coding"))
               .where(F.col("day").isNotNull() & (F.col("day") <= F.lit(run_dates[-1])))
               .select("patient_id", "day", F.explode("coding").alias("c"))
               .select("patient_id", "day", F.col("c.system").alias("own"), "c.code", F.lit(resource).alias("resource")))
        rows = own if rows is None else rows.unionByName(own)
    hits = (rows.join(_catalog_rows(spark, catalog), ["resource", "code"])
            .where(F.col("system").isNull() | (F.col("system") == F.col("own"))))
    months = [ev.months for m in catalog for ev in m.evidence]
    key = ["measure_id", "patient_id", "months"]
    newest = (hits.join(calendar(spark, run_dates, months), ["day", "months"])
              .groupBy(*key, "first").agg(F.max("day").alias("day"), F.max("last").alias("last")))
    following = F.lead("first").over(Window.partitionBy(*key).orderBy("first"))
    return newest.withColumn("until", F.least("last", F.coalesce(following - 1, F.col("last")))).drop("last")


def population_intervals(tables: MeasureTables, spark: SparkSession, run_dates: Sequence[dt.date],
                         catalog: Sequence[MeasureSpec]) -> DataFrame:
    """(measure_id, patient_id, first, until): the run dates at which a patient is in a measure's population."""
    specs = [(m.id, m.min_age, m.max_age, m.gender) for m in catalog]
    years = [d.year for d in run_dates]
    # one row per birth year and measure that it can serve
    rows = []
    for name, low, high, gender in specs:
        for born in range(years[0] - high, years[-1] - low + 1):
            inside = [k for k, y in enumerate(years) if low <= y - born <= high]
            if inside:
                rows.append((born, name, gender, inside[0], inside[-1]))
    bands = _small(spark.createDataFrame(
        rows, "born INT, measure_id STRING, gender STRING, first INT, until INT"), len(rows))
    people = (tables.latest("Patient", F.col("gender").alias("own"), safe_date(F.col("birthDate")).alias("birth"))
              .select(F.col("id").alias("patient_id"), "own", F.year("birth").alias("born")))
    members = (people.join(bands, "born").where(F.col("gender").isNull() | (F.col("gender") == F.col("own")))
               .select("measure_id", "patient_id", "first", "until"))
    asked = [(m.id, code) for m in catalog for code in m.condition_codes]
    if not asked:
        return members
    wanted = spark.createDataFrame(asked, "measure_id STRING, code STRING")
    met = (tables.latest("Condition", F.col("subject.patientId").alias("patient_id"), F.col("code.coding").alias("coding"))
           .select("patient_id", F.explode("coding.code").alias("code"))
           .join(_small(wanted, len(asked)), "code").select("measure_id", "patient_id").distinct())
    conditional = F.col("measure_id").isin([m.id for m in catalog if m.condition_codes])
    return (members.join(met.withColumn("met", F.lit(True)), ["measure_id", "patient_id"], "left")
            .where(~conditional | F.col("met")).drop("met"))


def evaluate_dates(tables: MeasureTables, run_dates: Sequence, spark: SparkSession,
                   catalog: Sequence[MeasureSpec] = CATALOG) -> DataFrame:
    """``evaluate_all`` for each of ``run_dates``, with a column run_date; every table is ranked once."""
    dates = sorted({run_date_of(d) for d in run_dates})
    if not dates:
        raise ValueError("no run dates")
    key = ["measure_id", "patient_id", "run"]

    def at_each(intervals: DataFrame) -> DataFrame:
        return intervals.withColumn("run", F.explode(F.sequence("first", "until")))

    seen = (at_each(evidence_intervals(tables, spark, dates, catalog))
            .groupBy(*key).agg(F.max("day").alias("last_evidence_date")))
    members = at_each(population_intervals(tables, spark, dates, catalog)).select(*key)
    return (members.join(seen, key, "left")
            .select(F.element_at(_dates(dates), F.col("run") + 1).alias("run_date"), "measure_id", "patient_id",
                    F.col("last_evidence_date").isNotNull().alias("in_numerator"), "last_evidence_date"))
