"""Registered queries over gap state built by two successive runs.

Run 1 evaluates the catalog as of 2000-08-01, run 2 as of 2001-08-01, both on
the whole clinical tables, so every transition occurs: new gaps, open→closed,
closed→open, unchanged, and gaps of patients who left the population (kept,
untouched). Clocks are fixed so results are reproducible.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.operators import checks, gaps, issues, runs, serving
from gapwise.plans.measures import CATALOG, MeasureTables, RankedTables, evaluate_all, rank_tables
from gapwise.plans.run import current_state, run_measures
from gapwise.plans.sqlfiles import load_measures, register_dataset
from gapwise.session import scratch_path
from gapwise.sources.fixtures import RUN_DATE, star_clinical_tables
from gapwise.sources.measure_dim import measure_dim
from gapwise.sources.store import TableStore
from gapwise.sources.tables import read_table

RUN1 = dt.date(2000, 8, 1)
RUN2 = RUN_DATE
NOW1 = dt.datetime(2000, 8, 1, 6, 0)
NOW2 = dt.datetime(2001, 8, 1, 6, 0)
RUN_TIME = dt.timedelta(minutes=5)
DRILL_PATIENT = "p-105"


class TwoRuns:
    """The two runs over the star tables; ``evals1`` and ``evals2`` are lazy plans.

    Both read the tables ranked once and kept, however often they are evaluated.
    """

    def __init__(self, spark, sf_dir):
        self.spark = spark
        self._t = MeasureTables.of(star_clinical_tables(spark, sf_dir))
        self.dim = measure_dim(spark)

    @cached_property
    def ranked(self) -> RankedTables:
        return rank_tables(self._t).kept(scratch_path(self.spark, "ranked"))

    @cached_property
    def evals1(self) -> DataFrame:
        return evaluate_all(self.ranked, RUN1)

    @cached_property
    def evals2(self) -> DataFrame:
        return evaluate_all(self.ranked, RUN2)

    @cached_property
    def store(self) -> TableStore:
        """A store in which both runs have been committed, as two real runs do."""
        store = TableStore(self.spark, scratch_path(self.spark, "gaps"))
        for evals, now in ((self.evals1, NOW1), (self.evals2, NOW2)):
            state = store.read("care_gap", gaps.CARE_GAP_SCHEMA)
            store.commit("care_gap", gaps.upsert_gaps(state, evals, now, max_id=store.stats("care_gap").get("max_id")),
                         partition_by=["measure_id"], stats=gaps.state_stats())
        return store

    def state(self) -> DataFrame:
        return self.store.read("care_gap", gaps.CARE_GAP_SCHEMA)

    def run_log(self) -> DataFrame:
        parts = []
        for rd, now, ev in ((RUN1, NOW1, self.evals1), (RUN2, NOW2, self.evals2)):
            rid = f"run-{rd.isoformat()}"
            parts.append(runs.run_started(self.spark, rid, rd, now))
            parts.append(runs.run_completed(gaps.run_summary(ev, len(CATALOG)), rid, rd, now,
                                            now + RUN_TIME))
        return runs.current_runs(reduce(DataFrame.unionByName, parts))


def second_run(spark, sf_dir) -> DataFrame:
    """Evaluations of run 2 alone, for queries that read them once."""
    return evaluate_all(MeasureTables.of(star_clinical_tables(spark, sf_dir)), RUN2)


def _orders(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")


def order_runs(spark, sf_dir) -> DataFrame:
    """Run-log rows from the orders: one run per order date, started at midnight.

    By day of the month: every 5th day's run failed, every 7th is still
    running, the others succeeded with the day's O and other orders as counts.
    """
    day = F.to_date("o_orderdate")
    per_day = _orders(spark, sf_dir).groupBy(day.alias("run_date")).agg(
        F.count_if(F.col("o_orderstatus") == "O").cast("int").alias("gaps_open"),
        F.count_if(F.col("o_orderstatus") != "O").cast("int").alias("gaps_closed"))
    n = F.dayofmonth("run_date")
    rid, start = F.concat(F.lit("day-"), F.col("run_date").cast("string")), F.col("run_date").cast("timestamp")
    none = F.lit(None)
    started = per_day.select(
        rid.alias("id"), "run_date", start.alias("started_at"), none.cast("timestamp").alias("completed_at"),
        F.lit("RUNNING").alias("status"), none.cast("string").alias("error"),
        none.cast("int").alias("gaps_open"), none.cast("int").alias("gaps_closed"), F.lit(0).alias("step"))
    failed = n % 5 == 0
    ended = per_day.where(n % 7 != 0).select(
        rid.alias("id"), "run_date", start.alias("started_at"),
        (start + F.expr("INTERVAL 5 MINUTE")).alias("completed_at"),
        F.when(failed, F.lit("FAILED")).otherwise(F.lit("SUCCEEDED")).alias("status"),
        F.when(failed, F.concat(F.lit("no data for "), F.col("run_date").cast("string"))).alias("error"),
        F.when(~failed, F.col("gaps_open")).alias("gaps_open"),
        F.when(~failed, F.col("gaps_closed")).alias("gaps_closed"), F.lit(1).alias("step"))
    return started.unionByName(ended)


def run_history(spark, sf_dir):
    """Run log with failed and unfinished runs, written to the store and read as status lines."""
    store = TableStore(spark, scratch_path(spark, "runs"))
    store.append("measure_run", order_runs(spark, sf_dir))
    return serving.run_freshness(runs.current_runs(store.read_log("measure_run", runs.LOG_SCHEMA)))


def constraint_violations(spark, sf_dir):
    """Every kind of violation, made from the orders by the order key's last digit: 1 an unknown
    measure, 2 an unknown status, 3 the id of the order before, 4 no patient, 5 a second row of the
    key, 6 no status; runs: day 3 and 4 of a month share an id, day 9 has an unknown status."""
    o = _orders(spark, sf_dir)
    k, r = F.col("o_orderkey"), F.col("o_orderkey") % 10
    at = F.col("o_orderdate").cast("timestamp")
    base = o.select(
        F.when(r == 3, k - 1).otherwise(k).alias("id"),
        F.when(r == 1, F.lit("UNKNOWN")).otherwise(F.lit("CDC_A1C")).alias("measure_id"),
        F.when(r != 4, F.concat(F.lit("o-"), k.cast("string"))).alias("patient_id"),
        F.when(r == 2, F.lit("HALF")).when(r != 6, F.lit("OPEN")).alias("status"),
        F.lit(None).cast("date").alias("last_evidence_date"), at.alias("first_identified_at"),
        at.alias("last_evaluated_at"), F.when(r == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("c"))
    dirty = base.withColumn("c", F.explode("c")).withColumn("id", F.when(F.col("c") == 1, -F.col("id")).otherwise(F.col("id")))
    n = F.dayofmonth("run_date")
    rows = runs.current_runs(order_runs(spark, sf_dir)).withColumns({
        "id": F.when(n.isin(3, 4), F.date_format("run_date", "yyyy-MM")).otherwise(F.col("id")),
        "status": F.when(n == 9, F.lit("LOST")).otherwise(F.col("status"))})
    return checks.constraint_report(dirty.drop("c"), rows, measure_dim(spark))


def issue_id_quarantine(spark, sf_dir):
    """Issue ids of customers by name (its # is not allowed), by key, or by a key that makes it too long."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    k = F.col("c_custkey")
    evals = c.select(F.lit("BCS_MAMMOGRAPHY").alias("measure_id"),
                     F.when(k % 3 == 0, F.col("c_name")).when(k % 3 == 1, F.concat(F.lit("p-"), k.cast("string")))
                     .otherwise(F.lpad(k.cast("string"), 60, "0")).alias("patient_id"))
    return issues.invalid_issue_ids(evals)


def issue_store(spark, sf_dir):
    """Issues of both runs put into the sink, the second twice, and the current ones read back."""
    r = TwoRuns(spark, sf_dir)
    path = scratch_path(spark, "issues")
    for seq, rd, evals in ((1, RUN1, r.evals1), (2, RUN2, r.evals2), (2, RUN2, r.evals2)):
        issues.write_issues(issues.issue_document(issues.issue_rows(evals, r.dim, rd)), path, seq)
    doc = F.from_json("json", "identifiedDateTime STRING, detail STRING")
    return issues.read_issues(spark, path).select(
        "measure_id", "id", "seq", doc["identifiedDateTime"].alias("identified"), doc["detail"].alias("detail"))


def sql_run_state(spark, sf_dir):
    """The gap state after a real run of the SQL-file measures."""
    store = TableStore(spark, scratch_path(spark, "sqlrun"))
    dataset = register_dataset(star_clinical_tables(spark, sf_dir))
    run_measures(spark, dataset, RUN2, store, now=NOW2, run_id="sql", catalog=load_measures())
    return current_state(store)


def gap_status(spark, sf_dir):
    return gaps.to_gap_rows(second_run(spark, sf_dir))


def gap_state(spark, sf_dir):
    return TwoRuns(spark, sf_dir).state()


def bucketed_gap_state(spark, sf_dir):
    """The gap state after two real runs that keep it in buckets of its key, so that neither reads it through an exchange."""
    store = TableStore(spark, scratch_path(spark, "buckets"))
    tables = MeasureTables.of(star_clinical_tables(spark, sf_dir))
    for day, now in ((RUN1, NOW1), (RUN2, NOW2)):
        run_measures(spark, tables, day, store, now=now, run_id=str(day), bucketed=True)
    return current_state(store)


def gap_batch_dedup(spark, sf_dir):
    r = TwoRuns(spark, sf_dir)
    batch = (r.evals1.withColumn("seq", F.lit(1))
             .unionByName(r.evals2.withColumn("seq", F.lit(2))))
    return gaps.last_per_key(batch, "seq")


def gap_counts(spark, sf_dir):
    return gaps.gap_counts(second_run(spark, sf_dir))


def run_summary(spark, sf_dir):
    return gaps.run_summary(second_run(spark, sf_dir), len(CATALOG))


def run_log(spark, sf_dir):
    return TwoRuns(spark, sf_dir).run_log()


def constraint_report(spark, sf_dir):
    r = TwoRuns(spark, sf_dir)
    return checks.constraint_report(r.state(), r.run_log(), r.dim)


def search_gaps_page(spark, sf_dir):
    s = TwoRuns(spark, sf_dir).state()
    return serving.page(serving.search_gaps(s, status="OPEN"), 1, 50)


def search_gaps_keyset(spark, sf_dir):
    """R3 by keyset: the 50 OPEN gaps after (run-2 time, id 1000) in the fixed order."""
    s = TwoRuns(spark, sf_dir).state()
    return serving.page_after(serving.search_gaps(s, status="OPEN"), (NOW2, 1000), 50)


def search_gaps_deep(spark, sf_dir):
    """R3 by selection: page 20 of all gaps, found by counting ranges of the sort key."""
    return serving.deep_page(TwoRuns(spark, sf_dir).state(), 20, 50, select_rows=100)


def summary_deltas(spark, sf_dir):
    """The counts per measure and status, kept by what each of the two runs changes in them."""
    r = TwoRuns(spark, sf_dir)
    store = TableStore(spark, scratch_path(spark, "summary"))
    for evals, now in ((r.evals1, NOW1), (r.evals2, NOW2)):
        state = store.read("care_gap", gaps.CARE_GAP_SCHEMA)
        new, deltas = gaps.upsert_with_deltas(state, evals, now, max_id=store.stats("care_gap").get("max_id"))
        store.commit("care_gap", new, partition_by=["measure_id"], stats=gaps.state_stats())
        counts = store.read("gap_summary", gaps.SUMMARY_SCHEMA)
        store.commit("gap_summary", gaps.apply_deltas(counts, deltas))
    return store.read("gap_summary", gaps.SUMMARY_SCHEMA)


def commit_rejects(spark, sf_dir):
    """What a batch made from the orders breaks, by the order key's last digit: 1 an unknown measure, 2 an
    unknown status, 3 the stored id of the order before, 4 no patient, 5 twice the same key, 6 no status,
    7 a key stored under another id; the stored table (every order but those ending in 9) stays at version 1."""
    o = _orders(spark, sf_dir)
    k, r = F.col("o_orderkey"), F.col("o_orderkey") % 10
    at = F.col("o_orderdate").cast("timestamp")
    clean = o.select(k.alias("id"), F.lit("CDC_A1C").alias("measure_id"), F.concat(F.lit("o-"), k.cast("string")).alias("patient_id"),
                     F.lit("OPEN").alias("status"), F.lit(None).cast("date").alias("last_evidence_date"),
                     at.alias("first_identified_at"), at.alias("last_evaluated_at"), r.alias("r"))
    store, dim = TableStore(spark, scratch_path(spark, "checked")), measure_dim(spark)
    checks.commit_checked(store, "care_gap", clean.where("r <> 9").drop("r"), dim, gaps.CARE_GAP_SCHEMA)
    bad = clean.withColumns({
        "id": F.when(F.col("r") == 3, F.col("id") - 1).when(F.col("r") == 7, -F.col("id")).otherwise(F.col("id")),
        "measure_id": F.when(F.col("r") == 1, F.lit("UNKNOWN")).otherwise(F.col("measure_id")),
        "patient_id": F.when(F.col("r") != 4, F.col("patient_id")),
        "status": F.when(F.col("r") == 2, F.lit("HALF")).when(F.col("r") != 6, F.col("status")),
        "twice": F.explode(F.when(F.col("r") == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))})
    try:
        checks.commit_checked(store, "care_gap", bad.drop("r", "twice"), dim, gaps.CARE_GAP_SCHEMA)
    except checks.ConstraintViolation as e:
        return (e.rejects.select(F.explode("broken").alias("check_name")).groupBy("check_name")
                .agg(F.count(F.lit(1)).alias("violations"))
                .withColumn("version", F.lit(store.current_version("care_gap")).cast("bigint")))
    raise AssertionError("the batch has been taken")


def page_info(spark, sf_dir):
    s = TwoRuns(spark, sf_dir).state()
    return serving.page_info(serving.search_gaps(s, status="CLOSED", measure_id="COL_SCREENING"), 25)


def gap_summary(spark, sf_dir):
    return serving.gap_summary(TwoRuns(spark, sf_dir).state())


def scorecard(spark, sf_dir):
    r = TwoRuns(spark, sf_dir)
    return serving.scorecard(serving.gap_summary(r.state()), r.dim)


def recent_runs(spark, sf_dir):
    return serving.recent_runs(TwoRuns(spark, sf_dir).run_log())


def run_freshness(spark, sf_dir):
    return serving.run_freshness(TwoRuns(spark, sf_dir).run_log())


def patient_gaps(spark, sf_dir):
    return serving.patient_gaps(TwoRuns(spark, sf_dir).state(), DRILL_PATIENT)


def issue_documents(spark, sf_dir):
    return issues.issue_rows(second_run(spark, sf_dir), measure_dim(spark), RUN2)


def invalid_issue_ids(spark, sf_dir):
    return issues.invalid_issue_ids(second_run(spark, sf_dir))


def issue_bundles(spark, sf_dir):
    rows = issues.issue_rows(second_run(spark, sf_dir), measure_dim(spark), RUN2)
    return issues.flat_chunks(issues.chunk_issues(issues.issue_document(rows)))


GAP_QUERIES = {
    "gap_status": gap_status,
    "gap_state": gap_state,
    "bucketed_gap_state": bucketed_gap_state,
    "gap_batch_dedup": gap_batch_dedup,
    "gap_counts": gap_counts,
    "run_summary": run_summary,
    "run_log": run_log,
    "constraint_report": constraint_report,
    "search_gaps_page": search_gaps_page,
    "search_gaps_keyset": search_gaps_keyset,
    "search_gaps_deep": search_gaps_deep,
    "summary_deltas": summary_deltas,
    "commit_rejects": commit_rejects,
    "page_info": page_info,
    "gap_summary": gap_summary,
    "scorecard": scorecard,
    "recent_runs": recent_runs,
    "run_freshness": run_freshness,
    "patient_gaps": patient_gaps,
    "issue_documents": issue_documents,
    "invalid_issue_ids": invalid_issue_ids,
    "issue_bundles": issue_bundles,
    "issue_store": issue_store,
    "issue_id_quarantine": issue_id_quarantine,
    "run_history": run_history,
    "constraint_violations": constraint_violations,
    "sql_run_state": sql_run_state,
}
