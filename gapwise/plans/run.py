"""One measure run end to end (flagship job).

``run_measures`` evaluates the whole catalog for a run date, upserts the gap
state and commits it as a new snapshot, optionally writes the issue documents,
and records the run lifecycle. All measures publish in one snapshot commit,
so a failure part-way leaves the previous state in place (the reference
writes measure by measure; this is a deliberate, stronger behaviour).

The evaluations are checkpointed once (shared folder): they feed the upsert,
the counts and the issue documents, and the checkpoint cuts the lineage so a
lost executor does not re-run the measures.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.operators import checks, gaps, issues, runs
from gapwise.plans.backfill import evaluate_dates
from gapwise.plans.measures import CATALOG, assert_contract, evaluate_all, run_date_of
from gapwise.plans.sqlfiles import MeasureDefinition, evaluate_sql_catalog
from gapwise.session import checkpoint_root
from gapwise.sources.measure_dim import measure_dim
from gapwise.sources.store import TableStore


def _utcnow() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def evaluate(spark: SparkSession, source, run_date, catalog) -> DataFrame:
    """Evaluations of a catalog: specs over ``MeasureTables``, or SQL measures
    (:class:`MeasureDefinition`) over the name of a dataset."""
    if all(isinstance(m, MeasureDefinition) for m in catalog):
        return evaluate_sql_catalog(spark, source, run_date, list(catalog))
    return evaluate_all(source, run_date, catalog)


def run_measures(spark: SparkSession, source, run_date, store: TableStore,
                 now: dt.datetime | None = None, run_id: str | None = None, catalog=CATALOG,
                 issues_path: str | None = None,
                 code_system: str = issues.DEFAULT_MEASURE_CODE_SYSTEM, bucketed: bool = False) -> dict:
    """Evaluate ``catalog`` over ``source`` (see :func:`evaluate`) and publish the result.

    The run fails, and publishes nothing, if the result lacks a contract
    column, names an unknown measure or repeats a key, or if another run has
    committed in the meantime. ``bucketed`` keeps the state in buckets of its key
    instead of measure partitions, so the upsert moves the evaluations only.
    """
    run_date = run_date_of(run_date)
    started = now or _utcnow()
    run_id = run_id or runs.new_run_id()
    store.append("measure_run", runs.run_started(spark, run_id, run_date, started))
    try:
        checkpoint_root(spark)
        evals = assert_contract(evaluate(spark, source, run_date, catalog)).checkpoint(eager=True)
        dim = measure_dim(spark)
        if checks.check_fk(evals, "measure_id", dim).limit(1).count() > 0:
            raise ValueError("evaluated measure is not in the measure dimension")
        state = store.read("care_gap", gaps.CARE_GAP_SCHEMA)
        buckets = gaps.state_buckets(spark, store.current("care_gap")) if bucketed else None
        new_state = gaps.upsert_gaps(state, evals, now or _utcnow(),
                                     max_id=store.stats("care_gap").get("max_id"), buckets=buckets and buckets.n)
        version = store.commit("care_gap", new_state, note=f"run {run_id}",
                               partition_by=None if bucketed else ["measure_id"],
                               stats=gaps.state_stats(), buckets=buckets)
        if issues_path:
            docs = issues.issue_document(issues.issue_rows(evals, dim, run_date, code_system))
            issues.write_issues(docs, issues_path, version)
        summary = gaps.run_summary(evals, len(catalog))
        done = now or _utcnow()
        store.append("measure_run", runs.run_completed(summary, run_id, run_date, started, done))
        row = summary.first()  # three numbers for the caller
        return {"run_id": run_id, "measures_evaluated": row["measures_evaluated"],
                "gaps_open": row["gaps_open"], "gaps_closed": row["gaps_closed"]}
    except Exception as e:
        msg = str(e) or type(e).__name__
        store.append("measure_run", runs.run_failed(spark, run_id, run_date, started,
                                                     now or _utcnow(), msg))
        raise


def run_backfill(spark: SparkSession, tables, deliveries: list[tuple], store: TableStore, catalog=CATALOG) -> None:
    """Whole-population runs for ``deliveries`` of (run id, run date, time), in that order.

    The dates are evaluated in one pass over the tables; the gap state is
    committed once, as it is after the last run; every delivery gets its own
    run row with its counts. A failure fails all of them and publishes nothing.
    """
    rows = [(run_id, run_date_of(day), at, seq) for seq, (run_id, day, at) in enumerate(deliveries)]
    wanted = spark.createDataFrame(rows, "id STRING, run_date DATE, at TIMESTAMP, seq INT")
    none = F.lit(None)

    def log(df: DataFrame, status: str, step: int, **columns) -> None:
        given = {"started_at": F.col("at"), "completed_at": none, "status": F.lit(status), "error": none,
                 "gaps_open": none, "gaps_closed": none, "step": F.lit(step)} | columns
        store.append("measure_run", df.withColumns(given).select(
            *[F.col(f.name).cast(f.dataType) for f in runs.LOG_SCHEMA.fields]))

    log(wanted, "RUNNING", 0)
    try:
        checkpoint_root(spark)
        evals = evaluate_dates(tables, [r[1] for r in rows], spark, catalog).checkpoint()
        per_run = F.broadcast(wanted.drop("id"))  # one row a delivery, from the driver
        state = store.read("care_gap", gaps.CARE_GAP_SCHEMA)
        new_state = gaps.upsert_runs(state, evals.join(per_run, "run_date"), store.stats("care_gap").get("max_id"))
        store.commit("care_gap", new_state, note=f"{len(rows)} runs", partition_by=["measure_id"],
                     stats=gaps.state_stats())
        counts = evals.groupBy("run_date").agg(F.count_if(~F.col("in_numerator")).alias("open"),
                                               F.count_if("in_numerator").alias("closed"))
        zero = F.lit(0).cast("bigint")
        log(wanted.join(counts, "run_date", "left"), "SUCCEEDED", 1, completed_at=F.col("at"),
            gaps_open=F.coalesce("open", zero), gaps_closed=F.coalesce("closed", zero))
    except Exception as e:
        message = (str(e) or type(e).__name__)[:runs.ERROR_MAX_CHARS]
        log(wanted, "FAILED", 1, completed_at=F.col("at"), error=F.lit(message))
        raise


def current_state(store: TableStore):
    return store.read("care_gap", gaps.CARE_GAP_SCHEMA)


def current_run_log(store: TableStore):
    return runs.current_runs(store.read_log("measure_run", runs.LOG_SCHEMA))
