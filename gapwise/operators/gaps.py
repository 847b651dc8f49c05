"""Gap records: status, keyed upsert, batch counts, run totals.

State is a DataFrame with the ``care_gap`` columns. ``upsert_gaps`` is a pure
function ``(state, evaluations, now) -> state``; persisting it is the job of
``gapwise.sources.store`` (snapshot swap), so a failed run never leaves a
half-written state.

Semantics kept from the gap writer:
* insert sets ``first_identified_at`` and ``last_evaluated_at`` to ``now``;
* update overwrites status, evidence date (also with NULL) and
  ``last_evaluated_at``; ``id`` and ``first_identified_at`` stay;
* keys absent from the batch are left untouched (gaps are never deleted, and
  an older run date replayed later still overwrites newer state);
* inside one batch the last row of a key wins (explicit sequence column); a
  batch without a sequence must not repeat a key.

Scale: the merge is one full outer join on ``(measure_id, patient_id)``; both
keys are in the join so a measure holding most rows does not skew it. New ids
come from :func:`gapwise.operators.ids.dense_index` (distributed, ordered by
key), starting after the current maximum id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.functions.expr import gap_status
from gapwise.operators.ids import dense_index
from gapwise.session import checkpoint_root
from gapwise.sources.store import Buckets, Snapshot

KEY = ["measure_id", "patient_id"]

CARE_GAP_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("measure_id", T.StringType(), False),
    T.StructField("patient_id", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("last_evidence_date", T.DateType(), True),
    T.StructField("first_identified_at", T.TimestampType(), False),
    T.StructField("last_evaluated_at", T.TimestampType(), False),
])
COLUMNS = [f.name for f in CARE_GAP_SCHEMA.fields]
SUMMARY_SCHEMA = T.StructType([T.StructField("measure_id", T.StringType()), T.StructField("status", T.StringType()),
                               T.StructField("gaps", T.LongType())])


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CARE_GAP_SCHEMA)


def to_gap_rows(evals: DataFrame) -> DataFrame:
    """Evaluations → ``(measure_id, patient_id, status, last_evidence_date)`` (G1)."""
    return evals.select("measure_id", "patient_id",
                        gap_status(F.col("in_numerator")).alias("status"),
                        "last_evidence_date")


def last_per_key(evals: DataFrame, seq: str) -> DataFrame:
    """Keep one evaluation per key: the one with the highest ``seq``."""
    w = Window.partitionBy(*KEY).orderBy(F.col(seq).desc())
    return evals.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", seq)


def duplicate_keys(evals: DataFrame) -> DataFrame:
    return evals.groupBy(*KEY).count().where(F.col("count") > 1)


def _one_per_key(rows: DataFrame) -> DataFrame:
    """Fails the job on a key that occurs twice: without a sequence there is no last row."""
    return rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_n"), F.first("status").alias("status"),
        F.first("last_evidence_date").alias("last_evidence_date")
    ).withColumn("status", F.when(F.col("_n") == 1, F.col("status")).otherwise(F.raise_error(
        F.concat(F.lit("duplicate evaluation of "), F.concat_ws("/", *KEY))))).drop("_n")


def _joined(state: DataFrame, evals: DataFrame, now: dt.datetime, seq: str | None) -> DataFrame:
    """State and batch joined once and checkpointed: the new rows without id, ``_old`` the
    status before, ``_hit`` whether the batch has the key."""
    now_c = F.lit(now).cast("timestamp")
    e = to_gap_rows(last_per_key(evals, seq)) if seq else _one_per_key(to_gap_rows(evals))
    s = state.select(*COLUMNS)
    checkpoint_root(state.sparkSession)
    evaluated = F.col("e.status").isNotNull()
    return s.alias("s").join(e.alias("e"), KEY, "full_outer").select(
        F.col("s.id").alias("id"), *KEY,
        F.coalesce("e.status", "s.status").alias("status"),
        F.when(evaluated, F.col("e.last_evidence_date")).otherwise(F.col("s.last_evidence_date"))
         .alias("last_evidence_date"),
        F.coalesce("s.first_identified_at", now_c).alias("first_identified_at"),
        F.when(evaluated, now_c).otherwise(F.col("s.last_evaluated_at")).alias("last_evaluated_at"),
        F.col("s.status").alias("_old"), evaluated.alias("_hit")).checkpoint()


def _numbered(j: DataFrame, max_id: int | None, order: list[str], buckets: int | None = None) -> DataFrame:
    """The joined rows as a state: those without an id get the next ones, in ``order``.

    With ``buckets`` the new rows are dealt by key, as the kept ones are after a
    join with a bucketed state, so that a task writes one bucket's file.
    """
    if max_id is None:
        # A scalar subquery over the joined rows: never collected to the driver.
        start = j.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long")).scalar() + 1
    else:
        start = max_id + 1
    new = dense_index(j.where("id IS NULL").drop("id"), order, name="id", start=start)
    if buckets:
        new = new.repartition(buckets, *KEY)
    return j.where("id IS NOT NULL").select(*COLUMNS).unionByName(new.select(*COLUMNS))


def upsert_gaps(state: DataFrame, evals: DataFrame, now: dt.datetime,
                seq: str | None = None, max_id: int | None = None, buckets: int | None = None) -> DataFrame:
    """New gap state after applying one evaluation batch at time ``now``.

    State and batch are joined once; the result is checkpointed, since both the
    kept rows and the new rows, which get ids, are read from it. ``max_id`` is
    the greatest id of the state, as the store's manifest has it; None
    reads it from the state. Without ``seq`` a key may occur once per batch.
    ``buckets`` says that the result is committed in that many buckets of the key.
    """
    return _numbered(_joined(state, evals, now, seq), max_id, KEY, buckets)


def upsert_with_deltas(state: DataFrame, evals: DataFrame, now: dt.datetime, seq: str | None = None,
                       max_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """:func:`upsert_gaps` and ``(measure_id, status, gaps)``, what it adds to the counts per status.

    The changes come from the upsert's own join: of a key whose status is
    another one than before, the old status loses one gap and the new one gains
    one. Together with the counts before they are the counts after (R4, R6, R9).
    """
    j = _joined(state, evals, now, seq)
    moved = j.where(F.col("_hit") & ~F.col("_old").eqNullSafe(F.col("status")))
    one = F.lit(1).cast("bigint")
    signs = F.array(F.struct(F.col("_old").alias("status"), (-one).alias("gaps")),
                    F.struct(F.col("status").alias("status"), one.alias("gaps")))
    deltas = (moved.select("measure_id", F.explode(signs).alias("d")).where("d.status IS NOT NULL")
              .groupBy("measure_id", "d.status").agg(F.sum("d.gaps").alias("gaps")).where("gaps <> 0"))
    return _numbered(j, max_id, KEY), deltas


def apply_deltas(summary: DataFrame, deltas: DataFrame) -> DataFrame:
    """Counts per measure and status after ``deltas``; what comes to nothing is absent, as in a count."""
    return (summary.unionByName(deltas).groupBy("measure_id", "status").agg(F.sum("gaps").alias("gaps"))
            .where("gaps <> 0"))


def upsert_runs(state: DataFrame, evals: DataFrame, max_id: int | None = None) -> DataFrame:
    """The state after several runs one after the other, in one join (G2 for a backfill).

    ``evals`` has the evaluations of all runs with ``seq`` (the order of the
    runs) and ``at`` (the time of the run). What ``upsert_gaps`` does run by run
    comes to this: the last run that has a key decides its status and date, the
    first one identifies a new gap, and new ids follow the first run, then the key.
    """
    e = evals.withColumn("status", gap_status(F.col("in_numerator"))).groupBy(*KEY).agg(
        F.max_by(F.struct("status", "last_evidence_date", "at"), "seq").alias("last"),
        F.min(F.struct("seq", "at")).alias("first"))
    checkpoint_root(state.sparkSession)
    evaluated = F.col("e.last").isNotNull()
    j = state.select(*COLUMNS).alias("s").join(e.alias("e"), KEY, "full_outer").select(
        F.col("s.id").alias("id"), *KEY, F.coalesce("e.last.status", "s.status").alias("status"),
        F.when(evaluated, F.col("e.last.last_evidence_date")).otherwise(F.col("s.last_evidence_date"))
         .alias("last_evidence_date"),
        F.coalesce("s.first_identified_at", "e.first.at").alias("first_identified_at"),
        F.coalesce("e.last.at", "s.last_evaluated_at").alias("last_evaluated_at"),
        F.col("e.first.seq").alias("_seq")).checkpoint()
    return _numbered(j, max_id, ["_seq", *KEY])


def state_buckets(spark: SparkSession, snapshot: Snapshot | None = None) -> Buckets:
    """Buckets of a co-located state: those of ``snapshot``, if it has any and enough of them.

    A join reads the state without an exchange only if it has at least
    ``spark.sql.shuffle.partitions`` buckets. Sorted by patient, a read of one
    patient skips all row groups but one a file.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if snapshot and snapshot.buckets and snapshot.buckets.n >= n:
        return snapshot.buckets
    return Buckets(n, tuple(KEY), ("patient_id", "measure_id"))


def state_stats() -> dict:
    """Aggregates that the store takes while a state is written."""
    return {"max_id": F.max("id")}


def gap_counts(evals: DataFrame) -> DataFrame:
    """Open / closed counts of one batch per measure (G4; the batch, not the table)."""
    return evals.groupBy("measure_id").agg(
        F.count_if(~F.col("in_numerator")).cast("int").alias("gaps_open"),
        F.count_if(F.col("in_numerator")).cast("int").alias("gaps_closed"))


def run_summary(evals: DataFrame, measures_evaluated: int) -> DataFrame:
    """Totals across measures (G5); ``measures_evaluated`` is the catalog size,
    so a measure returning no rows still counts."""
    return evals.agg(
        F.lit(int(measures_evaluated)).alias("measures_evaluated"),
        F.count_if(~F.col("in_numerator")).cast("int").alias("gaps_open"),
        F.count_if(F.col("in_numerator")).cast("int").alias("gaps_closed"))
