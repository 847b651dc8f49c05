"""Table constraints as assertion jobs.

Each check returns the violating rows (so they can be quarantined or shown)
and ``constraint_report`` folds them into ``(check_name, violations)``. SQL
semantics are kept: a CHECK on a NULL value passes (NOT NULL is its own
check) and UNIQUE ignores keys containing NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.operators.runs import RUN_STATUSES
from gapwise.operators.serving import broadcast_if_small

# --- fixed values ------------------------------------------------------------
GAP_STATUSES = ("OPEN", "CLOSED")
GAP_NOT_NULL = ("id", "measure_id", "patient_id", "status", "first_identified_at",
                "last_evaluated_at")
RUN_NOT_NULL = ("id", "run_date", "started_at", "status")
MEASURE_NOT_NULL = ("id", "display_name")


def check_fk(df: DataFrame, col: str, ref: DataFrame, ref_col: str = "id") -> DataFrame:
    """Rows whose ``col`` has no match in ``ref`` (NULL references pass)."""
    keys = broadcast_if_small(ref.select(F.col(ref_col).alias("_ref")).distinct())
    return df.where(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("_ref"), "left_anti")


def check_domain(df: DataFrame, col: str, allowed) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed)))


def check_unique(df: DataFrame, cols) -> DataFrame:
    """Key values that occur more than once, with their count."""
    cols = list(cols)
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.where(nn).groupBy(*cols).count().where(F.col("count") > 1)


def check_not_null(df: DataFrame, cols) -> DataFrame:
    """One row per column: ``(column, nulls)`` (a single aggregation pass)."""
    cols = list(cols)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.selectExpr(f"stack({len(cols)}, {stack}) AS (column, nulls)")


def _row_checks(table: str, df: DataFrame, not_null, domains: dict, fks: dict) -> DataFrame:
    """Not-null, domain and foreign-key counts of one table in a single aggregation.

    ``fks`` maps a column to the (small) dimension it refers to.
    """
    aggs = []
    for col, (name, ref) in fks.items():
        known = ref.select(F.col("id").alias(col), F.lit(True).alias(f"_{name}")).distinct()
        df = df.join(broadcast_if_small(known), col, "left")
        aggs.append(F.count_if(F.col(col).isNotNull() & F.col(f"_{name}").isNull()).alias(name))
    for col, allowed in domains.items():
        aggs.append(F.count_if(~F.col(col).isin(list(allowed))).alias(f"{col}_domain"))
    aggs += [F.count_if(F.col(c).isNull()).alias(f"not_null.{c}") for c in not_null]
    counts = df.agg(*aggs)
    stack = ", ".join(f"'{table}.{c}', `{c}`" for c in counts.columns)
    return counts.selectExpr(f"stack({len(counts.columns)}, {stack}) AS (check_name, violations)")


def _unique_checks(table: str, df: DataFrame, keys: dict) -> DataFrame:
    parts = [check_unique(df, cols).agg(F.count(F.lit(1)).alias("violations"))
             .select(F.lit(f"{table}.{name}").alias("check_name"), "violations") for name, cols in keys.items()]
    return reduce(DataFrame.unionByName, parts)


def constraint_report(gaps: DataFrame, runs: DataFrame, measures: DataFrame) -> DataFrame:
    """``(check_name, violations)`` for every constraint of the three tables.

    One aggregation per table and one per unique key, so give it stored tables,
    not long plans.
    """
    return reduce(DataFrame.unionByName, [
        _row_checks("care_gap", gaps, GAP_NOT_NULL, {"status": GAP_STATUSES},
                    {"measure_id": ("fk_measure", measures)}),
        _unique_checks("care_gap", gaps, {"unique_measure_patient": ["measure_id", "patient_id"], "unique_id": ["id"]}),
        _row_checks("measure_run", runs, RUN_NOT_NULL, {"status": RUN_STATUSES}, {}),
        _unique_checks("measure_run", runs, {"unique_id": ["id"]}),
        _row_checks("measure", measures, MEASURE_NOT_NULL, {}, {}),
        _unique_checks("measure", measures, {"unique_id": ["id"]}),
    ])


class ConstraintViolation(ValueError):
    """A batch breaks constraints; ``rejects`` has its rows with the names of the broken ones."""

    def __init__(self, rejects: DataFrame, n: int):
        super().__init__(f"{n} rows break constraints")
        self.rejects = rejects


def batch_rejects(state: DataFrame, batch: DataFrame, measures: DataFrame) -> DataFrame:
    """Rows of a batch of gap rows that the gap table must not take, with ``broken``, the checks' names.

    Only the batch is checked. For uniqueness it meets the stored rows of its own
    keys and ids and no others: a key must come once and keep its id, an id
    must belong to one key.
    """
    key = ["measure_id", "patient_id"]
    known = broadcast_if_small(measures.select(F.col("id").alias("measure_id"), F.lit(True).alias("_known")).distinct())
    held = state.select(F.col("id").alias("_id"), F.struct(*key).alias("_key"))
    rows = batch.withColumn("_key", F.struct(*key)).join(known, "measure_id", "left")
    # the row's key and id among those of the batch, and among the stored ones
    times = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_times"))
    owners = rows.where("id IS NOT NULL").groupBy("id").agg(F.count_distinct("_key").alias("_owners"))
    stored_key = held.join(rows.select("_key").distinct(), "_key", "left_semi").groupBy("_key").agg(F.min("_id").alias("_held"))
    stored_id = (held.select(F.col("_id").alias("id"), F.col("_key").alias("_owner"))
                 .join(rows.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min("_owner").alias("_owner")))
    full = (rows.join(times, "_key", "left").join(stored_key, "_key", "left")
            .join(owners, "id", "left").join(stored_id, "id", "left"))
    whole = F.col("measure_id").isNotNull() & F.col("patient_id").isNotNull()
    broken = {f"not_null.{c}": F.col(c).isNull() for c in GAP_NOT_NULL} | {
        "status_domain": ~F.col("status").isin(*GAP_STATUSES),
        "fk_measure": F.col("measure_id").isNotNull() & F.col("_known").isNull(),
        "unique_measure_patient": whole & ((F.col("_times") > 1) | (F.col("_held") != F.col("id"))),
        "unique_id": (F.col("_owners") > 1) | (F.col("_owner") != F.col("_key"))}
    names = F.filter(F.array(*[F.when(c, F.lit(f"care_gap.{n}")) for n, c in broken.items()]), lambda x: x.isNotNull())
    return full.withColumn("broken", names).where(F.size("broken") > 0).select(*batch.columns, "broken")


def commit_checked(store, name: str, batch: DataFrame, measures: DataFrame, schema) -> int:
    """Put ``batch`` (whole gap rows) into the stored table, or raise :class:`ConstraintViolation`
    and leave the table at its version."""
    from gapwise.session import checkpoint_root
    checkpoint_root(batch.sparkSession)
    state = store.read(name, schema)
    batch = batch.select(*schema.fieldNames()).checkpoint()
    rejects = batch_rejects(state, batch, measures).checkpoint()
    if n := rejects.count():
        raise ConstraintViolation(rejects, n)
    key = ["measure_id", "patient_id"]
    kept = state.join(batch.select(*key), key, "left_anti")
    return store.commit(name, kept.unionByName(batch), partition_by=["measure_id"], stats={"max_id": F.max("id")})
