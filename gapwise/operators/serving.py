"""Read side: filtered, paged and aggregated views of the gap state.

All functions return DataFrames; nothing is collected except the two page
totals (``page_info`` returns them as a one-row DataFrame as well). Sorting is
fixed (``last_evaluated_at DESC, id DESC``); a page is ``offset/limit`` over
that order, which Spark plans as a distributed top-k
(``TakeOrderedAndProject``) rather than a full sort.

Scale note: a top-k page at offset ``o`` keeps ``o + size`` rows per task. A page
beyond ``TOP_ROWS`` is found by selection instead (``deep_page``): a few counts
over ranges of the sort key lead to the page's first row, from where on it is a
keyset page. Nothing but a range of at most ``SELECT_ROWS`` rows is ever sorted.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
STATUSES = ("OPEN", "CLOSED")
DEFAULT_PAGE_SIZE = 50
MIN_PAGE_SIZE = 1
MAX_PAGE_SIZE = 200
RECENT_RUNS = 20
#: Up to here a page is read as a top-k; this bounds what a task holds, not the page number.
TOP_ROWS = 10_000
#: A range of so many rows is sorted to find a position in it; larger ones are cut into so many buckets.
SELECT_ROWS, BUCKETS = 10_000, 1024
#: A dimension of at most so many rows is broadcast; a larger one is joined by shuffle.
MAX_BROADCAST_ROWS = 10_000


def broadcast_if_small(dim: DataFrame) -> DataFrame:
    """``dim`` marked for broadcast after its rows were counted, up to ``MAX_BROADCAST_ROWS``; else as it is.

    Without it the fact side of a join with a few measures would be dealt to as many tasks.
    """
    return F.broadcast(dim) if dim.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else dim


def validate_search(status: str | None = None, page: int = 0,
                    size: int = DEFAULT_PAGE_SIZE) -> None:
    """Argument checks, raised before any plan is built."""
    if status is not None and status not in STATUSES:
        raise ValueError(f"status must be one of {'|'.join(STATUSES)}, got {status!r}")
    if not isinstance(page, int) or page < 0:
        raise ValueError(f"page must be >= 0, got {page!r}")
    if not isinstance(size, int) or not (MIN_PAGE_SIZE <= size <= MAX_PAGE_SIZE):
        raise ValueError(f"size must be in [{MIN_PAGE_SIZE}, {MAX_PAGE_SIZE}], got {size!r}")


def search_gaps(gaps: DataFrame, status: str | None = None, measure_id: str | None = None,
                patient_id: str | None = None) -> DataFrame:
    """Optional-filter search: a ``None`` argument means "any" (R1)."""
    validate_search(status)
    out = gaps
    if status is not None:
        out = out.where(F.col("status") == F.lit(status))
    if measure_id is not None:
        out = out.where(F.col("measure_id") == F.lit(measure_id))
    if patient_id is not None:
        out = out.where(F.col("patient_id") == F.lit(patient_id))
    return out


def sort_gaps(gaps: DataFrame) -> DataFrame:
    """Most recently evaluated first, ties by id (R2)."""
    return gaps.orderBy(F.col("last_evaluated_at").desc(), F.col("id").desc())


def page(gaps: DataFrame, page_no: int = 0, size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """Page ``page_no`` of ``size`` rows in the fixed order.

    A page near the front is a top-k of all rows up to its end; a deep page is found by selection.
    """
    validate_search(None, page_no, size)
    first = page_no * size
    if first + size <= TOP_ROWS:
        return sort_gaps(gaps).offset(first).limit(size)
    return deep_page(gaps, page_no, size)


def key_at(gaps: DataFrame, position: int, select_rows: int = SELECT_ROWS) -> tuple[dt.datetime, int] | None:
    """``(last_evaluated_at, id)`` of the row at ``position`` (from 0) in the fixed order; None beyond the end.

    One key after the other is narrowed down: rows are counted in ``BUCKETS``
    ranges of the key, and the range that holds the position is looked at next,
    until it has at most ``select_rows`` rows or a single value. The driver
    sees one row per bucket.
    """
    rows = gaps.select(F.unix_micros("last_evaluated_at").alias("at"), F.col("id").alias("gap"))
    for key in ("at", "gap"):
        low, high, n = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
        if not position < n:
            return None
        while n > select_rows and low < high:
            width = (high - low) // BUCKETS + 1
            counts = (rows.groupBy(F.expr(f"({high} - {key}) div {width}").alias("bucket"))
                      .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
                      .orderBy("bucket").collect())
            for r in counts:
                if position < r["n"]:
                    break
                position -= r["n"]
            low, high, n = r["low"], r["high"], r["n"]
            rows = rows.where(F.col(key).between(low, high))
    found = rows.orderBy(F.desc("at"), F.desc("gap")).limit(position + 1).orderBy("at", "gap").limit(1)
    row = found.select(F.timestamp_micros("at").alias("at"), "gap").first()
    return row["at"], row["gap"]


def deep_page(gaps: DataFrame, page_no: int, size: int = DEFAULT_PAGE_SIZE, select_rows: int = SELECT_ROWS) -> DataFrame:
    """Any page, found by selection: its first row by counting, the others as a keyset page."""
    validate_search(None, page_no, size)
    key = key_at(gaps, page_no * size, select_rows)
    if key is None:
        return gaps.limit(0)
    return page_after(gaps, (key[0], key[1] + 1), size)


def page_after(gaps: DataFrame, after: tuple[dt.datetime, int] | None,
               size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """Keyset page: the ``size`` rows after ``(last_evaluated_at, id)`` in the fixed order."""
    validate_search(None, 0, size)
    if after is not None:
        ts, gid = after
        t = F.lit(ts).cast("timestamp")
        gaps = gaps.where((F.col("last_evaluated_at") < t)
                          | ((F.col("last_evaluated_at") == t) & (F.col("id") < F.lit(gid))))
    return sort_gaps(gaps).limit(size)


def page_info(gaps: DataFrame, size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """``total_elements`` and ``total_pages = ceil(n / size)``."""
    validate_search(None, 0, size)
    return gaps.agg(F.count(F.lit(1)).alias("total_elements")).select(
        "total_elements",
        F.ceil(F.col("total_elements") / F.lit(size)).cast("int").alias("total_pages"))


def gap_summary(gaps: DataFrame) -> DataFrame:
    """Count per measure and status; absent combinations are absent."""
    return (gaps.groupBy("measure_id", "status").agg(F.count(F.lit(1)).alias("gaps"))
            .orderBy("measure_id", "status"))


def list_measures(measures: DataFrame) -> DataFrame:
    """Measure dimension ordered by id."""
    return measures.orderBy("id")


def recent_runs(runs: DataFrame, n: int = RECENT_RUNS) -> DataFrame:
    """Latest ``n`` runs by start time, ties by id."""
    return runs.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(n)


def with_display_name(df: DataFrame, measures: DataFrame, id_col: str = "measure_id",
                      name_col: str = "name") -> DataFrame:
    """Display name from the dimension, falling back to the id.

    The dimension has one row per catalog measure and is broadcast if it is small.
    """
    dim = broadcast_if_small(measures.select(F.col("id").alias("_mid"), F.col("display_name").alias("_dn")))
    return (df.join(dim, F.col(id_col) == F.col("_mid"), "left")
            .withColumn(name_col, F.coalesce(F.col("_dn"), F.col(id_col)))
            .drop("_mid", "_dn"))


def scorecard(summary: DataFrame, measures: DataFrame) -> DataFrame:
    """Per measure: open, closed, total and closure % (0 when total is 0)."""
    cards = summary.groupBy("measure_id").agg(
        F.sum(F.when(F.col("status") == "OPEN", F.col("gaps")).otherwise(0)).cast("long").alias("open"),
        F.sum(F.when(F.col("status") != "OPEN", F.col("gaps")).otherwise(0)).cast("long").alias("closed"))
    cards = cards.withColumn("total", F.col("open") + F.col("closed")).withColumn(
        "closure_rate",
        F.when(F.col("total") == 0, F.lit(0.0))
         .otherwise(F.lit(100.0) * F.col("closed") / F.col("total")))
    return with_display_name(cards, measures).select(
        "measure_id", "name", "open", "closed", "total", "closure_rate").orderBy("measure_id")


def run_freshness(runs: DataFrame) -> DataFrame:
    """One status line per run: counts when SUCCEEDED, else the error if any."""
    detail = (F.when(F.col("status") == "SUCCEEDED",
                     F.concat_ws(" ", F.col("gaps_open").cast("string"), F.lit("open /"),
                                 F.col("gaps_closed").cast("string"), F.lit("closed")))
              .when(F.col("error").isNotNull(), F.col("error")))
    return runs.select("id", "status", "started_at", detail.alias("detail"))


def patient_gaps(gaps: DataFrame, patient_id: str) -> DataFrame:
    """All gaps of one patient in the fixed order."""
    return sort_gaps(search_gaps(gaps, patient_id=patient_id))
