"""Dense, ordered row numbers without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no partition moves every row into one
task. Here the rows are range-partitioned and sorted by the key (a normal
distributed sort), each row takes its position inside its partition from
``monotonically_increasing_id`` (lower 33 bits), and a per-partition offset —
a table with one row per partition, so its size is bounded by the partition
count and it is safe to broadcast — turns that into a global position.

The sorted rows are checkpointed to the shared checkpoint folder before the
positions are read, so a recomputation after a lost executor sees the same
partitioning and assigns the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.session import checkpoint_root

_LOW33 = (1 << 33) - 1


def dense_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index",
                start: int | Column = 1) -> DataFrame:
    """Add ``name`` = ``start`` + position of the row in ``order`` (ties: any order).

    Keys should be unique for a deterministic result.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    ranked = (df.orderBy(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
              .checkpoint(eager=True))
    counts = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid")
                                    .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    start_c = start if isinstance(start, Column) else F.lit(int(start))
    return (ranked.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (start_c + F.col("_off") + F.col("_pos")).cast("long"))
            .drop("_pid", "_pos", "_off"))


def index_within_group(df: DataFrame, group: str, order: Sequence[str], name: str = "group_index"
                       ) -> DataFrame:
    """0-based position of each row inside its ``group`` in ``order``.

    A group may be arbitrarily large: positions come from one distributed
    sort (:func:`dense_index`) minus the first position of the group, taken
    from a per-group ``min`` (one row per group).
    """
    g = dense_index(df, [group, *order], name="_g", start=0)
    first = g.groupBy(group).agg(F.min("_g").alias("_first"))
    return (g.join(first, group)
            .withColumn(name, F.col("_g") - F.col("_first"))
            .drop("_g", "_first"))
