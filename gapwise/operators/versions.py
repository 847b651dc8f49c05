"""Latest version per resource id (Q1).

Resource tables are append-only: every create or update adds one row. The
current state of a resource is its newest row by ``meta.lastUpdated``; equal
timestamps are broken by ``meta.versionId`` (fixed-width text, so text order is
version order), which makes the pick deterministic where the source ordering
alone is not.

Plan shape: ``row_number() … = 1`` is planned by Catalyst as a partial
``WindowGroupLimit`` before the exchange and a final one after it, so an id
with a very large number of versions is reduced to one row per input
partition before it is shuffled. Predicates on non-key columns must be applied
*after* this operator; Catalyst only moves key predicates through the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def version_order() -> list[Column]:
    """Newest first: ``meta.lastUpdated DESC, meta.versionId DESC`` (NULLs last)."""
    return [F.col("meta.lastUpdated").desc_nulls_last(),
            F.col("meta.versionId").desc_nulls_last()]


def latest(df: DataFrame, key: str | Sequence[str] = "id",
           order: Sequence[Column] | None = None) -> DataFrame:
    """Keep the newest row of every ``key``."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*(order or version_order()))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def version_rank(df: DataFrame, key: str = "id",
                 order: Sequence[Column] | None = None) -> DataFrame:
    """All versions with their rank (1 = newest); the projection ``p.*, rn`` (Q2)."""
    w = Window.partitionBy(key).orderBy(*(order or version_order()))
    return df.select("*", F.row_number().over(w).alias("rn"))
