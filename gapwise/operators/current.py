"""Current versions kept up to date batch by batch (Q1 and S4, incrementally).

``latest`` over a version store reads and ranks the whole history. Here the
current rows are a table of their own: a batch of new versions is ranked by
itself, only its ids meet the rows that are kept, and of the two the newer one by
version order stays. A version that arrives late, older than the kept one, never
wins; a batch that is applied again changes nothing. The history is not read.

The kept table is a snapshot in a :class:`~gapwise.sources.store.TableStore`, so
a batch is applied as a whole or not at all, and of two writers one has to start
again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.operators.versions import latest
from gapwise.sources.store import TableStore


def _order(side: str) -> Column:
    """Comparable version order of a row, NULLs oldest; NULL where the side has no row."""
    return F.struct(F.col(f"{side}.meta.lastUpdated"), F.col(f"{side}.meta.versionId"))


def newest_of(current: DataFrame, batch: DataFrame, key: str | Sequence[str] = "id") -> DataFrame:
    """``current`` after ``batch``; both have ``key``, ``meta`` and the same other columns.

    ``current`` has one row per key. Equal versions keep the row that is there.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = current.columns
    held = current.select(*keys, F.struct(*columns).alias("c"))
    new = latest(batch.select(*columns), keys).select(*keys, F.struct(*columns).alias("b"))
    wins = F.col("c").isNull() | (F.col("b").isNotNull() & (_order("b") > _order("c")))
    return (held.join(new, keys, "full_outer")
            .select(F.when(wins, F.col("b")).otherwise(F.col("c")).alias("row")).select("row.*"))


class CurrentRows:
    """The newest version per key of everything applied so far."""

    def __init__(self, store: TableStore, name: str, key: str | Sequence[str] = "id"):
        self.store, self.name, self.key = store, name, key

    def apply(self, batch: DataFrame, note: str | None = None) -> int:
        """Take a batch of versions in; returns the version of the kept table."""
        held = self.store.read(self.name, batch.schema)
        return self.store.commit(self.name, newest_of(held, batch, self.key), note=note)

    def read(self, schema) -> DataFrame:
        return self.store.read(self.name, schema)
