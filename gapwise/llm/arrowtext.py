"""Text columns as byte arrays inside Arrow tasks.

Helpers shared by the operators that run in ``mapInArrow``: a batch of texts
becomes one ``uint8`` array with offsets, words are found by a byte table, and
words are hashed all at once. Work is cut into slices of about
``SLICE_BYTES`` so that the temporary arrays stay small whatever the batch
size; a single longer text forms a slice of its own and is never cut.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A-Z become a-z, every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SPACES = [9, 10, 11, 12, 13, 32]
#: True where a byte belongs to a word ``[^\x20\x09-\x0D]+``.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[_SPACES] = False


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, _UPPER, _UPPER.lower())


def in_share(key: Column, wanted: int, total: int) -> Column:
    """True for about ``wanted`` and some more of ``total`` keys, picked by hash.

    Put before ``orderBy(...).limit(wanted)``: the limit's single task then gets
    about ``wanted`` rows in all and not that many from every partition.
    """
    share = min(1.0, (1.25 * wanted + 200) / max(total, 1))
    return F.pmod(F.xxhash64(F.lit(97), key), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))


def with_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *parts])


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema) -> DataFrame:
    with_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


class Texts:
    """The UTF-8 bytes of a text column and where each text starts; null reads as empty."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        _, offsets, data = column.buffers()
        off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data, self.offsets = raw[off[0]:off[-1]], off - off[0]

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def slices(self, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
        """Row ranges that hold at most ``limit`` bytes, or a single row."""
        start, n = 0, len(self)
        while start < n:
            stop = int(np.searchsorted(self.offsets, self.offsets[start] + limit, side="right")) - 1
            stop = min(n, max(stop, start + 1))
            yield start, stop
            start = stop

    def part(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        off = self.offsets[start:stop + 1]
        return self.data[off[0]:off[-1]], off - off[0]


def tokens(data: np.ndarray, offsets: np.ndarray, table: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes that ``table`` marks, row by row."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    word = table[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    after[-1], after[:-1] = False, word[1:]
    inner = offsets[1:-1]
    before[inner[inner < n]] = False
    after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for positions below n."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table)
    return _powers["up"], _powers["down"]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, equal for equal bytes anywhere."""
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each row, in text order, and the rows' bounds.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A row of fewer words,
    but not none, has its whole sequence as its only shingle. Row i owns
    hashes[bounds[i]:bounds[i + 1]], repeats included.
    """
    data = LOWER[data]
    starts, ends, row = tokens(data, offsets, NON_SPACE)
    words = hash_spans(data, starts, ends)
    n = len(offsets) - 1
    first = np.searchsorted(row, np.arange(n + 1))
    count = np.diff(first)

    def run(at: np.ndarray, size: int) -> np.ndarray:
        acc = words[at]
        for j in range(1, size):
            acc = mix(acc * np.uint64(0xE7037ED1A0B428DB) + words[at + j])
        return mix(acc + np.uint64(size))

    at = np.arange(max(len(words) - k + 1, 0))
    at = at[row[at] == row[at + k - 1]]
    values, where = [run(at, k)], [row[at]]
    for size in range(1, k):
        short = np.flatnonzero(count == size)
        if len(short):
            values.append(run(first[short], size))
            where.append(short)
    hashes, rows = np.concatenate(values), np.concatenate(where)
    if len(values) > 1:
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    return hashes, np.searchsorted(rows, np.arange(n + 1))
