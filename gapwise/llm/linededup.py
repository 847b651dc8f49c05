"""Line de-duplication by probing sharded perfect-hash arrays.

A line's key is the line without white space at both ends and with A-Z in
lower case; keys found in at least ``min_docs`` documents lose all their lines
everywhere. Keys travel as two independent 64-bit hashes.

1. One narrow aggregation gives the number of documents of every distinct key.
2. Keys are dealt into shards of about ``KEYS_PER_SHARD``. Each shard becomes
   one row: a minimal perfect hash, a 16-bit fingerprint and a count for each
   slot (the count stops at ``min_docs``, so it usually takes one byte).
3. Documents probe the arrays: probes (document, key hashes) are dealt to the
   same partitions as the shards and stream past one shard's arrays at a time,
   so a task holds the arrays of a single shard. Only hits leave that step.
4. The hits of a document, at most its own lines, join its text.

A key in a large part of all documents would send all their probes to one
shard. Such keys are resolved without probing: fewer than ``HOT_KEYS`` keys can
each have more than 1/``HOT_KEYS`` of all (document, key) pairs, so their list
has a proven bound and goes into the plan as a literal set. Keys just below that
still make a shard heavy when there are many shards: a shard with more than
``HEAVY`` times the mean is copied and its probes dealt to the copies, so no task
holds more than a fixed multiple of ``pairs / shards`` probes.

Edge cases: a null or empty text is one empty line; empty keys are never
dropped (``min_chars``); every row is a document of its own, so repeated rows
count as often as they occur and get equal results; null doc_ids are kept;
an empty table gives an empty result; further columns are passed through by
``drop_lines`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.arrowtext import ascii_lower, map_arrow, mix
from gapwise.llm.mphash import MinimalPerfectHash
from gapwise.session import checkpoint_root

MIN_DOCS = 10
MIN_CHARS = 1
KEYS_PER_SHARD = 1 << 16
HOT_KEYS = 1024
#: A shard with more than this many times the mean number of probes is copied.
HEAVY = 4
_BLANKS = " \t\n\x0b\x0c\r"
_SPLIT = "\n"


def lines_of(text: Column) -> Column:
    """The lines of a whole text; null reads as empty, which is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), _SPLIT, -1)


def key_of(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(_BLANKS)))


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(F.lit(11), key).alias("a"), F.xxhash64(F.lit(29), key).alias("b"))


def _keyed(text: Column, min_chars: int) -> Column:
    """The distinct key hashes of a text's lines, without keys shorter than ``min_chars``."""
    keys = F.filter(F.transform(lines_of(text), key_of), lambda k: F.char_length(k) >= min_chars)
    return F.transform(F.array_distinct(keys), _hashes)


def count_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b, n): the number of documents of every distinct line key."""
    return (docs.select(F.explode(_keyed(F.col("text"), min_chars)).alias("k"))
            .groupBy(F.col("k.a").alias("a"), F.col("k.b").alias("b"))
            .agg(F.count(F.lit(1)).alias("n")))


def _slot_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a.view(np.uint64)) ^ b.view(np.uint64)


class LineArrays:
    """One shard: perfect hash, fingerprint array, count array."""

    def __init__(self, index: MinimalPerfectHash, prints: np.ndarray, counts: np.ndarray):
        self.index, self.prints, self.counts = index, prints, counts

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, n: np.ndarray, cap: int) -> "LineArrays":
        keys = _slot_keys(a, b)
        index = MinimalPerfectHash.build(keys)
        slots = index.slots(keys)
        prints = np.zeros(len(index), np.uint16)
        counts = np.zeros(len(index), np.min_scalar_type(cap))
        prints[slots] = b.view(np.uint64) >> np.uint64(48)
        np.maximum.at(counts, slots, np.minimum(n, cap).astype(counts.dtype))
        return cls(index, prints, counts)

    def count(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Documents of each key (at most the cap); 0 for a key that no document has."""
        slots = self.index.slots(_slot_keys(a, b))
        known = slots >= 0
        out = np.zeros(len(a), np.int64)
        s = slots[known]
        same = self.prints[s] == (b.view(np.uint64)[known] >> np.uint64(48)).astype(np.uint16)
        out[known] = np.where(same, self.counts[s], 0)
        return out

    def to_row(self) -> list[bytes]:
        return [self.index.to_bytes(), self.prints.tobytes(),
                bytes([self.counts.dtype.itemsize]) + self.counts.tobytes()]

    @classmethod
    def from_row(cls, index: bytes, prints: bytes, counts: bytes) -> "LineArrays":
        return cls(MinimalPerfectHash.from_bytes(index), np.frombuffer(prints, np.uint16),
                   np.frombuffer(counts, f"<u{counts[0]}", offset=1))


def _shard(shards: int) -> Column:
    return F.pmod(F.col("b"), F.lit(shards)).cast("int").alias("shard")


def _runs(table: pa.RecordBatch) -> Iterator[tuple[int, int, int]]:
    """(shard, start, stop) of the runs of equal shard in a sorted batch."""
    shard = table.column("shard").to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(shard)) + 1
    for i, j in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(shard)]])):
        if j > i:
            yield int(shard[i]), int(i), int(j)


def build_arrays(keys: DataFrame, shards: int, cap: int) -> DataFrame:
    """(shard, index, prints, counts): the arrays of every shard of ``keys(a, b, n)``."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def row() -> pa.RecordBatch:
            a, b, n = (np.concatenate([h[i] for h in held]) for i in range(3))
            return pa.RecordBatch.from_pylist(
                [dict(zip(("shard", "index", "prints", "counts"),
                          [now, *LineArrays.build(a, b, n, cap).to_row()]))],
                schema=pa.schema([("shard", pa.int32()), ("index", pa.binary()),
                                  ("prints", pa.binary()), ("counts", pa.binary())]))

        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "n")]
            for shard, i, j in _runs(batch):
                if shard != now and held:
                    yield row()
                    held = []
                now = shard
                held.append([c[i:j].copy() for c in cols])
        if held:
            yield row()

    dealt = (keys.select(_shard(shards), "a", "b", "n").repartition("shard")
             .sortWithinPartitions("shard"))
    return map_arrow(dealt, make, "shard int, index binary, prints binary, counts binary")


def heavy_shards(keys: DataFrame, shards: int, pairs: int, hot_from: int) -> DataFrame | None:
    """(shard, copies) of the shards with more than ``HEAVY`` times the mean number of probes.

    There are at most ``shards / HEAVY`` of them, one for each 262,144 distinct
    keys, so their list is broadcast; None where no shard can be heavy.
    """
    if shards <= HEAVY:
        return None
    most = HEAVY * max(1, pairs // shards)
    return (keys.where(F.col("n") < hot_from).groupBy(_shard(shards)).agg(F.sum("n").alias("w"))
            .where(F.col("w") > most)
            .select("shard", F.ceil(F.col("w") / F.lit(most)).cast("int").alias("copies")))


def probe(probes: DataFrame, arrays: DataFrame, shards: int, least: int,
          heavy: DataFrame | None = None) -> DataFrame:
    """The rows of ``probes(doc, a, b)`` whose key is in at least ``least`` documents.

    The arrays of a ``heavy`` shard are copied, and its probes dealt to the copies by document.
    """
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            cols = [batch.column(c).fill_null(0).to_numpy(zero_copy_only=False)
                    for c in ("doc", "a", "b")]
            is_probe = batch.column("kind").to_numpy(zero_copy_only=False) == 1
            keep = np.zeros(batch.num_rows, bool)
            for shard, i, j in _runs(batch):
                first = i
                while first < j and not is_probe[first]:
                    now, held = shard, LineArrays.from_row(
                        *(batch.column(c)[first].as_py() for c in ("index", "prints", "counts")))
                    first += 1
                if first < j and shard == now:
                    keep[first:j] = held.count(cols[1][first:j], cols[2][first:j]) >= least
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols],
                                                 names=["doc", "a", "b"])

    none = F.lit(None)
    asked = probes.select(_shard(shards), F.lit(1).alias("kind"), "doc", "a", "b",
                          *(none.cast("binary").alias(c) for c in ("index", "prints", "counts")))
    held = arrays.select("shard", F.lit(0).alias("kind"),
                         *(none.cast("bigint").alias(c) for c in ("doc", "a", "b")),
                         "index", "prints", "counts")
    if heavy is not None:
        copies, many = F.coalesce("copies", F.lit(1)), F.broadcast(heavy)
        # copy c of shard s is a shard of its own: s + shards * c
        def copy(c: Column) -> Column:
            return (F.col("shard") + F.lit(shards).cast("bigint") * c).alias("shard")
        rest = held.columns[1:]
        asked = asked.join(many, "shard", "left").select(
            copy(F.pmod(F.xxhash64("doc"), copies)), *rest)
        held = (held.join(many, "shard", "left")
                .withColumn("c", F.explode(F.sequence(F.lit(0), copies - 1))).select(copy(F.col("c")), *rest))
    dealt = held.union(asked).repartition("shard").sortWithinPartitions("shard", "kind")
    return map_arrow(dealt, look, "doc bigint, a bigint, b bigint")


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept lines, plus n_lines and n_dropped.

    Further columns stay as they are (a column named n_lines or n_dropped is replaced).
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    keys = count_keys(docs, min_chars).checkpoint()
    shape = keys.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs")).first()
    shards = max(1, -(-shape["keys"] // KEYS_PER_SHARD))
    hot_from = max(min_docs, shape["pairs"] // HOT_KEYS + 1)
    hot = [(r["a"], r["b"]) for r in keys.where(F.col("n") >= hot_from).select("a", "b").collect()]

    def is_hot(k: Column) -> Column:
        if not hot:
            return F.lit(False)
        return k["a"].isin([a for a, _ in hot]) & k["b"].isin([b for _, b in hot])

    own = F.xxhash64(F.lit(3), F.col("doc_id"), F.col("text"))
    cold = F.filter(_keyed(F.col("text"), min_chars), lambda k: ~is_hot(k))
    probes = (docs.select(own.alias("doc"), F.explode(cold).alias("k"))
              .select("doc", "k.a", "k.b"))
    heavy = heavy_shards(keys, shards, shape["pairs"], hot_from)
    hits = (probe(probes, build_arrays(keys, shards, min_docs), shards, min_docs, heavy)
            .groupBy("doc").agg(F.collect_set(F.struct("a", "b")).alias("hits")))
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # the input row travels as one column, so that its names meet no names used here
    joined = (docs.select(F.struct(*rest).alias("row"), own.alias("doc"))
              .join(hits.hint("shuffle_hash"), "doc", "left"))

    def kept(line: Column) -> Column:
        key = key_of(line)
        k = _hashes(key)
        found = is_hot(k) | F.coalesce(F.array_contains(F.col("hits"), k), F.lit(False))
        return (F.char_length(key) < min_chars) | ~found

    return (joined.withColumn("lines", lines_of(F.col("row.text")))
            .withColumn("kept", F.filter("lines", kept))
            .select(*[F.array_join("kept", _SPLIT).alias("text") if c == "text" else F.col("row")[c].alias(c)
                      for c in rest],
                    F.size("lines").cast("bigint").alias("n_lines"),
                    (F.size("lines") - F.size("kept")).cast("bigint").alias("n_dropped")))


SQL = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (
  SELECT doc_id, i, ls[i] AS l,
         translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM split)),
common AS (
  SELECT k FROM line WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(common.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE common.k IS NULL), ''))
         AS kept_sha256
FROM line LEFT JOIN common ON line.k = common.k
GROUP BY doc_id
"""
