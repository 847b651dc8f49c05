"""Shards of documents along a Hilbert curve over their metadata.

Size, source and language are quantised to ``2 ** BITS`` cells each: size at cut
points of a percentile sketch over all documents, source and language by their
whole values, at weighted quantiles of the distinct values or, where these are
few enough, with a cell for each. A document's cell has an
index on the Hilbert curve through the cube of cells; documents are sorted by
that index and the sorted run is cut into shards, so a shard covers a compact
part of the cube and a filter on any of the dimensions skips most files.

Law ``rows``: shard = floor(rank * shards / rows), so counts are at most one
apart; ranks come from one distributed sort, with no single-task window.
Documents with equal texts take the smallest cell among them and follow each
other, so they share a shard unless a cut falls between them.

Edge cases: a null text has no bytes (its CRC-32 is that of an empty text);
null metadata is the lowest cell; a null doc_id comes first among equals;
repeated rows are rows like others; with fewer rows than shards some shards
stay empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.operators.ids import dense_index
from gapwise.session import checkpoint_root

SHARDS = 24
BITS = 4
DIMENSIONS = 3
SALTS = 32


def hilbert_index(cell: tuple[int, ...], bits: int) -> int:
    """Position on the Hilbert curve of a cell of a cube with 2**bits cells a side.

    Every level of the curve is an orthant walk in Gray-code order; the state
    is the entry corner and the direction of the orthant.
    """
    n = len(cell)
    mask = (1 << n) - 1
    entry, direction, index = 0, 0, 0

    def turn(x: int, by: int) -> int:
        by %= n
        return ((x >> by) | (x << (n - by))) & mask

    for level in range(bits - 1, -1, -1):
        corner = sum(((c >> level) & 1) << i for i, c in enumerate(cell))
        gray = turn(corner ^ entry, direction + 1)
        w, shift = gray, 1
        while shift < n:
            w ^= w >> shift
            shift <<= 1
        index = index << n | w
        if w == 0:
            start, step = 0, 0
        else:
            before = 2 * ((w - 1) // 2)
            start = before ^ (before >> 1)
            odd = w if w & 1 else w - 1
            step = ((odd + 1) & ~odd).bit_length() - 1
        entry ^= turn(start, -(direction + 1))
        direction = (direction + step + 1) % n
    return index


def curve(bits: int = BITS, dimensions: int = DIMENSIONS) -> list[int]:
    """The Hilbert index of every cell, by cell number in base 2**bits (first dimension highest)."""
    side = 1 << bits
    return [hilbert_index(tuple(c // side**(dimensions - 1 - i) % side for i in range(dimensions)), bits)
            for c in range(side**dimensions)]


def text_cuts(rows: DataFrame, column: str, side: int) -> list[str]:
    """At most ``side`` - 1 cut points of a text column: every value, or else its quantiles."""
    counts = (rows.select(F.col(column).alias("v")).where("v is not null")
              .groupBy("v").agg(F.count("*").alias("n")))
    few = counts.select("v").limit(side).collect()
    if len(few) < side:
        return [r["v"] for r in few]
    checkpoint_root(rows.sparkSession)
    placed = counts.repartitionByRange("v").withColumn("pid", F.spark_partition_id()).checkpoint()
    sums = placed.groupBy("pid").agg(F.sum("n").alias("n")).withColumn("one", F.lit(1))  # a row a partition
    before = sums.select("pid", (F.sum("n").over(Window.partitionBy("one").orderBy("pid")) - F.col("n")).alias("before"),
                         F.sum("n").over(Window.partitionBy("one")).alias("total"))
    run = F.col("before") + F.sum("n").over(Window.partitionBy("pid").orderBy("v"))
    cut = (placed.join(F.broadcast(before), "pid").select("v", "n", "total", run.alias("run"))
           .where(F.expr(f"least((run * {side}) div total, {side - 1}) > ((run - n) * {side}) div total")))
    return [r["v"] for r in cut.select("v").collect()]


def _cell(value: str, cuts: list[int] | list[str]) -> Column:
    """The number of cut points at or below the value; null: 0."""
    return sum((F.coalesce(F.col(value) >= c, F.lit(False)).cast("int") for c in cuts), F.lit(0))


def shard_documents(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve) for every row.

    ``docs(doc_id, text, lang, source, ...)``; ``curve`` is the row's place on the curve.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("same"),
        F.col("source").cast("string").alias("d1"), F.col("lang").cast("string").alias("d2"))
    side = 1 << bits
    steps = [i / side for i in range(1, side)]
    sizes = rows.agg(F.percentile_approx("size", steps, 10_000)).first()[0]
    cells = [_cell("size", sorted(set(sizes or []))), *[_cell(c, text_cuts(rows, c, side)) for c in ("d1", "d2")]]
    number = (cells[0] * side + cells[1]) * side + cells[2]
    table = F.array(*[F.lit(i) for i in curve(bits)])
    rows = rows.withColumn("curve", F.element_at(table, number + 1))
    # equal texts: the least place of the group; salted, as a text may fill a large part of the rows
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    least = (rows.groupBy("same", "size", "text_crc32")
             .agg(F.min("curve").alias("least"), F.count("*").alias("n")).where("n > 1")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).drop("n"))
    placed = (rows.withColumn("salt", salt).join(least, ["same", "size", "text_crc32", "salt"], "left")
              .select("doc_id", "size", "text_crc32", "same", F.coalesce("least", "curve").alias("curve")))
    ranked = dense_index(placed, ["curve", "same", "doc_id"], name="rank", start=0)
    total = docs.count()
    shard = F.expr(f"(rank * {shards}) div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (ranked.withColumn("shard", shard.cast("int"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("rank") - first).cast("bigint").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "curve"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write ``docs`` as one folder of Parquet files per shard, in curve order within a file.

    doc_id must identify a row; a column named shard is replaced.
    """
    place = shard_documents(docs, shards).select("doc_id", "shard", "slot")
    rows = docs.select("doc_id", F.struct(*[c for c in docs.columns if c != "shard"]).alias("row"))
    both = rows.alias("r").join(place.alias("p"), F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")))
    (both.select("p.shard", "p.slot", "row").repartition("shard").sortWithinPartitions("shard", "slot")
     .select("row.*", "shard").write.partitionBy("shard").parquet(path))
