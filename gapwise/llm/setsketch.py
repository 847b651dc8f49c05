"""Near-duplicate documents by SetSketch registers.

A document's set holds its distinct shingles (runs of ``words`` words; fewer
words form one shingle; no words, an empty set that links with nothing). Two
documents are linked if the Jaccard similarity of their sets is at least
``percent`` / 100, and groups are the connected components of the links.

1. Every set becomes ``REGISTERS`` SetSketch registers: for register i the
   minimum of exponentially distributed hashes, truncated to a power of ``BASE``.
   Registers of a union are the maxima of the registers, so sketches merge.
2. Equal sets form a class; only its first row, by doc_id, goes on. A class is a node
   with a number of its own, and a row is known by doc_id and text, so rows
   without a doc_id or with the same one are members like all others.
3. Bands of ``BAND`` registers are hashed to buckets. A pair of similarity 0.8
   shares no bucket with probability below 4e-6, more similar ones less.
4. In a bucket every member meets the bucket's smallest node. Such a pair is
   estimated from registers and set sizes by maximum likelihood, dropped if the
   estimate is over six standard errors too low, and else verified on the full
   sets. Members of a bucket that then do not hang together are gathered by the
   label that most of the bucket has; all of them are compared on full sets
   with all members under other labels, block against block. So each
   pair of a bucket is verified, or found unlikely, or already joined.
5. Components are found by star rounds over the verified links.

Edge cases: null or empty text: empty set, own group; repeated rows get equal
results; a component is named by its smallest doc_id, null only if it has none,
and ``kept`` compares a row's doc_id with that name, so rows that share the name
are all kept; ``drop_near_duplicates`` leaves exactly one row of a component. An
empty table gives an empty result. doc_id may have any type that can be ordered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.arrowtext import Texts, map_arrow, mix, shingles
from gapwise.llm.components import connected_components
from gapwise.session import checkpoint_root

WORDS = 5
PERCENT = 80
BAND = 5
BANDS = 32
REGISTERS = BAND * BANDS
BASE = 1.001
RATE = 20.0
#: Pairs estimated this far below the threshold are not verified: over six standard errors.
MARGIN = 0.2
#: Members of a family that are compared with as many others in one piece.
BLOCK = 256
SALTS = 16
#: Buckets of more members are joined by broadcast, if they are at most so many.
HOT_MEMBERS, MAX_HOT = 1000, 100_000
#: Keys of so many nodes (some 10 MB) are broadcast to the texts.
MAX_ASKED = 200_000
#: What identifies a row: whether it has no doc_id, the doc_id, and 128 bits of the text.
KEY = ["none", "id", "h1", "h2"]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(101, REGISTERS + 101).astype(np.uint64) * _STEP) | np.uint64(1)


def registers(distinct: np.ndarray) -> np.ndarray:
    """The SetSketch of a set of 64-bit hashes."""
    least = np.full(REGISTERS, np.uint64(2**64 - 1))
    for at in range(0, len(distinct), 1024):
        np.minimum(least, (distinct[at:at + 1024, None] * _SEEDS).min(axis=0), out=least)
    share = ((least >> np.uint64(32)).astype(float) + 0.5) / 2.0**32
    value = -np.log1p(-share) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum likelihood Jaccard similarity of sketch pairs (rows) with known set sizes."""
    a, b = a.astype(np.int32), b.astype(np.int32)
    up, down = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    same = a.shape[-1] - up - down
    u = size_a / (size_a + size_b)
    v = 1 - u
    lo, hi = np.zeros(up.shape), np.minimum(u / v, v / u) * (1 - 1e-9)

    def score(j: np.ndarray) -> np.ndarray:
        p, q = _p(np.maximum(u - v * j, 1e-12)), _p(np.maximum(v - u * j, 1e-12))
        return (up * np.log(p) + down * np.log(q)
                + same * np.log(np.maximum(1 - p - q, 1e-12)))

    for _ in range(30):  # the likelihood has one peak
        third = (hi - lo) / 3
        left, right = lo + third, hi - third
        low = score(left) < score(right)
        lo, hi = np.where(low, left, lo), np.where(low, hi, right)
    return (lo + hi) / 2


def _sets(texts: Texts, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for start, stop in texts.slices():
        hashes, bounds = shingles(*texts.part(start, stop), words)
        for i in range(stop - start):
            yield np.unique(hashes[bounds[i]:bounds[i + 1]])


def _key(docs: DataFrame) -> list[Column]:
    kind = docs.schema["doc_id"].dataType
    return [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit("0").cast(kind)).alias("id"),
            F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(11), "text").alias("h2")]


def _keyed(docs: DataFrame) -> DataFrame:
    """(none, id, h1, h2, text) of every row."""
    return docs.select(*_key(docs), "text")


def _sketches(keyed: DataFrame, words: int) -> DataFrame:
    """(none, id, h1, h2, n, set_a, set_b, regs): set size, 128-bit hash of the set, registers."""
    names = [*KEY, "n", "set_a", "set_b", "regs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for s in _sets(Texts(b.column(4)), words):
                a = mix(s).sum(dtype=np.uint64).view(np.int64)
                c = mix(s ^ _STEP).sum(dtype=np.uint64).view(np.int64)
                rows.append((len(s), int(a), int(c), registers(s).tobytes() if len(s) else None))
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], names=names)

    schema = T.StructType([*keyed.schema.fields[:4], *(T.StructField(c, T.LongType()) for c in ("n", "set_a", "set_b")),
                           T.StructField("regs", T.BinaryType())])
    return map_arrow(keyed, run, schema)


def _doc_id() -> Column:
    return F.when(~F.col("none"), F.col("id")).alias("doc_id")


def sketch(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n, set_a, set_b, regs) of every row of ``docs(doc_id, text, ...)``."""
    return _sketches(_keyed(docs), words).select(_doc_id(), "n", "set_a", "set_b", "regs")


def _bands(nodes: DataFrame) -> DataFrame:
    """(bucket, node) for every band of ``nodes(node, n, regs)``."""
    number = np.arange(1, BANDS + 1).astype(np.uint64) * _STEP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            regs = _matrix(b.column(1)).reshape(len(ids), BANDS, BAND).astype(np.uint64)
            key = np.broadcast_to(number, (len(ids), BANDS))
            for i in range(BAND):
                key = mix(key + regs[:, :, i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(ids, BANDS))],
                names=["bucket", "node"])

    return map_arrow(nodes.select("node", "regs"), run, "bucket bigint, node bigint")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _likely(percent: int) -> float:
    return percent / 100 - MARGIN


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose set sizes allow a link and whose estimate is not too low."""
    side = nodes.select("node", "n", "regs")
    both = (pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                na, nb = (b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (2, 3))
                ok = estimate(_matrix(b.column(4)), _matrix(b.column(5)), na, nb) >= _likely(percent)
                yield b.select([0, 1]).filter(pa.array(ok))

    return map_arrow(both.select("a", "b", "na", "nb", "ra", "rb"), run, "a bigint, b bigint")


def _verified(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, by their full shingle sets."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _shingle_sets(docs, firsts, asked, words)
    both = (pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
            .select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("common"),
                    (F.size("sa") + F.size("sb")).alias("total")))
    return (both.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common")))
            .select("a", "b").distinct())


def _shingle_sets(docs: DataFrame, firsts: DataFrame, asked: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the nodes ``asked(node)``; ``firsts`` has their rows' keys, ``docs`` the texts.

    The keys go to the texts by broadcast as long as they are few, else both are shuffled.
    """
    wanted = firsts.join(asked, "node", "left_semi").checkpoint()
    n = wanted.count()
    plain = docs.join(F.broadcast(wanted) if n <= MAX_ASKED else wanted.hint("shuffle_hash"), KEY).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            new = []
            for node in b.column(0).to_pylist():
                new.append(node not in seen)
                seen.add(node)
            b = b.filter(pa.array(new, pa.bool_()))
            sets = [s.view(np.int64) for s in _sets(Texts(b.column(1)), words)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["node", "shingles"])

    sets = map_arrow(plain, run, "node bigint, shingles array<bigint>").checkpoint()
    # a row that is repeated in several partitions gives its node several times
    return sets if sets.count() == n else sets.dropDuplicates(["node"]).checkpoint()


def _labels(links: DataFrame) -> DataFrame:
    """(node, label): a node linked with it, two steps down; equal labels are one component."""
    down = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")).checkpoint()
    next_down = down.select(F.col("node").alias("label"), F.col("label").alias("root"))
    return down.join(next_down, "label", "left").select("node", F.coalesce("root", "label").alias("label"))


def common_shingles(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, piece by piece of the shingles."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (left, right)]
    shared = np.intersect1d(*[np.unique(v) for v, _ in sides])
    for at in range(0, len(shared), width):
        piece = shared[at:at + width]
        marks = []
        for (values, owner), n in zip(sides, out.shape):
            k = np.minimum(np.searchsorted(piece, values), len(piece) - 1)
            inside = piece[k] == values
            m = np.zeros((n, len(piece)), np.float32)
            m[owner[inside], k[inside]] = 1
            marks.append(m)
        out += marks[0] @ marks[1].T
    return out


def _across(rest: DataFrame, docs: DataFrame, firsts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes of different labels in the same family.

    ``rest(family, node, label)``. Nodes of the family's own label need not
    meet each other. All others are cut into blocks, and each block meets
    every block of the family in a group of its own, which compares full sets
    and returns one link for each two labels that have any. So a group holds
    two blocks, however large the family, and no pair becomes a row but links.
    """
    sizes = (rest.groupBy("family").agg(
        F.count_if(F.col("label") != F.col("family")).alias("strange"),
        F.count_if(F.col("label") == F.col("family")).alias("own")))
    blocks = [F.ceil(F.col(c) / BLOCK).cast("int") for c in ("strange", "own")]
    is_own = F.col("label") == F.col("family")
    mine = F.when(is_own, F.col("nb") + F.pmod(F.xxhash64("node"), F.greatest("mb", F.lit(1)))).otherwise(
        F.pmod(F.xxhash64("node"), F.greatest("nb", F.lit(1)))).cast("int")
    others = F.when(is_own, F.sequence(F.lit(0), F.col("nb") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("nb") + F.col("mb") - 1))
    placed = (rest.join(sizes.select("family", blocks[0].alias("nb"), blocks[1].alias("mb")), "family")
              .where("nb > 0").withColumn("mine", mine).withColumn("other", F.explode(others))
              .select("family", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                      "mine", "node", "label"))
    sets = _shingle_sets(docs, firsts, rest.select("node").distinct(), words)

    def run(table: pa.Table) -> pa.Table:
        node, label, mine, i, j = (table.column(c).to_numpy() for c in ("node", "label", "mine", "i", "j"))
        column = table.column("shingles").combine_chunks()
        shingle, bounds = column.values.to_numpy(), column.offsets.to_numpy()
        size = np.diff(bounds).astype(float)
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        common = common_shingles(*[[shingle[bounds[x]:bounds[x + 1]] for x in side] for side in (left, right)])
        linked = (100 * common >= percent * (size[left][:, None] + size[right][None, :] - common)) & (common > 0)
        linked &= label[left][:, None] != label[right][None, :]
        x, y = np.nonzero(linked)
        x, y = left[x], right[y]
        names = np.stack([np.minimum(label[x], label[y]), np.maximum(label[x], label[y])], axis=1)
        keep = np.unique(names, axis=0, return_index=True)[1] if len(x) else np.zeros(0, np.int64)
        return pa.table({"a": np.minimum(node[x], node[y])[keep], "b": np.maximum(node[x], node[y])[keep]})

    return (placed.join(sets, "node").groupBy("family", "i", "j").applyInArrow(run, "a bigint, b bigint"))


def _members(bands: DataFrame) -> DataFrame:
    """(bucket, node, leader, size) of the members of shared buckets, without the leaders.

    A bucket with very many members would be one task of a join, so those meet
    their leader by broadcast, where they are few enough.
    """
    full = (bands.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("size"))
            .where("size > 1").checkpoint())
    hot = full.where(F.col("size") > HOT_MEMBERS)
    if hot.count() <= MAX_HOT:
        cold = bands.join(F.broadcast(hot.select("bucket")), "bucket", "left_anti").join(
            full.where(F.col("size") <= HOT_MEMBERS), "bucket")
        both = cold.unionByName(bands.join(F.broadcast(hot), "bucket"))
    else:
        both = bands.join(full, "bucket")
    return both.where("node != leader").checkpoint()


def link_classes(docs: DataFrame, firsts: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): verified links that join all linked ``nodes(node, n, regs)`` of the same bucket.

    ``firsts(node, *KEY)`` says which rows of ``docs(*KEY, text)`` the nodes stand for.
    """
    members = _members(_bands(nodes))
    met = members.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = _verified(_estimated(met, nodes, percent).checkpoint(), docs, firsts, words, percent).checkpoint()
    # the leaders have met everyone; what is open are pairs of other members under different labels
    placed = (members.where("size > 2").select("bucket", "node").join(_labels(links), "node", "left")
              .withColumn("label", F.coalesce("label", "node")).checkpoint())
    counted = placed.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    open_buckets = (counted.groupBy("bucket").agg(
        F.count("*").alias("labels"), F.max(F.struct("n", F.negative("label").alias("label"))).alias("most"))
        .where("labels > 1").select("bucket", F.negative("most.label").alias("family")))
    rest = placed.join(open_buckets, "bucket").select("family", "node", "label").distinct().checkpoint()
    return links.union(_across(rest, docs, firsts, words, percent))


def _salted(table: DataFrame) -> DataFrame:
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(none, id, h1, h2, n, winner) of every row; ``winner`` is the key of its component's first row,
    NULL where the set is empty."""
    checkpoint_root(docs.sparkSession)
    keyed = _keyed(docs)
    sketches = _sketches(keyed, words).checkpoint()
    some = sketches.where("n > 0")
    classes = (some.groupBy("set_a", "set_b").agg(F.min(F.struct(*KEY)).alias("first"))
               .withColumn("node", F.monotonically_increasing_id()).checkpoint())
    firsts = classes.select("node", *[F.col(f"first.{c}").alias(c) for c in KEY])
    nodes = (some.join(classes.select("node", "set_a", "set_b", *[F.col(f"first.{c}").alias(c) for c in KEY]),
                       ["set_a", "set_b", *KEY])
             .dropDuplicates(["node"]).select("node", "n", "regs").checkpoint())
    components = connected_components(link_classes(keyed, firsts, nodes, words, percent).toDF("u", "v"))
    # a component may hold a large part of the classes, a class a large part of the rows: both are salted
    linked = classes.join(components, "node", "left").withColumn("salt", _salt("node"))
    winners = (linked.where("component IS NOT NULL").groupBy("component", "salt").agg(F.min("first").alias("winner"))
               .groupBy("component").agg(F.min("winner").alias("winner")))
    changed = (linked.join(_salted(winners), ["component", "salt"], "left")
               .select("set_a", "set_b", F.coalesce("winner", "first").alias("winner")))
    # rows without a set name themselves, so that they do not meet under one key
    own = F.when(F.col("n") > 0, F.col("set_a")).otherwise(F.xxhash64(*KEY))
    return (sketches.select(*KEY, "n", own.alias("set_a"), F.when(F.col("n") > 0, F.col("set_b")).alias("set_b"),
                            _salt("id", "h1").alias("salt"))
            .join(_salted(changed), ["set_a", "set_b", "salt"], "left").select(*KEY, "n", "winner"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs(doc_id, text, ...)``."""
    name = F.when(F.col("n") == 0, F.col("doc_id")).when(~F.col("winner.none"), F.col("winner.id"))
    return (_grouped(docs, words, percent).withColumn("doc_id", _doc_id()).withColumn("component_id", name)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, its first by doc_id (none last), all columns as they are.

    Of rows that repeat a row's doc_id and text one stays. Rows without words all stay.
    """
    found = _grouped(docs, words, percent)
    gone = found.where(F.col("winner").isNotNull() & (F.col("winner") != F.struct(*KEY))).select(*KEY).distinct()
    # the input row travels as one column, so that its names meet no names used here
    has = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_key(docs), has.alias("has"))
    full = rows.where("has").dropDuplicates(KEY).join(gone.hint("shuffle_hash"), KEY, "left_anti")
    return full.select("row").union(rows.where("NOT has").select("row")).select(
        *[F.col("row")[c].alias(c) for c in docs.columns])


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 1], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 1, 1))) AS i
        FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id, r.c = d.doc_id AS kept
FROM (SELECT DISTINCT doc_id FROM documents) d
JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id
LEFT JOIN n ON n.doc_id = d.doc_id
"""
