"""Benchmark decontamination with one Aho-Corasick automaton.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.
A window is ``WINDOW`` consecutive words of a benchmark item (all words of a
shorter item). All windows form one automaton over normalised text, in which
words are joined and enclosed by single blanks, so a match always covers whole
words. Each document is normalised and scanned once, from its first to its
last byte; matches are mapped to word numbers and from there, by the bytes that
the normalisation kept, to code point offsets of the original text.

The benchmark is a stated query set. Its windows are cut into blocks of at
most ``MAX_PATTERN_BYTES`` bytes of patterns and item ids, so one automaton has
a bounded size (the ids of a window that many items share are dealt to several
blocks). One block, some 45,000 windows, is scanned against every document. For a
larger benchmark a Bloom filter of all windows (``FILTER_BITS``, so of a fixed
size) first picks the texts that can hit; only these are written to the shared
checkpoint folder and scanned block by block, and what a block finds is narrow:
hashes of the text, runs and ids. Copies of a text share their result.

Edge cases: a null text has no words and is never contaminated; items without
words have no windows; items with a null item_id hit like others and count as
one item, but add no id to ``items``; repeated items count once; repeated documents get equal results; an empty benchmark or table gives
no hits or no rows; further columns of the documents are not touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.arrowtext import hash_spans, map_arrow
from gapwise.session import scratch_path

WINDOW = 13
MAX_PATTERN_BYTES = 4 << 20
#: Ids of a window that one row holds.
PART_IDS = 65_536
#: Size and probes of the filter; at ten million windows about one in 10,000 others passes.
FILTER_BITS = 1 << 28
FILTER_PROBES = 6
#: Words that the filter looks up at a time.
FILTER_STEP = 1 << 16
#: Parts of the rows of one text.
SALTS = 16
#: Text hashes (16 bytes each) that are broadcast.
MAX_BROADCAST_KEYS = 200_000
#: A document is contaminated if at least one word in ``SHARE`` is hit.
SHARE = 20

_TO_WORDS = bytearray(b" " * 128 + bytes(range(128, 256)))
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    _TO_WORDS[_c] = _c
for _c in range(65, 91):
    _TO_WORDS[_c] = _c + 32
_TO_WORDS = bytes(_TO_WORDS)


def normalise(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def windows(words: list[bytes], size: int = WINDOW) -> set[bytes]:
    if not words:
        return set()
    k = min(size, len(words))
    return {b" " + b" ".join(words[i:i + k]) + b" " for i in range(len(words) - k + 1)}


def word_offsets(text: bytes, plain: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code point offsets at which the words start and end; ``plain`` is ``text`` byte by byte, other bytes blank."""
    word = np.frombuffer(b" " + plain + b" ", np.uint8) != 32
    starts = np.flatnonzero(word[1:-1] & ~word[:-2])
    ends = np.flatnonzero(word[1:-1] & ~word[2:])
    # words start and end beside ASCII, so every code point before an end is whole
    points = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return points[starts] - 1, points[ends]


NO_RUNS = np.zeros((0, 4), np.int64)


class Matcher:
    """The automaton of one block of (window, item ids)."""

    def __init__(self, block: list[tuple[bytes, tuple[str | None, ...]]]):
        self.items = [ids for _, ids in block]
        self.automaton = ahocorasick.Automaton()
        for i, (window, _) in enumerate(block):
            self.automaton.add_word(window.decode("latin-1"), (i, len(window)))
        if block:
            self.automaton.make_automaton()

    def find(self, text: bytes) -> tuple[int, np.ndarray, set[str | None]]:
        """The number of words, the hit runs (first word, last word, start, end) and the items that hit."""
        plain = text.translate(_TO_WORDS)
        words = plain.split()
        if not self.items or not words:
            return len(words), NO_RUNS, set()
        joined = b" " + b" ".join(words) + b" "
        found = list(self.automaton.iter(joined.decode("latin-1")))
        if not found:
            return len(words), NO_RUNS, set()
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        at = np.array([e for e, _ in found])
        sizes = np.array([size for _, (_, size) in found])
        first = np.searchsorted(blanks, at - sizes + 1)
        last = np.searchsorted(blanks, at) - 1
        starts, ends = word_offsets(text, plain)
        return (len(words), merge(np.stack([first, last, starts[first], ends[last]], axis=1)),
                {x for i in {i for _, (i, _) in found} for x in self.items[i]})


def merge(runs: np.ndarray) -> np.ndarray:
    """Runs (first word, last word, start, end) made disjoint and ascending."""
    if len(runs) < 2:
        return runs
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    last, end = np.maximum.accumulate(runs[:, 1]), np.maximum.accumulate(runs[:, 3])
    cut = np.flatnonzero(runs[1:, 0] > last[:-1] + 1) + 1
    a, b = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(runs) - 1]])
    return np.stack([runs[a, 0], last[b], runs[a, 2], end[b]], axis=1)


class WindowFilter:
    """A Bloom filter of the windows' hashes, and the numbers of words that windows have.

    It has no false negatives; a false positive costs a scan of its document.
    """

    def __init__(self):
        self.bits, self.sizes = np.zeros(FILTER_BITS // 8, np.uint8), set()

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        probes = np.arange(FILTER_PROBES, dtype=np.uint64)[:, None]
        return (hashes + probes * step) % np.uint64(len(self.bits) * 8)

    def add(self, windows: list[bytes]) -> None:
        plain = [w.strip() for w in windows]
        self.sizes.update(w.count(b" ") + 1 for w in plain)
        data, starts, ends = _laid_out(plain)
        at = self._places(hash_spans(data, starts, ends)).ravel()
        np.bitwise_or.at(self.bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def may_hit(self, words: list[bytes]) -> bool:
        reach = max(self.sizes, default=1) - 1
        for i in range(0, len(words), FILTER_STEP):
            data, starts, ends = _laid_out(words[i:i + FILTER_STEP + reach])
            for k in self.sizes:
                if k <= len(starts):
                    at = self._places(hash_spans(data, starts[:len(starts) - k + 1], ends[k - 1:]))
                    held = (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
                    if held.all(axis=0).any():
                        return True
        return False


def _laid_out(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words joined by blanks, with their starts and ends."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words)]
    return np.frombuffer(b" ".join(words), np.uint8), starts, ends


def window_ids(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(w, part, ids, nameless): the distinct windows with their item ids, sorted by w in each partition.

    The ids of a window come in parts of about ``PART_IDS`` at most; ``nameless``
    says that an item without an id has the window.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if found := sorted(windows(normalise(text.encode()), size)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.binary()), pa.array([item] * len(found), pa.string())], names=["w", "i"])

    items = benchmark.select(F.col("item_id").cast("string").alias("i"),
                             F.col("text").alias("t")).where("t is not null")
    parts = 1 + items.count() // PART_IDS
    part = F.pmod(F.xxhash64("i"), F.lit(parts)).cast("int")
    return (map_arrow(items, run, "w binary, i string").withColumn("part", part)
            .groupBy("w", "part").agg(F.sort_array(F.collect_set("i")).alias("ids"),
                                      F.max(F.col("i").isNull()).alias("nameless"))
            .repartition("w").sortWithinPartitions("w", "part"))


def blocks(benchmark: DataFrame, size: int = WINDOW, limit: int = MAX_PATTERN_BYTES
           ) -> Iterator[list[tuple[bytes, tuple[str | None, ...]]]]:
    """The benchmark's windows with their item ids (None for items without), in blocks of
    ``limit`` bytes of patterns and ids."""
    held: dict[bytes, list[str | None]] = {}
    used = 0
    for row in window_ids(benchmark, size).toLocalIterator():
        w = bytes(row["w"])
        for i in [*row["ids"], *([None] if row["nameless"] else [])]:
            need = len(i.encode()) if i is not None else 0
            need += len(w) if w not in held else 0
            if held and used + need > limit:
                yield [(k, tuple(v)) for k, v in held.items()]
                held, used = {}, 0
                need = len(w) + (len(i.encode()) if i is not None else 0)
            held.setdefault(w, []).append(i)
            used += need
    yield [(k, tuple(v)) for k, v in held.items()]


_matchers: dict[str, Matcher] = {}


def _matcher(shared) -> Matcher:
    """The matcher of a broadcast block; a worker keeps one at a time."""
    if shared.id not in _matchers:
        _matchers.clear()
        _matchers[shared.id] = Matcher(shared.value)
    return _matchers[shared.id]


class _Shared:
    """A broadcast variable and a key for it."""

    def __init__(self, variable, key: str):
        self.variable, self.id = variable, key

    @property
    def value(self):
        return self.variable.value


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("n_items", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("contaminated", T.BooleanType())])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _is_contaminated(n_words: int, runs: np.ndarray) -> bool:
    n_hit = int((runs[:, 1] - runs[:, 0] + 1).sum())
    return n_hit > 0 and SHARE * n_hit >= n_words


def _results(found: list[tuple[int, np.ndarray, set[str | None]]]) -> list[pa.Array]:
    """The columns of ``RESULT``."""
    ids = [sorted(x for x in items if x is not None) for _, _, items in found]
    return [pa.array([n for n, _, _ in found], pa.int64()),
            pa.array([int((r[:, 1] - r[:, 0] + 1).sum()) for _, r, _ in found], pa.int64()),
            pa.array(ids, pa.list_(pa.string())), pa.array([len(items) for _, _, items in found], pa.int64()),
            pa.array([[{"start": a, "end": b} for a, b in r[:, 2:].tolist()] for _, r, _ in found], _SPANS),
            pa.array([_is_contaminated(n, r) for n, r, _ in found], pa.bool_())]


def _scanned(docs: DataFrame, block: list, finish, schema: T.StructType) -> DataFrame:
    """``finish(batch, found)`` of every batch, ``found`` from one scan of each text."""
    spark = docs.sparkSession
    at = docs.columns.index("text")
    shared = _Shared(spark.sparkContext.broadcast(block), uuid.uuid4().hex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(shared)
        for b in batches:
            yield finish(b, [matcher.find(t.as_py() or b"") for t in b.column(at).cast(pa.large_binary())])

    return map_arrow(docs, run, schema)


def _only_block(benchmark: DataFrame) -> list | None:
    """The block of a benchmark that fits into one, else None."""
    todo = blocks(benchmark)
    first = next(todo)
    return first if next(todo, None) is None else None


def _keyed(docs: DataFrame, *columns) -> DataFrame:
    """``columns`` with two hashes of the text, which name it, and a salt for the rows of one text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")
    return docs.select(*columns, F.xxhash64(F.lit(11), text).alias("a"),
                       F.xxhash64(F.lit(29), text).alias("b"), salt.alias("salt"))


def _salted(keys: DataFrame) -> DataFrame:
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def find_in_blocks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(a, b) and ``RESULT`` of the distinct texts that hit, for a benchmark of many blocks.

    The filter of all windows picks the texts that can hit; only they are
    written, and scanned by each block's automaton. A block's rows are narrow.
    """
    spark = docs.sparkSession
    held = WindowFilter()
    for block in blocks(benchmark):
        held.add([w for w, _ in block])
    shared = spark.sparkContext.broadcast(held)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).cast(pa.large_binary())
            yield b.filter(pa.array([shared.value.may_hit(normalise(t.as_py() or b"")) for t in texts], pa.bool_()))

    def narrow(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        hit = [i for i, (_, _, items) in enumerate(found) if items]
        a, b = (batch.column(c).take(pa.array(hit, pa.int64())) for c in ("a", "b"))
        return pa.RecordBatch.from_arrays(
            [a, b, pa.array([found[i][0] for i in hit], pa.int64()),
             pa.array([found[i][1].ravel().tolist() for i in hit], pa.list_(pa.int64())),
             pa.array([list(found[i][2]) for i in hit], pa.list_(pa.string()))],
            names=["a", "b", "n_words", "runs", "items"])

    possible = map_arrow(_keyed(docs, "text").drop("salt"), pick, "text string, a bigint, b bigint")
    folder = scratch_path(spark, "decontam")
    possible.write.parquet(f"{folder}/texts")
    possible = spark.read.parquet(f"{folder}/texts")
    schema = T.StructType.fromDDL("a bigint, b bigint, n_words bigint, runs array<bigint>, items array<string>")
    for block in blocks(benchmark):
        # copies of a text have the same hits
        (_scanned(possible, block, narrow, schema).dropDuplicates(["a", "b"])
         .write.mode("append").parquet(f"{folder}/hits"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [(r["n_words"], merge(np.concatenate([np.array(x, np.int64).reshape(-1, 4) for x in r["runs"]])),
                      {i for x in r["items"] for i in x}) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *_results(found)],
                                             names=["a", "b", *RESULT.names])

    hits = (spark.read.schema(schema).parquet(f"{folder}/hits").groupBy("a", "b")
            .agg(F.max("n_words").alias("n_words"), F.collect_list("runs").alias("runs"),
                 F.collect_list("items").alias("items")))
    return map_arrow(hits, fold, T.StructType([*schema.fields[:2], *RESULT.fields]))


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, items, n_items, spans, contaminated) for ``docs(doc_id, text, ...)``.

    ``items`` are the ids of the items with an occurring window, sorted as
    strings, and ``n_items`` their number, with one more for items without an id;
    ``spans`` the hit passages as offsets in the original text.
    """
    plain = docs.select("doc_id", "text")
    schema = T.StructType([plain.schema["doc_id"], *RESULT.fields])
    block = _only_block(benchmark)
    if block is not None:
        return _scanned(plain, block, lambda batch, found: pa.RecordBatch.from_arrays(
            [batch.column(0), *_results(found)], names=schema.names), schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [len(normalise(t.as_py() or b"")) for t in b.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], pa.array(n, pa.int64())],
                                             names=["doc_id", "a", "b", "salt", "words"])

    asked = map_arrow(_keyed(plain, "doc_id", "text"), count, T.StructType(
        [schema.fields[0], *T.StructType.fromDDL("a bigint, b bigint, salt int, words bigint").fields]))
    empty = {"n_words": F.col("words"), "n_hit": F.lit(0), "items": F.array(), "n_items": F.lit(0),
             "spans": F.array(), "contaminated": F.lit(False)}
    return asked.join(_salted(find_in_blocks(plain, benchmark)), ["a", "b", "salt"], "left").select(
        "doc_id", *[F.coalesce(f.name, empty[f.name].cast(f.dataType)).alias(f.name) for f in RESULT.fields])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    block = _only_block(benchmark)
    if block is not None:
        return _scanned(docs, block, lambda batch, found: batch.filter(
            pa.array([not _is_contaminated(n, runs) for n, runs, _ in found], pa.bool_())), docs.schema)
    path = scratch_path(docs.sparkSession, "contaminated")
    find_in_blocks(docs.select("text"), benchmark).where("contaminated").select("a", "b").write.parquet(path)
    bad = docs.sparkSession.read.parquet(path)
    rows = _keyed(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    if bad.count() <= MAX_BROADCAST_KEYS:
        kept = rows.join(F.broadcast(bad), ["a", "b"], "left_anti")
    else:
        kept = rows.join(_salted(bad), ["a", "b", "salt"], "left_anti")
    return kept.select("row.*")


SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS s
  FROM (SELECT item_id, ws, least(13, len(ws)) AS k,
               unnest(generate_series(1, len(ws) - least(13, len(ws)) + 1)) AS i
        FROM iw WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM win),
dwin AS (
  SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i
        FROM dw, ks WHERE len(ws) >= k)),
hit AS (SELECT doc_id, i, dwin.k AS k, item_id FROM dwin JOIN win ON dwin.k = win.k AND dwin.s = win.s),
hw AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM hit) GROUP BY doc_id),
hi AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN hw ON dw.doc_id = hw.doc_id LEFT JOIN hi ON dw.doc_id = hi.doc_id
"""
