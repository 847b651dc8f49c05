"""Document fingerprints by improved consistent weighted sampling.

A document is a weighted set: its terms are pairs of consecutive words
(``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; the only word if there is just one),
each weighted by how often it occurs. For every sample k and term a hash gives
r ~ Gamma(2, 1), c ~ Gamma(2, 1) and b ~ U(0, 1); with
t = floor(ln w / r + b) and ln a = ln c - r (t - b) - r the sample is the
(term, t) of least a. Two documents agree in a sample with probability
sum(min) / sum(max) of their weights, the generalised Jaccard similarity, so
the share of agreeing samples estimates it. ``SAMPLES`` samples are kept with
16 bits each; a chance agreement has probability 2**-16.

``fingerprint_neighbours`` needs each document's successor by descending
doc_id. Cut points from a percentile sketch deal doc_ids into ranges, four a
task, found by binary search in one constant; the first document of a range is
also sent to the end of the range before it, so texts are shuffled once and
each task streams through its sorted rows.

Edge cases: a null or empty text (or one without words) has the all-zero
fingerprint, is like (1.0) another such text and unlike (0.0) every other; a
null doc_id comes last; a doc_id must be an integer; rows with equal doc_id
follow each other by text, or by a hash of it where one doc_id fills several
ranges (equal rows stay together); a
single row is its own successor; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.arrowtext import SLICE_BYTES, Texts, map_arrow, mix, shingles

SAMPLES = 64
TERM_WORDS = 2
_BLOCK = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _gamma2_table() -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x)."""
    x = np.concatenate([np.linspace(0, 1, 20_000), np.linspace(1, 30, 60_000)[1:]])
    return np.interp((np.arange(65536) + 0.5) / 65536, 1 - (1 + x) * np.exp(-x), x).astype(np.float32)


_GAMMA2 = _gamma2_table()
_UNIFORM = ((np.arange(65536) + 0.5) / 65536).astype(np.float32)
_EXPONENTIAL = -np.log((np.arange(65536) + 0.5) / 65536).astype(np.float32)
_SEEDS = mix((np.arange(1, SAMPLES + 1).astype(np.uint64)) * _STEP) | np.uint64(1)


def _least(terms: np.ndarray, log_weight: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each sample: the least ln a, the term and its t. ``log_weight`` None: all weights one."""
    best = np.full(SAMPLES, np.inf, np.float32)
    term, step = np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES, np.int64)
    columns = np.arange(SAMPLES)
    for at in range(0, len(terms), _BLOCK):
        part = terms[at:at + _BLOCK]
        x = part[:, None] * _SEEDS
        x ^= x >> np.uint64(32)
        x *= _STEP
        bits = x.view(np.uint16).reshape(len(part), SAMPLES, 4)
        r, b = _GAMMA2[bits[..., 3]], _UNIFORM[bits[..., 2]]
        y = x ^ (x >> np.uint64(29))
        y *= np.uint64(0xC2B2AE3D27D4EB4F)
        bits = y.view(np.uint16).reshape(len(part), SAMPLES, 4)
        log_a = np.log(_EXPONENTIAL[bits[..., 3]] + _EXPONENTIAL[bits[..., 2]])
        if log_weight is None:
            log_a -= r * (1 - b)
            t = None
        else:
            t = np.floor(log_weight[at:at + _BLOCK, None] / r + b)
            log_a -= r * (t - b + 1)
        i = np.argmin(log_a, axis=0)
        value = log_a[i, columns]
        new = value < best
        best[new] = value[new]
        term[new] = part[i[new]]
        step[new] = 0 if t is None else t[i, columns][new].astype(np.int64)
    return best, term, step


def sample(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The 16-bit samples of one weighted set; all zero if it is empty."""
    if not len(terms):
        return np.zeros(SAMPLES, np.uint16)
    once = weights == 1
    best, term, step = _least(terms[once], None)
    if not once.all():
        best2, term2, step2 = _least(terms[~once], np.log(weights[~once]).astype(np.float32))
        new = best2 < best
        term, step = np.where(new, term2, term), np.where(new, step2, step)
    code = (mix(term + step.astype(np.uint64) * _STEP) >> np.uint64(48)).astype(np.uint16)
    return np.maximum(code, 1)


def fingerprints(texts: Texts) -> np.ndarray:
    """A row of samples for each whole text."""
    out = np.zeros((len(texts), SAMPLES), np.uint16)
    for start, stop in texts.slices():
        terms, bounds = shingles(*texts.part(start, stop), TERM_WORDS)
        for i in range(stop - start):
            own, weights = np.unique(terms[bounds[i]:bounds[i + 1]], return_counts=True)
            out[start + i] = sample(own, weights)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of agreeing samples, row by row: an estimate of the generalised Jaccard similarity."""
    return (a == b).mean(axis=1)


def as_string(samples: np.ndarray) -> str:
    return samples.astype(">u2").tobytes().hex()


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs(doc_id, text, ...)``."""
    plain = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([as_string(x) for x in fingerprints(Texts(b.column(1)))],
                                       pa.string())], names=["doc_id", "fingerprint"])

    return map_arrow(plain, run, T.StructType([plain.schema["doc_id"],
                                               T.StructField("fingerprint", T.StringType())]))


def edit(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next document."""
    m = len(text) // 3
    return text[:len(text) - m] + following[:m]


_LAST = -(1 << 63)


def _longs(values: list[int]) -> Column:
    """An array of longs as one constant: the plan is as wide for 8,000 values as for one."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _count_ahead(key: Column, tie: Column, marks: list[tuple[int, int]], equal: bool) -> Column:
    """How many of the descending ``marks`` lie above (key, tie), or at it where ``equal``, by binary search."""
    if not marks:
        return F.lit(0)
    keys, ties = _longs([k for k, _ in marks]), _longs([t for _, t in marks])
    steps = _longs([1 << i for i in reversed(range(len(marks).bit_length()))])

    def step(low: Column, width: Column) -> Column:
        at = (low + width - 1).cast("int")
        k, t = F.get(keys, at), F.get(ties, at)  # null beyond the end: not ahead
        ahead = (k > key) | ((k == key) & ((t >= tie) if equal else (t > tie)))
        return F.when(ahead, low + width).otherwise(low)

    return F.aggregate(steps, F.lit(0).cast("bigint"), step).cast("int")


def _cuts(quantiles: list[int]) -> list[tuple[int, int]]:
    """Cut points (key, tie), descending; a key that fills several ranges is cut inside, by tie."""
    times = Counter(quantiles)
    out = [(k, _LAST + (1 << 64) * i // n) for k, n in times.items() for i in range(n)]
    return sorted(out, reverse=True)


def with_successor_ranges(docs: DataFrame, ranges: int, tasks: int | None = None) -> DataFrame:
    """``docs`` as (_range, _ahead, _key, _tie, doc_id, text), dealt out by range and sorted.

    Rows with _ahead = 1 are copies of the next range's first document (of the
    first document at all behind the last range). Where one doc_id (or null)
    fills several ranges, its rows are cut by a hash of their text.
    """
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST))
    steps = [i / ranges for i in range(1, ranges)]
    got = docs.agg(F.percentile_approx(key, steps, 10_000).alias("q")).first()["q"] if steps else []
    cuts = _cuts(got or [])
    # texts are hashed only where some doc_id needs it
    tie = F.xxhash64("text") if len(cuts) > len({k for k, _ in cuts}) else F.lit(0).cast("bigint")
    keyed = docs.select(key.alias("_key"), tie.alias("_tie"), "doc_id", "text")
    place = _count_ahead(F.col("_key"), F.col("_tie"), cuts, equal=False)
    heads = [(r["h"]["_key"], r["h"]["_tie"]) for r in
             keyed.groupBy(place.alias("p")).agg(F.max(F.struct("_key", "_tie")).alias("h")).collect()]
    heads.sort(reverse=True)  # one row a range that has any
    n = len(heads)
    at = (_count_ahead(F.col("_key"), F.col("_tie"), heads, equal=True) - 1).alias("_at")
    rows = keyed.select("*", F.explode(F.array(at)).alias("_at"))  # searched once a row
    if n:
        is_head = ((F.get(_longs([k for k, _ in heads]), F.col("_at")) == F.col("_key"))
                   & (F.get(_longs([t for _, t in heads]), F.col("_at")) == F.col("_tie")))
        before = F.pmod(F.col("_at") - 1, F.lit(n))
    else:
        is_head, before = F.lit(False), F.lit(0)
    own = F.struct(F.col("_at").alias("range"), F.lit(0).alias("ahead"))
    copy = F.struct(before.alias("range"), F.lit(1).alias("ahead"))
    dealt = rows.select("*", F.explode(F.when(is_head, F.array(own, copy)).otherwise(F.array(own))).alias("_to"))
    return (dealt.select(F.col("_to.range").alias("_range"), F.col("_to.ahead").alias("_ahead"),
                         "_key", "_tie", "doc_id", "text")
            .repartitionById(tasks or ranges, F.col("_range"))
            .sortWithinPartitions("_range", "_ahead", F.desc("_key"), F.desc("_tie"), "text"))


_OUT = [("n_chars", pa.int64(), T.LongType()), ("edited_sha256", pa.string(), T.StringType()),
        ("fingerprint", pa.string(), T.StringType()),
        ("edited_fingerprint", pa.string(), T.StringType()),
        ("near_edited", pa.float64(), T.DoubleType()), ("near_next", pa.float64(), T.DoubleType())]


def _compare(ids: list, texts: list[str]) -> list[pa.Array]:
    """Result columns of texts[:-1]; each text's successor is the one behind it."""
    own, following = texts[:-1], texts[1:]
    edited = [edit(a, b) for a, b in zip(own, following)]
    prints = fingerprints(Texts(pa.array([*texts, *edited], pa.large_string())))
    n = len(own)
    mine, after, changed = prints[:n], prints[1:n + 1], prints[n + 1:]
    values = [[len(t) for t in own], [hashlib.sha256(t.encode()).hexdigest() for t in edited],
              [as_string(x) for x in mine], [as_string(x) for x in changed],
              likeness(mine, changed), likeness(mine, after)]
    return [pa.array(v, kind) for v, (_, kind, _) in zip(values, _OUT)]


def fingerprint_neighbours(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""
    plain = docs.select("doc_id", "text")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if ranges is None:
        ranges = 4 * tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, now, closed = [], [], 0, None, None

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[:len(texts) - 1], kind), *_compare(ids, texts)],
                names=["doc_id", *(name for name, _, _ in _OUT)])

        for batch in batches:
            kind = batch.column(4).type
            for place, ahead, doc_id, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, 5))):
                if ahead and closed == place:
                    continue  # a repeated row of the next range's first document
                closed = place if ahead else None
                text = text or ""
                if place != now or size > SLICE_BYTES:
                    if len(texts) > 1:
                        yield flush()
                    keep = place == now
                    ids, texts = (ids[-1:], texts[-1:]) if keep else ([], [])
                    size, now = 0, place
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if len(texts) > 1:
            yield flush()

    schema = T.StructType([plain.schema["doc_id"], *(T.StructField(n, t) for n, _, t in _OUT)])
    return map_arrow(with_successor_ranges(plain, ranges, tasks), run, schema)
