"""Quality classifier: Bradley-Terry pairwise ranking.

A document's score is linear in its style features. The weights come from
preference pairs (a document labelled good is preferred to one labelled bad)
by logistic loss on the difference of the two feature vectors. A raw score is
turned into an accept / reject decision by a score quantile: the cut is the
quantile of the training scores that equals the share of bad labels, and the
reported score is shifted so that the cut lies at ``ACCEPT``.

Features are measured on whole texts in one Arrow pass. Every usable label whose
document is there takes part in training, and every (good, bad) pair of them in
the loss; there is no sample of rows or pairs. The sum over all pairs is not
formed pair by pair: the logistic function of a score difference is interpolated
in each of the two scores, between Chebyshev nodes of score cells of width 1
(error about 1e-11), so it is a sum over pairs of nodes, and what a task adds to
a node are its rows' shares and their feature sums. The driver sees the sums of
the cells in which scores lie (tens, whatever the number of rows), never rows.
The cut is found by counting ranges of the score. Scoring covers every row and
moves no text between tasks.

Edge cases: a null or empty text has all features zero and gets a score like
any other; a null doc_id is never trained on and is not held out; repeated
rows get equal scores and count once in training, as the one of least
features where their texts differ; label rows that are null, not exactly 0
or 1 (0.6 is neither) or contradictory (both values for one doc_id) are not used; with no usable label of one of the
two classes nothing is learned and every score is ``NEUTRAL`` (accepted). An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.arrowtext import LOWER, NON_SPACE, Texts, hash_spans, map_arrow, tokens
from gapwise.session import scratch_path

#: Scores from here on are accepted.
ACCEPT = 0.7
#: Score of every document when there is nothing to learn from.
NEUTRAL = 0.75
RIDGE = 1e-3
#: Chebyshev nodes in a score cell of width 1.
NODES = 10
#: A range of so many rows is looked at value by value for the cut; larger ones are cut into so many buckets.
SELECT_ROWS, BUCKETS = 10_000, 1024


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[list(chars.encode("ascii"))] = 1
    return t


_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _table("0123456789")
_STOPS = _table(".,;:?'\"-()")
_LETTER = _UPPER + _table("abcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = 1
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[33:127] = 1
_SYMBOL -= (_SYMBOL & (_LETTER | _DIGIT | _STOPS))

FEATURES = ("upper", "digit", "stops", "symbol", "space", "newline", "other_script",
            "word_length", "repeat_1", "repeat_2", "bare_words", "symbol_words", "upper_words",
            "distinct", "long_words", "short_words")
N_FEATURES = 2 * len(FEATURES)


def features(texts: Texts) -> np.ndarray:
    """One row of ``N_FEATURES`` style measures for each whole text."""
    parts = [_slice_features(*texts.part(a, b)) for a, b in texts.slices()]
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))


def _slice_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1

    def total(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=sums[1:])
        return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)

    size = np.maximum(np.diff(offsets), 1).astype(float)
    in_bytes = [total(t[data], offsets) / size for t in (_UPPER, _DIGIT, _STOPS, _SYMBOL)]
    in_bytes.append(total(~NON_SPACE[data], offsets) / size)
    in_bytes.append(total(data == 10, offsets) / size)
    in_bytes.append(total(data >= 128, offsets) / size)

    starts, ends, row = tokens(data, offsets, NON_SPACE)
    bounds = np.searchsorted(row, np.arange(n + 1))
    count = np.diff(bounds)
    words = np.maximum(count, 1).astype(float)
    hashes = hash_spans(LOWER[data], starts, ends)
    length = ends - starts

    def inside(table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=sums[1:])
        return sums[ends] - sums[starts]

    same1, same2 = np.zeros(len(row), bool), np.zeros(len(row), bool)
    same1[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    same2[2:] = (hashes[2:] == hashes[:-2]) & (row[2:] == row[:-2])
    letters, symbols, upper = inside(_LETTER), inside(_SYMBOL), inside(_UPPER)
    # distinct words over the number that a text of this length may be expected to have
    order = np.lexsort((hashes, row))
    first = np.ones(len(row), bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = total(first, bounds) / words ** 0.85
    in_words = [total(length, bounds) / words / 10.0]
    in_words += [total(x, bounds) / words
                 for x in (same1, same2, letters == 0, (symbols >= 2) & (letters > 0),
                           (upper >= 2) & (upper == letters))]
    in_words.append(np.minimum(distinct, 2.0))
    in_words += [total(x, bounds) / words for x in (length >= 14, length <= 1)]
    plain = np.stack(in_bytes + in_words, axis=1)
    plain[np.diff(offsets) == 0] = 0.0
    return np.concatenate([plain, np.sqrt(plain)], axis=1)


@dataclass(frozen=True)
class RankModel:
    """Weights over standardised features, and the raw score at the cut; None: nothing learned."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...] | None
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), NEUTRAL)
        raw = ((x - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights)
        return 1.0 / (1.0 + np.exp(-np.clip(raw - self.cut + np.log(ACCEPT / (1 - ACCEPT)), -40, 40)))


_AT = 0.5 + 0.5 * np.cos((2 * np.arange(NODES) + 1) * np.pi / (2 * NODES))
_TO_NODES = np.linalg.inv(np.polynomial.chebyshev.chebvander(2 * _AT - 1, NODES - 1))


def _place(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each score and its shares in the cell's nodes: f(score) is about shares @ f(nodes)."""
    cell = np.floor(score)
    return cell.astype(np.int64), np.polynomial.chebyshev.chebvander(2 * (score - cell) - 1, NODES - 1) @ _TO_NODES


def _add_sums(sums: dict, label: np.ndarray, z: np.ndarray, w: np.ndarray) -> None:
    """Add to ``sums[label, cell]`` the rows' shares in the cell's nodes, and these times their features."""
    cell, share = _place(z @ w)
    order = np.lexsort((cell, label))
    label, cell = label[order], cell[order]
    first = np.flatnonzero(np.r_[True, (label[1:] != label[:-1]) | (cell[1:] != cell[:-1])]) if len(order) else []
    for a, b in zip(first, [*first[1:], len(order)]):
        own, key = share[order[a:b]], (int(label[a]), int(cell[a]))
        rows = np.concatenate([own.sum(axis=0)[:, None], own.T @ z[order[a:b]]], axis=1)
        sums[key] = sums[key] + rows if key in sums else rows


class _AllPairs:
    """Loss over all pairs, its gradient and its curvature, from the sums of ``_add_sums`` at weights ``w``."""

    def __init__(self, sums: dict, w: np.ndarray):
        self.w, d = w, len(w)
        cells = [sorted(c for q, c in sums if q == k) for k in (0, 1)]
        at = [(np.array(c, float)[:, None] + _AT).ravel() for c in cells]
        rows = [np.concatenate([sums[k, c] for c in cells[k]]) for k in (0, 1)]
        n, x = [r[:, 0] for r in rows], [r[:, 1:] for r in rows]
        # means over all pairs of the loss, of p = 1 / (1 + e^difference) and of p (1 - p), and by node
        loss, p, q = 0.0, [np.zeros(len(a)) for a in at], [np.zeros(len(a)) for a in at]
        cross = np.zeros((d, d))
        n_pairs = self.n_pairs = n[0].sum() * n[1].sum()
        for a in range(0, len(at[1]), 64 * NODES):
            part = slice(a, a + 64 * NODES)
            difference = at[1][part, None] - at[0][None, :]
            loss += n[1][part] @ np.logaddexp(0.0, -difference) @ n[0]
            wrong = 1.0 / (1.0 + np.exp(np.clip(difference, -40, 40)))
            p[1][part], p[0] = wrong @ n[0], p[0] + n[1][part] @ wrong
            wrong *= 1.0 - wrong
            q[1][part], q[0] = wrong @ n[0], q[0] + n[1][part] @ wrong
            cross += x[1][part].T @ wrong @ x[0]
        self.loss = loss / n_pairs + RIDGE / 2 * w @ w
        self.gradient = RIDGE * w - (p[1] @ x[1] - p[0] @ x[0]) / n_pairs
        self.cross = (cross + cross.T) / n_pairs
        #: For each label and cell, by node: the sum of p (1 - p) over the pairs of a row at that node.
        self.weights = {(k, c): v for k in (0, 1) for c, v in zip(cells[k], q[k].reshape(-1, NODES))}

    def add_squares(self, squares: np.ndarray, label: np.ndarray, z: np.ndarray) -> None:
        """Add the rows' part of the curvature that is a sum over rows."""
        cell, share = _place(z @ self.w)
        keys, which = np.unique(np.stack([label, cell], axis=1), axis=0, return_inverse=True)
        # a score on a cell's edge may have been rounded into the next cell when the sums were taken
        none = np.zeros(NODES)
        at_nodes = np.array([self.weights.get((int(k), int(c)), none) for k, c in keys]).reshape(-1, NODES)
        weight = (share * at_nodes[which.ravel()]).sum(axis=1)
        squares += (z * weight[:, None]).T @ z

    def curve(self, squares: np.ndarray) -> np.ndarray:
        return squares / self.n_pairs - self.cross + RIDGE * np.eye(len(self.w))


def _newton(d: int, sums: Callable[[np.ndarray], dict], squares: Callable[[_AllPairs], np.ndarray]) -> np.ndarray:
    """Weights of least loss; ``sums`` and ``squares`` are passes over all rows.

    Weights are rounded, so that the order in which tasks' sums are added does not show.
    """
    at = _AllPairs(sums(np.zeros(d)), np.zeros(d))
    for _ in range(50):  # Newton steps, halved until the loss falls
        step, rate = np.linalg.solve(at.curve(squares(at)), at.gradient), 1.0
        if at.gradient @ step < 1e-8:  # twice what is left to gain
            break
        while rate > 1e-3:
            w = np.round(at.w - rate * step, 6)
            new = _AllPairs(sums(w), w)
            if new.loss < at.loss:
                break
            rate /= 2
        else:
            break
        at = new
    return at.w


def fit_pairs(good: np.ndarray, bad: np.ndarray, bad_share: float, pairs: int | None = None,
              seed: int | None = None) -> RankModel:
    """Bradley-Terry weights from all (good, bad) pairs of local rows, and the quantile cut.

    ``pairs`` and ``seed`` chose a sample of the pairs once; they have no effect.
    """
    both = np.concatenate([good, bad])
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z, label = (both - mean) / scale, np.repeat([1, 0], [len(good), len(bad)])

    def sums(w: np.ndarray) -> dict:
        out: dict = {}
        _add_sums(out, label, z, w)
        return out

    def squares(at: _AllPairs) -> np.ndarray:
        out = np.zeros((z.shape[1], z.shape[1]))
        at.add_squares(out, label, z)
        return out

    w = _newton(z.shape[1], sums, squares)
    raw, counts = np.unique(np.stack([z @ w, 1 - label], axis=1), axis=0, return_counts=True)
    found = _walk([(v, 1 - int(q), int(c)) for (v, q), c in zip(raw, counts)], 0.0,
                  bad_share, {1: (1 - bad_share) / len(good), 0: bad_share / len(bad)})
    cut = (found[0] + (found[0] if found[1] is None else found[1])) / 2
    return RankModel(tuple(mean), tuple(scale), tuple(w), float(cut))


def _walk(entries: list[tuple[float, int, int]], below: float, wanted: float,
          weight: dict[int, float]) -> tuple[float, float | None]:
    """The score at which the summed weights reach ``wanted``, and that of the row after it, if in ``entries``.

    ``entries`` are (score, label, rows) in order; ``below`` is the weight before the first.
    """
    for i, (score, label, rows) in enumerate(entries):
        need = max(1, int(np.ceil((wanted - 1e-12 - below) / weight[label])))
        if need < rows:
            return score, score
        if need == rows or i == len(entries) - 1:
            return score, entries[i + 1][0] if i + 1 < len(entries) else None
        below += rows * weight[label]
    raise ValueError("no rows")


def _cut(raw: DataFrame, bad_share: float, weight: dict[int, float]) -> float:
    """The weighted quantile ``bad_share`` of ``raw(_q, _raw)``: between the row that reaches it and the next one.

    Ranges of the score are counted, and the one in which the quantile lies is
    looked at next, until it has few rows or a single value.
    """
    low, high, n = raw.agg(F.min("_raw"), F.max("_raw"), F.count(F.lit(1))).first()
    below, inside = 0.0, raw
    while n > SELECT_ROWS and low < high:
        width = (high - low) / BUCKETS
        bucket = F.least(F.floor((F.col("_raw") - F.lit(low)) / F.lit(width)), F.lit(BUCKETS - 1))
        counts = (inside.groupBy(bucket.alias("_b")).agg(
            F.count_if(F.col("_q") == 1).alias("good"), F.count_if(F.col("_q") == 0).alias("bad"),
            F.min("_raw").alias("low"), F.max("_raw").alias("high")).orderBy("_b").collect())
        for r in counts:
            held = r["good"] * weight[1] + r["bad"] * weight[0]
            if below + held >= bad_share - 1e-12:
                break
            below += held
        else:  # rounding alone keeps the last range from reaching it
            below -= held
        low, high, n = r["low"], r["high"], r["good"] + r["bad"]
        inside = raw.where(F.col("_raw").between(low, high))
    entries = (inside.groupBy("_raw", "_q").agg(F.count(F.lit(1)).alias("n"))
               .orderBy("_raw", F.desc("_q")).collect())
    here, after = _walk([tuple(r) for r in entries], below, bad_share, weight)
    if after is None:
        after = raw.where(F.col("_raw") > high).agg(F.min("_raw")).first()[0]
    return round((here + (here if after is None else after)) / 2, 9)


def held_out(doc_id: Column) -> Column:
    """True for the documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _unpack(batch: pa.RecordBatch, mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels and standardised features of a batch of ``(_q, _x)``."""
    x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
    return batch.column(0).to_numpy(zero_copy_only=False), (x - mean) / scale


def _fit(rows: DataFrame, bad_share: float) -> RankModel:
    """The model of ``rows(_q, _x)``, labels and features; every pass over them is one Spark job."""
    at = [F.col("_x")[i].cast("double") for i in range(N_FEATURES)]
    got = rows.agg(F.count_if(F.col("_q") == 1), F.count_if(F.col("_q") == 0), *map(F.avg, at), *map(F.stddev_pop, at)).first()
    if not (got[0] and got[1]):
        return RankModel((), (), None, 0.0)
    # as float32, so that the order in which tasks' sums are added does not show
    mean, scale = (np.array(got[k:k + N_FEATURES], np.float32).astype(float) for k in (2, 2 + N_FEATURES))
    scale[scale < 1e-9] = 1.0
    spark = rows.sparkSession

    def sums(w: np.ndarray) -> dict:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: dict = {}
            for b in batches:
                _add_sums(out, *_unpack(b, mean, scale), w)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in out], pa.int32()), pa.array([k[1] for k in out], pa.int64()),
                 pa.array([v.ravel() for v in out.values()], pa.list_(pa.float64()))], names=["_q", "_cell", "_sums"])

        def added(group: pa.Table) -> pa.Table:
            total = np.sum([np.asarray(v.values) for c in group.column(2).chunks for v in c], axis=0)
            return group.slice(0, 1).set_column(2, "_sums", pa.array([total], pa.list_(pa.float64())))

        schema = "_q int, _cell bigint, _sums array<double>"
        cells = map_arrow(rows, part, schema).groupBy("_q", "_cell").applyInArrow(added, schema).toArrow()
        return {(q, c): np.array(v).reshape(NODES, -1) for q, c, v in zip(*(x.to_pylist() for x in cells.columns))}

    def squares(at: _AllPairs) -> np.ndarray:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((N_FEATURES, N_FEATURES))
            for b in batches:
                at.add_squares(out, *_unpack(b, mean, scale))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size), pa.int32()), pa.array(out.ravel())],
                                             names=["_at", "_sum"])

        total = map_arrow(rows, part, "_at int, _sum double").groupBy("_at").agg(F.sum("_sum")).toArrow()
        out = np.zeros(N_FEATURES * N_FEATURES)
        out[total.column(0).to_numpy()] = total.column(1).to_numpy()
        return out.reshape(N_FEATURES, N_FEATURES)

    w = _newton(N_FEATURES, sums, squares)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q, z = _unpack(b, mean, scale)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(z @ w)], names=["_q", "_raw"])

    map_arrow(rows, scored, "_q int, _raw double").write.parquet(path := scratch_path(spark, "quality"))
    cut = _cut(spark.read.parquet(path), bad_share, {1: (1 - bad_share) / got[0], 0: bad_share / got[1]})
    return RankModel(tuple(mean), tuple(scale), tuple(w), cut)


def train(docs: DataFrame, labels: DataFrame, pairs: int | None = None, seed: int | None = None) -> RankModel:
    """Fit on every usable row of ``docs(doc_id, text)`` and ``labels(doc_id, quality)``.

    Documents that are not held out are measured in place; their features, not
    their texts, meet the labels, and are written once for the passes of the
    fit. ``pairs`` and ``seed`` chose a sample once; they have no effect.
    """
    quality = F.col("quality").try_cast("double")
    lab = (labels.select(F.col("doc_id").alias("_id"), quality.alias("_q"))
           .where("_q in (0, 1)").where(~held_out(F.col("_id")) & F.col("_id").isNotNull())
           .groupBy("_id").agg(F.min("_q").cast("int").alias("_q"), F.max("_q").alias("_q2"))
           .where("_q = _q2").drop("_q2"))
    counts = {r["_q"]: r["n"] for r in lab.groupBy("_q").agg(F.count("*").alias("n")).collect()}
    if not (counts.get(0) and counts.get(1)):
        return RankModel((), (), None, 0.0)
    plain = (docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
             .where(F.col("_id").isNotNull() & ~held_out(F.col("_id"))))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(Texts(b.column(1))).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(list(x), pa.list_(pa.float32()))], names=["_id", "_x"])

    schema = T.StructType([plain.schema["_id"], T.StructField("_x", T.ArrayType(T.FloatType()))])
    spark = docs.sparkSession
    (map_arrow(plain, measure, schema).groupBy("_id").agg(F.min("_x").alias("_x")).join(lab, "_id")
     .select("_q", "_x").write.parquet(path := scratch_path(spark, "quality")))
    return _fit(spark.read.parquet(path), counts[0] / (counts[0] + counts[1]))


def score_documents(docs: DataFrame, model: RankModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs(doc_id, text, ...)``."""
    plain = docs.select("doc_id", "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(features(Texts(b.column(1))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())],
                                             names=["doc_id", "score"])

    schema = T.StructType([plain.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return map_arrow(plain, score, schema).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: RankModel) -> DataFrame:
    """The rows of ``docs`` that the model accepts, all columns as they are."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(features(Texts(b.column(at)))) >= ACCEPT))

    return map_arrow(docs, keep, docs.schema)
