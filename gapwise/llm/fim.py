"""Fill-in-middle transformation, cut at line ends through a learned rank index.

A document's text is a row of lines ``[^\\n]*\\n|[^\\n]+``. A digest of the seed
and doc_id draws two cuts between lines and the form: ``psm`` is
``<P>prefix<S>suffix<M>middle``, ``spm`` is ``<S>suffix<P>prefix<M>middle``,
``plain`` the text itself.

The n-th line end is found through a piecewise-linear rank index over all line
boundaries of a slice of documents: segments are fitted greedily, each as long
as one line through its first point keeps every boundary within ``ERROR`` bytes;
the distance of each boundary from its prediction is kept in one byte. A cut is
predicted from its rank and corrected by the residual, which is exact.

A text that holds a sentinel stays plain, so no sentinel can be found in a piece
or across two pieces and every output is taken apart again without loss.

Edge cases: a null text is an empty one and stays plain; an empty prefix, middle
or suffix is legal; a null doc_id is drawn as the empty text; repeated rows get
equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gapwise.llm.arrowtext import Texts, map_arrow

SEED = 7
FIM_PERCENT, SPM_PERCENT = 100, 50
ERROR = 120
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_STEP = 64


class RankIndex:
    """Sorted offsets as error-bounded line segments and one residual byte for each rank."""

    def __init__(self, first: np.ndarray, base: np.ndarray, slope: np.ndarray, residual: np.ndarray):
        self.first, self.base, self.slope, self.residual = first, base, slope, residual

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        """``offsets`` must not decrease; ``error`` is at most 126."""
        n, start = len(offsets), 0
        first, base, slope = [], [], []
        while start < n:
            low, high, stop, step = -np.inf, np.inf, start + 1, _STEP
            while stop < n:
                end = min(stop + step, n)
                run = np.arange(stop, end) - start
                rise = offsets[stop:end] - offsets[start]
                lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
                highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
                apart = lows > highs
                fit = int(apart.argmax()) if apart.any() else end - stop
                if fit:
                    low, high = lows[fit - 1], highs[fit - 1]
                stop += fit
                if stop < end:
                    break
                step *= 2
            first.append(start)
            base.append(offsets[start])
            slope.append((low + high) / 2 if stop > start + 1 else 0.0)
            start = stop
        index = cls(np.array(first, np.int64), np.array(base, np.int64), np.array(slope),
                    np.zeros(n, np.int8))
        ranks = np.arange(n)
        residual = offsets - index.predict(ranks)
        index.residual = residual.astype(np.int8)
        if not np.array_equal(index.residual, residual):
            raise ValueError(f"an error of {error} does not fit one byte")
        return index

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[k] + np.rint(self.slope[k] * (ranks - self.first[k])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        return self.predict(ranks) + self.residual[ranks]


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the line boundaries of each row, its start first, and the rows' bounds.

    Row i owns the boundaries bounds[i]:bounds[i + 1], one more than it has lines.
    """
    ends = np.flatnonzero(data == 10) + 1
    rows = len(offsets) - 1
    starts, stops = offsets[:-1], offsets[1:]
    owner = np.searchsorted(offsets, ends - 1, side="right") - 1
    filled = stops > starts
    open_end = filled.copy()
    open_end[filled] = data[stops[filled] - 1] != 10
    where = np.concatenate([np.arange(rows), owner, np.flatnonzero(open_end)])
    value = np.concatenate([starts, ends, stops[open_end]])
    order = np.lexsort((value, where))
    return value[order], np.searchsorted(where[order], np.arange(rows + 1))


def draws(doc_id, seed: int = SEED) -> list[int]:
    """The four numbers that place the cuts and choose the form."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def compose(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == "psm":
        return b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])
    if form == "spm":
        return b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
    return prefix + middle + suffix


def restore(form: str, output: bytes) -> bytes:
    """The text that an output was made of."""
    if form == "plain":
        return output
    mark, other = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, sep, rest = output.partition(other)
    second, last, middle = rest.partition(MIDDLE)
    if not output.startswith(mark) or not sep or not last:
        raise ValueError(f"not an output of form {form}")
    one = head[len(mark):]
    return one + middle + second if form == "psm" else second + middle + one


def transform_texts(texts: Texts, ids: list, seed: int = SEED, fim_percent: int = FIM_PERCENT,
                    spm_percent: int = SPM_PERCENT) -> Iterator[tuple]:
    """(n, form, prefix_chars, middle_chars, output) of every text."""
    for a, b in texts.slices():
        data, offsets = texts.part(a, b)
        value, bounds = boundaries(data, offsets)
        index, lines = RankIndex.fit(value), np.diff(bounds) - 1
        drawn = [draws(i, seed) for i in ids[a:b]]
        cuts = np.array([sorted((h[0] % (n + 1), h[1] % (n + 1))) for h, n in zip(drawn, lines.tolist())],
                        np.int64).reshape(-1, 2)
        cuts = index.offsets(bounds[:-1, None] + cuts)
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        prefix = points[cuts[:, 0]] - points[offsets[:-1]]
        middle = points[cuts[:, 1]] - points[cuts[:, 0]]
        raw = data.tobytes()
        for k, (c, d) in enumerate(cuts.tolist()):
            text = raw[offsets[k]:offsets[k + 1]]
            if (not text or drawn[k][2] % 100 >= fim_percent
                    or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))):
                yield int(lines[k]), "plain", None, None, text
                continue
            form = "spm" if drawn[k][3] % 100 < spm_percent else "psm"
            yield (int(lines[k]), form, int(prefix[k]), int(middle[k]),
                   compose(form, raw[offsets[k]:c], raw[c:d], raw[d:offsets[k + 1]]))


_SHARED = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())]


def _columns(rows: list[tuple]) -> list[pa.Array]:
    n, form, prefix, middle, *_ = zip(*rows) if rows else [()] * 5
    return [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
            pa.array(middle, pa.int64())]


def transform(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs(doc_id, text, ...)``."""
    plain = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(transform_texts(Texts(b.column(1)), b.column(0).to_pylist(), seed, fim_percent, spm_percent))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *_columns(rows), pa.array([r[4].decode() for r in rows], pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return map_arrow(plain, run, T.StructType([plain.schema["doc_id"], *_SHARED,
                                               T.StructField("output", T.StringType())]))


def restore_texts(made: DataFrame) -> DataFrame:
    """(doc_id, text) of every row of ``made(doc_id, form, output, ...)``."""
    plain = made.select("doc_id", "form", "output")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [restore(form, output.encode()).decode()
                    for form, output in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    return map_arrow(plain, run, T.StructType([plain.schema["doc_id"], T.StructField("text", T.StringType())]))


def round_trip(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT,
               spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row."""
    plain = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, made, restored = [], [], []
            for r in transform_texts(Texts(b.column(1)), b.column(0).to_pylist(), seed, fim_percent, spm_percent):
                rows.append(r[:4] + (None,))
                made.append(hashlib.sha256(r[4]).hexdigest())
                restored.append(hashlib.sha256(restore(r[1], r[4])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *_columns(rows), pa.array(made, pa.string()), pa.array(restored, pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    return map_arrow(plain, run, T.StructType([
        plain.schema["doc_id"], *_SHARED, T.StructField("output_sha256", T.StringType()),
        T.StructField("restored_sha256", T.StringType())]))


SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS l,
         sha256('7:' || CAST(doc_id AS VARCHAR)) AS h FROM documents
), u AS (
  SELECT *, CASE WHEN t = '' OR ends_with(t, chr(10)) THEN len(l) - 1 ELSE len(l) END AS n FROM d
), c AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS y,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS q, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS s FROM u
), k AS (SELECT *, least(x, y) AS a, greatest(x, y) AS b FROM c
), p AS (
  SELECT *, CASE a WHEN n THEN t WHEN 0 THEN '' ELSE array_to_string(l[1:a], chr(10)) || chr(10) END AS head,
         CASE b WHEN n THEN t WHEN 0 THEN '' ELSE array_to_string(l[1:b], chr(10)) || chr(10) END AS both_parts FROM k
), f AS (
  SELECT doc_id, t, n, head, substr(both_parts, length(head) + 1) AS mid, substr(t, length(both_parts) + 1) AS tail,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR q >= 100 THEN 'plain'
              WHEN s < 50 THEN 'spm' ELSE 'psm' END AS form FROM p
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(head) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || mid
              ELSE '<S>' || tail || '<P>' || head || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""
