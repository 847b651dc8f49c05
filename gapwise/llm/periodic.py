"""Periodic runs of words by an online sparse diagonal programme.

A run is a stretch of words with smallest period q, of at least ``MIN_WORDS``
words and ``MIN_PERIODS`` periods, that no neighbouring word extends. On the
diagonal of lag q it is a chain of matches word[i] = word[i - q].

Words are read from left to right. At a word its earlier occurrences open lags;
an open lag's match length grows as long as the words agree (in blocks of words
compared at once), and a diagonal that ends with enough matches emits its run at
that moment. What keeps the programme sparse, without losing a run:

* an occurrence counts if the next ``GRAM`` words agree too, since every run has
  at least that many matches on its diagonal; documents in which no such gram
  recurs near enough, most of them, are passed over whole;
* lag d is opened only at words whose number is a multiple of the largest power
  of two not above d: a run's 3q matches always include such a word with that
  many matches after it. So at most 2 * n * log2(n) occurrences are looked at,
  however often a word recurs;
* a multiple of an open lag inside that lag's stretch starts and ends with it
  and is not opened.

Grams are compared by hash, words of candidate documents exactly.

Edge cases: a null or empty text has no words and no runs; repeated rows get
equal results; a null doc_id is kept (``loop_tails`` leaves its text as it is);
an empty table gives an empty result; words keep their case.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gapwise.llm.arrowtext import NON_SPACE, Texts, hash_spans, map_arrow, mix, tokens

MIN_WORDS, MIN_PERIODS = 6, 4
GRAM = 5
_BLOCK = 16

Run = tuple[int, int, int]  # start, length, period


def _matches_right(words: np.ndarray, i: int, lag: int) -> int:
    """The first number from i on whose word differs from the one ``lag`` before it."""
    step, n = _BLOCK, len(words)
    while i < n:
        stop = min(i + step, n)
        same = words[i:stop] == words[i - lag:stop - lag]
        if not same.all():
            return i + int(same.argmin())
        i, step = stop, step * 2
    return n


def _matches_left(words: np.ndarray, i: int, lag: int) -> int:
    """The smallest number from which on, up to i, every word equals the one ``lag`` before it."""
    step = _BLOCK
    while i > lag:
        start = max(i - step, lag)
        same = words[start:i] == words[start - lag:i - lag]
        if not same.all():
            return i - int(same[::-1].argmin())
        i, step = start, step * 2
    return lag


def runs_of(words: list, before: list[int], at: list[int]) -> list[Run]:
    """The runs of one document by start, then period.

    ``before[i]`` is the previous number whose next ``GRAM`` words are those of
    i, or -1; ``at`` are the numbers, ascending, that have one near enough.
    """
    number: dict = {}
    code = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    plain, n = code.tolist(), len(words)
    open_lags: dict[int, tuple[int, int]] = {}  # lag: first word of its stretch, word that ends it
    best: dict[tuple[int, int], int] = {}
    for i in at:
        reach = 2 * (i & -i)
        if len(open_lags) > 4:
            open_lags = {d: x for d, x in open_lags.items() if x[1] > i}
        j = before[i]
        while j >= 0 and i - j < reach:
            lag, here = i - j, j
            j = before[j]
            known = open_lags.get(lag)
            if known is not None and known[1] > i:
                continue
            if any(lag % d == 0 and start <= here and end > i for d, (start, end) in open_lags.items()):
                continue
            span = 1 << (lag.bit_length() - 1)
            if (i + span > n or plain[i + span - 1] != plain[here + span - 1]
                    or plain[i + span // 2] != plain[here + span // 2] or plain[i] != plain[here]):
                continue
            end = _matches_right(code, i, lag)
            first = _matches_left(code, i, lag)
            open_lags[lag] = (first - lag, end)
            length = end - first + lag
            if length >= max(MIN_WORDS, MIN_PERIODS * lag):
                stretch = (first - lag, length)
                best[stretch] = min(lag, best.get(stretch, lag))
    return sorted((start, length, lag) for (start, length), lag in best.items())


def earlier_grams(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For word hashes of several documents, ``before`` and ``at`` of ``runs_of``, as global numbers."""
    n = len(words)
    before = np.full(n, -1, np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    start = np.arange(max(n - GRAM + 1, 0))
    start = start[row[start] == row[start + GRAM - 1]] if len(start) else start
    key = mix(row[start].astype(np.uint64))
    for k in range(GRAM):
        key = mix(key * np.uint64(0xE7037ED1A0B428DB) + words[start + k])
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    before[start[order[1:][same]]] = start[order[:-1][same]]
    at = np.flatnonzero(before >= 0)
    place = at - bounds[row[at]]
    return before, at[at - before[at] < 2 * (place & -place)]


def loop_tail(doc_id, n: int) -> tuple[int, int] | None:
    """Where the looped tail of a document of n words starts and its period, for one id in ten."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def scan(texts: Texts, ids: list | None = None) -> Iterator[tuple[list[bytes], list[Run]]]:
    """(words, runs) of every text; with ``ids``, of the text with its tail looped by ``loop_tail``."""
    for a, b in texts.slices():
        data, offsets = texts.part(a, b)
        starts, ends, row = tokens(data, offsets, NON_SPACE)
        hashes = hash_spans(data, starts, ends)
        bounds = np.searchsorted(row, np.arange(b - a + 1))
        raw, tails = data.tobytes(), {}
        if ids is not None:
            source = np.arange(len(hashes))
            for k in range(b - a):
                first, n = int(bounds[k]), int(bounds[k + 1] - bounds[k])
                tail = loop_tail(ids[a + k], n)
                if tail:
                    tails[k] = tail
                    source[first + tail[0]:first + n] = first + tail[0] + np.arange(n - tail[0]) % tail[1]
            hashes = hashes[source]
        before, at = earlier_grams(hashes, bounds)
        split = np.searchsorted(at, bounds)
        for k in range(b - a):
            words = raw[offsets[k]:offsets[k + 1]].split()
            if k in tails:
                start, period = tails[k]
                words = [*words[:start], *(words[start + i % period] for i in range(len(words) - start))]
            if split[k] == split[k + 1]:
                yield words, []
                continue
            first = int(bounds[k])
            own = before[first:int(bounds[k + 1])]
            yield words, runs_of(words, np.where(own < 0, -1, own - first).tolist(),
                                 (at[split[k]:split[k + 1]] - first).tolist())


def collapse(words: list, runs: list[Run]) -> list:
    """The words that no run repeats: each run keeps its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def find_runs(docs: DataFrame, loop_tails: bool = False) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of ``docs(doc_id, text, ...)``.

    ``runs`` are (start, length, period) by start, then period; ``collapsed`` is
    the text with every run cut down to one period, words joined by one blank.
    """
    plain = docs.select("doc_id", "text")
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, kept = [], []
            for words, runs in scan(Texts(b.column(1)), b.column(0).to_pylist() if loop_tails else None):
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                kept.append(b" ".join(collapse(words, runs)).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(found, run_type), pa.array(kept, pa.string())],
                names=["doc_id", "runs", "collapsed"])

    item = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    return map_arrow(plain, run, T.StructType([
        plain.schema["doc_id"], T.StructField("runs", T.ArrayType(item)), T.StructField("collapsed", T.StringType())]))


def digest_runs(docs: DataFrame, loop_tails: bool = False) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row.

    The four numbers are those of the longest run, of the first one among
    equals; null where there is none.
    """
    plain = docs.select("doc_id", "text")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for words, runs in scan(Texts(b.column(1)), b.column(0).to_pylist() if loop_tails else None):
                top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
                listed = "".join([f"{s},{n},{p}\n" for s, n, p in runs])
                out.append((len(runs), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None,
                            hashlib.sha256(listed.encode()).hexdigest(),
                            hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest()))
            columns = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in columns[:5]],
                 *[pa.array(c, pa.string()) for c in columns[5:]]], names=names)

    return map_arrow(plain, run, T.StructType([
        plain.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in names[1:6]],
        *[T.StructField(c, T.StringType()) for c in names[6:]]]))
