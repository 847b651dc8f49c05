"""Packing documents into sequences of a fixed size, shortest pack first over the length histogram.

Every document is tokenised, closed by an end id and cut into pieces: full
sequences and a rest. Only the histogram of piece lengths (at most ``size``
rows) is placed: lengths from the longest to the shortest, each into the packs
that are filled least, as long as it fits; packs with equal contents are one
pattern with a count, so the work depends on the size of a sequence and not on
the number of documents. Pieces are then ranked by one distributed sort on
(length, doc_id, start); a piece's rank names its pattern, the copy of the
pattern, and the place inside it.

A length's share of a pattern is a range of ranks: there are at most as many
ranges as placements, a few thousand for 2,048 ids, whatever the input.

Tokenising: plain Latin texts are cut into the words that the vocabulary's
pattern finds, others at ASCII white space, which no token crosses; each worker
remembers the ids of about ``REMEMBERED`` words and gives the others to the
tokenizer, which bounds its memory and changes no result.

Edge cases: a null text is an empty one and has the end id only; null and
repeated doc_ids are rows like others; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.arrowtext import map_arrow
from gapwise.operators.ids import dense_index
from gapwise.session import checkpoint_root

SIZE = 2048
END_ID = 1
REMEMBERED = 700_000
_JOINED, _GROUP = 5_000, 1 << 20
#: Texts whose characters have the same lower case and class in every Unicode version, and the parts into
#: which the vocabulary's pattern cuts them once they are lower-cased.
_PLAIN = re.compile("[\t-\r -~\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f]*")
_PART = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\u017f]+|[0-9]|[^\\sa-z0-9\xdf-\xf6\xf8-\u017f]+")
MAX_VOCABULARY_BYTES = 64 << 20


class Words:
    """A tokenizer with the ids of known words, as little-endian 32-bit bytes."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        marks = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = re.compile("|".join(marks) or "(?!)")
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Words are tokenised joined by blanks; an id belongs to the word where it starts."""
        for k in range(0, len(words), _JOINED):
            some = words[k:k + _JOINED]
            made = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            starts = np.cumsum([0, *(len(w) + 1 for w in some)])
            begin = np.array([a for a, _ in made.offsets], np.int64)
            cuts = (4 * np.searchsorted(begin, starts)).tolist()
            ids = np.array(made.ids, "<u4").tobytes()
            self.known.update(zip(some, map(ids.__getitem__, map(slice, cuts, cuts[1:]))))

    def cut(self, text: str) -> list[str]:
        """The words of a text: parts where it is plain, else what stands between ASCII white space."""
        if _PLAIN.fullmatch(text) and not self.mark.search(text):
            return _PART.findall(text.lower())
        out = []
        for word in text.encode().split():
            word = word.decode()
            if _PLAIN.fullmatch(word) and not self.mark.search(word):
                out += _PART.findall(word.lower())
            else:
                out.append(word)
        return out

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of every whole text."""
        start = 0
        while start < len(texts):
            group, size = [], 0
            while start < len(texts) and size < _GROUP:
                group.append(self.cut(texts[start] or ""))
                size += len(texts[start] or "")
                start += 1
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self._learn(list(set().union(*group).difference(self.known)))
            known = self.known
            for words in group:
                yield b"".join([known[w] for w in words])


_words: dict[str, Words] = {}


class Shared:
    """A tokenizer's definition as a broadcast (one file of bounded size); each worker reads it once."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            definition = f.read(MAX_VOCABULARY_BYTES + 1)
        if len(definition) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"tokenizer of more than {MAX_VOCABULARY_BYTES} characters")
        self.id, self.variable = uuid.uuid4().hex, spark.sparkContext.broadcast(definition)

    def __getstate__(self):
        return {"id": self.id, "variable": self.variable}

    def words(self) -> Words:
        if self.id not in _words:
            _words.clear()
            _words[self.id] = Words(self.variable.value)
        return _words[self.id]


def cut_pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID,
               with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every piece of ``docs(doc_id, text, ...)``."""
    shared, plain = Shared(docs.sparkSession, tokenizer), docs.select("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.words()
        for b in batches:
            row, rest, ids = [], [], []
            for k, made in enumerate(words.ids(b.column(1).to_pylist())):
                made += end
                n = len(made) // 4
                for start in range(0, n, size):
                    piece = made[4 * start:4 * (start + size)]
                    row.append(k)
                    rest.append((start, len(piece) // 4, zlib.crc32(piece), n))
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<i4"))
            columns = list(zip(*rest)) if rest else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), *[pa.array(c, pa.int64()) for c in columns],
                 *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else [])], names=names)

    fields = [plain.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in names[1:5]]]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return map_arrow(plain, run, T.StructType(fields))


#: (length, how many) of a pattern's pieces, longest first.
Pattern = tuple[tuple[int, int], ...]


def fill_packs(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, Pattern]]:
    """(count, pattern) of the packs that the lengths of the histogram fill."""
    packs: list[list[tuple[int, Pattern]]] = [[] for _ in range(size + 1)]  # by free room

    for length in sorted(histogram, reverse=True):
        left, room = histogram[length], size
        while left:
            while room >= length and not packs[room]:
                room -= 1
            if room < length:  # no pack has room: new ones, filled as far as this length goes
                each = size // length
                for count, more in ((left // each, each), (1, left % each)):
                    if count and more:
                        packs[size - more * length].append((count, ((length, more),)))
                break
            count, pattern = packs[room].pop()
            n = min(count, left)
            if count > n:
                packs[room].append((count - n, pattern))
            more = 1
            if pattern[-1][0] == length:
                pattern, more = pattern[:-1], pattern[-1][1] + 1
            packs[room - length].append((n, (*pattern, (length, more))))
            left -= n
    return [pack for free in packs for pack in free]


def rank_ranges(histogram: dict[int, int], packs: list[tuple[int, Pattern]]) -> np.ndarray:
    """Rows (first rank, first sequence, pieces per sequence, offset, length), by first rank.

    Ranks number all pieces from 0 by length; every pattern takes the next ranks
    of each of its lengths.
    """
    following, rank = {}, 0
    for length in sorted(histogram):
        following[length] = rank
        rank += histogram[length]
    rows, sequence = [], 0
    for count, pattern in packs:
        offset = 0
        for length, each in pattern:
            rows.append((following[length], sequence, each, offset, length))
            following[length] += each * count
            offset += each * length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack_pieces(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``pieces(doc_id, start, length, ...)`` with sequence_id and offset."""
    checkpoint_root(pieces.sparkSession)
    pieces = pieces.checkpoint()
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 0 < length <= size for length in histogram):
        raise ValueError(f"pieces must have 1 to {size} ids")
    table = rank_ranges(histogram, fill_packs(histogram, size))
    ranked = dense_index(pieces, ["length", "doc_id", "start"], name="_rank", start=0)
    at, names = ranked.columns.index("_rank"), [*pieces.columns, "sequence_id", "offset"]
    shared = pieces.sparkSession.sparkContext.broadcast(table)  # some thousand rows, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, sequence, each, offset, length = shared.value.T
        for b in batches:
            rank = b.column(at).to_numpy()
            k = np.searchsorted(first, rank, side="right") - 1
            copy, place = np.divmod(rank - first[k], each[k])
            kept = [c for i, c in enumerate(b.columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence[k] + copy, pa.int64()), pa.array(offset[k] + place * length[k], pa.int64())],
                names=names)

    return map_arrow(ranked, run, T.StructType([
        *pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    return pack_pieces(cut_pieces(docs, tokenizer, size, end_id), size)


def write_sequences(docs: DataFrame, tokenizer: str, path: str, size: int = SIZE, end_id: int = END_ID,
                    pad_id: int = 0) -> None:
    """Write (sequence_id, ids, segments) as Parquet, ``segments`` being the pieces' lengths in order.

    A sequence is padded to ``size`` unless its length is a power of two.
    """
    packed = pack_pieces(cut_pieces(docs, tokenizer, size, end_id, with_ids=True), size)
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    n = F.size("ids")
    padded = F.concat("ids", F.array_repeat(F.lit(pad_id), F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(size - n)))
    (parts.select("sequence_id", ids.alias("ids"), F.transform("p", lambda x: F.size(x["ids"])).alias("segments"))
     .withColumn("ids", padded).write.parquet(path))
