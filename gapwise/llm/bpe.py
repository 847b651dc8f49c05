"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens by a pattern. First tier: a minimal perfect hash
over the vocabulary resolves pre-tokens that are whole tokens; the slot's
stored hash and bytes confirm the hit. Second tier: the others are merged from
single bytes; a heap holds the mergeable neighbours by (rank, position) and a
linked list holds the parts, so the lowest rank is merged first, leftmost among
equals, in O(n log n) for a pre-token of n bytes. Ids are the ranks. Special
tokens are never recognised.

Pre-tokens repeat, so each worker remembers up to ``REMEMBERED`` of them; that
bounds its memory and changes no result. The vocabulary (about 1 MB, at most
``MAX_VOCABULARY_BYTES``) is read once from a path parameter and broadcast.

Edge cases: a null text is encoded as an empty one, which has no ids; repeated
rows get equal results; null doc_ids are kept; an empty table gives an empty
result. An id outside the vocabulary cannot be decoded and raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gapwise.llm.arrowtext import hash_spans, map_arrow
from gapwise.llm.mphash import MinimalPerfectHash

MAX_VOCABULARY_BYTES = 64 << 20
REMEMBERED = 300_000
_GROUP = 1 << 18


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary of more than {MAX_VOCABULARY_BYTES} bytes")
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())
            if token}


def _hashes(pieces: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(p) for p in pieces])
    data = np.frombuffer(b"".join(pieces), np.uint8)
    return hash_spans(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.cut = ranks, regex.compile(pattern)
        tokens = list(ranks)
        hashes = _hashes(tokens)
        self.whole = MinimalPerfectHash.build(hashes)
        slots = self.whole.slots(hashes)
        self.slot_hash = np.zeros(len(tokens), np.uint64)
        self.slot_hash[slots] = hashes
        self.slot_token: list[bytes] = [b""] * len(tokens)
        for slot, token in zip(slots.tolist(), tokens):
            self.slot_token[slot] = token
        self.known: dict[str, str] = {}
        self.bytes_of = {str(rank): token for token, rank in ranks.items()}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token, from single bytes."""
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))          # end of the part that starts here; 0: merged away
        before = list(range(-1, n - 1))      # start of the part before
        heap = []
        for i in range(n - 1):
            rank = ranks.get(piece[i:i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two parts has changed since
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                rank = ranks.get(piece[i:end[stop]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[stop]))
            if before[i] >= 0:
                rank = ranks.get(piece[before[i]:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def _learn(self, pre_tokens: list[str]) -> None:
        pieces = [t.encode() for t in pre_tokens]
        hashes = _hashes(pieces)
        slots = self.whole.slots(hashes)
        hit = (slots >= 0) & (self.slot_hash[slots] == hashes)
        for text, piece, slot, found in zip(pre_tokens, pieces, slots.tolist(), hit.tolist()):
            if found and self.slot_token[slot] == piece:
                self.known[text] = str(self.ranks[piece])
            else:
                self.known[text] = " ".join(map(str, self.merge(piece)))

    def encode(self, texts: list[str]) -> Iterator[str]:
        """The ids of every whole text, in decimal, joined by single blanks."""
        start = 0
        while start < len(texts):
            group, size = [], 0
            while start < len(texts) and size < _GROUP:
                group.append(self.cut.findall(texts[start]))
                size += len(texts[start])
                start += 1
            if len(self.known) > REMEMBERED:
                self.known.clear()
            new = set().union(*group).difference(self.known)
            if new:
                self._learn(list(new))
            known = self.known
            for pre_tokens in group:
                yield " ".join([known[t] for t in pre_tokens])

    def decode(self, ids: str) -> bytes:
        """The bytes of ids in decimal, joined by single blanks."""
        table = self.bytes_of
        try:
            return b"".join([table[i] for i in ids.split(" ")]) if ids else b""
        except KeyError as e:
            raise ValueError(f"id {e} is not in the vocabulary") from None


_encoders: dict[str, Encoder] = {}


class Shared:
    """A vocabulary and pattern as a broadcast; each worker makes one encoder of it."""

    def __init__(self, spark, ranks: dict[bytes, int], pattern: str):
        self.id, self.variable = uuid.uuid4().hex, spark.sparkContext.broadcast((ranks, pattern))

    def __getstate__(self):
        return {"id": self.id, "variable": self.variable}

    def encoder(self) -> Encoder:
        if self.id not in _encoders:
            _encoders.clear()
            _encoders[self.id] = Encoder(*self.variable.value)
        return _encoders[self.id]


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs(doc_id, text, ...)``."""
    shared, plain = Shared(docs.sparkSession, ranks, pattern), docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.encoder()
        for b in batches:
            ids = [[int(i) for i in e.split()] for e in encoder.encode(_texts(b.column(1)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["doc_id", "ids"])

    return map_arrow(plain, run, T.StructType([
        plain.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, content) of every row of ``encoded(doc_id, ids, ...)``; null ids read as none."""
    shared, plain = Shared(encoded.sparkSession, ranks, pattern), encoded.select("doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.encoder()
        for b in batches:
            out = [encoder.decode(" ".join(map(str, ids or []))) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())],
                                             names=["doc_id", "content"])

    return map_arrow(plain, run, T.StructType([plain.schema["doc_id"],
                                               T.StructField("content", T.BinaryType())]))


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): texts encoded, and the ids decoded again."""
    shared, plain = Shared(docs.sparkSession, ranks, pattern), docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.encoder()
        for b in batches:
            counts, ids, decoded = [], [], []
            for e in encoder.encode(_texts(b.column(1))):
                counts.append(e.count(" ") + 1 if e else 0)
                ids.append(hashlib.sha256(e.encode()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(e)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(plain, run, T.StructType([
        plain.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))
