"""Token counts by a linear longest-match automaton.

Words are split greedily into the longest pieces of a vocabulary, from left to
right. The vocabulary's entries form a trie over bytes, in which an entry that
ends a word ends with the symbol ``END``. Every trie node has a failure link and
a popped count: when no edge fits, following the link pops the pieces that the
greedy split has settled, and the count says how many, so a word is counted in
one pass over its bytes without backing up and without building pieces:

* a node that spells an entry links to the root and pops one piece;
* any other node takes its parent's popped count and link, and from there pops
  on until the edge's symbol fits.

A word that cannot be split into entries counts as one unknown token; a
vocabulary that has every single byte, alone and with ``END``, has none.

Texts are lower-cased (NFC) and cut into words by the vocabulary's pattern.
Words repeat, so each worker remembers the counts of up to ``REMEMBERED`` of
them, which bounds its memory and changes no result.

Edge cases: a null or empty text has 0 tokens; repeated rows get equal results;
null doc_ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import unicodedata
import uuid
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gapwise.llm.arrowtext import map_arrow

END = 256
REMEMBERED = 400_000
#: Fixed value: how the vocabulary's tokenizer cuts texts into words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SUFFIX = "</w>"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabulary files.

    Printable Latin-1 characters stand for themselves; the other bytes, in
    order, for the characters from U+0100 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_entries(path: str) -> list[tuple[int, ...]]:
    """The entries of a tokenizer file with word ends, as symbols 0 to 255 and ``END``."""
    with open(path, encoding="utf-8") as f:
        names = json.load(f)["model"]["vocab"]
    byte = byte_alphabet()
    out = []
    for name in names:
        ends = name.endswith(_SUFFIX)
        body = name.removesuffix(_SUFFIX) if ends else name
        out.append(tuple(byte[c] for c in body) + ((END,) if ends else ()))
    return [e for e in out if e and e != (END,)]


def words_of(text: str, cut: regex.Pattern) -> list[str]:
    return cut.findall(unicodedata.normalize("NFC", text).lower())


class LongestMatch:
    def __init__(self, entries: Iterable[tuple[int, ...]]):
        self.next: list[dict[int, int]] = [{}]
        spells = [False]
        for entry in entries:
            node = 0
            for symbol in entry:
                if symbol not in self.next[node]:
                    self.next[node][symbol] = len(self.next)
                    self.next.append({})
                    spells.append(False)
                node = self.next[node][symbol]
            spells[node] = True
        #: Failure link (-1: none) and number of pieces popped on following it.
        self.link, self.popped = [-1] * len(self.next), [0] * len(self.next)
        todo = deque([0])
        while todo:
            parent = todo.popleft()
            for symbol, node in self.next[parent].items():
                todo.append(node)
                if spells[node]:
                    self.link[node], self.popped[node] = 0, 1
                    continue
                count, at = self.popped[parent], self.link[parent]
                while at >= 0 and symbol not in self.next[at]:
                    count, at = count + self.popped[at], self.link[at]
                if at >= 0:
                    self.link[node], self.popped[node] = self.next[at][symbol], count

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match pieces of one word; 1 for an unknown word, 0 for none."""
        if not word:
            return 0
        node, count = 0, 0
        for symbol in (*word, END):
            while symbol not in self.next[node]:
                count, node = count + self.popped[node], self.link[node]
                if node < 0:
                    return 1
            node = self.next[node][symbol]
        while node > 0:
            count, node = count + self.popped[node], self.link[node]
        return count if node == 0 else 1


class Counter(dict):
    """Remembered counts of words."""

    def __init__(self, entries: list[tuple[int, ...]], pattern: str):
        self.match, self.cut = LongestMatch(entries), regex.compile(pattern)

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        n = self[word] = self.match.count(word.encode())
        return n

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, words_of(text, self.cut)))


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, entries: list[tuple[int, ...]], pattern: str = WORD) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row of ``docs(doc_id, text, ...)``.

    The entries (a vocabulary, some MB) are broadcast.
    """
    plain = docs.select("doc_id", "text")
    shared, key = docs.sparkSession.sparkContext.broadcast((entries, pattern)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _counters:
            _counters.clear()
            _counters[key] = Counter(*shared.value)
        counter = _counters[key]
        for b in batches:
            words, tokens = [], []
            for text in b.column(1):
                found = words_of(text.as_py() or "", counter.cut)
                words.append(len(found))
                tokens.append(sum(map(counter.__getitem__, found)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_words", "n_tokens"])

    return map_arrow(plain, run, T.StructType([
        plain.schema["doc_id"], T.StructField("n_words", T.LongType()),
        T.StructField("n_tokens", T.LongType())]))
