import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from cases import SCHEMA, documents, odd_rows, prose

from gapwise.llm import bpe, wordpiece

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENTRIES = wordpiece.load_entries(public_tokenizers.path("word_bpe_49k.json"))


def _texts():
    rng = random.Random(2)
    strange = ["don't we'll  \n\n\t x", "x" * 3000, "日本語のテキスト", "🙂🙃 áè", "<|endoftext|>", " ", "  z",
               "1234567890 3.14", "".join(chr(rng.randint(1, 0x2FFF)) for _ in range(2000)), "\x00\x01", "aAbB" * 500]
    return strange + [prose(rng, 80) for _ in range(40)]


def _rows():
    return odd_rows() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(_texts())]


def test_encoding_equals_the_reference_tokenizer(spark):
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    rows = _rows()
    out = bpe.round_trip(documents(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for i, t, *_ in rows:
        ids = known.encode_ordinary(t or "")
        want.append((str(i), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((str(r.doc_id), *r[1:]) for r in out) == sorted(want)


def test_encode_then_decode(spark):
    docs = documents(spark, _rows())
    back = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert sorted((str(r.doc_id), bytes(r.content)) for r in back.collect()) == sorted(
        (str(i), (t or "").encode()) for i, t, *_ in _rows())


def test_forgetting_changes_nothing_and_unknown_ids_raise(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "_GROUP", 10)
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    for text, ids in zip(_texts(), encoder.encode(_texts())):
        assert ids == " ".join(map(str, known.encode_ordinary(text)))
    with pytest.raises(ValueError):
        encoder.decode("999999")


def _greedy(word, entries, longest):
    s, i, n = (*word.encode(), wordpiece.END), 0, 0
    while i < len(s):
        j = next((j for j in range(min(len(s), i + longest), i, -1) if s[i:j] in entries), None)
        if j is None:
            return 1
        i, n = j, n + 1
    return n


def test_counts_equal_greedy_longest_match(spark):
    entries, longest = set(ENTRIES), max(map(len, ENTRIES))
    cut = regex.compile(wordpiece.WORD)
    rows = _rows()
    out = wordpiece.count_tokens(documents(spark, rows), ENTRIES).collect()
    want = []
    for i, t, *_ in rows:
        words = wordpiece.words_of(t or "", cut)
        want.append((str(i), len(words), sum(_greedy(w, entries, longest) for w in words)))
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in out) == sorted(want)


def test_small_vocabularies_with_unknown_words():
    rng = random.Random(1)
    for _ in range(200):
        entries = {tuple(rng.choice(b"ab") for _ in range(rng.randint(1, 5))) + rng.choice([(), (wordpiece.END,)])
                   for _ in range(rng.randint(1, 12))}
        match = wordpiece.LongestMatch(entries)
        for _ in range(20):
            word = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
            assert match.count(word.encode()) == _greedy(word, entries, 9), (entries, word)
    assert match.count(b"") == 0


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert wordpiece.count_tokens(empty, ENTRIES).count() == 0
