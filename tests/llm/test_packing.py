import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from cases import SCHEMA, documents, odd_rows, prose
from tokenizers import Tokenizer

from gapwise.llm import packing
from gapwise.llm.queries import op13_packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def _ids(texts):
    known = Tokenizer.from_file(PATH)
    return [e.ids + [1] for e in known.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def _check(rows, documents_ids, size):
    """Every id in exactly one piece, sequences gapless from 0, sums right; returns the share of padding."""
    pieces, want = Counter(), Counter()
    for doc_id, ids in documents_ids:
        for start in range(0, len(ids), size):
            part = np.array(ids[start:start + size], "<u4")
            want[doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    sequences = {}
    for r in rows:
        pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces == want
    assert sorted(sequences) == list(range(len(sequences)))
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        total += at
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / max(total, 1)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    share = _check(op13_packing(spark, SF).collect(), list(zip([d for d, _ in docs], _ids([t for _, t in docs]))), 2048)
    assert share < 0.02


@pytest.mark.parametrize("size", [16, 100, 2048])
def test_odd_rows(spark, size):
    rng = random.Random(13)
    rows = odd_rows() + [(50 + i % 7, prose(rng, rng.randint(0, 60)), "en", "s", 1) for i in range(80)]
    got = packing.pack_documents(documents(spark, rows), PATH, size).collect()
    _check(got, list(zip([r[0] for r in rows], _ids([r[1] for r in rows]))), size)
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), PATH, size).count() == 0


def test_ids_are_those_of_the_tokenizer():
    odd = ["ΑΣ ΣΑΣ. Σ x́ ́ ée \x1c a\x1cb  z  \x85k don't 'S'S ''re ẞ İstanbul ﬁ K Å",
           "<|endoftext|>a b<|startoftext|> <|endoftext", "日本 한 한̈ ̈́ क़ x̀̕ 𝔘𝔫",
           "12 ３ ²‍​ a　b\xa0c d", None, "", " \t\r\n\x0b\x0c"]
    odd += [f"{a}{chr(c)}{b}" for c in range(1, 0x500) for a, b in (("", ""), ("a", "b"), ("", "'s'"), ("1", " 2"))]
    words = packing.Words(open(PATH, encoding="utf-8").read())
    got = [np.frombuffer(x, "<u4").tolist() + [1] for x in words.ids(odd)]
    assert got == _ids(odd)


def _strict(histogram, size):
    """The placement done piece by piece: into the emptiest open pack that has room, else a new one."""
    packs = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            room = [size - sum(p) for p in packs]
            fits = [k for k, r in enumerate(room) if r >= length]
            if fits:
                packs[max(fits, key=room.__getitem__)].append(length)
            else:
                packs.append([length])
    return sorted(sum(p) for p in packs)


def test_patterns_follow_the_rule_and_hold_every_length():
    rng = random.Random(17)
    for k in range(60):
        size = rng.choice([8, 20, 64])
        histogram = {n: rng.randint(1, 12) for n in rng.sample(range(1, size + 1), rng.randint(1, 8))}
        packs = packing.fill_packs(histogram, size)
        held, fill = Counter(), []
        for count, pattern in packs:
            for length, each in pattern:
                held[length] += count * each
            fill += [sum(n * e for n, e in pattern)] * count
        assert held == histogram and sorted(fill) == _strict(histogram, size)


def test_work_does_not_depend_on_the_counts():
    rng = random.Random(19)
    histogram = {n: rng.randint(1, 10**12) for n in range(1, 2049)} | {1: 10**13}
    packs = packing.fill_packs(histogram)
    assert len(packs) < 3 * 2048 and len(packing.rank_ranges(histogram, packs)) < 40_000


def test_written_sequences(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packing.write_sequences(docs, PATH, f"{tmp_dir}/packed", size=256)
    rows = spark.read.parquet(f"{tmp_dir}/packed").collect()
    assert all(len(r.ids) == 256 or len(r.ids) & (len(r.ids) - 1) == 0 for r in rows)
    want = Counter(i for ids in _ids([r.text for r in docs.select("text").collect()]) for i in ids)
    got = Counter(i for r in rows for i in r.ids[:sum(r.segments)])
    assert got == want
