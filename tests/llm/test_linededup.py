import random
from collections import Counter

import numpy as np
from cases import SCHEMA, documents, odd_rows

from gapwise.llm import linededup
from gapwise.llm.mphash import MinimalPerfectHash

BLANKS = " \t\n\x0b\x0c\r"


def _key(line):
    return line.strip(BLANKS).translate({c: c + 32 for c in range(65, 91)})


def _brute(rows, min_docs):
    df = Counter(k for _, t, *_ in rows for k in {_key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not _key(x) or df[_key(x)] < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def _run(docs, min_docs):
    out = linededup.drop_lines(docs, min_docs)
    return Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect())


def test_against_brute_force(spark):
    rng = random.Random(5)
    pool = [f"Shared Line {i}" for i in range(30)] + ["Ünïcode ÄÖ", "  padded\t"]
    rows = odd_rows()
    for i in range(300):
        lines = [rng.choice(pool) if rng.random() < 0.3 else f"own {i} {j}" for j in range(rng.randint(1, 8))]
        if rng.random() < 0.2:
            lines.append(lines[0].upper() + "\r")
        rows.append((100 + i, "\n".join(lines), "en", "s", 1))
    assert _run(documents(spark, rows), 10) == _brute(rows, 10)
    assert _run(documents(spark, rows), 2) == _brute(rows, 2)


def test_many_shards_and_hot_lines(spark, monkeypatch):
    monkeypatch.setattr(linededup, "KEYS_PER_SHARD", 7)
    monkeypatch.setattr(linededup, "HOT_KEYS", 8)
    rows = [(i, f"everywhere\nown {i}\npair {i // 3}", "en", "s", 1) for i in range(120)]
    assert _run(documents(spark, rows), 3) == _brute(rows, 3)


def test_heavy_shards_are_copied(spark, monkeypatch):
    monkeypatch.setattr(linededup, "KEYS_PER_SHARD", 7)
    monkeypatch.setattr(linededup, "HOT_KEYS", 1)  # no key is hot
    monkeypatch.setattr(linededup, "HEAVY", 2)
    seen = []
    monkeypatch.setattr(linededup, "heavy_shards", lambda *a, f=linededup.heavy_shards: seen.append(f(*a)) or seen[-1])
    rows = [(i, f"everywhere\nown {i}\npair {i // 3}", "en", "s", 1) for i in range(120)] + odd_rows()
    assert _run(documents(spark, rows), 3) == _brute(rows, 3)
    assert max(r.copies for r in seen[0].collect()) > 1
    assert linededup.heavy_shards(spark.range(0), 2, 100, 10) is None


def test_empty_table_and_columns(spark):
    assert linededup.drop_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = documents(spark)
    out = linededup.drop_lines(docs)
    assert set(docs.columns) <= set(out.columns) and "n_dropped" in out.columns


def test_perfect_hash_is_minimal_and_survives_bytes():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 30_000):
        keys = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        index = MinimalPerfectHash.from_bytes(MinimalPerfectHash.build(keys).to_bytes())
        assert sorted(index.slots(keys)) == list(range(len(keys))) and len(index) == len(keys)
        others = rng.integers(0, 2**63, 100).astype(np.uint64)
        assert ((index.slots(others) >= -1) & (index.slots(others) < max(len(keys), 1))).all()


def test_equal_keys_share_the_arrays():
    a = np.array([1, 2, 2, 3], np.int64)
    arrays = linededup.LineArrays.from_row(*linededup.LineArrays.build(a, a, np.array([4, 5, 5, 300]), 10).to_row())
    assert arrays.count(a, a).tolist() == [4, 5, 5, 10]
    assert arrays.count(np.array([77]), np.array([78])).tolist() == [0]
