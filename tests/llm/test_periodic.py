import hashlib
import random
import time
import zlib

import pyarrow as pa
from cases import SCHEMA, documents, odd_rows, prose

from gapwise.llm import periodic
from gapwise.llm.arrowtext import Texts


def _brute_runs(words):
    """Every period, every maximal stretch of it, smallest periods only."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - start >= max(6, 4 * q):
                stretch = words[start:i]
                if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    found[start, i - start, q] = True
    return sorted((s, n, q) for s, n, q in found)


def _looped(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def _scan(text):
    return next(periodic.scan(Texts(pa.array([text], pa.string()))))[1]


def test_small_alphabets_against_brute_force():
    rng = random.Random(3)
    for k in range(1500):
        n = rng.randint(0, 90)
        words = [rng.choice("ab" if k % 3 else "abcd") for _ in range(n)]
        if k % 2:
            unit = words[:rng.randint(1, 9)]
            at = rng.randint(0, n)
            words = words[:at] + unit * rng.randint(1, 9) + words[at:] + unit * rng.randint(0, 6)
        if k % 5 == 0:
            inner = ["a"] * rng.randint(4, 9) + ["b"] * rng.randint(0, 7) + ["c"]
            words += inner * rng.randint(2, 7)
        assert _scan(" ".join(words)) == _brute_runs(words), words


def test_several_texts_at_once_do_not_meet():
    texts = ["a a a", "a a a", "x y " * 4, None, "", "x y x y", "z " * 6, "q r s " * 4 + "q"]
    got = [r for _, r in periodic.scan(Texts(pa.array(texts, pa.string())))]
    assert got == [[], [], [(0, 8, 2)], [], [], [], [(0, 6, 1)], [(0, 13, 3)]]


def test_queries_against_brute_force(spark):
    rng = random.Random(5)
    rows = odd_rows()[:6] + odd_rows()[7:] + [
        (1000 + i, prose(rng, rng.randint(0, 200)) + " la" * rng.choice([0, 0, 5, 6, 9]), "en", "s", 1) for i in range(150)]
    got = sorted(map(tuple, periodic.digest_runs(documents(spark, rows), loop_tails=True).collect()), key=repr)
    want, texts = [], []
    for doc_id, text, *_ in rows:
        words = _looped(doc_id, (text or "").encode().split())
        runs = _brute_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = b" ".join([w for i, w in enumerate(words) if i not in gone])
        top = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
        texts.append((doc_id, kept.decode()))
        want.append((doc_id, len(runs), *(top[0] if top else (None,) * 3),
                     1000 * top[0][1] // top[0][2] if top else None,
                     hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                     hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want, key=repr)
    assert sum(w[1] for w in want) > 20
    found = periodic.find_runs(documents(spark, rows), loop_tails=True)
    assert sorted(((r.doc_id, r.collapsed) for r in found.collect()), key=repr) == sorted(texts, key=repr)
    plain = {r.doc_id: r.runs for r in periodic.find_runs(documents(spark, rows)).collect()}
    assert [tuple(r) for r in plain[5]] == []
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic.digest_runs(empty).count() == periodic.find_runs(empty).count() == 0


def test_frequent_words_and_long_texts_stay_cheap():
    rng = random.Random(7)
    one = "a " * 200_000
    blocks = " ".join(" ".join(["a"] * rng.randint(3, 12) + ["b"]) for _ in range(3000))
    period = " ".join(prose(rng, 7000).split() * 9)
    for text, most in ((one, 12), (blocks, 12), (period, 6)):
        begin = time.process_time()
        runs = _scan(text)
        assert time.process_time() - begin < most
        words = text.split()
        for s, n, q in runs[:50]:
            assert words[s + q:s + n] == words[s:s + n - q]
    assert _scan(one) == [(0, 200_000, 1)] and _scan(period) == [(0, 63_000, 7000)]
