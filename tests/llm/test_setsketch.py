import random
import re

import numpy as np
from cases import SCHEMA, documents, odd_rows, prose
from pyspark.sql import functions as F

from gapwise.llm import setsketch
from gapwise.llm.arrowtext import mix
from gapwise.llm.components import connected_components


def _set(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def _brute(rows, k):
    rows = list(dict.fromkeys((i, t) for i, t, *_ in rows if i is not None))
    sets = {i: _set(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            c = len(sets[a] & sets[b])
            if c and 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def _corpus():
    rng = random.Random(6)
    rows, i = odd_rows(), 100
    for _ in range(25):
        words = prose(rng, rng.randint(60, 200)).split()
        for _ in range(rng.randint(1, 7)):  # drifting copies: chains, not only stars
            rows.append((i, " ".join(words), "en", "s", 1))
            i += rng.randint(1, 3)
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(["x", "y", "z"]) + str(rng.randint(0, 99))
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = _corpus()
    for k in (2, 5):
        want = _brute(rows, k)
        out = setsketch.near_duplicates(documents(spark, rows), words=k).collect()
        assert len(out) == len(rows)
        for r in out:
            if r.doc_id is not None:
                assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id], r


def test_large_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 3)
    rows = _corpus()
    want = _brute(rows, 2)
    for r in setsketch.near_duplicates(documents(spark, rows), words=2).collect():
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id][1]


def test_drop_leaves_one_of_each_group(spark):
    rows = _corpus()
    docs = documents(spark, rows)
    kept = setsketch.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, w in _brute(rows, 5).items() if w[2])
    assert ids.count(None) == 2


def test_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d", "en", "s", 1), (5, "a b c d", "en", "s", 1), (None, "q r s t", "en", "s", 1)]
    out = {(r.doc_id, r.component_id, r.kept) for r in
           setsketch.near_duplicates(documents(spark, rows), words=2).collect()}
    assert out == {(None, 5, False), (5, 5, True), (None, None, True)}


def _variant(text, *changes):
    words = text.split()
    for k, w in changes:
        words[k] = w
    return " ".join(words)


def test_clashing_and_missing_ids_are_members_like_others(spark):
    """Rows known by id and text: near copies without id, one id with several texts, each row in its group."""
    rng = random.Random(31)
    a, b, c, d = (" ".join(f"{x}{rng.randint(0, 9)}{i}" for i in range(120)) for x in "abcd")
    rows = [(None, a), (1, _variant(a, (50, "x"))), (None, _variant(a, (70, "y"))),        # near copies, two without id
            (2, b), (2, c), (2, b), (3, _variant(c, (60, "z"))),                         # one id, two texts, one repeated
            (None, d), (None, _variant(d, (40, "q"))), (None, d),                        # a group without any id
            (4, ""), (4, ""), (None, None), (None, " ")]
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in rows])
    got = setsketch.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=repr) == sorted([
        (None, 1, False), (1, 1, True), (None, 1, False), (2, 2, True), (2, 2, True), (2, 2, True), (3, 2, False),
        (None, None, True), (None, None, True), (None, None, True), (4, 4, True), (4, 4, True), (None, None, True),
        (None, None, True)], key=repr)
    kept = setsketch.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    texts = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert [t for t in texts if t[1] and t[1].strip()] == sorted(
        [(1, rows[1][1]), (2, b), (2, c), *[t for t in texts if t in ((None, d), (None, rows[8][1]))]], key=repr)
    assert len(texts) == 4 + 4  # one row of each of the four groups, and the four rows without words
    names = documents(spark, [(i, t, "en", "s", 1) for i, t in rows if t]).withColumn(
        "doc_id", F.concat(F.lit("n"), F.col("doc_id").cast("string")))
    assert setsketch.drop_near_duplicates(names).where("text = ' ' OR length(text) > 1").count() == 5


def test_hot_buckets_and_keys_either_way(spark, monkeypatch):
    rows = [*_corpus(), *_corpus()]
    want = _brute(rows, 2)
    monkeypatch.setattr(setsketch, "HOT_MEMBERS", 2)
    for most in (100_000, -1):
        monkeypatch.setattr(setsketch, "MAX_HOT", most)
        monkeypatch.setattr(setsketch, "MAX_ASKED", most)
        for r in setsketch.near_duplicates(documents(spark, rows), words=2).collect():
            if r.doc_id is not None:
                assert r.component_id == want[r.doc_id][1]


def test_empty_table(spark):
    assert setsketch.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    errors = []
    for share in (0.1, 0.5, 0.8, 0.95):
        for _ in range(30):
            n = 600
            pool = mix(rng.integers(0, 2**63, 2 * n).astype(np.uint64))
            common = int(2 * n * share / (1 + share))
            a = np.unique(pool[:common + (n - common)])
            b = np.unique(np.concatenate([pool[:common], pool[n:n + n - common]]))
            ra, rb = setsketch.registers(a), setsketch.registers(b)
            assert (setsketch.merge_registers(ra, rb) == setsketch.registers(np.union1d(a, b))).all()
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(setsketch.estimate(ra[None], rb[None], np.array([len(a)]), np.array([len(b)]))[0] - j)
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < setsketch.MARGIN


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (95, 90), (7, 7)]
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}
