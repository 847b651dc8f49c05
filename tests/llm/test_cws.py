import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from cases import SCHEMA, documents, odd_rows, prose

from gapwise.llm import cws
from gapwise.llm.arrowtext import Texts


def _terms(text):
    w = re.findall("[^\x20\x09-\x0d]+", text.translate({c: c + 32 for c in range(65, 91)}))
    return Counter(zip(w, w[1:])) if len(w) != 1 else Counter(w)


def _jaccard(a, b):
    a, b = _terms(a), _terms(b)
    both = sum((a | b).values())
    return sum((a & b).values()) / both if both else 1.0


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(4)
    errors = []
    for _ in range(60):
        base = [prose(rng, 1) for _ in range(120)] * rng.randint(1, 3)
        other = base[:rng.randint(10, len(base))] + [prose(rng, 1) for _ in range(rng.randint(1, 90))]
        a, b = " ".join(base), " ".join(other)
        x = cws.fingerprints(Texts(pa.array([a, b])))
        errors.append(float(cws.likeness(x[:1], x[1:])[0]) - _jaccard(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def _rows():
    rng = random.Random(8)
    return odd_rows()[:7] + odd_rows()[11:] + [(20 + i, prose(rng, rng.randint(1, 60)), "en", "s", 1)
                                              for i in range(60)]


def test_neighbours_against_brute_force(spark):
    rows = _rows()
    order = sorted(rows, key=lambda r: -r[0])
    for ranges in (1, 5, 200):
        got = {r.doc_id: r for r in cws.fingerprint_neighbours(documents(spark, rows), ranges).collect()}
        assert len(got) == len(rows)
        for i, (doc_id, text, *_) in enumerate(order):
            text, after = text or "", order[(i + 1) % len(order)][1] or ""
            m = len(text) // 3
            edited = text[:len(text) - m] + after[:m]
            r = got[doc_id]
            assert r.n_chars == len(text)
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert abs(r.near_edited - _jaccard(text, edited)) < 0.3
            x = cws.fingerprints(Texts(pa.array([text, edited, after], pa.string())))
            assert r.fingerprint == cws.as_string(x[0]) and r.edited_fingerprint == cws.as_string(x[1])
            assert r.near_next == float((x[0] == x[2]).mean())


def test_repeated_null_and_empty(spark):
    out = cws.fingerprint_neighbours(documents(spark), 4).collect()
    assert len(out) == len(odd_rows())
    plain = {r.doc_id: r.fingerprint for r in cws.fingerprint(documents(spark)).collect()}
    assert plain[1] == plain[2] == plain[3] == "0" * 4 * cws.SAMPLES
    assert plain[4] == plain[5] == plain[6] != plain[7]
    assert len({r.fingerprint for r in out if r.doc_id == 8}) == 1
    assert cws.fingerprint_neighbours(spark.createDataFrame([], SCHEMA)).count() == 0
    one = cws.fingerprint_neighbours(documents(spark, [(5, "a b c d", "en", "s", 7)])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(5, 1.0)]


def test_one_id_may_hold_most_rows(spark):
    rng = random.Random(5)
    rows = [(7 if i % 3 else None, prose(rng, 6) + f" {i}", "en", "s", 1) for i in range(300)]
    rows += [(i, prose(rng, 6), "en", "s", 1) for i in range(20)] + [(2**60 + i, f"big {i}", "en", "s", 1) for i in range(5)]
    dealt = cws.with_successor_ranges(documents(spark, rows).select("doc_id", "text"), 16, 4)
    sizes = Counter(r._range for r in dealt.where("_ahead = 0").select("_range").collect())
    assert sum(sizes.values()) == len(rows) and max(sizes.values()) < 70
    got = cws.fingerprint_neighbours(documents(spark, rows), 16).collect()
    assert len(got) == len(rows)
    # every row has a successor, and every row is one: the edited texts end with each text's start
    order = [r.asDict() for r in dealt.where("_ahead = 0").collect()]
    order.sort(key=lambda r: (-r["_key"], -r["_tie"], r["text"]))
    want = Counter()
    for i, r in enumerate(order):
        after, m = order[(i + 1) % len(order)]["text"], len(r["text"]) // 3
        want[(r["doc_id"], hashlib.sha256((r["text"][:len(r["text"]) - m] + after[:m]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == want


def test_plan_does_not_grow_with_the_ranges(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'some text' as text")
    def lines(ranges):
        plan = cws.with_successor_ranges(docs, ranges, 4)._jdf.queryExecution().optimizedPlan()
        assert "split(" not in plan.toString() and "Invoke" not in plan.toString()  # constants are folded
        return plan.numberedTreeString().count("\n")
    assert lines(4) == lines(4000)
