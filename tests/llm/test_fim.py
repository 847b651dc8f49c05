import hashlib
import random
import re

import numpy as np
import pytest
from cases import SCHEMA, documents, odd_rows, prose

from gapwise.llm import fim


def _brute(doc_id, text, fim_percent=100, spm_percent=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= fim_percent:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def _rows():
    rng = random.Random(12)
    rows = odd_rows() + [(100 + i, "\n" * rng.randint(0, 3) + "\n".join(prose(rng, rng.randint(0, 9)) for _ in range(i % 17))
                          + rng.choice(["", "\n", "<", "<S", "<\nP>"]), "en", "s", 1) for i in range(300)]
    return rows + [(500, "a <P> b\nc", "en", "s", 9), (501, "x\n<M>", "en", "s", 5), (502, "\n\n\n", "en", "s", 3),
                   (503, "<S>", "en", "s", 3)]


def _key(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("share", [(100, 50), (60, 20), (0, 50)])
def test_against_brute_force(spark, share):
    rows = _rows()
    made = fim.transform(documents(spark, rows), 7, *share)
    want = [_brute(r[0], r[1], *share) for r in rows]
    assert _key(made.collect()) == _key(want)
    back = fim.restore_texts(made).collect()
    assert _key(back) == _key([(r[0], r[1] or "") for r in rows])
    digest = fim.round_trip(documents(spark, rows), 7, *share).collect()
    assert _key(digest) == _key([(*w[:5], hashlib.sha256(w[5].encode()).hexdigest(),
                                 hashlib.sha256((r[1] or "").encode()).hexdigest()) for w, r in zip(want, rows)])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fim.transform(empty).count() == fim.round_trip(empty).count() == 0


def test_rank_index_is_exact_and_error_bounded():
    rng = np.random.default_rng(1)
    for steps in (rng.integers(0, 5, 4000), rng.integers(0, 2, 3000) * rng.integers(0, 10**6, 3000),
                  np.repeat(7, 5000), rng.zipf(1.3, 3000) % 10**7, np.array([3])):
        offsets = np.cumsum(steps).astype(np.int64)
        for error in (0, 8, fim.ERROR):
            index = fim.RankIndex.fit(offsets, error)
            ranks = np.arange(len(offsets))
            assert np.array_equal(index.offsets(ranks), offsets)
            assert np.abs(offsets - index.predict(ranks)).max() <= error + 1
            assert index.residual.itemsize == 1
    assert len(fim.RankIndex.fit(np.arange(0, 70000, 7)).first) == 1
    with pytest.raises(ValueError):
        fim.RankIndex.fit(np.cumsum(rng.integers(0, 900, 4000)), 100_000)


def test_restore_refuses_what_is_no_output():
    for form, output in (("psm", b"abc"), ("spm", b"<P>a<S>b<M>c"), ("psm", b"<P>a<S>b")):
        with pytest.raises(ValueError):
            fim.restore(form, output)
