import random
import re
import string

import numpy as np
import pyarrow as pa
from cases import SCHEMA, documents, odd_rows, prose

from gapwise.llm import quality
from gapwise.llm.arrowtext import Texts


def _corpus(n=400):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.75
        text = prose(rng, rng.randint(30, 120))
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), " | ".join(text.split()), "spam " * 60,
                               " ".join(w + "%%%" for w in text.split())])
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy_and_edge_rows(spark):
    rows, labels = _corpus()
    docs = documents(spark, [(a + 100, *r) for a, *r in rows] + odd_rows())
    lab = spark.createDataFrame([(a + 100, q) for a, q in labels] + [(None, 1), (4, None), (5, 7), (8, 0), (8, 1)],
                                "doc_id bigint, quality int")
    model = quality.train(docs, lab, pairs=5000)
    out = [r.asDict() for r in quality.score_documents(docs, model).collect()]
    assert len(out) == len(rows) + len(odd_rows())
    truth = {a + 100: q for a, q in labels}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    assert len({r["score"] for r in out if r["doc_id"] == 8}) == 1
    assert {r["held_out"] for r in out if r["doc_id"] is None} == {False}
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema
    assert kept.count() == sum(r["predicted"] for r in out)


def test_scores_come_from_the_text_alone(spark):
    rows, labels = _corpus(120)
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = quality.train(documents(spark, rows), lab, pairs=2000)
    moved = documents(spark, [(i + 5000, t, "xx", "other", 1) for i, t, *_ in rows])
    a = {r.doc_id: r.score for r in quality.score_documents(documents(spark, rows), model).collect()}
    b = {r.doc_id - 5000: r.score for r in quality.score_documents(moved, model).collect()}
    assert a == b


def test_pairs_decide_and_cut_is_the_share_of_bad_labels():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 0.5, (300, 3)), rng.normal(-1, 0.5, (100, 3))
    model = quality.fit_pairs(good, bad, 0.25, pairs=4000)
    assert (model.score(good) >= quality.ACCEPT).mean() > 0.95
    assert (model.score(bad) >= quality.ACCEPT).mean() < 0.05
    both = model.score(np.concatenate([good, bad]))
    assert abs((both < quality.ACCEPT).mean() - 0.25) < 0.02


def test_nothing_to_learn_and_empty_tables(spark):
    lab = spark.createDataFrame([], "doc_id bigint, quality int")
    docs = documents(spark)
    model = quality.train(docs, lab)
    assert {r.score for r in quality.score_documents(docs, model).collect()} == {quality.NEUTRAL}
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.score_documents(empty, quality.train(empty, lab)).count() == 0


def _plain_features(text):
    """The style measures of one text, counted one by one."""
    data = (text or "").encode()
    n = max(len(data), 1)
    stops, blank = b".,;:?'\"-()", b" \t\n\x0b\x0c\r"
    letter = string.ascii_letters.encode()

    def symbol(c):
        return 33 <= c < 127 and c not in letter and c not in string.digits.encode() and c not in stops

    tests = [lambda c: c in string.ascii_uppercase.encode(), lambda c: c in string.digits.encode(),
             lambda c: c in stops, symbol, lambda c: c in blank, lambda c: c == 10, lambda c: c >= 128]
    out = [sum(1 for c in data if t(c)) / n for t in tests]
    words = re.findall(rb"[^\x20\x09-\x0d]+", data)
    m = max(len(words), 1)
    low = [w.lower() for w in words]
    letters = [sum(c in letter or c >= 128 for c in w) for w in words]
    symbols = [sum(symbol(c) for c in w) for w in words]
    upper = [sum(65 <= c <= 90 for c in w) for w in words]
    out.append(sum(map(len, words)) / m / 10)
    out.append(sum(a == b for a, b in zip(low, low[1:])) / m)
    out.append(sum(a == b for a, b in zip(low, low[2:])) / m)
    out.append(sum(a == 0 for a in letters) / m)
    out.append(sum(s >= 2 and a > 0 for s, a in zip(symbols, letters)) / m)
    out.append(sum(u >= 2 and u == a for u, a in zip(upper, letters)) / m)
    out.append(min(len(set(low)) / m ** 0.85, 2.0))
    out += [sum(len(w) >= 14 for w in words) / m, sum(len(w) <= 1 for w in words) / m]
    return out + [v ** 0.5 for v in out]


def test_features_and_scores_against_a_direct_computation(spark):
    rng = random.Random(11)
    marks = ["%%%", "!!", "ABC", "(x)", "3.5", "\n", "\t\t", "é", "--", "loooooooooooooong"]
    texts = [r[1] for r in odd_rows()]
    texts += [" ".join(rng.choice([*marks, "word", "word", "Two"]) for _ in range(rng.randint(0, 80)))
              for _ in range(200)]
    want = np.array([_plain_features(t) for t in texts])
    got = quality.features(Texts(pa.array(texts, pa.string())))
    assert np.allclose(got, want, atol=1e-12)
    rows, labels = _corpus(150)
    model = quality.train(documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int"), pairs=2000)
    scored = {r.doc_id: r.score for r in quality.score_documents(documents(spark, rows), model).collect()}
    for i, text, *_ in rows:
        raw = sum(w * (x - m) / s for w, x, m, s in zip(model.weights, _plain_features(text), model.mean, model.scale))
        z = min(max(raw - model.cut + np.log(0.7 / 0.3), -40), 40)
        assert abs(scored[i] - 1 / (1 + np.exp(-z))) < 1e-9


def test_training_is_the_pairwise_loss_over_all_usable_labels(spark):
    rows, labels = _corpus(150)
    text = {i: t for i, t, *_ in rows}
    held = {r.i for r in spark.range(150).selectExpr("id as i", "crc32(cast(cast(id as string) as binary)) % 4 = 2 as h")
            .where("h").collect()}
    odd = [(0, 0.6), (1, None), (2, 7.0)]  # not labels, whatever the rows below say of other ids
    lab = [(i, float(q)) for i, q in labels if i > 2]
    model = quality.train(documents(spark, rows + rows[:9]),
                          spark.createDataFrame(odd + lab, "doc_id bigint, quality double"), pairs=20_000)
    good, bad = ([quality.features(Texts(pa.array([text[i]])))[0] for i, q in lab if q == want and i not in held]
                 for want in (1, 0))
    both = np.concatenate([good, bad])
    assert np.allclose(model.mean, both.mean(axis=0), atol=1e-6)
    scale = both.std(axis=0)
    scale[scale < 1e-9] = 1.0
    diff = np.array([(g - b) / scale for g in good for b in bad])

    def loss(w):
        return np.logaddexp(0, -(diff @ w)).mean() + quality.RIDGE / 2 * w @ w

    # no worse than the best of all pairs but for the sampling of pairs
    w, best = np.array(model.weights), np.zeros(diff.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(diff @ best, -40, 40)))
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + quality.RIDGE * np.eye(len(best))
        step, rate = np.linalg.solve(hessian, quality.RIDGE * best - diff.T @ p / len(diff)), 1.0
        while loss(best - rate * step) > loss(best) and rate > 1e-6:
            rate /= 2
        best = best - rate * step
    assert loss(best) <= loss(w) + 1e-9 < loss(best) + 0.01


def test_every_label_and_every_pair_count(spark):
    # 40,500 good rows of six kinds of text, those of the sixth kind rare
    rng = np.random.default_rng(5)
    marks = rng.integers(0, 6, 41_500)
    marks[:40_500] = np.where(np.arange(40_500) % 300 == 0, 5, marks[:40_500] % 3)
    rows = [(i, "w " * 6 + "%% " * int(k), "en", "s", 1) for i, k in enumerate(marks)]
    docs = documents(spark, rows, clash=False)
    labels = spark.createDataFrame([(i, int(i < 40_500)) for i in range(len(rows))], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    used = [r.doc_id for r in docs.where(~quality.held_out(docs.doc_id)).select("doc_id").collect()]
    x = quality.features(Texts(pa.array(["w " * 6 + "%% " * k for k in range(6)]))).astype(np.float32).astype(float)
    n = [np.bincount([marks[i] for i in used if (i < 40_500) == good], minlength=6) for good in (False, True)]
    n_all = n[0] + n[1]
    mean = n_all @ x / n_all.sum()
    assert np.allclose(model.mean, mean, atol=1e-7)
    assert np.allclose(model.scale, np.maximum(np.sqrt(n_all @ (x - mean) ** 2 / n_all.sum()), 0) + (np.ptp(x, axis=0) < 1e-9),
                       atol=1e-7)
    # the gradient over all pairs, counted by the six kinds of text, is zero
    z, w = (x - model.mean) / model.scale, np.array(model.weights)
    gradient = quality.RIDGE * w
    for g in range(6):
        for b in range(6):
            gradient = gradient - n[1][g] * n[0][b] / (n[1].sum() * n[0].sum()) * (z[g] - z[b]) / (1 + np.exp((z[g] - z[b]) @ w))
    assert np.abs(gradient).max() < 1e-4
    raw = sorted((float(z[k] @ w), k) for k in range(6))
    share = n[0].sum() / n_all.sum()
    passed = np.cumsum([n_all[k] for _, k in raw]) / n_all.sum()
    assert abs(model.cut - raw[int(np.argmax(passed >= share))][0]) < 1e-6


def test_sums_over_nodes_are_the_sums_over_pairs():
    rng = np.random.default_rng(2)
    z, label = rng.normal(0, 4, (90, 3)), rng.integers(0, 2, 90)
    w = np.array([1.5, -0.7, 2.0])
    sums = {}
    for part in (slice(0, 40), slice(40, 90)):
        quality._add_sums(sums, label[part], z[part], w)
    at = quality._AllPairs(sums, w)
    diff = np.array([g - b for g in z[label == 1] for b in z[label == 0]])
    p = 1 / (1 + np.exp(diff @ w))
    assert abs(at.loss - np.logaddexp(0, -(diff @ w)).mean() - quality.RIDGE / 2 * w @ w) < 1e-9
    assert np.allclose(at.gradient, quality.RIDGE * w - diff.T @ p / len(diff), atol=1e-9)
    squares = np.zeros((3, 3))
    at.add_squares(squares, label, z)
    want = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + quality.RIDGE * np.eye(3)
    assert np.allclose(at.curve(squares), want, atol=1e-8)


def test_cut_is_the_weighted_quantile_of_all_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(quality, "SELECT_ROWS", 20)
    monkeypatch.setattr(quality, "BUCKETS", 4)
    for values, share in ((rng.normal(0, 1, 300), 0.3), (np.round(rng.normal(0, 1, 300)), 0.4), (np.zeros(50), 0.5),
                          (np.r_[rng.normal(0, 1, 99), 1e6], 0.99), (rng.normal(0, 1, 100), 0.001)):
        label = rng.integers(0, 2, len(values))
        weight = {1: (1 - share) / (label == 1).sum(), 0: share / (label == 0).sum()}
        rows = spark.createDataFrame([(int(q), float(v)) for q, v in zip(label, values)], "_q int, _raw double")
        order = np.lexsort((1 - label, values))
        k = int(np.searchsorted(np.cumsum([weight[q] for q in label[order]]), share - 1e-12))
        want = (values[order][k] + values[order][min(k + 1, len(values) - 1)]) / 2
        assert abs(quality._cut(rows, share, weight) - want) < 1e-8
