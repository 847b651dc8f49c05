import random
import re

from cases import SCHEMA, documents, odd_rows, prose

from gapwise.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def _brute(rows, items):
    wins = {}
    for i, t in items:
        w = _words(t)
        if i is not None and w:
            k = min(13, len(w))
            for j in range(len(w) - k + 1):
                wins.setdefault(tuple(w[j:j + k]), set()).add(str(i))
    sizes = {len(k) for k in wins}
    out = []
    for i, t, *_ in rows:
        w, hit, ids = _words(t), set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in wins:
                    hit |= set(range(j, j + k))
                    ids |= wins[tuple(w[j:j + k])]
        out.append((str(i), len(w), len(hit), tuple(sorted(ids)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def _case():
    rng = random.Random(9)
    items = [(i, prose(rng, rng.choice([1, 5, 13, 14, 30]))) for i in range(25)]
    items += [(None, "no id here at all"), (77, None), (78, " ... "), (3, items[3][1])]
    rows = odd_rows()
    for i in range(150):
        parts = [prose(rng, rng.randint(0, 80))]
        if rng.random() < 0.5:
            w = rng.choice([t for _, t in items[4:25]]).split()
            a = rng.randint(0, max(0, len(w) - 13))
            parts.insert(rng.randint(0, 1), " - ".join(w[a:a + rng.randint(12, 30)]).upper())
        rows.append((100 + i, " ".join(parts), "en", "s", 1))
    return rows, items


def _run(found):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found.collect())


def test_against_brute_force_with_spans(spark):
    rows, items = _case()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontam.find_contamination(documents(spark, rows), bench)
    assert _run(found) == _brute(rows, items)
    text = {r[0]: r[1] for r in rows}
    for r in found.where("n_hit > 0 and doc_id is not null").collect():
        inside = [w for s in r.spans for w in _words(text[r.doc_id][s.start:s.end])]
        assert len(inside) == r.n_hit


def test_several_blocks_give_the_same(spark, monkeypatch):
    rows, items = _case()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontam, "blocks", lambda b, f=decontam.blocks: f(b, limit=500))
    assert len(list(decontam.blocks(bench))) > 2
    assert _run(decontam.find_contamination(documents(spark, rows), bench)) == _brute(rows, items)


def test_many_blocks_drop_the_same_rows_whatever_the_filter(spark, monkeypatch):
    rows, items = _case()
    rows += [(1000 + i, items[20][1], "en", "s", 1) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(x[0] for x in _brute(rows, items) if not x[4])
    docs = documents(spark, rows)
    monkeypatch.setattr(decontam, "blocks", lambda b, f=decontam.blocks: f(b, limit=500))
    # few bits let every text pass, and small steps cut between the words of windows
    for bits, step, keys in ((decontam.FILTER_BITS, 1 << 16, 200_000), (64, 3, 0)):
        monkeypatch.setattr(decontam, "FILTER_BITS", bits)
        monkeypatch.setattr(decontam, "FILTER_STEP", step)
        monkeypatch.setattr(decontam, "MAX_BROADCAST_KEYS", keys)
        kept = decontam.drop_contaminated(docs, bench)
        assert [f.name for f in kept.schema] == docs.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == want
    spans = {r.doc_id: r.spans for r in decontam.find_contamination(docs, bench).collect()}
    monkeypatch.undo()
    assert spans == {r.doc_id: r.spans for r in decontam.find_contamination(docs, bench).collect()}


def test_the_filter_has_no_false_negatives(monkeypatch):
    rows, items = _case()
    monkeypatch.setattr(decontam, "FILTER_BITS", 1 << 20)
    monkeypatch.setattr(decontam, "FILTER_STEP", 5)
    held = decontam.WindowFilter()
    held.add([w for _, t in items for w in decontam.windows(decontam.normalise((t or "").encode()))])
    passed = {str(r[0]) for r in rows if held.may_hit(decontam.normalise((r[1] or "").encode()))}
    hit = {x[0] for x in _brute(rows, items) if x[2]}
    assert hit <= passed and len(passed) <= len(hit) + 3


def test_offsets_count_code_points():
    text = "é — ein Wört, ŽLUŤ x\u00a0y".encode()
    plain = text.translate(decontam._TO_WORDS)
    starts, ends = decontam.word_offsets(text, plain)
    want = [m.span() for m in WORD.finditer(text.decode().translate({c: c + 32 for c in range(65, 91)}))]
    assert list(zip(starts.tolist(), ends.tolist())) == want


def test_drop_keeps_clean_rows_and_columns(spark):
    rows, items = _case()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(spark, rows)
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.schema == docs.schema
    want = sorted(x[0] for x in _brute(rows, items) if not x[4])
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_items_without_an_id_hit_as_in_the_sql(spark, tmp_dir):
    import duckdb

    from gapwise.llm import queries
    items = [(None, "one two three"), (None, "four five"), (7, "four five"), (8, "six")]
    docs = [(1, "one two three"), (2, "four five"), (3, "seven " * 30 + "six"), (4, "none")]
    spark.createDataFrame(items, "item_id bigint, text string").coalesce(1).write.parquet(tmp_dir + "/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1).write.parquet(tmp_dir + "/documents.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_dir}/{t}.parquet/*.parquet'")
    want = con.execute(decontam.SQL)
    columns = [c[0] for c in want.description]
    got = queries.op3_decontamination(spark, tmp_dir).select(*columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())
    docs, bench = (spark.read.parquet(f"{tmp_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {r.doc_id: r for r in decontam.find_contamination(docs, bench).collect()}
    assert [found[i]["items"] for i in range(1, 5)] == [[], ["7"], ["8"], []]
    assert [found[i].contaminated for i in range(1, 5)] == [True, True, False, False]
    assert {r.doc_id for r in decontam.drop_contaminated(docs, bench).collect()} == {3, 4}


def test_ids_of_a_shared_window_count_for_a_block(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PART_IDS", 50)
    bench = spark.createDataFrame([(f"item{i:06}", "the same words") for i in range(300)], "item_id string, text string")
    monkeypatch.setattr(decontam, "blocks", lambda b, f=decontam.blocks: f(b, limit=1000))
    made = list(decontam.blocks(bench))
    assert all(sum(len(w) + sum(map(len, ids)) for w, ids in block) <= 1000 for block in made)
    assert len(made) > 2 and sorted(i for block in made for _, ids in block for i in ids) == [
        f"item{i:06}" for i in range(300)]
    docs = spark.createDataFrame([(1, "the same words"), (2, "other")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in decontam.find_contamination(docs, bench).collect()}
    assert len(found[1]["items"]) == found[1].n_items == 300 and found[2].n_items == 0


def test_empty_sides(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    found = decontam.find_contamination(documents(spark), none).collect()
    assert len(found) == len(odd_rows()) and not any(r.contaminated or r.n_hit for r in found)
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert decontam.find_contamination(spark.createDataFrame([], SCHEMA), bench).count() == 0
