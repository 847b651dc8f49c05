import random
import zlib
from collections import Counter

from cases import SCHEMA, documents, odd_rows, prose

from gapwise.llm import hilbert


def test_neighbours_on_the_curve_are_neighbours_in_the_cube():
    for bits, n in ((4, 3), (3, 2), (2, 4), (1, 1)):
        places, side = hilbert.curve(bits, n), 1 << bits
        assert sorted(places) == list(range(side**n))
        cell = {p: [c // side**(n - 1 - i) % side for i in range(n)] for c, p in enumerate(places)}
        assert all(sum(abs(x - y) for x, y in zip(cell[p], cell[p + 1])) == 1 for p in range(side**n - 1))


def _rows():
    rng = random.Random(4)
    rows = odd_rows() + [(50 + i, prose(rng, rng.randint(1, 90)), rng.choice(["en", "de", "fr"]),
                          f"src{rng.randint(0, 9)}", 1) for i in range(300)]
    return rows + [(900 + i, rows[20][1], rng.choice(["en", "de"]), f"src{i % 7}", 1) for i in range(40)]


def test_counts_slots_sizes_and_groups(spark):
    rows = _rows()
    out = hilbert.shard_documents(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    counts = Counter(r.shard for r in out)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(n))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
    assert {(r.law, r.grown_shard) for r in out} == {("rows", None)}
    order = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in out)
    copies = [k for k, r in enumerate(order) if r.text_crc32 == zlib.crc32(rows[20][1].encode())]
    assert copies == list(range(copies[0], copies[0] + len(copies)))


def test_shards_cover_less_of_each_dimension_than_by_chance(spark):
    rng = random.Random(7)
    rows = [(i, "x" * rng.randint(1, 5000), f"l{rng.randint(0, 9)}", f"s{rng.randint(0, 9)}", 1) for i in range(2000)]
    meta = {r[0]: r[2:4] for r in rows}
    held = {}
    for r in hilbert.shard_documents(documents(spark, rows)).collect():
        held.setdefault(r.shard, []).append((*meta[r.doc_id], r["size"] // 500))
    skipped = [1 - len({x[d] for x in held[s]}) / 10 for s in held for d in range(3)]
    assert sum(skipped) / len(skipped) > 0.25  # in a shuffled order every shard touches nearly every value


def test_sources_that_begin_alike_are_told_apart(spark):
    rng = random.Random(7)
    for n in (8, 48):
        name = [f"https://www.example.org/crawl-{i:03}" for i in range(n)]
        rows = [(i, "x" * rng.randint(1, 5000), "en", rng.choice(name), 1) for i in range(2000)]
        source, held = {r[0]: r[3] for r in rows}, {}
        for r in hilbert.shard_documents(documents(spark, rows)).collect():
            held.setdefault(r.shard, set()).add(source[r.doc_id])
        assert sum(1 - len(x) / n for x in held.values()) / len(held) > (0.25 if n == 8 else 0.5), n


def test_text_cuts_against_a_direct_computation(spark):
    rng = random.Random(8)
    values = [f"same-start-{min(int(rng.expovariate(0.05)), 99):02}" for _ in range(1500)] + [None] * 40
    rows = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    some = sorted(v for v in values if v is not None)
    want = {some[-(-i * len(some) // 16) - 1] for i in range(1, 16)}
    assert set(hilbert.text_cuts(rows, "v", 16)) == want
    assert sorted(hilbert.text_cuts(rows.where("v < 'same-start-09'"), "v", 16)) == sorted(
        {v for v in some if v < "same-start-09"})


def test_small_empty_and_written_tables(spark, tmp_dir):
    assert hilbert.shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    few = hilbert.shard_documents(documents(spark, [(1, "a", "en", "s", 1), (2, None, None, None, None)])).collect()
    assert len({r.shard for r in few}) == 2 and {r.slot for r in few} == {0}
    rows = [r for r in _rows() if r[0] is not None and r[0] != 8]
    docs = documents(spark, rows)
    hilbert.write_shards(docs, tmp_dir + "/out", 6)
    back = spark.read.parquet(tmp_dir + "/out")
    assert Counter(r.doc_id for r in back.select("doc_id").collect()) == Counter(r[0] for r in rows)
    assert back.select("shard").distinct().count() == 6
