"""The pipeline at sf0.001 against a brute-force version of every stage."""

import hashlib

import corpus_pipeline
import public_tokenizers
import tiktoken
from test_decontam import _brute as contaminated
from test_linededup import _brute as without_lines
from test_setsketch import _brute as near

from gapwise.llm import bpe, quality

SF = "/root/testdata/sf0.001"


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_every_stage(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = {r.doc_id: r.predicted for r in quality.score_documents(docs, quality.train(docs, labels)).collect()}
    now, made = _rows(docs), docs
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, made, SF).write.parquet(f"{tmp_dir}/{k}")
        made = spark.read.parquet(f"{tmp_dir}/{k}")
        if k == 0:
            now = [r for r in now if scored[r[0]]]
        elif k == 1:
            text = {i: (t, n - d) for i, t, n, d in without_lines(now, 10)}
            now = [(r[0], text[r[0]][0], *r[2:4], len(text[r[0]][0])) for r in now]
        elif k == 2:
            groups = near(now, 5)
            now = [r for r in now if groups[r[0]][2]]
        elif k == 3:
            bad = {x[0] for x in contaminated(now, items) if x[4]}
            now = [r for r in now if str(r[0]) not in bad]
        if k < 4:
            assert made.schema == docs.schema, name
            assert sorted(_rows(made)) == sorted(now), name
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r[0], len(ids := known.encode_ordinary(r[1])),
                   hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(r[1].encode()).hexdigest()) for r in now)
    assert sorted(tuple(r) for r in made.collect()) == want
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == want


def test_empty_documents(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
