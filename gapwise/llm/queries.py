"""The registered queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.llm import (bpe, cws, decontam, fim, hilbert, linededup, packing, periodic, quality, setsketch,
                         sitetree, warczst, wordpiece)
from gapwise.session import scratch_path


def _read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train(docs, _read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score_documents(docs, model)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return linededup.drop_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(_read(spark, sf_dir, "documents", "doc_id", "text"),
                                        _read(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.fingerprint_neighbours(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_read(spark, sf_dir, "documents", "doc_id", "text"), words=2)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages", "page_id", "url", "html")
    archives = warczst.write_archives(warczst.plan_records(pages), warczst.sample_dictionary(pages))
    archives.write.parquet(path := scratch_path(spark, "warc"))
    read = warczst.read_records(spark.read.parquet(path), payloads=False)
    kind = pages.schema["page_id"].dataType
    return read.select(
        warczst.page_id_of("record_id").cast(kind).alias("page_id"), "payload_bytes",
        "payload_digest", "record_type", warczst.page_id_of("refers_to").cast(kind).alias("refers_to"))


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.round_trip(_read(spark, sf_dir, "documents", "doc_id", "text"),
                          bpe.load_ranks(_vocabulary("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.count_tokens(_read(spark, sf_dir, "documents", "doc_id", "text"),
                                  wordpiece.load_entries(_vocabulary("word_bpe_49k.json")))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.extract(_read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_documents(
        _read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest_runs(_read(spark, sf_dir, "documents", "doc_id", "text"), loop_tails=True)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.round_trip(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents", "doc_id", "text"),
                                  _vocabulary("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_fingerprints": op4_fingerprints,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_warc": op6_warc,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_token_counts": op8_token_counts,
    "op9_main_text": op9_main_text,
    "op10_shards": op10_shards,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_packing": op13_packing,
}
ORACLES: dict[str, str] = {
    "op2_line_dedup": linededup.SQL,
    "op3_decontamination": decontam.SQL,
    "op5_near_duplicates": setsketch.SQL,
    "op6_warc": warczst.SQL,
    "op12_fill_in_middle": fim.SQL,
}
