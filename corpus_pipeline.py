"""The corpus pipeline: documents through five operators, each stage written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``documents``. ``run`` writes each stage's rows
as Parquet under the shared folder of ``spark.checkpoint.dir`` before the next
stage reads them, so a lost executor costs at most the running stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.llm import bpe, decontam, linededup, quality, setsketch
from gapwise.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.keep_good(docs, quality.train(docs, labels))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents share; n_chars follows the text."""
    return (linededup.drop_lines(docs)
            .withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
            .select(*docs.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates."""
    return setsketch.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no considerable part of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontam.drop_contaminated(docs, benchmark)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document encoded by the public byte-level vocabulary and decoded again."""
    import public_tokenizers
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_stage),
    ("decontamination", decontamination_stage),
    ("byte-level BPE", encoding_stage),
]

#: SQL can express neither the ranking nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{k}")
        docs = spark.read.parquet(path)
    return docs
