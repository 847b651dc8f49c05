"""Structured Streaming entry points.

Both streams use ``foreachBatch`` with a checkpoint location, so a restarted
query resumes where it stopped and each file / request is processed once per
successful batch. ``trigger(availableNow=True)`` processes what has landed and
stops, the batch equivalent of the reference's push delivery.

Replay safety: a batch may be re-run after a failure. Bundle versions are
written to ``<root>/versions/batch=s-<n>`` with overwrite, so a re-run replaces
its own output instead of appending it twice; measure runs are idempotent on
the gap state (same evaluations → same upsert).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.operators.ingest import QUARANTINE, stage
from gapwise.operators.requests import parse_run_requests
from gapwise.sources.bundles import append_versions, with_object_columns


def _bundle_stream(spark: SparkSession, source: str, max_files: int | None) -> DataFrame:
    reader = (spark.readStream.format("text").option("wholetext", True)
              .option("pathGlobFilter", "*.json").option("recursiveFileLookup", True))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_object_columns(reader.load(source))


def write_ingest_batch(raw: DataFrame, batch_id: int, root: str) -> None:
    """Ingest one micro-batch into ``root``.

    Entries and quarantine are written once (``entries/batch=s-<n>``); the
    versions of all resource types come from that table. Both folders belong
    to the batch and are replaced if it runs again.
    """
    name = f"s-{batch_id}"
    append_versions(stage(raw, f"{root}/entries/batch={name}"), root, name)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Rejected bundles of all streamed batches."""
    ddl = "object_name STRING, object_time TIMESTAMP, reason STRING, detail STRING, batch STRING, part STRING"
    return (spark.read.schema(ddl).parquet(f"{root}/entries").where(F.col("part") == QUARANTINE)
            .drop("part"))


def stream_bundles(spark: SparkSession, source: str, root: str, checkpoint: str,
                   available_now: bool = True, max_files_per_trigger: int | None = None):
    """Ingest every bundle object landing under ``source`` into ``root``."""
    q = (_bundle_stream(spark, source, max_files_per_trigger).writeStream
         .foreachBatch(lambda df, bid: write_ingest_batch(df, bid, root))
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()


def run_requests_stream(spark: SparkSession, source: str, checkpoint: str,
                        runner: Callable | None = None, today=None, available_now: bool = True,
                        batch_runner: Callable | None = None):
    """Each delivered request triggers one whole-population run, in arrival order.

    Deliveries are run by file modification time, then file name, then line.
    A repeated delivery runs again and adds its own run row; an older run date
    that arrives last wins, as in any later run. ``runner(run_date)`` is called
    on the driver, which holds one date per delivery of the micro-batch;
    ``batch_runner(run_dates, batch_id)`` gets all of them at once, for a runner
    that evaluates many dates in one pass.
    """
    import datetime as dt

    def handle(df: DataFrame, batch_id: int) -> None:
        day = today or dt.datetime.now(dt.timezone.utc).date()
        wanted = parse_run_requests(df, day).where(F.col("outcome") == "run")
        dates = [r["run_date"] for r in wanted.orderBy("arrived", "file", "line").select("run_date").toLocalIterator()]
        if batch_runner and dates:
            batch_runner(dates, batch_id)
        for d in dates if runner else []:
            runner(d)

    src = (spark.readStream.format("text").option("wholetext", True).load(source)
           .select(F.col("_metadata.file_modification_time").alias("arrived"),
                   F.col("_metadata.file_path").alias("file"),
                   F.posexplode(F.split("value", "\n")).alias("line", "value"))
           .where(F.trim("value") != ""))
    q = src.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()
