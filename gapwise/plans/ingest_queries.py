"""Registered ingest queries over bundle documents derived from the star tables.

``bundle_documents`` turns every order into a three-entry bundle (Patient,
Observation, Condition; some deliberately broken) and every line item into a
one-entry Procedure bundle, so the ingest chain runs over whole tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.operators import ingest as I
from gapwise.operators.current import CurrentRows
from gapwise.operators.paths import first_unknown
from gapwise.operators.replays import VersionLog
from gapwise.operators.requests import parse_run_requests
from gapwise.plans.measures import MeasureTables, evaluate_all
from gapwise.plans.run import current_run_log, run_backfill
from gapwise.operators.versions import latest
from gapwise.session import scratch_path
from gapwise.sources.bundles import (append_versions, read_bundles, read_resources, read_versions,
                                     write_bundle_files)
from gapwise.sources.fixtures import (BUNDLE_OBJECT_TIME, EXPECTED_BUCKET, RUN_DATE, bundle_documents, census_documents,
                                      nested_documents, object_event_texts, procedure_event_texts, roster_documents, run_request_texts,
                                      star_clinical_tables, stay_versions, store_attempts, visit_documents)
from gapwise.sources.splitbundles import split_entries
from gapwise.sources.store import TableStore
from gapwise.sources.tables import read_table
from gapwise.streaming.streams import run_requests_stream, stream_bundles


def _ingested(spark, sf_dir) -> I.Ingested:
    """For queries that read the entries once: nothing is written."""
    return I.ingest(bundle_documents(spark, sf_dir))


def _staged(spark, sf_dir) -> I.Ingested:
    """For queries that join the entries with themselves: written once, then read."""
    return I.stage(bundle_documents(spark, sf_dir))


def _visits(spark, sf_dir) -> I.Ingested:
    return I.stage(visit_documents(spark, sf_dir))


def object_admission(spark, sf_dir) -> DataFrame:
    ev = I.parse_object_events(object_event_texts(spark, sf_dir))
    return I.admit_events(ev, EXPECTED_BUCKET).select("name", "bucket", "event_type", "reason")


def bundle_validation(spark, sf_dir) -> DataFrame:
    return _ingested(spark, sf_dir).rejected.select("object_name", "reason", "detail")


def bundle_entries(spark, sf_dir) -> DataFrame:
    return _ingested(spark, sf_dir).entries.select(
        "object_name", "pos", "bundle_type", "resource_type", "full_url", "method", "url",
        "resource_id", "rewritten")


def rewrite_stats(spark, sf_dir) -> DataFrame:
    return I.rewrite_stats(_ingested(spark, sf_dir).entries)


def resolved_references(spark, sf_dir) -> DataFrame:
    return (_staged(spark, sf_dir).resolved.where(F.col("reference").isNotNull())
            .select("object_name", "pos", "reference", "resolved_reference", "unresolved"))


def ingested_patients(spark, sf_dir) -> DataFrame:
    t = MeasureTables(_staged(spark, sf_dir).versions())
    return t.latest("Patient").select("id", "gender", F.col("birthDate").alias("birth_date"),
                                      F.col("meta.versionId").alias("version_id"))


def ingested_observations(spark, sf_dir) -> DataFrame:
    t = MeasureTables(_staged(spark, sf_dir).versions())
    return t.latest("Observation").select(
        "id", F.col("subject.patientId").alias("patient_id"),
        F.element_at("code.coding", 1)["system"].alias("system"),
        F.element_at("code.coding", 1)["code"].alias("code"),
        F.col("effective.dateTime").alias("effective_text"))


def ingested_procedures(spark, sf_dir) -> DataFrame:
    t = MeasureTables(_staged(spark, sf_dir).versions())
    return t.latest("Procedure").select(
        "id", F.col("subject.patientId").alias("patient_id"),
        F.element_at("code.coding", 1)["code"].alias("code"),
        F.col("performed.dateTime").alias("performed_text"),
        F.col("meta.versionId").alias("version_id"))


def ingest_round_trip(spark, sf_dir) -> DataFrame:
    """All measures over the ingested tables (bundle → tables → measures)."""
    return evaluate_all(MeasureTables(_staged(spark, sf_dir).versions()), RUN_DATE)


def resource_counts(spark, sf_dir) -> DataFrame:
    """Counts after ingesting every bundle twice (a full replay)."""
    docs = bundle_documents(spark, sf_dir)
    replay = docs.unionByName(docs.withColumn("object_time", F.col("object_time")
                                              + F.expr("INTERVAL 1 DAY")))
    return I.resource_counts(I.stage(replay).versions_long())


def stored_versions(spark, sf_dir) -> DataFrame:
    """Every resource type of the visit bundles through the version store, delivered twice."""
    root = scratch_path(spark, "versions")
    visits = _visits(spark, sf_dir)
    for _ in range(2):  # the same batch again replaces itself
        append_versions(visits, root, "b-1")
    doc = F.col("resource")
    return read_versions(spark, root).select(
        "resource_type", "id", "object_name", "pos",
        F.try_variant_get(doc, "$.id", "string").alias("document_id"),
        F.try_variant_get(doc, "$.subject.reference", "string").alias("subject"),
        F.try_variant_get(doc, "$.encounter.reference", "string").alias("encounter"))


def stored_observations(spark, sf_dir) -> DataFrame:
    """Typed read of one type from the version store."""
    root = scratch_path(spark, "versions")
    append_versions(_visits(spark, sf_dir), root)
    return read_resources(spark, root, "Observation").select(
        "id", F.col("subject.patientId").alias("patient_id"), F.col("effective.dateTime").alias("effective_text"))


def document_references(spark, sf_dir) -> DataFrame:
    """Every urn reference anywhere in the visit bundles' resources, with its target."""
    return I.reference_rows(_visits(spark, sf_dir).entries).select(
        "object_name", "pos", F.col("urn").alias("reference"), "target", F.col("target").isNull().alias("unresolved"))


def quarantine(spark, sf_dir) -> DataFrame:
    return _visits(spark, sf_dir).rejected.select("object_name", "reason", "detail")


def visit_rewrites(spark, sf_dir) -> DataFrame:
    """Mixed bundles: rewritten, left as is, created, and entries without a resource."""
    return I.ingest(visit_documents(spark, sf_dir)).entries.groupBy("object_name").agg(
        F.count(F.lit(1)).alias("entries"), F.count_if("rewritten").alias("rewritten"),
        F.count_if(~F.col("rewritten")).alias("left_as_is"), F.count_if("created").alias("created"),
        F.count_if(F.col("resource").isNull()).alias("without_resource"))


def bundle_files(spark, sf_dir) -> DataFrame:
    """Census bundles landed as files and read back as whole documents."""
    root = scratch_path(spark, "landing")
    write_bundle_files(census_documents(spark, sf_dir), root)
    entries = I.ingest(read_bundles(spark, root)).entries
    return I.ingest_result(entries.withColumn(
        "object_name", F.regexp_extract("object_name", "object=([^/]+)/", 1)))


def split_bundle_entries(spark, sf_dir) -> DataFrame:
    """Entries of the census bundles as files, read by byte ranges and not as whole objects."""
    root = scratch_path(spark, "landing")
    write_bundle_files(census_documents(spark, sf_dir), root)
    entry = F.from_json("body", "fullUrl STRING, resource STRUCT<resourceType: STRING, gender: STRING>")
    return split_entries(spark, root).select(
        F.regexp_extract("object_name", "object=([^/]+)/", 1).alias("object_name"), "pos", entry.alias("e")).select(
        "object_name", "pos", F.col("e.fullUrl").alias("full_url"),
        F.col("e.resource.resourceType").alias("resource_type"), F.col("e.resource.gender").alias("gender"))


def request_runs(spark, sf_dir) -> DataFrame:
    """One run request per quarter of order dates, newest first and the newest twice, through the
    request stream: every delivery is a finished run with its counts, in arrival order (G8)."""
    root = scratch_path(spark, "requests")
    quarters = order_quarters(spark, sf_dir)
    last = quarters.agg(F.max("d").alias("d"))
    payload = F.to_json(F.struct(F.col("d").cast("string").alias("runDate")))
    data = F.base64(F.encode(payload, "UTF-8"))
    (quarters.withColumn("again", F.lit(0)).unionByName(last.withColumn("again", F.lit(1)))
     .orderBy("again", F.desc("d")).coalesce(1)
     .select(F.to_json(F.struct(F.struct(data.alias("data")).alias("message"))).alias("value"))
     .write.text(f"{root}/landing"))
    store, tables = TableStore(spark, f"{root}/store"), MeasureTables.of(star_clinical_tables(spark, sf_dir))

    def runner(run_dates, batch_id) -> None:
        run_backfill(spark, tables, [(f"b{batch_id}-{k + 1}", d, BUNDLE_OBJECT_TIME + dt.timedelta(minutes=k))
                                     for k, d in enumerate(run_dates)], store)

    run_requests_stream(spark, f"{root}/landing", f"{root}/state", today=RUN_DATE,
                        batch_runner=runner).awaitTermination()
    return current_run_log(store).select("id", "run_date", "started_at", "status", "gaps_open", "gaps_closed")


def order_quarters(spark, sf_dir) -> DataFrame:
    return (read_table(spark, sf_dir, "orders", "o_orderdate")
            .select(F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("d")).distinct())


def document_rewrite(spark, sf_dir) -> DataFrame:
    """The references of every roster's Group after its document has been rewritten."""
    staged = I.stage(roster_documents(spark, sf_dir))
    doc = F.col("resource")
    members = F.try_variant_get(doc, "$.member", "array<struct<entity:struct<reference:string>>>")
    refs = F.transform(members, lambda m: m["entity"]["reference"])
    return (I.resolve_documents(staged.entries).where("resource_type = 'Group'")
            .select("object_name", F.size(refs).alias("members"),
                    F.size(F.filter(refs, lambda r: r.startswith("Patient/"))).alias("resolved"),
                    F.try_variant_get(doc, "$.managingEntity.reference", "string").alias("managing"),
                    F.array_join(refs, ",").alias("refs")))


def unknown_paths(spark, sf_dir) -> DataFrame:
    """The first element of each nested bundle, at whatever depth, that its type does not allow."""
    return first_unknown(I.ingest(nested_documents(spark, sf_dir)).entries)


def latest_incremental(spark, sf_dir) -> DataFrame:
    """Current stays kept up to date through three batches of versions, some of them late (Q1)."""
    current = CurrentRows(TableStore(spark, scratch_path(spark, "current")), "stay")
    for batch in (1, 0, 2):
        current.apply(stay_versions(spark, sf_dir, batch))
    return current.read(stay_versions(spark, sf_dir).schema).select(
        "id", "status", F.col("meta.versionId").alias("version_id"))


def replay_filter(spark, sf_dir) -> DataFrame:
    """Visits delivered again a day later, every seventh with an amended Observation: what the
    second batch stores is the amended ones (I9)."""
    docs = visit_documents(spark, sf_dir)
    seventh = F.regexp_extract("object_name", "([0-9]+)", 1).cast("bigint") % 7 == 0
    again = docs.withColumns({
        "object_time": F.col("object_time") + F.expr("INTERVAL 1 DAY"),
        "body": F.when(seventh, F.replace("body", F.lit('"final"'), F.lit('"amended"'))).otherwise(F.col("body"))})
    log = VersionLog(spark, scratch_path(spark, "replays"))
    for name, delivered in (("first", docs), ("second", again)):
        log.append(I.stage(delivered).versions_long(), name)
    return log.read().select("resource_type", "id", "object_name", "pos", "batch",
                             F.try_variant_get("resource", "$.status", "string").alias("status"))


def streamed_patients(spark, sf_dir) -> DataFrame:
    """Census bundles as files, through the file stream into the store, then the latest versions."""
    root = scratch_path(spark, "stream")
    write_bundle_files(census_documents(spark, sf_dir), f"{root}/landing")
    stream_bundles(spark, f"{root}/landing", f"{root}/store", f"{root}/state",
                   max_files_per_trigger=2000).awaitTermination()
    return latest(read_resources(spark, f"{root}/store", "Patient")).select("id", "gender")


def ingest_results(spark, sf_dir) -> DataFrame:
    return I.ingest_result(_ingested(spark, sf_dir).entries)


def outcome_classification(spark, sf_dir) -> DataFrame:
    return I.classify_outcomes(store_attempts(spark, sf_dir)).select(
        "object_name", F.col("attempt.l_linenumber").alias("line_number"),
        F.col("attempt.l_partkey").alias("part_key"), "status_code", "connection_error",
        "outcome")


def dispositions(spark, sf_dir) -> DataFrame:
    return I.dispositions(store_attempts(spark, sf_dir))


def ingest_report(spark, sf_dir) -> DataFrame:
    """Events of all bundle objects → admission → validate the objects, those admitted → outcome.

    Every object is validated where it is read and the admitted ones are told apart by name
    afterwards, so no document moves.
    """
    texts = object_event_texts(spark, sf_dir).unionByName(procedure_event_texts(spark, sf_dir))
    admitted = I.admit_events(I.parse_object_events(texts), EXPECTED_BUCKET).withColumnRenamed("name", "object_name")
    accepted = admitted.where(F.col("reason").isNull()).select("object_name").distinct()
    # an inner join, as the names are distinct and a semi-join would be pushed down to the documents
    ing = I.Ingested(I.ingest(bundle_documents(spark, sf_dir)).rows.join(accepted, "object_name"))
    return I.ingest_report(I.object_statuses(admitted, ing, I.dispositions(store_attempts(spark, sf_dir))))


def run_requests(spark, sf_dir) -> DataFrame:
    return parse_run_requests(run_request_texts(spark, sf_dir), RUN_DATE).select(
        "request_id", "run_date", "outcome", "reason")


INGEST_QUERIES = {
    "object_admission": object_admission,
    "bundle_validation": bundle_validation,
    "bundle_entries": bundle_entries,
    "rewrite_stats": rewrite_stats,
    "resolved_references": resolved_references,
    "ingested_patients": ingested_patients,
    "ingested_observations": ingested_observations,
    "ingested_procedures": ingested_procedures,
    "ingest_round_trip": ingest_round_trip,
    "resource_counts": resource_counts,
    "stored_versions": stored_versions,
    "stored_observations": stored_observations,
    "document_references": document_references,
    "quarantine": quarantine,
    "visit_rewrites": visit_rewrites,
    "bundle_files": bundle_files,
    "split_bundle_entries": split_bundle_entries,
    "request_runs": request_runs,
    "streamed_patients": streamed_patients,
    "ingest_results": ingest_results,
    "outcome_classification": outcome_classification,
    "dispositions": dispositions,
    "ingest_report": ingest_report,
    "run_requests": run_requests,
    "document_rewrite": document_rewrite,
    "unknown_paths": unknown_paths,
    "latest_incremental": latest_incremental,
    "replay_filter": replay_filter,
}
