"""Write-back issue documents (G9–G11) and their sink.

One ``DetectedIssue`` document per evaluation, with a deterministic id, so a
replayed run overwrites instead of duplicating. Documents are built with
``named_struct`` / ``to_json`` on the executors; transaction chunks of 200
entries are formed by a distributed position-in-measure (no per-measure
single-task window) and grouped into bundles of bounded size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.functions.expr import as_date_lit, is_valid_fhir_id, issue_id
from gapwise.operators.ids import index_within_group
from gapwise.operators.serving import with_display_name
from gapwise.operators.versions import latest

# --- fixed values ------------------------------------------------------------
ISSUE_STATUS = "final"
DETAIL_CLOSED = "Care gap closed: qualifying service on record."
DETAIL_OPEN = "Open care gap: no qualifying service found in the measurement window."
MITIGATION_ACTION = "Qualifying service performed"
BUNDLE_SIZE = 200
# Code system naming the measures; deployment-specific, so a parameter.
DEFAULT_MEASURE_CODE_SYSTEM = "urn:gapwise:care-gap-measure"


def issue_rows(evals: DataFrame, measures: DataFrame, run_date,
               code_system: str = DEFAULT_MEASURE_CODE_SYSTEM, strict: bool = True) -> DataFrame:
    """Flat issue fields, one row per evaluation.

    ``strict`` fails the job on an id that is not a valid FHIR id (never
    truncated, since truncation collides); otherwise such rows are kept and
    can be split off with :func:`invalid_issue_ids`.
    """
    rd = as_date_lit(run_date)
    e = with_display_name(evals, measures, "measure_id", "_name")
    iid = issue_id(F.col("measure_id"), F.col("patient_id"))
    if strict:
        iid = F.when(is_valid_fhir_id(iid), iid).otherwise(
            F.raise_error(F.concat(F.lit("Cannot form a valid FHIR id from: "), iid)))
    closed = F.col("in_numerator")
    return e.select(
        "measure_id", "patient_id", iid.alias("id"),
        F.lit(ISSUE_STATUS).alias("status"),
        F.lit(code_system).alias("code_system"),
        F.col("measure_id").alias("code"),
        F.col("_name").alias("code_display"),
        F.date_format(rd, "yyyy-MM-dd").alias("identified"),
        F.concat(F.lit("Patient/"), F.col("patient_id")).alias("patient_reference"),
        F.when(closed, F.lit(DETAIL_CLOSED)).otherwise(F.lit(DETAIL_OPEN)).alias("detail"),
        F.when(closed, F.lit(MITIGATION_ACTION)).alias("mitigation_action"),
        F.when(closed, F.date_format(F.col("last_evidence_date"), "yyyy-MM-dd'T'00:00:00'Z'"))
         .alias("mitigation_date"),
    )


def invalid_issue_ids(evals: DataFrame) -> DataFrame:
    """Evaluations whose issue id would be invalid (quarantine side of G10)."""
    iid = issue_id(F.col("measure_id"), F.col("patient_id"))
    return evals.select("measure_id", "patient_id", iid.alias("id")).where(~is_valid_fhir_id(iid))


def issue_document(rows: DataFrame) -> DataFrame:
    """Add ``document``: the nested resource (mitigation only when closed,
    its date only when known)."""
    mitigation = F.when(
        F.col("mitigation_action").isNotNull(),
        F.array(F.struct(F.struct(F.col("mitigation_action").alias("text")).alias("action"),
                         F.col("mitigation_date").alias("date"))))
    doc = F.struct(
        F.lit("DetectedIssue").alias("resourceType"),
        F.col("id"), F.col("status"),
        F.struct(F.array(F.struct(F.col("code_system").alias("system"), F.col("code"),
                                  F.col("code_display").alias("display"))).alias("coding"),
                 F.col("code_display").alias("text")).alias("code"),
        F.struct(F.col("patient_reference").alias("reference")).alias("patient"),
        F.col("identified").alias("identifiedDateTime"),
        F.col("detail"),
        mitigation.alias("mitigation"),
    )
    return rows.withColumn("document", doc)


def chunk_issues(docs: DataFrame, size: int = BUNDLE_SIZE) -> DataFrame:
    """Transaction bundles of at most ``size`` PUT entries per measure.

    Positions inside a measure come from a distributed sort; each bundle
    group holds at most ``size`` rows.
    """
    if size < 1:
        raise ValueError("bundle size must be positive")
    idx = index_within_group(docs, "measure_id", ["patient_id"], name="_pos")
    entries = idx.select(
        "measure_id", F.floor(F.col("_pos") / size).cast("long").alias("chunk"),
        F.struct(
            F.col("_pos").alias("position"),
            F.col("document").alias("resource"),
            F.struct(F.lit("PUT").alias("method"),
                     F.concat(F.lit("DetectedIssue/"), F.col("id")).alias("url")).alias("request"),
        ).alias("entry"))
    grouped = entries.groupBy("measure_id", "chunk").agg(F.collect_list("entry").alias("_e"))
    ordered = F.transform(F.array_sort(F.col("_e")),
                          lambda x: F.struct(x["resource"].alias("resource"),
                                             x["request"].alias("request")))
    return grouped.select(
        "measure_id", "chunk", F.size("_e").alias("entries"),
        F.to_json(F.struct(F.lit("Bundle").alias("resourceType"),
                           F.lit("transaction").alias("type"),
                           ordered.alias("entry"))).alias("bundle"))


def write_issues(docs: DataFrame, path: str, seq: int) -> None:
    """Put every document of one write into the sink.

    Documents are added under the write's sequence number, partitioned by
    measure, and never removed; :func:`read_issues` gives the last one put
    under each id. A write that is repeated under its number replaces itself.
    """
    (docs.select("measure_id", "id", F.to_json("document").alias("json"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("measure_id").json(f"{path}/seq={seq}"))


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """``(id, json, seq, measure_id)``: the current document of every id."""
    rows = spark.read.schema("id STRING, json STRING, seq BIGINT, measure_id STRING").json(path)
    return latest(rows, "id", [F.col("seq").desc()])


def flat_chunks(chunks: DataFrame) -> DataFrame:
    """What a transaction chunk holds: entry count, and the ids of its PUTs in order."""
    put = F.from_json("bundle", "type STRING, entry ARRAY<STRUCT<resource: STRUCT<id: STRING>, "
                                "request: STRUCT<method: STRING, url: STRING>>>")
    c = chunks.select("measure_id", "chunk", "entries", F.explode(F.array(put)).alias("b"))
    ids = F.transform("b.entry", lambda e: e["resource"]["id"])
    urls = F.transform("b.entry", lambda e: F.concat_ws(" ", e["request"]["method"], e["request"]["url"]))
    return c.select("measure_id", "chunk", "entries", F.col("b.type").alias("bundle_type"),
                    F.element_at(ids, 1).alias("first_id"), F.element_at(ids, -1).alias("last_id"),
                    F.array_join(ids, ",").alias("ids"), F.element_at(urls, 1).alias("first_request"))
