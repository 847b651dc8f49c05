"""Clinical resource version tables derived from the driver's star tables.

The mapping is the one in FIXTURES.md §B; every column is integer or date
arithmetic on ``customer``, ``orders`` and ``lineitem``, so the tables grow with
the input and an independent DuckDB query can rebuild them.

Only narrow transformations are used, except ``Procedure``, which joins
``lineitem`` to ``orders`` on the order key (a sort-merge join at scale; AQE
splits a skewed order key).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.sources.tables import read_table

# --- fixed values -----------------------------------------------------------
RUN_DATE = dt.date(2001, 8, 1)
SNOMED = "http://snomed.info/sct"
LOINC = "http://loinc.org"
OTHER_SYSTEM = "http://other"
PATIENT_VERSION_BASE = "2000-01-01"
# Procedure code by l_partkey % 40; Observation code by o_orderkey % 10;
# Condition code by o_orderkey % 12; every other remainder gives code "x".
PROCEDURE_CODES = {0: "71651007", 1: "73761001", 2: "444783004"}
OBSERVATION_CODES = {0: "4548-4", 3: "4548-4", 1: "2335-8", 2: "57905-2"}
CONDITION_CODES = {0: "44054006", 1: "46635009", 2: "73211009"}


def _code_by(rem: Column, mapping: dict[int, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(rem == k, F.lit(v)) if out is None else out.when(rem == k, F.lit(v))
    return out.otherwise(F.lit("x"))


def _coding(system: Column, code: Column) -> Column:
    return F.struct(F.array(F.struct(system.alias("system"), code.alias("code"))).alias("coding"))


def _meta(last_updated: Column, version_id: Column) -> Column:
    return F.struct(last_updated.cast("timestamp").alias("lastUpdated"),
                    version_id.alias("versionId"))


def _date_text(c: Column) -> Column:
    """``yyyy-MM-dd`` (a DATE cast to text; cheaper than a pattern formatter)."""
    return F.to_date(c).cast("string")


def _padded(*cols: Column) -> Column:
    """Non-negative integers as 19-digit zero-padded text joined by ``.``, so
    text order equals numeric order (the version tie-break)."""
    return F.concat_ws(".", *[F.lpad(c.cast("string"), 19, "0") for c in cols])


def _patient_ref(custkey: Column) -> Column:
    return F.struct(F.concat(F.lit("p-"), custkey.cast("string")).alias("patientId"))


@dataclass
class ClinicalTables:
    """Resource version tables (one row per version), keyed by ``id``."""

    patient: DataFrame
    condition: DataFrame
    observation: DataFrame
    procedure: DataFrame

    def by_type(self) -> dict[str, DataFrame]:
        return {"Patient": self.patient, "Condition": self.condition,
                "Observation": self.observation, "Procedure": self.procedure}


def patient_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    v = F.col("v")
    c = read_table(spark, sf_dir, "customer", "c_custkey")
    # Two versions for every fifth customer: a narrow explode, no shuffle.
    c = c.withColumn("v", F.explode(F.when(k % 5 == 0, F.array(F.lit(0), F.lit(1)))
                                    .otherwise(F.array(F.lit(0)))))
    birth = F.when(k % 97 == 0, F.lit("1950")).otherwise(
        _date_text(F.date_add(F.lit(dt.date(1921, 1, 1)), ((k * 37 + v * 400) % 25000).cast("int"))))
    return c.select(
        F.concat(F.lit("p-"), k.cast("string")).alias("id"),
        _meta(F.date_add(F.lit(dt.date.fromisoformat(PATIENT_VERSION_BASE)), v),
              _padded(v)).alias("meta"),
        F.when((k + v) % 2 == 0, F.lit("female")).otherwise(F.lit("male")).alias("gender"),
        birth.alias("birthDate"),
    )


def procedure_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.concat(F.lit("pr-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("id"),
        # Versions of one id are ordered by ship date, then part key, then supplier key.
        _meta(F.col("l_shipdate"),
              _padded(F.col("l_partkey"), F.col("l_suppkey"))).alias("meta"),
        _patient_ref(F.col("o_custkey")).alias("subject"),
        _coding(F.lit(SNOMED), _code_by(F.col("l_partkey") % 40, PROCEDURE_CODES)).alias("code"),
        F.struct(_date_text(F.col("l_shipdate")).alias("dateTime")).alias("performed"),
    )


def observation_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return o.select(
        F.concat(F.lit("ob-"), k.cast("string")).alias("id"),
        _meta(F.col("o_orderdate"), _padded(F.lit(1))).alias("meta"),
        _patient_ref(F.col("o_custkey")).alias("subject"),
        _coding(F.when(k % 10 == 3, F.lit(OTHER_SYSTEM)).otherwise(F.lit(LOINC)),
                _code_by(k % 10, OBSERVATION_CODES)).alias("code"),
        F.struct(F.when(k % 11 == 0, F.lit(None).cast("string"))
                 .otherwise(_date_text(F.col("o_orderdate"))).alias("dateTime")).alias("effective"),
    )


def condition_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return o.select(
        F.concat(F.lit("co-"), k.cast("string")).alias("id"),
        _meta(F.col("o_orderdate"), _padded(F.lit(1))).alias("meta"),
        _patient_ref(F.col("o_custkey")).alias("subject"),
        _coding(F.lit(SNOMED), _code_by(k % 12, CONDITION_CODES)).alias("code"),
    )


def star_clinical_tables(spark: SparkSession, sf_dir: str) -> ClinicalTables:
    return ClinicalTables(
        patient=patient_versions(spark, sf_dir),
        condition=condition_versions(spark, sf_dir),
        observation=observation_versions(spark, sf_dir),
        procedure=procedure_versions(spark, sf_dir),
    )


# --- ingest inputs derived from the star tables -----------------------------------------
# Order bundles carry the order's Patient (POST, urn fullUrl), an Observation and
# a Condition (POST, subject by urn). Every 50th key class is broken on purpose:
# remainder 7 truncated JSON, 8 a searchset, 9 no entries, 10 a bare Patient,
# 11 an unknown Patient element. Every fourth bundle (remainder 1) is a batch.
# Line items become one-entry batch bundles with a Procedure PUT by explicit id.
BROKEN_MALFORMED, BROKEN_SEARCHSET, BROKEN_EMPTY, BROKEN_BARE, BROKEN_UNKNOWN = 7, 8, 9, 10, 11
BUNDLE_OBJECT_TIME = dt.datetime(2001, 9, 1)


def _ts_text(c: Column) -> Column:
    return F.concat(_date_text(c), F.lit("T00:00:00Z"))


def _entry(full_url: Column, resource: Column, method: str, url: Column) -> Column:
    return F.to_json(F.struct(full_url.alias("fullUrl"), resource.alias("resource"),
                              F.struct(F.lit(method).alias("method"), url.alias("url")).alias("request")))


def _landed(orders: DataFrame) -> DataFrame:
    """Orders dealt out by key: objects land in many files, the test table is a single one.

    A number is given, as keys alone are so small that they would be put back into one task.
    """
    n = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return orders.repartition(n, "o_orderkey")


def procedure_object_name() -> Column:
    """Object name of a line item's bundle, without its suffix."""
    return F.concat(F.lit("bundles/procedure-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                    F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"),
                    F.lit("-"), F.col("l_suppkey").cast("string"), F.lit("-"),
                    F.regexp_replace(_date_text(F.col("l_shipdate")), "-", ""))


def bundle_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(object_name, object_time, body)`` bundle documents, one per order and one
    per line item; a narrow map over ``orders`` plus the Procedure join."""
    o = _landed(read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate"))
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    v = F.when(ck % 5 == 0, F.lit(1)).otherwise(F.lit(0))
    birth = F.when(ck % 97 == 0, F.lit("1950")).otherwise(
        _date_text(F.date_add(F.lit(dt.date(1921, 1, 1)), ((ck * 37 + v * 400) % 25000).cast("int"))))
    pref = F.concat(F.lit("urn:uuid:p-"), ck.cast("string"))
    patient = F.struct(
        F.lit("Patient").alias("resourceType"),
        F.struct(_ts_text(F.date_add(F.lit(dt.date.fromisoformat(PATIENT_VERSION_BASE)), v))
                 .alias("lastUpdated"), _padded(v).alias("versionId")).alias("meta"),
        F.when((ck + v) % 2 == 0, F.lit("female")).otherwise(F.lit("male")).alias("gender"),
        birth.alias("birthDate"),
        F.when(k % 50 == BROKEN_UNKNOWN, F.lit("blue")).alias("favouriteColour"))
    meta1 = F.struct(_ts_text(F.col("o_orderdate")).alias("lastUpdated"),
                     _padded(F.lit(1)).alias("versionId"))
    observation = F.struct(
        F.lit("Observation").alias("resourceType"), meta1.alias("meta"),
        F.lit("final").alias("status"),
        _coding(F.when(k % 10 == 3, F.lit(OTHER_SYSTEM)).otherwise(F.lit(LOINC)),
                _code_by(k % 10, OBSERVATION_CODES)).alias("code"),
        F.struct(pref.alias("reference")).alias("subject"),
        F.when(k % 11 != 0, _date_text(F.col("o_orderdate"))).alias("effectiveDateTime"))
    condition = F.struct(
        F.lit("Condition").alias("resourceType"), meta1.alias("meta"),
        _coding(F.lit(SNOMED), _code_by(k % 12, CONDITION_CODES)).alias("code"),
        F.struct(pref.alias("reference")).alias("subject"))
    entries = F.concat_ws(",",
                          _entry(pref, patient, "POST", F.lit("Patient")),
                          _entry(F.concat(F.lit("urn:uuid:ob-"), k.cast("string")), observation,
                                 "POST", F.lit("Observation")),
                          _entry(F.concat(F.lit("urn:uuid:co-"), k.cast("string")), condition,
                                 "POST", F.lit("Condition")))
    btype = (F.when(k % 50 == BROKEN_SEARCHSET, F.lit("searchset"))
             .when(k % 4 == 1, F.lit("batch")).otherwise(F.lit("transaction")))
    body = F.concat(F.lit('{"resourceType":"Bundle","type":"'), btype, F.lit('","entry":['),
                    F.when(k % 50 == BROKEN_EMPTY, F.lit("")).otherwise(entries), F.lit("]}"))
    body = (F.when(k % 50 == BROKEN_MALFORMED, F.substring(body, 1, 40))
            .when(k % 50 == BROKEN_BARE, F.to_json(patient)).otherwise(body))
    orders_docs = o.select(
        F.concat(F.lit("bundles/order-"), k.cast("string"), F.lit(".json")).alias("object_name"),
        F.lit(BUNDLE_OBJECT_TIME).cast("timestamp").alias("object_time"), body.alias("body"))

    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    j = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey, "inner")
    pid = F.concat(F.lit("pr-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                   F.col("l_linenumber").cast("string"))
    procedure = F.struct(
        F.lit("Procedure").alias("resourceType"), pid.alias("id"),
        F.struct(_ts_text(F.col("l_shipdate")).alias("lastUpdated"),
                 _padded(F.col("l_partkey"), F.col("l_suppkey"))
                 .alias("versionId")).alias("meta"),
        F.lit("completed").alias("status"),
        _coding(F.lit(SNOMED), _code_by(F.col("l_partkey") % 40, PROCEDURE_CODES)).alias("code"),
        F.struct(F.concat(F.lit("Patient/p-"), F.col("o_custkey").cast("string"))
                 .alias("reference")).alias("subject"),
        _date_text(F.col("l_shipdate")).alias("performedDateTime"))
    purl = F.concat(F.lit("Procedure/"), pid)
    pbody = F.concat(F.lit('{"resourceType":"Bundle","type":"batch","entry":['),
                     _entry(purl, procedure, "PUT", purl), F.lit("]}"))
    li_docs = j.select(
        F.concat(procedure_object_name(), F.lit(".json")).alias("object_name"),
        F.lit(BUNDLE_OBJECT_TIME).cast("timestamp").alias("object_time"), pbody.alias("body"))
    return orders_docs.unionByName(li_docs)


# Visit bundles: one per order, with what the order bundles lack. Entries: 0 Patient
# (POST, urn, with a primitive-extension sibling), 1 Organization (POST without
# fullUrl or id), 2 Encounter (POST, urn), 3 Observation (POST, urn; every 11th
# repeats the Encounter's fullUrl), 4 Condition (PUT, its id only in the url),
# 5 a DELETE without a resource. Encounter subject by o_orderkey % 5: 0 a urn that
# names no entry, 1 an absolute versioned reference, else the Patient's urn.
# Observation subject: every third a Group. Every 50th (remainder 7) is cut off.
def visit_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _landed(read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate"))
    k, ck = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    kt = k.cast("string")
    patient_urn, encounter_urn = F.concat(F.lit("urn:uuid:p-"), ck), F.concat(F.lit("urn:uuid:en-"), kt)

    def ref(c: Column) -> Column:
        return F.struct(c.alias("reference"))

    patient = F.struct(F.lit("Patient").alias("resourceType"), F.lit("female").alias("gender"),
                       _date_text(F.col("o_orderdate")).alias("birthDate"),
                       F.struct(F.lit("b1").alias("id")).alias("_birthDate"))
    organization = F.struct(F.lit("Organization").alias("resourceType"),
                            F.concat(F.lit("Clinic "), kt).alias("name"))
    encounter_subject = (F.when(k % 5 == 0, F.concat(F.lit("urn:uuid:gone-"), kt))
                         .when(k % 5 == 1, F.concat(F.lit("https://h/fhir/Patient/p-"), ck, F.lit("/_history/3")))
                         .otherwise(patient_urn))
    encounter = F.struct(F.lit("Encounter").alias("resourceType"), F.lit("finished").alias("status"),
                         ref(encounter_subject).alias("subject"))
    observation = F.struct(
        F.lit("Observation").alias("resourceType"), F.lit("own").alias("id"), F.lit("final").alias("status"),
        _coding(F.lit(LOINC), _code_by(k % 10, OBSERVATION_CODES)).alias("code"),
        ref(F.when(k % 3 == 0, F.lit("Group/g1")).otherwise(patient_urn)).alias("subject"),
        ref(encounter_urn).alias("encounter"),
        _date_text(F.col("o_orderdate")).alias("effectiveDateTime"))
    condition = F.struct(F.lit("Condition").alias("resourceType"),
                         _coding(F.lit(SNOMED), _code_by(k % 12, CONDITION_CODES)).alias("code"),
                         ref(patient_urn).alias("subject"))
    none = F.lit(None).cast("string")
    entries = F.concat_ws(
        ",", _entry(patient_urn, patient, "POST", F.lit("Patient")),
        _entry(none, organization, "POST", F.lit("Organization")),
        _entry(encounter_urn, encounter, "POST", F.lit("Encounter")),
        _entry(F.when(k % 11 == 0, encounter_urn).otherwise(F.concat(F.lit("urn:uuid:ov-"), kt)),
               observation, "POST", F.lit("Observation")),
        _entry(none, condition, "PUT", F.concat(F.lit("Condition/cv-"), kt)),
        F.concat(F.lit('{"request":{"method":"DELETE","url":"Basic/'), kt, F.lit('"}}')))
    body = F.concat(F.lit('{"resourceType":"Bundle","type":"transaction","entry":['), entries, F.lit("]}"))
    return o.select(
        F.concat(F.lit("visits/order-"), kt, F.lit(".json")).alias("object_name"),
        F.lit(BUNDLE_OBJECT_TIME).cast("timestamp").alias("object_time"),
        F.when(k % 50 == BROKEN_MALFORMED, F.substring(body, 1, 40)).otherwise(body).alias("body"))


# Census bundles: fifty customers' Patients each, so the number of objects grows with the table.
CENSUS_SIZE = 50


def census_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey")
    k = F.col("c_custkey")
    patient = F.struct(F.lit("Patient").alias("resourceType"),
                       F.when(k % 2 == 0, F.lit("female")).otherwise(F.lit("male")).alias("gender"))
    urn = F.concat(F.lit("urn:uuid:c-"), k.cast("string"))
    return (c.select(F.floor(k / CENSUS_SIZE).alias("g"), _entry(urn, patient, "POST", F.lit("Patient")).alias("e"))
            .groupBy("g").agg(F.array_join(F.sort_array(F.collect_list("e")), ",").alias("es"))
            .select(F.concat(F.lit("census/group-"), F.col("g").cast("string"), F.lit(".json")).alias("object_name"),
                    F.lit(BUNDLE_OBJECT_TIME).cast("timestamp").alias("object_time"),
                    F.concat(F.lit('{"resourceType":"Bundle","type":"batch","entry":['), F.col("es"),
                             F.lit("]}")).alias("body")))


# Roster bundles: a Group whose members are fifty customers by urn, the Patients as far as c_custkey % 7 is not
# 0 (those urns name no entry), and a repeated reference to the first member as managing entity.
def roster_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey")
    k = F.col("c_custkey")
    urn = F.concat(F.lit("urn:uuid:r-"), k.cast("string"))
    patient = F.struct(F.lit("Patient").alias("resourceType"), F.lit("unknown").alias("gender"))
    entity = F.struct(F.struct(urn.alias("reference")).alias("entity"))
    rows = c.select(F.floor(k / CENSUS_SIZE).cast("string").alias("g"), k, urn.alias("urn"), entity.alias("member"),
                    F.when(k % 7 != 0, _entry(urn, patient, "POST", F.lit("Patient"))).alias("e"))
    groups = rows.groupBy("g").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", "member"))), lambda x: x["member"]).alias("m"),
        F.min("c_custkey").alias("first"), F.array_join(F.sort_array(F.collect_list("e")), ",").alias("es"))
    group = F.struct(F.lit("Group").alias("resourceType"), F.col("g").alias("id"),
                     F.struct(F.concat(F.lit("urn:uuid:r-"), F.col("first").cast("string")).alias("reference"))
                     .alias("managingEntity"), F.col("m").alias("member"))
    url = F.concat(F.lit("Group/"), F.col("g"))
    return groups.select(
        F.concat(F.lit("rosters/group-"), F.col("g"), F.lit(".json")).alias("object_name"),
        F.lit(BUNDLE_OBJECT_TIME).cast("timestamp").alias("object_time"),
        F.concat(F.lit('{"resourceType":"Bundle","type":"transaction","entry":['), _entry(url, group, "PUT", url),
                 F.when(F.col("es") != "", F.concat(F.lit(","), F.col("es"))).otherwise(F.lit("")), F.lit("]}"))
        .alias("body"))


# Nested bundles: one per order, a Condition with an element that no type has somewhere below, by
# o_orderkey % 6: 1 in a coding, 2 in the subject's identifier, 3 in a note and in the evidence, 4 only under
# an extension (legal), 5 beside a primitive element (legal); else none.
def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    k = F.col("o_orderkey")
    r, kt = k % 6, k.cast("string")

    def when(n: int) -> Column:
        return F.when(r == n, F.lit("x"))

    condition = F.struct(
        F.lit("Condition").alias("resourceType"),
        F.struct(F.array(F.struct(F.lit("a").alias("code"), F.lit(None).cast("string").alias("colour")), F.struct(
            _code_by(k % 12, CONDITION_CODES).alias("code"), when(1).alias("colour"))).alias("coding")).alias("code"),
        F.struct(F.concat(F.lit("Patient/p-"), F.col("o_custkey").cast("string")).alias("reference"),
                 F.struct(when(2).alias("number")).alias("identifier")).alias("subject"),
        F.array(F.struct(F.lit("t").alias("text"), when(3).alias("mood"))).alias("note"),
        F.array(F.struct(when(3).alias("found"))).alias("evidence"),
        F.array(F.struct(when(4).alias("anything"))).alias("extension"),
        F.struct(when(5).alias("id")).alias("_recordedDate"))
    url = F.concat(F.lit("Condition/n-"), kt)
    return o.select(F.concat(F.lit("nested/order-"), kt, F.lit(".json")).alias("object_name"),
                    F.lit(BUNDLE_OBJECT_TIME).cast("timestamp").alias("object_time"),
                    F.concat(F.lit('{"resourceType":"Bundle","type":"transaction","entry":['),
                             _entry(url, condition, "PUT", url), F.lit("]}")).alias("body"))


# Stays: the orders of a customer as versions of one resource, in three batches by o_orderkey % 3, so that a
# batch brings versions older than ones already there.
def stay_versions(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    if batch is not None:
        o = o.where(F.col("o_orderkey") % 3 == batch)
    return o.select(F.concat(F.lit("p-"), F.col("o_custkey").cast("string")).alias("id"),
                    _meta(F.col("o_orderdate"), _padded(F.col("o_orderkey"))).alias("meta"),
                    F.col("o_orderstatus").alias("status"))


# Object events: one per bundle object. For order objects, remainders of o_orderkey % 13: 5 a deletion
# event, 6 no bucket, 7 another bucket, 8 a .txt object, 9 no event type.
EXPECTED_BUCKET = "clinical-landing"
OTHER_BUCKET = "elsewhere"
DELETED_EVENT = "google.cloud.storage.object.v1.deleted"


def procedure_event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: a finalized event per line-item bundle; every 17th order's objects are absent
    (their names end in ``.gone.json``)."""
    from gapwise.operators.ingest import OBJECT_FINALIZED
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    name = F.concat(procedure_object_name(), F.when(F.col("l_orderkey") % 17 == 0, F.lit(".gone.json"))
                    .otherwise(F.lit(".json")))
    return li.select(F.to_json(F.struct(
        F.lit(OBJECT_FINALIZED).alias("event_type"), F.lit(EXPECTED_BUCKET).alias("bucket"),
        name.alias("name"))).alias("value"))


def object_event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: object-event JSON text per order object (with an extra unknown field)."""
    from gapwise.operators.ingest import OBJECT_FINALIZED
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    k = F.col("o_orderkey")
    r = k % 13
    ev = F.struct(
        F.when(r == 5, F.lit(DELETED_EVENT)).when(r == 9, F.lit(None).cast("string"))
         .otherwise(F.lit(OBJECT_FINALIZED)).alias("event_type"),
        F.when(r == 6, F.lit(None).cast("string")).when(r == 7, F.lit(OTHER_BUCKET))
         .otherwise(F.lit(EXPECTED_BUCKET)).alias("bucket"),
        F.concat(F.lit("bundles/order-"), k.cast("string"),
                 F.when(r == 8, F.lit(".txt")).otherwise(F.lit(".json"))).alias("name"),
        k.cast("string").alias("generation"),
        F.col("o_totalprice").cast("long").alias("size"),
        F.lit("application/json").alias("contentType"),
        F.lit("STANDARD").alias("storageClass"))
    return o.select(F.to_json(ev).alias("value"))


# Store write attempts: one attempt per line item of the order's bundle, in
# line-number order; status by l_partkey % 8: 0,1,2 → 200, 3 → 503, 4 → 429,
# 5 → 400, 6 → 500, 7 → connection failure.
ATTEMPT_STATUS = {0: 200, 1: 200, 2: 200, 3: 503, 4: 429, 5: 400, 6: 500}


def store_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    r = F.col("l_partkey") % 8
    code = None
    for rem, st in ATTEMPT_STATUS.items():
        code = F.when(r == rem, F.lit(st)) if code is None else code.when(r == rem, F.lit(st))
    return li.select(
        F.concat(F.lit("bundles/order-"), F.col("l_orderkey").cast("string"), F.lit(".json"))
        .alias("object_name"),
        # Attempt number: line number, then part and supplier keys break ties.
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").alias("attempt"),
        code.alias("status_code"), (r == 7).alias("connection_error"))


# Run requests: one envelope per order, data = base64 of {"runDate": order date};
# o_orderkey % 9: 1 no data, 2 blank runDate, 3 malformed base64, 4 not JSON,
# 5 impossible date, 6 the JSON text null, 7 no message at all.
def run_request_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    r = k % 9
    payload = (F.when(r == 2, F.lit('{"runDate":"  "}'))
               .when(r == 4, F.lit("runDate=2001-01-01"))
               .when(r == 5, F.lit('{"runDate":"2001-02-30"}'))
               .when(r == 6, F.lit("null"))
               .otherwise(F.concat(F.lit('{"runDate":"'), _date_text(F.col("o_orderdate")),
                                   F.lit('","source":"backfill"}'))))
    data = (F.when(r == 1, F.lit(None).cast("string"))
            .when(r == 3, F.lit("%%not-base64%%"))
            .otherwise(F.base64(F.encode(payload, "UTF-8"))))
    env = F.struct(
        F.when(r != 7, F.struct(data.alias("data"), k.cast("string").alias("messageId")))
         .alias("message"),
        F.lit("projects/x/subscriptions/measure-run").alias("subscription"))
    return o.select(k.cast("string").alias("request_id"), F.to_json(env).alias("value"))
