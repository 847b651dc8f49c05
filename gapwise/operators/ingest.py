"""Bundle ingest as DataFrame transforms.

Input rows are whole bundle documents ``(object_name, object_time, body)``,
from files (``gapwise.sources.bundles.read_bundles``), a file stream, or any
DataFrame. Bodies are parsed once into Spark's VARIANT type and every later
step reads typed fields from it with ``try_variant_get``; there is no
per-row Python.

Flow: ``parse_bundles`` (parse + typed rejects + unknown elements) →
``explode_entries`` (one row per entry, or one row per rejected bundle) →
``rewrite_to_put`` (idempotent PUTs, ids inside the document, ids for creates
that bring none). That part is a map over the bundle rows. ``stage`` writes its
result once, partitioned by resource type with the quarantine beside it, and
every later step reads that table: ``project_resources`` types the measure
inputs, ``append_versions`` stores every resource type. References are resolved
by an equi-join of the rows that hold one with their bundle's fullUrls; the
documents of short bundles (``ROW_LOOKUP``) are resolved in their row, from what
their bundle's fullUrls name, which the map part leaves beside every entry.
``latest`` gives the current state, so replaying a bundle never adds resources.

The parsed bundle and its checks are outputs of one-element ``explode`` steps:
Catalyst does not inline generated columns, so a text is parsed once per job
however many fields are read from it, without writing the corpus anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.functions.expr import safe_ts
from gapwise.operators.versions import latest
from gapwise.session import scratch_path

# --- fixed values ------------------------------------------------------------
OBJECT_FINALIZED = "google.cloud.storage.object.v1.finalized"
JSON_SUFFIX = ".json"
URN_UUID = "urn:uuid:"
URN_REFERENCE = '"reference":"(urn:uuid:[^"]*)"'
#: A text without both of these holds no urn reference, however it is laid out, unless it has an
#: escape, which may spell anything.
URN_REFERENCE_PARTS, ESCAPE = ('"reference"', URN_UUID), "\\"
#: Bundles of up to so many entries bring what their fullUrls name along in every entry.
ROW_LOOKUP = 32
#: So many names that several documents share are broadcast.
MAX_BROADCAST_NAMES = 200_000
WRITE_BUNDLE_TYPES = ("transaction", "batch")
TRANSIENT_STATUS = (429, 500, 502, 503, 504)
DEFAULT_MAX_ATTEMPTS = 5
# Admission reasons (I1) and bundle rejection reasons.
IGNORED_TYPE = "ignored: unexpected event type"
IGNORED_MALFORMED = "ignored: malformed event"
IGNORED_BUCKET = "ignored: unexpected bucket"
IGNORED_NOT_JSON = "ignored: not a .json object"
REJECT_MALFORMED = "malformed JSON"
REJECT_NOT_BUNDLE = "not a Bundle"
REJECT_BUNDLE_TYPE = "not a transaction or batch bundle"
REJECT_NO_ENTRIES = "no entries"
REJECT_UNKNOWN_ELEMENT = "unknown element"
# Top-level elements of the FHIR R4 resources this pipeline projects (public
# specification). Resource types not listed here are not checked.
KNOWN_ELEMENTS = {
    "Patient": [
        "resourceType", "id", "meta", "implicitRules", "language", "text", "contained",
        "extension", "modifierExtension", "identifier", "active", "name", "telecom",
        "gender", "birthDate", "deceasedBoolean", "deceasedDateTime", "address",
        "maritalStatus", "multipleBirthBoolean", "multipleBirthInteger", "photo",
        "contact", "communication", "generalPractitioner", "managingOrganization", "link"],
    "Condition": [
        "resourceType", "id", "meta", "implicitRules", "language", "text", "contained",
        "extension", "modifierExtension", "identifier", "clinicalStatus",
        "verificationStatus", "category", "severity", "code", "bodySite", "subject",
        "encounter", "onsetDateTime", "onsetAge", "onsetPeriod", "onsetRange", "onsetString",
        "abatementDateTime", "abatementAge", "abatementPeriod", "abatementRange",
        "abatementString", "recordedDate", "recorder", "asserter", "stage", "evidence", "note"],
    "Observation": [
        "resourceType", "id", "meta", "implicitRules", "language", "text", "contained",
        "extension", "modifierExtension", "identifier", "basedOn", "partOf", "status",
        "category", "code", "subject", "focus", "encounter", "effectiveDateTime",
        "effectivePeriod", "effectiveTiming", "effectiveInstant", "issued", "performer",
        "valueQuantity", "valueCodeableConcept", "valueString", "valueBoolean",
        "valueInteger", "valueRange", "valueRatio", "valueSampledData", "valueTime",
        "valueDateTime", "valuePeriod", "dataAbsentReason", "interpretation", "note",
        "bodySite", "method", "specimen", "device", "referenceRange", "hasMember",
        "derivedFrom", "component"],
    "Procedure": [
        "resourceType", "id", "meta", "implicitRules", "language", "text", "contained",
        "extension", "modifierExtension", "identifier", "instantiatesCanonical",
        "instantiatesUri", "basedOn", "partOf", "status", "statusReason", "category", "code",
        "subject", "encounter", "performedDateTime", "performedPeriod", "performedString",
        "performedAge", "performedRange", "recorder", "asserter", "performer", "location",
        "reasonCode", "reasonReference", "bodySite", "outcome", "report", "complication",
        "complicationDetail", "followUp", "note", "focalDevice", "usedReference", "usedCode"],
    "Encounter": [
        "resourceType", "id", "meta", "implicitRules", "language", "text", "contained",
        "extension", "modifierExtension", "identifier", "status", "statusHistory", "class",
        "classHistory", "type", "serviceType", "priority", "subject", "episodeOfCare",
        "basedOn", "participant", "appointment", "period", "length", "reasonCode",
        "reasonReference", "diagnosis", "account", "hospitalization", "location",
        "serviceProvider", "partOf"],
}
#: Types with a typed projection; every other type is stored as a document.
RESOURCE_TYPES = ("Patient", "Condition", "Observation", "Procedure")
#: Partitions of a staged table that hold no typed resource.
QUARANTINE, UNTYPED = "_quarantine", "_untyped"


# --- S3 / I1: object events -------------------------------------------------------
OBJECT_EVENT_DDL = ("event_type STRING, bucket STRING, name STRING, generation STRING, "
                    "size BIGINT, contentType STRING")


def parse_object_events(df: DataFrame, col: str = "value") -> DataFrame:
    """JSON event text → the bound fields; unknown fields are ignored (S3).

    A text is parsed once, not once for every use of a field."""
    return df.select("*", _once(F.from_json(F.col(col), OBJECT_EVENT_DDL)).alias("_e")).select(
        *[c for c in df.columns if c != col], "_e.*")


def admit_events(events: DataFrame, expected_bucket: str | None = None) -> DataFrame:
    """Add ``reason`` (NULL = accepted), checks in the reference order.

    A NULL event type passes; the suffix test is case-sensitive.
    """
    et, bucket, name = F.col("event_type"), F.col("bucket"), F.col("name")
    reason = F.when(et.isNotNull() & (et != F.lit(OBJECT_FINALIZED)), F.lit(IGNORED_TYPE)) \
        .when(bucket.isNull() | name.isNull(), F.lit(IGNORED_MALFORMED))
    if expected_bucket is not None and expected_bucket.strip() != "":
        reason = reason.when(bucket != F.lit(expected_bucket), F.lit(IGNORED_BUCKET))
    reason = reason.when(~name.endswith(JSON_SUFFIX), F.lit(IGNORED_NOT_JSON))
    return events.withColumn("reason", reason)


# --- I2 / I3: validation -------------------------------------------------------------
def _once(col: Column) -> Column:
    """Evaluate ``col`` once per row: a one-element explode is never inlined."""
    return F.explode(F.array(col))


def _known_elements_map() -> Column:
    pairs = []
    for t, keys in KNOWN_ELEMENTS.items():
        pairs += [F.lit(t), F.array(*[F.lit(k) for k in keys])]
    return F.create_map(*pairs)


#: What is read of a bundle and of an entry, each in one cast of the VARIANT. A part of another
#: kind than named here (a number for an object) is NULL.
ENTRY_DDL = "struct<fullUrl: string, resource: variant, request: struct<method: string, url: string>>"
BUNDLE_DDL = f"struct<resourceType: string, type: string, entry: array<{ENTRY_DDL}>>"
RESOURCE_DDL = "struct<resourceType: string, id: string>"
#: The element names of a resource; hardly any value is of this kind, so none is copied.
NAMES_DDL = "map<string, array<array<boolean>>>"


def _keys_known(rtype: Column, keys: Column) -> Column:
    """Whether all of a resource's element names are allowed, by one match per resource: a VARIANT's
    names are sorted, so each is tried once. False only sends a resource to the exact look."""
    text = F.concat(F.array_join(keys, ","), F.lit(","))
    out = F.lit(True)
    for t, names in KNOWN_ELEMENTS.items():
        in_order = "".join(f"(?:{x},)?+" for x in sorted([*names, *(f"_{x}" for x in names)]))
        known = text.rlike(f"^{in_order}$") | (F.size(keys) == 0)
        out = F.when(rtype == t, known).otherwise(out)
    return out


def _first_unknown(rtype: Column, keys: Column) -> Column:
    """``Type.key`` of the first of a resource's top-level keys that is
    not allowed for its type (NULL when none, or when the type is unchecked).
    ``_key`` carries the id and extensions of a primitive element ``key``."""
    allowed = F.try_element_at(_known_elements_map(), rtype)
    bad = F.try_element_at(F.filter(keys, lambda k: ~F.array_contains(
        allowed, F.when(k.startswith("_"), F.substr(k, F.lit(2))).otherwise(k))), F.lit(1))
    return F.when(F.coalesce(~_keys_known(rtype, keys), F.lit(False)), F.concat(rtype, F.lit("."), bad))


def _with_head(e: Column) -> Column:
    """An entry with its resource's type, id and element names."""
    r = e["resource"]
    return F.struct(e.alias("e"), F.try_variant_get(r, "$", RESOURCE_DDL).alias("r"),
                    F.map_keys(F.try_variant_get(r, "$", NAMES_DDL)).alias("keys"))


def _may_hold_urns(body: Column) -> Column:
    parts = [F.contains(body, F.lit(x)) for x in URN_REFERENCE_PARTS]
    return (parts[0] & parts[1]) | F.contains(body, F.lit(ESCAPE))


def parse_bundles(raw: DataFrame) -> DataFrame:
    """``entry`` (ARRAY of entries ``e`` with their resource's head ``r`` and ``keys``) plus ``reason`` /
    ``detail`` / ``bundle_type`` and ``has_urns`` for every document of ``(object_name, object_time, body)``;
    NULL reason = accepted (I2, I3).

    ``has_urns`` is False only where no resource can hold a urn reference. A bundle and its entries are
    read in one cast, a resource's head in another; the checks run over what those have left.
    """
    keep = [c for c in raw.columns if c != "body"]
    parsed = raw.select(*keep, _may_hold_urns(F.col("body")).alias("has_urns"),
                        _once(F.try_parse_json(F.col("body"))).alias("_v"))
    parsed = parsed.select(*keep, "has_urns", F.col("_v").isNotNull().alias("_json"),
                           _once(F.try_variant_get("_v", "$", BUNDLE_DDL)).alias("_b"))
    rtype, btype = F.col("_b.resourceType"), F.col("_b.type")
    parsed = parsed.select(*keep, "has_urns", "_json", rtype.alias("_rtype"), btype.alias("bundle_type"),
                           _once(F.transform("_b.entry", _with_head)).alias("entry"))
    rtype, btype, ents = F.col("_rtype"), F.col("bundle_type"), F.col("entry")
    unknown = F.try_element_at(F.filter(F.transform(ents, lambda e: _first_unknown(
        e["r"]["resourceType"], e["keys"])), lambda x: x.isNotNull()), F.lit(1))
    reason = (F.when(~F.col("_json"), F.lit(REJECT_MALFORMED))
              .when(F.coalesce(rtype != F.lit("Bundle"), F.lit(True)), F.lit(REJECT_NOT_BUNDLE))
              .when(F.coalesce(~btype.isin(*WRITE_BUNDLE_TYPES), F.lit(True)), F.lit(REJECT_BUNDLE_TYPE))
              .when(F.coalesce(F.size(ents) < 1, F.lit(True)), F.lit(REJECT_NO_ENTRIES))
              .when(F.col("_unknown").isNotNull(), F.lit(REJECT_UNKNOWN_ELEMENT)))
    detail = (F.when(F.col("reason") == REJECT_NOT_BUNDLE, F.coalesce(rtype, F.lit("unknown")))
              .when(F.col("reason") == REJECT_BUNDLE_TYPE, F.coalesce(btype, F.lit("none")))
              .when(F.col("reason") == REJECT_UNKNOWN_ELEMENT, F.col("_unknown")))
    return (parsed.withColumn("_unknown", _once(unknown)).withColumn("reason", reason)
            .withColumn("detail", detail)
            .select(*keep, "entry", "has_urns", "reason", "detail", "bundle_type"))


# --- I4 / I5 / I6 / I7: entries and idempotent rewrite --------------------------------
def _entry_parts(entry: Column, pos: Column) -> dict[str, Column]:
    e, r = entry["e"], entry["r"]
    return {"pos": pos, "full_url": e["fullUrl"], "resource": e["resource"], "resource_type": r["resourceType"],
            "resource_id": r["id"], "method": e["request"]["method"], "url": e["request"]["url"],
            "has_request": e["request"].isNotNull()}


def _identity(e: dict[str, Column]) -> dict[str, Column]:
    """Of an entry's parts: ``rw``, whether it is a POST with a ``urn:uuid:`` fullUrl; ``given``, the id that
    it brings (its resource's, else that of its PUT url); ``rid``, the id that its resource gets."""
    has = e["resource"].isNotNull()
    rw = (has & e["has_request"] & (F.coalesce(e["method"], F.lit("")) == "POST")
          & F.coalesce(e["full_url"].startswith(URN_UUID), F.lit(False)))
    uuid = F.substr(e["full_url"], F.lit(len(URN_UUID) + 1))
    put_id = F.when(e["method"] == "PUT", F.nullif(
        F.regexp_extract(e["url"], r"(?:^|/)[A-Za-z]+/([^/?]+)$", 1), F.lit("")))
    given = F.coalesce(e["resource_id"], put_id)
    fresh = F.concat(F.lit("new-"), F.substring(
        F.sha2(F.concat_ws(":", F.col("object_name"), e["pos"].cast("string")), 256), 1, 32))
    rid = F.when(rw, uuid).when(has, F.coalesce(given, fresh)).otherwise(e["resource_id"])
    return {"has": has, "rw": rw, "uuid": uuid, "given": given, "rid": rid}


def _named_by_urns() -> Column:
    """``(urn, to)`` for the urns among a bundle's fullUrls in entry order, as in :func:`reference_targets`."""
    def named(entry: Column, pos: Column) -> Column:
        parts = _entry_parts(entry, pos)
        target = F.concat_ws("/", parts["resource_type"], _identity(parts)["rid"])
        is_urn = parts["full_url"].startswith(URN_UUID) & parts["resource_type"].isNotNull()
        return F.named_struct(F.lit("urn"), parts["full_url"], F.lit("to"), F.when(is_urn, target))
    return F.filter(F.transform("entry", named), lambda x: x["to"].isNotNull())


def explode_entries(parsed: DataFrame) -> DataFrame:
    """One row per entry with its position and typed request fields (I4); a
    rejected bundle gives one row without position, with its reason.

    ``named`` is what the fullUrls of its bundle name, if that may hold a urn reference and has at most
    ``ROW_LOOKUP`` entries; ``by_join`` marks the longer ones, and those without a name or time.
    """
    keep = [c for c in parsed.columns if c != "entry"]
    short = ((F.coalesce(F.size("entry"), F.lit(0)) <= ROW_LOOKUP)
             & F.col("object_name").isNotNull() & F.col("object_time").isNotNull())
    accepted = F.when(F.col("reason").isNull(), F.col("entry"))
    # Beside the generator they would be made for every entry, from a copy of all.
    rows = parsed.select(
        *keep, F.when(F.col("reason").isNull() & F.col("has_urns") & short, _named_by_urns()).alias("named"),
        (F.col("has_urns") & ~short).alias("by_join"), accepted.alias("entry"))
    rows = rows.select(*[c for c in rows.columns if c != "entry"], F.posexplode_outer("entry").alias("pos", "entry"))
    return rows.select(*keep, "named", "by_join",
                       *[c.alias(name) for name, c in _entry_parts(F.col("entry"), F.col("pos")).items()])


def normalize_bundle_type(df: DataFrame) -> DataFrame:
    """``batch`` bundles become ``transaction``."""
    return df.withColumn("bundle_type", F.when(F.col("bundle_type") == "batch", F.lit("transaction"))
                         .otherwise(F.col("bundle_type")))


def _with_id(resource: Column, rid: Column) -> Column:
    """The resource document with its top-level id set."""
    fields = F.map_filter(F.try_variant_get(resource, "$", "map<string,variant>"), lambda k, _: k != "id")
    return F.to_variant_object(F.map_concat(fields, F.create_map(F.lit("id"), rid.cast("variant"))))


def rewrite_to_put(entries: DataFrame) -> DataFrame:
    """POST with a ``urn:uuid:`` fullUrl → ``PUT Type/<uuid>``, id := uuid.

    Everything else (existing PUT, no urn fullUrl, missing resource or
    request) keeps its request as is. ``rewritten`` marks the changed entries.
    A resource that brings no id of its own is created by the store: it gets
    the id of its PUT url, else one formed from object name and position, the
    same on every replay (``created``). The id is also set in the document.
    """
    i = _identity({c: F.col(c) for c in ("pos", "full_url", "resource", "resource_id", "method", "url", "has_request")})
    has, rw, rid = i["has"], i["rw"], i["rid"]
    cols = [c for c in entries.columns if c not in ("resource_id", "method", "url", "resource")]
    # One projection, so every output is decided from the entry as written.
    return entries.select(
        *cols, F.coalesce(rw, F.lit(False)).alias("rewritten"), rid.alias("resource_id"),
        (has & ~rw & i["given"].isNull()).alias("created"),
        F.when(rw, F.lit("PUT")).otherwise(F.col("method")).alias("method"),
        F.when(rw, F.concat_ws("/", F.col("resource_type"), i["uuid"])).otherwise(F.col("url")).alias("url"),
        F.when(has & (F.col("resource_id").isNull() | (F.col("resource_id") != rid)),
               _with_id(F.col("resource"), rid)).otherwise(F.col("resource")).alias("resource"))


def rewrite_stats(entries: DataFrame) -> DataFrame:
    """Per bundle: entries, rewritten and left-as-is counts."""
    return entries.groupBy("object_name").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(F.col("rewritten")).alias("rewritten"),
        F.count_if(~F.col("rewritten")).alias("left_as_is"))


# --- I8: intra-bundle references --------------------------------------------------------
BUNDLE = ["object_name", "object_time"]


def reference_targets(entries: DataFrame) -> DataFrame:
    """``fullUrl → Type/id`` of every bundle for the urns among its fullUrls, as only urn references are
    looked up; of equal fullUrls the first entry counts."""
    return (entries.where(F.col("full_url").startswith(URN_UUID) & F.col("resource_type").isNotNull())
            .groupBy(*BUNDLE, F.col("full_url").alias("urn"))
            .agg(F.min_by(F.concat_ws("/", "resource_type", "resource_id"), "pos").alias("target")))


def resolve_references(entries: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """``urn:uuid:`` subjects resolved against the fullUrls of the same bundle (I8).

    Adds ``reference`` (the subject as written), ``resolved_reference``
    (``Type/id``) and ``unresolved`` (a urn that names no entry of the bundle).
    Only rows with a urn subject are joined; the others would all meet under a
    null key. ``among``: the entries whose fullUrls count (default: ``entries``).
    """
    return _resolve(entries.withColumn("reference", _reference()),
                    reference_targets(entries if among is None else among))


def _reference() -> Column:
    return F.try_variant_get("resource", "$.subject.reference", "string")


def _resolve(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``rows(bundle, reference, ...)`` with ``resolved_reference`` and ``unresolved``."""
    is_urn = F.coalesce(F.col("reference").startswith(URN_UUID), F.lit(False))
    plain = (rows.where(~is_urn).withColumn("resolved_reference", F.col("reference"))
             .withColumn("unresolved", F.lit(False)))
    joined = (rows.where(is_urn).withColumn("urn", F.col("reference"))
              .join(targets, [*BUNDLE, "urn"], "left")
              .withColumn("resolved_reference", F.col("target"))
              .withColumn("unresolved", F.col("target").isNull()))
    return plain.unionByName(joined.select(*plain.columns))


def reference_rows(entries: DataFrame) -> DataFrame:
    """Every urn reference anywhere in a resource: ``(bundle, pos, urn, target)``,
    target NULL where it names no entry of the bundle."""
    return (entries.select(*BUNDLE, "pos", F.explode(F.array_distinct("urns")).alias("urn"))
            .join(reference_targets(entries), [*BUNDLE, "urn"], "left"))


def urn_references(text: Column) -> Column:
    """The urn references of a document's text in their order, repeated ones too."""
    return F.regexp_extract_all(text, F.lit(URN_REFERENCE), F.lit(1))


def with_urns(rows: DataFrame) -> DataFrame:
    """Adds ``urns``, the urn references of ``resource``; looked for only in bundles that may hold one."""
    none = F.when(F.col("resource").isNotNull(), F.array().cast("array<string>"))
    return rows.withColumn("urns", F.when(F.col("has_urns"), urn_references(F.to_json("resource"))).otherwise(none))


def resolve_in_rows(rows: DataFrame) -> DataFrame:
    """:func:`resolve_documents` for entries of bundles whose fullUrls are in ``named``: a map."""
    out = rows.withColumn("_text", F.when(F.col("has_urns"), F.to_json("resource")))
    out = out.withColumn("_urns", urn_references(F.col("_text")))
    written = F.zip_with(F.split("_text", URN_REFERENCE), F.transform("_urns", lambda u: F.coalesce(F.try_element_at(
        F.col("named.to"), F.nullif(F.array_position("named.urn", u), F.lit(0)).cast("int")), u)), _reference_after)
    resolved = F.when(F.size("_urns") > 0, F.parse_json(F.array_join(written, ""))).otherwise(F.col("resource"))
    return out.withColumn("resource", resolved).select(*rows.columns)


def _reference_after(piece: Column, to: Column) -> Column:
    return F.concat(piece, F.coalesce(F.concat(F.lit('"reference":"'), to, F.lit('"')), F.lit("")))


def resolve_documents(entries: DataFrame) -> DataFrame:
    """``resource`` with every resolvable urn reference replaced by ``Type/id``.

    The text is cut at its references, their targets are joined in, and the
    pieces are put together again once: linear in the text, however many
    references a resource has.
    """
    has = F.size("urns") > 0
    cut = (entries.where(has).withColumn("_pieces", F.split(F.to_json("resource"), URN_REFERENCE))
           .drop("resource"))
    found = (entries.where(has).select(*BUNDLE, "pos", F.posexplode("urns").alias("_k", "urn"))
             .join(reference_targets(entries), [*BUNDLE, "urn"], "left")
             .groupBy(*BUNDLE, "pos").agg(F.sort_array(F.collect_list(
                 F.struct("_k", F.coalesce("target", "urn").alias("to")))).alias("_to")))
    written = F.zip_with(F.col("_pieces"), F.col("_to"), lambda piece, to: _reference_after(piece, to["to"]))
    done = (cut.join(found, [*BUNDLE, "pos"])
            .withColumn("resource", F.parse_json(F.array_join(written, ""))))
    return entries.where(~F.coalesce(has, F.lit(False))).unionByName(done.select(*entries.columns))


# --- I10: analytics projection ---------------------------------------------------------
def _version_meta() -> Column:
    """Source ``meta`` if present; otherwise the object time, ties by object and position."""
    src_ts = safe_ts(F.try_variant_get("resource", "$.meta.lastUpdated", "string"))
    src_v = F.try_variant_get("resource", "$.meta.versionId", "string")
    def digits(c: Column, width: int) -> Column:
        padded = F.when((c >= 0) & (F.length(c.cast("string")) <= width), F.lpad(c.cast("string"), width, "0"))
        return padded.otherwise(F.format_string(f"%0{width}d", c))

    ingest_v = F.concat_ws(":", digits(F.unix_micros(F.col("object_time")), 20), F.col("object_name"),
                           digits(F.col("pos"), 10))
    return F.struct(F.coalesce(src_ts, F.col("object_time")).alias("lastUpdated"),
                    F.coalesce(src_v, ingest_v).alias("versionId"))


def _coding() -> Column:
    return F.struct(F.try_variant_get("resource", "$.code.coding",
                                      "array<struct<system:string,code:string>>").alias("coding"))


PATIENT_REFERENCE = r"(?:^|/)Patient/([^/]+)(?:/_history/[^/]+)?$"


def _subject(reference: Column) -> Column:
    """``patientId`` of a relative or absolute, versioned or plain Patient reference; else NULL."""
    return F.struct(F.nullif(F.regexp_extract(reference, PATIENT_REFERENCE, 1), F.lit("")).alias("patientId"))


def _own_columns(resource_type: str) -> list[Column]:
    """The typed columns of one type that are read from ``resource`` alone."""
    def get(p: str) -> Column:
        return F.try_variant_get("resource", p, "string")

    return {
        "Patient": [get("$.gender").alias("gender"), get("$.birthDate").alias("birthDate")],
        "Condition": [_coding().alias("code")],
        "Observation": [_coding().alias("code"),
                        F.struct(get("$.effectiveDateTime").alias("dateTime")).alias("effective")],
        "Procedure": [_coding().alias("code"),
                      F.struct(get("$.performedDateTime").alias("dateTime")).alias("performed")],
    }[resource_type]


def project(resource_type: str, rows: DataFrame) -> DataFrame:
    """Typed version rows of one type from ``(id, meta, resource)``, shaped like the
    measure inputs (I10): choice fields become structs (``performedDateTime`` →
    ``performed.dateTime``), references become ``subject.patientId``."""
    reference = F.try_variant_get("resource", "$.subject.reference", "string")
    subject = [] if resource_type == "Patient" else [_subject(reference).alias("subject")]
    return rows.select("id", "meta", *subject, *_own_columns(resource_type))


#: What a version row is made of.
STORED = [*BUNDLE, "pos", "resource_type", "resource_id", "resource"]


def _stored(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("resource").isNotNull())


def project_resources(entries: DataFrame) -> dict[str, DataFrame]:
    """Typed version rows per measure input type (I10). Their references are resolved
    after the projection, so that the join moves typed columns and no documents."""
    def rows(t: str) -> DataFrame:
        named = (_stored(entries).where(F.col("resource_type") == t)
                 .withColumns({"id": F.col("resource_id"), "meta": _version_meta()}))
        if t == "Patient":
            return project(t, named)
        own = named.select(*BUNDLE, "id", "meta", _reference().alias("reference"), *_own_columns(t))
        return _resolve(own, reference_targets(entries)).select(
            "id", "meta", _subject(F.col("resolved_reference")).alias("subject"),
            *[c for c in own.columns if c not in (*BUNDLE, "id", "meta", "reference")])

    return {t: rows(t) for t in RESOURCE_TYPES}


class Ingested:
    """One ingest pass: ``rows`` are the entries and the rejected bundles."""

    def __init__(self, rows: DataFrame, written: bool = False):
        self.rows, self.written = rows, written

    @property
    def entries(self) -> DataFrame:
        return with_urns(self._accepted).drop("has_urns", "named", "by_join")

    @property
    def _accepted(self) -> DataFrame:
        return self.rows.where(F.col("reason").isNull()).drop("reason", "detail")

    @property
    def rejected(self) -> DataFrame:
        return self.rows.where(F.col("reason").isNotNull()).select("object_name", "object_time", "reason", "detail")

    @property
    def resolved(self) -> DataFrame:
        return resolve_references(self.entries)

    def versions(self) -> dict[str, DataFrame]:
        return project_resources(self.entries)

    def versions_long(self) -> DataFrame:
        """Every resource of every type as a version row with its final document (S5 input)."""
        return self._documents().select(
            F.coalesce("resource_type", F.lit(UNTYPED)).alias("resource_type"),
            F.col("resource_id").alias("id"), "meta", "resource", "object_name", "pos")

    def _documents(self) -> DataFrame:
        """Entries with a resource, their documents resolved: in the row, and by a join those of bundles that are
        long or share name and time with another document. Rows not written yet are not read twice to tell.
        ``meta`` is the document's own, so whoever takes no ``resource`` needs none resolved."""
        def with_meta(entries: DataFrame) -> DataFrame:
            return _stored(entries).withColumn("meta", _version_meta())

        if not self.written:
            return with_meta(resolve_documents(self.entries))
        rows = self._accepted.withColumn("_name", F.xxhash64(*BUNDLE))
        names = (rows.where("pos = 0").groupBy("_name")
                 .agg((F.count(F.lit(1)) > 1).alias("_shared"), F.bool_or("by_join").alias("by_join")))
        n = names.agg(F.count_if("_shared").alias("shared"), F.bool_or("by_join").alias("by_join")).first()
        if not n.shared and not n.by_join:
            return resolve_in_rows(with_meta(self._accepted))
        joined = F.col("by_join")
        if n.shared:
            shared = names.where("_shared").select("_name", "_shared").checkpoint()
            rows = rows.join(F.broadcast(shared) if n.shared <= MAX_BROADCAST_NAMES else shared, "_name", "left")
            joined = joined | F.coalesce("_shared", F.lit(False))
        rows = rows.withColumn("_joined", joined)
        alone = resolve_in_rows(with_meta(rows.where("NOT _joined")))
        among = with_urns(rows.where("_joined")).select(*STORED, "full_url", "urns")
        both = [*STORED, "meta"]
        return alone.select(*both).unionByName(with_meta(resolve_documents(among)).select(*both))


def ingest(raw: DataFrame) -> Ingested:
    """The map part of the chain for ``(object_name, object_time, body)`` rows, nothing written.

    Every use of the result parses the texts again: use :func:`stage` where
    more than one step reads it.
    """
    return Ingested(rewrite_to_put(explode_entries(normalize_bundle_type(parse_bundles(raw)))))


def write_parts(rows: DataFrame, path: str, by: str) -> None:
    """``rows`` as Parquet partitioned by ``by``, a VARIANT as it is: its readers take it whole, so taking
    it apart into typed columns and putting it together again would be work without use."""
    conf, key = rows.sparkSession.conf, "spark.sql.variant.inferShreddingSchema"
    before = conf.get(key, None)
    conf.set(key, "false")
    try:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(by).parquet(path)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def stage(raw: DataFrame, path: str | None = None) -> Ingested:
    """:func:`ingest` written once to ``path`` (default: a fresh shared scratch folder),
    partitioned by resource type with the quarantine as a partition of its own."""
    spark: SparkSession = raw.sparkSession
    path = path or scratch_path(spark, "ingest")
    rows = ingest(raw).rows.withColumn(
        "part", F.when(F.col("reason").isNotNull(), F.lit(QUARANTINE))
        .otherwise(F.coalesce("resource_type", F.lit(UNTYPED))))
    write_parts(rows, path, "part")
    return staged(spark, path, rows.schema)


def staged(spark: SparkSession, path: str, schema) -> Ingested:
    return Ingested(spark.read.schema(schema).parquet(path), written=True)


# --- I9 / I15: replay safety and counts ----------------------------------------------
def resource_counts(versions_long: DataFrame) -> DataFrame:
    """Current resources per type; replaying bundles does not change it."""
    cur = latest(versions_long, ["resource_type", "id"])
    return cur.groupBy("resource_type").agg(F.count(F.lit(1)).alias("resources"))


def drop_identical_replays(versions_long: DataFrame) -> DataFrame:
    """Remove version rows identical in type, id and content."""
    h = F.xxhash64(F.to_json("resource"))
    return versions_long.withColumn("_h", h).dropDuplicates(["resource_type", "id", "_h"]).drop("_h")


# --- I11–I14: outcomes, dispositions, results, report ----------------------------------
def classify_outcomes(attempts: DataFrame) -> DataFrame:
    """``success`` (2xx), ``transient`` (connection failure or 429/5xx listed),
    ``permanent`` (anything else) (I11)."""
    st = F.col("status_code")
    outcome = (F.when(F.coalesce(F.col("connection_error"), F.lit(False)), F.lit("transient"))
               .when(st.between(200, 299), F.lit("success"))
               .when(st.isin(*TRANSIENT_STATUS), F.lit("transient"))
               .otherwise(F.lit("permanent")))
    return attempts.withColumn("outcome", outcome)


def dispositions(attempts: DataFrame, max_attempts: int = DEFAULT_MAX_ATTEMPTS) -> DataFrame:
    """Per object: ``ack`` (success or permanent), ``retry`` (transient with budget
    left) or ``redeliver`` (transient, budget exhausted) (I12)."""
    per = classify_outcomes(attempts).groupBy("object_name").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.max_by("outcome", "attempt").alias("last_outcome"))
    disp = (F.when(F.col("last_outcome") != "transient", F.lit("ack"))
            .when(F.col("attempts") >= max_attempts, F.lit("redeliver"))
            .otherwise(F.lit("retry")))
    return per.withColumn("disposition", disp)


def ingest_result(entries: DataFrame) -> DataFrame:
    """Per ingested object: number of entries."""
    return entries.groupBy("object_name").agg(F.count(F.lit(1)).alias("resource_count"))


def ingest_report(statuses: DataFrame) -> DataFrame:
    """Totals per status over ``(object_name, status)`` rows."""
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("objects"))


def object_statuses(admitted: DataFrame, ingested: Ingested, disp: DataFrame | None = None) -> DataFrame:
    """``(object_name, status)`` for every delivered event.

    ``skipped``: acknowledged without a write (event ignored, object missing or
    rejected, permanent store error); ``ingested``: written; ``pending``: no
    outcome yet, or a transient error with attempts left; ``failed``:
    attempts used up, to be delivered again. Without ``disp`` every accepted
    bundle counts as written.
    """
    per_object = (ingested.rows.groupBy("object_name")
                  .agg(F.max(F.col("reason").isNotNull()).alias("_rejected")))
    rows = admitted.select("object_name", "reason").join(per_object, "object_name", "left")
    written = F.lit("ingested")
    if disp is not None:
        rows = rows.join(disp.select("object_name", "last_outcome", "disposition"), "object_name", "left")
        written = (F.when(F.col("last_outcome") == "success", F.lit("ingested"))
                   .when(F.col("last_outcome") == "permanent", F.lit("skipped"))
                   .when(F.col("disposition") == "redeliver", F.lit("failed"))
                   .otherwise(F.lit("pending")))
    skipped = F.col("reason").isNotNull() | F.coalesce(F.col("_rejected"), F.lit(True))
    return rows.select("object_name", F.when(skipped, F.lit("skipped")).otherwise(written).alias("status"))
