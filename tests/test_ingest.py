"""Bundle ingest (S1, S3, S5, I1–I15) and run requests."""
import base64
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from gapwise.operators import ingest as I
from gapwise.operators.requests import parse_run_requests, run_dates_in_order
from gapwise.sources.bundles import (append_versions, read_admitted, read_bundles, read_resources,
                                     read_versions)

T = dt.datetime(2024, 1, 1)


def entry(full_url, resource, method="POST", url=None):
    e = {"resource": resource, "request": {"method": method, "url": url or resource["resourceType"]}}
    if full_url:
        e["fullUrl"] = full_url
    return e


PATIENT = {"resourceType": "Patient", "gender": "female", "birthDate": "1960-01-01"}
OBS = {"resourceType": "Observation", "subject": {"reference": "urn:uuid:pat-1"},
       "code": {"coding": [{"system": "http://loinc.org", "code": "4548-4"}]},
       "effectiveDateTime": "2024-01-01"}
ENC = {"resourceType": "Encounter", "status": "finished", "subject": {"reference": "urn:uuid:pat-1"}}


def bundle(btype="transaction", entries=None):
    return {"resourceType": "Bundle", "type": btype,
            "entry": entries if entries is not None else [
                entry("urn:uuid:pat-1", PATIENT), entry("urn:uuid:obs-1", OBS),
                entry("urn:uuid:enc-1", ENC)]}


CASES = {
    "transaction": json.dumps(bundle()),
    "batch": json.dumps(bundle("batch")),
    "bare_patient": json.dumps(PATIENT),
    "searchset": json.dumps(bundle("searchset")),
    "no_entries": json.dumps(bundle(entries=[])),
    "malformed": '{"resourceType": "Bundle", "type": ',
    "unknown_element": json.dumps(bundle(entries=[entry("urn:uuid:pat-1", dict(PATIENT, favouriteColor="x"))])),
}


def raw(spark, docs):
    return spark.createDataFrame([(k, T, v) for k, v in docs.items()],
                                 "object_name string, object_time timestamp, body string")


def test_parse_cases(spark):
    ing = I.ingest(raw(spark, CASES))
    rej = {r.object_name: (r.reason, r.detail) for r in ing.rejected.collect()}
    assert rej == {"bare_patient": (I.REJECT_NOT_BUNDLE, "Patient"),
                   "searchset": (I.REJECT_BUNDLE_TYPE, "searchset"),
                   "no_entries": (I.REJECT_NO_ENTRIES, None),
                   "malformed": (I.REJECT_MALFORMED, None),
                   "unknown_element": (I.REJECT_UNKNOWN_ELEMENT, "Patient.favouriteColor")}
    assert sorted({r.object_name for r in ing.entries.collect()}) == ["batch", "transaction"]
    types = {r.bundle_type for r in ing.entries.collect()}
    assert types == {"transaction"}  # batch normalised


def test_rewrite_cases(spark):
    b = bundle(entries=[
        entry("urn:uuid:pat-1", PATIENT),                                   # POST + urn → PUT
        entry("Patient/keep-1", dict(PATIENT, id="keep-1"), "PUT", "Patient/keep-1"),  # existing PUT
        entry(None, dict(OBS, subject={"reference": "urn:uuid:nowhere"})),  # POST without fullUrl
        {"fullUrl": "urn:uuid:x", "request": {"method": "POST", "url": "Patient"}},  # no resource
    ])
    ing = I.ingest(raw(spark, {"b": json.dumps(b)}))
    e = {r.pos: r for r in ing.resolved.collect()}
    assert (e[0].method, e[0].url, e[0].resource_id, e[0].rewritten) == ("PUT", "Patient/pat-1", "pat-1", True)
    assert (e[1].method, e[1].url, e[1].resource_id, e[1].rewritten) == ("PUT", "Patient/keep-1", "keep-1", False)
    assert (e[2].method, e[2].rewritten, e[2].unresolved) == ("POST", False, True)
    assert e[3].rewritten is False
    st = I.rewrite_stats(ing.entries).first()
    assert (st.entries, st.rewritten, st.left_as_is) == (4, 1, 3)
    assert I.ingest_result(ing.entries).first().resource_count == 4


def test_references_and_projection(spark):
    ing = I.ingest(raw(spark, {"t": CASES["transaction"]}))
    obs = ing.versions()["Observation"].first()
    assert obs.id == "obs-1" and obs.subject.patientId == "pat-1"
    assert obs.code.coding[0].code == "4548-4" and obs.effective.dateTime == "2024-01-01"
    assert obs.meta.lastUpdated == T  # no source meta: the object time
    pat = ing.versions()["Patient"].first()
    assert (pat.id, pat.gender, pat.birthDate) == ("pat-1", "female", "1960-01-01")


def test_replay_does_not_add_resources(spark, tmp_dir):
    one = raw(spark, {"t": CASES["transaction"]})
    twice = one.unionByName(one.withColumn("object_time", F.lit(dt.datetime(2024, 1, 2))))
    c1 = {r.resource_type: r.resources for r in I.resource_counts(I.ingest(one).versions_long()).collect()}
    c2 = {r.resource_type: r.resources for r in I.resource_counts(I.ingest(twice).versions_long()).collect()}
    assert c1 == c2 == {"Patient": 1, "Observation": 1, "Encounter": 1}
    assert I.drop_identical_replays(I.ingest(twice).versions_long()).count() == 3
    append_versions(I.ingest(twice), tmp_dir)
    assert read_resources(spark, tmp_dir, "Patient").count() == 2  # two versions, one resource


def test_nothing_is_lost(spark, tmp_dir):
    """Entries = stored + without a resource, and every type, id-less create and legal sibling is kept."""
    b = bundle(entries=[
        entry("urn:uuid:pat-1", dict(PATIENT, _birthDate={"id": "x"})), entry(None, {"resourceType": "Organization"}),
        entry("urn:uuid:dup", ENC), entry("urn:uuid:dup", OBS), {"request": {"method": "DELETE", "url": "Basic/1"}},
        entry(None, {"resourceType": "Device"}, "PUT", "Device/d-1"), entry("urn:uuid:q", {"status": "untyped"}, url="x")])
    ing = I.stage(raw(spark, {"b": json.dumps(b), "bad": CASES["searchset"]}))
    assert ing.rejected.count() == 1
    batch = append_versions(ing, tmp_dir)
    rows = read_versions(spark, tmp_dir).selectExpr("*", "to_json(resource) doc").collect()
    assert ing.entries.count() == 7 == len(rows) + 1
    assert {r.resource_type for r in rows} == {"Patient", "Organization", "Encounter", "Observation", "Device", "_untyped"}
    assert all(json.loads(r.doc)["id"] == r.id for r in rows)
    ids = {r.resource_type: r.id for r in rows}
    assert ids["Device"] == "d-1" and ids["Organization"].startswith("new-")
    assert json.loads(next(r.doc for r in rows if r.resource_type == "Encounter"))["subject"]["reference"] == "Patient/pat-1"
    append_versions(ing, tmp_dir, batch)  # the same batch again
    assert read_versions(spark, tmp_dir).count() == 6
    assert {r.id for r in I.stage(raw(spark, {"b": json.dumps(b)})).versions_long().collect()} == {r.id for r in rows}


def test_subject_forms(spark):
    refs = ["urn:uuid:pat-1", "Patient/p9", "https://h/fhir/Patient/p9", "Patient/p9/_history/2", "Group/g", "urn:uuid:no"]
    b = bundle(entries=[entry("urn:uuid:pat-1", PATIENT)] + [
        entry(f"urn:uuid:o{i}", dict(OBS, subject={"reference": r})) for i, r in enumerate(refs)])
    got = {r.id: r.subject.patientId for r in I.stage(raw(spark, {"b": json.dumps(b)})).versions()["Observation"].collect()}
    assert got == {"o0": "pat-1", "o1": "p9", "o2": "p9", "o3": "p9", "o4": None, "o5": None}


def test_a_bundle_of_many_entries(spark):
    n = 20_000
    b = bundle(entries=[entry(f"urn:uuid:e{i}", {"resourceType": "Encounter", "partOf": {"reference": f"urn:uuid:e{(i + 1) % n}"},
                                                "subject": {"reference": f"urn:uuid:e{i // 2}"}}) for i in range(n)])
    ing = I.stage(raw(spark, {"b": json.dumps(b)}))
    assert ing.resolved.where("resolved_reference = concat('Encounter/e', pos div 2)").count() == n
    long = ing.versions_long().selectExpr("pos", "try_variant_get(resource, '$.partOf.reference', 'string') r")
    assert long.where(f"r = concat('Encounter/e', (pos + 1) % {n})").count() == n


def test_admitted_objects_are_read(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "in"))
    for name in ("transaction", "searchset"):
        with open(os.path.join(tmp_dir, "in", f"{name}.json"), "w") as f:
            f.write(CASES[name])
    events = spark.createDataFrame([("in/transaction.json", None), ("in/searchset.json", None), ("in/gone.json", None),
                                    ("in/x.txt", I.IGNORED_NOT_JSON)], "name string, reason string")
    docs = read_admitted(spark, events, tmp_dir)
    assert sorted(r.object_name for r in docs.collect()) == ["in/searchset.json", "in/transaction.json"]
    att = spark.createDataFrame([("in/transaction.json", 1, 503, False)],
                                "object_name string, attempt int, status_code int, connection_error boolean")
    got = {r.object_name: r.status for r in I.object_statuses(
        events.withColumnRenamed("name", "object_name"), I.ingest(docs), I.dispositions(att)).collect()}
    assert got == {"in/transaction.json": "pending", "in/searchset.json": "skipped", "in/gone.json": "skipped",
                   "in/x.txt": "skipped"}


def test_read_bundle_files(spark, tmp_dir):
    for name, body in CASES.items():
        with open(os.path.join(tmp_dir, f"{name}.json"), "w") as f:
            f.write(body)
    with open(os.path.join(tmp_dir, "notes.txt"), "w") as f:
        f.write("ignored")
    df = read_bundles(spark, tmp_dir)
    assert df.count() == len(CASES)
    assert all(r.object_name.endswith(".json") for r in df.collect())


def test_admission_cases(spark):
    ev = [("google.cloud.storage.object.v1.finalized", "b", "x.json"),
          (None, "b", "x.json"),
          ("google.cloud.storage.object.v1.deleted", "b", "x.json"),
          ("google.cloud.storage.object.v1.finalized", None, "x.json"),
          ("google.cloud.storage.object.v1.finalized", "other", "x.json"),
          ("google.cloud.storage.object.v1.finalized", "b", "x.JSON")]
    texts = spark.createDataFrame([(json.dumps({"event_type": t, "bucket": b, "name": n, "extra": 1}),)
                                   for t, b, n in ev], "value string")
    got = [r.reason for r in I.admit_events(I.parse_object_events(texts), "b").collect()]
    assert got == [None, None, I.IGNORED_TYPE, I.IGNORED_MALFORMED, I.IGNORED_BUCKET, I.IGNORED_NOT_JSON]
    got = [r.reason for r in I.admit_events(I.parse_object_events(texts), "").collect()]
    assert got[4] is None


def test_outcomes_and_dispositions(spark):
    att = spark.createDataFrame([
        ("ok", 1, 200, False), ("busy", 1, 503, False), ("slow", 1, 429, False), ("bad", 1, 400, False),
        ("down", 1, None, True), ("retry-ok", 1, 503, False), ("retry-ok", 2, 200, False)] +
        [("exhausted", i, 503, False) for i in range(1, 6)],
        "object_name string, attempt int, status_code int, connection_error boolean")
    out = {(r.object_name, r.attempt): r.outcome for r in I.classify_outcomes(att).collect()}
    assert out[("ok", 1)] == "success" and out[("busy", 1)] == "transient"
    assert out[("slow", 1)] == "transient" and out[("bad", 1)] == "permanent"
    assert out[("down", 1)] == "transient"
    d = {r.object_name: r.disposition for r in I.dispositions(att).collect()}
    assert d == {"ok": "ack", "busy": "retry", "slow": "retry", "bad": "ack", "down": "retry",
                 "retry-ok": "ack", "exhausted": "redeliver"}


def env(data=None, message=True):
    if not message:
        return json.dumps({"subscription": "s"})
    return json.dumps({"message": {"data": data, "messageId": "1"}, "subscription": "s"})


def b64(s):
    return base64.b64encode(s.encode()).decode()


def test_run_request_cases(spark):
    today = dt.date(2024, 5, 5)
    cases = [env(b64('{"runDate":"2024-01-31"}')), env(None), env(""), env(b64("")),
             env(b64('{"runDate":""}')), env(b64('{"other":1}')), env(message=False),
             env("@@@"), env(b64("not json")), env(b64('{"runDate":"2024-02-30"}')),
             env(b64("null")), env(b64("[1]")), env(b64('{"runDate":"24-1-1"}'))]
    df = spark.createDataFrame([(c,) for c in cases], "value string")
    got = [(r.outcome, r.run_date) for r in parse_run_requests(df, today).collect()]
    assert got == [("run", dt.date(2024, 1, 31))] + [("run", today)] * 6 + [("ignored", None)] * 6
    assert [r.run_date for r in run_dates_in_order(parse_run_requests(df, today)).collect()] == \
        [dt.date(2024, 1, 31), today]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_typed_reads_move_no_documents(spark):
    """References are resolved on typed columns: no join of the plan carries a VARIANT, and only urns are targets."""
    staged = I.stage(raw(spark, {"a": json.dumps(bundle())}))
    plan = _plan(staged.versions()["Observation"])
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line]
    below = plan.splitlines()[joins[0] + 1]
    assert joins and "Project" in below and "resource#" not in below.split("Project", 1)[1].split(" AS ")[0]
    targets = I.reference_targets(I.ingest(raw(spark, {"a": json.dumps(bundle(entries=[
        entry("urn:uuid:p", PATIENT), entry("Patient/x", PATIENT, "PUT", "Patient/x")]))})).entries)
    assert [r.urn for r in targets.collect()] == ["urn:uuid:p"]


def test_odd_entries_and_references(spark):
    """Entries and parts of another kind, siblings, unsorted and unknown names, escapes and repeated references."""
    twice = {"resourceType": "Group", "id": "g", "member": [{"entity": {"reference": "urn:uuid:p"}}] * 2,
             "managingEntity": {"reference": "urn:uuid:p"}}
    odd = [5, None, "x", {"resource": 7, "request": 3}, {"fullUrl": 1, "resource": {"resourceType": 2, "zz": 1}},
           entry("urn:uuid:p", {"_gender": {"id": "1"}, "gender": "male", "resourceType": "Patient", "active": [[True]]}),
           entry("Group/g", twice, "PUT", "Group/g")]
    escaped = json.dumps(bundle(entries=[entry("urn:uuid:p", PATIENT), entry(None, OBS)])).replace(
        "urn:uuid:pat-1", "urn\\u003auuid:p")
    ing = I.stage(raw(spark, {"odd": json.dumps(bundle(entries=odd)), "escaped": escaped,
                              "bad": json.dumps(bundle(entries=[entry(None, dict(PATIENT, _note={}))]))}))
    assert [(r.object_name, r.detail) for r in ing.rejected.collect()] == [("bad", "Patient._note")]
    rows = {(r.object_name, r.pos): r for r in ing.entries.drop("resource").collect()}
    assert [rows["odd", i].has_request for i in range(7)] == [False] * 5 + [True, True]
    assert [rows["odd", i].resource_type for i in range(7)] == [None] * 4 + ["2", "Patient", "Group"]
    assert rows["odd", 4].full_url == "1" and rows["odd", 6].urns == ["urn:uuid:p"] * 3
    assert rows["escaped", 1].urns == ["urn:uuid:p"]
    refs = sorted((r.object_name, r.pos, r.target) for r in I.reference_rows(ing.entries).collect())
    assert refs == [("escaped", 1, "Patient/p"), ("odd", 6, "Patient/p")]
    docs = {r.object_name: json.loads(r.d) for r in I.resolve_documents(ing.entries).where(
        "pos = 6 or (pos = 1 and object_name = 'escaped')").select("object_name", F.to_json("resource").alias("d")).collect()}
    assert [m["entity"]["reference"] for m in docs["odd"]["member"]] == ["Patient/p"] * 2
    assert docs["odd"]["managingEntity"]["reference"] == docs["escaped"]["subject"]["reference"] == "Patient/p"


def test_a_delivery_to_the_version_log_is_computed_once(spark, tmp_path):
    from gapwise.operators.replays import VersionLog
    read = spark.sparkContext.accumulator(0)

    def counted(docs):
        def count(batches):
            for b in batches:
                read.add(b.num_rows)
                yield b
        return docs.mapInArrow(count, docs.schema)

    docs = raw(spark, {"a": json.dumps(bundle()), "b": json.dumps(bundle())})
    versions = I.ingest(counted(docs)).versions_long()
    versions.write.format("noop").mode("overwrite").save()
    once, log = read.value, VersionLog(spark, str(tmp_path))
    for batch in ("first", "second"):
        before = read.value
        log.append(versions, batch)
        assert 0 < read.value - before <= once
    assert log.read().count() == 6


def test_report_moves_no_documents(spark, tmp_path):
    from gapwise.plans.ingest_queries import ingest_report
    spark.sql("""select id as o_orderkey, id % 7 as o_custkey, timestamp_ntz'2000-01-02' as o_orderdate,
        'F' as o_orderstatus, 1.5D as o_totalprice from range(120)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("""select id as l_orderkey, 1 as l_linenumber, id % 40 as l_partkey, id % 3 as l_suppkey,
        timestamp_ntz'2000-03-04' as l_shipdate from range(120)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    report = ingest_report(spark, str(tmp_path))
    lines = _plan(report).splitlines()
    joins = [i for i, line in enumerate(lines) if "Join " in line and "object_name#" in line]
    assert joins and not any(c in lines[i + 1] for i in joins for c in ("body", "resource#", "entry#"))
    got = {r.status: r.objects for r in report.collect()}
    assert sum(got.values()) == 240 and set(got) <= {"skipped", "ingested", "pending", "failed"}


def test_documents_of_short_bundles_are_resolved_in_their_row(spark):
    """Without a join or a shuffle; bundles that are long or share name and time with another as by the join."""
    short = raw(spark, {"a": json.dumps(bundle()), "b": CASES["searchset"], "c": json.dumps(bundle(entries=[
        entry("urn:uuid:x", ENC), entry("urn:uuid:x", OBS), entry(None, dict(OBS, id="o", encounter={"reference": "urn:uuid:x"})),
        {"fullUrl": "urn:uuid:y", "request": {"method": "POST", "url": "Patient"}},
        entry(None, {"resourceType": "Device", "patient": {"reference": "urn:uuid:y"}}, "PUT", "Device/d-1")]))})
    long = bundle(entries=[entry(f"urn:uuid:{k}", dict(ENC, partOf={"reference": f"urn:uuid:{k + 1}"}))
                           for k in range(I.ROW_LOOKUP + 1)])
    none = spark.createDataFrame([(None, T, json.dumps(bundle()))], short.schema)
    mixed = short.unionByName(none).unionByName(raw(spark, {"long": json.dumps(long)})).unionByName(
        raw(spark, {"a": json.dumps(bundle(entries=[entry("urn:uuid:later", PATIENT), entry(None, OBS)]))}))

    def rows(versions):
        return sorted(tuple(r) for r in versions.select(
            F.coalesce("object_name", F.lit("")), "pos", "resource_type", "id", "meta", F.to_json("resource")).collect())

    for docs in (short, mixed):
        got = rows(I.stage(docs).versions_long())
        assert got == rows(I.ingest(docs).versions_long()) and '"Encounter/x"' in str(got)
    plan = _plan(I.stage(short).versions_long())
    assert "Join" not in plan and "Aggregate" not in plan
    assert "Join" in _plan(I.stage(mixed).versions_long())


def test_counts_resolve_no_documents(spark):
    plan = _plan(I.resource_counts(I.stage(raw(spark, {"a": json.dumps(bundle())})).versions_long()))
    assert "Join" not in plan and "StructsToJson" not in plan


def test_staging_writes_no_document_as_text(spark):
    assert "StructsToJson" not in _plan(I.ingest(raw(spark, {"a": json.dumps(bundle())})).rows)


def test_an_event_is_parsed_once(spark):
    events = I.parse_object_events(spark.range(9).selectExpr("concat('{\"bucket\":\"b', id, '\",\"name\":\"x.json\"}') value"))
    wanted = I.admit_events(events, "b1").where("reason IS NULL")
    plan = _plan(wanted.select("name").distinct())
    assert plan.count("from_json") == 1 and wanted.count() == 1
