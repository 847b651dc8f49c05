"""Issue documents and transaction chunks."""
import datetime as dt
import json

import pytest

from gapwise.operators import issues
from gapwise.sources.measure_dim import measure_dim

EV = "measure_id string, patient_id string, in_numerator boolean, last_evidence_date date"


def test_open_and_closed_documents(spark):
    e = spark.createDataFrame([("CDC_A1C", "p1", False, None),
                               ("CDC_A1C", "p2", True, dt.date(2024, 3, 1)),
                               ("CDC_A1C", "p3", True, None)], EV)
    docs = {r.patient_id: json.loads(r.j) for r in issues.issue_document(
        issues.issue_rows(e, measure_dim(spark), "2024-06-01")).selectExpr("patient_id", "to_json(document) j").collect()}
    o, c, c2 = docs["p1"], docs["p2"], docs["p3"]
    assert o["id"] == "caregap-cdc-a1c-p1" and o["status"] == "final"
    assert o["patient"]["reference"] == "Patient/p1" and o["identifiedDateTime"] == "2024-06-01"
    assert o["code"]["coding"][0]["code"] == "CDC_A1C" and o["code"]["text"] == "Diabetes: HbA1c testing"
    assert "mitigation" not in o and o["detail"].startswith("Open care gap")
    assert c["mitigation"][0]["date"] == "2024-03-01T00:00:00Z"
    assert c["mitigation"][0]["action"]["text"] == "Qualifying service performed"
    assert "date" not in c2["mitigation"][0]


def test_chunks_of_200(spark):
    e = spark.createDataFrame([("BCS_MAMMOGRAPHY", f"p{i:04d}", i % 2 == 0, None) for i in range(450)], EV)
    b = issues.chunk_issues(issues.issue_document(issues.issue_rows(e, measure_dim(spark), "2024-01-01")))
    rows = sorted((r.chunk, r.entries, json.loads(r.bundle)) for r in b.collect())
    assert [(c, n) for c, n, _ in rows] == [(0, 200), (1, 200), (2, 50)]
    first = rows[0][2]
    assert first["type"] == "transaction"
    assert first["entry"][0]["request"] == {"method": "PUT", "url": "DetectedIssue/caregap-bcs-mammography-p0000"}
    assert rows[1][2]["entry"][0]["resource"]["id"] == "caregap-bcs-mammography-p0200"


def test_bad_ids_fail_or_quarantine(spark):
    e = spark.createDataFrame([("CDC_A1C", "p 1", False, None), ("CDC_A1C", "x" * 60, False, None),
                               ("CDC_A1C", "ok", False, None)], EV)
    assert issues.invalid_issue_ids(e).count() == 2
    with pytest.raises(Exception):
        issues.issue_rows(e, measure_dim(spark), "2024-01-01").collect()


def test_issue_sink_puts_and_never_removes(spark, tmp_dir):
    dim = measure_dim(spark)

    def put(seq, rows, day):
        e = spark.createDataFrame(rows, EV)
        issues.write_issues(issues.issue_document(issues.issue_rows(e, dim, day)), tmp_dir, seq)

    put(1, [("CDC_A1C", "p1", False, None), ("COL_SCREENING", "p1", False, None)], "2024-01-01")
    put(2, [("CDC_A1C", "p2", False, None), ("CDC_A1C", "p1", True, None)], "2024-01-02")
    put(2, [("CDC_A1C", "p2", False, None), ("CDC_A1C", "p1", True, None)], "2024-01-02")  # repeated write
    got = {r.id: json.loads(r.json)["identifiedDateTime"] for r in issues.read_issues(spark, tmp_dir).collect()}
    assert got == {"caregap-cdc-a1c-p1": "2024-01-02", "caregap-cdc-a1c-p2": "2024-01-02",
                   "caregap-col-screening-p1": "2024-01-01"}
