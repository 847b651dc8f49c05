"""File-stream ingest and run-request streams."""
import base64
import json
import os
import uuid

from gapwise.operators import ingest as I
from gapwise.plans.measures import MeasureTables, evaluate_all
from gapwise.sources.bundles import append_versions, read_bundles, read_resources
from gapwise.streaming.streams import read_quarantine, run_requests_stream, stream_bundles
from test_ingest import CASES


def test_bundle_stream_matches_batch_and_is_replay_safe(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    os.makedirs(src)
    for name, body in CASES.items():
        with open(os.path.join(src, f"{name}.json"), "w") as f:
            f.write(body)
    root, ck = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "ck")
    q = stream_bundles(spark, src, root, ck)
    q.awaitTermination(120)
    streamed = read_resources(spark, root, "Patient")
    batch = I.ingest(read_bundles(spark, src)).versions()["Patient"]
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert read_quarantine(spark, root).count() == 5
    # batch appends and streamed batches share one layout
    append_versions(I.ingest(read_bundles(spark, src)), root)
    assert read_resources(spark, root, "Patient").count() == 2 * batch.count()
    # restart: nothing new, nothing reprocessed
    q2 = stream_bundles(spark, src, root, ck)
    q2.awaitTermination(120)
    assert read_resources(spark, root, "Patient").count() == 2 * batch.count()


def test_run_request_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "requests")
    os.makedirs(src)
    lines = [json.dumps({"message": {"data": base64.b64encode(json.dumps({"runDate": d}).encode()).decode()}})
             for d in ("2024-01-02", "2024-01-01", "2024-01-02")] + ["{bad"]
    with open(os.path.join(src, "r.json"), "w") as f:
        f.write("\n".join(lines))
    seen = []
    q = run_requests_stream(spark, src, os.path.join(tmp_dir, "ck"), seen.append)
    q.awaitTermination(120)
    # one run for each delivery, in arrival order
    assert [d.isoformat() for d in seen] == ["2024-01-02", "2024-01-01", "2024-01-02"]
