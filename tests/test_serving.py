"""Serving reads."""
import datetime as dt

import pytest

from gapwise.operators import gaps, serving
from gapwise.sources.measure_dim import measure_dim

T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 1, 2)


@pytest.fixture(scope="module")
def state(spark):
    rows = []
    i = 0
    for m, n_open, n_closed in (("BCS_MAMMOGRAPHY", 4, 6), ("CDC_A1C", 3, 0), ("OTHER", 0, 2)):
        for k in range(n_open + n_closed):
            i += 1
            rows.append((i, m, f"p{k}", "OPEN" if k < n_open else "CLOSED", None, T1,
                         T2 if i % 2 else T1))
    return spark.createDataFrame(rows, "id long, measure_id string, patient_id string, status string, "
                                 "last_evidence_date date, first_identified_at timestamp, "
                                 "last_evaluated_at timestamp")


def test_scorecard_closure_rate(spark, state):
    cards = {r.measure_id: r for r in serving.scorecard(serving.gap_summary(state), measure_dim(spark)).collect()}
    b = cards["BCS_MAMMOGRAPHY"]
    assert (b.open, b.closed, b.total, b.closure_rate) == (4, 6, 10, 60.0)
    assert b.name == "Breast cancer screening"
    assert cards["OTHER"].name == "OTHER"  # display-name fallback
    assert cards["CDC_A1C"].closure_rate == 0.0


def test_summary_omits_empty_combinations(state):
    rows = [(r.measure_id, r.status, r.gaps) for r in serving.gap_summary(state).collect()]
    assert rows == [("BCS_MAMMOGRAPHY", "CLOSED", 6), ("BCS_MAMMOGRAPHY", "OPEN", 4),
                    ("CDC_A1C", "OPEN", 3), ("OTHER", "CLOSED", 2)]


def test_search_filters_sort_and_pages(state):
    all_sorted = [(r.last_evaluated_at, r.id) for r in serving.sort_gaps(state).collect()]
    assert all_sorted == sorted(all_sorted, reverse=True)
    p1 = [r.id for r in serving.page(state, 1, 4).collect()]
    assert p1 == [i for _, i in all_sorted[4:8]]
    assert serving.search_gaps(state, status="OPEN", measure_id="CDC_A1C").count() == 3
    assert serving.search_gaps(state, patient_id="p0").count() == 3
    info = serving.page_info(state, 4).first()
    assert (info.total_elements, info.total_pages) == (15, 4)
    after = all_sorted[3]
    ks = [r.id for r in serving.page_after(state, after, 4).collect()]
    assert ks == [i for _, i in all_sorted[4:8]]
    assert [r.measure_id for r in serving.patient_gaps(state, "p9").collect()] == ["BCS_MAMMOGRAPHY"]


def test_argument_validation(state):
    for kwargs in ({"status": "closed"}, {"page": -1}, {"size": 0}, {"size": 201}):
        with pytest.raises(ValueError):
            serving.validate_search(**kwargs)
    with pytest.raises(ValueError):
        serving.search_gaps(state, status="BOGUS")


def test_measures_runs_freshness(spark):
    assert [r.id for r in serving.list_measures(measure_dim(spark)).collect()] == \
        ["BCS_MAMMOGRAPHY", "CDC_A1C", "COL_SCREENING"]
    runs_df = spark.createDataFrame(
        [(f"r{i}", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 0, i), None,
          "SUCCEEDED" if i % 3 else "FAILED", None if i % 3 else "boom", 1, 2) for i in range(30)],
        "id string, run_date date, started_at timestamp, completed_at timestamp, status string, "
        "error string, gaps_open int, gaps_closed int")
    recent = [r.id for r in serving.recent_runs(runs_df).collect()]
    assert recent == [f"r{i}" for i in range(29, 9, -1)]
    fr = {r.id: r.detail for r in serving.run_freshness(runs_df).collect()}
    assert fr["r1"] == "1 open / 2 closed" and fr["r0"] == "boom"


def test_small_dimension_needs_no_shuffle_of_the_facts(spark, monkeypatch):
    from gapwise.operators import serving
    facts = spark.range(1000).selectExpr("concat('m', id % 3) as measure_id", "id")
    dim = spark.createDataFrame([("m0", "Zero"), ("m1", "One")], "id string, display_name string")

    def joined():
        return serving.with_display_name(facts, dim)

    plan = joined()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    want = sorted((r.measure_id, r.id, r.name) for r in joined().collect())
    monkeypatch.setattr(serving, "MAX_BROADCAST_ROWS", 1)
    plan = joined()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(measure_id" in plan
    assert sorted((r.measure_id, r.id, r.name) for r in joined().collect()) == want
    assert {r[2] for r in want if r[0] == "m2"} == {"m2"}
