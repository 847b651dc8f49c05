"""Deep pages by selection, counts kept by deltas, and batches checked before their commit."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gapwise.operators import checks, gaps, serving
from gapwise.sources.store import TableStore

AT = dt.datetime(2000, 1, 1)


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(3)
    rows = [(i * 3 + 1, "M", f"p{i}", "OPEN", None, AT, AT + dt.timedelta(microseconds=rng.choice([0, 1, 5, 10**12])))
            for i in range(12_000)]
    return spark.createDataFrame(rows, gaps.CARE_GAP_SCHEMA).cache()


@pytest.mark.parametrize("page", [0, 3, 99, 200, 239, 240, 500])
def test_a_deep_page_is_the_page(many, page):
    want = sorted(((r.last_evaluated_at, r.id) for r in many.collect()), reverse=True)[page * 50:page * 50 + 50]
    for select_rows in (1, 700, 20_000):
        got = serving.deep_page(many, page, 50, select_rows).collect()
        assert [(r.last_evaluated_at, r.id) for r in got] == want
    assert [r.id for r in serving.page(many, page, 50).collect()] == [i for _, i in want]


def test_selection_sorts_one_small_range(many):
    plan = serving.deep_page(many, 220, 50, 100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=50" in plan and "rangepartitioning" not in plan
    assert serving.key_at(many.limit(0), 0) is None


EVALS = "measure_id STRING, patient_id STRING, in_numerator BOOLEAN, last_evidence_date DATE"


def test_counts_kept_by_deltas_equal_counts(spark, tmp_dir):
    rng = random.Random(5)
    state = gaps.empty_state(spark)
    counts = spark.createDataFrame([], gaps.SUMMARY_SCHEMA)
    for k in range(4):
        rows = [(m, f"p{i}", rng.random() < (0.0 if k == 3 else 0.5), None)
                for m in ("A", "B") for i in range(40) if rng.random() < 0.6 or k == 3]
        new, deltas = gaps.upsert_with_deltas(state, spark.createDataFrame(rows, EVALS), AT + dt.timedelta(days=k))
        counts = gaps.apply_deltas(counts, deltas).checkpoint()
        state = new.checkpoint()
        assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, serving.gap_summary(state).collect()))
    assert {r.status for r in counts.collect()} == {"OPEN"}  # a status without gaps is absent


def test_deltas_do_not_read_the_state(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    store.commit("care_gap", gaps.upsert_gaps(gaps.empty_state(spark), spark.createDataFrame([("A", "p", True, None)], EVALS), AT))
    _, deltas = gaps.upsert_with_deltas(store.read("care_gap", gaps.CARE_GAP_SCHEMA),
                                        spark.createDataFrame([("A", "p", False, None)], EVALS), AT)
    assert deltas.inputFiles() == []
    assert sorted(map(tuple, deltas.collect())) == [("A", "CLOSED", -1), ("A", "OPEN", 1)]


def _gap(i, p, status="OPEN", m="A"):
    return (i, m, p, status, None, AT, AT)


def _frame(spark, rows):
    loose = "id BIGINT, measure_id STRING, patient_id STRING, status STRING, last_evidence_date DATE, " \
            "first_identified_at TIMESTAMP, last_evaluated_at TIMESTAMP"
    return spark.createDataFrame(rows, loose)


def test_a_bad_batch_is_named_and_not_taken(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    dim = spark.createDataFrame([("A", "a"), ("B", "b")], "id STRING, display_name STRING")

    def commit(rows):
        return checks.commit_checked(store, "care_gap", _frame(spark, rows), dim, gaps.CARE_GAP_SCHEMA)

    assert commit([_gap(1, "p"), _gap(2, "q")]) == 1
    assert commit([_gap(1, "p", "CLOSED"), _gap(3, "r")]) == 2
    bad = {"care_gap.fk_measure": [_gap(9, "s", m="X")], "care_gap.status_domain": [_gap(9, "s", "HALF")],
           "care_gap.not_null.patient_id": [_gap(9, None)], "care_gap.not_null.id": [_gap(None, "s")],
           "care_gap.unique_id": [_gap(2, "s")], "care_gap.unique_measure_patient": [_gap(8, "q")]}
    for name, rows in bad.items():
        with pytest.raises(checks.ConstraintViolation) as e:
            commit([_gap(4, "t"), *rows])
        assert [list(r.broken) for r in e.value.rejects.collect()] == [[name]], name
    with pytest.raises(checks.ConstraintViolation) as e:
        commit([_gap(5, "u"), _gap(6, "u"), _gap(7, "v"), _gap(7, "w")])
    assert sorted((r.patient_id, *r.broken) for r in e.value.rejects.collect()) == [
        ("u", "care_gap.unique_measure_patient"), ("u", "care_gap.unique_measure_patient"),
        ("v", "care_gap.unique_id"), ("w", "care_gap.unique_id")]
    assert store.current_version("care_gap") == 2
    assert sorted((r.id, r.patient_id, r.status) for r in store.read("care_gap", gaps.CARE_GAP_SCHEMA).collect()) == [
        (1, "p", "CLOSED"), (2, "q", "OPEN"), (3, "r", "OPEN")]
