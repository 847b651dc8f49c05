"""Gap state kept in buckets of its key."""
import datetime as dt
import re

from pyspark.sql import functions as F

from gapwise.operators import gaps
from gapwise.sources.store import Buckets, TableStore

AT = [dt.datetime(2001, m, 1) for m in (1, 2, 3)]


def evaluations(spark, first, last, in_numerator):
    return spark.range(first, last).select(
        F.concat(F.lit("M"), (F.col("id") % 3).cast("string")).alias("measure_id"),
        F.concat(F.lit("p-"), F.col("id").cast("string")).alias("patient_id"),
        F.expr(in_numerator).alias("in_numerator"), F.lit(None).cast("date").alias("last_evidence_date"))


def upsert(store, evals, now, buckets):
    state = store.read("care_gap", gaps.CARE_GAP_SCHEMA)
    new = gaps.upsert_gaps(state, evals, now, max_id=store.stats("care_gap").get("max_id"),
                           buckets=buckets and buckets.n)
    store.commit("care_gap", new, stats=gaps.state_stats(), buckets=buckets)


def test_bucketed_state_equals_the_plain_one(spark, tmp_dir):
    runs = [evaluations(spark, 0, 300, "id % 2 = 0"), evaluations(spark, 100, 500, "id % 5 = 0"),
            evaluations(spark, 0, 0, "true")]
    plain, dealt = TableStore(spark, f"{tmp_dir}/plain"), TableStore(spark, f"{tmp_dir}/dealt")
    for evals, at in zip(runs, AT):
        upsert(plain, evals, at, None)
        upsert(dealt, evals, at, gaps.state_buckets(spark, dealt.current("care_gap")))
    a, b = (s.read("care_gap", gaps.CARE_GAP_SCHEMA) for s in (plain, dealt))
    assert a.count() == 500 and b.exceptAll(a).count() == 0 and a.exceptAll(b).count() == 0
    assert dealt.stats("care_gap") == plain.stats("care_gap") == {"max_id": 500}


def test_the_join_reads_the_state_without_an_exchange(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/s")
    buckets = gaps.state_buckets(spark)
    upsert(store, evaluations(spark, 0, 300, "true"), AT[0], buckets)
    upsert(store, evaluations(spark, 200, 400, "false"), AT[1], buckets)
    # a bucket is one file of kept rows and one of new ones at most
    files = spark.read.parquet(store.current("care_gap").path).select(F.input_file_name()).distinct().count()
    assert files <= 2 * buckets.n
    # another store object, as in another session, finds the buckets in the manifest
    state = TableStore(spark, store.root).read("care_gap", gaps.CARE_GAP_SCHEMA)
    keys = evaluations(spark, 0, 10, "true").groupBy(*gaps.KEY).count()
    plan = state.join(keys, gaps.KEY, "full_outer")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in lines[join:scan]), plan
    assert re.search(r"SelectedBucketsCount: (\d+) out of \1", plan)


def test_buckets_of_the_state(spark, tmp_dir):
    store = TableStore(spark, f"{tmp_dir}/s")
    few = Buckets(1, tuple(gaps.KEY), ("patient_id",))
    upsert(store, evaluations(spark, 0, 20, "true"), AT[0], few)
    assert store.current("care_gap").buckets == few
    # one bucket is fewer than the session's partitions, so the next commit deals anew
    again = gaps.state_buckets(spark, store.current("care_gap"))
    assert again.n == int(spark.conf.get("spark.sql.shuffle.partitions"))
    upsert(store, evaluations(spark, 10, 30, "true"), AT[1], again)
    assert store.read("care_gap", gaps.CARE_GAP_SCHEMA).count() == 30
    tables = {t.name for t in spark.catalog.listTables()}
    assert store.vacuum("care_gap", keep=1) == 1
    gone = tables - {t.name for t in spark.catalog.listTables()}
    assert len(gone) == 1 and store.read("care_gap", gaps.CARE_GAP_SCHEMA).count() == 30
