"""Jobs and frame helpers: processing-time stream trigger (T1, T4), reuse by
persist / checkpoint (U1), profile job with report (K3), rows per partition (U2)."""

import os
import time

import pytest

from pyspark.sql import functions as F

from slotwise.operators.frames import partition_rows, reused, spread
from slotwise.plans.profile_job import profile_table, read_profile_report
from slotwise.sources.streams import file_stream
from slotwise.streaming.words import start_word_counts


def test_processing_time_trigger(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("x y x\n")
    out = os.path.join(tmp_dir, "out")
    q = start_word_counts(file_stream(spark, src), out, os.path.join(tmp_dir, "ckpt"), trigger="1 second")
    try:
        q.processAllAvailable()
        deadline = time.time() + 30
        while time.time() < deadline and not os.path.isdir(os.path.join(out, "totals")):
            time.sleep(0.2)
    finally:
        q.stop()
    counts = {r.word: r.cnt for r in spark.read.parquet(os.path.join(out, "counts")).collect()}
    assert counts == {"x": 2, "y": 1}
    assert [r.total for r in spark.read.parquet(os.path.join(out, "totals")).collect()] == [3]


def test_reuse_modes(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"))
    for how in ("persist", "checkpoint", "none"):
        with reused(df, how) as d:
            assert d.count() == 100 and d.groupBy("k").count().count() == 7
    assert not df.is_cached


def test_profile_job_report(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), ("", 2), (None, 2)], "s string, n int")
    path = os.path.join(tmp_dir, "report")
    prof = profile_table(spark, "db", "t", df=df, report_path=path)
    assert prof.count() == 2
    lines = sorted(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.startswith("part-"))
    assert "".join(lines).splitlines() == ["db|t|s|TRUE|TRUE|TRUE|4|0", "db|t|n|FALSE|FALSE|FALSE|1|1"]
    back = {r.column_name: tuple(r) for r in read_profile_report(spark, path).collect()}
    assert back["n"] == ("db", "t", "n", "FALSE", "FALSE", "FALSE", 1, 1)


def test_partition_rows_and_spread(spark):
    df = spark.range(1000).coalesce(1)
    assert [tuple(r) for r in partition_rows(df).collect()] == [(0, 1000)]
    wide = spread(df, 4)
    assert wide.rdd.getNumPartitions() == 4 and wide.count() == 1000
    assert spread(spark.range(1000).repartition(8), 4).rdd.getNumPartitions() == 8


def test_interval_job_default_text_mode(spark, tmp_dir):
    """The job with its defaults, which are the reference's (text values,
    observed slots, output under dt=<start>): all seven record types are written."""
    from slotwise.plans.interval_job import IntervalParams, fixture_inputs, run
    from tests.conftest import SF_SMALL
    out = os.path.join(tmp_dir, "records")
    written = run(fixture_inputs(spark, SF_SMALL),
                  IntervalParams(start="2024-01-19", end="2024-01-19", excluded_plan="MACHINERY"),
                  out)
    assert written == ["rdng_meas", "hrly_sum", "daily_sum", "daily_max", "peak_ind", "outage_ind", "status"]
    for t in written:
        assert os.listdir(os.path.join(out, f"rec_type={t}")) == ["dt=2024-01-19"]
        assert os.listdir(os.path.join(out, f"rec_type={t}", "dt=2024-01-19")) == ["im=15"]
    daily = spark.read.json(os.path.join(out, "rec_type=daily_sum"))
    assert daily.count() > 0 and dict(daily.dtypes)["ds"] == "string"


def test_stream_timeout_stops_and_raises(spark, tmp_dir):
    import pytest
    from slotwise.plans.stream_job import run_files
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for i in range(40):
        with open(os.path.join(src, f"{i}.txt"), "w") as f:
            f.write("x y\n")
    with pytest.raises(TimeoutError):
        run_files(spark, src, max_files_per_trigger=1, out=os.path.join(tmp_dir, "out"), timeout=2)
    assert not spark.streams.active


def test_tables_are_read_anew(spark, tmp_dir):
    from slotwise.sources.tables import read_table
    spark.range(3).write.parquet(os.path.join(tmp_dir, "t.parquet"))
    assert read_table(spark, "t", tmp_dir).count() == 3
    spark.range(5).write.mode("append").parquet(os.path.join(tmp_dir, "t.parquet"))
    assert read_table(spark, "t", tmp_dir).count() == 8


def test_table_list(spark):
    from slotwise.sources.tables import TABLES, list_tables, register_tables
    from tests.conftest import SF_SMALL
    register_tables(spark, SF_SMALL)
    assert set(TABLES) <= {r.tableName for r in list_tables(spark).collect()}


def test_rerun_without_rows_and_kept_fields(spark, tmp_dir):
    import json
    from slotwise.sinks.files import write_records
    df = spark.createDataFrame([("b", 2), ("a", 1)], "sa string, n int").coalesce(1)
    path = os.path.join(tmp_dir, "r")
    at = os.path.join(path, "rec_type=t", "dt=2024-01-01", "im=15")

    def lines():
        return [json.loads(x) for f in sorted(os.listdir(at)) if f.startswith("part-") for x in open(os.path.join(at, f))]

    write_records(df, path, "t", "2024-01-01", 15, sort_by=["sa"])
    assert lines() == [{"sa": "a", "n": 1}, {"sa": "b", "n": 2}]
    write_records(df, path, "t", "2024-01-01", 15, keep_fields=True)
    assert lines()[0] == {"sa": "b", "n": 2, "rec_type": "t", "im": "15"}
    write_records(df, path, "t", "2024-01-02", 15)
    write_records(df.limit(0), path, "t", "2024-01-01", 15)
    assert lines() == [] and spark.read.json(path).count() == 2


def test_reused_checkpoint_files_go(spark):
    from slotwise.session import shared_dir
    root = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    with reused(spark.range(10), "checkpoint") as d:
        assert d.count() == 10
    assert not [x for x in set(os.listdir(root)) - before if x.startswith("reused")]


@pytest.mark.parametrize("reuse", ["persist", "checkpoint", "none"])
def test_slots_are_found_by_the_pass_that_fills_the_cache(spark, reuse):
    from slotwise.operators.outputs import SlotsSeen, observed_values
    from slotwise.operators.frames import reused
    from slotwise.plans.catalog import _offgrid_inputs, _params
    from tests.conftest import SF_SMALL
    from slotwise.plans.interval_job import enriched_readings
    e = enriched_readings(_offgrid_inputs(spark, SF_SMALL), _params(start="2024-01-19", end="2024-01-19"))
    want = observed_values(e, "qtr_intr"), observed_values(e, "hr_intr", 24)
    seen = SlotsSeen(e)
    tracker = spark.sparkContext.statusTracker()
    with reused(seen.frame, reuse) as base:
        base.write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobGroup("slots", "none expected")
        try:
            assert seen.found() == want and len(want[0]) > 10
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert list(tracker.getJobIdsForGroup("slots")) == []


def test_odd_slots_are_left_to_the_discovery_job(spark):
    from slotwise.operators.outputs import SlotsSeen
    df = spark.createDataFrame([("0015", "00"), (None, None), ("9999", "23")], "qtr_intr string, hr_intr string")
    seen = SlotsSeen(df)
    seen.frame.collect()
    assert seen.found() is None
    seen = SlotsSeen(df.where("hr_intr IS NULL OR hr_intr <> '23'"))
    seen.frame.collect()
    assert seen.found() == (["0015"], ["00"])
    seen = SlotsSeen(df.limit(0))
    seen.frame.collect()
    assert seen.found() == ([], [])
