import random
from collections import Counter

from pyspark.sql import functions as F

from slotwise.operators import outputs as out
from slotwise.operators.frequent import candidates, frequent_values, value_states
from slotwise.operators.normalise import normalise_readings
from slotwise.operators.quarantine import checks, quarantine, tag, write_quarantine
from slotwise.sources import fixtures
from tests.conftest import SF_SMALL
from tests.test_plans import plan_text


def test_good_and_malformed_are_all_rows(spark, tmp_dir):
    src = fixtures.readings_src(spark, SF_SMALL, malformed=True)
    q = quarantine(src)
    write_quarantine(q.bad, tmp_dir, "r1")
    n, counts = src.count(), q.counts                                   # counted by the write itself
    assert counts["rows"] == n and counts["malformed"] == counts["malformed value"] > 0 == counts["malformed day"]
    assert spark.read.json(f"{tmp_dir}/run=r1").count() == counts["malformed"]
    assert q.good.count() + counts["malformed"] == n and q.good.columns == src.columns
    normalise_readings(q.good, *fixtures.WINDOW, 15, typed=True).collect()


def test_every_reason_and_nulls(spark):
    cols = {c: c for c in ("rdng_meas", "periodcount", "interval_measure", "pcfc_day_per_dt", "pcfc_qtr_hr_per_strt_dttm", "pcfc_hr_per_strt_dttm")}
    good = ("1.5", "23", "15", "2024-01-19", "2024-01-19 10:15:00", "2024-01-19 10:00:00")
    bad = ("1,5", "x", "15.5.1", "2024-13-01", "half past", "25:61")
    rows = [good, bad, tuple([None] * 6), (good[0], *bad[1:3], *good[3:])]
    src = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    got = [sorted(x["reason"] for x in r.malformed) for r in tag(src).collect()]
    assert got == [[], sorted(checks()), [], ["interval", "period count"]]
    assert tag(src).collect()[1].malformed[0]["raw"] == "1,5"


def test_frequent_values_with_a_full_summary(spark):
    rng = random.Random(5)
    rows = [rng.choice(["a", "b", "c"]) if rng.random() < 0.5 else f"v{rng.randint(0, 10**6)}" for _ in range(20_000)] + [None] * 500
    df = spark.createDataFrame([(v, i % 5) for i, v in enumerate(rows)], "v string, day int").repartition(4)
    want = [(v, n) for v, n in sorted(Counter(x for x in rows if x).items(), key=lambda x: (-x[1], x[0]))]
    got = frequent_values(df, "v", 3, tracked=64).collect()
    assert [(r.value, r.cnt) for r in got] == want[:3] and all(r.certain for r in got) and [r["rank"] for r in got] == [1, 2, 3]
    states = value_states(df, "v", by="day", tracked=64)
    assert states.count() == 5 and candidates(states, 64).count() <= 64
    assert [tuple(r) for r in frequent_values(df, "v", 3, tracked=64, states=states).collect()] == [tuple(r) for r in got]
    low = frequent_values(df, "v", 40, tracked=8).collect()
    assert low and not any(r.certain for r in low)                      # below the bound a value outside could have as many
    assert all((r.value, r.cnt) in dict(want).items() for r in low)     # counts are exact all the same


def test_frequent_values_of_few_and_none(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "v string")
    assert [tuple(r) for r in frequent_values(df, "v").collect()] == [("x", 2, 1, True), ("y", 1, 2, True)]
    assert frequent_values(df.where("v IS NULL"), "v").collect() == []
    assert frequent_values(df.limit(0), "v").collect() == []


def test_grains_agree_with_the_outputs_from_one_scan(spark):
    from slotwise.plans.catalog import _enriched
    e = _enriched(spark, SF_SMALL)
    partials = out.hour_partials(e).persist()
    for grain, want in (("hour", out.hourly_sum(e, as_string=False)), ("day", out.daily_sum(e, as_string=False))):
        got = out.sums_from(partials, grain, as_string=False).select(*want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert "FileScan" not in plan_text(got).split("InMemoryRelation")[0]
    text = out.hour_partials(e.withColumn("rm", F.col("rm").cast("string")))
    assert sorted(map(repr, out.sums_from(text, "day", False).collect())) == sorted(map(repr, out.daily_sum(e, as_string=False).select(
        *out.sums_from(text, "day", False).columns).collect()))
    partials.unpersist()
