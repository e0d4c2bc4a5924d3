"""Hot keys: one account holding most readings is split over several join
tasks, by AQE at runtime or by the salted join; results are unchanged."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slotwise.operators.enrich import enrich
from slotwise.operators.joins import salted_join
from slotwise.operators.outputs import daily_sum
from slotwise.operators.normalise import READING_FIELDS

D = dt.date
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def readings(spark, n_hot=20000, n_cold=40):
    base = spark.range(n_hot + n_cold).select(
        F.when(F.col("id") < n_hot, F.lit("1")).otherwise((F.col("id") % 20 + 2).cast("string")).alias("sa"),
        (F.col("id") % 97).cast("string").alias("sp"),
        F.lit("complete").alias("rsc"), F.lit("15").alias("im"),
        (F.col("id") % 13).cast("decimal(18,4)").alias("rm"), F.lit("1101").alias("chnl"),
        F.lit("20170301").alias("rd"), F.lit("2017-03-01").alias("pfd"), F.lit(None).cast("string").alias("rdng_dttm"),
        F.lit("1200").alias("qtr_intr"), F.lit("12").alias("hr_intr"), F.lit("12:00:00").alias("qtr_intr_10"),
        F.lit("96").alias("pc"), F.lit("kd").alias("uom"), F.lit("ACTUAL").alias("st"), F.lit(0).alias("oi"),
        F.lit(4).alias("demand_factor"))
    return base.select(*READING_FIELDS)


def dims(spark):
    accounts = spark.range(1, 23).select(F.col("id").alias("account_id"), F.lit("RES").alias("plan_code"),
                                          F.lit(5).alias("plan_id"))
    plans = spark.createDataFrame([(5, "A")], "plan_id int, use_type string")
    assignments = spark.range(1, 23).select(F.col("id").alias("account_id"), F.lit(D(2017, 1, 1)).alias("assign_start"),
                                             F.lit(D(2018, 1, 1)).alias("assign_end"))
    seasons = spark.createDataFrame([("A", D(2017, 1, 1), D(2017, 5, 31), "W")],
                                    "use_type string, season_start date, season_end date, si string")
    calendar = spark.createDataFrame([(D(2017, 3, 1), "WD")], "cal_date date, day_type string")
    dayparts = spark.createDataFrame([("ON", 5, "08:00:00", "16:00:00", "WD", "W")],
                                     "pi string, plan_id int, t0 string, t1 string, day_type string, season string")
    return accounts, plans, assignments, seasons, calendar, dayparts


def totals(df):
    return {(r.sa, r.sp): r.ds for r in df.collect()}


def test_aqe_splits_hot_account(spark, skew_conf):
    r = readings(spark).repartition(8)
    out = daily_sum(enrich(r, *dims(spark)), as_string=False)
    got = totals(out)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "skew=true" in plan
    assert sum(got.values()) == float(r.agg(F.sum("rm")).collect()[0][0])


def test_salted_join_matches(spark, skew_conf):
    r = readings(spark).repartition(8)
    d = dims(spark)
    want = totals(daily_sum(enrich(r, *d), as_string=False))
    got = totals(daily_sum(enrich(r, *d, skew="split", rows_per_split=1000), as_string=False))
    assert got == want


def test_salted_join_spreads_rows(spark, skew_conf):
    big = spark.range(10000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(1, "x"), (2, "y")], "k2 int, w string")
    j = salted_join(big, small, "k", "k2", rows_per_split=1000)
    assert j.count() == 10000
    parts = j.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 4
