"""Reading normaliser and dimension clean-up."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slotwise.operators import dimensions as D
from slotwise.operators.normalise import READING_FIELDS, normalise_readings

RAW = ("serv_pnt_id bigint, serv_acct_id bigint, periodcount int, interval_measure int, rdng_meas string, "
       "rdng_chnl_num int, pcfc_day_per_dt string, rdng_dttm string, pcfc_qtr_hr_per_strt_dttm string, "
       "pcfc_hr_per_strt_dttm string, unit_of_meas_cd string, status string, outage_ind int")


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, RAW)


def row(day="2017-03-01", slot="08:15", interval=15, chan=1101, value="9.5", unit="KWH", status=None, pc=96):
    return (7, 11, pc, interval, value, chan, day, f"{day} {slot}:03", f"{day} {slot}:00", f"{day} {slot[:2]}:00:00",
            unit, status, None)


def test_filters_and_projection(spark):
    df = raw_rows(spark, [row(), row(day="2017-03-02"), row(chan=7777), row(interval=60), row(value="10.25")])
    out = normalise_readings(df, "2017-03-01", "2017-03-01", 15)
    assert tuple(out.columns) == READING_FIELDS
    rows = out.collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r.sp, r.sa, r.rsc, r.im, r.rd, r.qtr_intr, r.hr_intr, r.qtr_intr_10, r.uom, r.st, r.demand_factor) == \
        ("7", "11", "complete", "15", "20170301", "0815", "08", "08:15:00", "kd", "ACTUAL", "4")
    assert {x.rm for x in rows} == {"9.5", "10.25"}


def test_typed_and_lenient(spark):
    df = raw_rows(spark, [row(value="1.23456"), row(value="oops")])
    out = normalise_readings(df, "2017-03-01", "2017-03-01", 15, typed=True, lenient=True)
    vals = sorted((r.rm for r in out.collect()), key=lambda v: (v is None, v))
    assert [str(v) if v is not None else None for v in vals] == ["1.2346", None]
    assert out.schema["demand_factor"].dataType.typeName() == "integer"
    with pytest.raises(Exception):
        normalise_readings(df, "2017-03-01", "2017-03-01", 15, typed=True).collect()


def test_unsupported_interval_rejected(spark):
    with pytest.raises(ValueError):
        normalise_readings(raw_rows(spark, [row()]), "2017-03-01", "2017-03-01", 30)


def test_accounts_drop_excluded_and_null(spark):
    df = spark.createDataFrame([(1, "ESP", 5), (2, None, 5), (3, "RES", 6)],
                               "serv_acct_id bigint, serv_plan_cd string, serv_plan_id int")
    assert [r.account_id for r in D.clean_accounts(df).collect()] == [3]


def test_calendar_filter_date_and_timestamp(spark):
    d = spark.createDataFrame([(dt.date(2017, 2, 28), " WD "), (dt.date(2017, 3, 1), "WE ")],
                              "calendar_dt date, weekend_sce_holdy_ind string")
    got = D.clean_calendar(d, "2017-03-01", "2017-03-01").collect()
    assert [(r.cal_date, r.day_type) for r in got] == [(dt.date(2017, 3, 1), "WE")]
    t = d.select(F.col("calendar_dt").cast("timestamp").alias("calendar_dt"), "weekend_sce_holdy_ind")
    assert D.clean_calendar(t, "2017-03-01", "2017-03-01").count() == 1


DP = ("billg_daypart_type_cd string, serv_plan_id int, billg_daypart_strt_pcfc_tm timestamp, "
      "billg_daypart_end_pcfc_tm timestamp, billg_daypart_day_type_cd string, Seasn_cd string, "
      "serv_meas_type_cd string, billg_daypart_strt_dt date, billg_daypart_end_dt date")


def dp_rows(spark, rows):
    return spark.createDataFrame(rows, DP)


def test_dayparts_as_of_codes_and_utc(spark):
    t = dt.datetime
    rows = [(" ON ", 1, t(2017, 1, 1, 8), t(2017, 1, 1, 11, 59, 59), " WD", "W ", "KWHSNP ", dt.date(2023, 1, 1), dt.date(2024, 12, 31)),
            ("OFF", 1, t(2017, 1, 1, 14), t(2017, 1, 1, 18), "WE", "S", "KWHWFP", dt.date(2023, 1, 1), dt.date(2024, 1, 10)),
            (None, 1, t(2017, 1, 1), t(2017, 1, 1, 1), "WD", "W", "KWHSMP", dt.date(2023, 1, 1), dt.date(2024, 12, 31)),
            ("MID", 1, t(2017, 1, 1), t(2017, 1, 1, 1), "WD", "W", "OTHER", dt.date(2023, 1, 1), dt.date(2024, 12, 31))]
    df = dp_rows(spark, rows)
    early = D.clean_dayparts(df, as_of="2024-01-09").orderBy("pi").collect()
    assert [(r.pi, r.t0, r.t1, r.day_type, r.season) for r in early] == [
        ("OFF", "22:00:00", "02:00:00", "WE", "S"), ("ON", "16:00:00", "19:59:59", "WD", "W")]
    # valid_to is exclusive: the row ending 2024-01-10 is gone on that day.
    assert [r.pi for r in D.clean_dayparts(df, as_of="2024-01-10").collect()] == ["ON"]
    # default: valid today (the reference's behaviour).
    assert D.clean_dayparts(df).count() >= 0
