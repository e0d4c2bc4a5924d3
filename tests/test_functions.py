"""Scalar expressions (P3-P10, P14, P21, P22, F10) on hand-made rows."""

from pyspark.sql import functions as F

from slotwise.functions import readings as R
from slotwise.functions import text as X


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_completeness(spark):
    counts = [0, 23, 24, 25, 46, 92, 96, 100, 95, None]
    df = spark.createDataFrame([(c,) for c in counts], "pc int")
    got = col_values(df, R.completeness("pc"))
    assert got == ["complete"] * 8 + ["partial", "partial"]


def test_unit_status_factor(spark):
    df = spark.createDataFrame([(" kwh_del ",), ("KWH",), ("KWH_NET",), ("Kwh_Rec",), ("kvarh",), ("X",), (None,)], "u string")
    assert col_values(df, R.unit_code("u")) == ["kd", "kd", "kn", "kr", "kv", None, None]
    st = spark.createDataFrame([("Estimated",), ("estimated",), (None,), ("Read",)], "s string")
    assert col_values(st, R.status_code("s")) == ["ESTIMATED", "ACTUAL", "ACTUAL", "ACTUAL"]
    iv = spark.createDataFrame([(15,), (60,)], "i int")
    assert col_values(iv, R.demand_factor("i")) == ["4", "1"]
    assert col_values(iv, R.demand_factor("i", typed=True)) == [4, 1]


def test_slot_keys(spark):
    df = spark.createDataFrame([(15, "2024-01-19 08:45:00", "2024-01-19 08:00:00"),
                                (60, "2024-01-19 08:45:00", "2024-01-19 08:00:00"),
                                (30, "2024-01-19 08:45:00", "2024-01-19 08:00:00")], "i int, q string, h string")
    assert col_values(df, R.slot_key("i", "q", "h")) == ["0845", "0800", None]
    assert col_values(df, R.hour_key("h")) == ["08"] * 3
    assert col_values(df, R.slot_time("q")) == ["08:45:00"] * 3
    assert col_values(df, R.compact_date(F.substring("q", 1, 10))) == ["20240119"] * 3


def test_utc_time_follows_daylight_saving(spark):
    df = spark.createDataFrame([("2017-03-01 08:00:00",), ("2017-07-01 08:00:00",)], "t string") \
        .select(F.to_timestamp("t").alias("t"))
    assert col_values(df, R.utc_time_of_day("t")) == ["16:00:00", "15:00:00"]
    assert col_values(df, R.utc_time_of_day("t", normalise=True)) == ["16:00:00", "15:00:00"]


def test_day_bounds(spark):
    df = spark.createDataFrame([("2024-02-28",), ("2024-02-29",)], "d string")
    s, e = R.day_bounds("d")
    assert [tuple(r) for r in df.select(s, e).collect()] == [
        ("2024-02-28 00:00:00", "2024-02-29 00:00:00"), ("2024-02-29 00:00:00", "2024-03-01 00:00:00")]


def test_length_and_blank(spark):
    vals = [None, "", " ", "\t", " ", "x"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert col_values(df, X.any_length("v")) == [4, 0, 1, 1, 1, 1]
    assert col_values(df, X.any_length("v", null_length=None)) == [None, 0, 1, 1, 1, 1]
    assert col_values(df, X.is_blank("v")) == [False, True, True, True, True, False]


def test_tokens_keep_empty(spark):
    df = spark.createDataFrame([("a  b ",), ("",), (None,)], "v string")
    assert col_values(df, X.tokens("v")) == [["a", "", "b", ""], [""], None]
    ex = df.select(F.explode(X.tokens("v")).alias("t"))
    assert sorted(r.t for r in ex.collect()) == ["", "", "", "a", "b"]
