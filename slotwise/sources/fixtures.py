"""Adapters that give the driver tables the shape of the reference's inputs.

The reference reads Hive tables of interval readings and six dimensions;
the test data has TPC-H-like tables instead. These functions derive frames
with the reference's raw column names from the driver tables (FIXTURES.md
section C), so the library operators run on them unchanged. All are plain
projections of the given tables (plus one ``distinct`` for the calendar), so
their size grows with the data; the literal rows below are parameters of
the fixtures, attached per row through ``explode`` rather than a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.sources.tables import read_table

# Fixed fixture values (FIXTURES.md section C).
# Plan code that plays the role of the reference's excluded code.
EXCLUDED_PLAN = "MACHINERY"
# Run window and interval of the fixture readings.
WINDOW = ("2024-01-19", "2024-01-22")
INTERVAL = 15
# Event type -> reading channel; any other type gets the foreign channel 7777.
CHANNEL_OF_EVENT = (("click", 1101), ("view", 1102), ("purchase", 1103), ("error", 9104))
FOREIGN_CHANNEL = 7777
# Raw unit texts by event_id % 5 (mixed case, padded on purpose).
UNIT_TEXTS = (" kwh_del ", "KWH", "KWH_NET", "Kwh_Rec", "KVARH")
# Two seasons per use type, changing inside the window: (start, end, code).
SEASON_ROWS = (("2023-10-01", "2024-01-20", "W"), ("2024-01-21", "2024-05-31", "S"))
# Plan assignment bounds: start for all; end for even / odd accounts.
ASSIGN_START, ASSIGN_END_EVEN, ASSIGN_END_ODD = "2023-12-20", "2024-01-21", "2024-03-01"
# Clean day parts (UTC time of day): part, t0, t1, day type, season.
DAYPART_ROWS = (("OFF", "00:00:00", "07:59:59", "WD", "W"),
                ("MID", "08:00:00", "15:59:59", "WD", "W"),
                ("ON", "16:00:00", "20:59:59", "WD", "W"),
                ("SOF", "20:00:00", "23:59:59", "WE", "S"))
# Raw day parts: part, measure, local t0, local t1, day type, season, valid from, valid to.
DAYPART_SRC_ROWS = ((" ON ", "KWHSNP ", "2017-01-01 08:00:00", "2017-01-01 11:59:59", "WD", "W", "2023-01-01", "2024-12-31"),
                    ("OFF", "KWHWFP", "2017-01-01 14:00:00", "2017-01-01 18:00:00", "WE", "S", "2023-01-01", "2024-01-10"),
                    (None, "KWHSMP", "2017-01-01 00:00:00", "2017-01-01 01:00:00", "WD", "W", "2023-01-01", "2024-12-31"),
                    ("BAD", "KWHSMP", "2017-01-01 00:00:00", "2017-01-01 01:00:00", "WD", "W", "2023-01-01", "2024-12-31"),
                    ("MID", "OTHER", "2017-01-01 00:00:00", "2017-01-01 01:00:00", "WD", "W", "2023-01-01", "2024-12-31"))


def _sql_literal(v, t: str) -> str:
    if v is None:
        return f"CAST(NULL AS {t})"
    text = "'" + str(v).replace("'", "''") + "'"
    return text if t == "string" else f"{t.upper()} {text}"


def _rows_column(rows, names, types):
    """Literal rows as an array of structs, to be exploded onto each input
    row (one SQL expression, parsed once)."""
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{n}', {_sql_literal(v, t)}" for v, n, t in zip(r, names, types)) + ")"
        for r in rows)
    return F.explode(F.expr(f"array({structs})"))


# Raw day parts with summer and winter bounds, a part that crosses midnight in UTC
# (16:00 to 18:00 local), two parts that meet at a bound and a duplicate row.
DAYPART_RAW_ROWS = (("OFF", "KWHWFP", "2017-01-01 16:00:00", "2017-01-01 18:00:00", "WD", "W", "2023-01-01", "2024-12-31"),
                    ("MID", "KWHWMP", "2017-01-01 02:00:00", "2017-01-01 06:00:00", "WD", "W", "2023-01-01", "2024-12-31"),
                    ("ON", "KWHWNP", "2017-01-01 06:00:00", "2017-01-01 09:00:00", "WD", "W", "2023-01-01", "2024-12-31"),
                    ("ON", "KWHWNP", "2017-01-01 06:00:00", "2017-01-01 09:00:00", "WD", "W", "2023-01-01", "2024-12-31"),
                    ("SOF", "KWHSSP", "2017-07-01 07:00:00", "2017-07-01 12:00:00", "WE", "S", "2023-01-01", "2024-12-31"),
                    (" MID ", "KWHSMP ", "2017-07-01 12:00:00", "2017-07-01 16:59:59", "WE", "S", "2023-01-01", "2024-12-31"))


def readings_src(spark: SparkSession, base: str, offgrid: bool = False, malformed: bool = False) -> DataFrame:
    """Raw interval readings with the reference's column names, one per event.

    ``offgrid``: every 13th event keeps its own minute as its slot, every 17th
    has no slot. ``malformed``: values as text, every 19th of them no number."""
    ev = read_table(spark, "events", base)
    day = F.to_date("ts").cast("string")
    hh = F.lpad(F.hour("ts").cast("string"), 2, "0")
    minute = (F.floor(F.minute("ts") / 15) * 15).cast("int")
    if offgrid:
        minute = F.when(F.col("event_id") % 17 == 0, F.lit(None)).when(F.col("event_id") % 13 == 0, F.minute("ts")).otherwise(minute)
    mm = F.lpad(minute.cast("string"), 2, "0")
    value = F.col("value")
    if malformed:
        value = F.when(F.col("event_id") % 19 == 0, F.lit("x1")).otherwise(value.cast("string"))
    chan = None
    for et, ch in CHANNEL_OF_EVENT:
        chan = F.when(F.col("event_type") == et, ch) if chan is None else chan.when(F.col("event_type") == et, ch)
    unit = None
    for i, u in enumerate(UNIT_TEXTS):
        unit = F.when(F.col("event_id") % 5 == i, u) if unit is None else unit.when(F.col("event_id") % 5 == i, u)
    return ev.select(
        (F.col("user_id") % 50).alias("serv_pnt_id"),
        F.col("user_id").alias("serv_acct_id"),
        (F.col("user_id") % 101).cast("int").alias("periodcount"),
        F.when(F.col("event_id") % 10 == 9, 60).otherwise(15).alias("interval_measure"),
        value.alias("rdng_meas"),
        chan.otherwise(FOREIGN_CHANNEL).alias("rdng_chnl_num"),
        F.to_date("ts").alias("pcfc_day_per_dt"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("rdng_dttm"),
        F.concat(day, F.lit(" "), hh, F.lit(":"), mm, F.lit(":00")).alias("pcfc_qtr_hr_per_strt_dttm"),
        F.concat(day, F.lit(" "), hh, F.lit(":00:00")).alias("pcfc_hr_per_strt_dttm"),
        unit.alias("unit_of_meas_cd"),
        F.when(F.col("event_id") % 7 == 0, "Estimated").when(F.col("event_id") % 7 == 1, F.lit(None))
         .otherwise("Read").alias("status"),
        F.when(F.col("event_id") % 11 == 0, 1).when(F.col("event_id") % 11 == 1, F.lit(None))
         .otherwise(0).alias("outage_ind"),
    )


def accounts_src(spark: SparkSession, base: str) -> DataFrame:
    """Service accounts: account id, plan code, plan id."""
    return read_table(spark, "customer", base).select(
        F.col("c_custkey").alias("serv_acct_id"), F.col("c_mktsegment").alias("serv_plan_cd"),
        F.col("c_nationkey").alias("serv_plan_id"))


def plans_src(spark: SparkSession, base: str) -> DataFrame:
    """Service plans with a space-padded season use type."""
    return read_table(spark, "nation", base).select(
        F.col("n_nationkey").alias("serv_plan_id"),
        F.concat(F.lit(" "), F.col("n_regionkey").cast("string"), F.lit(" ")).alias("seasn_use_type_cd"))


def assignments_src(spark: SparkSession, base: str) -> DataFrame:
    """Plan assignments, half-open date ranges."""
    return read_table(spark, "customer", base).select(
        F.col("c_custkey").alias("serv_acct_id"),
        F.to_date(F.lit(ASSIGN_START)).alias("serv_plan_assign_strt_dt"),
        F.when(F.col("c_custkey") % 2 == 0, F.to_date(F.lit(ASSIGN_END_EVEN)))
         .otherwise(F.to_date(F.lit(ASSIGN_END_ODD))).alias("serv_plan_assign_end_dt"))


def seasons_src(spark: SparkSession, base: str) -> DataFrame:
    """Two closed-range seasons per use type."""
    s = _rows_column(SEASON_ROWS, ("start", "end", "code"), ("date", "date", "string"))
    return (read_table(spark, "region", base)
            .select(F.col("r_regionkey").cast("string").alias("season_use_type_cd"), s.alias("s"))
            .select("season_use_type_cd", F.col("s.start").alias("season_strt_dt"),
                    F.col("s.end").alias("season_end_dt"), F.col("s.code").alias("season_cd")))


def calendar_src(spark: SparkSession, base: str) -> DataFrame:
    """One row per event day with a weekday / weekend flag."""
    ev = read_table(spark, "events", base)
    return ev.select(
        F.to_date("ts").alias("calendar_dt"),
        F.when((F.dayofmonth("ts") % 7).isin(6, 0), "WE").otherwise("WD").alias("weekend_sce_holdy_ind"),
    ).distinct()


def dayparts_clean(spark: SparkSession, base: str) -> DataFrame:
    """Already-clean day parts per plan (UTC time of day), as the enrichment takes them."""
    p = _rows_column(DAYPART_ROWS, ("pi", "t0", "t1", "day_type", "season"),
                     ("string",) * 5)
    return (read_table(spark, "nation", base)
            .select(F.col("n_nationkey").alias("plan_id"), p.alias("p"))
            .select(F.col("p.pi"), "plan_id", F.col("p.t0"), F.col("p.t1"),
                    F.col("p.day_type"), F.col("p.season")))


def dayparts_src(spark: SparkSession, base: str, rows=DAYPART_SRC_ROWS) -> DataFrame:
    """Raw billing day parts per plan with the reference's column names."""
    names = ("billg_daypart_type_cd", "serv_meas_type_cd", "billg_daypart_strt_pcfc_tm",
             "billg_daypart_end_pcfc_tm", "billg_daypart_day_type_cd", "Seasn_cd",
             "billg_daypart_strt_dt", "billg_daypart_end_dt")
    types = ("string", "string", "timestamp", "timestamp", "string", "string", "date", "date")
    p = _rows_column(rows, names, types)
    return (read_table(spark, "nation", base)
            .select(F.col("n_nationkey").alias("serv_plan_id"), p.alias("p"))
            .select("serv_plan_id", *[F.col(f"p.{n}") for n in names]))
