"""Dimension clean-up (P12-P14, F4-F7): raw dimension tables -> the narrow,
trimmed frames the enrichment joins against."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from slotwise.functions.readings import DAYPART_ZONE, utc_time_of_day

# Fixed values of the reference's day-part filter.
PART_CODES = ("MID", "OFF", "ON", "SOF")
MEASURE_CODES = ("KWHSFP", "KWHSNP", "KWHSMP", "KWHWFP", "KWHWNP", "KWHWMP", "KWHSSP", "KWHWSP")
# Plan code the reference leaves out of the account dimension.
EXCLUDED_PLAN = "ESP"


def clean_accounts(raw: DataFrame, excluded: str = EXCLUDED_PLAN, account="serv_acct_id",
                   plan_code="serv_plan_cd", plan_id="serv_plan_id") -> DataFrame:
    """accounts whose plan code is not ``excluded`` (a NULL code is dropped too)."""
    return raw.where(F.col(plan_code) != F.lit(excluded)).select(
        F.col(account).alias("account_id"), F.col(plan_code).alias("plan_code"),
        F.col(plan_id).alias("plan_id"))


def clean_plans(raw: DataFrame, plan_id="serv_plan_id", use_type="seasn_use_type_cd") -> DataFrame:
    """Plan id with the trimmed season use type."""
    return raw.select(F.col(plan_id).alias("plan_id"), F.trim(F.col(use_type)).alias("use_type"))


def clean_assignments(raw: DataFrame, account="serv_acct_id", start="serv_plan_assign_strt_dt",
                      end="serv_plan_assign_end_dt") -> DataFrame:
    """Plan assignment ranges ``[assign_start, assign_end)`` per account."""
    return raw.select(F.col(account).alias("account_id"), F.col(start).alias("assign_start"),
                      F.col(end).alias("assign_end"))


def clean_seasons(raw: DataFrame, use_type="season_use_type_cd", start="season_strt_dt",
                  end="season_end_dt", code="season_cd") -> DataFrame:
    """Seasons ``[season_start, season_end]`` per trimmed use type, code as ``si``."""
    return raw.select(F.trim(F.col(use_type)).alias("use_type"), F.col(start).alias("season_start"),
                      F.col(end).alias("season_end"), F.trim(F.col(code)).alias("si"))


def clean_calendar(raw: DataFrame, start: str, end: str, day="calendar_dt",
                   day_type="weekend_sce_holdy_ind") -> DataFrame:
    """calendar days inside the run window with the trimmed day type.

    A ``date`` column is compared directly, which keeps the filter pushable
    into the scan; other types go through ``to_date`` like the reference."""
    d = F.col(day)
    if not isinstance(raw.schema[day].dataType, DateType):
        d = F.to_date(d)
    lo, hi = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    return raw.where(d.between(lo, hi)).select(d.alias("cal_date"),
                                               F.trim(F.col(day_type)).alias("day_type"))


def clean_dayparts(raw: DataFrame, as_of: str | _dt.date | None = None, zone: str = DAYPART_ZONE,
                   normalise_times: bool = False, part="billg_daypart_type_cd",
                   plan_id="serv_plan_id", t0="billg_daypart_strt_pcfc_tm",
                   t1="billg_daypart_end_pcfc_tm", day_type="billg_daypart_day_type_cd",
                   season="Seasn_cd", measure="serv_meas_type_cd", valid_from="billg_daypart_strt_dt",
                   valid_to="billg_daypart_end_dt") -> DataFrame:
    """Billing day parts of the known part and measure codes
    that are valid on ``as_of`` (``valid_from <= as_of <= valid_to - 1 day``),
    with their local bounds turned into UTC time of day.

    ``as_of=None`` uses the current date, as the reference does (quirk X6);
    pass the run date for a history load."""
    as_of_col = F.current_date() if as_of is None else F.to_date(F.lit(str(as_of)))
    kept = raw.where(F.trim(F.col(part)).isin(list(PART_CODES))
                     & F.trim(F.col(measure)).isin(list(MEASURE_CODES))
                     & (as_of_col >= F.col(valid_from))
                     & (as_of_col <= F.date_sub(F.col(valid_to), 1)))
    return kept.select(
        F.coalesce(F.trim(F.col(part)), F.lit("")).alias("pi"),
        F.col(plan_id).alias("plan_id"),
        utc_time_of_day(t0, zone, normalise_times).alias("t0"),
        utc_time_of_day(t1, zone, normalise_times).alias("t1"),
        F.trim(F.col(day_type)).alias("day_type"),
        F.trim(F.col(season)).alias("season"),
    )
