"""Reading normaliser (P1-P11, F1-F3): raw interval readings -> the 17-column
reading frame every output is computed from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.readings import (
    compact_date, completeness, demand_factor, hour_key, slot_key, slot_time, status_code, unit_code,
)

# Fixed values of the reference's reading filter: channels kept, intervals supported.
CHANNELS = (1101, 1102, 1103, 9104)
INTERVALS = (15, 60)


@dataclass(frozen=True)
class ReadingColumns:
    """Physical column names of the raw reading table (reference names by default)."""
    point: str = "serv_pnt_id"
    account: str = "serv_acct_id"
    period_count: str = "periodcount"
    interval: str = "interval_measure"
    value: str = "rdng_meas"
    channel: str = "rdng_chnl_num"
    day: str = "pcfc_day_per_dt"
    read_time: str = "rdng_dttm"
    quarter_start: str = "pcfc_qtr_hr_per_strt_dttm"
    hour_start: str = "pcfc_hr_per_strt_dttm"
    unit: str = "unit_of_meas_cd"
    status: str = "status"
    outage: str = "outage_ind"


def normalise_readings(src: DataFrame, start: str, end: str, interval: int = 15,
                       channels=CHANNELS, typed: bool = False, lenient: bool = False,
                       cols: ReadingColumns = ReadingColumns(), keep_keys: bool = False) -> DataFrame:
    """Filter the raw readings to the run window, interval and channels, and
    project them to the reading frame.

    The filter is written on the raw columns before any projection, so it is
    pushed into the scan (and prunes ``day`` partitions when the table is
    partitioned by it). ``typed=False`` keeps the reference's text types
    (value, demand factor as strings); ``typed=True`` keeps the value as
    ``decimal(18,4)`` (exact sums) and the demand factor as int.
    ``lenient=True`` turns malformed values into NULL instead of failing
    (quirk X15); text values stay as they are, and the outputs' own
    ``lenient`` reads them. ``keep_keys`` adds the account id and the reading
    day in their own types (``JOIN_KEYS``), for the joins. An interval other than 15 or 60 would give NULL slot
    keys, so it is rejected up front (quirk X7).
    """
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {INTERVALS}, got {interval!r}")
    c = cols
    kept = src.where(F.col(c.day).between(F.lit(start), F.lit(end))
                     & (F.col(c.interval) == F.lit(interval))
                     & F.col(c.channel).isin(list(channels)))
    if typed:
        v = F.col(c.value)
        value = (v.try_cast("decimal(18,4)") if lenient else v.cast("decimal(18,4)"))
    else:
        value = F.col(c.value).cast("string")
    keys = [F.col(c.account).alias("_account"), F.to_date(F.col(c.day)).alias("_day")] if keep_keys else []
    return kept.select(
        F.col(c.point).cast("string").alias("sp"),
        F.col(c.account).cast("string").alias("sa"),
        completeness(c.period_count).alias("rsc"),
        F.col(c.interval).cast("string").alias("im"),
        value.alias("rm"),
        F.col(c.channel).cast("string").alias("chnl"),
        compact_date(c.day).alias("rd"),
        F.col(c.day).cast("string").alias("pfd"),
        F.col(c.read_time).alias("rdng_dttm"),
        slot_key(c.interval, c.quarter_start, c.hour_start).alias("qtr_intr"),
        hour_key(c.hour_start).alias("hr_intr"),
        slot_time(c.quarter_start).alias("qtr_intr_10"),
        F.col(c.period_count).cast("string").alias("pc"),
        unit_code(c.unit).alias("uom"),
        status_code(c.status).alias("st"),
        F.col(c.outage).alias("oi"),
        demand_factor(c.interval, typed=typed).alias("demand_factor"),
        *keys,
    )


JOIN_KEYS = ("_account", "_day")


READING_FIELDS = ("sp", "sa", "rsc", "im", "rm", "chnl", "rd", "pfd", "rdng_dttm", "qtr_intr", "hr_intr",
                  "qtr_intr_10", "pc", "uom", "st", "oi", "demand_factor")
