"""Scalar expressions of the reading normaliser and its outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the reading normaliser must reproduce exactly.
# Period counts that make a reading day "complete" (divisible by any of them).
COMPLETE_DIVISORS = (23, 24, 25)
# Unit code map, applied after upper(trim()); anything else maps to NULL.
UNIT_CODES = (("KVARH", "kv"), ("KWH_DEL", "kd"), ("KWH", "kd"), ("KWH_NET", "kn"), ("KWH_REC", "kr"))
# Status text that marks an estimated reading; every other value (NULL too) is actual.
ESTIMATED_TEXT = "Estimated"
# Time zone of the day-part bounds stored in local wall-clock time.
DAYPART_ZONE = "America/Los_Angeles"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def completeness(period_count) -> Column:
    """P3: 'complete' when the count divides by 23, 24 or 25, else 'partial' (NULL too)."""
    pc = _c(period_count)
    cond = None
    for d in COMPLETE_DIVISORS:
        term = (pc % d) == 0
        cond = term if cond is None else (cond | term)
    return F.when(cond, F.lit("complete")).otherwise(F.lit("partial"))


def compact_date(day) -> Column:
    """P4: 'yyyy-MM-dd' (string or date) -> 'yyyyMMdd'."""
    return F.regexp_replace(_c(day).cast("string"), "-", "")


def slot_key(interval, quarter_ts, hour_ts) -> Column:
    """P5: 'HHMM' of the quarter-hour start (interval 15) or of the hour start
    (interval 60); NULL for any other interval."""
    iv = _c(interval)

    def hhmm(ts):
        return F.regexp_replace(F.substring(_c(ts).cast("string"), 12, 5), ":", "")

    return F.when(iv == 15, hhmm(quarter_ts)).when(iv == 60, hhmm(hour_ts))


def hour_key(hour_ts) -> Column:
    """P6: 'HH' of the hour start."""
    return F.substring(_c(hour_ts).cast("string"), 12, 2)


def slot_time(quarter_ts) -> Column:
    """Ten characters from position 12 of the quarter-hour start text."""
    return F.substring(_c(quarter_ts).cast("string"), 12, 10)


def time_of_day(ts) -> Column:
    """'HH:mm:ss' of a timestamp or timestamp text (normalised form, quirk X5)."""
    return F.date_format(F.to_timestamp(_c(ts).cast("string")), "HH:mm:ss")


def unit_code(unit) -> Column:
    """Unit-of-measure code after upper(trim())."""
    u = F.upper(F.trim(_c(unit)))
    out = None
    for raw, code in UNIT_CODES:
        out = F.when(u == raw, F.lit(code)) if out is None else out.when(u == raw, F.lit(code))
    return out


def status_code(status) -> Column:
    """Exactly 'Estimated' -> 'ESTIMATED', everything else (NULL too) -> 'ACTUAL'."""
    return F.when(_c(status) == ESTIMATED_TEXT, F.lit("ESTIMATED")).otherwise(F.lit("ACTUAL"))


def demand_factor(interval, typed: bool = False) -> Column:
    """P10: 4 for quarter-hour readings, else 1 ('4' / '1' text unless ``typed``)."""
    iv = _c(interval)
    if typed:
        return F.when(iv == 15, F.lit(4)).otherwise(F.lit(1))
    return F.when(iv == 15, F.lit("4")).otherwise(F.lit("1"))


def utc_time_of_day(local_ts, zone: str = DAYPART_ZONE, normalise: bool = False) -> Column:
    """Time of day in UTC of a local wall-clock timestamp; the shift
    follows the daylight-saving state of the stored date.

    Default is the reference's text: ten characters from position 12 of the
    UTC timestamp's string form ('HH:mm:ss', plus a fraction when present).
    ``normalise=True`` always yields 'HH:mm:ss' (quirk X5)."""
    utc = F.to_utc_timestamp(_c(local_ts), zone)
    if normalise:
        return F.date_format(utc, "HH:mm:ss")
    return F.substring(utc.cast("string"), 12, 10)


def day_bounds(day) -> tuple[Column, Column]:
    """('<day> 00:00:00', '<day + 1> 00:00:00')."""
    d = _c(day)
    start = F.concat(d.cast("string"), F.lit(" 00:00:00"))
    end = F.concat(F.date_add(F.to_date(d.cast("string")), 1).cast("string"), F.lit(" 00:00:00"))
    return start, end

