"""Column-level building blocks (JVM-side expressions, no Python UDFs)."""

from slotwise.functions.readings import (  # noqa: F401
    completeness, compact_date, demand_factor, hour_key, slot_key,
    slot_time, status_code, time_of_day, unit_code, utc_time_of_day, day_bounds,
)
from slotwise.functions.text import any_length, is_blank, tokens  # noqa: F401
