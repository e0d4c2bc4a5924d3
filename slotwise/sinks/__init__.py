"""Sinks: partitioned JSON records, delimited reports, console, temp views (K1-K5)."""

from slotwise.sinks.files import (  # noqa: F401
    as_view, console, read_records, read_report, write_records, write_report,
)
