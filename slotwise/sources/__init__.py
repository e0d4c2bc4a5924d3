"""Batch and stream sources (S1-S6) and the fixture adapters over the driver tables."""

from slotwise.sources.tables import (  # noqa: F401
    TABLES, columns_of, list_tables, read_lines, read_table, register_tables, scan_sql,
)
from slotwise.sources.streams import file_stream, kafka_options, kafka_stream  # noqa: F401
