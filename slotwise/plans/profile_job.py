"""The column-profile job (section 3.2 of the survey): a table -> one
profile row per column -> pipe-delimited report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from slotwise.operators.profile import column_profile, profile_report
from slotwise.sinks.files import read_report, write_report

REPORT_SCHEMA = StructType([StructField(n, StringType()) for n in (
    "db", "table_name", "column_name", "is_distinct", "has_blanks", "has_nulls")]
    + [StructField("max_length", IntegerType()), StructField("min_length", IntegerType())])


def profile_table(spark: SparkSession, db: str, table: str, df: DataFrame | None = None,
                  report_path: str | None = None, **kw) -> DataFrame:
    """Profile ``db.table`` (or the given frame) in one job; with
    ``report_path`` also write the reference's report lines there."""
    src = df if df is not None else spark.table(f"{db}.{table}")
    prof = column_profile(src, db=db, table=table, **kw)
    if report_path:
        write_report(profile_report(prof), report_path)
    return prof


def read_profile_report(spark: SparkSession, path: str) -> DataFrame:
    return read_report(spark, path, REPORT_SCHEMA)
